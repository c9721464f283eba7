"""SimHash near-duplicates: deletion-variant signatures, equality joins, connected groups.

The fingerprint is cut into two halves of 32 bits. Three differing bits or fewer put at most one
into some half, so two linked fingerprints agree on that half, whole or once its differing bit is
masked. Every distinct half is indexed whole and with each bit masked (its deletion variants, 32
keys), rows meet by equality of keys, and each meeting is verified by counting the differing bits.

No group is ever expanded into all its pairs. Copies collapse to one row per distinct fingerprint
first, and fingerprints of one half to one row per half before variants are made: a group of one half
has one key, not 32 with the same members. Two halves share at most one variant, as they differ in
just its bit, and only the fingerprints of such pairs become rows of it. In each key group all members
are compared with one hub, the fingerprint that most documents have; the links found are contracted
to components; only key groups that still hold several components are looked at again, and there two
members meet only if they are in different components and also agree on one byte of the other half
(three bits cannot touch all four).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskspark.llm.common import as_rows, ready, signed, text_chunks
from riskspark.llm.components import connected_components
from riskspark.sources.workdir import stage_table

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
#: Shingles whose bits are unpacked at a time.
BLOCK = 1 << 18

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Unsigned XXH64 of each run of ``size`` words, or of the whole sequence if it is shorter."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends[min(size, len(words)) - 1 :])],
        np.uint64,
    )


def fingerprints_of(hashes: list[np.ndarray]) -> np.ndarray:
    """Majority bits: a bit is set if it is set in over half of the hashes; none gives zero."""
    sizes = np.array([len(h) for h in hashes], np.int64)
    counts = np.zeros((len(hashes), 64), np.int64)
    if sizes.sum():
        flat = np.concatenate(hashes)
        owner = np.repeat(np.arange(len(hashes)), sizes)
        for low in range(0, len(flat), BLOCK):
            bits = np.unpackbits(
                flat[low : low + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
            )
            mine = owner[low : low + BLOCK]
            first = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1])))
            counts[mine[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    majority = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").reshape(-1)


def with_fingerprint(docs: DataFrame, name: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and a long ``name`` with the SimHash of ``text``; null text is empty."""
    ready(docs.sparkSession)
    source = docs.select(*keep, F.col("text").alias("__text"))
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches, "__text"):
            body = data.tobytes()
            hashes = [shingle_hashes(body[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            columns = [rows.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(signed(fingerprints_of(hashes)))], names=[*keep, name]
            )

    return source.mapInArrow(run, schema)


def _half(fingerprint: Column, which: int) -> Column:
    return F.shiftrightunsigned(fingerprint, 32) if which else fingerprint.bitwiseAND(0xFFFFFFFF)


def half_keys(fingerprint: Column) -> Column:
    """The two whole halves as keys: which half in the upper bits, above those of variants."""
    return F.array(*[_half(fingerprint, which).bitwiseOR(F.lit((64 + which) << 32)) for which in (0, 1)])


def variant_keys(half: Column) -> Column:
    """The 32 keys of a half key: (half, masked bit) in the upper bits, the half without that bit in the lower."""
    slot = F.shiftrightunsigned(half, 32).bitwiseAND(1) * 32
    rest = half.bitwiseAND(0xFFFFFFFF)
    return F.array(
        *[
            rest.bitwiseAND(0xFFFFFFFF ^ (1 << bit)).bitwiseOR(F.shiftleft(slot + bit, 32))
            for bit in range(32)
        ]
    )


def _of_first_half(key: Column) -> Column:
    slot = F.shiftrightunsigned(key, 32)
    return (slot < 32) | (slot == 64)


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def fingerprint_components(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``node``, ``component`` over a table (``fp`` unique, ``n_docs``), for linked fingerprints only."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves find up to three differing bits")
    entries = distinct.select("fp", "n_docs", F.explode(half_keys(F.col("fp"))).alias("half"))
    # the fingerprints of one half are one row from here on, whatever their number
    halves = stage_table(
        entries.groupBy("half").agg(F.max(F.struct("n_docs", "fp")).alias("top"), F.count(F.lit(1)).alias("members")),
        "simhash-halves",
    )
    variants = (
        halves.select("half", F.explode(variant_keys(F.col("half"))).alias("key"))
        .groupBy("key")
        .agg(F.min("half").alias("low"), F.max("half").alias("high"))
        .where("low < high")
    )
    pairs = variants.select("key", F.explode(F.array("low", "high")).alias("half"))
    tops = stage_table(pairs.hint("merge").join(halves.select("half", "top"), "half"), "simhash-variants")
    # the hub of a variant is that of one of its two halves
    hubs = tops.groupBy("key").agg(F.max("top").alias("top")).select("key", F.col("top.fp").alias("hub"))
    groups = tops.select("half", "key").hint("merge").join(hubs, "key")
    groups = groups.union(halves.where("members > 1").select("half", F.col("half").alias("key"), F.col("top.fp")))
    # the planner's estimate does not know that each row became many: it must not take the entries for small
    met = stage_table(
        entries.select("half", "fp").hint("merge").join(groups, "half").select("key", "fp", "hub"), "simhash-keys"
    )
    links = stage_table(
        met.where((F.col("fp") != F.col("hub")) & _near("fp", "hub", max_bits))
        .select(F.col("fp").alias("a"), F.col("hub").alias("b"))
        .distinct(),
        "simhash-links",
    )
    first = stage_table(connected_components(links, "a", "b"), "simhash-groups")
    grouped = met.join(first, met.fp == first.node, "left").select(
        "key", "fp", F.coalesce("component", "fp").alias("own")
    )
    still_open = (
        grouped.groupBy("key")
        .agg(F.min("own").alias("low"), F.max("own").alias("high"))
        .where("low < high")
        .select("key")
    )
    # which byte of the other half: four rows for each member of an open group
    parts = F.array(
        *[
            F.when(
                _of_first_half(F.col("key")),
                F.shiftright(_half(F.col("fp"), 1), 8 * i).bitwiseAND(0xFF),
            )
            .otherwise(F.shiftright(_half(F.col("fp"), 0), 8 * i).bitwiseAND(0xFF))
            .bitwiseOR(F.lit(i << 8))
            for i in range(4)
        ]
    )
    members = stage_table(
        grouped.join(still_open, "key", "left_semi").select("key", "fp", "own", F.explode(parts).alias("part")),
        "simhash-open",
    )
    others = members.select("key", "part", F.col("fp").alias("other"), F.col("own").alias("other_own"))
    more = (
        members.join(others, ["key", "part"])
        .where((F.col("own") < F.col("other_own")) & _near("fp", "other", max_bits))
        .select("own", "other_own")
        .distinct()
    )
    # whole components are joined: their members need not be looked at again
    joined = connected_components(more, "own", "other_own").select(F.col("node").alias("own"), F.col("component").alias("whole"))
    joined = stage_table(joined, "simhash-joined")
    within = first.join(joined, first.component == joined.own, "left").select("node", F.coalesce("whole", "component").alias("component"))
    alone = joined.join(first, joined.own == first.node, "left_anti").select(F.col("own").alias("node"), F.col("whole").alias("component"))
    return within.union(alone)


def _owned(docs: DataFrame, max_bits: int, low: Column) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``text_hash``, ``fp`` of all rows; ``fp``, ``low`` (an aggregate), ``own`` (component) of each fp."""
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    prints = stage_table(with_fingerprint(texts, "fp", ["doc_id", "text_hash"]), "simhash")
    distinct = stage_table(
        prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n_docs"), low.alias("low")), "simhash-distinct"
    )
    groups = fingerprint_components(distinct.select("fp", "n_docs"), max_bits)
    owned = stage_table(
        distinct.join(groups, distinct.fp == groups.node, "left").select(
            "fp", "low", F.coalesce("component", "fp").alias("own")
        ),
        "simhash-owned",
    )
    return prints, owned


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp`` (long) and ``component_id``, one row per input row.

    ``component_id`` is the smallest doc_id among all documents that can be reached over links of at
    most ``max_bits`` differing fingerprint bits, the document itself included. Null and blank texts
    have fingerprint zero and are linked like any other. A null doc_id keeps its row and never is a
    component id unless its component has no other. Repeated rows stay repeated. Extra columns are
    not looked at. No rows give no rows.
    """
    prints, owned = _owned(docs, max_bits, F.min("doc_id"))
    lowest = owned.groupBy("own").agg(F.min("low").alias("component_id"))
    labels = owned.join(lowest, "own").select("fp", "component_id")
    return prints.join(labels, "fp").select("doc_id", "text_hash", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, one document of each component: the one with the smallest doc_id.

    Documents without an id come after those with one, then the smallest text hash decides. Rows
    that agree in doc_id and text count as one document and one of them stays.
    """
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash")
    _, owned = _owned(docs, max_bits, F.min(order))
    keepers = owned.groupBy("own").agg(F.min("low").alias("low"))
    keepers = keepers.select(F.col("low.doc_id").alias("keep_id"), F.col("low.text_hash").alias("keep_hash"))
    rows = as_rows(docs, "doc_id", F.xxhash64("text").alias("text_hash"))
    kept = rows.join(
        keepers, F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_hash") == F.col("keep_hash")), "left_semi"
    )
    return kept.dropDuplicates(["doc_id", "text_hash"]).select("row.*")
