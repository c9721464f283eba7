"""Near copies by SimHash signatures and by the Jaccard similarity of word shingles.

Two texts are linked if the SimHash fingerprints of their shingles (five words) differ in at most
three bits, found by the deletion-variant signatures of ``simhash``, or if the sets of their
shingles have at least ``similarity`` of their union in common. Components of the first kind of
links are there before the second kind is looked for, so that only texts of different ones meet.

For the second kind, texts of equal sets collapse to one node first. Each node has ``BANDS`` keys
made of ``ROWS`` minwise hashes each; two sets of similarity s agree in some key with probability
1 - (1 - s ** ROWS) ** BANDS, which at 0.8 is 0.99997. Every link is verified on the whole sets.

No group is expanded into all its pairs. In each key group all members are compared with one hub,
the node that most documents have; the links found are contracted to components. Key groups that
still hold several components get ``DRAWN`` more hubs at a time, drawn by hash, each for the members
outside its component, until a round finds no further link. Key groups of one component are done with.
In those that hold several even then, all members left that are in different components are compared,
a pair of blocks at a time: the pairs are looked at in a task and only links become rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskspark.llm import simhash
from riskspark.llm.common import Rolling, as_rows, mix, ready, signed, text_chunks, word_bounds, word_hashes
from riskspark.llm.components import connected_components
from riskspark.llm.native import bitmap, in_bitmap
from riskspark.sources.workdir import discard, stage_table

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 4
#: Hubs of a key in each round but the first: members are read and joined once for all of them.
DRAWN = 3
#: Shingles of a block, about 8 MB: a task holds two blocks of a key, and a member goes to as many tasks as its key has blocks.
BLOCK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEPS = np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)
#: Odd factors and summands of the minwise hashes; the shingle hashes are mixed already.
_FACTORS, _SUMMANDS = mix(_STEPS) | np.uint64(1), mix(_STEPS << np.uint64(32))


def _shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words (of all words of a shorter text), and where each text begins."""
    lowered = _LOWER[data]
    starts, ends, first = word_bounds(lowered, offsets)
    words = np.diff(first)
    counts = np.where(words > 0, np.maximum(words - size + 1, 1), 0)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    low = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], counts)
    high = np.minimum(low + size, np.repeat(first[1:], counts))
    return Rolling(word_hashes(lowered, starts, ends)).spans(low, high), bounds


def _keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of ``BANDS`` keys for each text that has shingles."""
    first = bounds[:-1][np.diff(bounds) > 0]
    keys = np.empty((len(first), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(first), mix(np.array([band + 1], np.uint64))[0], np.uint64)
        for i in range(band * ROWS, (band + 1) * ROWS):
            key = mix(key ^ np.minimum.reduceat(hashes * _FACTORS[i] + _SUMMANDS[i], first))
        keys[:, band] = key
    return keys


def _sets(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    return [np.unique(hashes[a:b]).tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _with_nodes(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``node`` (hash of the shingle set), ``fp`` (SimHash), ``n_shingles``, ``keys``.

    No shingles give no keys.
    """
    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").alias("__text"))
    schema = T.StructType(
        [
            *source.schema.fields[:2],
            T.StructField("node", T.LongType()),
            T.StructField("fp", T.LongType()),
            T.StructField("n_shingles", T.IntegerType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches, "__text"):
            hashes, bounds = _shingles(data, offsets, size)
            sets = _sets(hashes, bounds)
            nodes = np.array([xxhash.xxh64_intdigest(s) for s in sets], np.uint64)
            prints = simhash.fingerprints_of([hashes[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())])
            sizes = pa.array([len(s) // hashes.itemsize for s in sets], pa.int32())
            ends = np.concatenate(([0], np.cumsum((np.diff(bounds) > 0) * BANDS))).astype(np.int32)
            keys = _keys(hashes, bounds).reshape(-1) if len(hashes) else np.zeros(0, np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(keys)))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(signed(nodes)), pa.array(signed(prints)), sizes, lists],
                names=schema.names,
            )

    return source.mapInArrow(run, schema)


def _sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node`` and ``shingles`` (sorted 64-bit hashes) of the nodes in ``wanted`` (``node``, ``text_hash``).

    A bitmap takes out most other texts a row at a time, so no text is shuffled.
    """
    bits = min(22, max(16, (64 * wanted.count()).bit_length()))
    texts = docs.select(F.xxhash64("text").alias("text_hash"), F.col("text").alias("__text"))
    texts = texts.withColumn("bits_set", bitmap(wanted, "text_hash", bits))
    texts = texts.where(in_bitmap(F.col("bits_set"), F.col("text_hash"), bits)).select("__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, data, offsets in text_chunks(batches, "__text"):
            fresh = {}
            for one in _sets(*_shingles(data, offsets, size)):
                node = xxhash.xxh64_intdigest(one)
                if node not in seen:
                    seen.add(node)
                    fresh[node] = one
            nodes = pa.array(signed(np.array(list(fresh), np.uint64)))
            yield pa.RecordBatch.from_arrays([nodes, pa.array(list(fresh.values()), pa.binary())], names=["node", "shingles"])

    found = texts.mapInArrow(run, "node long, shingles binary")
    found = found.join(wanted.select("node"), "node", "left_semi")
    return stage_table(found.groupBy("node").agg(F.first("shingles").alias("shingles")), "copies-sets")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a``, ``b`` whose whole sets are as similar as asked."""
    of = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"of_{name}"))
    both = pairs.hint("merge").join(of("a"), "a").hint("merge").join(of("b"), "b").select("a", "b", "of_a", "of_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                smaller, larger = sorted((len(x), len(y)))
                shared = 0
                if smaller >= similarity * larger - 1:
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared / (len(x) + len(y) - shared) >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stage_table(both.mapInArrow(run, "a long, b long"), "copies-links")


#: What a row of a key holds of its node, and of each hub of the key.
_MEMBER = ("node", "own", "n_shingles", "text_hash")


def _hubs(members: DataFrame, turn: int) -> DataFrame:
    """``key`` and what is known of its ``hubs``, of the keys that still hold two components.

    The first hub is the node that most documents have, later ones are drawn by hash.
    """
    draws = [-F.col("n_docs")] if turn == 0 else [F.xxhash64("key", "node", F.lit(turn), F.lit(i)) for i in range(DRAWN)]
    return (
        members.groupBy("key")
        .agg(
            F.min("own").alias("low"),
            F.max("own").alias("high"),
            F.array(*[F.min(F.struct(draw.alias("draw"), *_MEMBER)) for draw in draws]).alias("drawn"),
        )
        .where("low < high")
        .select("key", F.array_distinct(F.transform("drawn", lambda hub: hub.dropFields("draw"))).alias("hubs"))
    )


def _meeting(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """The members of open keys, each beside the hubs of its key: what a round works on, written once."""
    # the planner's estimate does not know that each row became many: it must not take them for small
    return stage_table(members.select("key", *_MEMBER).hint("merge").join(hubs, "key"), "copies-meeting")


def _not_hubs(meeting: DataFrame) -> DataFrame:
    """The members that have not been a hub of their key: a hub has met all of it."""
    return meeting.where(~F.array_contains("hubs.node", F.col("node"))).select("key", *_MEMBER)


def _met(meeting: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``a``, ``b`` of a node and a hub of one of its keys, the components ``c``, ``d`` they are in, and their text hashes.

    Sets of too different sizes cannot be as similar as asked and make no pair.
    """

    def may_link(hub: Column) -> Column:
        smaller, larger = F.least("n_shingles", hub["n_shingles"]), F.greatest("n_shingles", hub["n_shingles"])
        return (F.col("own") != hub["own"]) & (smaller >= F.lit(similarity) * larger - 1)

    met = meeting.select(*_MEMBER, F.explode(F.filter("hubs", may_link)).alias("hub"))
    own, hub = F.struct("node", "text_hash"), F.struct("hub.node", "hub.text_hash")
    return (
        met.select(
            F.least(own, hub).alias("low"),
            F.greatest(own, hub).alias("high"),
            F.least("own", "hub.own").alias("c"),
            F.greatest("own", "hub.own").alias("d"),
        )
        .select(
            F.col("low.node").alias("a"), F.col("high.node").alias("b"), "c", "d",
            F.col("low.text_hash").alias("a_text"), F.col("high.text_hash").alias("b_text"),
        )
        .distinct()
    )


def _ends(pairs: DataFrame) -> DataFrame:
    """``node``, ``text_hash`` of the nodes in pairs."""
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.col("a_text").alias("text_hash")),
        F.struct(F.col("b").alias("node"), F.col("b_text").alias("text_hash")),
    )
    return pairs.select(F.explode(ends).alias("end")).select("end.*").distinct()


def _signature_links(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that join the nodes of each component of fingerprints: each with the smallest one."""
    distinct = stage_table(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n_docs")), "copies-prints")
    groups = simhash.fingerprint_components(distinct).withColumnRenamed("node", "fp")
    owned = prints.select("node", "fp").distinct().join(groups, "fp", "left")
    owned = stage_table(owned.select("node", F.coalesce("component", "fp").alias("own")), "copies-signed")
    lowest = owned.groupBy("own").agg(F.min("node").alias("b"))
    links = owned.join(lowest, "own").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    links = stage_table(links, "copies-links")
    discard(distinct, owned)
    return links


def _renamed(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """The rows with the component that their ``own`` has become a part of, by ``owners`` (``own``, ``component``)."""
    return rows.join(owners, "own", "left").withColumn("own", F.coalesce("component", "own")).drop("component")


def _links_within(table: pa.Table, similarity: float) -> pa.Table:
    """Links ``c``, ``d`` between the components of a key's members in one block or in two, their sets compared exactly.

    Members come in rising size, so that those of fitting size lie side by side: one pass over their
    hashes counts what each shares with a member. Components are joined as they are found.
    """
    table = table.sort_by([("second", "ascending"), ("n_shingles", "ascending")])
    own, sizes = table["own"].to_numpy(), table["n_shingles"].to_numpy().astype(np.int64)
    hashes = np.frombuffer(b"".join(table["shingles"].to_pylist()), np.uint64)
    values, codes = np.unique(hashes, return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    first = int(np.count_nonzero(~table["second"].to_numpy(zero_copy_only=False)))
    begin = first if first < len(own) else 0
    marked, comp, links = np.zeros(len(values), bool), own.copy(), []
    for i in range(first):
        low, high = np.searchsorted(sizes[begin:], [similarity * sizes[i] - 1, (sizes[i] + 1) / similarity + 1]) + begin
        low = low if begin else i + 1
        others = comp[low:high]
        if (others == comp[i]).all():
            continue
        mine = codes[starts[i] : starts[i + 1]]
        marked[mine] = True
        shared = np.add.reduceat(marked[codes[starts[low] : starts[high]]], starts[low:high] - starts[low], dtype=np.int64)
        marked[mine] = False
        near = shared / (sizes[i] + sizes[low:high] - shared) >= similarity
        found = np.setdiff1d(others[near], comp[i : i + 1])
        links += [(comp[i], other) for other in found.tolist()]
        comp[np.isin(comp, found)] = comp[i]
    c, d = np.array(links, np.int64).reshape(-1, 2).T
    return pa.table({"c": pa.array(c), "d": pa.array(d)})


def _links_left(docs: DataFrame, members: DataFrame, size: int, similarity: float) -> DataFrame:
    """Links ``c``, ``d`` between the components of all members that share an open key, whatever their number."""
    blocks = F.ceil(F.sum("n_shingles") / F.lit(BLOCK)).cast("int")
    open_keys = members.groupBy("key").agg(F.min("own").alias("low"), F.max("own").alias("high"), blocks.alias("blocks"))
    open_keys = open_keys.where("low < high").select("key", "blocks")
    left = stage_table(members.hint("merge").join(open_keys, "key"), "copies-left")
    wanted = stage_table(left.select("node", "text_hash").distinct(), "copies-ends")
    sets = _sets_of(docs, wanted, size)
    # each block meets itself and every other one of its key
    placed = left.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        (F.col("block") > F.col("other")).alias("second"), "node", "own", "n_shingles",
    )
    # the planner's estimate does not know that each row became many: it must not take them for small
    both = placed.hint("merge").join(sets, "node").drop("node")

    def run(table: pa.Table) -> pa.Table:
        return _links_within(table, similarity)

    links = stage_table(both.groupBy("key", "low", "high").applyInArrow(run, "c long, d long").distinct(), "copies-links")
    discard(left, wanted, sets)
    return links


def _node_components(docs: DataFrame, nodes: DataFrame, known: DataFrame, size: int, similarity: float) -> DataFrame:
    """``node``, ``component`` of all nodes, over ``node`` (unique), ``n_docs``, ``n_shingles``, ``text_hash``, ``keys``.

    ``known`` are links ``a``, ``b`` found before; members of one component need not meet.

    Keys become rows once: to find the hubs of all keys, and then only those of keys that hold two
    components. The next round works on the rows that this one has written, and sets are made only
    of the nodes that a round compares. Hubs have met all of their key and leave it, a key of one
    component is closed for good, so rounds shrink. Tables of a round go when the next one has
    written what it takes over. What is open after the last round is compared whole.
    """
    owners = connected_components(known, "a", "b").withColumnRenamed("node", "own")
    # each node begins as a component of its own
    active = stage_table(_renamed(nodes.withColumn("own", F.col("node")), owners), "copies-active")
    owned = stage_table(active.select("node", "own"), "copies-owned")
    keyed = ("own", "node", "n_docs", "n_shingles", "text_hash")
    hubs = stage_table(_hubs(active.select(*keyed, F.explode("keys").alias("key")), 0), "copies-hubs")
    bits = min(22, max(16, (16 * hubs.count()).bit_length()))
    # the bitmap lets all open keys through and few others
    of_open = active.withColumn("bits_set", bitmap(hubs, "key", bits))
    of_open = of_open.withColumn("keys", F.filter("keys", lambda key: in_bitmap(F.col("bits_set"), key, bits)))
    meeting = _meeting(of_open.select(*_MEMBER, F.explode("keys").alias("key")), hubs)
    discard(active, hubs)
    tried, turn = None, 0
    while True:
        met = _met(meeting, similarity)
        pairs = stage_table(met if tried is None else met.join(tried, ["a", "b"], "left_anti"), "copies-pairs")
        wanted = stage_table(_ends(pairs), "copies-ends")
        sets = _sets_of(docs, wanted, size)
        fresh = _verified(pairs.select("a", "b"), sets, similarity)
        discard(wanted, sets)
        if fresh.isEmpty():
            break
        tried = pairs.select("a", "b") if tried is None else tried.union(pairs.select("a", "b"))
        joined = connected_components(pairs.join(fresh, ["a", "b"], "left_semi").select("c", "d"), "c", "d")
        owners = stage_table(joined.withColumnRenamed("node", "own"), "copies-owners")
        turn += 1
        before = (owned, meeting, owners, fresh)
        owned = stage_table(_renamed(owned, owners), "copies-owned")
        members = _renamed(_not_hubs(meeting), owners)
        meeting = _meeting(members, _hubs(members, turn))
        discard(*before)
    links = _links_left(docs, _not_hubs(meeting), size, similarity)
    owners = stage_table(connected_components(links, "c", "d").withColumnRenamed("node", "own"), "copies-owners")
    whole = stage_table(_renamed(owned, owners), "copies-owned")
    discard(owned, meeting, pairs, fresh, links, owners)
    return whole.withColumnRenamed("own", "component")


def drop_near_copies(docs: DataFrame, size: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, one document of each group: the one with the smallest doc_id.

    A group is all that can be reached over links. Words are runs between white space, ASCII letters
    lower-cased; a text of fewer than ``size`` words is one shingle; null and blank texts are copies
    of each other. Documents without an id come after those with one, then the smallest text hash
    decides. Rows that agree in doc_id and text count as one document and one of them stays.
    """
    if not 0 < similarity <= 1:
        raise ValueError("similarity is a share above zero")
    ready(docs.sparkSession)
    prints = stage_table(_with_nodes(docs, size), "copies")
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash")
    nodes = stage_table(
        prints.groupBy("node").agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.min(order).alias("low"),
            F.min("text_hash").alias("text_hash"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("keys").alias("keys"),
        ),
        "copies-nodes",
    )
    known = _signature_links(prints)
    discard(prints)
    groups = _node_components(docs, nodes.drop("low"), known, size, similarity)
    keepers = nodes.select("node", "low").join(groups, "node").groupBy("component").agg(F.min("low").alias("low"))
    keepers = stage_table(
        keepers.select(F.col("low.doc_id").alias("keep_id"), F.col("low.text_hash").alias("keep_hash")), "copies-keepers"
    )
    discard(nodes)
    rows = as_rows(docs, "doc_id", F.xxhash64("text").alias("text_hash"))
    kept = rows.join(
        keepers, F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_hash") == F.col("keep_hash")), "left_semi"
    )
    return kept.dropDuplicates(["doc_id", "text_hash"]).select("row.*")
