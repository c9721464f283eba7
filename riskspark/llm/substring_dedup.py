"""Removal of passages that an earlier document has: winnowed anchors, extension both ways, repeats.

Seeds. Every window of ``length`` words picks the smallest hash among its ``anchor``-word grams, the
last of equals. Equal windows pick the same gram, so documents that share a window share an anchor.
Neighbouring windows with one anchor form a run; a run is a seed with its whole reach to both sides.

Join. Anchors that only one document has are dropped. Of the rest, a run that an earlier document
has word for word is settled: all of it is a repeat. What is left are runs whose anchor is shared
but whose surroundings differ, such as the edges of a copied passage.

Extension. Only for the first holder of each such run, the anchor is extended by every reach that
makes up ``length`` words (l to the left, the rest to the right), and each extension is matched
against all others over that anchor by its 128-bit hash. This finds how far every match goes on
either side without forming pairs of documents: a passage in n documents costs n rows, not n^2.
Overlapping matches are then merged into maximal repeats.

Every step reduces within a task first: of equal rows in a task all but the one with the smallest
document are settled on the spot, so a passage that a third of all documents share sends a few rows
for each task. Whole texts move twice, both times keyed by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.common import (
    Rolling,
    mix,
    ready,
    signed,
    sliding_rightmost_minimum,
    text_chunks,
    word_bounds,
    word_hashes,
)
from riskspark.sources.workdir import stage_table

LENGTH = 50
ANCHOR = 12

_ANCHORS = pa.schema([("anchor", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
_RUNS = pa.schema(
    [("anchor", pa.int64()), ("run", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64())]
    + [("start", pa.int32()), ("windows", pa.int32()), ("settled", pa.bool_())]
)
_WINDOWS = pa.schema(
    [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())]
    + [("w1", pa.int64()), ("w2", pa.int64()), ("settled", pa.bool_())]
)
_KEPT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64())]
    + [("removed", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("kept_text", pa.string())]
)


def _word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_bounds(data, offsets)
    return word_hashes(data, starts, ends), first


def seed_runs(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> dict[str, np.ndarray]:
    """Runs of neighbouring windows with one anchor: row, first window in the text, count, hashes."""
    ids, first = _word_ids(data, offsets)
    empty = np.zeros(0, np.int64)
    if len(ids) < length:
        return {"row": empty, "start": empty, "windows": empty, "anchor": empty, "run": empty}
    rolling = Rolling(ids)
    grams = rolling.windows(anchor)
    picked = sliding_rightmost_minimum(grams, length - anchor + 1)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(picked)]
    at = np.flatnonzero(np.arange(len(picked)) + length <= first[row + 1])
    picked = picked[at]
    begins = np.ones(len(at), bool)
    begins[1:] = (at[1:] != at[:-1] + 1) | (picked[1:] != picked[:-1])
    begins = np.flatnonzero(begins)
    windows = np.diff(np.append(begins, len(at)))
    start, place = at[begins], picked[begins]
    whole = rolling.spans(start, start + windows - 1 + length)
    shape = (windows * (2 * length) + (place - start)).astype(np.uint64)
    return {
        "row": row[start],
        "start": start - first[row[start]],
        "windows": windows,
        "anchor": signed(grams[place]),
        "run": signed(mix(whole + mix(shape))),
    }


def _has_smaller(keys: list[np.ndarray], doc_ids: np.ndarray) -> np.ndarray:
    """Whether another entry has the same keys and a smaller document."""
    order = np.lexsort([doc_ids, *keys])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    lowest = doc_ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    found = np.empty(len(order), bool)
    found[order] = lowest < doc_ids[order]
    return found


def _ids(rows: pa.RecordBatch, name: str) -> np.ndarray:
    return rows.column(rows.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id``, ``text_hash``, ``start``, ``stop``: word ranges that an earlier document has.

    Ranges may overlap; together they cover exactly the windows of ``length`` words whose word
    sequence starts somewhere in a document with a smaller doc_id.
    """
    if not 1 <= anchor <= length:
        raise ValueError("an anchor is at most as long as a window")
    ready(docs.sparkSession)
    texts = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches):
            found = seed_runs(data, offsets, length, anchor)
            owner = _ids(rows, "doc_id")[found["row"]]
            order = np.lexsort([owner, found["anchor"]])
            key, owner = found["anchor"][order], owner[order]
            cut = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else order
            last = np.append(cut[1:], len(key)) - 1 if len(key) else cut
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[cut]), pa.array(owner[cut]), pa.array(owner[last])], schema=_ANCHORS
            )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches):
            found = seed_runs(data, offsets, length, anchor)
            owner = _ids(rows, "doc_id")[found["row"]]
            settled = _has_smaller([found["anchor"], found["run"]], owner)
            # settled rows need no partner: any number instead of the anchor spreads them over all tasks
            spread_out = mix((owner * 65_537 + found["start"]).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(settled, signed(spread_out), found["anchor"])),
                    pa.array(found["run"]),
                    pa.array(owner),
                    pa.array(_ids(rows, "text_hash")[found["row"]]),
                    pa.array(found["start"].astype(np.int32)),
                    pa.array(found["windows"].astype(np.int32)),
                    pa.array(settled),
                ],
                schema=_RUNS,
            )

    def extensions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches):
            ids, first = _word_ids(data, offsets)
            needs = rows.column(rows.schema.get_field_index("needs"))
            counts = pc.list_value_length(needs).to_numpy(zero_copy_only=False)
            values = needs.flatten()
            start = pc.struct_field(values, "start").to_numpy(zero_copy_only=False)
            windows = pc.struct_field(values, "windows").to_numpy(zero_copy_only=False)
            row = np.repeat(np.repeat(np.arange(len(rows)), counts), windows)
            begin = np.repeat(start - np.append(0, np.cumsum(windows)[:-1]), windows) + np.arange(windows.sum())
            at = first[row] + begin
            w1 = signed(Rolling(ids).spans(at, at + length))
            w2 = signed(Rolling(mix(ids + np.uint64(length))).spans(at, at + length))
            owner = _ids(rows, "doc_id")[row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(owner),
                    pa.array(_ids(rows, "text_hash")[row]),
                    pa.array(begin.astype(np.int32)),
                    pa.array((begin + length).astype(np.int32)),
                    pa.array(w1),
                    pa.array(w2),
                    pa.array(_has_smaller([w1, w2], owner)),
                ],
                schema=_WINDOWS,
            )

    as_ddl = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean"}
    ddl = lambda schema: ", ".join(f"{f.name} {as_ddl[f.type]}" for f in schema)

    shared = (
        texts.select("doc_id", "text")
        .mapInArrow(spread, ddl(_ANCHORS))
        .groupBy("anchor")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low < high")
        .select("anchor")
    )
    known = shared.select("anchor", F.lit(True).alias("shared"))
    met = texts.mapInArrow(runs, ddl(_RUNS)).join(known, "anchor", "left").where("settled or shared").drop("shared")
    met = stage_table(met, "repeat-runs")
    holders = stage_table(
        met.where("not settled").groupBy("anchor", "run").agg(F.min("doc_id").alias("holder")), "repeat-holders"
    )
    held = met.where("not settled").join(holders, ["anchor", "run"])
    unlike = holders.groupBy("anchor").agg(F.count(F.lit(1)).alias("runs")).where("runs > 1").select("anchor")
    needs = (
        held.where("holder = doc_id")
        .join(unlike, "anchor", "left_semi")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", "windows")).alias("needs"))
    )
    reached = stage_table(texts.join(needs, ["doc_id", "text_hash"]).mapInArrow(extensions, ddl(_WINDOWS)), "repeat-windows")
    lowest = reached.where("not settled").groupBy("w1", "w2").agg(F.min("doc_id").alias("holder"))
    columns = ["doc_id", "text_hash", "start", "stop"]
    stop = (F.col("start") + F.col("windows") + (length - 1)).alias("stop")
    return (
        met.where("settled")
        .select("doc_id", "text_hash", "start", stop)
        .union(held.where("holder < doc_id").select("doc_id", "text_hash", "start", stop))
        .union(reached.where("settled").select(columns))
        .union(reached.where("not settled").join(lowest, ["w1", "w2"]).where("holder < doc_id").select(columns))
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """One row per document: ``n_words``, ``n_removed``, ``removed`` word ranges and ``kept_text``.

    Words are maximal runs of bytes other than the six ASCII white-space ones. A word goes if a
    window of ``length`` consecutive words over it also starts in a document with a smaller doc_id;
    windows are judged on the input. Kept words are joined by one space. Null texts have no words.
    Rows with a null doc_id keep all their words and take none from others; rows with equal doc_id
    are not earlier than one another. No rows give no rows; extra columns are not looked at.
    """
    cuts = repeats(docs, length, anchor).groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "stop")).alias("cuts")
    )
    texts = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches):
            body = data.tobytes()
            cut = rows.column(rows.schema.get_field_index("cuts"))
            counts = pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False)
            values = cut.flatten()
            start = pc.struct_field(values, "start").to_numpy(zero_copy_only=False)
            stop = pc.struct_field(values, "stop").to_numpy(zero_copy_only=False)
            edges = np.append(0, np.cumsum(counts))
            out: dict[str, list] = {name: [] for name in _KEPT.names[1:]}
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                words = body[a:b].split()
                out["n_words"].append(len(words))
                ranges = []
                if counts[i]:
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, start[edges[i] : edges[i + 1]], 1)
                    np.add.at(depth, stop[edges[i] : edges[i + 1]], -1)
                    kept = np.cumsum(depth[:-1]) == 0
                    words = list(compress(words, kept.tolist()))
                    turns = np.flatnonzero(np.diff(np.concatenate(([True], kept, [True])))).tolist()
                    ranges = [{"start": x, "stop": y} for x, y in zip(turns[::2], turns[1::2])]
                out["n_removed"].append(out["n_words"][-1] - len(words))
                out["removed"].append(ranges)
                out["kept_text"].append(b" ".join(words).decode())
            arrays = [pa.array(out[name], _KEPT.field(name).type) for name in _KEPT.names[1:]]
            yield pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index("doc_id")), *arrays], names=_KEPT.names
            )

    return texts.join(cuts, ["doc_id", "text_hash"], "left").mapInArrow(
        keep,
        "doc_id long, n_words long, n_removed long, removed array<struct<start: int, stop: int>>, kept_text string",
    )
