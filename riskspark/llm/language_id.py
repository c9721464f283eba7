"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the 1- to 3-grams of code points of labelled texts into a fixed number of buckets
per language, in numpy within a task and by a sum per (language, bucket) across tasks. The matrix of
log probabilities (buckets x languages, its size fixed by the parameters) is broadcast; scoring
looks up the buckets of a text's n-grams and adds their rows, which is the sparse product of counts
and matrix. Documents are scored where they are read: no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.common import mix, ready, text_chunks

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.05
#: Expected number of labelled rows that are learned from: a bounded sample by a hash of the id.
SAMPLE_ROWS = 20_000
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """A 32-bit number for each code point; all that are not letters share one."""
    codes = (mix(np.arange(1, 0x110001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
    return np.where(_letters(), codes, np.uint32(0x9E3779B9))


def gram_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int):
    """For each order the buckets of all n-grams and where each text's begin; and letters per text.

    N-grams do not cross texts: those that would are put into a bucket past the last one.
    """
    points = np.frombuffer(_LOWER[data].tobytes().decode().encode("utf-32-le"), np.uint32)
    before = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    starts = before[offsets]
    codes = _codes()[points]
    letters = np.append(0, np.cumsum(_letters()[points]))
    found = []
    for order in ORDERS:
        value = codes.copy()
        for i in range(1, order):
            value[:-i] = value[:-i] * np.uint32(0x85EBCA6B) ^ codes[i:] * np.uint32(0xC2B2AE35)
        value = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * order)
        bucket = (value >> np.uint32(8)).astype(np.int64) % buckets
        for i in range(1, order):
            past = starts[1:] - i
            bucket[past[past >= 0]] = buckets
        found.append(bucket)
    return found, starts, letters[starts[1:]] - letters[starts[:-1]]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_probability: np.ndarray  # buckets + 1 rows, the last one zero
    log_prior: np.ndarray


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS) -> LanguageModel:
    """A model of the rows with a text, a ``lang`` and a doc_id.

    All of them if they are at most ``sample_rows``, else about so many, chosen by a hash of the id.
    """
    ready(docs.sparkSession)
    usable = docs.where("text is not null and lang is not null and doc_id is not null")
    share = 1_000_000 * sample_rows // max(1, usable.select("doc_id").count())
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows_of: dict[str, int] = {}
        for rows, data, offsets in text_chunks(batches):
            found, starts, _ = gram_buckets(data, offsets, buckets)
            names = np.array(rows.column(0).to_pylist(), object)
            owner = np.repeat(np.arange(len(names)), np.diff(starts))
            for name in dict.fromkeys(names.tolist()):
                mine = (names == name)[owner]
                total = sums.setdefault(name, np.zeros(buckets + 1, np.int64))
                for bucket in found:
                    total += np.bincount(bucket[mine], minlength=buckets + 1)
                rows_of[name] = rows_of.get(name, 0) + int((names == name).sum())
        for name, total in sums.items():
            total[buckets] = rows_of[name]
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used)), pa.array(used), pa.array(total[used])],
                names=["lang", "bucket", "n"],
            )

    counts = (
        chosen.mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = np.array(counts["lang"].to_pylist(), object)
    languages = sorted(set(names.tolist()))
    table = np.zeros((buckets + 1, len(languages)))
    column = np.searchsorted(languages, names) if len(languages) else np.zeros(0, np.int64)
    table[counts["bucket"].to_numpy(), column] = counts["n"].to_numpy()
    texts, table = table[buckets], table[:buckets] + SMOOTHING
    log_probability = np.zeros((buckets + 1, len(languages)), np.float32)
    log_probability[:buckets] = np.log(table / table.sum(axis=0))
    return LanguageModel(languages, log_probability, np.log(texts / max(1.0, texts.sum())))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (posterior of the prediction), one row per input row.

    Texts that are null, empty or without a letter, and all texts where nothing was learned, get
    ``und`` with score 0. Equal posteriors go to the first language by name.
    """
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for rows, data, offsets in text_chunks(batches):
            found, starts, letters = gram_buckets(data, offsets, len(known.log_probability) - 1)
            sums = np.tile(known.log_prior, (len(rows), 1))
            full = np.flatnonzero(np.diff(starts))
            for bucket in found:
                if len(full) and known.languages:
                    sums[full] += np.add.reduceat(
                        known.log_probability[bucket], starts[full], axis=0, dtype=np.float64
                    )
            if known.languages:
                best = sums.argmax(axis=1)
                top = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                names = np.array(known.languages, object)[best]
            else:
                top, names = np.zeros(len(rows)), np.full(len(rows), UNKNOWN, object)
            names[letters == 0], top[letters == 0] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(names.tolist(), pa.string()), pa.array(top)],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )
