"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme values.

Training. For every hashed token, in how many toxic and in how many clean labelled texts it occurs;
its log-odds under an informative Dirichlet prior (the pooled counts, scaled down) with their
standard error. Tokens whose log-odds stay positive by ``Z`` standard errors score that lower bound;
all other tokens together form one class with a small negative score, as in a two-class log-odds
alphabet. So the expected score of clean text is negative, and scores of chance segments follow an
extreme-value law with decay one: the expected number of segments of at least score s in n clean
tokens is K n exp(-s). K is estimated from the clean texts.

Scoring. A linear scan lists every maximal-scoring segment of a text; those whose expected number is
below ``SIGNIFICANT`` are toxic passages. The text's evidence (best segment and number of significant
ones, both against K n) goes through a logistic fit to a probability. Documents are scored where
they are read; what is broadcast is one score per bucket, a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from riskspark.llm.common import as_rows, ready, text_chunks, word_bounds, word_hashes
from riskspark.sources.workdir import stage_table

BUCKETS = 1 << 20
#: Expected number of labelled rows that are learned from: a bounded sample by a hash of the id.
SAMPLE_ROWS = 20_000
PRIOR_WEIGHT = 0.05
Z = 2.5
SIGNIFICANT = 0.05
THRESHOLD = 0.7

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TOKEN_BYTES = np.zeros(256, bool)
_TOKEN_BYTES[97:123] = True
_TOKEN_BYTES[128:] = True


@dataclass(frozen=True)
class ToxicityModel:
    scores: np.ndarray  # per bucket; zero: not significant
    rest: float  # score of any other token
    chance: float  # K
    weights: np.ndarray  # logistic: intercept and one per feature


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """Buckets of all lower-cased words of letters, their byte bounds, each text's first word."""
    lowered = _LOWER[data]
    starts, ends, first = word_bounds(lowered, offsets, _TOKEN_BYTES)
    return (word_hashes(lowered, starts, ends) % np.uint64(BUCKETS)).astype(np.int64), starts, ends, first


def maximal_segments(places: list[int], scores: list[float], rest: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of a sequence that scores ``rest`` except at some places.

    ``places`` rise, ``scores`` are positive, ``rest`` is not. Returns (first, last, score) in order.
    Linear time: each candidate remembers the nearest one to its left with a smaller left sum.
    """
    found: list[tuple[int, int, float, float, int]] = []  # first, last, left sum, right sum, link
    total, at = 0.0, 0
    for place, score in zip(places, scores):
        total += rest * (place - at)
        first, left, last = place, total, place
        total += score
        at = place + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append((first, last, left, total, j))
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
    return [(first, last, right - left) for first, last, left, right, _ in found]


def _log_chance(model: ToxicityModel, tokens: int) -> float:
    return float(np.log1p(model.chance * tokens))


def _evidence(model: ToxicityModel, segments: list[tuple[int, int, float]], tokens: int):
    """Features of a text and its significant segments."""
    if not segments:
        return (0.0, 0.0, 0.0), []
    base = _log_chance(model, tokens)
    bound = np.log(max(model.chance * tokens, 1e-9) / SIGNIFICANT)
    good = [s for s in segments if s[2] >= bound]
    best = max(s[2] for s in segments)
    return (max(0.0, best - base), float(np.log1p(len(good))), float(np.log1p(sum(s[2] for s in good)))), good


def _scan(model: ToxicityModel, data: np.ndarray, offsets: np.ndarray):
    """For each text: its number of tokens, its maximal segments in tokens; and all token bounds."""
    buckets, starts, ends, first = _tokens(data, offsets)
    scores = model.scores[buckets]
    hits = np.flatnonzero(scores)
    edges = np.searchsorted(hits, first)
    where, value = hits.tolist(), scores[hits].tolist()
    found = []
    for i, (low, high) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        begin = int(first[i])
        segments = (
            maximal_segments([p - begin for p in where[low:high]], value[low:high], model.rest) if high > low else []
        )
        found.append((int(first[i + 1]) - begin, segments))
    return found, starts, ends, first


def _sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """Labelled texts; labels of about ``sample_rows`` ids at most, so that side is small enough to send.

    An id has one label, the highest that any of its rows gives: repeated ones neither multiply texts
    nor make the side larger.
    """
    usable = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = 1_000_000 * sample_rows // max(1, usable.count())
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    return docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        (F.col("toxic") > 0).cast("int").alias("toxic"), "text"
    )


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """A model of the texts that ``labels`` (doc_id, toxic) marks. Without any, it scores all the same."""
    ready(docs.sparkSession)
    texts = _sample(docs, labels, sample_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int32)
        for rows, data, offsets in text_chunks(batches):
            buckets, _, _, first = _tokens(data, offsets)
            owner = np.repeat(np.arange(len(rows)), np.diff(first))
            once = np.unique(owner * BUCKETS + buckets)
            toxic = rows.column(0).to_numpy()[once // BUCKETS]
            for label in (0, 1):
                sums[label] += np.bincount(once[toxic == label] % BUCKETS, minlength=BUCKETS).astype(np.int32)
        used = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(sums[1][used].astype(np.int64)), pa.array(sums[0][used].astype(np.int64))],
            names=["bucket", "toxic", "clean"],
        )

    counts = stage_table(
        texts.mapInArrow(count, "bucket long, toxic long, clean long")
        .groupBy("bucket")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "toxic-counts",
    )
    scores = np.zeros(BUCKETS, np.float32)
    all_toxic, all_clean = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    if not all_toxic or not all_clean:
        return ToxicityModel(scores, 0.0, 0.0, np.array([-20.0, 0, 0, 0]))
    prior = PRIOR_WEIGHT * (all_toxic + all_clean)
    toxic, clean = (F.col(c) + PRIOR_WEIGHT * (F.col("toxic") + F.col("clean")) for c in ("toxic", "clean"))
    odds = F.log(toxic / (all_toxic + prior - toxic)) - F.log(clean / (all_clean + prior - clean))
    marked = (
        counts.withColumn("score", odds - Z * F.sqrt(1 / toxic + 1 / clean)).where("score > 0").toArrow()
    )
    scores[marked["bucket"].to_numpy()] = marked["score"].to_numpy()
    share_toxic = sum(marked["toxic"].to_pylist()) / all_toxic
    share_clean = sum(marked["clean"].to_pylist()) / all_clean
    rest = float(min(0.0, np.log((1 - share_toxic + 1e-9) / (1 - share_clean + 1e-9))))
    return _calibrate(texts, ToxicityModel(scores, rest, 0.0, np.zeros(4)))


def _calibrate(texts: DataFrame, model: ToxicityModel) -> ToxicityModel:
    """K from the clean training texts, then the logistic weights; a few numbers per sampled text."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches):
            found, *_ = _scan(shared.value, data, offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([tokens for tokens, _ in found], pa.int64()),
                    pa.array([[s[2] for s in segments] for _, segments in found], pa.list_(pa.float64())),
                ],
                names=["toxic", "tokens", "scores"],
            )

    seen = texts.mapInArrow(run, "toxic int, tokens long, scores array<double>").toArrow()
    label, tokens = seen["toxic"].to_numpy().astype(float), seen["tokens"].to_numpy()
    segments = [[(0, 0, s) for s in row] for row in seen["scores"].to_pylist()]
    chance_hits = sum(s[2] >= 1 for row, y in zip(segments, label) if not y for s in row)
    chance = (chance_hits + 0.5) / max(1.0, float(tokens[label == 0].sum()) * np.exp(-1))
    model = replace(model, chance=float(chance))
    features = np.array([[1.0, *_evidence(model, row, int(n))[0]] for row, n in zip(segments, tokens)])
    return replace(model, weights=_logistic(features, label))


def _logistic(features: np.ndarray, label: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps for a logistic fit; the ridge leaves the intercept alone."""
    penalty = np.full(features.shape[1], ridge)
    penalty[0] = 1e-3
    weights = np.zeros(features.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (label - p) - penalty * weights
        bend = (features * (p * (1 - p))[:, None]).T @ features + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def score(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: doc_id) with ``score``, ``predicted`` and ``passages``.

    ``passages`` are the significant segments: start and end in code points, log-odds and expected
    number by chance. Null and empty texts have none and get the score of a text without evidence.
    One row per input row, whatever else it holds; no rows give no rows.
    """
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    keep = ["doc_id"] if keep is None else keep
    source = docs.select(*keep, F.col("text").alias("__text"))
    passage = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("log_odds", pa.float64()), ("by_chance", pa.float64())])
    schema = T.StructType(
        [
            *docs.select(*keep).schema.fields,
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
            T.StructField("passages", T._parse_datatype_string("array<struct<start: long, end: long, log_odds: double, by_chance: double>>")),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for rows, data, offsets in text_chunks(batches, "__text"):
            found, starts, ends, first = _scan(known, data, offsets)
            chars = None
            features, passages = np.zeros((len(rows), 4)), []
            features[:, 0] = 1
            for i, (tokens, segments) in enumerate(found):
                features[i, 1:], good = _evidence(known, segments, tokens)
                if good and chars is None:
                    chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))
                passages.append(
                    [
                        {
                            "start": int(chars[starts[first[i] + a]] - chars[offsets[i]]),
                            "end": int(chars[ends[first[i] + b]] - chars[offsets[i]]),
                            "log_odds": s,
                            "by_chance": float(known.chance * tokens * np.exp(-s)),
                        }
                        for a, b, s in good
                    ]
                )
            value = 1 / (1 + np.exp(-np.clip(features @ known.weights, -30, 30)))
            columns = [rows.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32)), pa.array(passages, pa.list_(passage))],
                names=[*keep, "score", "predicted", "passages"],
            )

    return source.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    return score(as_rows(docs, "text"), model, ["row"]).where("predicted = 0").select("row.*")
