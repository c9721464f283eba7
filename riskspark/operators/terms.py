"""Terms and categories as long tables: counts, weights and the best terms of a group.

A row is a term of a record. No vocabulary is held by the driver or broadcast as a whole, and no
record has an array of vocabulary length: tables grow with what occurs in the records.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskspark.operators.ranking import ranked_values, top_k, top_k_per_group
from riskspark.sources.workdir import stage_table

KEY = "cve_id"
#: A term that at least one record in so many has is a common one.
COMMON = 1000


def _counts_by_row(worded: DataFrame, words: str) -> DataFrame:
    """``cve_id``, ``term``, ``n``: how often each row has each of its words; the words do not leave their task."""
    rows = worded.select(KEY, words)
    term = rows.schema[words].dataType.elementType
    schema = T.StructType([rows.schema[KEY], T.StructField("term", term), T.StructField("n", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                keys, lists = (column.slice(low, 256) for column in batch.columns)
                found = pc.list_flatten(lists).dictionary_encode(null_encoding="encode")
                size = max(1, len(found.dictionary))
                places = pc.list_parent_indices(lists).to_numpy().astype(np.int64) * size + found.indices.to_numpy()
                places, n = np.unique(places, return_counts=True)
                columns = [keys.take(pa.array(places // size)), found.dictionary.take(pa.array(places % size)), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def row_counts(worded: DataFrame, words: str = "words") -> DataFrame:
    """``cve_id``, ``term``, ``n`` of every row by itself, as a table."""
    return stage_table(_counts_by_row(worded, words), "term-counts")


def _keys(worded: DataFrame) -> DataFrame:
    """``cve_id``, ``rows``: how many rows each key has; no other column of the records is read."""
    return stage_table(worded.groupBy(KEY).agg(F.count(F.lit(1)).alias("rows")), "term-keys")


def _merged(counts: DataFrame, keys: DataFrame) -> DataFrame:
    """Counts by row added up for the keys of several rows; all others are whole as they are."""
    several = keys.where("rows > 1").select(F.col(KEY).alias("_several"))
    if several.isEmpty():
        return counts
    shared = F.col(KEY).eqNullSafe(F.col("_several"))
    added = counts.join(several, shared, "left_semi").groupBy(KEY, "term").agg(F.sum("n").alias("n"))
    return counts.join(several, shared, "left_anti").union(added)


def term_counts(worded: DataFrame, words: str = "words") -> DataFrame:
    """``cve_id``, ``term``, ``n``: how often each record has each of its words. ``worded`` is read twice."""
    return _merged(_counts_by_row(worded, words), _keys(worded))


def _known(counts: DataFrame, min_documents: int, size: int | None) -> DataFrame:
    """``term``, ``n_with``, ``total`` of the terms that ``inverse_frequencies`` gives, most frequent first if cut."""
    known = counts.groupBy("term").agg(F.count(F.lit(1)).alias("n_with"), F.sum("n").alias("total"))
    known = known.where(F.col("n_with") >= min_documents)
    return known if size is None else top_k(known, ["-total", "term"], size)


def vocabulary(counts: DataFrame, min_documents: int, size: int) -> list[str]:
    """The ``size`` most frequent terms that enough rows of ``counts`` have, ties by the term; ``size`` is a setting."""
    return [row["term"] for row in _known(counts, min_documents, size).collect()]


def inverse_frequencies(
    counts: DataFrame, n_records: Column, min_documents: int = 1, size: int | None = None
) -> DataFrame:
    """``term``, ``idf`` of the terms that enough records have, of these the ``size`` most frequent if asked for.

    ``idf`` is the logarithm of (records + 1) / (records with the term + 1).
    """
    known = _known(counts, min_documents, size)
    return known.select("term", F.log((n_records + F.lit(1.0)) / (F.col("n_with") + F.lit(1.0))).alias("idf"))


def term_weights(
    worded: DataFrame,
    min_documents: int = 1,
    size: int | None = None,
    words: str = "words",
    by_row: DataFrame | None = None,
) -> DataFrame:
    """``cve_id``, ``term``, ``n``, ``idf``, ``weight`` = n x idf for every known term of every record.

    Records without words count among the records, and have no rows. ``worded`` is read twice, once
    for its keys alone; ``by_row`` is its ``row_counts`` where they are there already.
    """
    keys = _keys(worded)
    counts = _merged(row_counts(worded, words) if by_row is None else by_row, keys)
    idf = inverse_frequencies(counts, keys.agg(F.sum("rows")).scalar(), min_documents, size)
    weighed = _with_idf(counts, stage_table(idf, "term-idf"))
    return weighed.select(KEY, "term", "n", "idf", (F.col("n") * F.col("idf")).alias("weight"))


def _with_idf(counts: DataFrame, idf: DataFrame) -> DataFrame:
    """``counts`` of the terms in ``idf``, which has one row per term, with their ``idf``.

    Most rows have a term that many records have. Terms of at least one in ``COMMON`` records are
    fewer than ``COMMON`` times the mean number of terms of a record, however many records there are,
    so they are broadcast; only rows of other terms are shuffled.
    """
    is_common = F.col("idf") <= F.lit(math.log(COMMON))
    common = F.broadcast(idf.where(is_common))
    rest = counts.join(F.broadcast(idf.where(is_common).select("term")), "term", "left_anti")
    return counts.join(common, "term").unionByName(rest.join(idf.where(~is_common), "term"))


def category_rows(
    records: DataFrame, column: str, min_documents: int = 1, size: int | None = None
) -> DataFrame:
    """``cve_id``, ``value``: the different members of a list column, of those that enough records have."""
    rows = records.select(KEY, F.explode(F.array_distinct(column)).alias("value")).where(F.col("value").isNotNull())
    if min_documents <= 1 and size is None:
        return rows
    often = rows.groupBy("value").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") >= min_documents)
    if size is not None:
        often = top_k(often, ["-total", "value"], size)
    return rows.join(stage_table(often.select("value"), "category-values"), "value", "left_semi")


def top_terms(weights: DataFrame, assigned: DataFrame, n: int, out: str = "top_keywords") -> DataFrame:
    """The terms of largest mean weight of each group in ``assigned`` (``cve_id``, ``cluster_id``), best first.

    All means of a group have one divisor, so sums rank alike; counts are summed and weighed once,
    which leaves no room for the order of addition. Ties go by the term.
    """
    # a record has one row there and many here, so only its group is hashed and nothing is sorted
    sums = weights.join(assigned.select(KEY, "cluster_id").hint("shuffle_hash"), KEY).groupBy("cluster_id", "term").agg(
        (F.sum("n") * F.max("idf")).alias("total")
    )
    best = top_k_per_group(sums, ["cluster_id"], ["-total", "term"], n, "_rank")
    return ranked_values(best, ["cluster_id"], "term", "_rank", out)
