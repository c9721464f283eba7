"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskspark.operators.ranking import row_numbers


def latest_per_key(
    df: DataFrame,
    key: str = "cve_id",
    newest: str = "last_modified",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Newest row of every non-null key, undated rows last.

    ``ties`` names the columns that decide between equally new rows, in that order; by default all
    other columns that have an order do, so the result does not depend on the order of arrival. The
    ``<= 1`` bound is applied on the map side: a key with very many copies sends one row per map
    task to its reducer.
    """
    if ties is None:
        ties = [name for name, kind in df.dtypes if name not in (key, newest) and "map<" not in kind]
    first = row_numbers([key], [f"-{newest}", *ties])
    keyed = df.where(F.col(key).isNotNull())
    return keyed.withColumn("_nth", first).where(F.col("_nth") <= 1).drop("_nth")
