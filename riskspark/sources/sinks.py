"""Table writers (K1-K9). Each returns the number of rows written, counted in the same pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.readwriter import DataFrameWriter

from riskspark.sources.tables import DateLike, as_date
from riskspark.sources.workdir import scratch_path

#: CSV with every value as it is: quotes doubled, blanks at the ends kept.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


#: Tables of long texts are about a third smaller than in the default codec.
CODEC = "zstd"


def write_counted(df: DataFrame, write: Callable[[DataFrameWriter], None]) -> int:
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")).write)
    return seen.get["rows"]


def by_partition(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of one partition brought together into files of a sensible size.

    Without it every task leaves a small file in every partition. Adaptive execution splits a
    partition that holds a large share of the rows and merges small ones.
    """
    return df.hint("rebalance", *[F.col(name) for name in by]) if by else df


def overwrite_partitions(
    df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", reset: bool = False, together: bool = False
) -> int:
    """Replace the partitions present in ``df`` and keep the others; ``reset`` drops them all.

    The overwrite mode is set on the write, so the session setting does not matter. ``together``
    says that the rows of a partition are in few tasks already.
    """
    mode = "static" if reset else "dynamic"
    return write_counted(
        df if together else by_partition(df, by),
        lambda w: (w.option("compression", CODEC) if fmt == "parquet" else w).format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*by)
        .save(path),
    )


def write_snapshot(
    df: DataFrame, path: str, date: DateLike, by: Sequence[str] = (), single_file: bool = False
) -> int:
    """Replace one snapshot as a whole.

    The snapshot is the outer folder, so a re-run that no longer has some inner partition (or any
    row) leaves nothing stale behind. ``single_file`` is for results of a few rows.
    """
    body = df.drop("snapshot_date")
    body = body.coalesce(1) if single_file else by_partition(body, by)
    return write_counted(
        body,
        lambda w: w.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", CODEC)
        .partitionBy(*by)
        .parquet(f"{path}/snapshot_date={str(date)[:10]}"),
    )


def write_by_strategy(df: DataFrame, path: str, date: DateLike) -> int:
    """One table for all strategies, partitioned by strategy and snapshot."""
    dated = df.withColumn("snapshot_date", as_date(date))
    return overwrite_partitions(dated, path, ["strategy", "snapshot_date"])


def write_verified(df: DataFrame, path: str, by: Sequence[str], reset: bool = False) -> int:
    """Stage outside the table, read back and count, then publish.

    A failure while computing ``df`` leaves the table as it was.
    """
    spark = df.sparkSession
    staging = scratch_path(spark, "publish")
    written = overwrite_partitions(df, staging, by)
    staged = spark.read.schema(df.schema).parquet(staging)
    found = staged.count()
    if found != written:
        raise RuntimeError(f"staged {found} rows, expected {written}; {path} is unchanged")
    return overwrite_partitions(staged.select(df.columns), path, by, reset=reset)


def export_csv(df: DataFrame, path: str, columns: Sequence[str]) -> int:
    """CSV of those listed columns that exist; lists are joined by ``|``."""
    kinds = dict(df.dtypes)
    present = [
        F.array_join(name, "|").alias(name) if kinds[name].startswith("array") else F.col(name)
        for name in columns
        if name in kinds
    ]
    return write_counted(
        df.select(present),
        lambda w: w.mode("overwrite").options(**CSV_OPTIONS).csv(path),
    )
