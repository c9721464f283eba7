"""Partitioned table reads and snapshot resolution."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

DateLike = str | dt.date

#: Fixed value: the folder name of the partition without a value.
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False
) -> DataFrame:
    """A table folder with its partition columns; ``merge_schema`` unites the files by name."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        read_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def among(column: str, values: Sequence) -> Column:
    """Whether a partition is one of the listed ones; the default partition is None. Prunes the scan."""
    known = F.col(column).isin([v for v in values if v is not None])
    return F.coalesce(known, F.lit(False)) | (F.col(column).isNull() if None in values else F.lit(False))


def as_date(value: DateLike):
    return F.lit(str(value)[:10]).cast("date")


def at_snapshot(df: DataFrame, date: DateLike, column: str = "snapshot_date") -> DataFrame:
    """Rows of one snapshot. A typed equality on the bare column, so partitions are pruned."""
    return df.where(F.col(column) == as_date(date))


def read_snapshot(
    spark: SparkSession, path: str, date: DateLike, merge_schema: bool = False
) -> DataFrame:
    """One snapshot of a table that has the snapshot as its outer folder.

    Only that folder is listed, and only its files are asked for their schema, however many
    snapshots the table holds. A snapshot that is not there has no rows.
    """
    folder = f"{path}/snapshot_date={str(date)[:10]}"
    if not table_exists(spark, folder):
        return at_snapshot(read_table(spark, path), date)
    reader = spark.read.option("basePath", path).option("mergeSchema", merge_schema)
    return reader.parquet(folder)


#: Number types from narrow to wide; a column takes the widest that one of its snapshots has.
_WIDTHS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _wider(name: str, one: str, other: str) -> str:
    if one == other:
        return one
    if one in _WIDTHS and other in _WIDTHS:
        wider = max(one, other, key=_WIDTHS.index)
        # a float does not hold all integers of 32 or 64 bits
        return "double" if wider == "float" and {one, other} & {"int", "bigint"} else wider
    raise ValueError(f"column {name} is {one} in one snapshot and {other} in another")


def read_merged_snapshots(spark: SparkSession, path: str, column: str = "snapshot_date") -> DataFrame:
    """All snapshots of a table whose columns were added, dropped or widened over time.

    Columns are united by name and are null where a snapshot lacks them; numbers take the widest type
    that occurs, and a change between other types is an error. Snapshots of one schema are one scan,
    so the plan grows with the number of schemas and not with that of snapshots.
    """
    dates = [row[0] for row in read_table(spark, path).select(column).distinct().orderBy(column).collect()]
    folders: dict[StructType, list[str]] = {}
    for date in dates:
        folder = f"{path}/{column}={date if date is not None else DEFAULT_PARTITION}"
        folders.setdefault(spark.read.parquet(folder).schema, []).append(folder)
    kinds: dict[str, str] = {}
    for schema in folders:
        for field in schema:
            kind = field.dataType.simpleString()
            kinds[field.name] = _wider(field.name, kinds.get(field.name, kind), kind)
    parts = []
    for schema, places in folders.items():
        rows = spark.read.option("basePath", path).schema(schema).parquet(*places)
        parts.append(
            rows.select(
                *[
                    (F.col(f"`{name}`") if name in schema.fieldNames() else F.lit(None)).cast(kind).alias(name)
                    for name, kind in kinds.items()
                ],
                F.col(column).cast("date").alias(column),
            )
        )
    if not parts:
        return read_table(spark, path)
    return reduce(DataFrame.union, parts)


def available_snapshots(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Every snapshot, newest first. Reads no data column, only the partition values."""
    return df.select(column).distinct().orderBy(F.desc(column))


def latest_snapshot(df: DataFrame, column: str = "snapshot_date") -> dt.date | None:
    return df.agg(F.max(column)).first()[0]


def resolve_snapshot(
    df: DataFrame, requested: DateLike | None = None, column: str = "snapshot_date"
) -> dt.date | None:
    """The requested snapshot if it holds rows, else the latest, else ``None``.

    The usual request exists and costs a look into one partition only.
    """
    if requested is not None and not at_snapshot(df, requested, column).isEmpty():
        return dt.date.fromisoformat(str(requested)[:10])
    return latest_snapshot(df, column)


def find_snapshot(
    spark: SparkSession, path: str, requested: DateLike | None = None
) -> dt.date | None:
    """As ``resolve_snapshot``, for a table folder; looks at the others only if it has to."""
    if requested is not None and not read_snapshot(spark, path, requested).isEmpty():
        return dt.date.fromisoformat(str(requested)[:10])
    return latest_snapshot(read_table(spark, path))


def job_snapshot(df: DataFrame, requested: DateLike, column: str = "snapshot_date") -> dt.date:
    """As ``resolve_snapshot``, but an empty table keeps the requested date."""
    return resolve_snapshot(df, requested, column) or dt.date.fromisoformat(str(requested)[:10])


def snapshot_as_of(
    df: DataFrame,
    date: DateLike,
    column: str = "score_date",
    lookback_days: int | None = None,
    required: bool = False,
) -> DataFrame:
    """The whole latest partition dated ``date`` or earlier, never a later one.

    One plan: the latest date is a scalar subquery, so on a table partitioned by ``column`` only
    that partition is read. ``lookback_days`` bounds the search (and the partitions looked at);
    ``required`` turns "nothing found" from an empty result into an error.
    """
    eligible = F.col(column) <= as_date(date)
    if lookback_days is not None:
        eligible &= F.col(column) >= F.date_sub(as_date(date), lookback_days)
    latest = df.where(eligible).agg(F.max(column).alias(column))
    if required:
        message = F.lit(f"no {column} within {lookback_days} days before {date}")
        latest = latest.select(F.coalesce(column, F.raise_error(message).cast("date")).alias(column))
    return df.where(eligible & (F.col(column) == latest.scalar()))
