"""Replace-by-key upsert into a partitioned Parquet table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from riskspark import constants as K
from riskspark.functions.bitmaps import bitmap, in_bitmap
from riskspark.operators.dedupe import latest_per_key
from riskspark.operators.key_index import candidate_partitions, write_key_index
from riskspark.operators.silver import within_window
from riskspark.sources.sinks import by_partition, overwrite_partitions, write_snapshot
from riskspark.sources.tables import DEFAULT_PARTITION, DateLike, among, read_table, table_exists
from riskspark.sources.workdir import stage_table


#: An upsert leaves rows in their files until there are so many times more than of this size; then it gathers them.
FILES, FILE_BYTES = 8, 32 << 20


@dataclass(frozen=True)
class UpsertStats:
    modified_rows: int = 0
    affected_years: int = 0
    written_rows: int = 0


def stage_changes(
    changes: DataFrame, path: str | None, date: DateLike | None, **dedupe
) -> DataFrame:
    """The change set with one row per key, kept on disk.

    With a ``path`` it stays there as the snapshot's lineage record, else in the work folder. In
    both cases later steps read the table and not the raw feed behind it.
    """
    latest = latest_per_key(changes, **dedupe)
    if path is None:
        return stage_table(latest, "changes")
    write_snapshot(latest, path, date)
    reader = changes.sparkSession.read.schema(latest.schema)
    return reader.parquet(f"{path}/snapshot_date={str(date)[:10]}")


def affected_partitions(
    base: DataFrame | None,
    changes: DataFrame,
    incoming: DataFrame,
    key: str,
    partition: str,
    may_hold: list | None = None,
) -> DataFrame:
    """Row counts of every partition that the change set touches.

    A partition is touched when a changed record arrives there, or when the table now holds a
    changed key there. ``rows_after`` is what it will hold: rows now, less those replaced, plus
    those arriving. One row per partition. Of the base only keys and partitions are read to find
    the touched ones, those of the partitions in ``may_hold`` if it is given, and only touched
    partitions are counted.
    """
    arriving = incoming.groupBy(partition).agg(F.count(F.lit(1)).alias("arriving"))
    if base is None:
        return arriving.selectExpr(partition, "arriving AS rows_after", "false AS exists_now")
    leaving = (
        (base if may_hold is None else base.where(among(partition, may_hold)))
        .select(key, partition)
        .join(changes.select(key), key, "left_semi")
        .groupBy(partition)
        .agg(F.count(F.lit(1)).alias("replaced"))
    )
    touched = stage_table(
        leaving.select(partition, "replaced", F.lit(0).cast("long").alias("arriving"))
        .union(arriving.select(partition, F.lit(0).cast("long"), "arriving"))
        .groupBy(partition)
        .agg(F.sum("replaced").alias("replaced"), F.sum("arriving").alias("arriving")),
        "touched",
    )
    # one row per touched partition, so bounded by the table's partition count
    values = [row[partition] for row in touched.select(partition).collect()]
    now = base.where(among(partition, values)).groupBy(F.col(partition).alias("_held")).agg(
        F.count(F.lit(1)).alias("now")
    )
    return touched.join(now, F.col(partition).eqNullSafe(F.col("_held")), "left").select(
        partition,
        (F.coalesce("now", F.lit(0)) - F.col("replaced") + F.col("arriving")).alias("rows_after"),
        F.col("now").isNotNull().alias("exists_now"),
    )


def _told_apart(base: DataFrame, changes: DataFrame, key: str) -> tuple[DataFrame | None, DataFrame]:
    """Rows of the base that a bitmap of the changed keys tells to be without a change, and the others.

    The others, about as many as there are changes, are all that has to be shuffled. Keys of types
    that an equality join would convert first are not told by their hashes.
    """
    kind = base.schema[key].dataType
    if kind != changes.schema[key].dataType or kind not in (StringType(), LongType(), IntegerType()):
        return None, base
    bits = min(22, max(16, (16 * changes.count()).bit_length()))
    hashes = changes.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("_hash"))
    marked = base.withColumn("_bits", bitmap(hashes, "_hash", bits))
    maybe = F.col(key).isNotNull() & F.coalesce(in_bitmap(F.col("_bits"), F.xxhash64(key), bits), F.lit(False))
    return marked.where(~maybe).drop("_bits"), marked.where(maybe).drop("_bits")


def merged(base: DataFrame, incoming: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows without a change, and all incoming rows; columns unknown to one side become null."""
    untouched = base.join(changes.select(key), key, "left_anti")
    return untouched.unionByName(incoming, allowMissingColumns=True)


def _in_few_files(spark: SparkSession, table: str, partition: str, values: list) -> bool:
    """Whether the files of these partitions are not far more than their size asks for; from the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(table)
    n, size = files.where(among(partition, values)).agg(F.count(F.lit(1)), F.sum("length")).first()
    return n <= FILES * (len(values) + (size or 0) / FILE_BYTES)


def upsert_partitions(
    spark: SparkSession,
    changes: DataFrame,
    table: str,
    first_year: int = K.FIRST_YEAR,
    key: str = "cve_id",
    newest: str = "last_modified",
    partition: str = "year",
    target: str = "published_year",
    lineage: str | None = None,
    snapshot_date: DateLike | None = None,
    index: str | None = None,
) -> UpsertStats:
    """Bring a table partitioned by ``partition`` up to date with a change set.

    A changed record goes to the partition named by its ``target`` column and every other copy of
    its key leaves the table, also when the newest version lies before ``first_year`` or has no
    year: then the key leaves for good. The new content of all touched partitions is counted, which
    reads keys only; if the count is as expected it is written beside them and replaces them when it
    is complete, so a failure before that changes nothing. Partitions that lose all rows are cleared
    after it; a run that broke off in between is put right by running the same change set again.

    With an ``index`` folder only partitions that may hold a changed key are searched for it, and
    the index is renewed for the partitions that changed.
    """
    latest = stage_changes(changes, lineage, snapshot_date, key=key, newest=newest)
    if latest.isEmpty():
        return UpsertStats()
    base = read_table(spark, table) if table_exists(spark, table) else None
    incoming = within_window(latest, first_year, target).withColumn(partition, F.col(target))
    may_hold = None
    if base is not None and index is not None:
        may_hold = candidate_partitions(spark, latest, table, index, key, partition)
    touched = affected_partitions(base, latest, incoming, key, partition, may_hold).collect()
    if not touched:
        return UpsertStats()
    result, together = incoming, False
    if base is not None:
        values = [row[partition] for row in touched]
        lying, others = _told_apart(base.where(among(partition, values)), latest, key)
        result = merged(others, incoming, latest, key)
        if lying is not None:
            together = _in_few_files(spark, table, partition, values)
            result = by_partition(result, [partition]) if together else result
            result = lying.unionByName(result, allowMissingColumns=True)
    expected, found = sum(row["rows_after"] for row in touched), result.count()
    if found != expected:
        raise RuntimeError(f"the upsert made {found} rows, expected {expected}; {table} is unchanged")
    written = overwrite_partitions(result, table, [partition], together=together)
    emptied = [row[partition] for row in touched if row["exists_now"] and not row["rows_after"]]
    _write_empty(spark, table, partition, emptied, result.drop(partition).schema)
    if index is not None:
        write_key_index(spark, table, index, key, partition, [row[partition] for row in touched])
    return UpsertStats(
        modified_rows=incoming.count(), affected_years=len(touched), written_rows=written
    )


def _write_empty(
    spark: SparkSession, table: str, partition: str, values: list, schema: StructType
) -> None:
    """Partitions that lost all rows: a dynamic overwrite does not touch them."""
    for value in values:
        folder = DEFAULT_PARTITION if value is None else value
        spark.createDataFrame([], schema).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(f"{table}/{partition}={folder}")


def merge_versioned(
    changes: DataFrame,
    table: str,
    first_year: int = K.FIRST_YEAR,
    key: str = "cve_id",
    target: str = "published_year",
    **dedupe,
) -> None:
    """The same upsert as one MERGE, for a catalog table whose format supports it.

    Needs a connector for such a format on the session; plain Parquet has none.
    """
    latest = within_window(latest_per_key(changes, key, **dedupe), first_year, target)
    same_key = F.col(f"{table}.{key}") == F.col(f"changes.{key}")
    merge = latest.alias("changes").mergeInto(table, same_key)
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def full_refresh(
    df: DataFrame,
    table: str,
    first_year: int = K.FIRST_YEAR,
    partition: str = "year",
    target: str = "published_year",
    fmt: str = "parquet",
    **dedupe,
) -> int:
    """Rebuild a table from all years in one job.

    The newest version of a key decides, also about whether the key is inside the window.
    """
    latest = within_window(latest_per_key(df, **dedupe), first_year, target)
    return overwrite_partitions(
        latest.withColumn(partition, F.col(target)), table, [partition], fmt, reset=True
    )


def repartition_table(
    spark: SparkSession,
    source: str,
    table: str,
    first_year: int = K.FIRST_YEAR,
    fmt: str = "parquet",
) -> int:
    """Copy a table partitioned by feed year into one partitioned by publication year."""
    rows = within_window(read_table(spark, source).drop("year"), first_year)
    return overwrite_partitions(rows, table, ["published_year"], fmt, reset=True)
