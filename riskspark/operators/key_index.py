"""Which partitions of a table hold a key, told without reading the keys of most others.

Beside a partitioned table lies an index of two small tables. One has a row per partition: lowest
and highest key, a signature of the files it was made from, and a level. The other holds the keys of
a partition as a Bloom filter cut into 2 ** level blocks of 4 KB, at most about ``BLOCK_KEYS`` keys
each, so that one lookup reads one block per partition and no block or task grows with the table.

The index only ever leaves partitions out. A partition whose files are no longer those of its
signature, or that has none, counts as one that may hold anything: a stale, missing or half-written
index costs a scan and never a result. What the blocks name by chance goes too: the keys of named
partitions, and of no others, are read and compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskspark.sources.sinks import overwrite_partitions
from riskspark.sources.tables import among, read_table, table_exists
from riskspark.sources.workdir import discard, stage_table

#: Keys of a block: 32 to 64 bits a key once a partition has more than half of them.
BLOCK_KEYS = 1024
#: Fixed value of the built-in bitmap functions: bits in one of their bitmaps.
BLOCK_BITS = 1 << 15
#: Bits set for a key. At 64 to 32 bits a key a foreign key meets all of them once in 10^5 to 4 x 10^3 lookups.
PROBES = 4


def partition_files(spark: SparkSession, table: str, partition: str) -> DataFrame:
    """``partition``, ``files``: a signature of the data files of each partition.

    One row per file, from the listing alone: no file is opened.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(table)
    mark = F.xxhash64("path", "length", "modificationTime")
    return files.groupBy(partition).agg(
        F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.bit_xor(mark).cast("string")).alias("files")
    )


def _block(key: Column, level: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(F.expr("9223372036854775807")) % F.pow(F.lit(2), level).cast("long")


def _probes(key: Column) -> list[Column]:
    """Places in a block that a key sets."""
    second = F.xxhash64(F.lit(1), key)
    return [F.shiftrightunsigned(second, 15 * i).bitwiseAND(BLOCK_BITS - 1).cast("int") for i in range(PROBES)]


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place % 8) == 1


def write_key_index(
    spark: SparkSession, table: str, index: str, key: str, partition: str, only: Sequence | None = None
) -> None:
    """Make the index of a table, or renew it for the listed partitions.

    Keys without a value are not in it. The signature is taken before the keys are read: a table that
    changes meanwhile leaves a signature that no longer holds.
    """
    files = stage_table(partition_files(spark, table, partition), "files")
    keys = read_table(spark, table).select(F.col(partition), F.col(key).alias("key")).where("key is not null")
    if only is not None:
        keys = keys.where(among(partition, only))
    sizes = keys.groupBy(partition).agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / BLOCK_KEYS))).cast("int")
    same = F.col(f"s.{partition}").eqNullSafe(F.col(f"f.{partition}"))
    summary = stage_table(
        sizes.alias("s").join(files.alias("f"), same).select(f"s.{partition}", level.alias("level"), "low", "high", "files"),
        "key-partitions",
    )
    same = F.col(f"k.{partition}").eqNullSafe(F.col(f"s.{partition}"))
    placed = keys.alias("k").join(summary.alias("s"), same).select(
        f"k.{partition}", "level", _block(F.col("key"), F.col("level")).alias("block"), F.array(_probes(F.col("key"))).alias("places")
    )
    # keys of a block are brought together before bits are set: a bitmap per task and block could be 4 KB for each key
    placed = placed.repartition(F.col(partition), F.col("level"), F.col("block"))
    blocks = (
        placed.select(partition, "level", "block", F.explode("places").alias("place"))
        .groupBy(partition, "level", "block")
        .agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits"))
    )
    overwrite_partitions(blocks, f"{index}/blocks", [partition], reset=only is None)
    # last: until then the old signatures stand, which no longer fit
    overwrite_partitions(summary, f"{index}/partitions", [partition], reset=only is None)
    discard(files, summary)


def candidate_partitions(
    spark: SparkSession, changes: DataFrame, table: str, index: str, key: str, partition: str
) -> list:
    """Partitions of the table that hold a key of ``changes``, nulls among them as None.

    Every partition that holds one is in the list, and beside them only those that the index does
    not know as they are. What reaches the driver is a row per partition, the levels in use (at most
    some thirty) and the lowest and highest changed key.
    """
    now = stage_table(partition_files(spark, table, partition), "files")
    if not (table_exists(spark, f"{index}/partitions") and table_exists(spark, f"{index}/blocks")):
        return [row[partition] for row in now.select(partition).collect()]
    wanted = changes.select(F.col(key).alias("key")).where("key is not null")
    lowest, highest = wanted.agg(F.min("key"), F.max("key")).first()
    same = F.col(f"n.{partition}").eqNullSafe(F.col(f"p.{partition}")) & (F.col("n.files") == F.col("p.files"))
    known = now.alias("n").join(read_table(spark, f"{index}/partitions").alias("p"), same, "left")
    inside = (F.col("low") <= F.lit(highest)) & (F.col("high") >= F.lit(lowest))
    known = stage_table(known.select(f"n.{partition}", "level", "low", "high", inside.alias("inside")), "key-partitions")
    rows = known.where("level is null or inside").select(partition, "level").collect()
    discard(now)
    found = [row[partition] for row in rows if row["level"] is None]
    ranged = [row for row in rows if row["level"] is not None]
    if ranged:
        levels = sorted({row["level"] for row in ranged})
        asked = wanted.select("key", F.explode(F.array([F.lit(level) for level in levels])).alias("level"))
        asked = asked.select("key", "level", _block(F.col("key"), F.col("level")).alias("block"))
        names = [row[partition] for row in ranged]
        blocks = read_table(spark, f"{index}/blocks").where(among(partition, names))
        same = F.col(f"b.{partition}").eqNullSafe(F.col(f"p.{partition}"))
        blocks = blocks.alias("b").join(known.where("inside").alias("p"), same & (F.col("b.level") == F.col("p.level")))
        blocks = blocks.select(f"b.{partition}", "b.level", "block", "bits", "low", "high")
        met = asked.join(blocks, ["level", "block"]).where("key between low and high")
        for place in _probes(F.col("key")):
            met = met.where(_is_set(F.col("bits"), place))
        hits = stage_table(met.select(partition, "key").distinct(), "key-hits")
        named = [row[partition] for row in hits.select(partition).distinct().collect()]
        held = read_table(spark, table).where(among(partition, named)).select(F.col(partition), F.col(key).alias("key"))
        same = F.col(f"t.{partition}").eqNullSafe(F.col(f"h.{partition}")) & (F.col("t.key") == F.col("h.key"))
        holders = held.alias("t").join(hits.alias("h"), same, "left_semi").select(partition).distinct()
        found += [row[partition] for row in holders.collect()]
        discard(hits)
    discard(known)
    return found
