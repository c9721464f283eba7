"""The key index names every partition that holds a changed key, and hardly any other."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from riskspark.operators import key_index, upsert
from riskspark.sources.sinks import overwrite_partitions
from riskspark.sources.tables import among

DAY = dt.datetime(2024, 1, 1)


def _table(spark, path, rows):
    """``rows`` keys dealt over partitions of falling size, the last one without a value."""
    keys = spark.range(rows).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("cve_id"),
        F.lit(DAY).alias("last_modified"),
        F.lit("old").alias("description"),
        F.when(F.col("id") % 10 != 9, F.least(F.lit(5), F.floor(F.sqrt("id") % 7)).cast("int")).alias("published_year"),
    )
    overwrite_partitions(keys.withColumn("year", F.col("published_year")), path, ["year"])
    return keys


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "table"), str(tmp_path / "index")


def _holding(spark, path, changes):
    rows = spark.read.parquet(path).join(changes.select("cve_id"), "cve_id", "left_semi").select("year").distinct().collect()
    return {r.year for r in rows}


def test_all_holders_and_few_others(spark, paths):
    path, index = paths
    keys = _table(spark, path, 60_000)
    key_index.write_key_index(spark, path, index, "cve_id", "year")
    levels = {r.level for r in spark.read.parquet(f"{index}/partitions").collect()}
    assert len(levels) > 1 and max(levels) >= 3
    blocks = spark.read.parquet(f"{index}/blocks")
    assert {r.n for r in blocks.select(F.length("bits").alias("n")).distinct().collect()} == {4096}
    spare = 0
    for start in range(0, 60_000, 20_000):
        changes = keys.where(f"cve_id in ('k{start}', 'k{start + 1}', 'x{start}')")
        got = key_index.candidate_partitions(spark, changes, path, index, "cve_id", "year")
        held = _holding(spark, path, changes)
        assert held <= set(got) and len(got) == len(set(got))
        spare += len(set(got) - held)
    assert spare <= 1
    foreign = spark.createDataFrame([("a",), ("z",), (None,)], "cve_id string")
    assert key_index.candidate_partitions(spark, foreign, path, index, "cve_id", "year") == []
    inside = spark.range(1000).select(F.concat(F.lit("k1x"), F.col("id").cast("string")).alias("cve_id"))
    got = key_index.candidate_partitions(spark, inside.limit(5), path, index, "cve_id", "year")
    assert len(got) <= 1
    nothing = spark.createDataFrame([(None,)], "cve_id string")
    assert key_index.candidate_partitions(spark, nothing, path, index, "cve_id", "year") == []


def test_only_named_partitions_are_searched(spark, paths, capsys):
    path, index = paths
    keys = _table(spark, path, 2_000)
    key_index.write_key_index(spark, path, index, "cve_id", "year")
    changes = keys.where("cve_id in ('k1', 'k9')")
    got = key_index.candidate_partitions(spark, changes, path, index, "cve_id", "year")
    assert set(got) == _holding(spark, path, changes) and len(got) == 2 and None in got
    base = spark.read.parquet(path)
    base.where(among("year", got)).select("cve_id", "year").explain()
    plan = capsys.readouterr().out
    # one scan, pruned by the two partitions alone: no filter is left for the rows
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ (= 1|IN \(1\))[^\]]*isnull\(year#\d+\)", plan)
    assert plan.count("FileScan") == 1 and "Filter (" not in plan
    assert "ReadSchema: struct<cve_id:string>" in plan


def test_stale_partial_and_missing_indexes_leave_nothing_out(spark, paths):
    path, index = paths
    keys = _table(spark, path, 500)
    everything = {r.year for r in spark.read.parquet(path).select("year").distinct().collect()}
    changes = keys.where("cve_id = 'k1'")
    look = lambda: set(key_index.candidate_partitions(spark, changes, path, index, "cve_id", "year"))
    assert look() == everything
    key_index.write_key_index(spark, path, index, "cve_id", "year", only=[1])
    assert look() == everything
    key_index.write_key_index(spark, path, index, "cve_id", "year")
    assert look() == {1}
    # another writer moves the key without the index
    moved = spark.read.parquet(path).where("year = 3").drop("year").unionByName(changes).withColumn("year", F.lit(3))
    moved.write.parquet(f"{path}-copy")
    overwrite_partitions(spark.read.parquet(f"{path}-copy"), path, ["year"])
    assert look() == {1, 3}
    key_index.write_key_index(spark, path, index, "cve_id", "year", only=[3])
    assert look() == {1, 3}
    assert set(key_index.candidate_partitions(spark, keys.where("cve_id = 'k2'"), path, index, "cve_id", "year")) == {1}


def test_upsert_with_and_without_index_agree(spark, tmp_path):
    plain, indexed, index = (str(tmp_path / name) for name in ("plain", "indexed", "index"))
    keys = _table(spark, plain, 3_000)
    _table(spark, indexed, 3_000)
    key_index.write_key_index(spark, indexed, index, "cve_id", "year")
    later = keys.withColumn("last_modified", F.lit(DAY + dt.timedelta(days=1)))
    rounds = [
        later.where("cve_id in ('k1', 'k9', 'k400')").withColumn("published_year", F.lit(4)),
        later.where("cve_id in ('k1', 'k2')").withColumn("published_year", F.lit(-5)),
        later.where("published_year = 2").withColumn("published_year", F.lit(3)),
    ]
    for changes in rounds:
        stats = [
            upsert.upsert_partitions(spark, changes, plain, 0),
            upsert.upsert_partitions(spark, changes, indexed, 0, index=index),
        ]
        assert stats[0] == stats[1]
        a, b = spark.read.parquet(plain), spark.read.parquet(indexed)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_many_foreign_keys_name_no_partition(spark, paths):
    path, index = paths
    keys = _table(spark, path, 60_000)
    key_index.write_key_index(spark, path, index, "cve_id", "year")
    # all inside the range of the keys: at some chance hits in 10^5 lookups the blocks alone name a partition
    foreign = spark.range(300_000).select(F.concat(F.lit("k1x"), F.col("id").cast("string")).alias("cve_id"))
    look = lambda changes: set(key_index.candidate_partitions(spark, changes, path, index, "cve_id", "year"))
    assert look(foreign) == set()
    mixed = foreign.unionByName(keys.where("cve_id = 'k1'").select("cve_id"))
    assert look(mixed) == {1}
