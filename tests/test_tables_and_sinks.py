import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskspark.sources import sinks, tables
from riskspark.sources.workdir import scratch_path, shared_folder, stage_table

DAY = dt.date


@pytest.fixture
def history(spark, tmp_path):
    path = str(tmp_path / "history")
    df = spark.createDataFrame(
        [("a", 0.1, DAY(2026, 5, 10)), ("a", 0.3, DAY(2026, 5, 14)), ("a", 0.9, DAY(2026, 5, 16))],
        "cve_id string, epss_score double, score_date date",
    )
    sinks.overwrite_partitions(df, path, ["score_date"])
    return spark.read.parquet(path)


def test_as_of_takes_the_latest_past_partition(history):
    assert [r.epss_score for r in tables.snapshot_as_of(history, "2026-05-14").collect()] == [0.3]
    assert [r.epss_score for r in tables.snapshot_as_of(history, "2026-05-15").collect()] == [0.3]


def test_as_of_without_a_past_is_empty_with_the_same_schema(history):
    nothing = tables.snapshot_as_of(history, "2026-05-01")
    assert nothing.count() == 0 and nothing.schema == history.schema


def test_as_of_reads_one_partition(history, capsys):
    df = tables.snapshot_as_of(history, "2026-05-15", lookback_days=3)
    df.collect()
    df.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(score_date" in plan and "Subquery" in plan


def test_lookback(history):
    found = tables.snapshot_as_of(history, "2026-05-20", lookback_days=4, required=True)
    assert [r.epss_score for r in found.collect()] == [0.9]
    with pytest.raises(Exception, match="no score_date within 2 days"):
        tables.snapshot_as_of(history, "2026-05-20", lookback_days=2, required=True).collect()


def test_snapshot_resolution(spark, history):
    def resolve(date):
        return tables.resolve_snapshot(history, date, "score_date")

    assert resolve("2026-05-14") == DAY(2026, 5, 14)
    assert resolve("2026-05-15") == DAY(2026, 5, 16)
    assert resolve(None) == DAY(2026, 5, 16)
    empty = history.limit(0)
    assert tables.resolve_snapshot(empty, "2026-05-14", "score_date") is None
    assert tables.job_snapshot(empty, "2026-05-14", "score_date") == DAY(2026, 5, 14)
    dates = [r[0].day for r in tables.available_snapshots(history, "score_date").collect()]
    assert dates == [16, 14, 10]


def test_overwrite_replaces_only_present_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "v int, p string")
    assert sinks.overwrite_partitions(first, path, ["p"]) == 3
    assert sinks.overwrite_partitions(first.where("v = 1"), path, ["p"]) == 1
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3]
    sinks.overwrite_partitions(first.where("v = 2"), path, ["p"], reset=True)
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]


def test_snapshot_rerun_leaves_nothing_stale(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2020), (2, 2021)], "v int, published_year int")
    sinks.write_snapshot(df, path, "2026-05-01", by=["published_year"])
    sinks.write_snapshot(df, path, "2026-05-02", by=["published_year"])
    assert sinks.write_snapshot(df.where("v = 1"), path, "2026-05-02", by=["published_year"]) == 1
    stored = spark.read.parquet(path)
    assert tables.at_snapshot(stored, "2026-05-01").count() == 2
    assert [r.published_year for r in tables.at_snapshot(stored, "2026-05-02").collect()] == [2020]


def test_single_file_snapshot(spark, tmp_path):
    sinks.write_snapshot(spark.range(100).repartition(5), str(tmp_path / "t"), "2026-05-01", single_file=True)
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 1


def test_failed_verified_write_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.createDataFrame([(1, "01")], "v int, p string")
    assert sinks.write_verified(good, path, ["p"]) == 1
    broken = good.withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        sinks.write_verified(broken, path, ["p"])
    assert spark.read.schema(good.schema).parquet(path).collect() == good.collect()


def test_strategy_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "cve_id string, strategy string")
    assert sinks.write_by_strategy(df, path, "2026-05-01") == 2
    assert (tmp_path / "t" / "strategy=x" / "snapshot_date=2026-05-01").is_dir()


def test_csv_export_of_present_columns(spark, tmp_path):
    df = spark.createDataFrame(
        [(" a", 1.5, ["x", "y"], 'say "hi", all')], "id string, s double, tags array<string>, t string"
    )
    path = str(tmp_path / "out")
    assert sinks.export_csv(df, path, ["s", "missing", "id", "tags", "t"]) == 1
    back = spark.read.options(header=True, escape='"').csv(path)
    assert back.columns == ["s", "id", "tags", "t"]
    assert tuple(back.first()) == ("1.5", " a", "x|y", 'say "hi", all')


def test_merge_schema(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t" / "p=1"))
    spark.range(1).withColumn("extra", F.lit(1)).write.parquet(str(tmp_path / "t" / "p=2"))
    df = tables.read_table(spark, str(tmp_path / "t"), merge_schema=True)
    assert df.count() == 2 and "extra" in df.columns


def test_table_exists(spark, tmp_path):
    assert not tables.table_exists(spark, str(tmp_path / "nothing"))
    spark.range(1).write.parquet(str(tmp_path / "t"))
    assert tables.table_exists(spark, str(tmp_path / "t"))


def test_work_tables_live_in_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(configured)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    staged = stage_table(spark.range(5), "x")
    assert staged.count() == 5 and configured in staged.inputFiles()[0]


def test_one_snapshot_is_read_from_its_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_snapshot(spark.range(3), path, "2026-05-01")
    sinks.write_snapshot(spark.range(5).withColumn("extra", F.lit(1)), path, "2026-05-02")
    one = tables.read_snapshot(spark, path, DAY(2026, 5, 2))
    assert (one.count(), one.columns) == (5, ["id", "extra", "snapshot_date"])
    assert one.first().snapshot_date == DAY(2026, 5, 2)
    assert all("snapshot_date=2026-05-02" in name for name in one.inputFiles())
    assert tables.read_snapshot(spark, path, "2026-05-09").count() == 0


def test_finding_a_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_snapshot(spark.range(3), path, "2026-05-01")
    sinks.write_snapshot(spark.range(3), path, "2026-05-03")
    sinks.write_snapshot(spark.range(0), path, "2026-05-02")
    assert tables.find_snapshot(spark, path, "2026-05-01") == DAY(2026, 5, 1)
    assert tables.find_snapshot(spark, path, "2026-05-02") == DAY(2026, 5, 3)
    assert tables.find_snapshot(spark, path) == DAY(2026, 5, 3)


def test_merged_snapshots_widen_and_fill(spark, tmp_path):
    path = str(tmp_path / "merged")
    sinks.write_snapshot(spark.createDataFrame([(1, 0.5)], "a int, b float"), path, "2024-01-01")
    sinks.write_snapshot(spark.createDataFrame([(2**40, "x")], "a long, c string"), path, "2024-01-02")
    sinks.write_snapshot(spark.createDataFrame([(3, 0.25)], "a int, b float"), path, "2024-01-03")
    merged = tables.read_merged_snapshots(spark, path)
    assert dict(merged.dtypes) == {"a": "bigint", "b": "float", "c": "string", "snapshot_date": "date"}
    got = {tuple(r)[:3] for r in merged.select("a", "b", "c").collect()}
    assert got == {(1, 0.5, None), (2**40, None, "x"), (3, 0.25, None)}
    # two schemas, two scans, however many snapshots
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    sinks.write_snapshot(spark.createDataFrame([("no",)], "a string"), path, "2024-01-04")
    with pytest.raises(ValueError, match="column a"):
        tables.read_merged_snapshots(spark, path)
