import datetime as dt

import pytest

from riskspark.operators import upsert
from riskspark.sources.sinks import overwrite_partitions

SCHEMA = "cve_id string, published_year int, last_modified timestamp, description string"


def _rows(spark, *rows):
    return spark.createDataFrame(
        [(k, y, dt.datetime(2024, 1, day), text) for k, y, day, text in rows], SCHEMA
    )


def _store(spark, path, df, year=None):
    from pyspark.sql import functions as F

    year_of = F.lit(year) if year else F.col("published_year")
    overwrite_partitions(df.withColumn("year", year_of.cast("int")), path, ["year"])


def _content(spark, path):
    return sorted(
        (r.cve_id, r.year, r.description) for r in spark.read.parquet(path).collect()
    )


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def test_changed_and_new_rows(spark, path):
    _store(spark, path, _rows(spark, ("0001", 2024, 1, "old"), ("0002", 2024, 1, "kept")))
    stats = upsert.upsert_partitions(
        spark, _rows(spark, ("0001", 2024, 2, "new"), ("0003", 2024, 2, "added")), path
    )
    assert _content(spark, path) == [
        ("0001", 2024, "new"),
        ("0002", 2024, "kept"),
        ("0003", 2024, "added"),
    ]
    assert stats == upsert.UpsertStats(2, 1, 3)


def test_misplaced_copy_leaves_an_empty_partition(spark, path):
    _store(spark, path, _rows(spark, ("0001", 2021, 1, "misplaced")), year=2026)
    stats = upsert.upsert_partitions(spark, _rows(spark, ("0001", 2021, 2, "moved")), path)
    assert _content(spark, path) == [("0001", 2021, "moved")]
    assert spark.read.parquet(f"{path}/year=2026").count() == 0
    assert stats == upsert.UpsertStats(1, 2, 1)


def test_untouched_partitions_keep_their_files(spark, path, tmp_path):
    _store(spark, path, _rows(spark, ("0001", 2020, 1, "a"), ("0002", 2021, 1, "b")))
    before = sorted(p.name for p in (tmp_path / "table" / "year=2020").glob("*.parquet"))
    upsert.upsert_partitions(spark, _rows(spark, ("0002", 2021, 2, "c")), path)
    after = sorted(p.name for p in (tmp_path / "table" / "year=2020").glob("*.parquet"))
    assert before == after
    assert _content(spark, path) == [("0001", 2020, "a"), ("0002", 2021, "c")]


def test_rows_before_the_window_are_ignored(spark, path):
    changes = _rows(spark, ("0001", 2020, 1, "early"), ("0002", 2024, 1, "late"))
    stats = upsert.upsert_partitions(spark, changes, path, first_year=2024)
    assert _content(spark, path) == [("0002", 2024, "late")]
    assert stats == upsert.UpsertStats(1, 1, 1)


def test_newest_version_wins_and_lineage_is_kept(spark, path, tmp_path):
    lineage = str(tmp_path / "updates")
    changes = _rows(spark, ("0001", 2024, 1, "v1"), ("0001", 2024, 9, "v9"))
    upsert.upsert_partitions(
        spark, changes, path, lineage=lineage, snapshot_date="2024-01-10"
    )
    assert _content(spark, path) == [("0001", 2024, "v9")]
    kept = spark.read.parquet(lineage)
    assert [(r.description, r.snapshot_date) for r in kept.collect()] == [
        ("v9", dt.date(2024, 1, 10))
    ]


def test_empty_change_set_writes_nothing(spark, path, tmp_path):
    stats = upsert.upsert_partitions(spark, spark.createDataFrame([], SCHEMA), path)
    assert stats == upsert.UpsertStats()
    assert not (tmp_path / "table").exists()


def test_columns_unknown_to_one_side_become_null(spark, path):
    _store(spark, path, _rows(spark, ("0001", 2024, 1, "a"), ("0002", 2024, 1, "b")))
    changes = _rows(spark, ("0002", 2024, 2, "c")).drop("description").selectExpr("*", "1 AS extra")
    upsert.upsert_partitions(spark, changes, path)
    got = {r.cve_id: (r.description, r.extra) for r in spark.read.parquet(path).collect()}
    assert got == {"0001": ("a", None), "0002": (None, 1)}


def test_full_refresh_dedupes_and_drops_old_partitions(spark, path):
    _store(spark, path, _rows(spark, ("0009", 2019, 1, "gone")))
    rows = _rows(spark, ("0001", 2024, 1, "v1"), ("0001", 2024, 2, "v2"), ("0002", 2001, 1, "old"))
    assert upsert.full_refresh(rows, path) == 1
    assert _content(spark, path) == [("0001", 2024, "v2")]


def test_repartition_table(spark, path, tmp_path):
    _store(spark, path, _rows(spark, ("0001", 2024, 1, "a"), ("0002", 2001, 1, "b")), year=2025)
    target = str(tmp_path / "target")
    assert upsert.repartition_table(spark, path, target) == 1
    df = spark.read.parquet(target)
    assert "year" not in df.columns
    assert [(r.cve_id, r.published_year) for r in df.collect()] == [("0001", 2024)]


def test_the_default_partition_is_replaced_too(spark, path, tmp_path):
    from pyspark.sql import functions as F

    base = _rows(spark, ("A", None, 1, "old"), ("B", None, 1, "kept"), ("C", 2020, 1, "moves"))
    overwrite_partitions(base.withColumn("year", F.col("published_year")), path, ["year"])
    upsert.upsert_partitions(spark, _rows(spark, ("A", 2021, 2, "new")), path)
    assert sorted(_content(spark, path), key=repr) == [("A", 2021, "new"), ("B", None, "kept"), ("C", 2020, "moves")]
    upsert.upsert_partitions(spark, _rows(spark, ("B", 2022, 2, "dated")), path)
    assert _content(spark, path) == [("A", 2021, "new"), ("B", 2022, "dated"), ("C", 2020, "moves")]
    assert not (tmp_path / "table" / "year=None").exists()


def test_a_key_that_leaves_the_window_is_removed(spark, path):
    _store(spark, path, _rows(spark, ("A", 2020, 1, "old"), ("B", 2020, 1, "kept")))
    stats = upsert.upsert_partitions(spark, _rows(spark, ("A", 2001, 2, "early")), path)
    assert _content(spark, path) == [("B", 2020, "kept")]
    assert stats == upsert.UpsertStats(0, 1, 1)


def test_both_paths_let_the_newest_version_decide(spark, path):
    rows = _rows(spark, ("A", 2016, 1, "old"), ("A", 2001, 2, "early"), ("B", 2016, 1, "kept"))
    upsert.full_refresh(rows, path)
    assert _content(spark, path) == [("B", 2016, "kept")]


def test_a_wrong_count_leaves_the_table_alone(spark, path, monkeypatch):
    _store(spark, path, _rows(spark, ("A", 2020, 1, "old")))
    monkeypatch.setattr(upsert, "merged", lambda held, incoming, changes, key: incoming.limit(0))
    with pytest.raises(RuntimeError, match="unchanged"):
        upsert.upsert_partitions(spark, _rows(spark, ("A", 2020, 2, "new")), path)
    assert _content(spark, path) == [("A", 2020, "old")]


def test_only_rows_that_may_be_changed_are_shuffled(spark, path, monkeypatch):
    base = [(f"{i:04}", 2020 + i % 3, 1, f"text {i}") for i in range(400)]
    _store(spark, path, _rows(spark, *base))
    met = []
    merged = upsert.merged
    monkeypatch.setattr(upsert, "merged", lambda held, *rest: met.append(held.count()) or merged(held, *rest))
    staged = []
    stage = upsert.stage_table
    monkeypatch.setattr(upsert, "stage_table", lambda df, label: staged.append(label) or stage(df, label))
    changes = [(f"{i:04}", 2021, 2, "changed") for i in range(0, 400, 50)]
    upsert.upsert_partitions(spark, _rows(spark, *changes, (None, 2021, 2, "no key")), path)
    new = {k: (k, y, text) for k, y, _, text in base + changes}
    assert _content(spark, path) == sorted(new.values())
    assert met[0] < 20
    # the new content is written once, to the table
    assert "upsert" not in staged


def test_many_small_files_are_gathered(spark, path, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "FILES", 1)
    rows = [(f"{i:04}", 2020, 1, "a") for i in range(40)]
    for part in range(4):
        _rows(spark, *rows[part::4]).selectExpr("*", "2020 AS year").write.mode("append").partitionBy("year").parquet(path)
    assert len(list((tmp_path / "table" / "year=2020").glob("*.parquet"))) > 3
    upsert.upsert_partitions(spark, _rows(spark, ("0001", 2020, 2, "b")), path)
    assert len(list((tmp_path / "table" / "year=2020").glob("*.parquet"))) == 1
    assert len(_content(spark, path)) == 40
