import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators import ranking
from riskspark.operators.dedupe import latest_per_key


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows, most of them in one group, with ties and nulls in the score."""
    rng = random.Random(7)
    rows = [
        (
            f"k{i:05d}",
            "hot" if rng.random() < 0.8 else f"g{rng.randrange(5)}",
            None if rng.random() < 0.05 else rng.randrange(40) / 10,
            rng.randrange(2),
        )
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "key string, grp string, score double, flag int")
    return df.repartition(9), rows


def _by_score(row):
    return (row[2] is None, -(row[2] or 0), row[0])


ORDER = ["-score", "key"]


@pytest.mark.parametrize("k", [1, 50, 700, 5000])
def test_top_k_equals_a_full_sort(skewed, k):
    df, rows = skewed
    want = [r[0] for r in sorted(rows, key=_by_score)[:k]]
    assert [r.key for r in ranking.top_k(df, ORDER, k).collect()] == want


def test_top_k_is_a_bounded_heap(skewed, capsys):
    df, _ = skewed
    ranking.top_k(df, ORDER, 1500).explain()
    plan = capsys.readouterr().out
    assert "TakeOrderedAndProject" in plan and "Sort [" not in plan and "Window" not in plan


def test_ranked_prefix_over_mixed_order(skewed):
    df, rows = skewed
    want = sorted(rows, key=lambda r: (-r[3], r[1], *_by_score(r)))[:150]
    got = ranking.ranked_prefix(df, ["-flag", "grp", *ORDER], 150, "rank")
    assert [(r.rank, r.key) for r in got.orderBy("rank").collect()] == [
        (i + 1, r[0]) for i, r in enumerate(want)
    ]


def test_prefix_that_ends_in_nulls(spark):
    rows = [(f"k{i:03d}", None if i % 3 else float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "key string, score double").repartition(12)
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))[:30]
    got = ranking.ranked_prefix(df, ORDER, 30, "rank").orderBy("rank").collect()
    assert [r.key for r in got] == [r[0] for r in want]


def test_global_rank_is_the_position_in_the_total_order(skewed):
    df, rows = skewed
    want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=_by_score))}
    ranked = ranking.global_rank(df, ORDER, "rank")
    assert {r.key: r["rank"] for r in ranked.collect()} == want
    assert ranked.columns == [*df.columns, "rank"]


def test_global_rank_has_no_one_task_window(skewed, capsys):
    df, _ = skewed
    ranked = ranking.global_rank(df, ORDER, "rank")
    ranked.explain()
    plan = capsys.readouterr().out
    # the only single-partition step adds up run lengths
    assert plan.count("SinglePartition") == 1 and "_rows" in plan


def _ranks_in_group(rows):
    want = {}
    for group in {r[1] for r in rows}:
        members = sorted((r for r in rows if r[1] == group), key=_by_score)
        want |= {r[0]: i + 1 for i, r in enumerate(members)}
    return want


def test_global_rank_writes_only_what_is_kept(skewed, monkeypatch):
    df, _ = skewed
    written = []
    real = ranking.stage_table
    monkeypatch.setattr(ranking, "stage_table", lambda table, label: written.append(table.columns) or real(table, label))
    whole = {r.key: r["rank"] for r in ranking.global_rank(df, ORDER, "rank").collect()}
    narrow = ranking.global_rank(df, ORDER, "rank", keep=["key"])
    assert written[1] == ["key", "_place"] and narrow.columns == ["key", "rank"]
    assert {r.key: r["rank"] for r in narrow.collect()} == whole


def test_group_rank_of_a_hot_group(skewed):
    df, rows = skewed
    ranked = ranking.group_rank(df, ["grp"], ORDER, "rank")
    assert {r.key: r["rank"] for r in ranked.collect()} == _ranks_in_group(rows)


def test_null_is_a_group_of_its_own(spark):
    df = spark.createDataFrame(
        [(None, "a"), (None, "b"), ("g", "c"), (None, "d")], "grp string, key string"
    )
    got = {r.key: r["rank"] for r in ranking.group_rank(df, ["grp"], ["key"], "rank").collect()}
    assert got == {"a": 1, "b": 2, "c": 1, "d": 3}


@pytest.mark.parametrize("k", [30, 1200])
def test_top_k_per_group(skewed, k):
    df, rows = skewed
    want = {key: v for key, v in _ranks_in_group(rows).items() if v <= k}
    got = ranking.top_k_per_group(df, ["grp"], ORDER, k, "rank")
    assert {r.key: r["rank"] for r in got.collect()} == want


def test_rows_are_trimmed_before_the_shuffle(skewed, capsys):
    df, _ = skewed
    ranking.top_k_per_group(df, ["grp"], ORDER, 5).explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_values_order_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", ["x", "y"]), ("a", ["y", None]), ("a", ["z", "w"]), ("b", []), ("c", [None])],
        "grp string, items array<string>",
    )
    got = {r.grp: r.top for r in ranking.top_values(df, "grp", "items", 3, "top").collect()}
    assert got == {"a": ["y", "w", "x"], "c": []}


def test_latest_per_key(spark):
    rows = [("a", 1, "old"), ("a", 3, "new"), ("b", None, "undated"), ("b", 1, "dated"), (None, 9, "no key")]
    df = spark.createDataFrame(rows, "cve_id string, last_modified int, text string")
    got = {r.cve_id: r.text for r in latest_per_key(df).collect()}
    assert got == {"a": "new", "b": "dated"}
    assert latest_per_key(df).columns == df.columns


def test_latest_per_key_does_not_depend_on_arrival(spark):
    rows = [("a", 1, f"copy {i}") for i in range(40)]
    schema = "cve_id string, last_modified int, text string"
    kept = {
        latest_per_key(spark.createDataFrame(rows, schema).orderBy(F.rand(seed)).repartition(n))
        .first()
        .text
        for seed, n in ((1, 1), (2, 3), (3, 7))
    }
    assert len(kept) == 1


def test_latest_per_key_with_a_map_column(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 2, {"x": 2})], "cve_id string, last_modified int, m map<string,int>")
    assert latest_per_key(df).first().m == {"x": 2}
