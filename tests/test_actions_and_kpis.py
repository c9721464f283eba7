import math

import pytest
from pyspark.sql import functions as F

from riskspark.functions.predicates import matches
from riskspark.functions.scores import percent_if_ratio
from riskspark.operators import actions, kpis

RECORDS = [
    ("CVE-1", 0.9, 1, 0.5, "acme", "box"),
    ("CVE-2", 0.8, 0, 0.1, "acme", "box"),
    ("CVE-3", 0.7, 0, 0.2, "acme", "box"),
    ("CVE-4", 0.6, 1, 0.9, "acme", "lid"),
    ("CVE-5", 0.5, 0, 0.3, None, None),
    ("CVE-6", 0.5, 0, 0.3, None, None),
]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(
        RECORDS,
        "cve_id string, priority_score_final double, is_kev int, epss_score double,"
        " primary_vendor string, primary_product string",
    )


def test_actions(records):
    got = actions.build_actions(records).collect()
    assert [(r.primary_vendor, r.primary_product) for r in got] == [
        ("acme", "box"),
        ("unknown", "unknown"),
        ("acme", "lid"),
    ]
    box = got[0]
    assert (box.n_cves, box.n_kev, box.max_priority, box.max_epss) == (3, 1, 0.9, 0.5)
    assert box.sum_priority == pytest.approx(2.4)
    assert box.mean_epss == pytest.approx(0.8 / 3)
    assert box.effort_proxy == pytest.approx(math.log1p(3))
    assert box.action_score == pytest.approx(2.4 / math.log1p(3))
    assert box.top_cves == ["CVE-1", "CVE-2", "CVE-3"]
    assert got[1].top_cves == ["CVE-5", "CVE-6"]


def test_id_lists_are_bounded_and_ordered(records):
    assert actions.build_actions(records, top_ids=2).first().top_cves == ["CVE-1", "CVE-2"]


def test_top_actions_equal_the_head_of_all(records):
    assert actions.top_actions(records, 2).collect() == actions.build_actions(records).take(2)


def test_group_without_ids_has_no_effort(records):
    nameless = records.withColumn("cve_id", F.lit(None).cast("string"))
    row = actions.build_actions(nameless).first()
    assert (row.n_cves, row.effort_proxy, row.action_score, row.top_cves) == (0, 0.0, 0.0, [])


def test_actions_shuffle_aggregates_and_heads_only(records, capsys):
    actions.build_actions(records).explain()
    plan = capsys.readouterr().out
    assert "partial_count" in plan and "WindowGroupLimit" in plan


def test_overview(spark):
    df = spark.createDataFrame(
        [(1, 0.8, "Critical"), (0, 0.7, "Low"), (0, 0.1, "Low"), (1, 0.9, "High")],
        "is_kev int, epss_score double, priority_level_final string",
    )
    assert tuple(kpis.overview(df).first()) == (4, 2, 25.0, 2)
    assert tuple(kpis.overview(df.limit(0)).first()) == (0, 0, 0.0, 0)


def test_fixed_domain(spark):
    df = spark.createDataFrame([("high",), ("HIGH",), ("odd",), (None,)], "cvss_severity string")
    assert [(r.severity, r.n) for r in kpis.fixed_domain_counts(df).collect()] == [
        ("CRITICAL", 0),
        ("HIGH", 2),
        ("MEDIUM", 0),
        ("LOW", 0),
        ("NONE", 0),
    ]


def test_share_of_max(spark):
    df = spark.createDataFrame([(2.0,), (1.0,), (-1.0,), (None,)], "s double")
    assert [r.share_of_max for r in kpis.share_of_max(df, "s").collect()][:3] == [100.0, 50.0, 0.0]
    zeros = spark.createDataFrame([(0.0,)], "s double")
    assert kpis.share_of_max(zeros, "s").first().share_of_max == 0.0


def test_settings(spark):
    comparison = spark.createDataFrame([(None, 0), (20, 0)], "daily_capacity int, simulation_days int")
    series = spark.createDataFrame([(1, 7), (9, 7)], "day int, daily_capacity int")
    assert tuple(kpis.run_settings(comparison, series).first()) == (20, 9)
    assert tuple(kpis.run_settings(comparison.limit(0), series.limit(0)).first()) == (50, 30)
    assert tuple(kpis.run_settings(comparison.limit(0), series).first()) == (7, 9)


def test_lookup_and_detail(records):
    assert kpis.lookup(records, "CVE-4").first().primary_product == "lid"
    assert kpis.lookup(records, "nope").count() == 0
    listed = records.select(F.sequence(F.lit(1), F.lit(30)).alias("top_cves"))
    assert len(kpis.detail_columns(listed).first().top_cves) == 10


def test_percent_if_ratio(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (42.0,)], "v double")
    assert [r[0] for r in df.select(percent_if_ratio(F.col("v"))).collect()] == [50.0, 100.0, 42.0]


@pytest.mark.parametrize(
    "filters, want",
    [
        ({}, ["a", "b", "c"]),
        ({"level": "All", "vendor": ""}, ["a", "b", "c"]),
        ({"level": "High"}, ["b"]),
        ({"only_flagged": True}, ["a"]),
        ({"vendor": "CM"}, ["a"]),
        ({"vendor": "%"}, ["c"]),
        ({"vendor": "a%e", "wildcards": True}, ["a"]),
        ({"min_probability": 0.5}, ["a", "b"]),
        ({"only_flagged": True, "level": "High"}, []),
    ],
)
def test_filters(spark, filters, want):
    df = spark.createDataFrame(
        [("a", "Low", 1, "Acme", 0.9), ("b", "High", 0, None, 0.5), ("c", "Low", 0, "50% off", 0.1)],
        "id string, priority_level_final string, is_kev int, primary_vendor string, epss_score double",
    )
    assert sorted(r.id for r in df.where(matches(**filters)).collect()) == want
