import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskspark.functions import scores
from riskspark.operators import scoring

AS_OF = "2024-06-01"


@pytest.fixture
def master(spark):
    return spark.createDataFrame(
        [
            ("low", 2.0, 0.1, 0, dt.datetime(2024, 6, 1)),
            ("flagged", 2.0, 0.1, 1, dt.datetime(2010, 1, 1)),
            ("gaps", None, None, None, None),
            ("top", 10.0, 1.0, 1, dt.datetime(2023, 6, 2)),
        ],
        "cve_id string, cvss_score double, epss_percentile double, is_kev int, published timestamp",
    )


def _scores(df):
    return {r.cve_id: r for r in df.collect()}


def test_base_score(master):
    got = _scores(scoring.score_base(master, AS_OF))
    assert got["low"].priority_score == pytest.approx(0.12)
    assert got["flagged"].priority_score == 0.9
    assert got["gaps"].priority_score == 0.0
    assert got["top"].priority_score == 1.0
    assert [got[k].priority_level for k in ("low", "flagged", "gaps", "top")] == [
        "Low",
        "Critical",
        "Low",
        "Critical",
    ]


def test_recency_is_relative_to_the_snapshot(master):
    got = _scores(scoring.score_base(master, AS_OF, recency_weight=0.1))
    assert got["low"].recency_score == 1.0
    assert got["flagged"].recency_score == 0.0
    assert got["gaps"].recency_score == 0.0
    assert got["top"].recency_score == pytest.approx(1 - 365 / 1095)
    assert got["low"].priority_score == pytest.approx(0.22)


def test_percentile_counts_and_not_the_raw_probability(master):
    raw = master.withColumn("epss_score", F.lit(0.99))
    assert _scores(scoring.score_base(raw, AS_OF))["low"].priority_score == pytest.approx(0.12)


def test_text_input_is_cast_or_counts_as_zero(spark):
    df = spark.createDataFrame(
        [("a", "5.0", "x", "1")],
        "cve_id string, cvss_score string, epss_percentile string, is_kev string",
    ).withColumn("published", F.lit(None).cast("date"))
    row = scoring.score_base(df, AS_OF).first()
    assert (row.cvss_score, row.epss_percentile, row.is_kev) == (5.0, 0.0, 1)


def test_level_boundaries(spark):
    df = spark.createDataFrame([(0.8,), (0.79,), (0.6,), (0.4,), (0.39,), (None,)], "s double")
    assert [r[0] for r in df.select(scores.level(F.col("s"))).collect()] == [
        "Critical",
        "High",
        "High",
        "Medium",
        "Low",
        "Low",
    ]


def test_level_of_any_value(spark):
    df = spark.createDataFrame([("0.8",), ("x",), (None,), ("0.1",)], "s string")
    assert [r[0] for r in df.select(scores.level_of_any(F.col("s"))).collect()] == [
        "Critical",
        "Unknown",
        "Unknown",
        "Low",
    ]


@pytest.fixture
def clustered(spark):
    return spark.createDataFrame(
        [
            ("a", 1, 0.5, 1, 0.8, 9.0),
            ("b", 1, 0.4, 0, 0.2, 5.0),
            ("c", 2, 0.6, 0, 0.1, 7.0),
            ("d", 2, 1.45, 0, 0.1, 7.0),
            ("e", None, 0.9, 1, 0.9, 9.0),
        ],
        "cve_id string, cluster_id int, priority_score double, is_kev int, epss_score double,"
        " cvss_score double",
    )


def test_group_adjusted_score(clustered):
    got = _scores(scoring.score_final(clustered))
    assert (got["a"].cluster_size, got["a"].cluster_kev_density) == (2, 0.5)
    assert (got["a"].cluster_epss_max, got["a"].cluster_epss_mean) == (0.8, 0.5)
    assert got["a"].cluster_avg_cvss == 7.0
    assert got["a"].priority_score_final == pytest.approx(0.5 * 1.25 + 0.08)
    assert got["c"].priority_score_final == pytest.approx(0.61)
    assert got["c"].priority_level_final == "High"


def test_final_score_is_clipped(clustered):
    boosted = clustered.withColumn("is_kev", F.lit(1))
    assert _scores(scoring.score_final(boosted))["d"].priority_score_final == 1.5


def test_record_without_a_group(clustered):
    kept = _scores(scoring.score_final(clustered))["e"]
    assert (kept.priority_score_final, kept.priority_level_final) == (0.9, "Critical")
    assert kept.cluster_size is None
    zero = _scores(scoring.score_final(clustered, ungrouped="zero"))["e"]
    assert (zero.priority_score_final, zero.priority_level_final) == (0.0, "Low")
    with pytest.raises(ValueError):
        scoring.score_final(clustered, ungrouped="drop")


def test_long_table_is_not_shuffled_by_group(clustered, capsys):
    scoring.score_final(clustered).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "hashpartitioning(cluster_id" not in plan


def test_nan_is_no_number(spark):
    from pyspark.sql import functions as F

    from riskspark.functions import scores

    df = spark.createDataFrame([("NaN",), ("0.9",), ("x",), (None,), ("inf",)], "v string")
    got = [tuple(r) for r in df.select(scores.number("v"), scores.level_of_any(F.col("v"))).collect()]
    assert got == [(0.0, "Unknown"), (0.9, "Critical"), (0.0, "Unknown"), (0.0, "Unknown"), (float("inf"), "Critical")]
