import math
import datetime as dt

import pytest

from riskspark import schemas
from riskspark.operators import master, quality, silver
from riskspark.sources.tables import snapshot_as_of

DAY = dt.date


@pytest.fixture
def sides(spark):
    catalogue = silver.conform(
        spark.createDataFrame(
            [
                ("CVE-1", ["acme", "x"], ["box"]),
                ("CVE-2", [], []),
                ("CVE-3", ["solo"], None),
            ],
            "cve_id string, cpe_vendors array<string>, cpe_products array<string>",
        )
    )
    exploited = spark.createDataFrame(
        [
            ("CVE-1", "KevVendor", "KevProduct", "n", DAY(2024, 1, 1), "s", "r", "Known", True),
            ("CVE-2", "Listed", "Thing", "n", DAY(2024, 1, 1), "s", "r", "Unknown", False),
        ],
        schemas.EXPLOITED,
    )
    probabilities = spark.createDataFrame(
        [("CVE-1", 0.7, 0.99, DAY(2024, 5, 1)), ("CVE-2", None, 0.5, DAY(2024, 5, 1))],
        schemas.PROBABILITY,
    )
    return catalogue, exploited, probabilities


def _by_key(df):
    return {r.cve_id: r for r in df.collect()}


def test_defaults_and_fallbacks(sides):
    rows = _by_key(master.build_master(*sides, "2024-05-02"))
    one, two, three = rows["CVE-1"], rows["CVE-2"], rows["CVE-3"]
    assert (one.is_kev, one.is_ransomware, one.epss_score) == (1, True, 0.7)
    assert (one.primary_vendor, one.primary_product) == ("acme", "box")
    assert one.epss_score_date == DAY(2024, 5, 1)
    assert (two.primary_vendor, two.primary_product) == ("Listed", "Thing")
    assert (two.epss_score, two.epss_percentile) == (0.0, 0.5)
    assert (three.is_kev, three.is_ransomware, three.epss_score) == (0, False, 0.0)
    assert (three.primary_vendor, three.primary_product) == ("solo", None)
    assert {r.snapshot_date for r in rows.values()} == {DAY(2024, 5, 2)}


def test_duplicates_in_side_tables_do_not_multiply_rows(sides):
    catalogue, exploited, probabilities = sides
    again = exploited.unionByName(exploited)
    older = probabilities.selectExpr(
        "cve_id", "0.1D AS epss_score", "epss_percentile", "date_sub(score_date, 1) AS score_date"
    )
    built = master.build_master(catalogue, again, probabilities.unionByName(older), "2024-05-02")
    rows = built.collect()
    assert len(rows) == 3
    assert _by_key(built)["CVE-1"].epss_score == 0.7


def test_master_never_uses_a_future_probability(sides, spark):
    catalogue, exploited, _ = sides
    history = spark.createDataFrame(
        [
            ("CVE-1", 0.1, 0.5, DAY(2026, 5, 10)),
            ("CVE-1", 0.3, 0.5, DAY(2026, 5, 14)),
            ("CVE-1", 0.9, 0.5, DAY(2026, 5, 16)),
        ],
        schemas.PROBABILITY,
    )
    built = master.build_master(
        catalogue, exploited, snapshot_as_of(history, "2026-05-14"), "2026-05-14"
    )
    assert _by_key(built)["CVE-1"].epss_score == 0.3


@pytest.fixture
def profiled(spark):
    return spark.createDataFrame(
        [
            ("CVE-1", 9.8, 0.95, ["CWE-1"], ["a"], 1, DAY(2023, 1, 1), "CRITICAL"),
            ("CVE-2", None, 0.0, [], [], 0, None, None),
            ("CVE-3", 5.0, 0.75, None, None, 1, DAY(2024, 1, 1), "MEDIUM"),
            ("CVE-4", 5.0, 0.0, ["CWE-2"], ["b"], 0, None, "MEDIUM"),
        ],
        "cve_id string, cvss_score double, epss_score double, cwes array<string>,"
        " cpe_vendors array<string>, is_kev int, kev_date_added date, cvss_severity string",
    )


def test_profile(profiled):
    row = quality.summary(profiled, "2024-05-02").first().asDict()
    assert row == {
        "snapshot_date": DAY(2024, 5, 2),
        "row_count": 4,
        "distinct_cve_count": 4,
        "pct_null_cvss": 25.0,
        "pct_null_epss": 50.0,
        "pct_null_cwes": 50.0,
        "pct_null_cpe": 50.0,
        "pct_epss_gt_07": 50.0,
        "pct_epss_gt_09": 25.0,
        "mean_epss": pytest.approx(0.425),
        "median_epss": 0.0,
        "kev_count": 2,
        "nvd_kev_intersection": 2,
        "nvd_epss_intersection": 2,
        "nvd_kev_epss_intersection": 2,
    }
    complete = quality.completeness(quality.summary(profiled, "2024-05-02")).first()
    assert complete.cvss_complete == 75.0


def test_profile_of_nothing(profiled):
    row = quality.summary(profiled.limit(0), "2024-05-02").first()
    assert (row.row_count, row.pct_null_cvss, row.median_epss) == (0, None, None)


def test_distributions(profiled, rows):
    day = DAY(2024, 5, 2)
    assert rows(quality.severity_distribution(profiled, day), "cvss_severity", "cve_count") == [
        ("CRITICAL", 1),
        ("MEDIUM", 2),
        (None, 1),
    ]
    assert rows(quality.exploited_by_year(profiled, day), "kev_year", "kev_count") == [
        (2023, 1),
        (2024, 1),
    ]


def test_order_statistic_over_a_million_values_in_bounded_memory(spark):
    df = spark.range(1_000_003).selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE pmod(xxhash64(id), 1000000007) / 997D END AS x")
    values = sorted(r.x for r in df.collect() if r.x is not None)
    for share in (0.5, 0.001, 0.9):
        assert quality.order_statistic(df, "x", share, held=2_000) == values[math.ceil(share * len(values)) - 1]


def test_order_statistic_of_ties_and_nothing(spark):
    def of(*values, **kwargs):
        return quality.order_statistic(spark.createDataFrame([(v,) for v in values], "x double"), "x", **kwargs)

    assert of() is None and of(None, float("nan")) is None
    assert of(3.0) == 3.0 and of(1.0, 2.0) == 1.0 and of(1.0, 2.0, 3.0) == 2.0
    hot = [0.0] * 900 + [i / 7 for i in range(100)] + [1e300, -1e300]
    assert of(*hot, held=3) == 0.0 and of(*hot, held=3, share=0.95) == sorted(hot)[math.ceil(0.95 * 1002) - 1]
