import json

import pytest

from riskspark.operators import clustering, silver
from riskspark.plans import daily
from riskspark.plans.serving import EXPORT_COLUMNS, Serving, export
from riskspark.sources import feeds
from riskspark.sources.tables import read_table

DATE = "2024-06-01"
OPTIONS = daily.RunOptions(
    capacity=4,
    days=3,
    arrivals=2,
    cluster_counts=(2, 3),
    features=clustering.FeatureSettings(40, 2, 5, 2, 4),
)


def _record(i, text, year=2023):
    return {
        "cve": {
            "id": f"CVE-{i}",
            "published": f"{year}-03-01T00:00:00.000",
            "lastModified": "2024-01-01T00:00:00.000",
            "descriptions": [{"lang": "en", "value": text}],
            "metrics": {"cvssMetricV31": [{"cvssData": {"baseScore": i % 10 + 0.5, "baseSeverity": "HIGH"}}]},
            "weaknesses": [{"description": [{"lang": "en", "value": f"CWE-{i % 2}"}]}],
            "configurations": [
                {"nodes": [{"cpeMatch": [{"criteria": f"cpe:2.3:a:vendor{i % 3}:product:1"}]}]}
            ],
        }
    }


def _write_feed(path, records):
    path.mkdir()
    (path / "feed.json").write_text(json.dumps({"vulnerabilities": records}, indent=1))
    return str(path)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Two daily runs: a full load, then a change to one record."""
    base = tmp_path_factory.mktemp("daily")
    texts = ["memory buffer overflow pointer", "database query injection statement"]
    feed = _write_feed(base / "feed", [_record(i, texts[i % 2], 2022 + i % 2) for i in range(24)])
    (base / "listed.csv").write_text(
        "cveID,vendorProject,product,vulnerabilityName,dateAdded,shortDescription,"
        "requiredAction,knownRansomwareCampaignUse\nCVE-3,V,P,N,2024-01-01,s,r,Known\n"
    )
    (base / "p.csv").write_text(
        "#c\ncve,epss,percentile\n" + "".join(f"CVE-{i},{i / 30},{i / 30}\n" for i in range(24))
    )
    tables = daily.Layout(str(base / "lake"))
    catalogue = silver.catalogue(feeds.read_catalogue_feed(spark, feed))
    daily.load_catalogue(spark, catalogue, tables, "2024-05-31")
    daily.load_exploited(feeds.read_exploited_csv(spark, str(base / "listed.csv")), tables)
    raw = feeds.read_probability_csv(spark, str(base / "p.csv"))
    daily.load_probabilities(raw, tables, "2024-05-30")
    daily.build_gold(spark, tables, "2024-05-31", OPTIONS)

    change = _write_feed(base / "change", [_record(5, "database query changed", 2024)])
    changed = silver.catalogue(feeds.read_catalogue_feed(spark, change))
    daily.load_catalogue(spark, changed, tables, DATE)
    daily.load_probabilities(raw, tables, DATE)
    written = daily.build_gold(spark, tables, DATE, OPTIONS)
    return tables.root, written


def test_rows_written(root):
    _, written = root
    full = {"master_vulnerabilities", "vulnerability_scores", "vulnerabilities_clustered"}
    assert {written[name] for name in full | {"vulnerability_scores_final"}} == {24}
    assert written["quality_summary"] == 1
    assert written["strategy_comparison"] == 5
    assert written["simulation_timeseries"] == 15
    assert written["clustering_metrics"] == 2
    assert written["remediation_actions"] == 3


def test_change_moved_the_record(spark, root):
    catalogue = read_table(spark, daily.Layout(root[0]).silver("catalogue"))
    assert [tuple(r) for r in catalogue.where("cve_id = 'CVE-5'").select("description", "year").collect()] == [
        ("database query changed", 2024)
    ]
    assert catalogue.count() == 24


def test_history_has_both_days(spark, root):
    history = read_table(spark, daily.Layout(root[0]).silver("probabilities"))
    assert history.select("score_date").distinct().count() == 2


def test_serving(spark, root):
    serve = Serving(spark, root[0])
    assert [str(r[0]) for r in serve.available_snapshots().collect()] == [DATE, "2024-05-31"]
    assert serve.overview_stats(DATE).count() == 24
    top = serve.top_n_vulnerabilities(5, snapshot_date=DATE).collect()
    assert len(top) == 5
    assert [r.priority_score_final for r in top] == sorted(
        (r.priority_score_final for r in top), reverse=True
    )
    flagged = serve.top_n_vulnerabilities(5, only_kev=True, vendor="VENDOR0").collect()
    assert [r.cve_id for r in flagged] == ["CVE-3"]
    assert serve.vulnerability("CVE-3", DATE).first().is_kev == 1
    assert serve.data_quality_latest().first().row_count == 24
    assert serve.data_quality_summary("1999-01-01").count() == 1
    assert serve.simulation_timeseries(DATE).count() == 15
    coverage = [r.kev_coverage for r in serve.strategy_comparison(DATE).collect()]
    assert coverage == sorted(coverage, reverse=True) and len(coverage) == 5
    assert serve.remediation_actions(2, DATE).count() == 2


def test_recommendations(spark, root):
    serve = Serving(spark, root[0])
    kev = serve.remediation_recommendations("kev_first", 1, DATE).collect()
    assert [r.cve_id for r in kev] == ["CVE-3"]
    assert serve.remediation_recommendations("top_priority", 50, DATE).count() == 4
    assert serve.remediation_recommendations("unheard_of", 50, DATE).count() == 0


def test_cluster_pages(spark, root):
    pages = Serving(spark, root[0]).cluster_overview(DATE).collect()
    assert sum(p.cluster_size for p in pages) == 24
    density = [(p.kev_density, p.cluster_size) for p in pages]
    assert density == sorted(density, reverse=True)
    assert all(p.top_keywords and p.topic_vendors for p in pages)


def test_rerun_of_a_day_replaces_it(spark, root):
    tables = daily.Layout(root[0])
    again = daily.build_gold(spark, tables, DATE, OPTIONS)
    assert again["vulnerability_scores_final"] == 24
    assert Serving(spark, root[0]).overview_stats(DATE).count() == 24


def test_exports(spark, root, tmp_path):
    serve = Serving(spark, root[0])
    path = str(tmp_path / "plan")
    assert export(serve.remediation_actions(2, DATE), "remediation_plan", path) == 2
    back = spark.read.option("header", True).csv(path)
    assert back.columns == EXPORT_COLUMNS["remediation_plan"]
    assert all(len(r.top_cves.split("|")) == 5 for r in back.collect())
