import datetime as dt
import gzip
import json

import pytest

from riskspark import schemas
from riskspark.operators import silver
from riskspark.sources import feeds


def _metric(score, severity, nested=True):
    if nested:
        return [{"cvssData": {"baseScore": score, "baseSeverity": severity}}]
    return [{"cvssData": {"baseScore": score}, "baseSeverity": severity}]


def _cpe(*names):
    return [{"nodes": [{"cpeMatch": [{"criteria": name} for name in names]}]}]


def _weakness(*values):
    return [{"description": [{"lang": "en", "value": value}]} for value in values]


DOCUMENT = {
    "vulnerabilities": [
        {
            "cve": {
                "id": "CVE-2031-7001",
                "published": "2031-06-07T08:09:10.000",
                "lastModified": "2031-07-01T00:00:00.000",
                "descriptions": [{"lang": "en", "value": "lamp"}, {"lang": "fr", "value": "lampe"}],
                "metrics": {
                    "cvssMetricV30": _metric(2.2, "LOW"),
                    "cvssMetricV31": _metric(5.6, "MEDIUM"),
                },
                "weaknesses": _weakness("CWE-12", "CWE-345", "CWE-12", "NVD-CWE-noinfo"),
                "configurations": _cpe(
                    "cpe:2.3:h:lumen:lamp:3:*", "cpe:2.3:h:lumen:shade:4:*", "cpe:2.3:h:ikon:lamp:4:*"
                ),
                "references": [{"url": "u", "tags": ["Exploit"]}, {"url": "v"}, {"url": "w", "tags": []}],
            }
        },
        {
            "cve": {
                "id": "\tcve-2031-7002",
                "published": "2031-01-01T00:00:00.000",
                "metrics": {"cvssMetricV2": _metric(4.4, "MEDIUM", nested=False)},
                "descriptions": [],
                "configurations": [],
                "references": [],
            }
        },
        {"cve": {"id": "CVE-2031-7003", "published": "soon"}},
        {
            "cve": {
                "id": "CVE-2031-7004",
                "published": "1999-12-31T23:59:59.000",
                "metrics": {"cvssMetricV40": [], "cvssMetricV31": _metric(0.0, "NONE")},
                "weaknesses": _weakness("unsure"),
                "configurations": _cpe("cpe", "cpe:2.3:o:kern"),
            }
        },
    ]
}


@pytest.fixture(params=["plain", "gzip"])
def feed(spark, tmp_path, request):
    text = json.dumps(DOCUMENT, indent=2)
    if request.param == "plain":
        (tmp_path / "feed.json").write_text(text)
    else:
        (tmp_path / "feed.json.gz").write_bytes(gzip.compress(text.encode()))
    return feeds.read_catalogue_feed(spark, str(tmp_path))


def _row(feed, number):
    return silver.catalogue(feed).where(f"cve_id LIKE '%CVE-2031-{number}'").first()


def test_nested_record_becomes_one_typed_row(feed):
    df = silver.catalogue(feed)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in schemas.CATALOGUE
    ]
    assert df.count() == 4
    full = _row(feed, 7001)
    assert (full.cvss_score, full.cvss_severity, full.cvss_version) == (5.6, "MEDIUM", "v3.1")
    assert (full.published, full.published_year) == (dt.datetime(2031, 6, 7, 8, 9, 10), 2031)
    assert full.description == "lamp"
    assert full.cwes == ["CWE-12", "CWE-345"]
    assert full.cpe_vendors == ["lumen", "ikon"]
    assert full.cpe_products == ["lamp", "shade"]
    assert full.cpe_versions == ["3", "4"]
    assert (full.reference_count, full.has_exploit_reference) == (3, True)


def test_oldest_metric_keeps_its_severity_beside_the_data(feed):
    row = _row(feed, 7002)
    assert (row.cvss_score, row.cvss_severity, row.cvss_version) == (4.4, "MEDIUM", "v2")
    assert (row.description, row.cpe_vendors, row.reference_count) == (None, [], 0)
    assert row.has_exploit_reference is False


def test_missing_parts_are_null_not_errors(feed):
    row = _row(feed, 7003)
    assert (row.published, row.published_year, row.cvss_score, row.cvss_version) == (None,) * 4
    assert (row.cwes, row.cpe_vendors) == (None, None)
    assert (row.reference_count, row.has_exploit_reference) == (0, False)


def test_empty_metric_list_falls_through_and_short_names_have_no_product(feed):
    row = _row(feed, 7004)
    assert (row.cvss_score, row.cvss_severity, row.cvss_version) == (0.0, "NONE", "v3.1")
    assert row.cwes == []
    assert row.cpe_vendors == [None, "kern"]
    assert row.cpe_products == [None]


def test_nested_lists_are_whole(spark):
    configurations = [
        {"nodes": [{"cpeMatch": [{"criteria": f"cpe:2.3:a:v{c}:p{m}:{n}"} for m in range(210)]} for n in range(22)]}
        for c in range(21)
    ]
    record = {"id": "X", "configurations": configurations}
    feed = spark.createDataFrame([{"vulnerabilities": [{"cve": record}]}], schemas.FEED)
    row = silver.catalogue(feed).first()
    assert (len(row.cpe_vendors), len(row.cpe_products), len(row.cpe_versions)) == (21, 210, 22)


def test_year_window(spark):
    df = spark.createDataFrame([("a", 2014), ("b", 2015), ("c", 2024)], "cve_id string, published_year long")
    assert [r.cve_id for r in silver.within_window(df, 2015).orderBy("cve_id").collect()] == ["b", "c"]


def test_exploited_list(spark, tmp_path):
    (tmp_path / "list.csv").write_text(
        "cveID,vendorProject,product,vulnerabilityName,dateAdded,shortDescription,"
        "requiredAction,knownRansomwareCampaignUse\n"
        ' cve-2024-0001 ,Acme,Box,Bug,2024-01-05,"two\nlines, ""quoted""",patch,Known\n'
        "CVE-2024-0002,Acme,Box,Bug,05/01/2024,text,patch,Unknown\n"
        "CVE-2024-0003,Acme,Box,Bug,2024-01-07,text,patch,\n"
    )
    df = silver.exploited(feeds.read_exploited_csv(spark, str(tmp_path)))
    rows = {r.cve_id: r for r in df.collect()}
    assert df.schema.names == schemas.EXPLOITED.names
    assert rows["CVE-2024-0001"].kev_date_added == dt.date(2024, 1, 5)
    assert rows["CVE-2024-0001"].short_description == 'two\nlines, "quoted"'
    assert rows["CVE-2024-0002"].kev_date_added is None
    assert [rows[f"CVE-2024-000{i}"].is_ransomware for i in (1, 2, 3)] == [True, False, False]


def test_probabilities(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "#model_version:v1,score_date:2024-05-01\ncve,epss,percentile\n"
        "CVE-2024-0001,0.5,0.95\ncve-2024-0002,0.01,0.10\nCVE-2024-0003,,0.50\nCVE-4,n/a,1\n"
    )
    df = silver.probabilities(feeds.read_probability_csv(spark, str(tmp_path)), "2024-05-01")
    got = [tuple(r) for r in df.orderBy("cve_id").collect()]
    day = dt.date(2024, 5, 1)
    assert got == [
        ("CVE-2024-0001", 0.5, 0.95, day),
        ("CVE-2024-0002", 0.01, 0.10, day),
        ("CVE-2024-0003", None, 0.5, day),
        ("CVE-4", None, 1.0, day),
    ]


def test_conform_adds_missing_columns(spark):
    df = silver.conform(spark.createDataFrame([("a", 2024)], "cve_id string, published_year long"))
    assert df.schema == schemas.CATALOGUE
    assert df.first().cwes is None


def test_a_missing_inner_list_keeps_the_others(spark):
    from riskspark.functions import nested

    schema = (
        "configurations array<struct<nodes: array<struct<cpeMatch: array<struct<criteria: string>>>>>>,"
        " weaknesses array<struct<description: array<struct<value: string>>>>"
    )
    found = [([([("cpe:a",)],), (None,)],), (None,)]
    df = spark.createDataFrame([(found, [([("CWE-1",)],), (None,)]), (None, None)], schema)
    rows = df.select(nested.platform_names().alias("p"), nested.weakness_ids().alias("w")).collect()
    assert [tuple(r) for r in rows] == [(["cpe:a"], ["CWE-1"]), (None, None)]
