"""Every named query against its SQL counterpart, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as contract
from riskspark.plans import views
from riskspark.plans.oracle import ORACLE_SQL
from riskspark.plans.queries import QUERIES
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
INVARIANT_ONLY = {"kmeans_clusters", "kmeans_metrics", "cluster_topics", "embedding_clusters"}


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, connection, name):
    problem = compare(spark, connection, name, SF_DIR)
    if name in ("top_n_filtered",) and problem == "no rows on either side":
        return
    assert problem is None


def test_every_query_has_sql_or_is_checked_by_invariants():
    assert set(QUERIES) - set(ORACLE_SQL) == INVARIANT_ONLY


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 50
    assert [r.action_score for r in rows] == sorted((r.action_score for r in rows), reverse=True)


def test_clusters_cover_all_documents(spark):
    documents = views.table(spark, SF_DIR, "documents").count()
    got = contract.queries()["kmeans_clusters"](spark, SF_DIR)
    assert got.count() == documents
    assert {r.cluster_id for r in got.select("cluster_id").distinct().collect()} <= set(range(12))


PLANNED = [
    name
    for name in sorted(QUERIES)
]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_have_no_cross_join_and_no_python(spark, capsys, name):
    contract.queries()[name](spark, SF_DIR).explain("extended")
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"(Python|Pandas|Arrow)\w*(UDF|Eval|Exec)", plan)


def test_scan_reads_only_the_needed_columns(spark, capsys):
    contract.queries()["severity_fixed_domain"](spark, SF_DIR).explain()
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*)", capsys.readouterr().out)
    lines = next(s for s in schemas if "l_partkey" in s)
    assert lines.startswith("struct<l_partkey:bigint,l_quantity:double>")
