"""Reads behind the result pages (T7-T13, P14-P18). Each returns a DataFrame for one snapshot.

A missing requested snapshot falls back to the latest. A table without any snapshot, like any
other error, is raised and not shown as "no rows".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskspark.functions.predicates import matches
from riskspark.operators.kpis import lookup
from riskspark.operators.ranking import sort_columns, top_k
from riskspark.plans.daily import Layout
from riskspark.sources.sinks import export_csv
from riskspark.sources.tables import (
    DateLike,
    at_snapshot,
    available_snapshots,
    find_snapshot,
    read_snapshot,
    read_table,
    resolve_snapshot,
    table_exists,
)

# fixed values: display order of each strategy's recommendations
RECOMMENDATION_ORDER = {
    "top_priority": ["-priority_score_final", "-epss_score", "cve_id"],
    "high_epss": ["-epss_score", "-priority_score_final", "cve_id"],
    "cluster_based": ["-priority_score_final", "-is_kev", "-epss_score", "cve_id"],
    "kev_first": ["-is_kev", "-priority_score_final", "-epss_score", "cve_id"],
    "hybrid": ["-is_kev", "-priority_score_final", "-epss_score", "cve_id"],
}
# fixed values: columns of each CSV export; those a table lacks are left out
EXPORT_COLUMNS = {
    "vulnerabilities": [
        "cve_id",
        "priority_score_final",
        "priority_level_final",
        "cvss_score",
        "cvss_severity",
        "epss_score",
        "is_kev",
        "primary_vendor",
        "primary_product",
        "published",
    ],
    "remediation_plan": [
        "primary_vendor",
        "primary_product",
        "n_cves",
        "n_kev",
        "max_priority",
        "mean_epss",
        "action_score",
        "max_epss",
        "sum_priority",
        "effort_proxy",
        "top_cves",
    ],
    "capacity_strategy": [
        "cve_id",
        "priority_score_final",
        "epss_score",
        "is_kev",
        "cvss_score",
        "cluster_id",
        "primary_vendor",
        "primary_product",
        "priority_level_final",
        "cvss_severity",
    ],
}
OVERVIEW_COLUMNS = ["cve_id", "is_kev", "epss_score", "priority_level_final", "cvss_severity"]
CLUSTERS_BY_RISK = ["-kev_density", "-cluster_size", "cluster_id"]


def top_records(df: DataFrame, n: int = 50, where: Column | None = None) -> DataFrame:
    """Best n records of those that pass the filters."""
    kept = df if where is None else df.where(where)
    return top_k(kept, ["-priority_score_final", "cve_id"], n)


def recommendations(df: DataFrame, strategy: str, n: int = 50) -> DataFrame:
    """Best n of a strategy's selection in its own order; nothing for an unknown strategy."""
    if strategy not in RECOMMENDATION_ORDER:
        return df.limit(0)
    rows = df.where(F.col("strategy") == strategy)
    return top_k(rows, RECOMMENDATION_ORDER[strategy], n)


def clusters_with_topics(risk: DataFrame, topics: DataFrame | None) -> DataFrame:
    """Risk and topics per cluster and snapshot, riskiest first; risk alone without topics."""
    if topics is None:
        shown = risk.where(F.col("cluster_size") > 0)
    else:
        described = topics.select(
            "cluster_id",
            "snapshot_date",
            "top_keywords",
            F.col("top_vendors").alias("topic_vendors"),
            "top_cwes",
        )
        shown = risk.join(described, ["cluster_id", "snapshot_date"], "left")
    return shown.orderBy(*sort_columns(CLUSTERS_BY_RISK))


def riskiest_clusters(overview: DataFrame, n: int = 5) -> DataFrame:
    return top_k(overview, CLUSTERS_BY_RISK, n)


def export(df: DataFrame, view: str, path: str) -> int:
    """One of the named exports as CSV."""
    return export_csv(df, path, EXPORT_COLUMNS[view])


class Serving:
    """The result tables under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.tables = Layout(root)

    def _snapshot(self, name: str, date: DateLike | None) -> DataFrame:
        path = self.tables.gold(name)
        found = find_snapshot(self.spark, path, date)
        if found is None:
            return read_table(self.spark, path).limit(0)
        return read_snapshot(self.spark, path, found, merge_schema=True)

    def overview_stats(self, date: DateLike | None = None) -> DataFrame:
        return self._snapshot("vulnerability_scores_final", date).select(OVERVIEW_COLUMNS)

    def top_n_vulnerabilities(
        self,
        n: int = 50,
        priority_level: str | None = None,
        only_kev: bool = False,
        vendor: str | None = None,
        snapshot_date: DateLike | None = None,
        min_epss: float = 0.0,
    ) -> DataFrame:
        rows = self._snapshot("vulnerability_scores_final", snapshot_date)
        return top_records(rows, n, matches(priority_level, only_kev, vendor, min_epss))

    def vulnerability(self, cve_id: str, snapshot_date: DateLike | None = None) -> DataFrame:
        return lookup(self._snapshot("vulnerability_scores_final", snapshot_date), cve_id)

    def cluster_overview(self, snapshot_date: DateLike | None = None) -> DataFrame:
        risk = self._snapshot("cluster_risk_summary", snapshot_date)
        found = risk.select("snapshot_date").first()
        if found is None:
            return risk
        path = self.tables.gold("cluster_topics")
        topics = None
        if table_exists(self.spark, path):
            topics = read_snapshot(self.spark, path, found[0])
        return clusters_with_topics(risk, topics)

    def strategy_comparison(self, snapshot_date: DateLike | None = None) -> DataFrame:
        rows = self._snapshot("strategy_comparison", snapshot_date)
        return rows.orderBy(F.desc("kev_coverage"), "strategy")

    def remediation_recommendations(
        self, strategy: str, top_n: int = 50, snapshot_date: DateLike | None = None
    ) -> DataFrame:
        chosen = read_table(self.spark, self.tables.gold("remediation_recommendations"))
        rows = chosen.where(F.col("strategy") == strategy)
        found = resolve_snapshot(rows, snapshot_date)
        at = rows.limit(0) if found is None else at_snapshot(rows, found)
        return recommendations(at, strategy, top_n)

    def remediation_actions(
        self, top_n: int = 50, snapshot_date: DateLike | None = None
    ) -> DataFrame:
        rows = self._snapshot("remediation_actions", snapshot_date)
        return top_k(rows, ["-action_score", "primary_vendor", "primary_product"], top_n)

    def data_quality_summary(self, snapshot_date: DateLike | None = None) -> DataFrame:
        return self._snapshot("quality_summary", snapshot_date)

    def data_quality_latest(self) -> DataFrame:
        return self.data_quality_summary(None)

    def simulation_timeseries(self, snapshot_date: DateLike | None = None) -> DataFrame:
        return self._snapshot("simulation_timeseries", snapshot_date).orderBy("strategy", "day")

    def available_snapshots(self) -> DataFrame:
        return available_snapshots(
            read_table(self.spark, self.tables.gold("vulnerability_scores_final"))
        )
