"""The daily run: feeds to result tables in one session, tables written at the edges only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from riskspark import constants as K
from riskspark.operators import (
    actions,
    clustering,
    key_index,
    master,
    projection,
    quality,
    scoring,
    selection,
    silver,
    upsert,
)
from riskspark.sources.sinks import overwrite_partitions, write_by_strategy, write_snapshot
from riskspark.sources.tables import (
    DateLike,
    at_snapshot,
    read_snapshot,
    read_table,
    snapshot_as_of,
    table_exists,
)


@dataclass(frozen=True)
class Layout:
    """Table folders under one root."""

    root: str

    def silver(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/gold/{name}"


@dataclass(frozen=True)
class RunOptions:
    capacity: int = K.DAILY_CAPACITY
    days: int = K.HORIZON_DAYS
    arrivals: int = K.ARRIVALS_PER_DAY
    first_year: int = K.FIRST_YEAR
    cluster_counts: tuple[int, ...] = K.CLUSTER_COUNTS
    features: clustering.FeatureSettings = field(default_factory=clustering.FeatureSettings)


def load_catalogue(
    spark: SparkSession,
    catalogue: DataFrame,
    tables: Layout,
    date: DateLike,
    full: bool = False,
    first_year: int = K.FIRST_YEAR,
) -> None:
    """Rebuild the catalogue when asked to or when there is none yet, else apply the changes."""
    index = tables.silver("catalogue_keys")
    if full or not table_exists(spark, tables.silver("catalogue")):
        upsert.full_refresh(catalogue, tables.silver("catalogue"), first_year)
        key_index.write_key_index(spark, tables.silver("catalogue"), index, "cve_id", "year")
    else:
        upsert.upsert_partitions(
            spark,
            catalogue,
            tables.silver("catalogue"),
            first_year,
            lineage=tables.silver("catalogue_updates"),
            snapshot_date=date,
            index=index,
        )


def load_exploited(raw: DataFrame, tables: Layout) -> int:
    rows = silver.exploited(raw)
    return overwrite_partitions(rows, tables.silver("exploited"), [], reset=True)


def load_probabilities(
    raw: DataFrame, tables: Layout, date: DateLike, reset_history: bool = False
) -> int:
    """One more day of history; ``reset_history`` drops the days before."""
    rows = silver.probabilities(raw, date)
    return overwrite_partitions(rows, tables.silver("probabilities"), ["score_date"], reset=reset_history)


def build_gold(
    spark: SparkSession,
    tables: Layout,
    date: DateLike,
    options: RunOptions = RunOptions(),
    groups: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, int]:
    """Every result table of one snapshot; returns the rows written per table.

    Each step reads the snapshot that the step before has written. ``groups`` gives the clusters
    (``cve_id``, ``cluster_id``) of the scored records where they are known already; then none are
    sought, and there are no measures and topics of them.
    """
    written = {}

    def publish(name: str, df: DataFrame, small: bool = False, **kwargs) -> None:
        path = tables.gold(name)
        written[name] = write_snapshot(df, path, date, single_file=small, **kwargs)

    def snapshot(name: str) -> DataFrame:
        return read_snapshot(spark, tables.gold(name), date)

    joined = master.build_master(
        silver.conform(read_table(spark, tables.silver("catalogue"))),
        read_table(spark, tables.silver("exploited")),
        snapshot_as_of(read_table(spark, tables.silver("probabilities")), date),
        date,
    )
    publish("master_vulnerabilities", joined, by=["published_year"])
    records = snapshot("master_vulnerabilities")

    publish("quality_summary", quality.summary(records, date), small=True)
    publish("severity_distribution", quality.severity_distribution(records, date), small=True)
    publish("kev_by_year", quality.exploited_by_year(records, date), small=True)

    publish("vulnerability_scores", scoring.score_base(records, date))
    scored = snapshot("vulnerability_scores")

    if groups is None:
        run = clustering.run_clustering(scored, options.cluster_counts, options.features)
        publish("clustering_metrics", run.metrics, small=True)
        publish("cluster_topics", run.topics, small=True)
        assignments = run.assignments
    else:
        assignments = groups(scored)
    publish("vulnerabilities_clustered", clustering.attach_clusters(scored, assignments))

    publish(
        "vulnerability_scores_final", scoring.score_final(snapshot("vulnerabilities_clustered"))
    )
    final = selection.selection_input(snapshot("vulnerability_scores_final"), dedupe=False)

    publish("cluster_risk_summary", selection.cluster_risk_summary(final), small=True)
    written["remediation_recommendations"] = write_by_strategy(
        selection.select_all(final, options.capacity),
        tables.gold("remediation_recommendations"),
        date,
    )
    chosen = at_snapshot(read_table(spark, tables.gold("remediation_recommendations")), date)
    settings = (options.capacity, options.days, options.arrivals)
    publish(
        "strategy_comparison", selection.compare_strategies(final, chosen, *settings), small=True
    )
    publish("simulation_timeseries", projection.project_backlog(final, *settings), small=True)
    publish("remediation_actions", actions.build_actions(final))
    return written
