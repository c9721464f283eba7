"""One named query per operator group, over the test tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskspark import constants as K
from riskspark.functions import scores
from riskspark.functions.predicates import matches
from riskspark.functions.text import clean_text, words
from riskspark.operators import (
    actions,
    clustering,
    key_index,
    kpis,
    master,
    measures,
    projection,
    quality,
    scoring,
    selection,
    silver,
    terms,
    upsert,
)
from riskspark.operators.dedupe import latest_per_key
from riskspark.operators.ranking import top_values
from riskspark.plans import daily, serving, views
from riskspark.plans.views import DOC_DATE, LINE_DATE
from riskspark.sources import feeds, sinks
from riskspark.sources.tables import (
    among,
    at_snapshot,
    available_snapshots,
    find_snapshot,
    read_merged_snapshots as merged_snapshots,
    read_snapshot,
    read_table,
    snapshot_as_of,
)
from riskspark.sources.workdir import scratch_path, stage_table


def _joined(df: DataFrame, *lists: str, in_order: bool = False) -> DataFrame:
    """Array columns as text, so that result rows compare by value."""

    def text(name: str):
        return F.array_join(name if in_order else F.sort_array(name), ",", "<null>")

    return df.withColumns({name: text(name) for name in lists})


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Sums and means of doubles depend on the order of addition in their last digits."""
    return df.withColumns({name: F.round(name, 6) for name in names})


# --- inputs ----------------------------------------------------------------------------


def _line_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_base(views.line_facts(spark, sf_dir), LINE_DATE)


def _line_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_final(_line_scored(spark, sf_dir))


#: What selections show of a record beside what they choose by.
SHOWN = ("priority_level_final", "cvss_severity", "primary_vendor", "primary_product")


def _line_selection(spark: SparkSession, sf_dir: str, shown: Sequence[str] = ()) -> DataFrame:
    """One row per record with what selections choose by, and the columns that they show."""
    final = _line_final(spark, sf_dir).select(
        "cve_id",
        "cluster_id",
        "priority_score_final",
        "epss_score",
        "is_kev",
        "cvss_score",
        *shown,
    )
    return selection.selection_input(final)


def _line_selectable(spark: SparkSession, sf_dir: str, shown: Sequence[str] = SHOWN) -> DataFrame:
    """The final scores as the written table that selection reads several times."""
    return stage_table(_line_selection(spark, sf_dir, shown), "scores-final")


def _doc_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.build_master(
        views.doc_catalogue(spark, sf_dir),
        views.doc_exploited(spark, sf_dir),
        snapshot_as_of(views.probability_history(spark, sf_dir), DOC_DATE),
        DOC_DATE,
    )


def _written_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master as profiles read it: written once, each base table scanned once."""
    return stage_table(_doc_master(spark, sf_dir), "master")


def _feed_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as nested JSON documents and read back through the feed reader."""
    path = scratch_path(spark, "feed")
    views.order_feed_lines(spark, sf_dir).write.text(path)
    return silver.catalogue(feeds.read_catalogue_feed(spark, path, one_document_per_file=False))


# --- scoring and actions -----------------------------------------------------------------


def remediation_actions_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _line_scored(spark, sf_dir).withColumnRenamed(
        "priority_score", "priority_score_final"
    )
    top = actions.top_actions(scored, 50)
    return _rounded(
        _joined(top, "top_cves", in_order=True),
        "sum_priority",
        "mean_epss",
        "effort_proxy",
        "action_score",
    )


def remediation_actions_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = actions.build_actions(_line_final(spark, sf_dir))
    return _rounded(
        _joined(kpis.detail_columns(every), "top_cves", in_order=True),
        "max_priority",
        "sum_priority",
        "mean_epss",
        "effort_proxy",
        "action_score",
    )


def action_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of every action as a card shows them: the first three."""
    every = actions.build_actions(_line_final(spark, sf_dir))
    shown = kpis.detail_columns(every, shown=3)
    return _joined(shown, "top_cves", in_order=True).select("primary_vendor", "primary_product", "top_cves")


def scoring_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value is text; every third says NaN, every fifth is not a number at all."""
    events = views.table(spark, sf_dir, "events")
    text = (
        F.when(F.col("event_id") % 3 == 0, "NaN")
        .when(F.col("event_id") % 5 == 0, "none")
        .otherwise(F.col("value").cast("string"))
    )
    raw = events.select("event_id", text.alias("score"))
    return raw.select(
        "event_id", scores.number("score").alias("number"), scores.level_of_any(F.col("score")).alias("level")
    )


def priority_score_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_scored(spark, sf_dir).select(
        "cve_id", "cvss_normalized", "recency_score", "priority_score", "priority_level"
    )


def scoring_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = views.event_probability_rows(spark, sf_dir)
    return words.select(
        "cve",
        scores.level_of_any(F.col("epss")).alias("label"),
        scores.percent_if_ratio(F.col("epss").try_cast("double")).alias("shown"),
    )


def cluster_final_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = _line_final(spark, sf_dir).select(
        "cve_id",
        "cluster_id",
        "cluster_size",
        "cluster_kev_density",
        "cluster_epss_max",
        "cluster_epss_mean",
        "cluster_avg_cvss",
        "priority_score_final",
        "priority_level_final",
    )
    return _rounded(final, "cluster_epss_mean", "cluster_avg_cvss")


def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        views.line_facts(spark, sf_dir)
        .groupBy("cluster_id")
        .agg(
            F.count(F.lit(1)).alias("size"), F.sum(F.col("is_kev").cast("long")).alias("kev_count")
        )
        .orderBy("cluster_id")
    )


# --- master and quality --------------------------------------------------------------------


def master_left_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(
        _doc_master(spark, sf_dir).drop("description"), "cwes", "cpe_vendors", "cpe_products"
    )


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.summary(_written_master(spark, sf_dir), DOC_DATE), "mean_epss")


def severity_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.severity_distribution(_doc_master(spark, sf_dir), DOC_DATE)


def flag_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.exploited_by_year(_doc_master(spark, sf_dir), DOC_DATE)


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.completeness(quality.summary(_written_master(spark, sf_dir), DOC_DATE))


def quality_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of two snapshots are written; the later one is found and read."""
    path = scratch_path(spark, "quality")
    for date in ("2024-01-10", DOC_DATE):
        known = snapshot_as_of(views.probability_history(spark, sf_dir), date)
        records = master.build_master(
            views.doc_catalogue(spark, sf_dir), views.doc_exploited(spark, sf_dir), known, date
        )
        sinks.write_snapshot(quality.summary(stage_table(records, "master"), date), path, date, single_file=True)
    latest = find_snapshot(spark, path)
    return _rounded(read_snapshot(spark, path, latest), "mean_epss")


def snapshot_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_as_of(views.probability_history(spark, sf_dir), DOC_DATE)


def latest_within_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History partitioned by day; the search looks into the last days only."""
    path = scratch_path(spark, "history")
    sinks.overwrite_partitions(views.probability_history(spark, sf_dir), path, ["score_date"])
    history = read_table(spark, path)
    return snapshot_as_of(history, "2024-02-02", lookback_days=7, required=True)


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    return latest_per_key(events, "user_id", "ts", ["-event_id"])


# --- upsert ----------------------------------------------------------------------------------


def _upserted(spark: SparkSession, sf_dir: str) -> tuple[str, upsert.UpsertStats]:
    path, lineage = scratch_path(spark, "orders"), scratch_path(spark, "changes")
    upsert.full_refresh(views.order_catalogue(spark, sf_dir), path, 1990)
    stats = upsert.upsert_partitions(
        spark,
        views.order_changes(spark, sf_dir),
        path,
        first_year=1996,
        lineage=lineage,
        snapshot_date=LINE_DATE,
    )
    return path, stats


def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _upserted(spark, sf_dir)
    return read_table(spark, path)


def upsert_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, stats = _upserted(spark, sf_dir)
    return spark.createDataFrame(
        [(stats.modified_rows, stats.affected_years, stats.written_rows)],
        "modified_rows long, affected_years long, written_rows long",
    )


def _order_table(spark: SparkSession, orders: DataFrame) -> str:
    path = scratch_path(spark, "orders")
    sinks.overwrite_partitions(orders.withColumn("year", F.col("published_year")), path, ["year"])
    return path


def upsert_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without a year that get one, and one that loses it, leave no second copy."""
    number = F.col("cve_id").cast("long")
    orders = views.order_catalogue(spark, sf_dir)
    path = _order_table(
        spark, orders.withColumn("published_year", F.when(number % 9 != 0, F.col("published_year")))
    )
    later = orders.withColumn("last_modified", F.col("last_modified") + F.make_dt_interval(F.lit(1)))
    changes = later.where(number % 27 == 0).withColumn("published_year", F.lit(1997))
    upsert.upsert_partitions(spark, changes.withColumn("description", F.lit("dated")), path, 1990)
    return read_table(spark, path)


def upsert_leaves_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose newest version lies before the window are gone."""
    number = F.col("cve_id").cast("long")
    orders = views.order_catalogue(spark, sf_dir)
    path = _order_table(spark, orders)
    changes = orders.where(number % 6 == 0).withColumn(
        "published_year", F.when(number % 12 == 0, F.lit(1980)).otherwise(F.col("published_year"))
    )
    upsert.upsert_partitions(spark, changes.withColumn("description", F.lit("moved")), path, 1990)
    return read_table(spark, path)


def upsert_new_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that only the changes have, and one that only the table has."""
    orders = views.order_catalogue(spark, sf_dir)
    path = _order_table(spark, orders)
    changes = orders.where(F.col("cve_id").cast("long") % 10 == 0).drop("description")
    upsert.upsert_partitions(spark, changes.withColumn("review", F.lit("seen")), path, 1990)
    return read_table(spark, path, merge_schema=True).select(
        "cve_id", "last_modified", "description", "review", "published_year", "year"
    )


def upsert_key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two change sets that concern two and one of 28 quarters; the index tells which to search.

    ``searched`` marks the quarters that the index named for the first change set.
    """
    orders = views.order_catalogue(spark, sf_dir).withColumn(
        "published_year", F.col("published_year") * 10 + F.quarter("last_modified")
    )
    path, index = _order_table(spark, orders), scratch_path(spark, "order-keys")
    key_index.write_key_index(spark, path, index, "cve_id", "year")
    few = orders.where("published_year in (19932, 19974) and cast(cve_id as long) % 97 = 0")
    searched = key_index.candidate_partitions(spark, few, path, index, "cve_id", "year")
    upsert.upsert_partitions(spark, few.withColumn("description", F.lit("changed")), path, 1990, index=index)
    moved = few.where("published_year = 19932").withColumns(
        {"published_year": F.lit(19961), "description": F.lit("moved")}
    )
    upsert.upsert_partitions(spark, moved, path, 1990, index=index)
    return read_table(spark, path).withColumn("searched", among("year", searched))


def upsert_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change set without records changes nothing."""
    orders = views.order_catalogue(spark, sf_dir)
    path = _order_table(spark, orders)
    stats = upsert.upsert_partitions(spark, orders.where("cve_id IS NULL"), path, 1990)
    return read_table(spark, path).withColumn("written_rows", F.lit(stats.written_rows))


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders from 1996 on by their newest version; every fourth has moved out before."""
    path = scratch_path(spark, "orders")
    orders = views.order_catalogue(spark, sf_dir)
    moved = orders.where(F.col("cve_id").cast("long") % 4 == 0).select(
        "cve_id",
        (F.col("last_modified") + F.make_dt_interval(F.lit(1))).alias("last_modified"),
        "description",
        F.lit(1980).alias("published_year"),
    )
    upsert.full_refresh(orders.unionByName(moved), path, 1996)
    return read_table(spark, path)


def repartition_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by year of the feed, copied into one by year of publication."""
    source, path = scratch_path(spark, "by-feed"), scratch_path(spark, "by-publication")
    orders = views.order_catalogue(spark, sf_dir)
    by_feed = orders.withColumn("year", F.col("cve_id").cast("long") % 3 + 2000)
    sinks.overwrite_partitions(by_feed, source, ["year"])
    upsert.repartition_table(spark, source, path, 1995)
    return read_table(spark, path)


# --- nested and CSV feeds --------------------------------------------------------------------


def nested_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(_feed_catalogue(spark, sf_dir), "cwes").select(
        "cve_id",
        "published",
        "last_modified",
        "description",
        "cwes",
        "reference_count",
        "published_year",
    )


def nested_fallback_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed_catalogue(spark, sf_dir).select(
        "cve_id", "cvss_score", "cvss_severity", "cvss_version"
    )


def nested_exploit_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed_catalogue(spark, sf_dir).select("cve_id", "reference_count", "has_exploit_reference")


def feed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records published in 1997 or later: the window is the feature."""
    return silver.within_window(_feed_catalogue(spark, sf_dir), 1997).select("cve_id", "published_year")


def nested_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as gzipped documents of many records, one document per file."""
    path = scratch_path(spark, "feed-files")
    views.order_feed_files(spark, sf_dir).write.option("maxRecordsPerFile", 1).option(
        "compression", "gzip"
    ).text(path)
    feed = silver.catalogue(feeds.read_catalogue_feed(spark, path))
    return feed.select("cve_id", "cvss_score", "cvss_severity", "cvss_version", "published_year")


#: A gzipped file cannot be split: one of so many wide records, some 70 MB of text, is little for a task.
WIDE_RECORDS_PER_FILE = 200


def cpe_fields_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many names and values a record of very many configurations, nodes and matches has.

    The feed is gzipped: as plain text it takes more than 300 KB a record.
    """
    path = scratch_path(spark, "feed-wide")
    views.wide_feed_lines(spark, sf_dir).write.option("maxRecordsPerFile", WIDE_RECORDS_PER_FILE).option(
        "compression", "gzip"
    ).text(path)
    wide = silver.catalogue(feeds.read_catalogue_feed(spark, path, one_document_per_file=False))
    last = lambda name: F.array_max(F.transform(name, lambda v: v.cast("int")))
    return wide.select(
        "cve_id",
        F.size("cpe_vendors").alias("vendors"),
        F.size("cpe_products").alias("products"),
        F.size("cpe_versions").alias("versions"),
        last("cpe_versions").alias("last_version"),
    )


def cpe_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ["cpe_vendors", "cpe_products", "cpe_versions"]
    return _joined(_feed_catalogue(spark, sf_dir), *lists).select("cve_id", *lists)


def csv_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "listing")
    views.part_listing(spark, sf_dir).write.options(**sinks.CSV_OPTIONS).csv(path)
    return silver.exploited(feeds.read_exploited_csv(spark, path))


def csv_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "probabilities")
    views.event_probability_rows(spark, sf_dir).write.option("header", True).csv(path)
    return silver.probabilities(feeds.read_probability_csv(spark, path), DOC_DATE)


# --- selection -------------------------------------------------------------------------------


def _selected(strategy: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        chosen = selection.SELECTORS[strategy](_line_selectable(spark, sf_dir), K.DAILY_CAPACITY)
        return chosen.select("cve_id", "cluster_id", "is_kev", "epss_score", "priority_score_final")

    return query


def strategy_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's position under every strategy."""
    ordered = ["cve_id", "cluster_id", "priority_score_final", "epss_score", "is_kev"]
    # read once; every strategy reads the table that ranking the clusters writes
    facts = selection.with_rounds(_line_selection(spark, sf_dir).select(ordered))
    ranked = [
        selection.strategy_ranking(facts, name, keep=["cve_id"]).select(
            F.lit(name).alias("strategy"), "cve_id", "place"
        )
        for name in K.STRATEGIES
    ]
    return reduce(DataFrame.unionByName, ranked)


def strategy_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = _line_selectable(spark, sf_dir, shown=())
    return selection.compare_strategies(full, selection.select_all(full)).orderBy(
        F.desc("kev_coverage"), "strategy"
    )


def backlog_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.project_backlog(_line_selectable(spark, sf_dir, shown=())).orderBy("strategy", "day")


# --- clusters --------------------------------------------------------------------------------


def cluster_risk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = selection.selection_input(_line_final(spark, sf_dir), dedupe=False)
    return _rounded(
        selection.cluster_risk_summary(final), "avg_priority_final", "avg_cvss", "avg_epss"
    )


def _cluster_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk joined to topics; the topics here are the most frequent vendors and products."""
    date = F.lit(LINE_DATE).cast("date")
    facts = views.line_facts(spark, sf_dir)
    listed = facts.withColumn("cluster_id", F.coalesce("cluster_id", F.lit(K.NO_CLUSTER))).withColumns(
        {"vendors": F.array("primary_vendor"), "products": F.array("primary_product")}
    )
    topics = (
        top_values(listed, "cluster_id", "products", 3, "top_keywords")
        .join(top_values(listed, "cluster_id", "vendors", 5, "top_vendors"), "cluster_id", "left")
        .withColumns({"top_cwes": F.array(F.lit("none")), "snapshot_date": date})
    )
    risk = cluster_risk_summary(spark, sf_dir).withColumn("snapshot_date", date)
    return serving.clusters_with_topics(risk, topics)


def cluster_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(
        _cluster_pages(spark, sf_dir), "top_keywords", "topic_vendors", "top_cwes", in_order=True
    )


def top5_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    risk = cluster_risk_summary(spark, sf_dir)
    return serving.riskiest_clusters(risk.where(F.col("cluster_size") > 0))


def cluster_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.cluster_totals(cluster_risk_summary(spark, sf_dir))


def top_values_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = views.doc_catalogue(spark, sf_dir).withColumn("words", F.split("description", " "))
    grouped = documents.withColumn("cluster_id", F.get("cpe_products", F.lit(0)))
    top = top_values(grouped, "cluster_id", "words", K.TOP_VALUES, "top_words")
    return _joined(top, "top_words", in_order=True)


# --- serving reads -----------------------------------------------------------------------------


def top_n_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = matches("Critical", only_flagged=True, vendor="bRAND#1", min_probability=0.3)
    best = serving.top_records(_line_final(spark, sf_dir), 50, wanted)
    return best.select(
        "cve_id", "primary_vendor", "epss_score", "priority_score_final", "priority_level_final"
    )


def recommendations_by_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selections are written partitioned by strategy and read back, 20 per strategy."""
    path = scratch_path(spark, "recommendations")
    selected = selection.select_all(_line_selectable(spark, sf_dir))
    sinks.write_by_strategy(selected, path, LINE_DATE)
    stored = at_snapshot(read_table(spark, path), LINE_DATE)
    shown = [serving.recommendations(stored, name, 20) for name in K.STRATEGIES]
    return reduce(DataFrame.unionByName, shown).select(
        "strategy", "cve_id", "is_kev", "epss_score", "priority_score_final"
    )


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.lookup(_doc_master(spark, sf_dir), "17").select(
        "cve_id", "is_kev", "epss_score", "primary_vendor", "cvss_score"
    )


def overview_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.overview(_line_final(spark, sf_dir).select(serving.OVERVIEW_COLUMNS))


def severity_fixed_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.fixed_domain_counts(views.line_facts(spark, sf_dir))


def score_share_of_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = kpis.share_of_max(_line_final(spark, sf_dir), "priority_score_final")
    return _rounded(shares.select("cve_id", "share_of_max"), "share_of_max")


# --- tables --------------------------------------------------------------------------------------


def _written_snapshots(spark: SparkSession, sf_dir: str) -> str:
    """Lines of each year as one snapshot; the last year is written twice."""
    path = scratch_path(spark, "snapshots")
    facts = views.line_facts(spark, sf_dir).withColumns(
        {
            "published_year": F.year("published"),
            "snapshot_date": F.make_date(F.year("published"), F.lit(12), F.lit(31)),
        }
    )
    sinks.write_verified(facts, path, ["snapshot_date", "published_year"])
    again = facts.where(F.col("published_year") == 2001).withColumn("cvss_score", F.lit(0.0))
    sinks.overwrite_partitions(again, path, ["snapshot_date", "published_year"])
    return path


def write_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read_table(spark, _written_snapshots(spark, sf_dir), merge_schema=True)
    counts = stored.groupBy("snapshot_date", "published_year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cvss_score").alias("severity")
    )
    return _rounded(counts, "severity")


def read_one_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written_snapshots(spark, sf_dir)
    found = find_snapshot(spark, path, "1998-12-31")
    return read_snapshot(spark, path, found).select("cve_id", "cvss_score", "snapshot_date")


def read_merged_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots whose columns were added, dropped and widened, read as one table."""
    path = scratch_path(spark, "merged")
    lines = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("int").alias("line"), F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag")
    )
    quantity = F.col("quantity").cast("float").alias("quantity")
    sinks.write_snapshot(lines.where("line <= 2").select("l_orderkey", "line", quantity, "flag"), path, "2024-01-01")
    sinks.write_snapshot(lines.where("line = 3").select("l_orderkey", "line", quantity), path, "2024-01-02")
    wide = F.col("line").cast("long").alias("line")
    sinks.write_snapshot(lines.where("line > 3").select("l_orderkey", wide, F.col("quantity").cast("double").alias("quantity"), F.lit("new").alias("extra")), path, "2024-01-03")
    return merged_snapshots(spark, path)


def daily_scores_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily chain: three feeds, a second day's changes, master, scores, given groups, final scores.

    The second day is run twice over the same tables, as a broken-off run is repeated.
    """
    tables = daily.Layout(scratch_path(spark, "lake"))
    daily.load_catalogue(spark, views.doc_feed(spark, sf_dir), tables, "2024-01-14")
    daily.load_exploited(views.doc_exploited_raw(spark, sf_dir), tables)

    def groups(scored: DataFrame) -> DataFrame:
        given = scored.where("cve_id NOT LIKE '%3'")
        return given.select("cve_id", (F.col("cve_id").cast("long") % 7).cast("int").alias("cluster_id"))

    for _ in range(2):
        daily.load_catalogue(spark, views.doc_feed_changes(spark, sf_dir), tables, DOC_DATE)
        # the last of these days is later than the snapshot and must not be used
        for day in ("2024-01-14", DOC_DATE, "2024-01-16"):
            daily.load_probabilities(views.probability_raw(spark, sf_dir, day), tables, day)
        daily.build_gold(spark, tables, DOC_DATE, groups=groups)
    final = read_snapshot(spark, tables.gold("vulnerability_scores_final"), DOC_DATE).select(
        "cve_id", "published", "epss_score", "is_kev", "cluster_id", "cluster_size", "priority_score", "priority_level",
        "priority_score_final", "priority_level_final",
    )
    return _rounded(final.withColumn("published", F.to_date("published")), "priority_score_final")


def available_snapshot_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return available_snapshots(read_table(spark, _written_snapshots(spark, sf_dir)))


def settings_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capacity from the stored comparison; the horizon only from the last stored day."""
    capacity = views.table(spark, sf_dir, "nation").count()
    days = views.table(spark, sf_dir, "region").count() + 7
    full = _line_selectable(spark, sf_dir, shown=())
    comparison = selection.compare_strategies(full, selection.select_all(full, capacity), capacity)
    series = projection.project_backlog(full, capacity, days)
    stored = [
        stage_table(df.drop("simulation_days"), label)
        for df, label in ((comparison, "comparison"), (series, "series"))
    ]
    return kpis.run_settings(*stored)


def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record export, whose score columns this table lacks, read back by its header."""
    path = scratch_path(spark, "export")
    serving.export(views.line_facts(spark, sf_dir), "vulnerabilities", path)
    schema = (
        "cve_id string, cvss_score double, cvss_severity string, epss_score double, is_kev int, "
        "primary_vendor string, primary_product string, published timestamp_ntz"
    )
    return spark.read.schema(schema).options(header=True, enforceSchema=False).csv(path)


# --- text and clustering ---------------------------------------------------------------------------


def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = views.doc_catalogue(spark, sf_dir).na.drop(subset=["description"])
    return described.select("cve_id", clean_text(F.col("description")).alias("clean_text"))


def _clustered(spark: SparkSession, sf_dir: str) -> clustering.Clustering:
    """Over all default counts, with the small model of the features."""
    scored = scoring.score_base(_doc_master(spark, sf_dir), DOC_DATE)
    return clustering.run_clustering(scored, settings=clustering.SMALL_FEATURES)


def kmeans_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.score_base(_doc_master(spark, sf_dir), DOC_DATE)
    return clustering.attach_clusters(
        scored.select("cve_id", "is_kev"), _clustered(spark, sf_dir).assignments
    )


def kmeans_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir).metrics


def cluster_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir).topics


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    vectors = views.table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    return stage_table(vectors, "vectors")


def embedding_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every ready-made vector, with the best of all default counts."""
    vectors = _vectors(spark, sf_dir)
    metrics, models = clustering.try_cluster_counts(vectors)
    best = models[clustering.best_cluster_count(metrics)]
    return best.transform(vectors).select("vec_id", F.col("prediction").alias("cluster_id"))


# --- the deterministic parts of clustering, over given groups --------------------------------------


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.prepare_text(scoring.score_base(_doc_master(spark, sf_dir), DOC_DATE))


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that can tell documents apart, in order; here without the common English ones."""
    kept = words(F.col("clean_text"), K.DOMAIN_STOP_WORDS, K.MIN_TOKEN_LENGTH)
    return _prepared(spark, sf_dir).select("cve_id", F.array_join(kept, " ").alias("words"))


def _worded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and their words; no table is made of them, as counting reads the words once."""
    kept = words(F.col("clean_text"), K.DOMAIN_STOP_WORDS, K.MIN_TOKEN_LENGTH)
    return _prepared(spark, sf_dir).select("cve_id", kept.alias("words"))


def _term_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_table(terms.term_weights(_worded(spark, sf_dir)), "term-weights")


def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and weight of every term in every document."""
    return terms.term_weights(_worded(spark, sf_dir)).select(
        "cve_id", "term", "n", F.round("weight", 6).alias("weight")
    )


def top_terms_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of largest mean weight for given groups of documents."""
    weights = _term_weights(spark, sf_dir)
    given = _prepared(spark, sf_dir).select("cve_id", (F.col("cve_id").cast("long") % 5).alias("cluster_id"))
    return _joined(terms.top_terms(weights, given, K.TOP_KEYWORDS), "top_keywords", in_order=True)


def topics_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of given groups, of which one has neither vendors nor weaknesses."""
    number = F.col("cve_id").cast("long")
    prepared = stage_table(_prepared(spark, sf_dir), "prepared")
    given = prepared.withColumn("cluster_id", F.when(number % 20 == 0, 5).otherwise(number % 5))
    topics = clustering.cluster_topics(given, _term_weights(spark, sf_dir))
    return _joined(topics, "top_keywords", "top_vendors", "top_cwes", in_order=True)


def category_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categories of every document, each once."""
    prepared = _prepared(spark, sf_dir)
    found = [
        terms.category_rows(prepared, column).select("cve_id", F.lit(column).alias("kind"), "value")
        for column in ("cwes", "cpe_vendors")
    ]
    return reduce(DataFrame.unionByName, found)


def numeric_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir).select("cve_id", "cvss_scaled", "epss_percentile", "is_kev")


def _vector_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = views.table(spark, sf_dir, "embeddings")
    return stage_table(
        vectors.select(F.col("vec_id").alias("cve_id"), F.posexplode("embedding").alias("dim", "value"))
        .withColumn("value", F.col("value").cast("double"))
        .where("value <> 0"),
        "vector-entries",
    )


def _vector_moments(spark: SparkSession, sf_dir: str) -> measures.Moments:
    given = views.table(spark, sf_dir, "embeddings").selectExpr("vec_id AS cve_id", "label AS cluster_id")
    return measures.moments(_vector_entries(spark, sf_dir), given)


def _projected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[float]]:
    vectors = views.table(spark, sf_dir, "embeddings")
    given = vectors.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("given"))
    return clustering.project(given, "given", 3)


def pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the variance of each of three principal components."""
    _, shares = _projected(spark, sf_dir)
    rows = spark.createDataFrame(list(enumerate(shares, 1)), "component int, share double")
    return _rounded(rows, "share")


def pca_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squared length of each vector's projection: free of the signs and order of the components."""
    rows, _ = _projected(spark, sf_dir)
    squares = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda total, x: total + x * x)
    return _rounded(rows.select("vec_id", squares.alias("length")), "length")


def _measured(spark: SparkSession, name: str, value: float | None) -> DataFrame:
    return spark.createDataFrame([(value,)], f"{name} double").select(F.round(name, 6).alias(name))


def davies_bouldin_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measure of a given grouping of vectors."""
    return _measured(spark, "davies_bouldin", measures.davies_bouldin(_vector_moments(spark, sf_dir)))


def davies_bouldin_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same measure over the term weights of given groups of documents, zeros never looked at."""
    prepared = _prepared(spark, sf_dir)
    given = prepared.select("cve_id", (F.col("cve_id").cast("long") % 5).alias("cluster_id"))
    weights = _term_weights(spark, sf_dir).select("cve_id", F.col("term").alias("dim"), F.col("weight").alias("value"))
    return _measured(spark, "davies_bouldin", measures.davies_bouldin(measures.moments(weights, given)))


def silhouette_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouette of a given grouping of vectors."""
    return _measured(spark, "silhouette", measures.silhouette(_vector_moments(spark, sf_dir)))


def lloyd_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of k-means over all vectors, from the first four as centres."""
    entries = _vector_entries(spark, sf_dir)
    vectors = views.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cve_id"))
    first = vectors.where("cve_id IS NOT NULL").orderBy("cve_id").limit(4)
    numbered = first.select("cve_id", (F.row_number().over(Window.orderBy("cve_id")) - 1).alias("cluster_id"))
    centres = entries.join(numbered, "cve_id").select("cluster_id", "dim", "value")
    assigned, _ = measures.lloyd(entries, vectors, centres, 3)
    return assigned.select(F.col("cve_id").alias("vec_id"), "cluster_id")


def best_count_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank-sum choice among measures that the line numbers stand in for."""
    measures = views.table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("k")).agg(
        F.round(F.avg("l_discount"), 9).alias("silhouette"),
        F.round(F.sum("l_tax"), 6).alias("cost"),
        F.round(F.avg("l_quantity"), 9).alias("davies_bouldin"),
    )
    best = clustering.best_cluster_count(measures.orderBy("k"))
    return spark.createDataFrame([(best,)], "k int")


def attach_given_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given groups joined to all records; records without a text have none."""
    scored = scoring.score_base(_doc_master(spark, sf_dir), DOC_DATE)
    given = scored.where("cve_id NOT LIKE '%3'").select(
        "cve_id", (F.col("cve_id").cast("long") % 7).cast("int").alias("cluster_id")
    )
    return clustering.attach_clusters(scored.select("cve_id", "is_kev"), given)


QUERIES = {
    "remediation_actions_top50": remediation_actions_top50,
    "remediation_actions_all": remediation_actions_all,
    "priority_score_levels": priority_score_levels,
    "scoring_label": scoring_label,
    "cluster_final_score": cluster_final_score,
    "group_sizes": group_sizes,
    "master_left_joins": master_left_joins,
    "quality_summary": quality_summary,
    "severity_distribution": severity_distribution,
    "flag_by_year": flag_by_year,
    "completeness": completeness,
    "quality_latest": quality_latest,
    "snapshot_asof": snapshot_asof,
    "latest_within_days": latest_within_days,
    "dedupe_latest": dedupe_latest,
    "upsert_partitions": upsert_partitions,
    "upsert_stats": upsert_stats,
    "upsert_null_partition": upsert_null_partition,
    "upsert_leaves_window": upsert_leaves_window,
    "upsert_new_columns": upsert_new_columns,
    "upsert_key_index": upsert_key_index,
    "upsert_empty": upsert_empty,
    "full_refresh": full_refresh,
    "repartition_table": repartition_table,
    "nested_flatten": nested_flatten,
    "nested_fallback_chain": nested_fallback_chain,
    "nested_exploit_flag": nested_exploit_flag,
    "feed_window": feed_window,
    "nested_multiline": nested_multiline,
    "cpe_fields_wide": cpe_fields_wide,
    "cpe_fields": cpe_fields,
    "csv_silver": csv_silver,
    "csv_probabilities": csv_probabilities,
    "select_top_priority": _selected("top_priority"),
    "select_high_score": _selected("high_epss"),
    "select_group_quota": _selected("cluster_based"),
    "select_flag_first": _selected("kev_first"),
    "select_hybrid": _selected("hybrid"),
    "strategy_ranking": strategy_ranking,
    "strategy_comparison": strategy_comparison,
    "backlog_projection": backlog_projection,
    "cluster_risk_summary": cluster_risk_summary,
    "cluster_overview": cluster_overview,
    "top5_clusters": top5_clusters,
    "cluster_totals": cluster_totals,
    "top_values_per_group": top_values_per_group,
    "top_n_filtered": top_n_filtered,
    "recommendations_by_strategy": recommendations_by_strategy,
    "point_lookup": point_lookup,
    "overview_kpis": overview_kpis,
    "severity_fixed_domain": severity_fixed_domain,
    "score_share_of_max": score_share_of_max,
    "write_snapshot": write_snapshot,
    "read_one_snapshot": read_one_snapshot,
    "read_merged_snapshots": read_merged_snapshots,
    "daily_scores_final": daily_scores_final,
    "available_snapshots": available_snapshot_dates,
    "settings_resolution": settings_resolution,
    "csv_export": csv_export,
    "text_clean": text_clean,
    "kmeans_clusters": kmeans_clusters,
    "kmeans_metrics": kmeans_metrics,
    "cluster_topics": cluster_topics,
    "embedding_clusters": embedding_clusters,
    "document_words": document_words,
    "tfidf_weights": tfidf_weights,
    "top_terms_given": top_terms_given,
    "category_values": category_values,
    "numeric_features": numeric_features,
    "davies_bouldin_given": davies_bouldin_given,
    "davies_bouldin_terms": davies_bouldin_terms,
    "pca_variance": pca_variance,
    "pca_lengths": pca_lengths,
    "silhouette_given": silhouette_given,
    "lloyd_given": lloyd_given,
    "topics_given": topics_given,
    "best_count_given": best_count_given,
    "attach_given_clusters": attach_given_clusters,
    "scoring_nan": scoring_nan,
    "action_details": action_details,
}
