"""Figures for overview pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskspark import constants as K


def overview(df: DataFrame) -> DataFrame:
    """Rows, flagged rows, share of critical rows, rows with a high probability."""
    rows = F.count(F.lit(1))
    critical = F.count_if(F.col("priority_level_final") == K.LEVELS[0][0])
    return df.agg(
        rows.alias("n_total"),
        F.coalesce(F.sum(F.col("is_kev").cast("long")), F.lit(0)).alias("n_kev"),
        F.coalesce(F.try_divide(critical * 100.0, rows), F.lit(0.0)).alias("pct_critical"),
        F.count_if(F.col("epss_score") > 0.7).alias("n_high_epss"),
    )


def fixed_domain_counts(
    df: DataFrame, column: str = "cvss_severity", domain: Sequence[str] = K.SEVERITY_CLASSES
) -> DataFrame:
    """Counts over a given list of classes, zero where a class is absent, in the given order."""
    classes = df.sparkSession.createDataFrame(
        list(enumerate(domain)), "position int, severity string"
    )
    counts = df.groupBy(F.upper(column).alias("severity")).agg(F.count(F.lit(1)).alias("n"))
    return (
        classes.join(counts, "severity", "left")
        .select("position", "severity", F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("position")
    )


def cluster_totals(risk: DataFrame) -> DataFrame:
    return risk.agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.sum("cluster_size").alias("n_records"),
        F.count_if(F.col("n_kev") > 0).alias("n_clusters_with_kev"),
    )


def share_of_max(df: DataFrame, column: str, out: str = "share_of_max") -> DataFrame:
    """A column as 0-100 percent of its maximum, which is a scalar subquery and not a window."""
    peak = df.agg(F.max(column).alias("peak")).scalar()
    usable = F.when(peak.isNull() | (peak == 0), F.lit(1.0)).otherwise(peak)
    share = F.lit(100.0) * F.col(column) / usable
    return df.withColumn(out, F.greatest(F.lit(0.0), F.least(F.lit(100.0), share)))


def lookup(df: DataFrame, key_value: str, key: str = "cve_id") -> DataFrame:
    return df.where(F.col(key) == key_value).limit(1)


def run_settings(comparison: DataFrame, timeseries: DataFrame) -> DataFrame:
    """Capacity and horizon that a run was made with, from whichever table knows them.

    A missing or zero setting falls through to the next source and finally to the default.
    """

    def first_set(df: DataFrame, name: str):
        if name not in df.columns:
            return F.lit(None).cast("int")
        values = df.agg(F.first(F.col(name).try_cast("int"), ignorenulls=True).alias(name))
        return F.nullif(values.scalar(), F.lit(0))

    last_day = (
        timeseries.agg(F.max(F.col("day").try_cast("int")).alias("day")).scalar()
        if "day" in timeseries.columns
        else F.lit(None).cast("int")
    )
    return comparison.sparkSession.range(1).select(
        F.coalesce(
            first_set(comparison, "daily_capacity"),
            first_set(timeseries, "daily_capacity"),
            F.lit(K.DAILY_CAPACITY),
        ).alias("daily_capacity"),
        F.coalesce(
            first_set(comparison, "simulation_days"),
            first_set(timeseries, "simulation_days"),
            F.nullif(last_day, F.lit(0)),
            F.lit(K.HORIZON_DAYS),
        ).alias("simulation_days"),
    )


def detail_columns(df: DataFrame, ids: str = "top_cves", shown: int = 10) -> DataFrame:
    """The id list cut to what a detail card shows (P20)."""
    return df.withColumn(ids, F.slice(ids, 1, shown))
