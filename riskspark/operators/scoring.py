"""Base and group-adjusted priority."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark import constants as K
from riskspark.functions import scores
from riskspark.sources.tables import DateLike, as_date
from riskspark.sources.workdir import stage_table


def score_base(
    master: DataFrame,
    snapshot_date: DateLike,
    severity_weight: float = K.SEVERITY_WEIGHT,
    probability_weight: float = K.PROBABILITY_WEIGHT,
    exploited_weight: float = K.EXPLOITED_WEIGHT,
    recency_weight: float = K.RECENCY_WEIGHT,
) -> DataFrame:
    """Weighted score and level per record. A projection: no shuffle."""
    filled = master.withColumns(
        {
            "cvss_score": scores.number("cvss_score"),
            "epss_percentile": scores.number("epss_percentile"),
            "is_kev": scores.number("is_kev", "int"),
        }
    )
    parts = filled.withColumns(
        {
            "cvss_normalized": F.col("cvss_score") / F.lit(10.0),
            "recency_score": scores.recency(F.col("published"), as_date(snapshot_date)),
        }
    )
    weighted = scores.weighted_score(
        [
            (severity_weight, F.col("cvss_normalized")),
            (probability_weight, F.col("epss_percentile")),
            (exploited_weight, F.col("is_kev")),
            (recency_weight, F.col("recency_score")),
        ]
    )
    scored = parts.withColumn("priority_score", scores.floored(weighted, F.col("is_kev") == 1))
    return scored.withColumn("priority_level", scores.level(F.col("priority_score")))


def group_stats(df: DataFrame, group: str = "cluster_id") -> DataFrame:
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("cluster_size"),
            F.avg("is_kev").alias("cluster_kev_density"),
            F.max("epss_score").alias("cluster_epss_max"),
            F.avg("epss_score").alias("cluster_epss_mean"),
            F.avg("cvss_score").alias("cluster_avg_cvss"),
        )
    )


def attach_group_stats(df: DataFrame, group: str = "cluster_id") -> DataFrame:
    """Group statistics on every row.

    The aggregate combines on the map side and is written out, so the join back knows its size:
    usually a broadcast, and the long table is never shuffled by a column of few values.
    """
    return df.join(stage_table(group_stats(df, group), "group-stats"), group, "left")


def score_final(
    scored: DataFrame,
    alpha: float = K.GROUP_DENSITY_ALPHA,
    beta: float = K.GROUP_PROBABILITY_BETA,
    ungrouped: str = "keep",
    group: str = "cluster_id",
) -> DataFrame:
    """Score adjusted by the risk of the record's group.

    A record without a group has nothing to be adjusted by. ``ungrouped="keep"`` keeps its base
    score; ``ungrouped="zero"`` gives 0, the value that arithmetic on missing statistics yields.
    """
    if ungrouped not in ("keep", "zero"):
        raise ValueError(f"ungrouped must be 'keep' or 'zero', not {ungrouped!r}")
    density, peak = F.col("cluster_kev_density"), F.col("cluster_epss_max")
    if ungrouped == "keep":
        density, peak = F.coalesce(density, F.lit(0.0)), F.coalesce(peak, F.lit(0.0))
    final = scores.boosted(F.col("priority_score"), density, peak, alpha, beta)
    return (
        attach_group_stats(scored, group)
        .withColumn("priority_score_final", final)
        .withColumn("priority_level_final", scores.level(F.col("priority_score_final")))
    )
