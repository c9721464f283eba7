"""Patch actions by vendor and product, by benefit per effort."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark import constants as K
from riskspark.functions import scores
from riskspark.operators.ranking import ranked_values, top_k, top_k_per_group
from riskspark.sources.workdir import stage_table

GROUPS = ["primary_vendor", "primary_product"]
BY_ACTION = ["-action_score", *GROUPS]


def name_groups(df: DataFrame) -> DataFrame:
    unknown = F.lit(K.UNKNOWN_GROUP)
    return df.withColumns({name: F.coalesce(name, unknown) for name in GROUPS})


def action_scores(df: DataFrame) -> DataFrame:
    """Aggregates and action score per group. Combines on the map side, so a hot group is cheap."""
    return (
        name_groups(df)
        .groupBy(*GROUPS)
        .agg(
            F.count("cve_id").alias("n_cves"),
            F.count_if(F.col("is_kev") == 1).alias("n_kev"),
            F.max("priority_score_final").alias("max_priority"),
            F.sum("priority_score_final").alias("sum_priority"),
            F.avg("epss_score").alias("mean_epss"),
            F.max("epss_score").alias("max_epss"),
        )
        .withColumn("effort_proxy", scores.effort(F.col("n_cves")))
        .withColumn(
            "action_score",
            scores.benefit_per_effort(F.col("sum_priority"), F.col("effort_proxy")),
        )
    )


def attach_top_ids(df: DataFrame, groups: DataFrame, top_ids: int) -> DataFrame:
    """The ids of each group's best records, as a short list beside its aggregates.

    Records travel only after they were cut to ``top_ids`` per group on the map side. ``groups``
    are groups of ``df``, so each finds its list.
    """
    records = name_groups(df).select(*GROUPS, "priority_score_final", "cve_id")
    best = top_k_per_group(
        records, GROUPS, ["-priority_score_final", "cve_id"], top_ids, "_nth"
    )
    return groups.join(ranked_values(best, GROUPS, "cve_id", "_nth", "top_cves"), GROUPS)


def build_actions(df: DataFrame, top_ids: int = K.ACTION_TOP_IDS) -> DataFrame:
    """Every action, best first."""
    return attach_top_ids(df, action_scores(df), top_ids).orderBy(
        F.desc("action_score"), *GROUPS
    )


def top_actions(df: DataFrame, n: int = 50, top_ids: int = K.ACTION_TOP_IDS) -> DataFrame:
    """The n best actions. Their id lists are built for the chosen groups only.

    The n groups are written out and semi-joined to the records: the planner sees n rows.
    """
    chosen = stage_table(top_k(action_scores(df), BY_ACTION, n), "actions")
    members = name_groups(df).join(chosen.select(*GROUPS), GROUPS, "left_semi")
    return attach_top_ids(members, chosen, top_ids).orderBy(F.desc("action_score"), *GROUPS)
