"""Backlog over a horizon when a strategy's order is worked off day by day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from riskspark import constants as K
from riskspark.operators.selection import GROUP, KEY, with_rounds, strategy_ranking
from riskspark.sources.workdir import stage_table


def _daily_work(df: DataFrame, capacity: int, days: int) -> DataFrame:
    """Rows, flagged rows and probability worked off per strategy and day."""
    names = [KEY, "priority_score_final", "epss_score", "is_kev"]
    narrow = df.select(*names, *([GROUP] if GROUP in df.columns else []))
    facts = stage_table(with_rounds(narrow), "rounds")
    worked = [
        strategy_ranking(facts, name, limit=capacity * days)
        .select(
            F.lit(name).alias("strategy"),
            F.ceil(F.col("place") / capacity).cast("int").alias("day"),
            "is_kev",
            "epss_score",
        )
        .groupBy("strategy", "day")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("is_kev") == 1).alias("flagged"),
            F.sum("epss_score").alias("epss"),
        )
        for name in K.STRATEGIES
    ]
    return reduce(DataFrame.unionByName, worked)


def project_backlog(
    df: DataFrame,
    capacity: int = K.DAILY_CAPACITY,
    days: int = K.HORIZON_DAYS,
    arrivals: int = K.ARRIVALS_PER_DAY,
) -> DataFrame:
    """Open rows, open flagged rows and mitigated probability per strategy and day.

    Only the rows that fit into the horizon are ranked. They are reduced to one row per strategy
    and day, and running sums over that small frame replace one query per strategy and day. New
    arrivals are assumed to be flagged at the rate of the table.
    """
    spark = df.sparkSession
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("is_kev") == 1).alias("flagged")
    )
    all_rows, all_flagged = totals.select("rows").scalar(), totals.select("flagged").scalar()
    calendar = spark.createDataFrame(
        [(name,) for name in K.STRATEGIES], "strategy string"
    ).select("strategy", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("day"))
    so_far = W.partitionBy("strategy").orderBy("day").rowsBetween(W.unboundedPreceding, 0)

    def running(name: str):
        return F.sum(F.coalesce(name, F.lit(0))).over(so_far)

    arrived = F.lit(max(0, arrivals)) * F.col("day")
    flagged_rate = F.coalesce(F.try_divide(all_flagged, all_rows), F.lit(0.0))
    flagged_arrived = F.rint(arrived * flagged_rate).cast("long")  # halves go to the even number
    nothing = F.lit(0).cast("long")
    return (
        calendar.join(_daily_work(df, capacity, days), ["strategy", "day"], "left")
        .withColumns(
            {"_rows": running("rows"), "_flagged": running("flagged"), "_epss": running("epss")}
        )
        .select(
            "strategy",
            "day",
            F.greatest(all_rows + arrived - F.col("_rows"), nothing).alias("backlog_size"),
            F.greatest(all_flagged + flagged_arrived - F.col("_flagged"), nothing).alias(
                "kev_in_backlog"
            ),
            F.round("_epss", 4).alias("cumulative_mitigated_epss"),
            F.col("day").cast("double").alias("mean_age_in_backlog"),
            F.lit(capacity).alias("daily_capacity"),
            F.lit(days).alias("simulation_days"),
            F.lit(arrivals).alias("arrival_rate"),
        )
    )
