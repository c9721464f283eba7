"""Quality profile of a master snapshot."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.sources.tables import DateLike, as_date


def _percent(condition: Column) -> Column:
    return F.try_divide(F.count_if(condition) * 100.0, F.count(F.lit(1)))


def _missing(values: str) -> Column:
    return F.col(values).isNull() | (F.size(values) == 0)


def _next_bounds(inside: DataFrame, at: int, n: int) -> tuple[float, float]:
    """Approximate values a little below and above place ``at`` of ``n``."""
    shares = [max(at / n - 0.01, 0.0), min(at / n + 0.01, 1.0)]
    return tuple(inside.agg(F.percentile_approx("v", shares, 10_000)).first()[0])


def order_statistic(df: DataFrame, column: str, share: float = 0.5, held: int = 100_000) -> float | None:
    """The smallest value that at least ``share`` of all values do not exceed; exact, none of no values.

    The range that holds it is narrowed by approximate bounds, each put right by an exact count of
    what lies below, until it has at most ``held`` different values; only these are counted and put
    in order. Nulls and not-a-number are no values. Where approximate bounds do not narrow the
    range, its halves do. Every step is an aggregation over ``df``, so let it be a written table.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    n, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if not n:
        return None
    place = max(1, math.ceil(share * n))
    at, approximate = place, True
    while True:
        inside = values.where(F.col("v").between(low, high))
        if low == high:
            return low
        # a bounded prefix of the different values tells whether they are few
        few = inside.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        if few.limit(held + 1).count() <= held:
            upto = F.sum("n").over(Window.orderBy("v"))
            return few.withColumn("upto", upto).where(F.col("upto") >= at).agg(F.min("v")).first()[0]
        lower, upper = _next_bounds(inside, at, n) if approximate else (low, low + (high - low) / 2)
        below, within = inside.agg(F.count_if(F.col("v") < lower), F.count_if(F.col("v").between(lower, upper))).first()
        if at <= below:
            found = inside.where(F.col("v") < lower)
        elif at <= below + within:
            found, at = inside.where(F.col("v").between(lower, upper)), at - below
        else:
            found, at = inside.where(F.col("v") > upper), at - below - within
        count, next_low, next_high = found.agg(F.count("v"), F.min("v"), F.max("v")).first()
        approximate = count < n
        n, low, high = count, next_low, next_high


def summary(df: DataFrame, snapshot_date: DateLike) -> DataFrame:
    """The whole profile in one row.

    ``pct_null_epss`` counts zero probabilities, the filled form of "no probability known".
    One aggregation that combines on the map side, and a few narrow ones for the exact median, which
    never hold more than a bounded number of values. Distinct keys shuffle the key column and are a
    subquery over it: ``df`` is read several times, so let it be a written table.
    """
    median = order_statistic(df, "epss_score")
    distinct_keys = df.agg(F.count_distinct("cve_id").alias("n")).scalar()
    flagged = F.col("is_kev") == 1
    scored = F.col("epss_score") > 0.0
    profile = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        _percent(F.col("cvss_score").isNull()).alias("pct_null_cvss"),
        _percent(F.col("epss_score") == 0.0).alias("pct_null_epss"),
        _percent(_missing("cwes")).alias("pct_null_cwes"),
        _percent(_missing("cpe_vendors")).alias("pct_null_cpe"),
        _percent(F.col("epss_score") > 0.7).alias("pct_epss_gt_07"),
        _percent(F.col("epss_score") > 0.9).alias("pct_epss_gt_09"),
        F.avg("epss_score").alias("mean_epss"),
        F.sum(F.col("is_kev").cast("long")).alias("kev_count"),
        F.count_if(flagged).alias("nvd_kev_intersection"),
        F.count_if(scored).alias("nvd_epss_intersection"),
        F.count_if(flagged & scored).alias("nvd_kev_epss_intersection"),
        F.lit(median).cast("double").alias("median_epss"),
    )
    first = ["row_count"]
    last = profile.columns[profile.columns.index("kev_count") : -1]
    shares = [name for name in profile.columns[:-1] if name not in first + last]
    return profile.select(
        as_date(snapshot_date).alias("snapshot_date"),
        *first,
        distinct_keys.alias("distinct_cve_count"),
        *shares,
        "median_epss",
        *last,
    )


def severity_distribution(df: DataFrame, snapshot_date: DateLike) -> DataFrame:
    counts = df.groupBy("cvss_severity").agg(F.count(F.lit(1)).alias("cve_count"))
    return counts.withColumn("snapshot_date", as_date(snapshot_date))


def exploited_by_year(df: DataFrame, snapshot_date: DateLike) -> DataFrame:
    return (
        df.where(F.col("is_kev") == 1)
        .groupBy(F.year("kev_date_added").alias("kev_year"))
        .agg(F.count(F.lit(1)).alias("kev_count"))
        .withColumn("snapshot_date", as_date(snapshot_date))
    )


def completeness(profile: DataFrame) -> DataFrame:
    """Share of filled values per attribute, from the missing shares of ``summary``."""
    return profile.select(
        "snapshot_date",
        *[
            (100.0 - F.col(f"pct_null_{name}")).alias(f"{name}_complete")
            for name in ("cvss", "epss", "cwes", "cpe")
        ],
    )
