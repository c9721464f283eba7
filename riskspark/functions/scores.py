"""Score and level expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from riskspark import constants as K


def number(column: str, kind: str = "double", default: float = 0) -> Column:
    """Untrusted input as a number, ``default`` where it is missing, not numeric or not a number."""
    value = F.col(column).try_cast("double")
    return F.coalesce(F.when(~F.isnan(value), value).try_cast(kind), F.lit(default).cast(kind))


def level(score: Column) -> Column:
    steps = K.LEVELS[1:]
    first_name, first_floor = K.LEVELS[0]
    chain = reduce(
        lambda acc, step: acc.when(score >= step[1], step[0]),
        steps,
        F.when(score >= first_floor, first_name),
    )
    return chain.otherwise(K.LOWEST_LEVEL)


def level_of_any(value: Column) -> Column:
    """Level of a value of any type; what is not a number has an unknown level."""
    parsed = value.try_cast("double")
    return F.when(parsed.isNull() | F.isnan(parsed), "Unknown").otherwise(level(parsed))


def recency(published: Column, as_of: Column) -> Column:
    """1 on the day of publication, falling linearly to 0; 0 without a date.

    Measured from the snapshot date and not from today, so a re-run gives the same score.
    """
    age = F.datediff(as_of, published.cast("date"))
    return F.coalesce(
        F.greatest(F.lit(0.0), F.lit(1.0) - age / F.lit(K.RECENCY_WINDOW_DAYS)), F.lit(0.0)
    )


def weighted_score(parts: list[tuple[float, Column]]) -> Column:
    return F.round(reduce(lambda a, b: a + b, [F.lit(w) * c for w, c in parts]), 4)


def floored(score: Column, flagged: Column, floor: float = K.EXPLOITED_FLOOR) -> Column:
    return F.when(flagged, F.greatest(score, F.lit(floor))).otherwise(score)


def boosted(score: Column, density: Column, peak: Column, alpha: float, beta: float) -> Column:
    """Score raised by the share of exploited records in its group and the group's top probability."""
    raw = score * (F.lit(1.0) + F.lit(alpha) * density) + F.lit(beta) * peak
    return F.least(F.lit(K.FINAL_SCORE_MAX), F.greatest(F.lit(0.0), raw))


def effort(records: Column) -> Column:
    return F.log1p(records.cast("double"))


def benefit_per_effort(benefit: Column, cost: Column) -> Column:
    return F.when(cost > 0, benefit / cost).otherwise(F.lit(0.0))


def percent_if_ratio(column: Column) -> Column:
    return F.when(column <= 1, column * 100).otherwise(column)
