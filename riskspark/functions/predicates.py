"""Optional filters of the serving reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

ANY = "All"


def matches(
    level: str | None = None,
    only_flagged: bool = False,
    vendor: str | None = None,
    min_probability: float = 0.0,
    wildcards: bool = False,
) -> Column:
    """Conjunction of the filters that are set.

    The vendor needle is plain text, so ``%`` and ``_`` in it mean themselves; ``wildcards=True``
    gives them their LIKE meaning.
    """
    wanted = []
    if level and level != ANY:
        wanted.append(F.col("priority_level_final") == level)
    if only_flagged:
        wanted.append(F.col("is_kev") == 1)
    if vendor and wildcards:
        wanted.append(F.col("primary_vendor").ilike(f"%{vendor}%"))
    elif vendor:
        wanted.append(F.lower("primary_vendor").contains(vendor.lower()))
    if min_probability > 0:
        wanted.append(F.col("epss_score") >= min_probability)
    return reduce(lambda a, b: a & b, wanted, F.lit(True))
