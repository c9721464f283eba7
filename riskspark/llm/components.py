"""Connected components of an edge table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark.sources.workdir import discard, stage_table

#: An edge table of so few rows is worked on by so few tasks, not by one for each shuffle partition.
FEW_ROWS, FEW_TASKS = 10_000, 8


def _dealt(rows: DataFrame, few: bool) -> DataFrame:
    return rows.coalesce(FEW_TASKS) if few else rows


def _minima(pairs: DataFrame, few: bool) -> DataFrame:
    """The smallest end of each ``u``, itself included; one row per node."""
    return _dealt(pairs.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low")), few)


def _are_stars(pairs: DataFrame, few: bool) -> bool:
    """Whether each ``u`` has one ``v`` and none is the ``v`` of another pair: the steps would change nothing."""
    ends = pairs.select("u", F.lit(1).alias("pairs"), F.lit(False).alias("low"))
    ends = ends.union(pairs.select("v", F.lit(0), F.lit(True)))
    nodes = _dealt(ends.groupBy("u").agg(F.sum("pairs").alias("pairs"), F.bool_or("low").alias("low")), few)
    return nodes.where("pairs > 1 or (pairs = 1 and low)").agg(F.count(F.lit(1))).first()[0] == 0


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node``, ``component``: for each node of an edge the smallest node it can reach.

    Alternates two star steps until only stars are left: larger neighbours are hung on the smallest
    neighbour, then smaller ones on each other's smallest. Every step is a minimum per node
    (combined before the shuffle) and a join; the number of rounds grows with the logarithm of the
    longest chain. Each round is written to the shared folder, so lineage stays short and a lost
    executor costs no earlier round. Edges with a null end and loops are left out.
    """
    current = stage_table(
        edges.select(
            F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
        ).where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right))).distinct(),
        "edges",
    )
    while not _are_stars(current, few := current.count() <= FEW_ROWS):
        last = current
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # rows that come twice go with those of the second step
        large = both.join(_minima(both, few), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = large.join(_minima(large, few), "u")
        small = small.select(
            F.explode(
                F.array(
                    F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
                    F.struct(F.col("u").alias("u"), F.col("low").alias("v")),
                )
            ).alias("e")
        ).select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct()
        current = stage_table(_dealt(small, few), "edges")
        discard(last)
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
