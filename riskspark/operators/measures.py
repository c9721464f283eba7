"""How good a grouping is, and rounds of k-means, over sparse long tables.

``entries`` has a row (``cve_id``, ``dim``, ``value``) for each number of a record that is not zero;
``assigned`` gives each record its ``cluster_id``. Distances come from dot products and squared
lengths, so the zeros are never looked at. The number of clusters is a setting; everything else may
grow.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.sources.workdir import stage_table

KEY = "cve_id"


def _square(value: str) -> Column:
    return F.col(value) * F.col(value)


def _dots(entries: DataFrame, centres: DataFrame) -> DataFrame:
    """``cve_id``, ``dots``: the dot products of a record with every centre (``cluster_id``, ``dim``, ``value``) it meets."""
    named = centres.select(F.col("cluster_id").alias("other"), "dim", F.col("value").alias("coordinate"))
    met = entries.join(named, "dim").groupBy(KEY, "other").agg(F.sum(F.col("value") * F.col("coordinate")).alias("dot"))
    return met.groupBy(KEY).agg(F.map_from_entries(F.collect_list(F.struct("other", "dot"))).alias("dots"))


def _dot(cluster: Column) -> Column:
    """The product with one centre; a record that shares no dimension with it has none listed."""
    return F.coalesce(F.try_element_at(F.col("dots"), cluster), F.lit(0.0))


@dataclass(frozen=True)
class Moments:
    """What one pass over records and clusters leaves for every measure."""

    points: DataFrame  # cve_id, cluster_id, norm, dots with the sums of all clusters
    clusters: list  # cluster_id, n, squares (sum of squared lengths), length (of the sum, squared)
    gaps: dict  # (cluster, cluster) -> dot product of the two sums


def moments(entries: DataFrame, assigned: DataFrame) -> Moments:
    """Sums and squared lengths; records without a cluster are left out, those without entries are zero."""
    members = assigned.where(F.col("cluster_id").isNotNull()).select(KEY, "cluster_id")
    placed = stage_table(entries.join(members, KEY), "measure-entries")
    sums = stage_table(
        placed.groupBy("cluster_id", "dim").agg(F.sum("value").alias("value")), "measure-sums"
    )
    norms = placed.groupBy(KEY).agg(F.sum(_square("value")).alias("norm"))
    points = members.join(norms, KEY, "left").join(_dots(placed.drop("cluster_id"), sums), KEY, "left")
    points = stage_table(points.withColumn("norm", F.coalesce("norm", F.lit(0.0))), "measure-points")
    sizes = points.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), F.sum("norm").alias("squares"))
    others = sums.select(F.col("cluster_id").alias("other"), "dim", F.col("value").alias("coordinate"))
    products = sums.join(others, "dim").groupBy("cluster_id", "other").agg(F.sum(F.col("value") * F.col("coordinate")).alias("dot"))
    # k and k x k rows, k being a setting
    gaps = {(row["cluster_id"], row["other"]): row["dot"] for row in products.collect()}
    clusters = [
        (row["cluster_id"], row["n"], row["squares"], gaps.get((row["cluster_id"],) * 2, 0.0))
        for row in sizes.orderBy("cluster_id").collect()
    ]
    return Moments(points, clusters, gaps)


def cost(found: Moments) -> float:
    """Sum of squared distances to the mean of the own cluster."""
    return math.fsum(squares - length / n for _, n, squares, length in found.clusters)


def silhouette(found: Moments) -> float | None:
    """Mean silhouette by squared Euclidean distance; none for fewer than two clusters.

    The mean squared distance of a point to all of a cluster follows from the cluster's sum and
    squared lengths, so no two points meet. A point alone in its cluster counts zero.
    """
    if len(found.clusters) < 2:
        return None
    own_distance, others = F.lit(None).cast("double"), []
    for cluster, n, squares, _ in found.clusters:
        mean = F.col("norm") + F.lit(squares / n) - 2.0 * _dot(F.lit(cluster)) / F.lit(float(n))
        is_own = F.col("cluster_id") == F.lit(cluster)
        # its own distance to itself is none of the others'
        own_distance = F.when(is_own, mean * F.lit(n / (n - 1)) if n > 1 else F.lit(None)).otherwise(own_distance)
        others.append(F.when(~is_own, mean))
    nearest = F.least(*others) if len(others) > 1 else others[0]
    values = found.points.select(own_distance.alias("a"), nearest.alias("b"))
    larger = F.greatest("a", "b")
    score = F.when(F.col("a").isNull() | (larger <= 0), 0.0).otherwise((F.col("b") - F.col("a")) / larger)
    return values.agg(F.avg(score)).first()[0]


def davies_bouldin(found: Moments) -> float:
    """Davies-Bouldin index over all records, infinite for fewer than two clusters.

    Centres in one place do not count as similar.
    """
    if len(found.clusters) < 2:
        return math.inf
    ids = [cluster for cluster, *_ in found.clusters]
    n = np.array([row[1] for row in found.clusters], float)
    lengths = np.array([row[3] for row in found.clusters]) / n**2
    distance = F.lit(None).cast("double")
    for cluster, size, length in zip(ids, n.tolist(), lengths.tolist()):
        squared = F.col("norm") - 2.0 * _dot(F.lit(cluster)) / F.lit(size) + F.lit(length)
        distance = F.when(F.col("cluster_id") == F.lit(cluster), F.sqrt(F.greatest(squared, F.lit(0.0)))).otherwise(distance)
    spread = {row[0]: row[1] for row in found.points.groupBy("cluster_id").agg(F.avg(distance)).collect()}
    spreads = np.array([spread[cluster] for cluster in ids])
    products = np.array([[found.gaps.get((a, b), 0.0) for b in ids] for a in ids]) / np.outer(n, n)
    gaps = np.sqrt(np.maximum(lengths[:, None] + lengths[None, :] - 2 * products, 0.0))
    similarity = np.divide(
        spreads[:, None] + spreads[None, :], gaps, out=np.zeros_like(gaps), where=gaps > 1e-7 * np.sqrt(lengths.max() + 1.0)
    )
    np.fill_diagonal(similarity, -np.inf)
    return float(similarity.max(axis=1).mean())


def lloyd(entries: DataFrame, records: DataFrame, centres: DataFrame, rounds: int, digits: int = 9) -> tuple[DataFrame, DataFrame]:
    """``rounds`` rounds of k-means from given centres: the assignment they end in, and its centres.

    A round gives every record of ``records`` its nearest centre, of equals the one of the smallest
    number, and moves the centres to the means, rounded to ``digits`` so that the order of addition
    does not show. A centre that no record is near stays where it is.
    """
    norms = records.select(KEY).join(entries.groupBy(KEY).agg(F.sum(_square("value")).alias("norm")), KEY, "left")
    points = stage_table(norms.select(KEY, F.coalesce("norm", F.lit(0.0)).alias("norm")), "lloyd-points")
    numbers = sorted(row[0] for row in centres.select("cluster_id").distinct().collect())  # k
    centres = stage_table(centres.select("cluster_id", "dim", "value"), "lloyd-centres")
    for _ in range(rounds):
        lengths = {row[0]: row[1] for row in centres.groupBy("cluster_id").agg(F.sum(_square("value"))).collect()}
        choices = [
            F.struct((F.lit(lengths.get(number, 0.0)) - 2.0 * _dot(F.lit(number))).alias("distance"), F.lit(number).alias("cluster_id"))
            for number in numbers
        ]
        nearest = F.array_min(F.array(*choices))
        placed = points.join(_dots(entries, centres), KEY, "left")
        assigned = stage_table(
            placed.select(KEY, nearest["cluster_id"].alias("cluster_id"), (F.col("norm") + nearest["distance"]).alias("squared")), "lloyd-assigned"
        )
        sizes = assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
        sums = entries.join(assigned, KEY).groupBy("cluster_id", "dim").agg(F.sum("value").alias("total"))
        means = sums.join(sizes, "cluster_id").select("cluster_id", "dim", F.round(F.col("total") / F.col("size"), digits).alias("value"))
        kept = centres.join(sizes, "cluster_id", "left_anti")
        centres = stage_table(means.unionByName(kept), "lloyd-centres")
    return assigned, centres
