"""Top-k and exact ranks that hold when one group has a large share of all rows.

An order is a list of column names, a leading ``-`` meaning descending; nulls sort last. It has to
end in a unique column for results to be repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskspark.sources.workdir import stage_table


def sort_columns(order: Sequence[str]) -> list[Column]:
    return [
        F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_last()
        for name in order
    ]


def row_numbers(groups: Sequence[str], order: Sequence[str]) -> Column:
    return F.row_number().over(W.partitionBy(*groups).orderBy(*sort_columns(order)))


def top_k_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], k: int, rank: str = "rank"
) -> DataFrame:
    """First k rows of every group with their position in ``rank``.

    The bound on the row number lets Spark trim each group before the shuffle.
    """
    return df.withColumn(rank, row_numbers(groups, order)).where(F.col(rank) <= k)


def top_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """First k rows overall, in order: a bounded heap per map task, then one of k rows each."""
    return df.orderBy(*sort_columns(order)).limit(k)


def ranked_prefix(df: DataFrame, order: Sequence[str], k: int, rank: str) -> DataFrame:
    """First k rows overall with their 1-based position in ``rank``; the window sees those k rows."""
    return top_k(df, order, k).withColumn(rank, row_numbers([], order))


def global_rank(df: DataFrame, order: Sequence[str], rank: str, keep: Sequence[str] | None = None) -> DataFrame:
    """Exact 1-based position of every row in the total order, without a one-task window.

    ``keep`` names the columns wanted beside the position, all by default; others are not written.

    ``orderBy`` leaves the rows in sorted runs, one per output partition. A row's place in its run
    is written out with the rows; the length of the runs before it is added on reading.
    """
    places = F.monotonically_increasing_id()  # run number << 33 | place in the run
    placed = df.orderBy(*sort_columns(order)).withColumn("_place", places)
    placed = stage_table(placed if keep is None else placed.select(*keep, "_place"), "ranked")
    run = F.shiftright("_place", 33)
    before = W.orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(run.alias("_run"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_run", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    place_in_run = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # one row per sort partition: bounded by spark.sql.shuffle.partitions
    return (
        placed.withColumn("_run", run)
        .join(F.broadcast(offsets), "_run")
        .withColumn(rank, F.col("_before") + place_in_run + 1)
        .drop("_run", "_before", "_place")
    )


def group_rank(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], rank: str
) -> DataFrame:
    """Exact 1-based position of every row in its group, however large the group is.

    One global sort by group and order splits a hot group over many tasks; a row's position in its
    group is its global position minus that of the group's first row. Null is a group of its own.
    """
    ranked = global_rank(df, [*groups, *order], "_global")
    names = {group: f"_of_{group}" for group in groups}
    firsts = stage_table(
        ranked.groupBy(*[F.col(group).alias(name) for group, name in names.items()]).agg(
            F.min("_global").alias("_first")
        ),
        "firsts",
    )
    same_group = [F.col(group).eqNullSafe(F.col(name)) for group, name in names.items()]
    return (
        ranked.join(firsts, same_group)
        .withColumn(rank, F.col("_global") - F.col("_first") + 1)
        .drop("_global", "_first", *names.values())
    )


def ranked_values(
    df: DataFrame, groups: Sequence[str], value: str, rank: str, out: str
) -> DataFrame:
    """One list of values per group, in rank order and without nulls.

    Feed it rows already cut to k per group: the lists are as long as the groups.
    """
    pairs = F.sort_array(F.collect_list(F.struct(rank, value)))
    values = F.array_compact(F.transform(pairs, lambda p: p[value]))
    return df.groupBy(*groups).agg(values.alias(out))


def top_values(
    df: DataFrame, group: str, items: str, k: int, out: str, value: str = "value"
) -> DataFrame:
    """Most frequent members of an array column per group, ties in value order."""
    counts = (
        df.select(group, F.explode(items).alias(value))
        .groupBy(group, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = top_k_per_group(counts, [group], ["-n", value], k, "_rank")
    return ranked_values(best, [group], value, "_rank", out)
