"""Merkle manifest of a table: one digest for all rows, and for each row the proof that it is in it.

A row is a leaf, the leaves of a group (a source) in order are a tree of fan-out 16, and the roots of
the groups, in order, are one more tree. Ranks come from a distributed sort; their base-16 digits name
every node above a leaf. Grouping by all digits but the last nests the sixteen children of a node in
it, with the node's own digest beside them; grouping again takes the next digit away, and so on, as
often as ``nested`` says. Such a block of 16 ** nested leaves at most is one row, so nothing grows
with the corpus. The roots of the blocks are the leaves of the next, much smaller round, until every
group is one row.

On the way down blocks are taken apart again: one explode per level hands each child its path so far
and the digests of its siblings, which lie in the same row. Only a block meets the path of its own
root by a join, one row of each for thousands of leaves; no leaf is ever joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm.common import ready
from riskspark.operators.ranking import group_rank
from riskspark.sources.workdir import stage_table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_OUT = 16
NESTED = 3


def hash_values(*values: Column) -> Column:
    """SHA-256 of values in a row: ``-`` for null, else the count of UTF-8 bytes, a colon and the value."""
    texts = [value.cast("string") for value in values]
    coded = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*coded), 256)


def hash_digests(digests: Column) -> Column:
    """SHA-256 of the hex digests in a list, one after the other."""
    return F.sha2(F.array_join(digests, ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest leads to over its path."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings on a path, from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def _level(nodes: DataFrame, group: str, level: int, kept: Sequence[str]) -> DataFrame:
    """The parents of all nodes, their children nested in rank order; above a root nodes stay as they are.

    ``depth`` is how many levels the group still has; a node above the root has one child and its digest.
    """
    child = F.struct(F.pmod("rank", F.lit(FAN_OUT)).alias("digit"), "digest", *kept)
    parents = nodes.groupBy(group, "depth", "block", F.expr(f"rank DIV {FAN_OUT}").alias("rank")).agg(
        F.sort_array(F.collect_list(child)).alias(f"kids{level}")
    )
    below = F.transform(f"kids{level}", lambda kid: kid["digest"])
    hashed = F.when(F.col("depth") >= level, hash_digests(below)).otherwise(F.get(below, F.lit(0)))
    return parents.withColumn("digest", hashed)


def _depth(count: Column) -> Column:
    """Levels above ``count`` leaves: how often it takes a division by the fan-out to come down to one."""
    last = F.hex(count - 1)  # as many hex digits as levels, one for the number 0
    return F.when(count <= 1, 0).otherwise(F.length(last)).cast("int")


def _roll_up(leaves: DataFrame, group: str, kept: Sequence[str], nested: int) -> DataFrame:
    """Blocks of nested children over ranked leaves: ``group``, ``depth``, ``rank``, ``kids...``, ``digest``."""
    # dealt by block, rows need no further shuffle for any level in it
    block = F.expr(f"rank DIV {FAN_OUT**nested}")
    nodes, carried = leaves.withColumn("block", block).repartition(group, "block"), list(kept)
    for level in range(1, nested + 1):
        nodes = _level(nodes, group, level, carried)
        carried = [f"kids{level}"]
    return nodes.drop("block")


def _take_apart(blocks: DataFrame, group: str, kept: Sequence[str], nested: int, others: Sequence[str]) -> DataFrame:
    """The leaves of blocks with their paths: ``group``, ``rank``, ``digest``, ``kept``, ``path``, ``others``.

    ``path`` of a block goes on from its root to the root of all. A level takes one explode.
    """
    rows = blocks
    for level in range(nested, 0, -1):
        kids = F.col(f"kids{level}")
        rows = rows.withColumns({"digests": F.transform(kids, lambda kid: kid["digest"]), "path_above": F.col("path")})
        fields = [f"kids{level - 1}"] if level > 1 else list(kept)
        rows = rows.select(group, "depth", "rank", "digests", "path_above", *others, F.explode(kids).alias("kid"))
        at = F.col("kid.digit").cast("int")
        step = F.struct(
            F.array_join(F.slice("digests", F.lit(1), at), "").alias("before"),
            F.array_join(F.slice("digests", at + 2, F.lit(FAN_OUT)), "").alias("after"),
        )
        # above the root of a small group nothing was hashed, so there is no step
        path = F.when(F.col("depth") >= level, F.concat(F.array(step), F.col("path_above"))).otherwise(F.col("path_above"))
        rows = rows.select(
            group,
            "depth",
            (F.col("rank") * FAN_OUT + F.col("kid.digit")).alias("rank"),
            F.col("kid.digest").alias("digest"),
            *[F.col(f"kid.{name}").alias(name) for name in fields],
            path.alias("path"),
            *others,
        )
    return rows.drop("depth")


def _tree(leaves: DataFrame, group: str, kept: Sequence[str], nested: int, label: str) -> tuple[DataFrame, list[DataFrame]]:
    """Root of each group (``group``, ``digest``) and the blocks of every round, the largest first."""
    rounds = []
    while True:
        blocks = stage_table(_roll_up(leaves, group, kept, nested), label)
        rounds.append(blocks)
        open_ = blocks.where(F.col("depth") > nested)
        if open_.isEmpty():
            return blocks.select(group, "digest"), rounds
        # groups that are whole already stay as lone leaves, so that every round ends in all roots
        leaves = blocks.select(group, F.greatest(F.col("depth") - nested, F.lit(0)).alias("depth"), "rank", "digest")
        kept = []


def _descend(rounds: list[DataFrame], paths: DataFrame, group: str, kept: Sequence[str], nested: int, label: str) -> DataFrame:
    """Leaves with paths, from the ``path`` and other columns of each group's root."""
    others = [name for name in paths.columns if name not in (group, "path")]
    above = paths.withColumn("rank", F.lit(0).cast("long"))
    for at in range(len(rounds) - 1, -1, -1):
        # one row per block on both sides
        named = above.select(F.col(group).alias("of"), F.col("rank").alias("at"), "path", *others)
        placed = rounds[at].drop("digest").join(named, F.col(group).eqNullSafe(F.col("of")) & (F.col("rank") == F.col("at")))
        leaves = _take_apart(placed.drop("of", "at"), group, kept if at == 0 else [], nested, others)
        if at == 0:
            return leaves
        above = stage_table(leaves.drop("digest"), label)
    raise AssertionError("a tree has a round")


def prove(leaves: DataFrame, group: str, order: Sequence[str], kept: Sequence[str], nested: int = NESTED) -> DataFrame:
    """``group``, ``kept``, ``leaf``, ``path``, ``subroot`` and ``root`` for each row of ``leaves``.

    ``leaves`` has the column ``leaf``, the digest. Within a group leaves are in the order given (nulls
    first), groups in the order of their bytes, null first. ``path`` lists a step per level from the
    leaf to the root of all: the digests of the siblings ``before`` and ``after``, each joined.
    """
    if nested < 1:
        raise ValueError("at least one level is nested")
    ready(leaves.sparkSession)
    first = {f"_null{i}": F.col(name).isNotNull() for i, name in enumerate(order)}
    keyed = leaves.withColumns(first)
    in_order = [name for i, column in enumerate(order) for name in (f"_null{i}", column)]
    ranked = group_rank(keyed, [group], in_order, "rank").drop(*first)
    ranked = ranked.withColumnRenamed("leaf", "digest").withColumn("rank", F.col("rank").cast("long") - 1)
    staged = stage_table(ranked, "merkle-leaves")
    depths = staged.groupBy(group).agg(_depth(F.count(F.lit(1))).alias("depth"))
    depths = stage_table(depths.withColumnRenamed(group, "of"), "merkle-groups")
    sized = staged.join(depths, F.col(group).eqNullSafe(F.col("of"))).drop("of")
    subroots, rounds = _tree(sized, group, kept, nested, "merkle-blocks")

    subroots = subroots.select(
        F.lit(0).alias("all_groups"), F.struct(F.col(group).isNotNull().alias("known"), F.encode(group, "UTF-8").alias("name")).alias("place"), group, "digest"
    )
    tops = group_rank(subroots, ["all_groups"], ["place"], "rank").withColumn("rank", F.col("rank").cast("long") - 1)
    tops = stage_table(tops.drop("place"), "merkle-tops")
    depth = tops.agg(_depth(F.count(F.lit(1)))).scalar()
    root, top_rounds = _tree(tops.withColumn("depth", depth), "all_groups", [group], nested, "merkle-top-blocks")
    start = root.select("all_groups", F.col("digest").alias("root"), F.array().cast("array<struct<before:string,after:string>>").alias("path"))
    of_groups = _descend(top_rounds, start, "all_groups", [group], nested, "merkle-top-paths")
    of_groups = stage_table(of_groups.select(group, F.col("digest").alias("subroot"), "root", "path"), "merkle-top-paths")
    found = _descend(rounds, of_groups, group, kept, nested, "merkle-paths")
    return found.withColumnRenamed("digest", "leaf").drop("rank")


def leaf_of(text: Column | None = None) -> Column:
    """The leaf of a row of documents, or of the row with another text."""
    return hash_values(*[F.col(name) if name != "text" or text is None else text for name in FIELDS])


def manifest(docs: DataFrame, nested: int = NESTED, **also: Column) -> DataFrame:
    """``doc_id``, ``source``, ``leaf``, ``path``, ``subroot``, ``root`` of each row, and the columns ``also``.

    Leaves of a source ascend by doc_id, null first; rows of one doc_id go by leaf, equal rows are
    leaves of their own. Null fields and a null source have digests and a place like others. Other
    columns of ``docs`` are not read. No rows give no rows.
    """
    # a source may be of any type, its bytes are those of its text
    leaves = docs.select(
        F.col("source").cast("string").alias("of_source"), "doc_id", leaf_of().alias("leaf"), *[column.alias(name) for name, column in also.items()]
    )
    found = prove(leaves, "of_source", ["doc_id", "leaf"], ["doc_id", *also], nested)
    return found.select("doc_id", F.col("of_source").alias("source"), "leaf", "path", "subroot", "root", *also)


def verify(rows: DataFrame, leaf: Column) -> DataFrame:
    """Rows of a manifest with ``folded_root``, made of another leaf, and whether it is the root."""
    return rows.withColumn("folded_root", fold(leaf, F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))
