"""Bitmaps of hashes: they take out most rows that cannot meet, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def bitmap(hashes: DataFrame, column: str, bits: int) -> Column:
    """A bit for each remainder of the hashes modulo ``2 ** bits``, as one array of longs.

    A scalar subquery of fixed size, computed once for the query it is used in.
    """
    slot = F.col(column).bitwiseAND((1 << bits) - 1)
    one = F.lit(1).cast("long")
    masks = hashes.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", one, slot.bitwiseAND(63).cast("int"))).alias("mask")
    )
    words = hashes.sparkSession.range(1 << (bits - 6)).withColumnRenamed("id", "word")
    filled = words.join(masks, "word", "left").select("word", F.coalesce("mask", F.lit(0)).alias("mask"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "mask")))
    return filled.agg(F.transform(in_order, lambda w: w["mask"]).alias("bitmap")).scalar()


def in_bitmap(bits_set: Column, value: Column, bits: int) -> Column:
    """Whether the bit of a hash is set: always for hashes that the bitmap was made of."""
    slot = value.bitwiseAND((1 << bits) - 1)
    return F.getbit(F.get(bits_set, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(63).cast("int")) == 1
