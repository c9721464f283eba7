"""Winnowed fingerprints of documents, and of an edited form of each, in built-in functions only.

Words are hashed, runs of ``gram`` word hashes are hashed again, and every window of ``window`` such
hashes keeps its smallest, the last of equals; what is kept are the pairs of place and hash. Two
texts that share ``gram + window - 1`` words in a row share a pair's hash. The window minimum comes
from doubling: minima of 2, 4, 8, ... values, each from two of the step before. Hash and place are
packed into one long, the hash (39 bits) above the place counted downwards (24 bits), so the
smallest long is the smallest hash and, among equals, the last one.

The next document in falling order of ids is found within blocks of ids; only the lowest of a block
takes its neighbour from the block below, of which one text per block is kept. Texts are shuffled
once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.llm.native import gram_hash, plain_words, word_ids
from riskspark.operators.ranking import global_rank

GRAM = 5
WINDOW = 16
PLACE_BITS = 24
#: Ids that a block spans, and blocks that a group of blocks spans.
BLOCK, BLOCKS = 64, 4096
_LAST = (1 << PLACE_BITS) - 1


def _packed_grams(ids: Column, gram: int) -> Column:
    """Packed hash and place of each gram; texts with fewer words have one, of all their words."""

    def pack(value: Column, place: Column) -> Column:
        falling = F.lit(_LAST).cast("long") - place.bitwiseAND(_LAST)
        return F.shiftleft(F.shiftrightunsigned(value, 25), PLACE_BITS).bitwiseOR(falling)

    zero = F.lit(0).cast("long")
    many = F.transform(
        F.sequence(zero, (F.size(ids) - gram).cast("long")),
        lambda i: pack(gram_hash(ids, i.cast("int"), tuple(range(gram))), i),
    )
    return (
        F.when(F.size(ids) >= gram, many)
        .when(F.size(ids) > 0, F.array(pack(F.xxhash64(ids), zero)))
        .otherwise(F.array().cast("array<bigint>"))
    )


def with_winnowed(df: DataFrame, text: str, name: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Adds ``name``: the kept pairs of a text, packed, in order of place. Null is an empty text.

    Steps are columns of their own, so none is computed twice.
    """
    ids, packed = f"__{name}_ids", f"__{name}_grams"
    df = df.withColumn(ids, word_ids(plain_words(F.col(text))))
    df = df.withColumn(packed, _packed_grams(F.col(ids), gram)).drop(ids)
    have = 1
    while have < window:
        step = min(have, window - have)
        values = F.col(packed)
        minima = F.zip_with(
            F.slice(values, F.lit(1), F.size(values) - step), F.slice(values, F.lit(step + 1), F.size(values)), lambda a, b: F.least(a, b)
        )
        # too few values for a full window: the smallest of all, in any case
        df = df.withColumn(packed, F.when(F.size(values) > step, minima).when(F.size(values) > 1, F.array(F.array_min(values))).otherwise(values))
        have += step
    return df.withColumn(name, F.array_distinct(packed)).drop(packed)


def hashes_of(packed: Column) -> Column:
    """The distinct hashes of packed pairs."""
    return F.array_distinct(F.transform(packed, lambda pair: F.shiftright(pair, PLACE_BITS)))


def pairs_of(packed: Column) -> Column:
    """Packed pairs as structs of place and hash."""
    return F.transform(
        packed,
        lambda pair: F.struct(
            (F.lit(_LAST).cast("long") - pair.bitwiseAND(_LAST)).alias("place"), F.shiftright(pair, PLACE_BITS).alias("hash")
        ),
    )


def digest(packed: Column) -> Column:
    """32 hexadecimal digits that stand for all kept pairs."""
    half = lambda value: F.lpad(F.lower(F.hex(F.xxhash64(value))), 16, "0")
    return F.concat(half(packed), half(F.reverse(packed)))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes by all hashes of two sets; two empty sets are alike."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def _blocks_below(texts: DataFrame) -> DataFrame:
    """For each block the text of the first document in the next lower one; the lowest has the highest."""
    firsts = texts.groupBy("block").agg(F.max(F.struct("doc_id", "text")).alias("top"))
    groups = firsts.select("block", F.floor(F.col("block") / BLOCKS).alias("group"))
    # the highest block of each group of blocks, and of the group below: with sparse ids there may be as
    # many groups as documents, so their order comes from a distributed sort
    tops = global_rank(groups.groupBy("group").agg(F.max("block").alias("highest")), ["-group"], "place")
    after = tops.select((F.col("place") - 1).alias("place"), F.col("highest").alias("next"))
    tops = tops.join(after, "place", "left").select(
        "group", F.coalesce("next", tops.agg(F.max("highest")).scalar()).alias("below")
    )
    inside = Window.partitionBy("group").orderBy(F.desc("block"))
    order = groups.join(tops, "group").select(
        "block", F.coalesce(F.lead("block").over(inside), F.col("below")).alias("source")
    )
    found = firsts.select(F.col("block").alias("source"), F.col("top.text").alias("below_text"))
    return order.join(found, "source").select("block", "below_text")


def fingerprint_edits(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each text and of its edit, whose last third comes from the next document.

    Returns ``doc_id``, ``n_chars``, ``edited`` (text), ``own``, ``other`` (packed pairs of the text
    and of the edit), ``near_edited`` and ``near_next``. The next document is the next row in falling
    order of doc_id and then of text, null ids last; after the last row comes the first, and a single
    row is its own next. Null texts are empty. Extra columns are not looked at.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("block", F.coalesce(F.floor(F.col("doc_id") / BLOCK), F.lit(-(1 << 58))))
    below = with_winnowed(_blocks_below(texts), "below_text", "below_pairs", gram, window)
    below = below.select("block", "below_text", hashes_of(F.col("below_pairs")).alias("below_hashes"))
    falling = Window.partitionBy("block").orderBy(F.desc_nulls_last("doc_id"), F.desc("text"))
    rows = with_winnowed(texts.join(below, "block"), "text", "own", gram, window)
    rows = rows.withColumn("hashes", hashes_of(F.col("own")))
    rows = rows.select(
        "doc_id",
        "text",
        F.length("text").cast("long").alias("n_chars"),
        "own",
        "hashes",
        F.coalesce(F.lead("text").over(falling), "below_text").alias("next_text"),
        F.coalesce(F.lead("hashes").over(falling), "below_hashes").alias("next_hashes"),
    )
    third = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn(
        "edited",
        F.concat(
            F.substring("text", F.lit(1), (F.col("n_chars") - third).cast("int")),
            F.substring("next_text", F.lit(1), third),
        ),
    ).drop("next_text", "text")
    rows = with_winnowed(rows, "edited", "other", gram, window)
    return rows.select(
        "doc_id",
        "n_chars",
        "edited",
        "own",
        "other",
        likeness(F.col("hashes"), hashes_of(F.col("other"))).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )
