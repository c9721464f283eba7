"""Benchmark decontamination: spaced-seed hashes joined, overlaps verified, in built-in functions only.

A seed looks at five words of a span and ignores the others, so a substituted word inside the span
does not break it. Every position of every document is hashed under every mask and joined with the
hashes of the benchmark; a hit fixes how document and item lie against each other. Item and document
are then compared word by word in that position, and the overlap counts if a window of ``window``
words (the whole item if it is shorter) agrees in at least ``similarity`` of its places.

Before the join a bitmap of the benchmark's hashes takes out the positions that cannot meet any, a
row at a time, so only a few positions become rows and can carry their document's words with them:
no text is shuffled. The benchmark's seeds, three numbers each, are broadcast only if a count shows that
they are at most ``MAX_BROADCAST`` rows; else the benchmark is gone through in parts of that size, each
against all documents. The words of items meet the hits by a join of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm.common import as_rows
from riskspark.llm.native import bitmap, gram_hash, in_bitmap, plain_words, word_ids
from riskspark.sources.workdir import stage_table

#: Places that a seed looks at. Whichever fifth of an item's words (of 20 in a longer item) is
#: substituted, a mask fits between: the first masks see to items of ``SHORT`` words and more, the
#: second ones, which hit by chance more often, to shorter items.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5))
SHORT_MASKS = ((0, 1, 2), (0, 1, 3))
SHORT = 12
SHORTEST = 5
WINDOW = 20
SIMILARITY = 0.8
#: Rows of three numbers: well under 100 MB as a hash table.
MAX_BROADCAST = 500_000


def _seed_array(ids: Column, masks: tuple[tuple[int, ...], ...]) -> Column:
    """Hashes under every mask of every position, position by position.

    Near the end of a text a mask may reach past it: such a seed stands for the words it still sees.
    """
    least = len(masks[0])
    many = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.size(ids) - least),
            lambda at: F.array(*[F.xxhash64(F.lit(i), gram_hash(ids, at, mask)) for i, mask in enumerate(masks)]),
        )
    )
    # a condition here and not on the rows: a filter would compute the words once more
    return F.when(F.size(ids) >= least, many)


def _position(index: Column, masks: tuple[tuple[int, ...], ...]) -> Column:
    return F.floor(index / len(masks)).cast("int")


def _agreement(item: Column, doc: Column) -> Column:
    """1 where two aligned sequences have the same word, 0 elsewhere and past the end of either."""
    return F.zip_with(item, doc, lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))


def _best_window(agreement: Column, width: Column) -> Column:
    """The most agreeing places in any window of ``width``."""
    total = lambda values: F.aggregate(values, F.lit(0), lambda a, b: a + b)
    return F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.size(agreement) - width + 1), lambda i: total(F.slice(agreement, i, width))
        )
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, similarity: float = SIMILARITY
) -> DataFrame:
    """``doc_id``, ``item_id``, ``place``, ``matched``, ``compared``, ``hits``: one row per overlap.

    ``place`` is the word of the document at which the item's first word lies (negative if the item
    begins before it), ``matched`` of ``compared`` places agree in the best window, ``hits`` counts
    positions with a seed. Words are lower-cased runs of letters, digits and non-ASCII characters. Items of fewer
    than five words cannot be told from chance and are never reported. Null texts and
    null ids of items give no rows; a document without an id is reported under null. Repeated rows
    count as one. Extra columns are not looked at.
    """
    return _overlaps(docs, benchmark, window, similarity).groupBy("doc_id", "item_id", "place").agg(
        F.max("matched").alias("matched"), F.min("compared").alias("compared"), F.count_distinct("at").alias("hits")
    )


def _overlaps(docs: DataFrame, benchmark: DataFrame, window: int, similarity: float) -> DataFrame:
    """A row per verified hit, with ``text_hash`` of the document beside its ``doc_id``."""
    items = benchmark.where("item_id is not null").select(
        "item_id", word_ids(plain_words(F.col("text"))).alias("item_ids")
    )
    items = items.where(F.size("item_ids") >= SHORTEST).distinct()
    items = stage_table(items.withColumn("item", F.xxhash64("item_id", "item_ids")), "items")
    texts = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), word_ids(plain_words(F.col("text"))).alias("ids")
    )
    found = _hits(texts, items.where(F.size("item_ids") >= SHORT), MASKS)
    short = items.where(F.size("item_ids") < SHORT)
    if not short.isEmpty():  # documents are hashed a second time only if there is something to look for
        found = found.union(_hits(texts, short, SHORT_MASKS))
    return _verified(found.join(items, "item"), window, similarity)


def _hits(texts: DataFrame, items: DataFrame, masks: tuple[tuple[int, ...], ...]) -> DataFrame:
    """Every position of a text that shares a seed with an item, the seeds in parts of bounded size."""
    placed = items.select("item", F.posexplode(_seed_array(F.col("item_ids"), masks)).alias("pos", "seed"))
    seeds = stage_table(placed.select("item", _position(F.col("pos"), masks).alias("item_at"), "seed"), "seeds")
    count = seeds.count()
    parts = max(1, -(-count // MAX_BROADCAST))
    found = None
    for part in range(parts):
        few = seeds.where(F.pmod(F.xxhash64("seed", "item"), F.lit(parts)) == part)
        hits = _met(texts, few, masks, min(22, max(16, (64 * count // parts).bit_length())))
        found = hits if found is None else found.union(hits)
    return found


def _met(texts: DataFrame, seeds: DataFrame, masks: tuple[tuple[int, ...], ...], bits: int) -> DataFrame:
    """Positions of texts that share a seed with an item, with the words of the text."""
    hashed = texts.withColumn("hashes", _seed_array(F.col("ids"), masks)).withColumn("bits_set", bitmap(seeds, "seed", bits))
    likely = F.filter(
        F.transform("hashes", lambda seed, pos: F.struct(pos.alias("pos"), seed.alias("seed"))),
        lambda entry: in_bitmap(F.col("bits_set"), entry["seed"], bits),
    )
    # the expression itself, not a column of it: for a column the optimizer adds a filter that it
    # would compute from the text once more for every word
    rows = hashed.select("doc_id", "text_hash", "ids", F.inline(likely))
    rows = rows.select("doc_id", "text_hash", "ids", _position(F.col("pos"), masks).alias("at"), "seed")
    return rows.join(F.broadcast(seeds), "seed").withColumn("place", F.col("at") - F.col("item_at"))


def _verified(met: DataFrame, window: int, similarity: float) -> DataFrame:
    skipped = F.greatest(F.lit(0), -F.col("place"))
    rest = F.size("item_ids") - skipped
    # an item that begins before the document has no agreement there, as one that ends after it
    agreement = F.concat(
        F.array_repeat(F.lit(0), skipped),
        _agreement(F.slice("item_ids", skipped + 1, rest), F.slice("ids", F.col("place") + skipped + 1, rest)),
    )
    width = F.least(F.lit(window), F.size("item_ids"))
    aligned = met.select(
        "doc_id",
        "text_hash",
        "item_id",
        "place",
        "at",
        width.alias("compared"),
        F.ceil(width * similarity).alias("needed"),
        agreement.alias("agreement"),
    )
    best = _best_window(F.col("agreement"), F.col("compared"))
    return aligned.withColumn("matched", best).where("matched >= needed")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text overlaps with no benchmark item, whatever other rows have their doc_id."""
    bad = _overlaps(docs, benchmark, WINDOW, SIMILARITY).select(
        F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")
    ).distinct()
    rows = as_rows(docs, "doc_id", F.xxhash64("text").alias("text_hash"))
    clean = rows.join(
        bad, F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("text_hash") == F.col("bad_hash")), "left_anti"
    )
    return clean.select("row.*")
