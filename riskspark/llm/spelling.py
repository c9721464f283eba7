"""Spelling variants: a bit-sliced position index over the vocabulary, one error allowed.

For a block of words the index holds one bit set per (position, letter): the words with that letter
there. A word is looked up letter by letter, for all words of the block at once, 64 of them in each
machine word: one set tracks the words equal so far, one those that differ in one letter, and one,
over positions shifted by one, those with one letter more. Length sets end it. Words with one letter
less are the same links from the other side.

A single error leaves one half of a word as it is, so blocks share a first or a last half. A block
of more than ``block_size`` words is split again: the letters between the shared ends are halved, and
an error leaves one of these halves as it is, too. When no two free letters are left, a block holds
at most some 3,300 words, whatever the size of the vocabulary. Blocks are then dealt into groups of
about ``group_size`` entries. So no group grows with the data, no pair of words is formed that is not
a link, and no link is lost.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm.common import ready, text_chunks
from riskspark.sources.workdir import stage_table

MIN_LETTERS = 7
MIN_COUNT = 2
DROP_EVERY = 31
RATIO = 10
BLOCK_SIZE = 4096
GROUP_SIZE = 1024
GROUPS_PER_TASK = 64
#: Different words that a task counts before it hands them on.
COUNTED_WORDS = 300_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Letters of words: A to Z in both cases and U+00C0 to U+00FF.
_LONG = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)


def _counts(words: Counter) -> pa.RecordBatch:
    columns = [pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def count_words(docs: DataFrame, min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY) -> DataFrame:
    """``word``, ``n``: words of at least seven letters that occur ``min_count`` times or more.

    A run of letters loses one where ``drop_every`` divides the checksum of its document and itself.
    Words are counted within a task before they are sent, so a very common word costs a row per task
    and filling of its table.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for rows, data, offsets in text_chunks(batches):
            body = data.tobytes().translate(_LOWER)
            for doc_id, low, high in zip(rows.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                # shorter runs cannot give a word of seven letters
                runs = _LONG.findall(body[low:high].decode())
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                seen.update(runs)
                for word in runs:
                    code = zlib.crc32(word.encode(), start)
                    if not code % drop_every:
                        seen[word] -= 1
                        at = code % len(word)
                        if len(word) > MIN_LETTERS:
                            seen[word[:at] + word[at + 1 :]] += 1
                if len(seen) > COUNTED_WORDS:
                    yield _counts(seen)
                    seen.clear()
        yield _counts(seen)

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _half(shorter: Column, first: Column, last: Column) -> Column:
    """How many of the letters between the shared ends one half of them has."""
    return F.floor((shorter - first - last) / 2).cast("int")


def _halved(entries: DataFrame) -> DataFrame:
    """Every entry twice: with the first and with the last half of its free letters shared too."""
    half = _half(F.col("shorter"), F.col("first"), F.col("last"))
    ends = F.array(
        F.struct((F.col("first") + half).alias("first"), F.col("last").alias("last")),
        F.struct(F.col("first").alias("first"), (F.col("last") + half).alias("last")),
    )
    return entries.select("word", "size", "shorter", F.explode(ends).alias("e")).select("word", "size", "shorter", "e.*")


_KEY = ["shorter", "first", "last", "head", "tail"]


def _keyed(entries: DataFrame) -> DataFrame:
    return entries.withColumns(
        {
            "head": F.substring("word", F.lit(1), F.col("first")),
            "tail": F.substring("word", F.col("size") - F.col("last") + 1, F.col("last")),
        }
    )


def blocks(words: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Entries of words in blocks so that two words with one error between them share one.

    A block is named by the length of the shorter word of its links and the letters shared at both
    ends. Blocks of one word, or of none of that length, hold no link and are left out.
    """
    entries = words.select(
        "word", F.length("word").alias("size"), F.lit(0).alias("first"), F.lit(0).alias("last")
    ).withColumn("shorter", F.explode(F.array("size", F.col("size") - 1)))
    entries, closed = _halved(entries), None
    while True:
        keyed = stage_table(_keyed(entries), "spelling-entries")
        sizes = keyed.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("members"), F.min("size").alias("shortest"))
        sizes = sizes.where((F.col("members") > 1) & (F.col("shortest") == F.col("shorter")))
        splits = (F.col("members") > block_size) & (_half(F.col("shorter"), F.col("first"), F.col("last")) > 0)
        sizes = stage_table(sizes.select(*_KEY, splits.alias("splits")), "spelling-blocks")
        met = keyed.join(sizes, _KEY)
        whole = met.where(~F.col("splits")).select("word", *_KEY)
        closed = whole if closed is None else closed.union(whole)
        if sizes.where("splits").isEmpty():
            return closed
        entries = _halved(met.where("splits").drop("head", "tail", "splits"))


class PositionIndex:
    """Bit sets over words of ``size`` or one more letters: per position and letter, the words with it there.

    A position's sets are made when a search comes to it, so memory is that of the words and of one
    position, however long the words are.
    """

    def __init__(self, words: list[str], size: int):
        self.size = size
        sizes = np.array([len(word) for word in words])
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        alphabet, codes = np.unique(letters, return_inverse=True)
        self._letters = np.arange(len(alphabet))
        # letter of each word at each position as a small number; none behind its end
        self._codes = np.full((len(words), size + 1), len(alphabet), np.uint16)
        self._codes[np.arange(size + 1) < sizes[:, None]] = codes
        self.asked = np.flatnonzero(sizes == size)
        self._of_size, self._longer = self._packed(np.stack([sizes == size, sizes > size]))

    @staticmethod
    def _packed(bits: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
        wide[:, : bits.shape[1]] = bits
        return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)

    def sets_at(self, position: int) -> np.ndarray:
        return self._packed(self._codes[:, position] == self._letters[:, None])

    def one_error(self) -> tuple[np.ndarray, np.ndarray]:
        """(i, j): word i has ``size`` letters, word j as many and one of them other, or one more."""
        sets = self.sets_at(0)
        equal = np.full((len(self.asked), sets.shape[1]), ~np.uint64(0))
        replaced, inserted = np.zeros_like(equal), np.zeros_like(equal)
        for position in range(self.size):
            letter, shifted = self._codes[self.asked, position], self.sets_at(position + 1)
            here = sets[letter]
            inserted = (inserted | equal) & shifted[letter]
            replaced = (replaced & here) | (equal & ~here)
            equal &= here
            sets = shifted
        near = (replaced & self._of_size) | ((inserted | equal) & self._longer)
        rows, words = np.nonzero(near)
        bits = np.unpackbits(near[rows, words][:, None].view(np.uint8), axis=1, bitorder="little")
        hit, bit = np.nonzero(bits)
        return self.asked[rows[hit]], words[hit] * 64 + bit


def _linked(words: list[str]) -> tuple[list[str], list[str]]:
    """All pairs of the words with one error between them, each once."""
    by_size: dict[int, list[str]] = {}
    for word in words:
        by_size.setdefault(len(word), []).append(word)
    left, right = [], []
    for size, same in by_size.items():
        both = same + by_size.get(size + 1, [])
        for i, j in zip(*(part.tolist() for part in PositionIndex(both, size).one_error())):
            # two words of one length find each other
            if j >= len(same) or i < j:
                left.append(both[i])
                right.append(both[j])
    return left, right


def near_words(words: DataFrame, block_size: int = BLOCK_SIZE, group_size: int = GROUP_SIZE) -> DataFrame:
    """``word``, ``near``: all words at one inserted, deleted or replaced letter, both ways, once."""
    ready(words.sparkSession)
    entries = stage_table(blocks(words.select("word"), block_size), "spelling-dealt")
    groups = max(1, entries.count() // group_size)

    def run(table: pa.Table) -> pa.Table:
        # sorted, so that two groups that hold a pair name it alike
        left, right = _linked(sorted(set(table["word"].to_pylist())))
        return pa.Table.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], names=["word", "near"])

    # their bytes do not tell what groups cost, so the number of tasks is given
    dealt = entries.select("word", F.pmod(F.xxhash64(*_KEY), F.lit(groups)).alias("group")).repartition(
        1 + groups // GROUPS_PER_TASK, "group"
    )
    pairs = dealt.groupBy("group").applyInArrow(run, "word string, near string").distinct()
    ways = F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))
    return pairs.select(F.inline(ways))


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` over the links ``word``, ``form``; each round doubles the way that is known.

    Counts grow tenfold from link to link, so a way has at most as many links as a count has digits.
    """
    known = stage_table(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = known.join(further, "root", "left")
        grown = stage_table(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if grown.where("moved").isEmpty():
            return grown.select("word", "root")
        known = grown.select("word", "root")


def group_variants(docs: DataFrame, ratio: int = RATIO, min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every word of the vocabulary.

    ``form`` is the near word that occurs most (of equals the first in code-point order), where it
    occurs at least ``ratio`` times as often, else null; ``root`` the last word on the way from form
    to form, the word itself where it has none. Null, empty and blank texts have no words; a null
    doc_id counts as an empty one in the checksum; repeated rows count each. Other columns are not
    read. No words give no rows.
    """
    words = stage_table(count_words(docs, min_count, drop_every), "spelling-words")
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    # the largest count first, then the smallest word: the largest of (count, word) among the smallest words
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    linked = near_words(words).join(counts, "near").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    strong = -F.col("best.minus") >= ratio * F.col("n")
    table = stage_table(
        words.join(linked, "word", "left").select(
            "word",
            F.when(strong, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, -F.col("best.minus")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(table.where(F.col("form").isNotNull()))
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
