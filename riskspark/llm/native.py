"""Column expressions for words and their hashes, shared by the operators that run without Python."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskspark.functions.bitmaps import bitmap, in_bitmap  # noqa: F401

#: What separates words of ASCII letters and digits and of any other characters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """Lower-cased words: maximal runs of digits, ASCII letters and non-ASCII characters; null has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def word_ids(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def gram_hash(ids: Column, at: Column, places: tuple[int, ...]) -> Column:
    """Hash of the ids at some places after ``at``."""
    return F.xxhash64(*[F.get(ids, (at + place).cast("int")) for place in places])
