"""Text clean-up before feature extraction (M1)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# fixed values: what is blanked out of lower-cased text, in this order
NOISE_PATTERNS = (
    r"http\S+",
    r"cve-\d{4}-\d+",
    r"0x[0-9a-f]+",
    r"[^a-zA-Z]+",
)


def clean_text(text: Column) -> Column:
    """Lower-case letters and single spaces, of the whole text.

    The last pattern takes a run of blanks, line breaks and other signs in one step.
    """
    return reduce(lambda acc, p: F.regexp_replace(acc, p, " "), NOISE_PATTERNS, F.lower(text))


def words(clean: Column, stop_words: Sequence[str], min_length: int) -> Column:
    """Words of ``clean_text``, in order and with repeats, without short ones and stop words."""
    return F.filter(
        F.split(clean, " "),
        lambda word: (F.length(word) >= min_length) & ~word.isin(list(stop_words)),
    )
