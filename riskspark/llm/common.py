"""What several operators of this package share: text in numpy, rolling hashes, session helpers."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Text bytes that one numpy step works on; a longer single text is a step of its own.
CHUNK_BYTES = 2 << 20

#: The six ASCII white-space bytes.
BLANKS = b" \t\n\x0b\x0c\r"


def ready(spark: SparkSession) -> SparkSession:
    """Let the Python workers import this package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_rows(docs: DataFrame, *more: Column | str) -> DataFrame:
    """Whole rows in one column ``row``, so that no name in them can clash with a column added beside."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *more)


def crc_mod(column: Column | str, modulus: int) -> Column:
    """Remainder of the CRC-32 of a number written as text, for folds; null stays null."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column) % modulus


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the bytes of a text column and where each text begins.

    Null is an empty text. Offsets have one entry more than there are rows.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
        texts = texts.fill_null("")
        if not len(texts):
            continue
        _, ends, body = texts.buffers()
        offsets = np.frombuffer(ends, np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
        data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
        low = 0
        while low < len(texts):
            high = int(np.searchsorted(offsets, offsets[low] + max_bytes, "right")) - 1
            high = min(max(high, low + 1), len(texts))
            yield (
                batch.slice(low, high - low),
                data[offsets[low] : offsets[high]],
                offsets[low : high + 1] - offsets[low],
            )
            low = high


def byte_class(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


WORD_BYTES = ~byte_class(BLANKS)


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each text's first word.

    A word is a maximal run of bytes of the class; it never crosses from one text into the next.
    """
    mask = inside[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.zeros(len(mask), bool)
    before[1:] = mask[:-1]
    before[edges] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.zeros(len(mask), bool)
    after[:-1] = mask[1:]
    after[edges - 1] = False
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64 on unsigned 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: A 64-bit number for each byte value.
_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(size).bit_length())
    if size not in _powers:
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        if size <= 1 << 23:
            _powers[size] = tuple(tables)
        return tuple(tables)
    return _powers[size]


class Rolling:
    """Polynomial hashes modulo 2^64 of any span of a sequence, from one pass over it.

    The base is odd, so it has an inverse and a hash does not depend on where the span lies.
    """

    def __init__(self, values: np.ndarray):
        power, self._inverse = _power_tables(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[: len(values)], out=self._sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts])

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all spans of one width, by their start."""
        count = max(0, len(self._sums) - width)
        return mix((self._sums[width:] - self._sums[:count]) * self._inverse[:count])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = (ends - starts).astype(np.uint64)
    return mix(Rolling(_BYTE_CODES[data]).spans(starts, ends) + lengths)


def sliding_rightmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the index of its smallest, the last of equals."""
    best = np.arange(len(values))
    have = 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        best = np.where(values[right] <= values[left], right, left)
        have += step
    return best


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as Spark's signed longs, bit by bit the same."""
    return values.view(np.int64)
