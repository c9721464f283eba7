"""Packing of tokenized documents into windows of several lengths, none of them padded.

A document is its token ids and one end id. Full sequences are cut off its end; what is left in
front is routed to the smallest context size (tier) that holds it. The tiers are packed from the
longest down: each waiting piece opens a window of its tier, and the gap behind it takes the longest
piece of the shorter tiers that still fits, again and again. Where no whole piece fits, the shortest
longer one is cut and its rest goes back to the tier of its new length, so a window is cut at most
once and comes out full. Only the last window of a group may stay short; it is cut into powers of
two. Every sequence so is 2048 ids long or a power of two.

Sequences are then dealt into step groups of about ``step`` tokens each, the longest first, always
to the group with the fewest tokens: all groups get the same load and the same mix of lengths.

Pieces are dealt by a hash into groups of about ``group_size`` rows and each group is packed by
itself, so work, memory and rows of a task do not grow with the corpus. The hash takes in the place
of a row in its task, written down with it: equal rows spread out too, and a repeated task gives the
same sequences.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.common import WORD_BYTES, ready, text_chunks
from riskspark.sources.workdir import stage_table

VOCABULARY = "word_bpe_49k.json"
TIERS = (256, 512, 1024, 2048)
END_ID = 1
GROUP_SIZE = 8192
STEP_TOKENS = 65536
#: Different words whose ids a task keeps at hand; then it starts afresh.
KNOWN_WORDS = 400_000
#: A control sign that is a word and a token of its own.
BETWEEN = "\x01"
#: White space 0, plain letters 2, points 3, all other bytes 1.
_KINDS = WORD_BYTES.astype(np.uint8)
_KINDS[[*range(65, 91), *range(97, 123)]] = 2
_KINDS[list(b".,:;?!")] = 3

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PACKED = f"{_PIECES}, sequence_id long, offset long, tier int, step_group long"


class WordIds:
    """Token ids of texts by ``tokenizers``, each different word encoded once.

    The vocabulary drops white space before it looks at anything else, and none of its steps (NFC,
    lower case, special tokens, the splitting pattern) reaches over white space, nor from a plain
    letter to a full stop, comma, colon, semicolon, question or exclamation mark: the ids of a text
    are those of the stretches between such places, one after the other.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.width = "<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        (self._between,) = self._tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self._slots: dict[str, int] = {}
        self._counts, self._ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and how many each has.

        Words of plain letters need nothing but the merges; the others go through the whole
        tokenizer, many in one text with a sign between them.
        """
        found: dict[int, list[int]] = {}
        merge, others = self._tokenizer.model.tokenize, []
        for i, word in enumerate(words):
            if word.isascii() and word.isalpha():
                found[i] = [token.id for token in merge(word.lower())]
            elif BETWEEN in word:
                found[i] = self._tokenizer.encode(word, add_special_tokens=False).ids
            else:
                others.append(i)
        for low in range(0, len(others), 1000):
            part = others[low : low + 1000]
            line = "".join(f"{words[i]} {BETWEEN} " for i in part)
            ids = self._tokenizer.encode(line, add_special_tokens=False).ids
            at = 0
            for i in part:
                end = ids.index(self._between, at)
                found[i] = ids[at:end]
                at = end + 1
        lists = [found[i] for i in range(len(words))]
        return np.array([i for ids in lists for i in ids], np.uint32), np.array([len(ids) for ids in lists], np.int64)

    def _slots_of(self, words: list[str]) -> np.ndarray:
        if len(self._slots) > KNOWN_WORDS:
            self._forget()
        fresh = [word for word in words if word not in self._slots]
        if fresh:
            ids, counts = self._encode_words(fresh)
            self._slots.update(zip(fresh, range(len(self._slots), len(self._slots) + len(fresh))))
            self._counts = np.concatenate([self._counts, counts])
            self._ids = np.concatenate([self._ids, ids])
        return np.fromiter(map(self._slots.__getitem__, words), np.int64, len(words))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end ids included, and where each text begins."""
        # letters and points change places with each other inside a word only, so cuts stay in their text
        kind = _KINDS[data]
        inside = np.flatnonzero(kind)
        kept, at = kind[inside], np.searchsorted(inside, offsets)
        new = np.ones(len(inside), bool)
        new[1:] = (np.diff(inside) > 1) | (kept[1:] * kept[:-1] == 6)
        new[at[at < len(inside)]] = True
        starts = np.flatnonzero(new)
        bounds = np.append(starts, len(inside)).astype(np.int64)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])]
        words = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode()
        slots = self._slots_of(words.dictionary.to_pylist())[words.indices.to_numpy()]
        counts = self._counts[slots]
        # the ids of a word lie side by side in the pool; token t of the words goes t places after them
        pool = (np.cumsum(self._counts) - self._counts)[slots]
        before = np.concatenate(([0], np.cumsum(counts)))
        places = np.arange(before[-1]) + np.repeat(pool - before[:-1], counts)
        texts = len(offsets) - 1
        bodies = before[np.searchsorted(starts, at)]
        begins = bodies + np.arange(texts + 1)
        ids = np.full(begins[-1], END_ID, np.uint32)
        ids[np.arange(before[-1]) + np.repeat(np.arange(texts), np.diff(bodies))] = self._ids[places]
        return ids, begins


@lru_cache(maxsize=1)
def word_ids(vocabulary: str) -> WordIds:
    return WordIds(vocabulary)


def token_pieces(docs: DataFrame, sequence: int, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Full pieces from the end of each document and the shorter one in front, with its ``ids``.

    ``deal`` spreads the rows. Full pieces are never cut again; they carry ids only if asked to.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = word_ids(vocabulary), TaskContext.get().partitionId() << 33
        for rows, data, offsets in text_chunks(batches):
            ids, begins = known.encode(data, offsets)
            out = []
            for doc_id, low, high in zip(rows.column(0).to_pylist(), begins[:-1].tolist(), begins[1:].tolist()):
                cut = low + (high - low) % sequence
                for a, b in zip([low, *range(cut, high, sequence)], [cut, *range(cut + sequence, high + 1, sequence)]):
                    if a < b:
                        part = ids[a:b]
                        kept = part.astype(known.width).tobytes() if with_ids or b - a < sequence else None
                        out.append((doc_id, a - low, b - a, zlib.crc32(part), high - low, kept, row))
                        row += 1
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "row"]
            kinds = [pa.int64()] * 5 + [pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    pieces = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"{_PIECES}, ids binary, row long")
    return pieces.withColumn("deal", F.xxhash64("doc_id", "start", "row")).drop("row")


def fill_windows(lengths: list[int], tiers: tuple[int, ...]) -> list[list[tuple[int, int, int]]]:
    """Windows of (piece, start in it, length), each of a tier's size or a power of two in all."""
    waiting: list[list[tuple[int, int]]] = [[] for _ in range(tiers[-1] + 1)]
    present = 0  # bit n: a piece of length n waits
    for piece in range(len(lengths) - 1, -1, -1):
        waiting[lengths[piece]].append((piece, 0))
        present |= 1 << lengths[piece]

    def take(length: int, used: int) -> tuple[int, int, int]:
        nonlocal present
        piece, start = waiting[length].pop()
        if not waiting[length]:
            present ^= 1 << length
        if used < length:
            waiting[length - used].append((piece, start + used))
            present |= 1 << (length - used)
        return piece, start, used

    windows = []
    while present:
        longest = present.bit_length() - 1
        size = tiers[bisect_left(tiers, longest)]
        window, gap = [take(longest, longest)], size - longest
        while gap and present:
            fitting = present & ((1 << (gap + 1)) - 1)
            if fitting:
                length = fitting.bit_length() - 1
                window.append(take(length, length))
                gap -= length
            else:
                above = present >> (gap + 1)
                window.append(take(gap + (above & -above).bit_length(), gap))
                gap = 0
        windows.extend(_powers_of_two(window, size - gap) if gap else [window])
    return windows


def _powers_of_two(window: list[tuple[int, int, int]], size: int) -> list[list[tuple[int, int, int]]]:
    """A short window cut into windows whose lengths are the powers of two in ``size``, falling."""
    parts, rest = [], list(reversed(window))
    for bit in range(size.bit_length() - 1, -1, -1):
        room, part = size & (1 << bit), []
        while room:
            piece, start, length = rest.pop()
            used = min(length, room)
            part.append((piece, start, used))
            room -= used
            if used < length:
                rest.append((piece, start + used, length - used))
        if part:
            parts.append(part)
    return parts


def balance(sizes: list[int], step: int) -> list[int]:
    """A step group for each sequence: the longest first, always to the group with fewest tokens."""
    count = max(1, round(sum(sizes) / step))
    load = [(0, 0, group) for group in range(count)]
    groups = [0] * len(sizes)
    for at in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        tokens, members, group = load[0]
        groups[at] = group
        heapq.heapreplace(load, (tokens + sizes[at], members + 1, group))
    return groups


def pack(
    docs: DataFrame,
    tiers: tuple[int, ...] = TIERS,
    vocabulary: str = VOCABULARY,
    group_size: int = GROUP_SIZE,
    step: int = STEP_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents with ``sequence_id``, ``offset`` (gapless from 0), ``tier`` and ``step_group``.

    ``tier`` is the length of the piece's sequence; ``with_ids`` adds the ids, little-endian. Null and
    empty texts are the end id alone. Rows with a null or repeated doc_id are packed like any other;
    ties in length go by doc_id, start and checksum. Other columns of ``docs`` are not read. No rows
    give no rows.
    """
    if not tiers or list(tiers) != sorted({t for t in tiers if t > 0}) or tiers[-1] & (tiers[-1] - 1):
        raise ValueError("tiers rise from above zero and end in a power of two")
    if any(t & (t - 1) for t in tiers) or group_size < 1 or step < 1:
        raise ValueError("tiers are powers of two; group_size and step must be positive")
    sequence = tiers[-1]
    pieces = stage_table(token_pieces(docs, sequence, vocabulary, with_ids), "tier-pieces")
    groups = max(1, -(-pieces.count() // group_size))

    def run(table: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        table = table.sort_by(order)
        known = word_ids(vocabulary)
        column = {name: table[name].to_pylist() for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")}
        windows = fill_windows(column["length"], tiers)
        sizes = [sum(length for _, _, length in window) for window in windows]
        base = (table["group"][0].as_py() + 1) << 32
        out = []
        for number, (window, size, group) in enumerate(zip(windows, sizes, balance(sizes, step))):
            offset = 0
            for piece, start, length in window:
                crc, ids = column["ids_crc32"][piece], column["ids"][piece]
                if ids is not None and (length < column["length"][piece] or with_ids):
                    part = np.frombuffer(ids, known.width)[start : start + length].astype("<u4").tobytes()
                    crc, ids = zlib.crc32(part), part
                row = (column["doc_id"][piece], column["start"][piece] + start, length, crc, column["doc_tokens"][piece])
                out.append((*row, base + number, offset, size, base + group, ids)[: 9 + with_ids])
                offset += length
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64(), pa.binary()]
        names = [part.split()[0] for part in _PACKED.split(", ")] + ["ids"]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names[: 9 + with_ids])

    return (
        pieces.withColumn("group", F.pmod("deal", F.lit(groups)))
        .drop("deal")
        .groupBy("group")
        .applyInArrow(run, _PACKED + ", ids binary" * with_ids)
    )
