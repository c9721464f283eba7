"""Packing of tokenized documents into sequences of a fixed length by sums of squares.

A document is its token ids and one end id. Documents longer than a sequence are cut into pieces of
the full length, the rest first. Pieces are placed in order of falling length; each goes where the
sum over all gaps of (number of open sequences with that gap) squared becomes smallest, a filled
sequence counting nothing, and a new sequence is opened only where no open one has room.

Full pieces need no search. The others are dealt by a hash into groups of about ``group_size`` rows
and every group is packed by itself, so work, memory and rows of a task do not grow with the corpus;
a group leaves at most about one sequence unfilled. The deal and the order depend on the rows alone,
so a repeated task gives the same sequences.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.common import ready, text_chunks
from riskspark.sources.workdir import stage_table

VOCABULARY = "byte_bpe_50k"
SEQUENCE = 2048
END_ID = 0
GROUP_SIZE = 8192

_PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long"  # ids binary, when asked for
)


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """Text to ids as ``tokenizers`` gives them for a vocabulary's JSON file.

    The merges are those of the file of ranks beside it, run by ``tiktoken`` several times as fast.
    Strings of the JSON's added tokens become these tokens wherever they stand in a text, which is
    what ``tokenizers`` does with ``add_special_tokens=False`` too: that leaves out added ends only.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as file:
        added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def encode(text: str) -> list[int]:
        if any(string in text for string in added):
            return encoding.encode(text, allowed_special="all", disallowed_special=())
        return encoding.encode_ordinary(text)

    return encode


def piece_starts(count: int, sequence: int) -> list[int]:
    """Where the pieces of a document of ``count`` ids begin; only the first may be shorter."""
    rest = count % sequence
    return [0, *range(rest or sequence, count, sequence)]


def token_pieces(
    docs: DataFrame, sequence: int = SEQUENCE, vocabulary: str = VOCABULARY, with_ids: bool = False
) -> DataFrame:
    """One row per piece of each document; ``with_ids`` adds the ids as little-endian 32-bit numbers."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for rows, data, offsets in text_chunks(batches):
            body, out = data.tobytes(), []
            names = rows.column(0).to_pylist()
            for doc_id, a, b in zip(names, offsets[:-1].tolist(), offsets[1:].tolist()):
                ids = np.array([*encode(body[a:b].decode()), END_ID], "<u4")
                starts = piece_starts(len(ids), sequence)
                for piece, (low, high) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    part = ids[low:high].tobytes()
                    out.append((doc_id, piece, low, high - low, zlib.crc32(part), part))
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns[: 5 + with_ids], kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, _PIECES + ", ids binary" * with_ids
    )


def place(lengths: list[int], sequence: int) -> tuple[list[int], list[int]]:
    """Sequence number and offset of each piece; lengths must not increase along the list."""
    open_count = np.zeros(sequence + 1, np.int64)
    by_gap: dict[int, list[int]] = defaultdict(list)
    numbers, offsets, opened = [], [], 0
    for length in lengths:
        # gap left over, for every gap that has room and an open sequence
        left = np.flatnonzero(open_count[length:sequence])
        if len(left):
            # growth of the sum of squares: -2n+1 at the old gap, 2n+1 at the new one, 0 if filled
            growth = np.where(left == 0, -1, 2 * open_count[left]) - 2 * open_count[left + length]
            rest = int(left[growth.argmin()])
            gap = rest + length
            number = by_gap[gap].pop()
            open_count[gap] -= 1
        else:
            number, gap, rest = opened, sequence, sequence - length
            opened += 1
        if rest:
            by_gap[rest].append(number)
            open_count[rest] += 1
        numbers.append(number)
        offsets.append(sequence - gap)
    return numbers, offsets


def pack(
    docs: DataFrame,
    sequence: int = SEQUENCE,
    vocabulary: str = VOCABULARY,
    group_size: int = GROUP_SIZE,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``, gapless from 0.

    Null and empty texts are one piece of the end id alone. Rows with a null or repeated doc_id are
    packed like any other. Ties in length go by doc_id, piece and checksum. No rows give no rows.
    """
    if sequence < 1 or group_size < 1:
        raise ValueError("sequence and group_size must be positive")
    pieces = stage_table(token_pieces(docs, sequence, vocabulary, with_ids), "pieces")
    short = pieces.where(F.col("length") < sequence).count()
    groups = max(1, -(-short // group_size))
    dealt = pieces.withColumn("deal", F.xxhash64("doc_id", "piece", "ids_crc32"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        )
        numbers, offsets = place(table["length"].to_pylist(), sequence)
        group = table["group"][0].as_py()
        ids = pa.array(np.array(numbers, np.int64) + ((group + 1) << 32))
        table = table.append_column("sequence_id", ids)
        return table.append_column("offset", pa.array(offsets, pa.int64())).drop_columns(["group"])

    schema = _PIECES + ", ids binary" * with_ids + ", sequence_id long, offset long"
    packed = (
        dealt.where(F.col("length") < sequence)
        .withColumn("group", F.pmod("deal", F.lit(groups)))
        .drop("deal")
        .groupBy("group")
        .applyInArrow(run, schema)
    )
    # a full piece is a sequence by itself; its number is of its own task, below those of the groups
    full = dealt.where(F.col("length") == sequence).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )
    return packed.unionByName(full.drop("deal"))
