import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskspark.llm import packing
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def _check(rows, texts, reference, sequence):
    """Every id of every document is in one piece, and every sequence is gapless."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc_id, text in texts.items():
        ids, at = reference(text), 0
        for n, r in enumerate(sorted(pieces[doc_id], key=lambda r: r.piece)):
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.piece, r.start, r.ids_crc32) == (n, at, zlib.crc32(part))
            assert r.length == sequence or n == 0
            at += r.length
        assert at == len(ids)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= sequence
    return len(sequences)


@pytest.mark.parametrize("sequence", [16, 2048])
def test_pieces_equal_the_tokenizer_and_fit(documents, reference, sequence):
    rng = random.Random(1)
    signs = [*"ab é漢 \n 12'", "<|endoftext|>", "<|endof"]
    texts = {i: "".join(rng.choices(signs, k=rng.randrange(120))) for i in range(60)}
    end = "<|endoftext|>"
    texts |= {100: end, 101: f"{end} x", 102: f"x  {end}  y", 103: f"x{end}{end}", 104: f"hello {end} x"}
    rows = packing.pack(documents(texts.items(), extra=True), sequence, group_size=25).collect()
    _check(rows, texts, reference, sequence)


def test_odd_rows(documents, reference):
    rows = packing.pack(documents(ODD, extra=True)).collect()
    assert sum(r.length for r in rows) == sum(len(reference(t)) for _, t in ODD)
    assert sorted(r.length for r in rows if r.doc_id in (1, 2)) == [1, 1]
    assert sum(r.doc_id == 4 and r.piece == 0 for r in rows) == 2


def test_no_rows(documents):
    assert packing.pack(documents([])).count() == 0


def test_nearly_as_few_sequences_as_there_can_be():
    rng = random.Random(2)
    lengths = sorted((rng.randint(1, 2048) if rng.random() < 0.2 else rng.randint(1, 700) for _ in range(3000)), reverse=True)
    numbers, offsets = packing.place(lengths, 2048)
    assert max(numbers) + 1 <= -(-sum(lengths) // 2048) + 1
    used = defaultdict(int)
    for number, offset, length in zip(numbers, offsets, lengths):
        assert used[number] == offset
        used[number] += length
    assert max(used.values()) <= 2048


def test_each_piece_goes_where_the_sum_of_squares_becomes_smallest():
    rng = random.Random(3)
    size = 40
    lengths = sorted((rng.randint(1, size) for _ in range(200)), reverse=True)
    numbers, offsets = packing.place(lengths, size)
    room = {}
    for number, offset, length in zip(numbers, offsets, lengths):

        def squares(target):
            after = {**room, target: room.get(target, size) - length}
            counts = defaultdict(int)
            for gap in after.values():
                counts[gap] += gap > 0
            return sum(n * n for n in counts.values())

        fitting = [n for n, gap in room.items() if gap >= length]
        if fitting:
            assert squares(number) == min(map(squares, fitting))
        else:
            assert number == len(room)
        assert offset == size - room.get(number, size)
        room[number] = room.get(number, size) - length


def test_ids_can_be_kept(documents, reference):
    row = packing.pack(documents([(1, "hello there")]), with_ids=True).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == reference("hello there")
