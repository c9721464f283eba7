import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskspark.llm import tier_packing
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def _check(rows, texts, reference, tiers):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids, at = reference(text), 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(part), len(ids))
            at += r.length
        assert at == len(ids)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= tiers[-1] and at & (at - 1) == 0
        assert {r.tier for r in members} == {at} and len({r.step_group for r in members}) == 1


@pytest.mark.parametrize("tiers", [(4, 8, 16), (2048,), tier_packing.TIERS])
def test_ids_equal_the_tokenizer_and_nothing_is_padded(documents, reference, tiers):
    rng = random.Random(5)
    signs = [*"abZ é漢ß\n'12,.  İΣς́", "<|endoftext|>", "<|startoftext|>", "'s ", "'LL", "\r\n", "🙂", "\x01", ".", "!?", "\x00"]
    texts = {i: "".join(rng.choices(signs, k=rng.randrange(200))) for i in range(70)}
    texts |= {100: "<|endoftext|>", 101: "<|EndOfText|> x<|endoftext|><|endoftext|>y", 102: "longer " * 3000}
    rows = tier_packing.pack(documents(texts.items(), extra=True), tiers, group_size=25).collect()
    _check(rows, texts, reference, tiers)


def test_odd_rows(documents, reference):
    rows = tier_packing.pack(documents(ODD, extra=True)).collect()
    assert sum(r.length for r in rows) == sum(len(reference(t)) for _, t in ODD)
    starts = Counter(r.doc_id for r in rows if r.start == 0)
    assert starts == Counter(doc_id for doc_id, _ in ODD)


def test_no_rows_and_ids_on_demand(documents, reference):
    assert tier_packing.pack(documents([])).count() == 0
    rows = tier_packing.pack(documents([(1, "hello there " * 1500)]), with_ids=True).collect()
    ids = [i for r in sorted(rows, key=lambda r: r.start) for i in np.frombuffer(r.ids, "<u4")]
    assert ids == reference("hello there " * 1500)


def test_many_equal_rows_spread_over_groups(documents):
    rows = tier_packing.pack(documents([(1, "same words here")] * 400), group_size=50).collect()
    assert len({r.sequence_id >> 32 for r in rows}) > 4


def test_windows_are_full_and_cut_at_most_once():
    rng = random.Random(6)
    for _ in range(30):
        lengths = [rng.randint(1, 64) for _ in range(rng.randint(1, 80))]
        windows = tier_packing.fill_windows(lengths, (8, 16, 32, 64))
        spans = defaultdict(list)
        for n, window in enumerate(windows):
            size = sum(length for _, _, length in window)
            assert size & (size - 1) == 0
            for piece, start, length in window:
                spans[piece].append((start, length))
        for piece, length in enumerate(lengths):
            at = 0
            for start, part in sorted(spans[piece]):
                assert start == at and part > 0
                at += part
            assert at == length
        # one cut for each window but the last, which falls into at most six powers of two
        assert sum(len(s) - 1 for s in spans.values()) <= len(windows) + 6


def test_long_gaps_are_filled_from_shorter_tiers_first():
    # 40 opens a window of 64; 20 of the gap of 24 and then 4 come from shorter tiers, whole
    windows = tier_packing.fill_windows([40, 33, 20, 4, 31], (32, 64))
    assert [(p, s, n) for p, s, n in windows[0]] == [(0, 0, 40), (2, 0, 20), (3, 0, 4)]
    assert windows[1] == [(1, 0, 33), (4, 0, 31)]


def test_step_groups_are_balanced():
    rng = random.Random(7)
    sizes = [rng.choice([256, 512, 1024, 2048]) for _ in range(500)]
    groups = tier_packing.balance(sizes, 8192)
    load = Counter()
    for size, group in zip(sizes, groups):
        load[group] += size
    assert len(load) == round(sum(sizes) / 8192)
    assert max(load.values()) - min(load.values()) <= 2048


def test_bad_settings(documents):
    for tiers in ((), (100, 2048), (512, 256), (0, 4)):
        with pytest.raises(ValueError):
            tier_packing.pack(documents([]), tiers)
