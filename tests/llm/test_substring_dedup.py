import random
import re

import pytest
from pyspark.sql import functions as F

from riskspark.llm import substring_dedup
from tests.llm.conftest import ODD


def _brute(rows, length):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - length + 1):
            first.setdefault(tuple(words[i][j : j + length]), i)
    want = {}
    for i, w in words.items():
        cut = set()
        for j in range(len(w) - length + 1):
            if first[tuple(w[j : j + length])] < i:
                cut.update(range(j, j + length))
        want[i] = (len(w), len(cut), " ".join(x for k, x in enumerate(w) if k not in cut))
    return want


def _got(df, **how):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(df, **how).collect()}


@pytest.mark.parametrize("length, anchor", [(8, 3), (5, 5), (12, 4)])
def test_equals_brute_force(documents, length, anchor):
    rng = random.Random(length)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(120):
        words = [rng.choice("abcd") for _ in range(rng.randrange(40))]
        if i % 3 == 0:  # part of a passage that many documents have, in changing surroundings
            a = rng.randrange(20)
            words[5:5] = passage[a : a + rng.randint(3, 25)]
        if i % 10 == 0 and rows:
            words = rows[-1][1].split()
        rows.append((i, rng.choice([" ", "\n"]).join(words)))
    assert _got(documents(rows, extra=True), length=length, anchor=anchor) == _brute(rows, length)


def test_removed_ranges_are_the_removed_words(documents):
    shared = " ".join(f"w{i}" for i in range(60))
    rows = [(1, shared), (2, f"x {shared} y"), (3, "z")]
    by_id = {r.doc_id: r for r in substring_dedup.remove_repeats(documents(rows)).collect()}
    assert [tuple(x) for x in by_id[2].removed] == [(1, 61)]
    assert (by_id[2].kept_text, by_id[1].removed, by_id[3].kept_text) == ("x y", [], "z")


def test_odd_rows(documents):
    got = substring_dedup.remove_repeats(documents(ODD, extra=True), length=3, anchor=2).collect()
    assert len(got) == len(ODD)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.kept_text))
    assert by_id[1] == by_id[2] == by_id[3] == [(0, 0, "")]
    # equal ids are not earlier than one another; a later document loses the words; a null id keeps them
    assert by_id[4] == [(3, 0, "One two three.")] * 2
    assert by_id[5] == [(3, 3, "")]
    assert by_id[None] == [(3, 0, "One two three.")]
    assert by_id[7][0][:2] == (5000, 0)


def test_no_rows(documents):
    assert substring_dedup.remove_repeats(documents([])).count() == 0


def test_a_passage_in_most_documents_makes_no_pairs(documents, capsys):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{i} {passage} {i * 7}") for i in range(300)]
    df = documents(rows)
    assert _got(df) == _brute(rows, 50)
    assert substring_dedup.repeats(df).agg(F.count("*")).first()[0] < 50 * len(rows)
