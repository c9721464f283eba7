import random
import re
import zlib
from collections import Counter

import pytest

from riskspark.llm import spelling
from tests.llm.conftest import ODD


def _near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def _brute(rows, ratio=10, every=31):
    """The contract, word by word and pair by pair."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if code % every == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if _near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def _texts(seed, words=60, rows=40):
    rng = random.Random(seed)
    letters = "abcéà×"
    base = ["".join(rng.choices(letters, k=rng.randint(6, 10))) for _ in range(words)]
    for word in list(base):
        at = rng.randrange(len(word))
        base += [word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]]
    weights = [rng.choice([1, 1, 30, 400]) for _ in base]
    return [(i, rng.choice([" ", ", ", "1"]).join(w.title() for w in rng.choices(base, weights, k=200))) for i in range(rows)]


@pytest.mark.parametrize("ratio", [10, 2])
def test_equals_brute_force(documents, ratio):
    rows = [*_texts(ratio), (99, "lettersq " * 3 + "lettersx " * 40 + "lettrsx " * 500)]
    got = {tuple(r) for r in spelling.group_variants(documents(rows, extra=True), ratio).collect()}
    want = _brute(rows, ratio)
    assert got == want
    assert ("lettersq", "lettersx", "lettrsx", 3, 1, 40) in want


def test_crowded_blocks_are_split_and_lose_no_link(spark):
    rng = random.Random(4)
    words = {"shared" + "".join(rng.choices("abc", k=rng.randint(3, 6))) for _ in range(500)}
    words |= {"".join(rng.choices("abc", k=rng.randint(3, 6))) + "common" for _ in range(300)}
    table = spark.createDataFrame([(w,) for w in words], "word string").repartition(3)
    blocks = spelling.blocks(table, 20)
    free = blocks.where("shorter - first - last > 1")
    assert free.groupBy("shorter", "first", "last", "head", "tail").count().where("count > 20").isEmpty()
    found = spelling.near_words(table, 20, 50).collect()
    want = {(a, b) for a in words for b in words if _near(a, b)}
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_very_long_words_next_to_short_ones(documents):
    long = "abc" * 5000
    rows = [(1, f"{long} {long} {long}x {long}x abcdefg abcdefg abcdefgh abcdefgh")]
    assert {tuple(r) for r in spelling.group_variants(documents(rows)).collect()} == _brute(rows)


def test_odd_rows_and_no_rows(documents):
    rows = [*ODD, (None, "abcdefg abcdefg Abcdefgé abcdefgé"), (None, "abcdefg")]
    assert {tuple(r) for r in spelling.group_variants(documents(rows, extra=True)).collect()} == _brute(rows)
    assert spelling.group_variants(documents([])).count() == 0
    assert spelling.group_variants(documents([(1, None)])).count() == 0


def test_chains_of_forms_end_at_the_last(spark):
    steps = [(f"w{i:03}", f"w{i + 1:03}") for i in range(13)]
    roots = spelling._roots(spark.createDataFrame(steps, "word string, form string")).collect()
    assert {tuple(r) for r in roots} == {(word, "w013") for word, _ in steps}
