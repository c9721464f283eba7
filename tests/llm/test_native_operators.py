import itertools
import random
import re
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from riskspark.llm import decontaminate, fingerprints, license_scan
from riskspark.llm.native import plain_words
from tests.llm.conftest import ODD


def _words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def test_plain_words(documents):
    rows = [*ODD[:3], (9, "A-b  c_d İK\x7fé1,"), (10, "--x--")]
    got = {r.doc_id: r.w for r in documents(rows).select("doc_id", plain_words(F.col("text")).alias("w")).collect()}
    assert got[1] == got[2] == got[3] == []
    assert len(got[9]) == len(_words(rows[3][1])) and got[10] == ["x"]


def _no_python(df, capsys):
    df.explain()
    plan = capsys.readouterr().out
    return not re.search(r"Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", plan)


# --- winnowing ----------------------------------------------------------------------------------


def _kept(values, window):
    """Places of the last smallest value of every window, or of all values if they are fewer."""
    width = min(window, len(values))
    return sorted({max(range(i, i + width), key=lambda j: (-values[j], j)) for i in range(len(values) - width + 1)} if values else set())


@pytest.mark.parametrize("gram, window", [(2, 4), (3, 7), (1, 1)])
def test_kept_places_are_the_last_minima_of_windows(documents, gram, window):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices("abc", k=rng.randrange(40)))) for i in range(50)]
    df = documents(rows)
    places = lambda d: d.select("doc_id", fingerprints.pairs_of(F.col("p")).alias("p"))
    every = {r.doc_id: [x.hash for x in r.p] for r in places(fingerprints.with_winnowed(df, "text", "p", gram, 1)).collect()}
    got = {r.doc_id: [(x.place, x.hash) for x in r.p] for r in places(fingerprints.with_winnowed(df, "text", "p", gram, window)).collect()}
    assert got == {i: [(j, h[j]) for j in _kept(h, window)] for i, h in every.items()}


def test_shared_words_share_a_hash(documents):
    run = " ".join(f"w{i}" for i in range(fingerprints.GRAM + fingerprints.WINDOW - 1))
    df = documents([(1, f"a b c {run} d e"), (2, f"x {run} y z q r"), (3, "nothing in common " * 9)])
    marked = fingerprints.with_winnowed(df, "text", "p").select("doc_id", fingerprints.hashes_of(F.col("p")).alias("h"))
    h = {r.doc_id: set(r.h) for r in marked.collect()}
    assert h[1] & h[2] and not h[1] & h[3]


def _edited(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    out = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        third = len(t) // 3
        out.append((i, len(t), t[: len(t) - third] + after[:third]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("step", [1, 50, 10_000_000])
def test_edits_take_from_the_next_document(documents, step):
    rng = random.Random(8)
    rows = [(rng.randrange(10**9) if step > 10**6 else i * step, "".join(rng.choices("ab é漢 ", k=rng.randrange(60)))) for i in range(150)]
    got = fingerprints.fingerprint_edits(documents(rows, extra=True)).select("doc_id", "n_chars", "edited").collect()
    assert sorted(map(tuple, got), key=repr) == _edited(rows)


def test_edits_of_odd_rows(documents):
    got = fingerprints.fingerprint_edits(documents(ODD, extra=True)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited) for r in got), key=repr) == _edited(ODD)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_a_single_document_follows_itself(documents, capsys):
    df = fingerprints.fingerprint_edits(documents([(5, "a b c d e f g h i")]))
    row = df.first()
    assert (row.edited, row.near_next) == ("a b c d e f a b c", 1.0)
    assert _no_python(df, capsys)
    assert fingerprints.fingerprint_edits(documents([])).count() == 0


def test_equal_texts_have_equal_digests(documents):
    rows = [(1, "one two three four five six"), (2, "one two three four five six"), (3, "one two three four five seven"), (4, "")]
    df = fingerprints.with_winnowed(documents(rows), "text", "p").select("doc_id", fingerprints.digest(F.col("p")).alias("d"))
    d = {r.doc_id: r.d for r in df.collect()}
    assert d[1] == d[2] != d[3] and len(set(d.values())) == 3


# --- license scan -------------------------------------------------------------------------------


def test_license_base_equals_brute_force(documents, capsys):
    rng = random.Random(3)
    bits = ["GNU General", "public", "license", "apache LICENSE,", "cc", "by", "BY-NC", "mit", "mit-license", "word", "é"]
    rows = [(i, " ".join(rng.choices(bits, k=rng.randrange(25)))) for i in range(200)]
    df = license_scan.scan(documents(rows, extra=True))
    got = {r.doc_id: r for r in df.collect()}
    for i, text in rows:
        words, found, labels = _words(text), [], set()
        for phrase, label in license_scan.PHRASES:
            parts = phrase.split()
            at = [j for j in range(len(words)) if words[j : j + len(parts)] == parts]
            found += at
            labels |= {label} if at else set()
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(found), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((min(found), max(found)) if found else (None, None))
        assert set(labels) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert _no_python(df, capsys)


def test_license_notices_with_changed_words(documents):
    mit = next(text for label, text in license_scan.TEMPLATES if text.startswith("permission is hereby granted"))
    words = mit.split()
    changed = [*words[:10], "really", *words[10:30], *words[32:]]
    rows = [
        (1, "x y " + " ".join(changed) + " z"),
        (2, "This work is licensed under the GNU General Public License, version 3."),
        (3, "Licensed under CC BY-NC 4.0."),
        (4, "permission is hereby granted to go home"),
    ]
    got = {r.doc_id: r for r in license_scan.scan(documents(rows)).collect()}
    assert got[1].labels == "mit" and got[1].spans[0].first == 2 and got[1].spans[0].last == len(changed) + 1
    assert (got[2].labels, got[2].base_labels) == ("gpl,gpl-3.0", "gpl")
    assert got[3].labels == "cc-by,cc-by-nc-4.0"
    assert (got[4].labels, got[4].score, got[4].spans) == ("", 0.0, None)


def test_license_odd_rows(documents):
    rows = [*ODD, (4, "mit license"), (None, "mit license")]
    got = license_scan.scan(documents(rows, extra=True)).collect()
    assert len(got) == len(rows)
    assert sorted((r.n_words, r.n_base) for r in got if r.doc_id in (1, 2, 3)) == [(0, 0)] * 3
    assert sum(r.n_base for r in got) == 2
    assert license_scan.scan(documents([])).count() == 0


# --- decontamination ----------------------------------------------------------------------------


def _overlap(doc, item):
    width = min(len(item), decontaminate.WINDOW)
    need = -(-width * 4 // 5)
    for place in range(-len(item) + 1, len(doc)):
        same = [0 <= place + k < len(doc) and doc[place + k] == w for k, w in enumerate(item)]
        if max(sum(same[i : i + width]) for i in range(len(item) - width + 1)) >= need:
            return True
    return False


def test_overlaps_equal_brute_force(documents, spark, capsys):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([15, 22, 40])))) for k in range(12)]
    rows = []
    for i in range(90):
        words = rng.choices(vocabulary, k=rng.randint(0, 80))
        if i % 3 == 0:
            part = items[i % 12][1].split()
            for at in rng.sample(range(len(part)), rng.choice([0, 1, len(part) // 8, len(part) // 3])):
                part[at] = "other"
            words[10:10] = part[rng.choice([0, 0, 3]) :]
        rows.append((i, " ".join(words).capitalize()))
    benchmark = spark.createDataFrame([*items, (99, "too short"), (98, None), (None, items[0][1])], "item_id long, text string")
    df = decontaminate.contaminated(documents(rows, extra=True), benchmark)
    got = {(r.doc_id, r.item_id) for r in df.collect()}
    want = {(i, k) for i, t in rows for k, item in items if _overlap(_words(t), _words(item))}
    assert got == want and len(want) >= 15
    assert _no_python(df, capsys)
    kept = decontaminate.drop_contaminated(documents(rows, extra=True), benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _ in rows} - {i for i, _ in want})


def test_some_mask_fits_beside_all_allowed_substitutions():
    for size in range(decontaminate.SHORTEST, decontaminate.WINDOW + 1):
        masks = decontaminate.MASKS if size >= decontaminate.SHORT else decontaminate.SHORT_MASKS
        seeds = [{at + m for m in mask} for mask in masks for at in range(size - mask[-1])]
        for changed in itertools.combinations(range(size), size // 5):
            assert any(seed.isdisjoint(changed) for seed in seeds), (size, changed)


def test_short_items_with_every_allowed_substitution(documents, spark):
    items = {n: [f"n{n}w{i}" for i in range(n)] for n in (5, 6, 7, 9, 10, 11, 13)}
    rows, want = [], set()
    for n, item in items.items():
        for changed in itertools.combinations(range(n), n // 5):
            words = ["x" if i in changed else w for i, w in enumerate(item)]
            want.add((len(rows), n))
            rows.append((len(rows), " ".join(["a", *words, "b"] if len(rows) % 2 else words)))
        rows.append((len(rows), " ".join(["x"] * (n // 5 + 1) + item[n // 5 + 1 :])))
    benchmark = spark.createDataFrame([(n, " ".join(item)) for n, item in items.items()], "item_id long, text string")
    got = decontaminate.contaminated(documents(rows), benchmark)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_overlaps_cut_off_by_either_end_of_a_document(documents, spark):
    item = [f"w{i}" for i in range(20)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = [(1, " ".join(item[1:] + ["x"] * 30)), (2, " ".join(["x"] * 30 + item[:19])), (3, " ".join(item[4:])), (4, " ".join(item[5:] + ["x"]))]
    got = {(r.doc_id, r.place, r.matched) for r in decontaminate.contaminated(documents(rows), benchmark).collect()}
    assert got == {(1, -1, 19), (2, 30, 19), (3, -4, 16)}


def test_a_benchmark_in_parts_gives_the_same(documents, spark, monkeypatch):
    items = [(k, " ".join(f"v{k * 7 + j}" for j in range(20))) for k in range(9)]
    rows = [(i, f"a b {items[i % 9][1]} c") for i in range(20)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in decontaminate.contaminated(documents(rows), benchmark).collect()}
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", 100)
    assert {tuple(r) for r in decontaminate.contaminated(documents(rows), benchmark).collect()} == whole
    assert len(whole) >= 20


def test_decontamination_of_odd_rows(documents, spark):
    item = " ".join(f"w{i}" for i in range(15))
    rows = [*ODD, (9, item), (9, item), (None, item)]
    benchmark = spark.createDataFrame([(1, item), (1, item)], "item_id long, text string")
    got = decontaminate.contaminated(documents(rows, extra=True), benchmark).select("doc_id", "item_id", "place").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(9, 1, 0), (None, 1, 0)], key=repr)
    kept = decontaminate.drop_contaminated(documents(rows), benchmark)
    assert kept.count() == len(ODD)
    empty = benchmark.limit(0)
    assert decontaminate.contaminated(documents(rows), empty).count() == 0
    assert decontaminate.drop_contaminated(documents(rows), empty).count() == len(rows)
    assert decontaminate.contaminated(documents([]), benchmark).count() == 0


def test_clean_rows_stay_beside_contaminated_ones_of_the_same_id(documents, spark):
    item = " ".join(f"w{i}" for i in range(15))
    clean = [(None, "a clean text"), (None, None), (9, "another clean text")]
    df = documents([*clean, (None, item), (9, item)], extra=True)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(df, benchmark)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(clean, key=repr)
