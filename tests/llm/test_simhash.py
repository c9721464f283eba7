import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from riskspark.llm import simhash
from tests.llm.conftest import ODD


def _fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(rows, max_bits=3):
    prints = [(i, _fingerprint(t)) for i, t in rows]
    group = list(range(len(prints)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                group[y] = x
    ids = {}
    for k, (i, _) in enumerate(prints):
        ids.setdefault(find(k), []).append(i)
    low = {root: min((i for i in members if i is not None), default=None) for root, members in ids.items()}
    return sorted(((i, low[find(k)]) for k, (i, _) in enumerate(prints)), key=repr)


def test_fingerprints_equal_their_definition(documents):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["A", "bé", "C!", "d\t", "漢"], k=rng.randrange(60)))) for i in range(80)]
    got = simhash.with_fingerprint(documents(rows), "f", ["doc_id"]).collect()
    assert {r.doc_id: r.f % 2**64 for r in got} == {i: _fingerprint(t) for i, t in rows}


def test_spark_hashes_a_shingle_alike(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("a bé c"))).first()[0] % 2**64
    assert simhash.shingle_hashes("A bé C".encode())[0] == _fingerprint("a bé c") == value


def test_components_of_planted_fingerprints(spark):
    """Chains and clusters of fingerprints a few bits apart, many of them in one key group."""
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for centre in list(prints)[:10]:
        for _ in range(25):
            value = centre
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                value ^= 1 << bit
            prints.add(value)
    low_half = rng.getrandbits(32)
    prints |= {rng.getrandbits(32) << 32 | low_half for _ in range(60)}
    prints |= {low_half ^ (7 << (3 * k)) for k in range(9)} | {low_half}
    values = sorted(prints)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    distinct = spark.createDataFrame([(v, 1) for v in signed], "fp long, n_docs long").repartition(4)
    got = {r.node: r.component for r in simhash.fingerprint_components(distinct).collect()}
    group = list(range(len(values)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    linked = set()
    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= 3:
                linked |= {a, b}
                x, y = sorted((find(a), find(b)))
                group[y] = x
    assert set(got) == {signed[k] for k in linked}
    sets = lambda pairs: sorted(map(sorted, pairs.values()))
    mine, want = {}, {}
    for k in linked:
        mine.setdefault(got[signed[k]], []).append(k)
        want.setdefault(find(k), []).append(k)
    assert sets(mine) == sets(want)


def test_fingerprints_of_one_half_make_one_row_each(spark, monkeypatch):
    """A large group that agrees on a half has one key, not one for each bit that may be masked."""
    rows = {}
    stage = simhash.stage_table

    def counted(df, label):
        table = stage(df, label)
        rows[label] = table.count()
        return table

    monkeypatch.setattr(simhash, "stage_table", counted)
    rng = random.Random(6)
    prints = [rng.getrandbits(63) >> 32 << 32 | 77 for _ in range(200)]
    distinct = spark.createDataFrame([(v, 1) for v in {*prints, prints[0] ^ 1, prints[1] ^ (1 << 40)}], "fp long, n_docs long")
    got = {r.node: r.component for r in simhash.fingerprint_components(distinct).collect()}
    want = {v: min(pair) for pair in ((prints[0], prints[0] ^ 1), (prints[1], prints[1] ^ (1 << 40))) for v in pair}
    assert got == want
    # 201 of the shared half, two of the other half of each pair, and those where a masked bit joins two halves
    assert rows["simhash-keys"] < 3 * 202


def test_documents_equal_brute_force(documents):
    rng = random.Random(9)
    rows = []
    for i in range(60):
        words = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 150))]
        rows.append((3 * i, " ".join(words)))
        rows.append((3 * i + 1, " ".join([*words[:-1], "changed"])))
        if i % 4 == 0:
            rows.append((3 * i + 2, " ".join(words).upper()))
    rng.shuffle(rows)
    got = simhash.near_duplicates(documents(rows, extra=True)).select("doc_id", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _components(rows)


def test_odd_rows(documents):
    got = simhash.near_duplicates(documents(ODD, extra=True)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == _components(ODD)


def test_one_document_of_each_group_stays(documents):
    df = documents(ODD, extra=True)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 6, 7, 8]


def test_no_rows(documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.drop_near_duplicates(documents([])).count() == 0


def test_more_bits_than_two_halves_can_find(documents):
    with pytest.raises(ValueError):
        simhash.near_duplicates(documents([(1, "a")]), max_bits=4)


def test_one_of_near_copies_without_an_id_or_with_one_id_stays(documents):
    words = [f"w{i}" for i in range(2000)]
    texts = [" ".join([*words[:k], *words[k + 1 :]]) for k in range(2000)]
    first = _fingerprint(texts[0])
    texts = [t for t in texts[:60] if (_fingerprint(t) ^ first).bit_count() <= 3]
    assert len(texts) > 2
    for i in (None, 7):
        assert simhash.drop_near_duplicates(documents([(i, t) for t in texts])).count() == 1
