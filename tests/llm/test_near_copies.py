import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskspark.llm import near_copies
from tests.llm.conftest import ODD


def _shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def _planted(seed=5, originals=60):
    """Texts, edited copies of them at 0.8 to 0.95, and others just below."""
    rng = random.Random(seed)
    rows = []
    for _ in range(originals):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(80, 400))]
        rows.append((len(rows), " ".join(words)))
        for low, high in ((0.8, 0.82), (0.82, 0.88), (0.88, 0.95), (0.7, 0.79)):
            copy, whole = list(words), _shingles(rows[-1][1] if low == 0.8 else " ".join(words))
            while _jaccard(whole, _shingles(" ".join(copy))) > high:
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            if _jaccard(whole, _shingles(" ".join(copy))) >= low:
                rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return rows


def _kept(rows):
    """The first document of each group of linked ones, by comparing all pairs."""
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    sets, group = [_shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if _jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                group[y] = x
    return [rows[k] for k in range(len(rows)) if find(k) == k]


def test_stage_drops_edited_copies(spark, documents):
    rows = _planted()
    kept = corpus_pipeline.drop_near_duplicates(spark, documents(rows, extra=True), "")
    got = {r.doc_id for r in kept.collect()}
    want = {i for i, _ in _kept(rows)}
    removed = len(rows) - len(want)
    assert removed > 100 and want <= got
    recall = 1 - len(got - want) / removed
    print(f"recall {recall:.4f} of {removed} copies")
    assert recall >= 0.99


def test_large_group_of_copies_of_copies(documents):
    rng = random.Random(2)
    words, rows = [f"w{i}" for i in range(200)], []
    for i in range(120):
        rows.append((i, " ".join(words)))
        words[rng.randrange(200)] = f"x{i}"
    assert [r.doc_id for r in near_copies.drop_near_copies(documents(rows)).collect()] == [i for i, _ in _kept(rows)]


def test_odd_rows(documents):
    df = documents(ODD, extra=True)
    kept = near_copies.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 6, 7, 8]
    assert near_copies.drop_near_copies(documents([])).count() == 0


def test_copies_without_an_id(documents):
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join([*words[:k], "changed", *words[k + 1 :]]) for k in (0, 40, 99)]
    assert near_copies.drop_near_copies(documents([(None, t) for t in texts])).count() == 1
    assert near_copies.drop_near_copies(documents([(7, t) for t in texts])).count() == 1
    (row,) = near_copies.drop_near_copies(documents([*[(None, t) for t in texts], (9, texts[1])])).collect()
    assert row.doc_id == 9


def test_texts_of_near_signatures_are_one_group(spark):
    """A long run of repeated lines with another tail: the sets are far apart, the fingerprints are not."""
    cycle = " ".join(f"line{i}" for i in range(11))
    tails = [" ".join(f"{name}{i}" for i in range(12)) for name in ("left", "right")]
    rows = [(n + 1, " ".join([cycle] * 60 + [tail])) for n, tail in enumerate(tails)] + [(3, tails[0])]
    assert _jaccard(_shingles(rows[0][1]), _shingles(rows[1][1])) < 0.5
    kept = near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_keys_become_rows_once_however_many_rounds(documents, monkeypatch):
    plans = []
    stage = near_copies.stage_table

    def noted(df, label):
        plans.append((label, df._jdf.queryExecution().optimizedPlan().toString()))
        return stage(df, label)

    monkeypatch.setattr(near_copies, "stage_table", noted)
    rng = random.Random(2)
    words, rows = [f"w{i}" for i in range(200)], []
    for i in range(120):
        rows.append((i, " ".join(words)))
        words[rng.randrange(200)] = f"x{i}"
    kept = near_copies.drop_near_copies(documents(rows))
    assert [r.doc_id for r in kept.collect()] == [i for i, _ in _kept(rows)]
    rounds = sum(label == "copies-pairs" for label, _ in plans)
    assert rounds >= 2
    # for the first hubs, and for the members of open keys
    assert sum(plan.count("Generate explode(keys") for _, plan in plans) == 2


def test_members_of_open_keys_are_read_for_several_hubs_at_a_time(documents, monkeypatch):
    """Copies with too many changes share keys with a large group but no link: rounds must not read them one hub at a time."""
    read = []
    stage = near_copies.stage_table

    def counted(df, label):
        table = stage(df, label)
        if label == "copies-meeting":
            read.append((table.count(), table.selectExpr("max(size(hubs))").first()[0]))
        return table

    monkeypatch.setattr(near_copies, "stage_table", counted)
    rng = random.Random(8)
    rows = []
    words = [f"w{i}" for i in range(150)]
    for i in range(150):
        copy = list(words)
        for place in rng.sample(range(150), rng.randint(1, 6)):
            copy[place] = f"x{i}-{place}"
        rows.append((i, " ".join(copy)))
    kept = near_copies.drop_near_copies(documents(rows))
    # links of near signatures may join more than the similarity of sets does
    assert {0} < {r.doc_id for r in kept.collect()} <= {i for i, _ in _kept(rows)}
    assert len(read) >= 2 and [hubs for _, hubs in read][:2] == [1, near_copies.DRAWN]


@pytest.mark.parametrize("block", [near_copies.BLOCK, 500])
def test_members_of_a_key_that_no_hub_links_are_compared(spark, documents, monkeypatch, block):
    """One key, its hub is like none of the others: links among them are found all the same, in one block or many."""
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rng = random.Random(4)
    texts = [[f"w{i}-{k}" for k in range(rng.randint(60, 90))] for i in range(25)]
    for i in range(1, 13):
        # the copy of a copy is a link of its own
        for at in (i, len(texts))[: 1 + i % 2]:
            copy = list(texts[at])
            copy[rng.randrange(len(copy))] = f"x{i}"
            texts.append(copy)
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    docs = documents(rows)
    nodes = near_copies._with_nodes(docs, 5).withColumn("keys", F.array(F.lit(7).cast("long")))
    nodes = nodes.withColumn("n_docs", F.when(F.col("doc_id") == 0, 9).otherwise(1).cast("long")).persist()
    known = spark.createDataFrame([], "a long, b long")
    found = near_copies._node_components(docs, nodes.drop("doc_id", "fp"), known, 5, 0.8)
    kept = found.join(nodes, "node").groupBy("component").agg(F.min("doc_id").alias("doc_id")).collect()
    want = [i for i, _ in _kept(rows)]
    assert len(want) == 25 and sorted(r.doc_id for r in kept) == want
