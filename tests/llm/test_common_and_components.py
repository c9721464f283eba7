import random

import numpy as np
import pyarrow as pa
import pytest

from riskspark.llm import common, components
from riskspark.llm.components import connected_components


def test_chunks_cover_all_rows_and_never_split_a_text():
    texts = ["a b", None, "", "ccc " * 10, "é"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], names=["doc_id", "text"])
    seen = []
    for rows, data, offsets in common.text_chunks(iter([batch.slice(1), batch.slice(0, 1)]), max_bytes=4):
        body = data.tobytes()
        seen += [(i, body[a:b].decode()) for i, a, b in zip(rows.column(0).to_pylist(), offsets, offsets[1:])]
    assert sorted(seen) == [(i, t or "") for i, t in enumerate(texts)]


def test_words_do_not_cross_texts_and_hashes_do_not_depend_on_place():
    texts = [b"ab cd", b"", b"cd", b" ab\x0bx"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    starts, ends, first = common.word_bounds(data, offsets)
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [b"ab", b"cd", b"cd", b"ab", b"x"]
    assert first.tolist() == [0, 2, 2, 3, 5]
    ids = common.word_hashes(data, starts, ends)
    assert ids[0] == ids[3] and ids[1] == ids[2] and len(set(ids.tolist())) == 3


@pytest.mark.parametrize("width", [1, 2, 5, 26])
def test_sliding_minimum_takes_the_last_of_equals(width):
    values = np.random.default_rng(3).integers(0, 6, 200).astype(np.uint64)
    got = common.sliding_rightmost_minimum(values, width)
    want = [max(range(i, i + width), key=lambda j: (-int(values[j]), j)) for i in range(200 - width + 1)]
    assert got.tolist() == want


def _brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in parent}


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(-5, 2000 + i) for i in range(50)]
    edges = [e for e in edges if e[0] != e[1]]
    df = spark.createDataFrame(edges + edges[:5] + [(7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    assert got == _brute(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_stars_take_no_round(spark, monkeypatch):
    written = []
    stage = components.stage_table
    monkeypatch.setattr(components, "stage_table", lambda df, label: written.append(label) or stage(df, label))
    df = spark.createDataFrame([(low * 100 + i, low) for low in (1, 2) for i in range(5)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    assert got == {1: 1, 2: 2} | {low * 100 + i: low for low in (1, 2) for i in range(5)}
    assert len(written) == 1


def test_components_of_many_edges_equal_those_of_few(spark, monkeypatch):
    rng = random.Random(8)
    edges = [(rng.randrange(90), 100 + rng.randrange(90)) for _ in range(80)]
    df = spark.createDataFrame(edges, "a long, b long")
    few = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    monkeypatch.setattr(components, "FEW_ROWS", 10)
    assert few == _brute(edges) == {r.node: r.component for r in connected_components(df, "a", "b").collect()}
