import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskspark.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row):
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _levels(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_sha("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def _steps(levels, at):
    steps = []
    for level in levels[:-1]:
        low = at // 16 * 16
        steps.append(("".join(level[low:at]), "".join(level[at + 1 : low + 16])))
        at //= 16
    return steps


def _brute(rows):
    """(doc_id, leaf, path, subroot, root) of every row, by lists."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0], _leaf(row)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [_levels([leaf for _, _, leaf in sorted(groups[s], key=lambda t: (t[0], t[1] or 0, t[2]))]) for s in order]
    top = _levels([tree[-1][0] for tree in trees])
    found = []
    for n, (source, tree) in enumerate(zip(order, trees)):
        ids = [i for _, i, _ in sorted(groups[source], key=lambda t: (t[0], t[1] or 0, t[2]))]
        for at, (doc_id, leaf) in enumerate(zip(ids, tree[0])):
            found.append((doc_id, leaf, tuple(_steps(tree, at) + _steps(top, n)), tree[-1][0], top[-1][0]))
    return found


def _rows(sizes, seed=0):
    rng = random.Random(seed)
    ids = list(range(sum(sizes.values())))
    rng.shuffle(ids)
    return [(ids.pop(), source, rng.choice(["en", None]), rng.randint(0, 9), rng.choice(["Ab c", "é漢", "", None])) for source, n in sizes.items() for _ in range(n)]


def _check(spark, rows, nested):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rank", "2 AS digest", "3 AS path", "4 AS depth").repartition(3)
    found = merkle.manifest(docs, nested).collect()
    got = [(r.doc_id, r.leaf, tuple((s.before, s.after) for s in r.path), r.subroot, r.root) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, _brute(rows)))


@pytest.mark.parametrize("nested", [1, 2, 3])
def test_equals_lists(spark, nested):
    sizes = {"b": 1, None: 2, "": 16, "é": 17, "z": 300, "😀": 5}
    _check(spark, _rows(sizes), nested)


def test_more_sources_than_a_node_holds(spark):
    _check(spark, _rows({f"s{i}": i % 3 + 1 for i in range(40)}), 1)


def test_odd_rows(spark):
    odd = [(None, None, None, None, None), (None, "a", None, 1, ""), (1, "a", "en", 2, "x" * 30000), (1, "a", "en", 2, "x"), (1, "a", "en", 2, "x"), (None, "a", None, 1, "")]
    _check(spark, odd, 3)
    _check(spark, [(5, "only", None, None, "one")], 3)


def test_no_rows(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_only_rows_as_they_were_verify(spark):
    rows = _rows({"a": 30, "b": 4}, 3)
    docs = spark.createDataFrame(rows, SCHEMA)
    other = merkle.leaf_of(F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    for r in merkle.verify(merkle.manifest(docs, other=other), F.col("other")).collect():
        assert r.verified == (r.other == r.leaf)
        digest = r.other
        for s in r.path:
            digest = _sha(s.before + digest + s.after)
        assert digest == r.folded_root


def test_a_block_nests_a_level_at_least(spark):
    with pytest.raises(ValueError):
        merkle.manifest(spark.createDataFrame([], SCHEMA), nested=0)
