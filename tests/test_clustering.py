import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskspark.functions.text import clean_text
from riskspark.operators import clustering, measures, terms

SETTINGS = clustering.FeatureSettings(
    vocabulary_size=50, min_documents=2, category_size=5, category_min_documents=2, pca_components=6
)
THEMES = {
    "web": "cross site scripting in the browser page script",
    "memory": "buffer overflow corrupts heap memory pointer",
    "query": "sql injection through the database query statement",
}


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        (
            f"{theme}-{i}",
            f"{text} {i}",
            [f"CWE-{n}"],
            [theme, "shared"],
            float(n * 3),
            0.1 * n,
            int(i % 4 == 0),
        )
        for n, (theme, text) in enumerate(THEMES.items())
        for i in range(20)
    ]
    rows.append(("no-text", None, None, None, 1.0, 0.0, 1))
    return spark.createDataFrame(
        rows,
        "cve_id string, description string, cwes array<string>, cpe_vendors array<string>,"
        " cvss_score double, epss_percentile double, is_kev int",
    )


@pytest.fixture(scope="module")
def run(scored):
    return clustering.run_clustering(scored, (2, 3, 4), SETTINGS)


def test_clean_text(spark):
    text = "See\nhttps://x.y/z?q CVE-2024-1234 at 0xDEADbeef: Déjà vu, 42 times!"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(clean_text(F.col("t"))).first()[0] == "see at d j vu times "


def test_prepared_input_has_no_gaps(scored, spark):
    prepared = clustering.prepare_text(
        scored.withColumn("cvss_score", F.lit(None).cast("double"))
        .withColumn("cwes", F.lit(None).cast("array<string>"))
        .withColumn("epss_percentile", F.lit("odd"))
    )
    assert prepared.count() == 60
    row = prepared.first()
    assert (row.cwes, row.cvss_scaled, row.epss_percentile) == ([], 0.0, 0.0)


def test_words(spark):
    df = spark.createDataFrame([("the remote attacker can go to a database",)], "clean_text string")
    assert clustering.words_of(df).first().words == ["database"]


def test_every_text_is_assigned_and_themes_separate(run, scored):
    assigned = {r.cve_id: r.cluster_id for r in run.assignments.collect()}
    assert len(assigned) == 60
    k = clustering.best_cluster_count(run.metrics)
    assert set(assigned.values()) <= set(range(k))
    themes = [{c for key, c in assigned.items() if key.startswith(t)} for t in THEMES]
    assert not (themes[0] & themes[1] or themes[1] & themes[2] or themes[0] & themes[2])
    attached = clustering.attach_clusters(scored, run.assignments)
    assert attached.count() == 61
    assert attached.where("cve_id = 'no-text'").first().cluster_id is None


def test_metrics(run):
    rows = {r.k: r for r in run.metrics.collect()}
    assert set(rows) == {2, 3, 4}
    assert all(-1 <= r.silhouette <= 1 and r.cost >= 0 and r.davies_bouldin >= 0 for r in rows.values())


def test_topics(run, scored):
    topics = {r.cluster_id: r for r in run.topics.collect()}
    assert sum(r["size"] for r in topics.values()) == 60
    assert sum(r.kev_count for r in topics.values()) == 15
    for row in topics.values():
        assert 0 < len(row.top_keywords) <= 10
        theme = next(t for t in THEMES if t in row.top_vendors)
        assert row.top_keywords[0] in THEMES[theme].split()
        # ties in name order
        assert row.top_vendors == sorted([theme, "shared"])


def test_keywords_are_the_largest_mean_weights(spark):
    rows = [(1, ["b", "b", "c"]), (2, ["b", "c", "c"]), (3, ["a", "c", "d"]), (4, []), (5, [])]
    worded = spark.createDataFrame(rows, "cve_id int, words array<string>")
    weights = terms.term_weights(worded)
    by_term = {(r.cve_id, r.term): (r.n, r.weight) for r in weights.collect()}
    assert by_term[1, "b"] == (2, pytest.approx(2 * math.log(6 / 3))) and len(by_term) == 7
    given = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 2)], "cve_id int, cluster_id int")
    got = {r.cluster_id: r.top_keywords for r in terms.top_terms(weights, given, 2).collect()}
    assert got == {0: ["b", "c"], 1: ["a", "d"]}
    assert {r.term for r in terms.term_weights(worded, 2).collect()} == {"b", "c"}
    assert {r.term for r in terms.term_weights(worded, 1, 1).collect()} == {"c"}


def test_weights_hold_no_vocabulary_in_one_place(spark, capsys):
    worded = spark.createDataFrame([(1, ["b", "c"]), (2, ["b"])], "cve_id int, words array<string>")
    terms.term_weights(worded).explain("formatted")
    plan = capsys.readouterr().out
    assert "vector" not in plan.lower() and "collect_" not in plan and "SinglePartition" not in plan.replace("Scalar", "")


def test_terms_are_counted_without_a_shuffle_of_words(spark, capsys):
    kind = "cve_id int, words array<string>"
    terms.term_counts(spark.createDataFrame([(1, ["b", "c", "b"]), (2, []), (3, None)], kind)).explain()
    assert "Exchange" not in capsys.readouterr().out
    # rows of one key count together, also those without a key
    rows = [(1, ["b", "c", "b"]), (1, ["b"]), (None, ["c"]), (None, ["c", None]), (2, ["b"]), (3, []), (4, None)]
    worded = spark.createDataFrame(rows, kind)
    got = {(r.cve_id, r.term): r.n for r in terms.term_counts(worded).collect()}
    assert got == {(1, "b"): 3, (1, "c"): 1, (None, "c"): 2, (None, None): 1, (2, "b"): 1}
    assert {r.idf for r in terms.term_weights(worded).where("term = 'c'").collect()} == {math.log(8 / 3)}


def test_vocabulary_is_taken_from_the_counted_words(spark):
    rows = [(1, ["b", "b", "c"]), (2, ["b", "c", "c", "c"]), (2, ["d", "c"]), (None, ["d", "e"])]
    worded = spark.createDataFrame(rows, "cve_id int, words array<string>")
    found = terms.vocabulary(terms.row_counts(worded), 2, 2)
    assert found == ["c", "b"]
    settings = clustering.FeatureSettings(vocabulary_size=2, min_documents=2)
    counter, sought = clustering.text_stages(settings, found)[0], clustering.text_stages(settings)[0].fit(worded)
    assert sorted(sought.vocabulary) == sorted(counter.vocabulary)
    got = [r.term_counts.toArray().tolist() for r in counter.transform(worded).collect()]
    assert got == [[1, 2], [3, 1], [1, 0], [0, 0]]


def test_common_and_rare_terms_are_both_weighed(spark, capsys):
    n = 3 * terms.COMMON
    worded = spark.range(n).selectExpr("id AS cve_id", "array('all', concat('of-', id), concat('of-', id)) AS words")
    weights = terms.term_weights(worded)
    weights.explain()
    # all but rare terms find their weight without a shuffle
    assert "Union" in capsys.readouterr().out
    got = {(r.cve_id, r.term): (r.n, r.idf) for r in weights.collect()}
    assert len(got) == 2 * n
    assert all(got[i, "all"] == (1, 0.0) and got[i, f"of-{i}"] == (2, math.log((n + 1) / 2)) for i in range(n))


def test_topics_of_a_cluster_without_values(spark):
    rows = [(1, 0, ["v"], ["c"], 1), (2, 1, [], [], 0)]
    given = spark.createDataFrame(rows, "cve_id int, cluster_id int, cpe_vendors array<string>, cwes array<string>, is_kev int")
    weights = terms.term_weights(spark.createDataFrame([(1, ["x"]), (2, [])], "cve_id int, words array<string>"))
    got = {r.cluster_id: tuple(r)[1:] for r in clustering.cluster_topics(given, weights).collect()}
    assert got == {0: (["x"], ["v"], ["c"], 1, 1), 1: ([], [], [], 1, 0)}


def _entries(spark, points, labels):
    long = [(i, d, float(v)) for i, p in enumerate(points) for d, v in enumerate(p) if v]
    entries = spark.createDataFrame(long, "cve_id int, dim int, value double").repartition(5)
    assigned = [(i, None if c is None else int(c)) for i, c in enumerate(labels)]
    return entries, spark.createDataFrame(assigned, "cve_id int, cluster_id int")


def test_sparse_measures_equal_the_dense_ones(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator

    rng = np.random.default_rng(8)
    points = rng.normal(size=(150, 6)) * (rng.random((150, 6)) < 0.4)
    labels = rng.integers(0, 4, 150)
    points[3] = 0
    found = measures.moments(*_entries(spark, points, labels))
    dense = _points(spark, points, map(int, labels))
    assert measures.davies_bouldin(found) == pytest.approx(clustering.davies_bouldin(dense))
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    assert measures.silhouette(found) == pytest.approx(evaluator.evaluate(dense))
    centres = np.array([points[labels == c].mean(axis=0) for c in range(4)])
    assert measures.cost(found) == pytest.approx(((points - centres[labels]) ** 2).sum())


def test_measures_of_few_clusters(spark):
    one = measures.moments(*_entries(spark, [[1, 0], [0, 1]], [0, 0]))
    assert measures.silhouette(one) is None and measures.davies_bouldin(one) == math.inf
    alone = measures.moments(*_entries(spark, [[1, 0], [0, 1], [0, 3], [9, 9]], [0, 1, 1, None]))
    # the first is alone and counts zero; to its own cluster the others have 4, to the first 2 and 10
    assert measures.silhouette(alone) == pytest.approx((0 + (2 - 4) / 4 + (10 - 4) / 10) / 3)


def test_lloyd_equals_plain_rounds(spark):
    rng = np.random.default_rng(9)
    points = np.concatenate([rng.normal(c, 1, size=(40, 3)) for c in (0, 3, 6)])
    entries, records = _entries(spark, points, [None] * 120)
    start = [(c, d, float(v)) for c in range(4) for d, v in enumerate(points[c * 30])] + [(7, 0, 1e6)]
    assigned, centres = measures.lloyd(entries, records, spark.createDataFrame(start, "cluster_id int, dim int, value double"), 4)
    means = {c: points[c * 30] for c in range(4)} | {7: np.array([1e6, 0, 0])}
    for _ in range(4):
        own = [min(means, key=lambda c: (((p - means[c]) ** 2).sum(), c)) for p in points]
        means = {c: points[[o == c for o in own]].mean(axis=0) if c in own else means[c] for c in means}
    assert {r.cve_id: r.cluster_id for r in assigned.collect()} == dict(enumerate(own))
    for r in centres.collect():
        assert r.value == pytest.approx(means[r.cluster_id][r.dim], abs=1e-8)
    assert centres.where("cluster_id = 7").count() == 1


def _points(spark, points, labels):
    rows = [(list(map(float, p)), label) for p, label in zip(points, labels)]
    return spark.createDataFrame(rows, "p array<double>, prediction int").select(
        array_to_vector("p").alias("features"), "prediction"
    )


def test_davies_bouldin_equals_its_definition(spark):
    rng = np.random.default_rng(5)
    points, labels = rng.normal(size=(200, 4)), rng.integers(0, 5, 200)
    centres = np.array([points[labels == c].mean(axis=0) for c in range(5)])
    spread = np.array(
        [np.linalg.norm(points[labels == c] - centres[c], axis=1).mean() for c in range(5)]
    )
    worst = [
        max(
            (spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j])
            for j in range(5)
            if j != i
        )
        for i in range(5)
    ]
    df = _points(spark, points, map(int, labels)).repartition(7)
    assert clustering.davies_bouldin(df) == pytest.approx(np.mean(worst))


def test_davies_bouldin_of_one_cluster(spark):
    assert clustering.davies_bouldin(_points(spark, [[0, 0], [1, 1]], [0, 0])) == math.inf


def test_best_count(spark):
    from riskspark import schemas

    def best(*rows):
        return clustering.best_cluster_count(spark.createDataFrame(rows, schemas.CLUSTER_METRICS))

    assert best((4, 0.9, 10.0, 0.1), (6, 0.5, 5.0, 0.5)) == 4
    assert best((4, 0.1, 10.0, 0.9), (6, 0.5, 5.0, 0.5), (8, 0.4, 4.0, 0.7)) == 6
    assert best((4, 0.5, 9.0, 0.5), (6, 0.5, 9.0, 0.5)) == 4


def test_without_pca(scored):
    settings = clustering.FeatureSettings(50, 2, 5, 2, None)
    features, weights = clustering.build_features(clustering.prepare_text(scored), settings)
    width = features.select(F.size(vector_to_array("features")).alias("n")).first().n
    # three weaknesses, four vendors, three numbers
    assert width == weights.select("term").distinct().count() + 3 + 4 + 3


def test_the_whole_run_keeps_every_term_and_measures_sparsely(scored):
    run = clustering.run_clustering(scored, (2, 3), clustering.FeatureSettings(buckets=256))
    assert sum(r["size"] for r in run.topics.collect()) == 60
    assert all(-1 <= r.silhouette <= 1 and r.cost >= 0 and r.davies_bouldin >= 0 for r in run.metrics.collect())


def test_coinciding_centres_do_not_count(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(0, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [4.0, 0.0]), (2, [6.0, 0.0])]
    df = spark.createDataFrame([(c, Vectors.dense(v)) for c, v in rows], ["prediction", "features"])
    df = df.withColumn("prediction", df.prediction.cast("int"))
    # by hand: every cluster's worst is the pair with the third one, (0 + 1) / 5
    assert clustering.davies_bouldin(df) == pytest.approx(0.2)


def test_features_keep_every_term_unless_asked_otherwise():
    whole = clustering.FeatureSettings()
    assert (whole.min_documents, whole.category_min_documents, whole.pca_components) == (1, 1, None)
