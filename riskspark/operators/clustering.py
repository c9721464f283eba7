"""Text, category and numeric features, k-means and cluster topics.

Vectors for k-means number terms by a hash, or by a vocabulary where its size is a setting; neither
grows with the records. Whatever names terms, like the topics, works on the long tables of
``riskspark.operators.terms``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (
    IDF,
    PCA,
    CountVectorizer,
    CountVectorizerModel,
    HashingTF,
    StopWordsRemover,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from riskspark import constants as K, schemas
from riskspark.functions import scores
from riskspark.functions.text import clean_text, words
from riskspark.operators import measures, terms
from riskspark.operators.ranking import top_values
from riskspark.sources.workdir import stage_table

KEY = "cve_id"


@dataclass(frozen=True)
class FeatureSettings:
    """Which terms and dimensions features keep; by default all of them.

    Without a size terms and categories are numbered by a hash into ``buckets`` dimensions each, so
    that centres stay of one size; terms of one bucket count together in the distances only.
    ``SMALL_FEATURES`` is a small model: rare terms, all but the most frequent ones and all but the
    first principal components are lost in it.
    """

    vocabulary_size: int | None = None
    min_documents: int = 1
    category_size: int | None = None
    category_min_documents: int = 1
    pca_components: int | None = None
    buckets: int = 1 << 16


SMALL_FEATURES = FeatureSettings(
    K.VOCABULARY_SIZE,
    K.MIN_DOCUMENTS,
    K.CATEGORY_VOCABULARY_SIZE,
    K.CATEGORY_MIN_DOCUMENTS,
    K.PCA_COMPONENTS,
)


@dataclass(frozen=True)
class Clustering:
    """Tables of one clustering run."""

    assignments: DataFrame  # key, cluster_id
    metrics: DataFrame  # one row per tried k
    topics: DataFrame  # one row per cluster


def prepare_text(df: DataFrame) -> DataFrame:
    """Records with a description, its text cleaned, and no gaps in the other inputs."""
    none = F.array().cast("array<string>")
    return df.na.drop(subset=["description"]).select(
        KEY,
        clean_text(F.col("description")).alias("clean_text"),
        F.coalesce("cwes", none).alias("cwes"),
        F.coalesce("cpe_vendors", none).alias("cpe_vendors"),
        (scores.number("cvss_score") / F.lit(10.0)).alias("cvss_scaled"),
        scores.number("epss_percentile").alias("epss_percentile"),
        scores.number("is_kev", "int").alias("is_kev"),
    )


def words_of(prepared: DataFrame) -> DataFrame:
    """The clean text as a list of words that can tell clusters apart (M2, M3)."""
    stop_words = [*StopWordsRemover.loadDefaultStopWords("english"), *K.DOMAIN_STOP_WORDS]
    kept = words(F.col("clean_text"), stop_words, K.MIN_TOKEN_LENGTH)
    return prepared.withColumn("words", kept).drop("clean_text")


def _counter(source: str, target: str, size: int | None, least: int, buckets: int, binary: bool):
    if size is None:
        return HashingTF(inputCol=source, outputCol=target, numFeatures=buckets, binary=binary)
    return CountVectorizer(inputCol=source, outputCol=target, vocabSize=size, minDF=least, binary=binary)


def text_stages(settings: FeatureSettings, vocabulary: list[str] | None = None) -> list:
    """Counts and weights of terms; a ``vocabulary`` known already is not sought again."""
    if vocabulary:
        counter = CountVectorizerModel.from_vocabulary(vocabulary, "words", "term_counts")
    else:
        counter = _counter(
            "words", "term_counts", settings.vocabulary_size, settings.min_documents, settings.buckets, False
        )
    weigh = IDF(inputCol="term_counts", outputCol="tfidf")
    if settings.vocabulary_size is None:
        weigh.setMinDocFreq(settings.min_documents)
    return [counter, weigh]


def category_stages(settings: FeatureSettings) -> list:
    sizes = (settings.category_size, settings.category_min_documents, settings.buckets)
    return [_counter(column, f"{column}_vector", *sizes, True) for column in ("cwes", "cpe_vendors")]


def assembly_stages() -> list:
    return [
        VectorAssembler(
            inputCols=["cvss_scaled", "epss_percentile", "is_kev"], outputCol="numeric"
        ),
        VectorAssembler(
            inputCols=["tfidf", "cwes_vector", "cpe_vendors_vector", "numeric"],
            outputCol="assembled",
        ),
    ]


def project(df: DataFrame, column: str, components: int) -> tuple[DataFrame, list[float]]:
    """Vectors on their first principal components, as ``features``, and each one's share of the variance (M8).

    One aggregation leaves a covariance matrix, as large as the dimensions squared whatever the rows;
    rows are projected as they are, without taking off the mean. More components than dimensions are
    an error of the caller's.
    """
    model = PCA(k=components, inputCol=column, outputCol="features").fit(df)
    return model.transform(df), model.explainedVariance.toArray().tolist()


def build_features(
    prepared: DataFrame, settings: FeatureSettings = FeatureSettings()
) -> tuple[DataFrame, DataFrame]:
    """Feature table and the long table of term weights.

    Texts are split into words once; words and assembled vectors are written out, as fitting reads
    them several times, and words are counted once, for the vocabulary and the weights. The result
    keeps only the columns that clustering and topics need.
    """
    worded = stage_table(words_of(prepared), "words")
    counts = terms.row_counts(worded)
    vocabulary = None
    if settings.vocabulary_size is not None:
        vocabulary = terms.vocabulary(counts, settings.min_documents, settings.vocabulary_size)
    stages = text_stages(settings, vocabulary) + category_stages(settings) + assembly_stages()
    model = Pipeline(stages=stages).fit(worded)
    assembled = stage_table(
        model.transform(worded).select(KEY, "assembled", "cwes", "cpe_vendors", "is_kev"), "features"
    )
    if settings.pca_components is None:
        features = assembled.withColumnRenamed("assembled", "features")
    else:
        projected, _ = project(assembled, "assembled", settings.pca_components)
        features = stage_table(projected.drop("assembled"), "pca")
    weights = terms.term_weights(worded, settings.min_documents, settings.vocabulary_size, by_row=counts)
    return features, stage_table(weights, "term-weights")


def feature_entries(prepared: DataFrame, weights: DataFrame, settings: FeatureSettings = FeatureSettings()) -> DataFrame:
    """All features as a long table (``cve_id``, ``dim``, ``value``) without zeros, named, not numbered."""
    found = [weights.select(KEY, F.concat(F.lit("term:"), "term").alias("dim"), F.col("weight").alias("value"))]
    for column in ("cwes", "cpe_vendors"):
        rows = terms.category_rows(prepared, column, settings.category_min_documents, settings.category_size)
        found.append(rows.select(KEY, F.concat(F.lit(f"{column}:"), "value").alias("dim"), F.lit(1.0).alias("value")))
    for column in ("cvss_scaled", "epss_percentile", "is_kev"):
        found.append(prepared.select(KEY, F.lit(column).alias("dim"), F.col(column).cast("double").alias("value")))
    return reduce(DataFrame.union, found).where("value <> 0")


def davies_bouldin(predictions: DataFrame, cluster: str = "prediction") -> float:
    """Davies-Bouldin index over all rows of short vectors, infinite for fewer than two clusters.

    For vectors of many dimensions take ``measures.davies_bouldin``. Two aggregations with map-side combine reduce the rows to one centre and one mean distance per
    cluster; only those k rows reach the driver, where every cluster is compared with every other.
    """
    centres = {
        row[cluster]: row["centre"].toArray()
        for row in predictions.groupBy(cluster)
        .agg(Summarizer.mean(F.col("features")).alias("centre"))
        .collect()
    }
    if len(centres) < 2:
        return math.inf
    ids = sorted(centres)
    # k rows, k being a setting of the run
    centre_rows = predictions.sparkSession.createDataFrame(
        [(int(i), centres[i].tolist()) for i in ids], f"{cluster} int, centre array<double>"
    )
    squares = F.zip_with(
        vector_to_array("features"), "centre", lambda a, b: (a - b) * (a - b)
    )
    distance = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))
    spread = {
        row[cluster]: row["spread"]
        for row in predictions.join(F.broadcast(centre_rows), cluster)
        .groupBy(cluster)
        .agg(F.avg(distance).alias("spread"))
        .collect()
    }
    points = np.array([centres[i] for i in ids])
    spreads = np.array([spread[i] for i in ids])
    # squared gaps from one product of k x k numbers, no array of k x k x d
    norms = (points**2).sum(axis=1)
    gaps = np.sqrt(np.maximum(norms[:, None] + norms[None, :] - 2 * points @ points.T, 0.0))
    # centres in one place do not count as similar
    similarity = np.divide(
        spreads[:, None] + spreads[None, :], gaps, out=np.zeros_like(gaps), where=gaps > 1e-7 * np.sqrt(norms.max() + 1.0)
    )
    np.fill_diagonal(similarity, -np.inf)
    return float(similarity.max(axis=1).mean())


def try_cluster_counts(
    features: DataFrame,
    counts: Sequence[int] = K.CLUSTER_COUNTS,
    seed: int = K.KMEANS_SEED,
    iterations: int = K.KMEANS_ITERATIONS,
    entries: DataFrame | None = None,
) -> tuple[DataFrame, dict[int, KMeansModel]]:
    """Quality measures per cluster count, and the fitted models, so the best needs no refit.

    With ``entries``, the features as a sparse long table, they are measured there.
    """
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    models, rows = {}, []
    for k in counts:
        model = KMeans(k=k, seed=seed, maxIter=iterations).fit(features)
        predictions = model.transform(features)
        models[k] = model
        if entries is not None:
            found = measures.moments(entries, predictions.select(KEY, F.col("prediction").alias("cluster_id")))
            rows.append((k, measures.silhouette(found), measures.cost(found), measures.davies_bouldin(found)))
            continue
        # silhouette is undefined when everything falls into one cluster
        used = sum(size > 0 for size in model.summary.clusterSizes)
        silhouette = float(evaluator.evaluate(predictions)) if used > 1 else None
        rows.append((k, silhouette, float(model.summary.trainingCost), davies_bouldin(predictions)))
    metrics = features.sparkSession.createDataFrame(rows, schemas.CLUSTER_METRICS)
    return metrics, models


def best_cluster_count(metrics: DataFrame) -> int:
    """Smallest sum of the ranks by silhouette, cost and Davies-Bouldin; the smaller k on a tie.

    The frame has one row per tried count.
    """
    table = metrics.toPandas()
    ranks = (
        table["silhouette"].rank(ascending=False, method="first", na_option="bottom")
        + table["cost"].rank(method="first")
        + table["davies_bouldin"].rank(method="first")
    )
    return int(table.loc[ranks.idxmin(), "k"])


def cluster_topics(
    clustered: DataFrame, weights: DataFrame, n_values: int = K.TOP_VALUES, n_terms: int = K.TOP_KEYWORDS
) -> DataFrame:
    """Keywords, most frequent vendors and weaknesses, size and flagged count of every cluster.

    One row per cluster in ``clustered``; a list that a cluster has nothing for is empty.
    """
    sizes = clustered.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("size"), F.sum(F.col("is_kev").cast("long")).alias("kev_count")
    )
    lists = {
        "top_keywords": terms.top_terms(weights, clustered, n_terms),
        "top_vendors": top_values(clustered, "cluster_id", "cpe_vendors", n_values, "top_vendors"),
        "top_cwes": top_values(clustered, "cluster_id", "cwes", n_values, "top_cwes"),
    }
    topics = reduce(lambda left, right: left.join(right, "cluster_id", "left"), lists.values(), sizes)
    none = F.array().cast("array<string>")
    return topics.select("cluster_id", *[F.coalesce(name, none).alias(name) for name in lists], "size", "kev_count")


def run_clustering(
    scored: DataFrame,
    counts: Sequence[int] = K.CLUSTER_COUNTS,
    settings: FeatureSettings = FeatureSettings(),
) -> Clustering:
    prepared = prepare_text(scored)
    features, weights = build_features(prepared, settings)
    # principal components are few and dense; all other features are long and mostly zero
    entries = None
    if settings.pca_components is None:
        entries = stage_table(feature_entries(prepared, weights, settings), "feature-entries")
    metrics, models = try_cluster_counts(features, counts, entries=entries)
    best = models[best_cluster_count(metrics)]
    clustered = stage_table(
        best.transform(features)
        .withColumnRenamed("prediction", "cluster_id")
        .select(KEY, "cluster_id", "cwes", "cpe_vendors", "is_kev"),
        "clustered",
    )
    return Clustering(
        assignments=clustered.select(KEY, "cluster_id"),
        metrics=metrics,
        topics=cluster_topics(clustered, weights),
    )


def attach_clusters(scored: DataFrame, assignments: DataFrame) -> DataFrame:
    """Cluster of every record, null for those without a text."""
    return scored.drop("cluster_id").join(assignments, KEY, "left")
