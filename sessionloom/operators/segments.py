"""Audience segments: K-Means on unit vectors, silhouette, segment profiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import make_config
from ..functions.numeric import round_half_up
from ..functions.text import segment_label
from .kmeans_batch import fit_many, parallel_starts, silhouettes, stored_vectors
from .ranking import sample_rows
from .textsignals import unit_features


def subsample(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """Exactly min(n, N) rows without replacement, keyed by id."""
    return sample_rows(df, n, id_col, seed, tag="subsample")


# -- silhouette ---------------------------------------------------------------------


def point_silhouettes(
    points: DataFrame, id_col: str, vector_col: str, cluster_col: str, most: int = 10_000
) -> DataFrame:
    """Exact Euclidean silhouette of every point of a bounded sample.

    ``points`` must be a sample (at most ``most`` rows): it is shipped to the
    executors once and each partition measures its own points against it, so no pair of
    points is ever a row.
    """
    spark = points.sparkSession
    is_array = dict(points.dtypes)[vector_col].startswith("array")
    values = F.col(vector_col).cast("array<double>") if is_array else vector_to_array(vector_col)
    points = points.select(id_col, values.alias("v"), F.col(cluster_col).cast("int").alias("c"))
    local = points.select("v", "c").limit(most + 1).toPandas()
    if len(local) > most:
        raise ValueError(f"silhouette needs a sample of at most {most} points")
    schema = f"{id_col} {dict(points.dtypes)[id_col]}, silhouette double"
    if len(local) == 0:
        return spark.createDataFrame([], schema)
    labels, codes = np.unique(local["c"].to_numpy(), return_inverse=True)
    matrix = np.vstack(local["v"].to_list())
    shared = spark.sparkContext.broadcast((matrix, codes, labels))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        others, codes, labels = shared.value
        sizes = np.bincount(codes, minlength=len(labels)).astype(float)
        member = np.zeros((len(codes), len(labels)))
        member[np.arange(len(codes)), codes] = 1.0
        squares = (others**2).sum(axis=1)
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.iloc[start : start + 256]
                mine = np.vstack(part["v"].to_list())
                own = np.searchsorted(labels, part["c"].to_numpy())
                gaps = squares[None, :] + (mine**2).sum(axis=1)[:, None] - 2.0 * mine @ others.T
                sums = np.sqrt(np.maximum(gaps, 0.0)) @ member
                rows = np.arange(len(part))
                peers = sizes[own] - 1.0
                inner = np.divide(sums[rows, own], peers, out=np.zeros(len(part)), where=peers > 0)
                means = sums / sizes
                means[rows, own] = np.inf
                outer = means.min(axis=1)
                top = np.maximum(inner, outer)
                valid = (peers > 0) & np.isfinite(outer) & (top > 0)
                value = np.divide(outer - inner, top, out=np.zeros(len(part)), where=valid)
                yield pd.DataFrame({id_col: part[id_col].to_numpy(), "silhouette": value})

    return points.mapInPandas(measure, schema)


def mean_silhouette(
    df: DataFrame,
    id_col: str,
    vector_col: str = "embedding",
    cluster_col: str = "segment_id",
    sample_size: int = 10_000,
    seed: int = 42,
) -> DataFrame:
    """One row (silhouette, n_points): mean Euclidean silhouette of a seeded sample of ``sample_size`` points.

    Every point of the sample is measured against every other; ``squared_silhouette`` takes all rows.
    """
    sample = subsample(df.select(id_col, vector_col, cluster_col), sample_size, id_col, seed)
    return point_silhouettes(sample, id_col, vector_col, cluster_col, sample_size).agg(
        F.avg("silhouette").alias("silhouette"), F.count(F.lit(1)).alias("n_points")
    )


def squared_silhouette(df: DataFrame, features_col: str = "features", cluster_col: str = "segment_id") -> float:
    """Silhouette over all rows with squared Euclidean distance, from per-cluster sums: linear cost.

    0 where there are fewer than two clusters.
    """
    if df.select(cluster_col).distinct().limit(2).count() < 2:
        return 0.0
    return ClusteringEvaluator(
        featuresCol=features_col, predictionCol=cluster_col, metricName="silhouette"
    ).evaluate(df)


# -- fitting ------------------------------------------------------------------------


def train_kmeans(
    vectors: DataFrame,
    n_clusters: int,
    init: str = "k-means||",
    max_iter: int = 500,
    seed: int = 42,
    restarts: int = 10,
    features_col: str = "features",
    weight_col: str | None = None,
) -> tuple[KMeansModel, float]:
    """Best of several seeded fits and its inertia. ``vectors`` should be unit length and persisted.

    All restarts take their k-means|| centres over all rows in a few shared scans (other starts are MLlib's), then
    move together, one scan a round (``kmeans_batch``). ``weight_col`` counts how often a vector occurs (see ``folded_vectors``). ``k-means++``
    is accepted and means its parallel form ``k-means||``.
    """
    arrays = stored_vectors(vectors, features_col, weight_col)
    try:
        return _train_stored(arrays, n_clusters, init, max_iter, seed, restarts, features_col)
    finally:
        arrays.unpersist()


def _train_stored(
    arrays: DataFrame, n_clusters: int, init: str, max_iter: int, seed: int, restarts: int, features_col: str = "features"
) -> tuple[KMeansModel, float]:
    """``train_kmeans`` over ``stored_vectors``."""
    mode = "k-means||" if init == "k-means++" else init
    rows = arrays.select(array_to_vector("x").alias(features_col), "w")
    first: dict[tuple[int, int], np.ndarray] = {}
    if mode == "k-means||":
        starts = parallel_starts(arrays, n_clusters, restarts, seed, features_col="x", weight_col="w")
        first = {(n_clusters, attempt): start for attempt, start in enumerate(starts)}
    for attempt in range(len(first), restarts):
        start = KMeans(
            k=n_clusters, initMode=mode, maxIter=0, seed=seed + attempt, featuresCol=features_col, weightCol="w"
        )
        first[(n_clusters, attempt)] = np.array(start.fit(rows).clusterCenters())
    fits = fit_many(arrays, [n_clusters], restarts, max_iter=max_iter, features_col="x", weight_col="w", init=first)
    centres, inertia, _ = min(fits.values(), key=lambda f: f[1])
    return kmeans_model(arrays.sparkSession, centres, features_col), inertia


def kmeans_model(spark: SparkSession, centres: np.ndarray, features_col: str = "features") -> KMeansModel:
    """An MLlib model with these centres: one random start on the centres alone takes each as it is."""
    distinct = np.unique(centres, axis=0)
    rows = spark.createDataFrame([(Vectors.dense(c),) for c in distinct], [features_col])
    return KMeans(
        k=max(len(distinct), 2), initMode="random", maxIter=0, featuresCol=features_col, predictionCol="segment_id"
    ).fit(rows)


def folded_vectors(vectors: DataFrame, features_col: str = "features") -> DataFrame:
    """Distinct vectors with their number as ``weight``: the same K-Means objective over fewer rows.

    Short texts often share a vector, and a fit passes over its rows dozens of times, so one shuffle
    (combined map-side) pays. Where all vectors differ it costs one more pass.
    """
    return vectors.groupBy(features_col).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def assign_segments(vectors: DataFrame, model: KMeansModel) -> DataFrame:
    """Add ``segment_id`` to every row (narrow: nearest centre)."""
    return model.transform(vectors)


def find_best_k(
    embeddings: DataFrame,
    k_range: Sequence[int],
    id_col: str,
    vector_col: str = "embedding",
    seed: int = 42,
    sample_size: int | None = None,
    restarts: int = 5,
    max_iter: int = 300,
) -> tuple[int, dict[int, float]]:
    """Fit and score each k on all vectors (or on a seeded sample of ``sample_size``).

    The best squared silhouette wins, the smaller k on ties.
    """
    taken = embeddings.select(id_col, vector_col)
    taken = taken if sample_size is None else subsample(taken, sample_size, id_col, seed)
    vectors = unit_features(taken, vector_col)
    folded = stored_vectors(folded_vectors(vectors), weight_col="weight")
    try:
        return _best_k_stored(folded, k_range, seed, restarts, max_iter)
    finally:
        folded.unpersist()


def _best_k_stored(
    folded: DataFrame, k_range: Sequence[int], seed: int, restarts: int, max_iter: int = 300
) -> tuple[int, dict[int, float]]:
    """``find_best_k`` over ``stored_vectors``."""
    columns = {"features_col": "x", "weight_col": "w"}
    # every k and restart in one scan per round (kmeans_batch); the best restart of each k is scored
    fits = fit_many(folded, list(k_range), restarts, seed=seed, max_iter=max_iter, **columns)
    best = {k: min((f for (of, _), f in fits.items() if of == k), key=lambda f: f[1])[0] for k in k_range if fits}
    scores = dict.fromkeys(k_range, 0.0) | silhouettes(folded, best, **columns)
    return min(scores, key=lambda k: (-scores[k], k)), scores


def search_scores(spark, scores: dict[int, float]) -> DataFrame:
    return spark.createDataFrame([(int(k), float(s)) for k, s in scores.items()], "k int, silhouette double")


# -- profiles -----------------------------------------------------------------------


def _terms(segmented: DataFrame) -> DataFrame:
    """(segment_id, kind, term, n): keyword tokens and categories counted in one pass."""
    words = F.filter(F.split(F.coalesce("keywords", F.lit("")), r"\s+"), lambda w: w != "")
    categories = F.coalesce(F.col("content_categories"), F.array().cast("array<string>"))

    def tagged(values: Column, kind: str) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("term")))

    both = F.explode(F.concat(tagged(words, "keyword"), tagged(categories, "category"))).alias("t")
    return (
        segmented.select("segment_id", both)
        .groupBy("segment_id", F.col("t.kind").alias("kind"), F.col("t.term").alias("term"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_terms(segmented: DataFrame, top_keywords: int = 8, top_categories: int = 5) -> DataFrame:
    """(segment_id, kind, term, n, rank): most frequent terms, ties by term.

    The rank filter is applied per task before the shuffle (window group limit), so a
    large vocabulary never meets in one task.
    """
    order = W.partitionBy("segment_id", "kind").orderBy(F.desc("n"), "term")
    ranked = _terms(segmented).withColumn("rank", F.row_number().over(order))
    largest = max(top_keywords, top_categories)
    limit = F.when(F.col("kind") == "keyword", top_keywords).otherwise(top_categories)
    return ranked.where(F.col("rank") <= largest).where(F.col("rank") <= limit)


_BEHAVIOUR = {
    "scroll_depth_avg": ("avg_scroll_depth", 3),
    "session_duration_s": ("avg_session_duration_s", 1),
    "click_count": ("avg_click_count", 1),
    "pages_visited": ("avg_pages_visited", 1),
}


def device_shares(segmented: DataFrame) -> DataFrame:
    """(segment_id, device_type, n_sessions, share) with the share to 3 decimals."""
    counts = segmented.where(F.col("device_type").isNotNull()).groupBy("segment_id", "device_type").agg(
        F.count(F.lit(1)).alias("n_sessions")
    )
    whole = F.sum("n_sessions").over(W.partitionBy("segment_id"))
    return counts.withColumn("share", round_half_up(F.col("n_sessions") / whole, 3))


def segment_sizes(segmented: DataFrame) -> DataFrame:
    """Size, share of all sessions, behavioural averages and device shares per segment.

    One pass: sums per (segment, device), then one row per segment.
    """
    sums = [F.sum(c).alias(f"sum_{c}") for c in _BEHAVIOUR] + [F.count(c).alias(f"n_{c}") for c in _BEHAVIOUR]
    per_device = segmented.groupBy("segment_id", "device_type").agg(F.count(F.lit(1)).alias("n"), *sums)
    listed = F.when(F.col("device_type").isNotNull(), F.struct((-F.col("n")).alias("order"), "device_type", "n"))
    per_segment = per_device.groupBy("segment_id").agg(
        F.sum("n").alias("n_sessions"),
        F.sum(F.when(F.col("device_type") == "mobile", F.col("n")).otherwise(0)).alias("mobile"),
        F.sum(F.when(F.col("device_type").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
        F.array_sort(F.collect_list(listed)).alias("devices"),  # one entry per device class
        *[F.sum(f"{p}_{c}").alias(f"{p}_{c}") for p in ("sum", "n") for c in _BEHAVIOUR],
    )
    everything = F.sum("n_sessions").over(W.partitionBy(F.lit(1)))  # one row per segment
    averages = [
        round_half_up(F.try_divide(f"sum_{c}", f"n_{c}"), digits).alias(name) for c, (name, digits) in _BEHAVIOUR.items()
    ]
    shares = F.transform(
        "devices", lambda d: F.struct(d["device_type"], round_half_up(d["n"] / F.col("known"), 3))
    )
    return per_segment.select(
        "segment_id",
        "n_sessions",
        round_half_up(F.lit(100.0) * F.col("n_sessions") / everything, 2).alias("pct_of_total"),
        *averages,
        round_half_up(F.lit(100.0) * F.col("mobile") / F.col("n_sessions"), 1).alias("pct_mobile"),
        F.map_from_entries(shares).alias("device_distribution"),
    )


def label_segments(segmented: DataFrame, top_keywords: int = 8, top_categories: int = 5) -> DataFrame:
    """The segment profile table: one row per segment, in the audience_segments contract.

    ``segmented`` has segment_id, keywords, content_categories, device_type and the
    behaviour columns. Two passes over the sessions (behaviour, terms) end in one row per segment each.
    """

    def collected(kind: str) -> Column:
        wanted = F.when(F.col("kind") == kind, F.struct("rank", "term"))
        return F.transform(F.array_sort(F.collect_list(wanted)), lambda s: s["term"])

    terms = top_terms(segmented, top_keywords, top_categories).groupBy("segment_id").agg(
        collected("keyword").alias("words"), collected("category").alias("cats")
    )
    return (
        segment_sizes(segmented)
        .join(terms, "segment_id", "left")
        .select(
            "segment_id",
            segment_label(F.col("cats"), F.col("words"), F.col("segment_id")).alias("segment_label"),
            "n_sessions",
            "pct_of_total",
            F.coalesce(F.array_join("words", ", "), F.lit("")).alias("top_keywords"),
            F.coalesce(F.array_join("cats", ", "), F.lit("")).alias("top_categories"),
            "device_distribution",
            "avg_scroll_depth",
            "avg_session_duration_s",
            "avg_click_count",
            "avg_pages_visited",
            "pct_mobile",
        )
        .orderBy("segment_id")
    )


# -- driver -------------------------------------------------------------------------


@dataclass
class SegmentationResult:
    segmented: DataFrame
    profiles: DataFrame
    model: KMeansModel
    n_clusters: int
    inertia: float
    silhouette: float
    search: dict[int, float]


def run_segmentation(
    sessions: DataFrame, cfg: dict[str, Any] | None = None, id_col: str = "session_id", vector_col: str = "embedding"
) -> SegmentationResult:
    """Optional k search, final fit, silhouette, assignment and profiles.

    ``sessions`` carries the embedding, keywords and behaviour columns on one row; the key
    travels with the vector instead of relying on row position.
    """
    seg = make_config(cfg)["segmentation"]
    seed = seg["kmeans_random_state"]
    k_range, n_clusters, search = list(seg["k_search_range"]), seg["n_clusters"], {}
    vectors = unit_features(sessions.select(id_col, vector_col), vector_col).drop(vector_col)
    # folded and written once: the k search, the fit and the silhouette read the same files
    folded = stored_vectors(folded_vectors(vectors), weight_col="weight")
    try:
        if len(k_range) > 1:
            n_clusters, search = _best_k_stored(folded, k_range, seed, seg["search_restarts"])
        model, inertia = _train_stored(
            folded, n_clusters, seg["kmeans_init"], seg["kmeans_max_iter"], seed, seg["kmeans_restarts"]
        )
        centres = np.array(model.clusterCenters())
        silhouette = silhouettes(folded, {n_clusters: centres}, features_col="x", weight_col="w")[n_clusters]
    finally:
        folded.unpersist()
    segmented = assign_segments(unit_features(sessions, vector_col), model).drop("features")
    return SegmentationResult(
        segmented=segmented,
        profiles=label_segments(segmented, seg["top_keywords_per_segment"]),
        model=model,
        n_clusters=n_clusters,
        inertia=inertia,
        silhouette=silhouette,
        search=search,
    )
