import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import assert_no_all_pairs_join, make_sessions, plan_text
from sessionloom.operators import segments as sg
from sessionloom.operators.textsignals import unit_features
from sessionloom.schemas import SEGMENTS_SCHEMA


@pytest.fixture(scope="module")
def blobs(spark):
    """Three separated groups of unit vectors."""
    rng = np.random.default_rng(4)
    centres = np.eye(8)[:3]
    rows = []
    for i in range(90):
        v = centres[i % 3] + rng.normal(0, 0.05, 8)
        rows.append((i, [float(x) for x in v / np.linalg.norm(v)], i % 3))
    return spark.createDataFrame(rows, "id long, embedding array<double>, segment_id int").cache()


def _brute_silhouette(points):
    scores = []
    for i, v, c in points:
        groups = {}
        for j, w, d in points:
            if i != j:
                groups.setdefault(d, []).append(float(np.linalg.norm(np.array(v) - np.array(w))))
        others = [np.mean(x) for d, x in groups.items() if d != c]
        if c not in groups or not others:
            scores.append(0.0)
            continue
        a, b = np.mean(groups[c]), min(others)
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


def test_silhouette_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=5)], int(rng.integers(0, 4)) * 3) for i in range(80)]
    rows.append((80, [9.0] * 5, 99))  # a singleton counts 0
    rows.append((81, rows[0][1], rows[0][2]))  # an exact copy
    df = spark.createDataFrame(rows, "id long, embedding array<double>, segment_id int").repartition(5)
    got = sg.mean_silhouette(df, "id").first()
    assert got["n_points"] == 82
    assert abs(got["silhouette"] - _brute_silhouette(rows)) < 1e-7


def test_one_cluster_has_silhouette_zero(spark, blobs):
    assert sg.mean_silhouette(blobs.withColumn("segment_id", F.lit(0)), "id").first()["silhouette"] == 0.0


def test_silhouette_sample_is_bounded(blobs):
    assert sg.mean_silhouette(blobs, "id", sample_size=40).first()["n_points"] == 40
    with pytest.raises(ValueError):
        sg.point_silhouettes(blobs, "id", "embedding", "segment_id", most=10)


def test_subsample(spark):
    df = spark.range(100).withColumnRenamed("id", "session_id")
    assert sg.subsample(df, 30, "session_id").count() == 30
    assert sg.subsample(df, 300, "session_id").count() == 100
    assert sg.subsample(df, 30, "session_id", 1).exceptAll(sg.subsample(df, 30, "session_id", 2)).count() > 0


def test_kmeans(blobs):
    vectors = unit_features(blobs.drop("segment_id"))
    model, inertia = sg.train_kmeans(vectors, 3, restarts=3)
    assigned = sg.assign_segments(vectors, model)
    assert assigned.count() == 90
    assert {r[0] for r in assigned.select("segment_id").distinct().collect()} == {0, 1, 2}
    centres = [np.array(c) for c in model.clusterCenters()]
    cost = 0.0
    for row in assigned.collect():
        distances = [float(((row["features"].toArray() - c) ** 2).sum()) for c in centres]
        assert row["segment_id"] == int(np.argmin(distances))
        cost += min(distances)
    assert abs(cost - inertia) < 1e-6


def test_best_k_finds_the_groups(blobs):
    best, scores = sg.find_best_k(blobs.drop("segment_id"), [2, 3, 4], "id", restarts=2)
    assert best == 3 and set(scores) == {2, 3, 4} and all(isinstance(s, float) for s in scores.values())


def test_squared_silhouette_is_available(blobs):
    assert sg.squared_silhouette(unit_features(blobs)) > 0.9
    assert sg.squared_silhouette(unit_features(blobs).withColumn("segment_id", F.lit(0))) == 0.0


def _segmented(spark):
    rows = [
        {"keywords": "beta alpha beta", "content_categories": ["x", "y"], "device_type": "mobile", "segment_id": 0},
        {"keywords": "alpha gamma", "content_categories": ["y"], "device_type": "mobile", "segment_id": 0},
        {"keywords": "", "content_categories": [], "device_type": "tablet", "segment_id": 0},
        {"keywords": None, "content_categories": None, "device_type": "desktop", "segment_id": 3},
    ]
    base = make_sessions(
        spark, [{k: r[k] for k in ("content_categories", "device_type")} | {"scroll_depth_avg": i / 10} for i, r in enumerate(rows)]
    )
    extra = spark.createDataFrame(
        [(f"s{i}", r["keywords"], r["segment_id"]) for i, r in enumerate(rows)],
        "session_id string, keywords string, segment_id int",
    )
    return base.join(extra, "session_id")


def test_top_terms_and_ties(spark):
    rows = sg.top_terms(_segmented(spark), 2, 5).collect()
    words = {r["rank"]: (r["term"], r["n"]) for r in rows if r["kind"] == "keyword"}
    assert words == {1: ("alpha", 2), 2: ("beta", 2)}  # a tie goes to the smaller term
    cats = {r["rank"]: r["term"] for r in rows if r["kind"] == "category"}
    assert cats == {1: "y", 2: "x"}


def test_top_terms_limits_before_the_shuffle(spark):
    text = plan_text(sg.top_terms(_segmented(spark)))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_profiles(spark):
    profiles = sg.label_segments(_segmented(spark), 5, 5)
    assert [f.name for f in profiles.schema.fields] == SEGMENTS_SCHEMA.fieldNames()
    rows = {r["segment_id"]: r for r in profiles.collect()}
    first, second = rows[0], rows[3]
    assert first["segment_label"] == "Y & X & Alpha" and second["segment_label"] == "Segment 3"
    assert first["top_keywords"] == "alpha, beta, gamma" and second["top_keywords"] == ""
    assert first["top_categories"] == "y, x"
    assert first["n_sessions"] == 3 and first["pct_of_total"] == 75.0 and first["pct_mobile"] == 66.7
    assert first["device_distribution"] == {"mobile": 0.667, "tablet": 0.333}
    assert first["avg_scroll_depth"] == 0.1 and second["avg_scroll_depth"] == 0.3
    assert_no_all_pairs_join(profiles)


def test_profile_sums(workspace):
    profiles = sg.label_segments(workspace.enriched())
    totals = profiles.agg(F.sum("n_sessions"), F.sum("pct_of_total")).first()
    assert totals[0] == workspace.enriched().count() and abs(totals[1] - 100) < 1


def test_hot_segment(spark):
    """One segment and one word hold most rows: counts stay exact."""
    rng = random.Random(1)
    rows = [(0 if rng.random() < 0.6 else 1, "hot" if rng.random() < 0.5 else f"w{rng.randint(0, 500)}") for _ in range(3000)]
    df = spark.createDataFrame(
        [(s, w, ["c"]) for s, w in rows], "segment_id int, keywords string, content_categories array<string>"
    )
    got = {(r["segment_id"], r["term"]): r["n"] for r in sg.top_terms(df).where("kind = 'keyword'").collect()}
    for segment in (0, 1):
        counts = {}
        for s, w in rows:
            if s == segment:
                counts[w] = counts.get(w, 0) + 1
        want = dict(sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:8])
        assert {t: n for (s, t), n in got.items() if s == segment} == want


def test_folded_vectors_keep_the_objective(spark, blobs):
    from pyspark.ml.functions import vector_to_array

    vectors = unit_features(blobs.unionByName(blobs.where("id % 3 = 0")).drop("segment_id"))
    folded = sg.folded_vectors(vectors)
    assert folded.agg(F.sum("weight")).first()[0] == vectors.count() > folded.count()
    model, inertia = sg.train_kmeans(folded, 3, restarts=2, weight_col="weight")
    placed = sg.assign_segments(vectors, model).withColumn("v", vector_to_array("features"))
    centres = model.clusterCenters()
    total = sum(float(((r["v"] - centres[r["segment_id"]]) ** 2).sum()) for r in placed.select("v", "segment_id").collect())
    assert abs(total - inertia) < 1e-6


def test_run_folds_its_vectors_once(spark, monkeypatch):
    shapes = np.eye(6)[[0, 0, 1, 1, 2, 2, 3, 3]] + np.repeat([0.0, 0.1], 4)[:, None]
    rows = [
        (f"s{i}", [float(x) for x in shapes[i % 8]], f"word{i % 4}", ["chess"], "mobile", 0.5, 10, 1, 2) for i in range(48)
    ]
    schema = (
        "session_id string, embedding array<double>, keywords string, content_categories array<string>, "
        "device_type string, scroll_depth_avg double, session_duration_s long, click_count long, pages_visited long"
    )
    sessions = spark.createDataFrame(rows, schema)
    real, folds = sg.folded_vectors, []
    monkeypatch.setattr(sg, "folded_vectors", lambda *a, **k: folds.append(1) or real(*a, **k))
    cfg = {"segmentation": {"k_search_range": [2, 3, 4], "search_restarts": 2, "kmeans_restarts": 2}}
    result = sg.run_segmentation(sessions, cfg)
    assert len(folds) == 1  # one shuffle of the vectors for the k search and the fit
    n_clusters, search = sg.find_best_k(sessions, [2, 3, 4], "session_id", restarts=2)
    assert result.n_clusters == n_clusters
    assert result.search == pytest.approx(search)
    placed = sg.assign_segments(unit_features(sessions, "embedding"), result.model)
    assert result.silhouette == pytest.approx(sg.squared_silhouette(placed), abs=1e-6)
    assert result.segmented.count() == 48 and result.profiles.agg(F.sum("n_sessions")).first()[0] == 48
