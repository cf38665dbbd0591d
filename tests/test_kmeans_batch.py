"""Many K-Means models in one scan against a NumPy Lloyd."""

import numpy as np
from pyspark.ml.linalg import Vectors

from sessionloom.operators import kmeans_batch as kb
from sessionloom.operators.segments import find_best_k, folded_vectors, squared_silhouette, train_kmeans


def lloyd(X, w, c, max_iter, tol):
    for _ in range(max_iter):
        d = ((X[:, None, :] - c[None]) ** 2).sum(2)
        j = d.argmin(1)
        n = np.bincount(j, weights=w, minlength=len(c))
        s = np.zeros_like(c)
        np.add.at(s, j, X * w[:, None])
        moved = np.where(n[:, None] > 0, s / np.maximum(n, 1e-300)[:, None], c)
        shift = np.sqrt(((moved - c) ** 2).sum(1)).max()
        c = moved
        if shift <= tol:
            break
    d = ((X[:, None, :] - c[None]) ** 2).sum(2)
    return c, float((d.min(1) * w).sum())


def test_centres_equal_numpy_lloyd(spark):
    rng = np.random.default_rng(4)
    X = np.concatenate([rng.normal(m, 0.3, (60, 3)) for m in (0, 2, 5)])
    w = rng.integers(1, 4, len(X)).astype(float)
    df = spark.createDataFrame([(Vectors.dense(x), float(v)) for x, v in zip(X, w)], ["features", "weight"]).repartition(3).cache()
    init = {(k, r): X[rng.choice(len(X), k, replace=False)] for k in (2, 3, 4) for r in range(2)}
    fits = kb.fit_many(df, [2, 3, 4], 2, max_iter=50, weight_col="weight", init=init)
    for key, start in init.items():
        centres, inertia, rounds = fits[key]
        want_c, want_i = lloyd(X, w, start.astype(float), 50, 1e-4)
        assert np.allclose(centres, want_c, atol=1e-9) and np.isclose(inertia, want_i, rtol=1e-9)
        assert 1 <= rounds <= 50
    # the JVM-side assignment picks the nearest centre
    centres = fits[(3, 0)][0]
    for r in df.select("features", kb.nearest("features", centres).alias("j")).collect():
        assert r["j"] == ((r["features"].toArray() - centres) ** 2).sum(1).argmin()


def test_search_scores_every_k(spark):
    rng = np.random.default_rng(1)
    # three directions: the search works on unit vectors
    rows = [(i, [float(v) for v in np.eye(4)[i % 3] * 5 + rng.normal(0, 0.3, 4)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    best, scores = find_best_k(df, [2, 3, 4], "vec_id", restarts=2, max_iter=30)
    assert set(scores) == {2, 3, 4} and best == 3 and all(-1 <= s <= 1 for s in scores.values())


def test_silhouettes_equal_the_evaluator_on_all_rows(spark):
    rng = np.random.default_rng(7)
    X = np.concatenate([rng.normal(m, 0.8, (25, 3)) for m in (0, 2, 5)] + [[[40.0, 0, 0]]])  # the last is alone
    rows = spark.createDataFrame([(Vectors.dense(x),) for x in np.repeat(X, [*[1, 3] * 37, 2, 1], axis=0)], ["features"])
    models = {k: X[rng.choice(len(X) - 1, k, replace=False)] for k in (2, 4)}
    models[7] = np.vstack([models[4], X[-1:], [[900.0, 9, 9]]])  # a lone vector's cluster and an empty one
    got = kb.silhouettes(folded_vectors(rows), models, weight_col="weight")
    for key, centres in models.items():
        placed = rows.withColumn("segment_id", kb.nearest("features", centres))
        assert np.isclose(got[key], squared_silhouette(placed), atol=1e-9)
    assert kb.silhouettes(rows, {1: X[:1]}) == {1: 0.0}


def test_restarts_share_their_scans_and_the_inertia_is_that_of_the_returned_centres(spark, monkeypatch):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(400, 3))
    df = spark.createDataFrame([(Vectors.dense(x),) for x in X], ["features"]).repartition(40)
    scans = []
    summed = kb._summed
    monkeypatch.setattr(kb, "_summed", lambda arrays, *a: scans.append(arrays.rdd.getNumPartitions()) or summed(arrays, *a))
    model, inertia = train_kmeans(df, 5, max_iter=2, restarts=4)
    centres = np.array(model.clusterCenters())
    assert centres.shape == (5, 3)
    # Spark's own training cost is that of the centres before the last move
    assert np.isclose(inertia, ((X[:, None] - centres) ** 2).sum(2).min(1).sum(), rtol=1e-9)
    assert len(scans) == 3 and max(scans) < 40  # two rounds and the final cost, whatever the restarts
    assert {r["segment_id"] for r in model.transform(df).select("segment_id").collect()} == set(range(5))


def test_partial_sums_are_few_pieces_and_the_same_added_by_spark_or_here(spark, monkeypatch):
    rng = np.random.default_rng(5)
    X, C = rng.normal(size=(300, 4)), rng.normal(size=(6, 4))
    blocks = kb.packed(spark.createDataFrame([(Vectors.dense(x),) for x in X], ["features"]).repartition(5))
    assert blocks.columns == ["x", "w"] and blocks.count() <= 5  # blocks of vectors, not one row a vector
    j = ((X[:, None] - C) ** 2).sum(2).argmin(1)
    for direct in (kb.DIRECT, 0):
        monkeypatch.setattr(kb, "DIRECT", direct)
        sums, n, squares, cost = kb._round(blocks, {0: C}, 5)[0]
        assert np.allclose(sums, [X[j == k].sum(0) for k in range(6)]) and n.tolist() == np.bincount(j, minlength=6).tolist()
        assert np.isclose(squares.sum(), (X * X).sum()) and np.isclose(cost, ((X[:, None] - C) ** 2).sum(2).min(1).sum())


def test_starts_of_all_restarts_come_from_four_scans_and_cover_far_groups(spark, monkeypatch):
    rng = np.random.default_rng(8)
    X = np.concatenate([rng.normal(m, 0.1, (n, 2)) for m, n in ((0, 200), (50, 5), (-70, 3))])
    df = spark.createDataFrame([(Vectors.dense(x), 2.0) for x in X], ["features", "weight"]).repartition(3).cache()
    scans = []
    drawn = kb._drawn
    monkeypatch.setattr(kb, "_drawn", lambda *a: scans.append(1) or drawn(*a))
    starts = kb.parallel_starts(df, 3, 6, weight_col="weight")
    assert len(scans) == 3 and len(starts) == 6  # and one for the weights, whatever the restarts
    for c in starts:
        assert sorted(round(float(v), -1) for v in c.mean(1)) == [-70, 0, 50]
        assert all((np.abs(X - p).sum(1) == 0).any() for p in c)
    one = kb.parallel_starts(spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 4, ["features"]), 2, 2)
    assert [c.tolist() for c in one] == [[[1.0, 2.0]] * 2] * 2
    assert kb.parallel_starts(df.where("weight < 0"), 3, 2, weight_col="weight") == []
