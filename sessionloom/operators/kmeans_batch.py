"""Many K-Means models fitted at once: every k and every restart share one scan of the vectors per round.

The vectors are packed once into binary blocks, so that a round copies them to the workers as they are. Each round,
a task multiplies its blocks once with the centres of all models
still moving; every model's nearest centres make one 0/1 matrix whose product with the vectors is the weighted
sum of each centre. These partial sums (at most models x k x (dimensions + 2) numbers a task, whatever the number of
vectors) leave the tasks as a few binary pieces; while all tasks' together are small (``DIRECT``), the driver adds
them and a round is one stage, beyond that Spark adds them over tasks first. The driver moves the centres. A model whose centres all moved by at most
``tol`` is converged and leaves the scan, so a search costs as many rounds as its slowest fit, not the sum of
all fits. A cluster that gets no vector keeps its centre.

Seeding is k-means++ per model (weighted by ``weight``, its own seed per restart) on a seeded sample of at
most ``INIT_ROWS`` distinct vectors, chosen by a hash order of the vectors and so alike at every size, unless
the caller gives the first centres; Lloyd's rounds, the final inertia and the silhouettes run over all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialised

INIT_ROWS = 20_000
# Vectors multiplied with all centres at a time, and so packed into one block.
_STEP = 2_048
# Bytes of all tasks' partial sums that the driver adds itself; numbers in a piece of them.
DIRECT = 64 << 20
_PIECE = 1 << 14


def vector_arrays(vectors: DataFrame, features_col: str = "features", weight_col: str | None = None) -> DataFrame:
    """(x array<double>, w double) of ML vectors or arrays: what every scan here reads."""
    is_array = dict(vectors.dtypes)[features_col].startswith("array")
    x = F.col(features_col).cast("array<double>") if is_array else vector_to_array(features_col)
    w = F.col(weight_col) if weight_col else F.lit(1.0)
    return vectors.select(x.alias("x"), w.cast("double").alias("w"))


def stored_vectors(vectors: DataFrame, features_col: str = "features", weight_col: str | None = None) -> DataFrame:
    """``vector_arrays`` written once in files of even size and persisted: a round's tasks follow from the size of
    the vectors, not from the shuffle partitions or the input splits of the plan that made them."""
    even = vector_arrays(vectors, features_col, weight_col).hint("rebalance")
    return materialised(even, "vectors").persist(StorageLevel.MEMORY_AND_DISK)


def _matrix(x: pa.ListArray) -> np.ndarray:
    """The vectors of an Arrow column as the rows of one matrix, without a copy."""
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def seeding_rows(vectors: DataFrame, seed: int, features_col: str = "features", weight_col: str | None = None, rows: int = INIT_ROWS):
    """(X, w) of a seeded sample of at most ``rows`` vectors, in a fixed order."""
    arrays = vector_arrays(vectors, features_col, weight_col)
    taken = arrays.withColumn("_o", F.xxhash64(F.lit(seed), "x")).orderBy("_o", "x").limit(rows).toArrow()
    if not taken.num_rows:
        return np.zeros((0, 0)), np.zeros(0)
    return _matrix(taken["x"].combine_chunks()), taken["w"].to_numpy()


def plus_plus(X: np.ndarray, w: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Weighted k-means++ seeding; repeats a point when fewer than k distinct ones exist."""
    rng = np.random.default_rng(seed)
    squares = (X * X).sum(1)

    def apart(pick: int) -> np.ndarray:
        d = squares - 2 * (X @ X[pick]) + squares[pick]
        return np.where(d > 1e-12 * (squares + squares[pick]), d, 0.0)  # what rounding leaves of a copy is 0

    chosen = [int(rng.choice(len(X), p=w / w.sum()))]
    near = apart(chosen[0])
    for _ in range(1, k):
        weight = near * w
        pick = int(rng.choice(len(X), p=weight / weight.sum())) if weight.sum() > 0 else chosen[-1]
        chosen.append(pick)
        near = np.minimum(near, apart(pick))
    return X[chosen].copy()


def _sizes(models: dict[int, np.ndarray]) -> dict[int, slice]:
    """Each model's rows in the stacked centres of all models."""
    ends = np.cumsum([len(c) for c in models.values()])
    return {m: slice(int(end) - len(c), int(end)) for (m, c), end in zip(models.items(), ends, strict=True)}


def packed(vectors: DataFrame, features_col: str = "features", weight_col: str | None = None) -> DataFrame:
    """(x binary, w binary): blocks of at most ``_STEP`` vectors and their weights as doubles, row by row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _STEP):
                part = batch.slice(at, _STEP)
                columns = (_matrix(part.column("x")), part.column("w").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], ["x", "w"])

    return vector_arrays(vectors, features_col, weight_col).mapInArrow(pack, "x binary, w binary")


def _added(pieces: Iterator[tuple[int, bytes]]) -> dict[int, np.ndarray]:
    """The pieces of partial sums, added by their number."""
    out: dict[int, np.ndarray] = {}
    for p, v in pieces:
        numbers = np.frombuffer(v)
        out[p] = out[p] + numbers if p in out else numbers
    return out


def _summed(blocks: DataFrame, size: int, add: Callable[[np.ndarray, np.ndarray, np.ndarray], None], parts: int) -> np.ndarray:
    """One scan: ``add(X, w, total)`` adds a block to a task's ``total`` of ``size`` numbers; all tasks' totals are
    added, here or by Spark. ``parts`` is the number of tasks."""
    schema = "p int, v binary"

    def batch_of(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["p", "v"]
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), False
        for batch in batches:
            for x, w in zip(batch.column("x"), batch.column("w"), strict=True):
                weights, seen = np.frombuffer(w.as_buffer()), True
                add(np.frombuffer(x.as_buffer()).reshape(len(weights), -1), weights, total)
        if seen:
            yield batch_of({p: total[at : at + _PIECE] for p, at in enumerate(range(0, size, _PIECE))})

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _added(((p.as_py(), v.as_buffer()) for b in batches for p, v in zip(b.column("p"), b.column("v"), strict=True)))
        if sums:
            yield batch_of(sums)

    sums = blocks.mapInArrow(task, schema)
    if parts * size * 8 > DIRECT:
        sums = sums.repartition("p").mapInArrow(again, schema)
    out = np.zeros(size)
    for p, v in _added(((r["p"], r["v"]) for r in sums.collect())).items():
        out[p * _PIECE : p * _PIECE + len(v)] = v
    return out


def _round(blocks: DataFrame, models: dict[int, np.ndarray], parts: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """One scan: per model the weighted sums, counts and squared lengths of each centre's vectors, and the inertia."""
    where, C = _sizes(models), np.concatenate(list(models.values()))
    rows, dims = C.shape
    squares = (C * C).sum(1)

    def add(X: np.ndarray, w: np.ndarray, total: np.ndarray) -> None:
        own = np.zeros((len(X), rows))
        at, xx = np.arange(len(X)), (X * X).sum(1)
        d = squares - 2 * (X @ C.T)
        costs = total[rows * (dims + 2) :]
        for i, part in enumerate(where.values()):
            j = d[:, part].argmin(1) + part.start
            own[at, j] = w
            costs[i] += float((np.maximum(d[at, j] + xx, 0) * w).sum())
        per_centre = total[: rows * (dims + 2)].reshape(rows, dims + 2)
        per_centre[:, 0] += own.sum(0)
        per_centre[:, 1] += xx @ own
        per_centre[:, 2:] += own.T @ X

    got = _summed(blocks, rows * (dims + 2) + len(models), add, parts)
    table = got[: rows * (dims + 2)].reshape(rows, dims + 2)
    return {
        m: (table[part, 2:], table[part, 0], table[part, 1], float(got[rows * (dims + 2) + i]))
        for i, (m, part) in enumerate(where.items())
    }


def _distances(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    return np.maximum((X * X).sum(1)[:, None] + (C * C).sum(1) - 2 * (X @ C.T), 0.0)


def _drawn(blocks: DataFrame, chosen: list[np.ndarray], n: int, seed: int) -> list[np.ndarray]:
    """One scan: per restart ``n`` vectors drawn without replacement, weighted by weight x squared distance to the
    nearest chosen vector (by weight alone where none is chosen): the least of one exponential key a vector."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        kept: list[list[tuple[float, bytes]]] = [[] for _ in chosen]
        for batch in batches:
            for x, w in zip(batch.column("x"), batch.column("w"), strict=True):
                weights = np.frombuffer(w.as_buffer())
                X = np.frombuffer(x.as_buffer()).reshape(len(weights), -1)
                xx = (X * X).sum(1)
                for r, C in enumerate(chosen):
                    d = _distances(X, C).min(1) if len(C) else np.ones(len(X))
                    d = np.where(d > 1e-12 * xx, d, 0.0)  # what rounding leaves of a copy is 0
                    chance = weights * d
                    key = rng.exponential(size=len(X)) / np.where(chance > 0, chance, 1.0)
                    key[chance <= 0] = np.inf
                    least = np.argsort(key, kind="stable")[:n]
                    kept[r] = sorted(kept[r] + [(float(key[i]), X[i].tobytes()) for i in least if key[i] < np.inf])[:n]
        rows = [(r, key, x) for r, some in enumerate(kept) for key, x in some]
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.binary())], ["r", "key", "x"]
            )

    keyed = blocks.mapInArrow(task, "r int, key double, x binary")
    rank = F.row_number().over(W.partitionBy("r").orderBy("key", "x"))
    found = keyed.withColumn("_n", rank).where(F.col("_n") <= n).orderBy("r", "_n").collect()  # restarts x n rows
    return [np.array([np.frombuffer(row["x"]) for row in found if row["r"] == r]) for r in range(len(chosen))]


def parallel_starts(vectors: DataFrame, k: int, restarts: int, seed: int = 42, steps: int = 2,
                    features_col: str = "features", weight_col: str | None = None) -> list[np.ndarray]:
    """k-means|| over all rows for every restart at once: a random vector, then ``steps`` draws of 2k vectors by
    distance to those chosen, one scan each; the candidates, weighted by the rows nearest to them, are reduced to
    k by k-means++. Empty for no vectors."""
    blocks = packed(vectors, features_col, weight_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        chosen = _drawn(blocks, [np.zeros((0, 0))] * restarts, 1, seed)
        if not all(len(c) for c in chosen):
            return []
        for step in range(1, steps + 1):
            more = _drawn(blocks, chosen, 2 * k, seed + step)
            chosen = [np.vstack([c, m]) if len(m) else c for c, m in zip(chosen, more, strict=True)]

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros(len(C)) for C in chosen]
            for batch in batches:
                for x, w in zip(batch.column("x"), batch.column("w"), strict=True):
                    weights = np.frombuffer(w.as_buffer())
                    X = np.frombuffer(x.as_buffer()).reshape(len(weights), -1)
                    for C, t in zip(chosen, total, strict=True):
                        t += np.bincount(_distances(X, C).argmin(1), weights=weights, minlength=len(C))
            flat = np.concatenate(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["p", "v"])

        sums = blocks.mapInArrow(task, "p long, v double").groupBy("p").agg(F.sum("v").alias("v")).orderBy("p").collect()
    finally:
        blocks.unpersist()
    weights = np.split(np.array([row["v"] for row in sums]), np.cumsum([len(c) for c in chosen])[:-1])
    return [plus_plus(C, w, k, seed + r) for r, (C, w) in enumerate(zip(chosen, weights, strict=True))]


def fit_many(
    vectors: DataFrame,
    ks: Sequence[int],
    restarts: int,
    seed: int = 42,
    max_iter: int = 300,
    tol: float = 1e-4,
    features_col: str = "features",
    weight_col: str | None = None,
    init: dict[tuple[int, int], np.ndarray] | None = None,
) -> dict[tuple[int, int], tuple[np.ndarray, float, int]]:
    """Centres, inertia and rounds of every (k, restart). ``vectors`` should be persisted."""
    keys = [(k, r) for k in ks for r in range(restarts)]
    if init is None:
        X, w = seeding_rows(vectors, seed, features_col, weight_col)
        if not len(X):
            return {}
        init = {(k, r): plus_plus(X, w, k, seed + r) for k, r in keys}
    centres = {i: np.array(init[key], float) for i, key in enumerate(keys)}
    rounds = dict.fromkeys(centres, 0)
    moving = set(centres)
    blocks = packed(vectors, features_col, weight_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = blocks.rdd.getNumPartitions()
        for _ in range(max_iter):
            if not moving:
                break
            sums = _round(blocks, {m: centres[m] for m in sorted(moving)}, parts)
            for m, (s, n, _, _) in sums.items():
                moved = np.where(n[:, None] > 0, s / np.maximum(n, 1e-300)[:, None], centres[m])
                shift = np.sqrt(((moved - centres[m]) ** 2).sum(1)).max()
                centres[m], rounds[m] = moved, rounds[m] + 1
                if shift <= tol:
                    moving.discard(m)
        final = _round(blocks, centres, parts)
    finally:
        blocks.unpersist()
    return {key: (centres[i], final[i][3], rounds[i]) for i, key in enumerate(keys)}


def silhouettes(
    vectors: DataFrame, models: dict[int, np.ndarray], features_col: str = "features", weight_col: str | None = None
) -> dict[int, float]:
    """Squared Euclidean silhouette over all rows of every model's nearest-centre clusters, in two scans.

    The first sums each cluster, the second measures every vector against these sums: the definition of Spark's
    ``ClusteringEvaluator``, where a vector of weight w counts as w equal rows. 0 for fewer than two clusters.
    """
    if not models:
        return {}
    blocks = packed(vectors, features_col, weight_col)
    parts = blocks.rdd.getNumPartitions()
    where, C = _sizes(models), np.concatenate(list(models.values()))
    squares = (C * C).sum(1)
    sums = _round(blocks, models, parts)
    n = np.concatenate([sums[m][1] for m in models])
    size = np.maximum(n, 1e-300)
    means = np.concatenate([sums[m][0] for m in models]) / size[:, None]
    spread = np.concatenate([sums[m][2] for m in models]) / size

    def add(X: np.ndarray, w: np.ndarray, total: np.ndarray) -> None:
        at, xx = np.arange(len(X)), (X * X).sum(1)
        near = squares - 2 * (X @ C.T)
        mean = np.maximum(xx[:, None] + spread - 2 * (X @ means.T), 0.0)  # mean squared distance to each cluster
        for i, part in enumerate(where.values()):
            j = near[:, part].argmin(1)
            peers = n[part][j] - 1.0
            inner = np.divide(mean[:, part][at, j] * n[part][j], peers, out=np.zeros(len(X)), where=peers > 0)
            others = np.where(n[part] > 0, mean[:, part], np.inf)
            others[at, j] = np.inf
            outer = others.min(1)
            top = np.maximum(inner, outer)
            valid = (peers > 0) & np.isfinite(outer) & (top > 0)
            total[i] += float((np.divide(outer - inner, top, out=np.zeros(len(X)), where=valid) * w).sum())

    got = _summed(blocks, len(models), add, parts)
    return {m: float(got[i] / n[part].sum()) if n[part].sum() > 0 else 0.0 for i, (m, part) in enumerate(where.items())}


def nearest(features_col: str, centres: np.ndarray) -> Column:
    """Index of the nearest centre, JVM-side: squared distances to each centre, then the first smallest."""
    x = vector_to_array(features_col)
    dists = [
        F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
        for c in centres
    ]
    found = F.array(*dists)
    return (F.array_position(found, F.array_min(found)) - 1).cast("int")
