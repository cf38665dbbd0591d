"""Comparing rows that share a bucket, and joining the links found into components.

Buckets of any size are cut into blocks and compared block by block, each pair of blocks being a
group of its own with a bounded number of rows. Inside a task, pairs live only in bounded chunks of
arrays; what leaves is a spanning forest (at most one row per compared row), never the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialised

# Rows of one side in a block, and pairs held at once by a task.
BLOCK = 512
CHUNK_PAIRS = 1_000_000


def shared_buckets(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of the buckets that can hold a link, with block numbers.

    ``rows``: ``bucket``, ``indexed`` (boolean), ``node``. A bucket counts if it holds an indexed and
    a probing row of two nodes. An indexed row meets every probing row of its bucket in exactly one
    group (``bucket``, ``bi``, ``bj``).
    """
    sizes = (
        rows.groupBy("bucket")
        .agg(
            F.count_if("indexed").alias("_index"),
            F.count_if(~F.col("indexed")).alias("_probe"),
            F.min("node").alias("_low"),
            F.max("node").alias("_high"),
        )
        .where("_index > 0 AND _probe > 0 AND _low <> _high")
        .select("bucket", *[F.ceil(F.col(c) / block).cast("int").alias(c) for c in ("_index", "_probe")])
    )
    met = rows.join(sizes, "bucket")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = [c for c in rows.columns]
    index = met.where("indexed").select(*kept, own("_index").alias("bi"), others("_probe").alias("bj"))
    probe = met.where("NOT indexed").select(*kept, others("_index").alias("bi"), own("_probe").alias("bj"))
    return index.unionByName(probe)


def in_groups(blocked: DataFrame) -> DataFrame:
    """Deal groups out and lay their rows side by side, indexed rows first."""
    keys = ["bucket", "bi", "bj"]
    return blocked.repartition(*keys).sortWithinPartitions(*keys, F.desc("indexed"))


def whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut sorted batches at group borders; a group is bounded, so what is carried over is too."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[["bucket", "bi", "bj"]].to_numpy()
        same = (keys == keys[-1]).all(axis=1)
        first = len(batch) - int(np.argmin(same[::-1])) if not same.all() else 0
        if first:
            yield pd.concat([*held, batch.iloc[:first]], ignore_index=True)
            held = [batch.iloc[first:]]
        elif held and not (held[-1][["bucket", "bi", "bj"]].to_numpy()[-1] == keys[0]).all():
            yield pd.concat(held, ignore_index=True)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def pair_chunks(rows: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (indexed, probing) of all pairs inside each group of ``rows``, in bounded chunks."""
    keys = rows[["bucket", "bi", "bj"]].to_numpy()
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    n_index = np.add.reduceat(rows["indexed"].to_numpy().astype(np.int64), starts)
    n_all = np.diff(np.r_[starts, len(rows)])
    n_probe = n_all - n_index
    pairs = n_index * n_probe
    bounds = np.r_[0, np.cumsum(pairs)]
    for low in range(0, int(bounds[-1]), CHUNK_PAIRS):
        k = np.arange(low, min(low + CHUNK_PAIRS, int(bounds[-1])))
        g = np.searchsorted(bounds, k, "right") - 1
        k = k - bounds[g]
        yield starts[g] + k // n_probe[g], starts[g] + n_index[g] + k % n_probe[g]


def forest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Label of each of ``size`` positions: the smallest position its links (a, b) lead to."""
    label = np.arange(size)
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            break
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def links_in_groups(blocked: DataFrame, verify: Callable, node_type: str) -> DataFrame:
    """(a, b) edges of spanning forests over the pairs of nodes that ``verify(rows, i, j)`` accepts."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches):
            node = rows["node"].to_numpy()
            code, names = pd.factorize(node)
            label = np.arange(len(names))
            for i, j in pair_chunks(rows):
                good = verify(rows, i, j) & (code[i] != code[j])
                joined = forest(label[code[i[good]]], label[code[j[good]]], len(names))
                label = joined[label]
            moved = np.flatnonzero(label != np.arange(len(names)))
            yield pd.DataFrame({"a": names[moved], "b": names[label[moved]]})

    return in_groups(blocked).mapInPandas(task, f"a {node_type}, b {node_type}")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (a, b); root is the smallest node of its component.

    Alternating large-star and small-star steps; each round is a table in the shared folder. Minima
    are combined before the shuffle and joined back, so a node with very many edges is no group.
    """
    u, v, m = F.col("u"), F.col("v"), F.col("m")
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = materialised(now, "edges")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == seen:
            return now.select(u.alias("node"), v.alias("root"))
        seen = mark
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least(u, m).alias("m"))
        large = both.where(v > u).join(low, "u").select(v.alias("u"), m.alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(low, "u")
        small = met.where(v != m).select(v.alias("u"), m.alias("v")).unionByName(low.select("u", m.alias("v")))
        now = materialised(small.distinct(), "edges")
