"""Exact global ranks and running sums without a single-task sort.

A rank over the whole table is the number of rows in earlier hash-prefix groups plus
the position inside the row's own group. Prefix totals are a fixed-size table
(at most 65,536 rows per ``by`` group), so they may be broadcast; rows only move to
their own, evenly filled prefix group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numeric import interval_index
from ..functions.sampling import hash_key, hash_prefix


def rank_by_hash(
    df: DataFrame,
    key: str,
    ties: Sequence[str] = (),
    by: Sequence[str] = (),
    first: int | Column | None = None,
    rank: str = "rank",
) -> DataFrame:
    """Number rows 1..n (per ``by`` group) in order of the hash column ``key``, then ``ties``.

    ``first`` keeps the n lowest ranks only; groups beyond them are dropped before the
    shuffle. ``by`` must have a fixed, small set of values (such as a 0/1 label).
    """
    prefixed = df.withColumn("_prefix", hash_prefix(key))
    totals = prefixed.groupBy(*by, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    running = W.partitionBy(*by).orderBy("_prefix").rowsBetween(W.unboundedPreceding, 0)
    offsets = totals.select(*by, "_prefix", (F.sum("_n").over(running) - F.col("_n")).alias("_before"))
    limit = None if first is None else (first if isinstance(first, Column) else F.lit(int(first)))
    if limit is not None:
        offsets = offsets.where(F.col("_before") < limit)
    inside = W.partitionBy(*by, "_prefix").orderBy(key, *ties)
    ranked = prefixed.join(F.broadcast(offsets), [*by, "_prefix"]).withColumn(
        rank, F.col("_before") + F.row_number().over(inside)
    )
    if limit is not None:
        ranked = ranked.where(F.col(rank) <= limit)
    return ranked.select(*df.columns, rank)


def sample_rows(df: DataFrame, n: int, id_col: str, seed: int | str = 42, tag: str = "sample") -> DataFrame:
    """Exactly min(n, N) rows in seeded hash order of ``id_col``; the same rows on every run."""
    keyed = df.withColumn("_key", hash_key(tag, seed, F.col(id_col)))
    return rank_by_hash(keyed, "_key", [id_col], first=n, rank="_rank").select(*df.columns)


def range_splits(df: DataFrame, col: str, pieces: int = 64) -> list[float]:
    """Distinct approximate quantiles of ``col``: fixed once, so every branch of a plan agrees."""
    probabilities = [i / pieces for i in range(1, pieces)]
    if not probabilities:
        return []
    return sorted(set(df.approxQuantile(col, probabilities, 0.25 / pieces)))


def running_sums(df: DataFrame, order_col: str, sums: dict[str, str], splits: list[float]) -> DataFrame:
    """Add descending running sums (rows with a larger or equal ``order_col``) of several columns.

    ``order_col`` must be unique per row. Rows are cut into ranges at ``splits``; range
    totals (one row per range) carry the sum of all higher ranges into each range.
    """
    ranged = df.withColumn("_range", interval_index(F.col(order_col), splits))
    if not splits:
        whole = W.partitionBy("_range").orderBy(F.desc(order_col)).rowsBetween(W.unboundedPreceding, 0)
        return ranged.withColumns({new: F.sum(old).over(whole) for new, old in sums.items()}).drop("_range")
    above = W.partitionBy(F.lit(1)).orderBy(F.desc("_range")).rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(*[F.sum(old).alias(f"_t_{new}") for new, old in sums.items()])
    carried = totals.select(
        "_range", *[F.coalesce(F.sum(f"_t_{new}").over(above), F.lit(0)).alias(f"_above_{new}") for new in sums]
    )
    inside = W.partitionBy("_range").orderBy(F.desc(order_col)).rowsBetween(W.unboundedPreceding, 0)
    joined = ranged.join(F.broadcast(carried), "_range")
    added = joined.withColumns({new: F.col(f"_above_{new}") + F.sum(old).over(inside) for new, old in sums.items()})
    return added.select(*df.columns, *sums)
