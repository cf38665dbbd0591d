"""Sharding by weighted rendezvous hashing, in built-in functions only.

Every (key, shard) pair has a hash u in (0, 1); a record goes to the shard with the smallest
-ln(u) / weight. A shard's share follows its weight, nothing but the key and the shards decides, and
a new shard only takes records: all other comparisons stay as they were.

Defined results: a null key is a key of its own, all such rows share a shard; null text has size 16
and the checksum of the empty text. Slots number a shard's rows from 0 without gaps in order of a
digest of id and text, then id, then size; rows equal in all three may swap places, which shows in no
column. An empty table gives an empty result. Extra columns are not touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialised
from .common import hex_fraction

ROW_BYTES = 16  # fixed cost of a record beside its text


def shard_costs(key: Column, weights: Sequence[float]) -> Column:
    """Array of (cost, shard) structs, one for each shard."""
    return F.transform(
        F.array(*[F.lit(float(w)) for w in weights]),
        lambda weight, shard: F.struct(
            (-F.ln(hex_fraction(F.md5(F.concat(key, F.lit(":"), shard.cast("string"))))) / weight).alias("cost"),
            shard.alias("shard"),
        ),
    )


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard number of a key (string column; null is the key 'null')."""
    return F.array_min(shard_costs(F.coalesce(key.cast("string"), F.lit("null")), weights)).shard


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint")


def order_key(tag: str, doc_id: Column, text: Column) -> Column:
    """Digest that puts rows in an even, repeatable order, also where ids are null or repeated."""
    part = lambda c: F.coalesce(c, F.lit("null"))
    return F.md5(F.concat(F.lit(tag + "|"), part(doc_id.cast("string")), F.lit("|"), part(F.md5(text))))


def numbered(df: DataFrame, group: Sequence[str], cell: Sequence[str], order: Sequence, out: str) -> DataFrame:
    """Number the rows of each group from 0 in order of (``cell``, ``order``) without a task per group.

    ``cell`` columns cut a group into small pieces: a row's number is the count of rows in earlier
    cells of its group plus its place in its own cell. ``cell`` holds columns or (column, 'desc').
    """
    names = [c if isinstance(c, str) else c[0] for c in cell]
    cell_order = [F.col(c) if isinstance(c, str) else F.desc(c[0]) for c in cell]
    counts = df.groupBy(*group, *names).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy(*cell_order).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*group, *names, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*group, *names).orderBy(*order)
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*group, *names)]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    placed = df.alias("l").join(offsets.alias("r"), condition).select("l.*", "r._before")
    return placed.withColumn(out, (F.col("_before") + F.row_number().over(inside) - 1).cast("bigint")).drop("_before")


def shard_records(docs: DataFrame, weights: Sequence[float], new_weight: float, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per record: doc_id, size, text_crc32, shard, slot, grown_shard (with one more shard)."""
    n, body = len(weights), F.col(text).cast("string")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))  # of the row selected below
    thin = docs.select(
        F.col(doc_id).alias("doc_id"),
        record_size(body).alias("size"),
        F.crc32(F.coalesce(body, F.lit(""))).alias("text_crc32"),
        order_key("slot", F.col(doc_id), body).alias("_order"),
    ).withColumn("_costs", shard_costs(key, [*weights, new_weight]))
    placed = thin.select(
        "doc_id",
        "size",
        "text_crc32",
        "_order",
        F.substring("_order", 1, 2).alias("_cell"),
        F.array_min(F.slice("_costs", 1, n)).shard.alias("shard"),
        F.array_min("_costs").shard.alias("grown_shard"),
    )
    stored = materialised(placed, "shards")
    slotted = numbered(stored, ["shard"], ["_cell"], ["_order", "doc_id", "size"], "slot")
    return slotted.select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")
