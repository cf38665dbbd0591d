"""Mixing sources to target weights by systematic sampling.

A source's target is its weight's share of the wished total, at most ``most_copies`` times its size;
what is cut off goes to the other sources by weight until none is above. A document of a source is
expected target / source size times. Expected copies are summed up along the source's documents,
large ones first, from one random offset per source; a document is taken once for each whole number
crossed. So it is taken the expected number of times rounded down or up, and since neighbours in the
order have like sizes, the words taken stay within about one document of the target.

Defined results: null or wordless texts have size 0 and are drawn like others; a null source is a
source, last in order; null ids are ordered by the text's digest. Repeated rows are documents of their
own; rows equal in id, source and text may swap their copies. Reruns agree. An empty table gives an
empty result. Extra columns pass through ``mix``; internal columns start with ``_mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialised
from .common import hex_fraction, n_words
from .rendezvous import numbered, order_key

WEIGHTS = (3.0, 1.0, 2.0)  # of sources in code point order, repeating
SHARE = 1.5  # wished total as a share of all words
MOST_COPIES = 2.0


def size_band(size: Column) -> Column:
    """Logarithmic band of a size: 64 bands each time the size doubles, in whole-number arithmetic."""
    digits = F.length(F.bin(size))
    width = F.greatest(digits - 7, F.lit(0))
    return (digits * 128 + F.floor(size / F.pow(F.lit(2.0), width))).cast("int")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most_copies: float) -> DataFrame:
    """``sizes(source, source_size)`` -> adds target: one row per source, so one task sorts them."""
    alike = F.lit(0)  # sources, not documents
    rank = F.row_number().over(W.partitionBy(alike).orderBy(F.asc_nulls_last("source")))
    weighted = sizes.withColumn("_rank", rank).withColumn(
        "_w", F.get(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights)).cast("int"))
    )
    cap = F.col("source_size") * F.lit(float(most_copies))
    first = W.partitionBy(alike).orderBy(cap / F.col("_w"), "_rank")
    everything = W.partitionBy(alike)
    filled = weighted.select(
        "*",
        cap.alias("_cap"),
        F.row_number().over(first).alias("_at"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("_total"),
        F.coalesce(F.sum(cap).over(first.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)).alias("_capped"),
        F.sum("_w").over(first.rowsBetween(0, W.unboundedFollowing)).alias("_open"),
    ).withColumn("_level", (F.col("_total") - F.col("_capped")) / F.col("_open"))
    # the first source in this order that its share does not fill sets the level of all after it
    own = F.when(F.col("_w") * F.col("_level") < F.col("_cap"), F.struct("_at", "_level"))
    level = F.min(own).over(everything)
    target = F.when(level.isNull() | (F.col("_at") < level["_at"]), F.col("_cap")).otherwise(F.col("_w") * level["_level"])
    return filled.select("source", "source_size", target.alias("target"))


def expected_copies(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most_copies: float = MOST_COPIES,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    tag: str = "mix",
) -> DataFrame:
    """One thin row per document: doc_id, order key, size, source, source_size, target, copies."""
    thin = materialised(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            n_words(F.col(text)).alias("size"),
            order_key(tag, F.col(doc_id), F.col(text)).alias("order_key"),
        )
        .withColumn("_band", size_band(F.col("size")))
        .withColumn("_cell", F.substring("order_key", 1, 2)),
        "mix",
    )
    sizes = thin.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most_copies)
    ranked = numbered(thin, ["source"], [("_band", "desc"), "_cell"], ["order_key", "doc_id"], "_at")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = hex_fraction(F.md5(F.concat(F.lit(f"{tag}|"), F.coalesce(F.col("source"), F.lit("null")))))
    joined = ranked.alias("l").join(targets.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
    copies = F.floor(rate * (F.col("_at") + 1) + offset) - F.floor(rate * F.col("_at") + offset)
    return joined.select("l.doc_id", "l.order_key", "l.size", "l.source", "r.source_size", "r.target", "l._at").withColumn(
        "copies", F.when(F.col("source_size") > 0, copies).otherwise(0).cast("bigint")
    ).drop("_at")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, all columns as they are."""
    drawn = expected_copies(docs, doc_id=doc_id, text=text, source=source, **options)

    def row_key(order: Column, of: str) -> Column:
        return F.concat(order, F.lit("|"), F.coalesce(F.col(of).cast("string"), F.lit("")))

    # rows alike in id, source and text have one key and share its copies evenly
    totals = drawn.groupBy(row_key(F.col("order_key"), "source").alias("_mix_key"), F.col("source").isNull().alias("_mix_null")).agg(
        F.sum("copies").alias("_mix_sum"), F.count(F.lit(1)).alias("_mix_n")
    )
    own_order = order_key(options.get("tag", "mix"), F.col(doc_id), F.col(text))
    keyed = docs.withColumn("_mix_key", row_key(own_order, source)).withColumn("_mix_null", F.col(source).isNull())
    met = keyed.join(totals, ["_mix_key", "_mix_null"])
    at = F.row_number().over(W.partitionBy("_mix_key", "_mix_null").orderBy(F.lit(0)))
    ranked = met.select(*docs.columns, "_mix_sum", "_mix_n", at.alias("_mix_at"))
    upto = F.col("_mix_sum") * F.col("_mix_at")
    own = F.floor(upto / F.col("_mix_n")) - F.floor((upto - F.col("_mix_sum")) / F.col("_mix_n"))
    counted = ranked.select(*docs.columns, own.cast("int").alias("_mix_out")).where("_mix_out > 0")
    return counted.withColumn("_mix_out", F.explode(F.array_repeat(F.lit(0), F.col("_mix_out")))).drop("_mix_out")
