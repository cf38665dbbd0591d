"""Line de-duplication over overlapping three-line windows, in built-in functions only.

Lines are the parts of a text between line feeds; lines without a word take no part and stay. Every
three consecutive remaining lines form a window. A window that occurs more than once in the whole
table keeps its first occurrence, in order of (doc_id, text digest, line number), nulls first. The
lines of all later occurrences are marked, marks that overlap or touch merge into spans, and the
marked lines go. Every distinct line stays at least once: its earliest occurrence is never marked.

Defined results: null text stays null and has 0 lines; texts under three lines keep everything; rows
equal in doc_id and text are one document and share its fate; an empty table gives an empty result.
Extra columns pass through; ``text``, ``n_lines``, ``n_removed`` and ``spans`` replace columns of
those names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _digest(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(text))


def windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(k1, k2, doc_id, digest, first, second, third): 128-bit window key and its line numbers."""
    worded = F.transform(
        _lines(F.col("_text")),
        lambda line, at: F.struct(
            at.alias("at"),
            F.when(line.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(line)).alias("h"),
            F.xxhash64(F.lit(1), line).alias("g"),
        ),
    )
    lines = docs.select(
        F.col(doc_id).alias("doc_id"), _digest(doc_id, text).alias("digest"), F.col(text).alias("_text")
    ).select("doc_id", "digest", F.filter(worded, lambda x: x.h.isNotNull()).alias("w"))
    n = F.size("w")
    triples = F.arrays_zip(
        F.slice("w", F.lit(1), n - 2).alias("a"), F.slice("w", F.lit(2), n - 2).alias("b"), F.slice("w", F.lit(3), n - 2).alias("c")
    )
    z = lines.where(n >= WINDOW).select("doc_id", "digest", F.explode(triples).alias("z"))
    return z.select(
        F.xxhash64("z.a.h", "z.b.h", "z.c.h").alias("k1"),
        F.xxhash64("z.a.g", "z.b.g", "z.c.g").alias("k2"),
        "doc_id",
        "digest",
        F.col("z.a.at").alias("first"),
        F.col("z.b.at").alias("second"),
        F.col("z.c.at").alias("third"),
    )


def covered_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, covered): ascending line numbers of later occurrences, per document that has any."""
    found = windows(docs, doc_id, text)
    place = F.struct("doc_id", "digest", "first")
    repeated = (
        found.groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("kept"))
        .where("n > 1")
        .select("k1", "k2", "kept")
    )
    later = found.join(repeated, ["k1", "k2"]).where(~place.eqNullSafe(F.col("kept")))
    marked = later.select("doc_id", "digest", F.explode(F.array("first", "second", "third")).alias("at"))
    return marked.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set("at")).alias("covered"))


def merged_spans(numbers: Column) -> Column:
    """Ascending numbers as text of inclusive spans: 2-4,9-11."""
    start = F.filter(numbers, lambda x, i: (i == 0) | (F.get(numbers, i - 1) < x - 1))
    end = F.filter(numbers, lambda x, i: (i == F.size(numbers) - 1) | (F.get(numbers, i + 1) > x + 1))
    return F.array_join(F.zip_with(start, end, lambda a, b: F.concat(a.cast("string"), F.lit("-"), b.cast("string"))), ",")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with later occurrences cut from ``text``; adds n_lines, n_removed and spans."""
    covered = covered_lines(docs, doc_id, text).select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("covered").alias("_covered")
    )
    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_removed", "spans")]
    keyed = docs.select(*kept_columns).withColumn("_own", _digest(doc_id, text))
    joined = keyed.join(covered, F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest")), "left")
    cut = joined.withColumn("_lines", _lines(F.col(text)))
    numbers = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_covered"))
    rest = F.array_join(F.transform(numbers, lambda i: F.get("_lines", i)), "\n")
    return cut.select(
        *[F.when(F.col("_covered").isNull(), F.col(text)).otherwise(rest).alias(text) if c == text else c for c in kept_columns],
        F.when(F.col(text).isNull(), 0).otherwise(F.size("_lines")).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_covered"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(merged_spans(F.col("_covered")), F.lit("")).alias("spans"),
    )
