"""Quality rules whose thresholds come from mergeable quantile sketches per language and source.

Rates of each text (per 10,000): characters per word, symbols per word character, lines that repeat
an earlier line, and words inside repeated three-word windows. A sketch is a histogram over
logarithmic bands in whole numbers (64 bands each time a value doubles, so quantiles are within 1.6 %
of the true value); counts of parts add up to the counts of the whole, whatever the partitioning.

Each (language, source) has its own sketch, mixed with ``PRIOR`` documents' worth of its language's
sketch, so that a group of few documents leans on its language and a large one on itself. A text
fails a rule when its rate lies above  q75 + FENCE * (q75 - q50) + slack, or, for characters per
word, also below the mirrored fence: outliers of their own group fail, not a fixed share of it.
A text is kept if it does not fail the fixed base rules nor any adaptive one.

Defined results: null or wordless texts have 0 words and fail the base rules; null language or source
is a group of its own; repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialised

LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words
PRIOR = 200.0
FENCE = 6.0
# rule: (rate, slack above, slack below or None), rates per 10,000
RULES = {
    "word_length": (25_000, 25_000),
    "symbols": (300, None),
    "dup_lines": (5_000, None),
    "repeats": (4_500, None),
}

BASE = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
SYMBOLS = b"#*$%&|<>"  # fixed value


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pair = np.unique(code[:-1] * len(ids) + code[1:], return_inverse=True)[1]
    triple = pair[:-1] * len(ids) + code[2:]
    _, of, number = np.unique(triple, return_inverse=True, return_counts=True)
    again = number[of] > 1
    hit = np.zeros(len(words), bool)
    for shift in range(3):
        hit[shift : shift + n] |= again
    return int(hit.sum())


def text_base(text: str) -> tuple[int, ...]:
    """Base figures of one whole text, in the order of ``BASE``."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.split(None, 1)]
    return (
        len(words),
        # bytes that do not continue a code point
        sum(map(len, words)) - _continued(data),
        sum(map(data.count, (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))))),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def _continued(data: bytes) -> int:
    return 0 if data.isascii() else int(((np.frombuffer(data, np.uint8) & 0xC0) == 0x80).sum())


def base_figures(text: Column) -> Column:
    """Struct of the base figures of a text."""

    def each(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_base(t) for t in texts], columns=[c.split()[0] for c in BASE.split(", ")], dtype="int64")

    return F.pandas_udf(each, BASE)(F.coalesce(text.cast("string"), F.lit("")))


def rates() -> dict[str, Column]:
    """Whole-number rates per 10,000 from the base columns; 0 where nothing is counted."""

    def per(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.floor(F.col(part) * 10_000 / F.col(whole))).otherwise(0).cast("bigint")

    return {
        "word_length": per("word_chars", "n_words"),
        "symbols": per("n_symbols", "word_chars"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"),
    }


def band(value: Column) -> Column:
    """Sketch band of a whole number: exact below 128, then 64 bands each time it doubles."""
    width = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return (width * 128 + F.floor(value / F.pow(F.lit(2.0), width))).cast("int")


def band_value(b: Column) -> Column:
    """Lower bound of a band."""
    return ((b % 128) * F.pow(F.lit(2.0), F.floor(b / 128))).cast("double")


def sketches(figures: DataFrame) -> DataFrame:
    """(lang, source, rule, band, n): mergeable sketch of every group."""
    named = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), band(F.col(r)).alias("band")) for r in RULES]))
    counted = figures.where("n_words > 0").select("lang", "source", named.alias("x"))
    return counted.groupBy("lang", "source", "x.rule", "x.band").agg(F.count(F.lit(1)).alias("n"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, <rule>_high, word_length_low) of every group."""
    # null languages and sources are values here: joins and windows then need no special case
    own = sketch.select(
        F.struct(F.col("lang").isNull().alias("x"), F.coalesce("lang", F.lit("")).alias("v")).alias("lang"),
        F.struct(F.col("source").isNull().alias("x"), F.coalesce("source", F.lit("")).alias("v")).alias("source"),
        "rule",
        "band",
        F.col("n").cast("double").alias("n"),
    )
    of_language = own.groupBy("lang", "rule", "band").agg(F.sum("n").alias("n"))
    total = W.partitionBy("lang", "rule")
    prior = of_language.select("lang", "rule", "band", (F.lit(PRIOR) * F.col("n") / F.sum("n").over(total)).alias("n"))
    spread = own.select("lang", "source").distinct().join(prior, "lang").select("lang", "source", "rule", "band", "n")
    mixed = own.unionByName(spread).groupBy("lang", "source", "rule", "band").agg(F.sum("n").alias("n"))
    group = W.partitionBy("lang", "source", "rule")
    running = group.orderBy("band").rowsBetween(W.unboundedPreceding, 0)
    seen = mixed.withColumn("_share", F.sum("n").over(running) / F.sum("n").over(group))
    at = lambda q: F.min(F.when(F.col("_share") >= q, F.col("band")))
    quantiles = seen.groupBy("lang", "source", "rule").agg(*[band_value(at(q / 100)).alias(f"q{q}") for q in (25, 50, 75)])
    fence = []
    for rule, (above, below) in RULES.items():
        high = F.col("q75") + F.lit(FENCE) * (F.col("q75") - F.col("q50")) + F.lit(float(above))
        fence.append(F.max(F.when(F.col("rule") == rule, high)).alias(f"{rule}_high"))
        if below is not None:
            low = F.col("q25") - F.lit(FENCE) * (F.col("q50") - F.col("q25")) - F.lit(float(below))
            fence.append(F.max(F.when(F.col("rule") == rule, low)).alias(f"{rule}_low"))
    found = quantiles.groupBy("lang", "source").agg(*fence)
    back = lambda c: F.when(~F.col(f"{c}.x"), F.col(f"{c}.v")).alias(c)
    return found.select(back("lang"), back("source"), *[c for c in found.columns if c not in ("lang", "source")])


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: doc_id, lang, source, base figures, base_failed, failed (array of rules), kept."""
    thin = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(lang).cast("string").alias("lang"),
        F.col(source).cast("string").alias("source"),
        base_figures(F.col(text)).alias("_base"),
    ).select("doc_id", "lang", "source", "_base.*")
    figures = materialised(thin.withColumns(rates()), "quality")
    fences = thresholds(sketches(figures))
    same = F.col("l.lang").eqNullSafe(F.col("r.lang")) & F.col("l.source").eqNullSafe(F.col("r.source"))
    joined = figures.alias("l").join(fences.alias("r"), same, "left")
    broken = []
    for rule, (_, below) in RULES.items():
        out = F.col(rule) > F.col(f"{rule}_high")
        if below is not None:
            out = out | (F.col(rule) < F.col(f"{rule}_low"))
        broken.append(F.when(out, F.lit(rule)))
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    verdict = joined.withColumn("failed", F.array_compact(F.array(*broken))).withColumn("base_failed", base_failed)
    return verdict.select(
        "doc_id",
        "l.lang",
        "l.source",
        *[c.split()[0] for c in BASE.split(", ")],
        "base_failed",
        "failed",
        (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"),
    )
