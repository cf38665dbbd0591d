"""Source divergence audit: how far each source's term frequencies stand from its language's and its peers'.

Tokenizer. Each text is encoded as UTF-8 and passed once through a 256-byte translate table that lower-cases
A-Z and turns every other ASCII byte that is not a-z into a blank; ``bytes.split`` then yields the terms (runs
of a-z and of non-ASCII characters, so multi-byte characters stay whole) and a ``Counter`` per document gives
term frequencies. Only these sparse (document, term, count) rows leave the Python worker; everything after is
Spark aggregation and joins in exact integer arithmetic.

Model. A language keeps the ``V`` terms found in at least ``MIN_DOCS`` of its documents. For a group (one
(lang, source), or the whole language) and a kept term of count ``c``:
``p = 1 + floor(SCALE * (c + 2) / (N + 2 * V))``, ``N`` the group's total over kept terms. Two groups differ
in a term by ``f = floor((p - q)^2 / (p + q))``.

Output parts per (lang, source): ``pair`` - every other source of the language, value the sum of f over all
kept terms (0 when V = 0), all ranks; ``term`` - the kept terms the source uses (c > 0) more than its
language does (p > q), value f, the ``TOP_TERMS`` first. Rank from 1 by value descending, then item by UTF-8
bytes ascending.

Sparse pair sums. For sources s, s' the sum runs over the terms either uses; terms neither uses share one value
f(p0_s, p0_s') (p0: p at c = 0) and are counted, not listed. Each kept term is one row holding the sources
that use it; each of them meets every other source of the language inside the task, and hash aggregation
sums per (lang, source, other) before the shuffle, so what moves is a few rows per pair and task. Work is
(sources of the language) x (terms a source uses), never (sources)^2 x V.

Defined results: null lang, source and text read as ''; a group whose documents have no kept term still has
its pair rows (value from p0 alone, 0 if V = 0) and no term rows; a language of one source has no pair rows;
repeated rows count as many times as they stand; an empty table gives no rows. Only lang, source and text
are read, so other columns never clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialised

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
# distinct (lang, source, term) entries a task holds before it hands them on
FLUSH = 500_000
# salt of the top-k: a hot source's terms are ranked in this many pieces first
PIECES = 32

# Bytes that end a term: ASCII outside a-z and A-Z (fixed value: 0x00-0x40, 0x5B-0x60, 0x7B-0x7F).
_BLANKED = [*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
TABLE = bytes(0x20 if b in _BLANKED else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def document_terms(text: str) -> Counter:
    """Term frequencies of one text, by one translate and one split."""
    return Counter(text.encode("utf-8", "surrogatepass").translate(TABLE).split())


def term_rows(docs: DataFrame, flush: int = FLUSH) -> DataFrame:
    """``docs(lang, source, text)`` (no nulls) -> per (lang, source, term): c (occurrences) and docs (documents
    holding it), summed in the worker over the documents of a task until ``flush`` entries are held."""

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs_) in held.items():  # one batch a group, its columns filled by C loops
            terms = list(counts)
            columns = [
                pa.repeat(pa.scalar(lang, pa.string()), len(terms)),
                pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(list(counts.values()), pa.int64()),
                pa.array(list(map(docs_.__getitem__, terms)), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "c", "docs"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, source, text in zip(langs, sources, texts, strict=True):
                terms = text.translate(TABLE).split()
                if not terms:
                    continue
                counts, docs_ = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(counts)
                counts.update(terms)
                docs_.update(set(terms))
                size += len(counts) - before
            if size > flush:
                yield from rows(held)
                held, size = {}, 0
        yield from rows(held)

    return docs.mapInArrow(task, "lang string, source string, term string, c long, docs long")


def _p(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact in 38-digit integers; null when V = 0."""
    den = f"(CAST({total} AS DECIMAL(38, 0)) + 2 * {kept})"
    return F.expr(f"CASE WHEN {den} > 0 THEN 1 + ({SCALE}BD * ({count} + 2)) div {den} END").cast("long")


def _f(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)) in longs: p and q are at most SCALE + 1, so the square fits."""
    return F.expr(f"CASE WHEN {p} + {q} > 0 THEN (({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q})) END")


def _ranked(rows: DataFrame, top: int | None) -> DataFrame:
    order = [F.col("value").desc(), F.col("item").asc()]
    if top is not None:  # spread a hot group over pieces, keep each piece's first ``top``, then rank the few left
        piece = F.abs(F.xxhash64("item")) % PIECES
        rows = rows.withColumn("_p", piece).withColumn(
            "_r", F.row_number().over(Window.partitionBy("lang", "source", "_p").orderBy(*order))
        )
        rows = rows.where(F.col("_r") <= top).drop("_p", "_r")
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    return rows if top is None else rows.where(F.col("rank") <= top)


def source_divergence(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS
) -> DataFrame:
    """Rows lang, source, part ('pair' or 'term'), item, value long, rank int (see the module)."""
    plain = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    groups = materialised(plain.select("lang", "source").distinct(), "divergence-groups")
    counted = materialised(
        term_rows(plain).groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("docs").alias("docs")),
        "divergence-counts",
    )
    in_lang = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("c").alias("c"))
    kept = materialised(in_lang.where(F.col("docs") >= min_docs).select("lang", "term", "c"), "divergence-kept")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("V"), F.sum("c").alias("NL"))
    used = counted.join(kept.select("lang", "term"), ["lang", "term"], "left_semi").select("lang", "source", "term", "c")
    totals = used.groupBy("lang", "source").agg(F.sum("c").alias("N"))
    group = (
        groups.join(totals, ["lang", "source"], "left")
        .join(sizes.select("lang", "V"), "lang", "left")
        .select("lang", "source", F.coalesce("N", F.lit(0)).alias("N"), F.coalesce("V", F.lit(0)).alias("V"))
    )
    group = materialised(group.withColumn("p0", _p("0", "N", "V")), "divergence-group")
    scored = materialised(
        used.join(group, ["lang", "source"]).select("lang", "source", "term", "c", _p("c", "N", "V").alias("p")),
        "divergence-scored",
    )

    # pair: one row per (lang, term) holding the sources that use it; each such source meets every other source
    # of the language in memory, and only partial sums per (source, other) leave the task
    everyone = group.groupBy("lang").agg(F.collect_list(F.struct(F.col("source").alias("o"), F.col("p0").alias("q0"))).alias("all"))
    users = scored.groupBy("lang", "term").agg(F.map_from_entries(F.collect_list(F.struct("source", "p"))).alias("use"))
    met = users.join(everyone, "lang").select("lang", "use", "all", F.explode(F.map_keys("use")).alias("source"))
    met = met.select("lang", "source", F.element_at("use", F.col("source")).alias("p"), "use", F.explode("all").alias("b"))
    met = met.where(F.col("b.o") != F.col("source")).select(
        "lang", "source", F.col("b.o").alias("other"), "p", F.col("b.q0").alias("q0"), F.try_element_at("use", F.col("b.o")).alias("q")
    )
    met = met.withColumn("f", _f("p", "coalesce(q, q0)"))
    # a term the other source lacks also counts, with the same f, for the pair seen from that source: its sums
    # are taken apart here and added to the mirrored pair afterwards, when a pair is one row
    lacked = F.col("q").isNull()
    seen = met.groupBy("lang", "source", "other").agg(
        F.sum("f").alias("f1"), F.count(F.lit(1)).alias("n1"),
        F.sum(F.when(lacked, F.col("f"))).alias("f2"), F.count_if(lacked).alias("n2"),
    )
    side = F.struct("source", "other", F.col("f1").alias("f"), F.col("n1").alias("n"))
    mirror = F.struct(F.col("other").alias("source"), F.col("source").alias("other"), F.col("f2").alias("f"), F.col("n2").alias("n"))
    summed = (
        seen.select("lang", F.explode(F.array(side, mirror)).alias("x"))
        .groupBy("lang", "x.source", "x.other")
        .agg(F.sum("x.f").alias("f1"), F.sum("x.n").alias("n1"))
    )
    others = group.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    pairs = group.join(others, "lang").where(F.col("source") != F.col("other"))
    pairs = pairs.join(summed, ["lang", "source", "other"], "left")
    rest = F.col("V") - F.coalesce("n1", F.lit(0))
    value = F.coalesce("f1", F.lit(0)) + rest * F.coalesce(_f("p0", "q0"), F.lit(0))
    pair_rows = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), value.cast("long").alias("value"))

    # term: terms a source uses more than its language
    whole = kept.join(sizes, "lang").select("lang", "term", _p("c", "NL", "V").alias("q"))
    above = scored.join(whole, ["lang", "term"]).where(F.col("p") > F.col("q"))
    term_rows_ = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f("p", "q").alias("value"))

    out = _ranked(pair_rows, None).unionByName(_ranked(term_rows_, TOP_TERMS))
    return out.select("lang", "source", "part", "item", F.col("value").cast("long"), F.col("rank").cast("int"))
