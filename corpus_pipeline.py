"""Corpus preparation: five stages over ``documents``, each a Spark job of its own.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame; ``run`` writes each result as Parquet to the shared folder and reads it back. All stages but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm import byte_bpe, golay_simhash, language_id, line_dedup, mixing
from sessionloom.llm.common import prepared, table
from sessionloom.llm.queries import byte_vocabulary
from sessionloom.session import materialised

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give each document its predicted language; documents that no language fits go."""
    prepared(spark)
    found = language_id.with_language(docs, language_id.learned(docs))
    return found.where("NOT rejected").withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated three-line passages; documents stay, with what is left of their text."""
    prepared(spark)
    cut = line_dedup.dedup_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group: op10's three-word shingles, fingerprints within 3 bits."""
    prepared(spark)
    return golay_simhash.one_per_group(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their target weights."""
    prepared(spark)
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them: a text that came back changed stops the job."""
    prepared(spark)
    coded = byte_bpe.round_trip(docs, **byte_vocabulary())
    same = F.col("decoded") == F.coalesce(F.encode("text", "utf-8"), F.lit(b""))
    n_tokens = F.when(F.assert_true(same, "decoded text differs").isNull(), F.col("n_tokens"))
    return coded.select("doc_id", "lang", "source", n_tokens.alias("n_tokens"), F.col("ids"))


STAGES = [
    ("language_id", known_language),
    ("line_dedup", distinct_lines),
    ("simhash_dedup", distinct_documents),
    ("source_mix", mixed_sources),
    ("byte_bpe", encoded),
]

# Language models, fuzzy keys and merges have no SQL form: tests/llm/test_pipeline.py recomputes run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back; one row per document of the mix."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), name)
    return docs.select("doc_id", "lang", "source", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"))
