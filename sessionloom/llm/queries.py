"""The corpus operators as named queries over the driver tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat_rotation, divergence, golay_simhash, hmm_lm, language_id, lattice_dedup, line_dedup, merkle, mixing
from . import quality_rules
from . import rendezvous, token_prefix
from .common import table

SHARDS = 40
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TOKEN_LIMIT = 2048


def byte_vocabulary() -> dict[str, str]:
    """Path and split pattern of the byte-level vocabulary."""
    return {"path": public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def op1_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return lattice_dedup.lattice_components(vectors, lattice_dedup.common_length(vectors))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.with_language(docs, language_id.learned(docs))
    return found.select(
        "doc_id",
        language_id.is_held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


def op3_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = rendezvous.shard_records(table(spark, sf_dir, "documents"), [1.0] * SHARDS, 1.0)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", "spans", "text")


def op5_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_rotation.perspectives(table(spark, sf_dir, "conversations"))


def op6_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_token_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    counted = token_prefix.with_prefix_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    n = token_prefix.total_tokens("prefix_counts")
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        n.alias("n_tokens"),
        (n > TOKEN_LIMIT).alias("over_limit"),
    )


def op8_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.expected_copies(table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.round_trip(docs, **byte_vocabulary())
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op10_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay_simhash.simhash_components(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # rows whose unsigned crc32 of the decimal doc_id is a multiple of 3 get A-Z lower-cased (nulls stay)
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(chosen, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))
    fields = [merkle.field(c) for c in ("doc_id", "source", "lang", "n_chars")] + [merkle.field(text)]
    built = merkle.manifest(docs, carry={"tampered": merkle.digest(*fields)})
    folded = merkle.fold(F.col("tampered"), F.col("path"))
    return built.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", folded.alias("folded_root"), (folded == F.col("root")).alias("verified")
    )


def op12_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.scored(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_lattice_dedup,
        op2_language_id,
        op3_rendezvous_shards,
        op4_line_dedup,
        op5_chat_rotation,
        op6_adaptive_quality,
        op7_token_prefixes,
        op8_systematic_mix,
        op9_byte_bpe,
        op10_golay_simhash,
        op11_merkle_manifest,
        op12_hmm_scores,
        op13_source_divergence,
        pipeline,
    )
    return {f.__name__: f for f in ops}
