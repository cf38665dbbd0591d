"""Table contract checks: violation counts per rule from one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DEVICE_CODES


def _stack(one_row: DataFrame, rules: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("violations")) for r in rules])
    return one_row.select(F.explode(pairs).alias("r")).select("r.*")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Number of surplus rows of a key (count is pre-aggregated per key)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))


def session_quality(sessions: DataFrame) -> DataFrame:
    """(rule, violations) for the sessions contract; 0 everywhere means the table is sound."""
    types = dict(sessions.dtypes)
    hours = F.col("active_hours_profile")
    categories = F.col("content_categories")
    if types["active_hours_profile"] == "string":
        hours = F.from_json(hours, "array<double>")
    if types["content_categories"] == "string":
        categories = F.from_json(categories, "array<string>")
    total = F.aggregate(hours, F.lit(0.0), lambda acc, x: acc + x)
    checks = {
        "session_id_null": F.col("session_id").isNull(),
        "user_id_hash_null": F.col("user_id_hash").isNull(),
        "device_type_null": F.col("device_type").isNull(),
        "device_type_unknown": ~F.col("device_type").isin(list(DEVICE_CODES)),
        "scroll_out_of_range": ~F.col("scroll_depth_avg").between(0.0, 1.0),
        "categories_invalid": categories.isNull() | (F.size(categories) < 1),
        "hours_not_24": hours.isNull() | (F.size(hours) != 24),
        "hours_not_normalised": F.abs(total - F.lit(1.0)) >= F.lit(1e-6),
    }
    counted = sessions.agg(*[F.count_if(c).alias(name) for name, c in checks.items()])
    unique = counted.withColumn("session_id_duplicate", duplicate_keys(sessions, "session_id").scalar())
    return _stack(unique, [*checks, "session_id_duplicate"])


def pair_quality(pairs: DataFrame) -> DataFrame:
    """(rule, violations) for the identity_pairs contract."""
    checks = {
        "ends_null": F.col("session_id_a").isNull() | F.col("session_id_b").isNull(),
        "label_invalid": F.col("label").isNull() | ~F.col("label").isin(0, 1),
        "probability_out_of_range": ~F.col("probability").between(0.0, 1.0),
        "split_unknown": ~F.col("split").isin("train", "test"),
    }
    counted = pairs.agg(*[F.count_if(c).alias(name) for name, c in checks.items()])
    unique = counted.withColumn("pair_id_duplicate", duplicate_keys(pairs, "pair_id").scalar())
    return _stack(unique, [*checks, "pair_id_duplicate"])


def segment_quality(segments: DataFrame) -> DataFrame:
    """(rule, violations) for the audience_segments contract."""
    checks = {
        "segment_id_null": F.col("segment_id").isNull(),
        "size_not_positive": F.coalesce(F.col("n_sessions"), F.lit(0)) <= 0,
        "pct_mobile_out_of_range": ~F.col("pct_mobile").between(0.0, 100.0),
    }
    counted = segments.agg(*[F.count_if(c).alias(name) for name, c in checks.items()])
    unique = counted.withColumn("segment_id_duplicate", duplicate_keys(segments, "segment_id").scalar())
    return _stack(unique, [*checks, "segment_id_duplicate"])


def enriched_quality(enriched: DataFrame) -> DataFrame:
    """(rule, violations) for the sessions_enriched contract."""
    checks = {
        "session_id_null": F.col("session_id").isNull(),
        "clean_text_null": F.col("clean_text").isNull(),
        "clean_text_has_pipe": F.col("clean_text").contains("|"),
        "n_keywords_negative": F.col("n_keywords") < 0,
        "segment_id_null": F.col("segment_id").isNull(),
    }
    counted = enriched.agg(*[F.count_if(c).alias(name) for name, c in checks.items()])
    unique = counted.withColumn("session_id_duplicate", duplicate_keys(enriched, "session_id").scalar())
    return _stack(unique, [*checks, "session_id_duplicate"])


def schema_mismatches(df: DataFrame, contract: T.StructType) -> list[str]:
    """Columns that are missing or have another type than the contract says."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in contract.fields:
        if field.name not in have:
            problems.append(f"{field.name}: missing")
        elif have[field.name].simpleString() != field.dataType.simpleString():
            problems.append(f"{field.name}: {have[field.name].simpleString()} != {field.dataType.simpleString()}")
    return problems
