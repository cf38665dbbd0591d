"""Dataset profile, run metrics and final summaries as small DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import round_half_up


def dataset_profile(df: DataFrame, tag: str = "sessions") -> DataFrame:
    """(metric, value): rows, columns, unique users, sessions per device.

    One (user, device) pre-aggregate serves all counts.
    """
    has_user, has_device = "user_id_hash" in df.columns, "device_type" in df.columns
    keys = [c for c, present in (("user_id_hash", has_user), ("device_type", has_device)) if present]
    n_cols = F.lit(len(df.columns)).cast("long")
    if not keys:
        totals = df.agg(F.count(F.lit(1)).alias("n"))
        facts = F.array(_fact(f"{tag}_n_rows", F.col("n")), _fact(f"{tag}_n_cols", n_cols))
        return totals.select(F.explode(facts).alias("m")).select("m.*")
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    facts = [_fact(f"{tag}_n_rows", F.col("n_rows")), _fact(f"{tag}_n_cols", n_cols)]
    aggregates = [F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")]
    if has_user:
        aggregates.append(F.countDistinct("user_id_hash").alias("n_users"))
        facts.append(_fact(f"{tag}_n_unique_users", F.col("n_users")))
    profile = grouped.agg(*aggregates).select(F.explode(F.array(*facts)).alias("m")).select("m.*")
    if has_device:
        per_device = (
            grouped.where(F.col("device_type").isNotNull())
            .groupBy("device_type")
            .agg(F.sum("n").alias("value"))
            .select(F.concat(F.lit(f"{tag}_sessions_"), "device_type").alias("metric"), "value")
        )
        profile = profile.unionByName(per_device)
    return profile


def _fact(name: str, value):
    return F.struct(F.lit(name).alias("metric"), value.alias("value"))


RUN_METRICS_SCHEMA = "run string, metric string, value double"


def identity_run_metrics(result, run: str) -> DataFrame:
    """(run, metric, value): quality figures and one ``fi_*`` row per feature importance."""
    numeric = ["accuracy", "precision", "recall", "f1", "roc_auc", "threshold", "n_train", "n_test"]
    facts = F.array(*[_fact(m, F.col(m).cast("double")) for m in numeric])
    rows = result.metrics.select(F.explode(facts).alias("m")).select("m.metric", "m.value")
    if result.feature_importance is not None:
        rows = rows.unionByName(
            result.feature_importance.select(
                F.concat(F.lit("fi_"), "feature").alias("metric"), round_half_up("importance", 6).alias("value")
            )
        )
    return rows.select(F.lit(run).alias("run"), "metric", "value")


def segmentation_run_metrics(spark: SparkSession, result, n_sessions: int, run: str) -> DataFrame:
    """(run, metric, value): silhouette per searched k, inertia, final silhouette, sizes."""
    rows = [(run, f"silhouette_k{k}", round(s, 4)) for k, s in result.search.items()]
    rows += [
        (run, "n_clusters", float(result.n_clusters)),
        (run, "inertia", round(result.inertia, 2)),
        (run, "silhouette_final", round(result.silhouette, 4)),
        (run, "n_sessions", float(n_sessions)),
    ]
    return spark.createDataFrame(rows, RUN_METRICS_SCHEMA)


def job_summary(sessions: DataFrame, metrics: DataFrame, segments: DataFrame | None) -> DataFrame:
    """One row: sessions, unique users, accuracy, AUC and (when segmented) the number of segments."""
    n_segments = F.lit(None).cast("long") if segments is None else segments.agg(F.count(F.lit(1))).scalar()
    return sessions.agg(
        F.count(F.lit(1)).alias("sessions"), F.countDistinct("user_id_hash").alias("unique_users")
    ).select(
        "sessions",
        "unique_users",
        metrics.select("accuracy").scalar().alias("accuracy"),
        metrics.select("roc_auc").scalar().alias("roc_auc"),
        n_segments.alias("n_segments"),
    )


def segment_listing(segments: DataFrame, label_length: int = 35) -> DataFrame:
    """Segment id, label cut to a fixed length, size, share and top categories."""
    return segments.select(
        "segment_id",
        F.substring("segment_label", 1, label_length).alias("segment_label"),
        "n_sessions",
        "pct_of_total",
        "top_categories",
    ).orderBy("segment_id")
