"""The end-to-end job: features, identity model, text signals, segments, tables."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import make_config
from ..functions.privacy import PII_COLUMNS, anonymise
from ..operators.features import session_features
from ..operators.matching import IdentityResult, save_model, train_identity_model
from ..operators.segments import SegmentationResult, label_segments, run_segmentation
from ..operators.summaries import (
    dataset_profile,
    identity_run_metrics,
    job_summary,
    segmentation_run_metrics,
)
from ..operators.textsignals import process_sessions_text
from ..session import configure, shared_dir
from ..sources.tables import write_table


@dataclass
class JobResult:
    tables: dict[str, DataFrame]
    identity: IdentityResult
    segmentation: SegmentationResult | None
    summary: DataFrame


# Columns that reach storage as keyed digests only.
STORED_PII = [*PII_COLUMNS, "ip_prefix_hash"]


class TableStore:
    """Named tables: in the catalog when a database is given, else as parquet in one folder."""

    def __init__(self, spark: SparkSession, database: str | None = None, folder: str | None = None):
        self.spark = spark
        self.database = database
        self.folder = folder or (None if database else shared_dir(spark, "job"))

    def save(self, df: DataFrame, name: str, bucket_by: str | None = None, buckets: int | None = None) -> DataFrame:
        if self.database:
            path = f"{self.folder}/{name}" if self.folder else None
            table = f"{self.database}.{name}"
            write_table(df, table, "replace", path, bucket_by, buckets)
            return self.spark.table(table)
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")


def run(
    spark: SparkSession,
    raw_sessions: DataFrame,
    cfg: dict[str, Any] | None = None,
    skip_nlp: bool = False,
    store: TableStore | None = None,
    model_path: str | None = None,
    run_name: str = "run",
    salt: str | None = None,
) -> JobResult:
    """Run every step and write its tables; each table is read back, so later steps start from files.

    Stored tables are anonymised with ``salt`` (default: HASH_SALT): the true user id, the raw network
    prefix and its plain digest, which has few enough values to be guessed, do not reach storage.
    With a catalog store the sessions table is bucketed by session id, and both pair joins
    read it without a shuffle.
    """
    configure(spark)
    cfg = make_config(cfg)
    store = store or TableStore(spark)
    featured = anonymise(session_features(raw_sessions), STORED_PII, salt)
    buckets = cfg["storage"]["session_buckets"] or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sessions = store.save(featured, "sessions", "session_id", buckets)
    tables = {"sessions": sessions, "dataset_profile": dataset_profile(sessions)}

    identity = train_identity_model(sessions, cfg)
    tables["identity_pairs"] = store.save(identity.pairs, "identity_pairs")
    run_metrics = identity_run_metrics(identity, f"{run_name}_identity")
    if model_path:
        save_model(identity.model, model_path)

    segmentation, profiles = None, None
    if not skip_nlp:
        dim = cfg["nlp"]["embedding_dim"]
        # the embedding feeds the k search, the fit and the profiles: computed once
        with_text = store.save(process_sessions_text(sessions, dim), "sessions_text", "session_id", buckets)
        segmentation = run_segmentation(with_text, cfg)
        enriched = segmentation.segmented.drop("keyword_list", "embedding").withColumn(
            "embedding_dim", F.lit(dim)
        )
        tables["sessions_enriched"] = store.save(enriched, "sessions_enriched", "session_id", buckets)
        # profiles come from the stored assignment, not from a second pass over the vectors
        top_words = cfg["segmentation"]["top_keywords_per_segment"]
        profiles = store.save(label_segments(tables["sessions_enriched"], top_words), "audience_segments")
        tables["audience_segments"] = profiles
        n_sessions = sessions.count()
        run_metrics = run_metrics.unionByName(
            segmentation_run_metrics(spark, segmentation, n_sessions, f"{run_name}_segmentation")
        )
    tables["run_metrics"] = store.save(run_metrics, "run_metrics")
    summary = job_summary(sessions, identity.metrics, profiles)
    return JobResult(tables, identity, segmentation, summary)
