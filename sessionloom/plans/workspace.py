"""Base tables derived from the driver tables, written once per session and source folder.

The catalogue queries share them the way a deployment shares its ingested tables: the
derivation runs once as a Spark job into the shared folder, later queries scan files
with pushed-down filters and pruned columns.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import at_least
from ..operators.features import session_features
from ..operators.matching import IdentityResult, identity_pairs, train_identity_model
from ..operators.pairs import build_feature_matrix, number_pairs, sample_pairs, stratified_split
from ..operators.segments import label_segments
from ..operators.textsignals import text_columns
from ..session import configure, shared_dir, spread
from ..sources.events import read_events
from .fixture import sessions_from_events
from .job import TableStore, run


# Key of the keyed digests in the catalogue's queries; deployments set their own.
TEST_SALT = "pepper"


@lru_cache(maxsize=None)
def _folder(app_id: str, sf_dir: str) -> dict[str, str]:
    """Names of the tables already written for this application and source folder."""
    return {}


@lru_cache(maxsize=None)
def _models(app_id: str, sf_dir: str) -> dict[str, IdentityResult]:
    """Models already fitted for this application and source folder."""
    return {}


class Workspace:
    """Access to the driver tables of one folder and to the tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._written = _folder(spark.sparkContext.applicationId, self.sf_dir)
        self._fitted = _models(spark.sparkContext.applicationId, self.sf_dir)

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def documents(self) -> DataFrame:
        """Texts, spread over the cores: text work is heavy and a small file is one split."""
        return spread(self.source("documents"))

    def events(self) -> DataFrame:
        return read_events(self.spark, self.sf_dir)

    def _stored(self, name: str, build) -> DataFrame:
        if name not in self._written:
            path = shared_dir(self.spark, name)
            build().write.parquet(path)
            self._written[name] = path
        return self.spark.read.parquet(self._written[name])

    def derive_sessions(self) -> DataFrame:
        """The sessions plan itself, from events, nothing stored."""
        return session_features(sessions_from_events(self.events()))

    def sessions(self) -> DataFrame:
        return self._stored("sessions", self.derive_sessions)

    def contract_sessions(self) -> DataFrame:
        """Sessions without the adapter's event key."""
        return self.sessions().drop("first_event_id")

    def pairs(self) -> DataFrame:
        """Sampled pairs with default settings."""
        return self._stored("pairs", lambda: sample_pairs(self.sessions()))

    def derive_feature_pairs(self) -> DataFrame:
        """Numbered, split pairs with their 16 features."""
        return build_feature_matrix(stratified_split(number_pairs(self.pairs())), self.sessions())

    def feature_pairs(self) -> DataFrame:
        return self._stored("feature_pairs", self.derive_feature_pairs)

    def scored_pairs(self) -> DataFrame:
        """Identity pairs scored by a fixed integer rule, so evaluation has an exact expected result."""
        points = (
            6 * F.col("ip_prefix_match")
            + F.col("device_fp_match")
            + F.col("same_hour_of_day")
            + 3 * F.least(F.col("n_shared_categories"), F.lit(1))
        )
        scored = self.feature_pairs().withColumn("probability", points / F.lit(11.0))
        return identity_pairs(scored.withColumn("predicted_label", at_least("probability", 0.5)))

    def derive_enriched(self) -> DataFrame:
        """Sessions with text columns and a segment given by the labels of the vectors table."""
        vectors = self.source("embeddings").select(F.col("vec_id").alias("_vec"), F.col("label").alias("segment_id"))
        n_vectors = self.source("embeddings").agg(F.count(F.lit(1))).scalar()
        placed = text_columns(self.sessions()).withColumn("_vec", F.pmod(F.col("first_event_id"), n_vectors))
        return placed.join(vectors, "_vec").drop("_vec", "keyword_list")

    def enriched(self) -> DataFrame:
        return self._stored("enriched", self.derive_enriched)

    def profiles(self) -> DataFrame:
        return self._stored("profiles", lambda: label_segments(self.enriched()))

    def trained(self, model: str) -> IdentityResult:
        """The identity model of this kind, fitted once with default settings."""
        if model not in self._fitted:
            cfg = {"identity": {"model": model}}
            self._fitted[model] = train_identity_model(self.sessions(), cfg, features=self.feature_pairs())
        return self._fitted[model]

    def job_table(self, name: str) -> DataFrame:
        """``run_summary``, ``run_metrics`` or ``audience_segments`` of one end-to-end run with default settings over the sessions."""
        if name not in self._written:
            store = TableStore(self.spark)
            result = run(self.spark, self.contract_sessions(), store=store, salt=TEST_SALT)
            store.save(result.summary, "run_summary")
            for table in ("run_summary", "run_metrics", "audience_segments"):
                self._written[table] = f"{store.folder}/{table}"
        return self.spark.read.parquet(self._written[name])
