import uuid

import pytest
from pyspark.sql import functions as F

from sessionloom.config import make_config
from sessionloom.operators.quality import enriched_quality, pair_quality, schema_mismatches, segment_quality
from sessionloom.operators.segments import run_segmentation
from sessionloom.operators.summaries import dataset_profile
from sessionloom.operators.textsignals import process_sessions_text
from sessionloom.plans.job import TableStore, run
from sessionloom.schemas import IDENTITY_PAIRS_SCHEMA, SEGMENTS_SCHEMA, SESSIONS_ENRICHED_SCHEMA
from sessionloom.session import shared_dir

CFG = {
    "identity": {"rf_params": {"n_estimators": 5, "max_depth": 4}},
    "segmentation": {"k_search_range": [3, 4], "kmeans_restarts": 1, "search_restarts": 1, "kmeans_max_iter": 20},
    "nlp": {"embedding_dim": 16},
}


@pytest.fixture(scope="module")
def full(spark, workspace):
    return run(spark, workspace.contract_sessions(), CFG, store=TableStore(spark), model_path=shared_dir(spark, "m"), salt="s")


def test_tables_meet_their_contracts(full):
    tables = full.tables
    stored = [f for f in SESSIONS_ENRICHED_SCHEMA.fields if f.name != "real_user_id"]
    assert schema_mismatches(tables["sessions_enriched"], type(SESSIONS_ENRICHED_SCHEMA)(stored)) == []
    assert schema_mismatches(tables["identity_pairs"], IDENTITY_PAIRS_SCHEMA) == []
    assert schema_mismatches(tables["audience_segments"], SEGMENTS_SCHEMA) == []
    for check in (
        enriched_quality(tables["sessions_enriched"]), pair_quality(tables["identity_pairs"]),
        segment_quality(tables["audience_segments"]),
    ):
        assert check.agg(F.sum("violations")).first()[0] == 0


def test_nothing_personal_is_stored(full, workspace):
    for name in ("sessions", "sessions_enriched"):
        assert "real_user_id" not in full.tables[name].columns
    raw = workspace.sessions().select("ip_prefix").distinct()
    assert full.tables["sessions"].join(raw, "ip_prefix").count() == 0
    assert "keyword_list" not in full.tables["sessions_enriched"].columns


def test_summary_and_metrics(full, workspace):
    row = full.summary.first()
    assert row["sessions"] == workspace.sessions().count() and row["n_segments"] in (3, 4)
    metrics = {(r["run"], r["metric"]): r["value"] for r in full.tables["run_metrics"].collect()}
    assert metrics[("run_identity", "accuracy")] == row["accuracy"]
    assert sum(1 for _, m in metrics if m.startswith("fi_")) == 16
    assert {m for r, m in metrics if r == "run_segmentation"} == {
        "silhouette_k3", "silhouette_k4", "n_clusters", "inertia", "silhouette_final", "n_sessions",
    }


def test_skip_text_in_a_catalog(spark, workspace):
    database = f"d_{uuid.uuid4().hex[:10]}"
    folder = shared_dir(spark, "catalog")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    try:
        result = run(
            spark, workspace.contract_sessions(), CFG, skip_nlp=True, store=TableStore(spark, database, f"{folder}/x"), salt="s"
        )
        assert result.segmentation is None and "audience_segments" not in result.tables
        assert result.summary.first()["n_segments"] is None
        assert spark.catalog.tableExists(f"{database}.sessions")
        buckets = spark.sql(f"DESCRIBE EXTENDED {database}.sessions").where("col_name = 'Num Buckets'").first()
        assert buckets["data_type"] == "4"
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_config_merge():
    cfg = make_config({"identity": {"rf_params": {"max_depth": 3}}, "data": {"random_seed": 7}})
    assert cfg["identity"]["rf_params"]["max_depth"] == 3 and cfg["identity"]["rf_params"]["n_estimators"] == 200
    assert cfg["data"]["random_seed"] == 7 and make_config()["data"]["random_seed"] == 42


def test_foreign_config_sections_are_accepted(spark, sessions):
    """A full config with extra sections and scikit-learn style names runs unchanged."""
    cfg = make_config({
        "database": {"backend": "sqlite"},
        "identity": {"rf_params": {"class_weight": "balanced", "n_jobs": -1}},
        "segmentation": {"kmeans_init": "k-means++", "k_search_range": [2], "kmeans_restarts": 1},
    })
    embedded = process_sessions_text(sessions, 8)
    assert run_segmentation(embedded, {**cfg, "segmentation": {**cfg["segmentation"], "n_clusters": 2}}).n_clusters == 2


def test_profile_without_known_columns(spark):
    rows = {r["metric"]: r["value"] for r in dataset_profile(spark.range(4), "t").collect()}
    assert rows == {"t_n_rows": 4, "t_n_cols": 1}
