from __future__ import annotations

import datetime as dt
import math

import duckdb
import pandas as pd
import pytest
from pyspark.sql import DataFrame

from sessionloom.operators.features import session_features
from sessionloom.plans.workspace import Workspace
from sessionloom.schemas import RAW_SESSIONS_SCHEMA
from sessionloom.session import local_session

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def workspace(spark) -> Workspace:
    return Workspace(spark, SF_DIR)


@pytest.fixture(scope="session")
def sessions(workspace) -> DataFrame:
    return workspace.sessions()


def duck(folder: str = SF_DIR, tables=TABLES) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in tables:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value) -> str:
    if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if "float" in type(value).__name__:
        return f"{float(value):.9f}"
    return str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(_cell(v) for v in row) for row in ordered.itertuples(index=False))


def assert_same(spark_df: DataFrame, sql: str, con: duckdb.DuckDBPyConnection) -> None:
    have, want = spark_df.toPandas(), con.sql(sql).df()
    assert sorted(have.columns) == sorted(want.columns)
    assert rows_of(have) == rows_of(want)


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def assert_no_all_pairs_join(df: DataFrame) -> None:
    text = plan_text(df)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def make_sessions(spark, rows: list[dict]) -> DataFrame:
    """Sessions with defaults for everything a test does not care about."""
    base = {
        "real_user_id": "user_0",
        "user_id_hash": "u0",
        "device_type": "mobile",
        "os": "iOS",
        "browser": "Safari Mobile",
        "ip_prefix": "1.2",
        "ip_prefix_hash": "net",
        "device_fingerprint_hash": "fp",
        "user_agent_hash": "ua",
        "session_start": dt.datetime(2024, 1, 1, 10, 0, 0),
        "session_duration_s": 100,
        "pages_visited": 4,
        "click_count": 5,
        "scroll_depth_avg": 0.5,
        "content_categories": ["gaming"],
        "interaction_text": "Gaming Mice | Best Deals",
        "active_hours_profile": [1.0] + [0.0] * 23,
    }
    full = [{**base, "session_id": f"s{i}", **row} for i, row in enumerate(rows)]
    names = [f.name for f in RAW_SESSIONS_SCHEMA.fields]
    raw = spark.createDataFrame([tuple(r[n] for n in names) for r in full], RAW_SESSIONS_SCHEMA)
    return session_features(raw)
