"""The events adapter: invariants, gap rule, and a hot user against the event-by-event SQL."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import assert_same, duck, plan_text
from sessionloom.operators.features import session_features
from sessionloom.operators.pairs import sample_pairs
from sessionloom.operators.quality import schema_mismatches, session_quality
from sessionloom.plans.fixture import sessions_from_events
from sessionloom.plans.oracle import all_oracles
from sessionloom.plans.workspace import Workspace
from sessionloom.schemas import SESSIONS_SCHEMA
from sessionloom.sources.events import event_cells

EXPECTED = all_oracles()


def test_contract(sessions):
    assert schema_mismatches(sessions, SESSIONS_SCHEMA) == []
    assert {r["rule"]: r["violations"] for r in session_quality(sessions).collect()} == {
        r: 0
        for r in [
            "session_id_null", "user_id_hash_null", "device_type_null", "device_type_unknown", "scroll_out_of_range",
            "categories_invalid", "hours_not_24", "hours_not_normalised", "session_id_duplicate",
        ]
    }


def test_every_event_is_in_one_session(workspace, sessions):
    assert sessions.agg(F.sum("pages_visited")).first()[0] == workspace.events().count()


def _events(spark, times):
    rows = [(i, t, 1, "click", 1.0, '{"k": 3}') for i, t in enumerate(times)]
    return spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    )


def test_gap_is_strict(spark):
    start = dt.datetime(2024, 1, 1, 0, 59, 59, 999999)
    gap = dt.timedelta(hours=6)
    tick = dt.timedelta(microseconds=1)
    exact = sessions_from_events(_events(spark, [start, start + gap]))
    beyond = sessions_from_events(_events(spark, [start, start + gap + tick]))
    assert exact.count() == 1
    assert beyond.count() == 2


def test_gap_below_an_hour_is_refused(spark):
    with pytest.raises(ValueError):
        sessions_from_events(_events(spark, [dt.datetime(2024, 1, 1)]), gap_us=1)


@pytest.fixture(scope="module")
def hot_folder(spark, tmp_path_factory):
    """12,000 events of which one user owns a third, many at the same instants."""
    folder = str(tmp_path_factory.mktemp("hot"))
    n = 12_000
    user = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.hash("id"), F.lit(60)))
    kinds = F.array(*[F.lit(k) for k in ("click", "view", "error", "signup")])
    seconds = F.pmod(F.hash("id", F.lit("t")), F.lit(40 * 86400))
    spark.range(n).select(
        F.col("id").alias("event_id"),
        (F.timestamp_seconds(F.lit(1704067200) + seconds)).cast("timestamp_ntz").alias("ts"),
        user.cast("long").alias("user_id"),
        F.element_at(kinds, (F.pmod(F.hash("id", F.lit("k")), F.lit(4)) + 1)).alias("event_type"),
        F.lit(1.0).alias("value"),
        F.concat(F.lit('{"k": '), F.pmod(F.hash("id", F.lit("p")), F.lit(100)).cast("string"), F.lit("}")).alias("props"),
    ).toPandas().to_parquet(f"{folder}/events.parquet", coerce_timestamps="us")
    return folder


def test_hot_user_sessions(spark, hot_folder):
    from sessionloom.plans.catalog import all_queries

    con = duck(hot_folder, ["events"])
    for name in ("sessions", "session_features", "session_hours", "positive_pairs", "negative_pairs", "numbered_split"):
        assert_same(all_queries()[name](spark, hot_folder), EXPECTED[name], con)


def test_hot_user_cells_are_bounded_by_time(spark, hot_folder):
    cells = event_cells(Workspace(spark, hot_folder).events())
    hot = cells.where("user_id = 7")
    assert hot.agg(F.sum("n")).first()[0] >= 4000
    per_hour = hot.groupBy("hour_slot").count().agg(F.max("count")).first()[0]
    assert per_hour <= 4 * 4  # event types x interests, whatever the number of events


def test_one_user_only_gives_no_negatives(spark):
    start = dt.datetime(2024, 1, 1)
    times = [start + dt.timedelta(hours=7 * i) for i in range(6)]
    sessions = session_features(sessions_from_events(_events(spark, times)))
    labels = {r["label"]: r["count"] for r in sample_pairs(sessions).groupBy("label").count().collect()}
    assert labels == {1: 3}


def test_events_are_scanned_once(workspace):
    text = plan_text(workspace.derive_sessions())
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in text and "Join" not in text
