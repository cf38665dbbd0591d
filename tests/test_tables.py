import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import make_sessions, plan_text
from sessionloom.operators import reports as rp
from sessionloom.operators.pairs import build_pair_features
from sessionloom.schemas import SEGMENTS_SCHEMA
from sessionloom.sources import tables as tb


@pytest.fixture
def name(spark):
    table = f"t_{uuid.uuid4().hex[:12]}"
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_write_modes(spark, name, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "data")
    assert not tb.table_exists(spark, name)
    tb.write_table(df, name, path=path)
    assert tb.table_exists(spark, name) and tb.read_table(spark, name).count() == 3
    tb.write_table(df, name, "append")
    assert tb.read_table(spark, name).count() == 6
    with pytest.raises(AnalysisException):
        tb.write_table(df, name, "fail")
    tb.write_table(df, name, "replace", path=path)
    assert tb.read_table(spark, name).count() == 3
    assert tb.read_table(spark, name, f"SELECT max(id) AS m FROM {name}").first()["m"] == 2
    with pytest.raises(ValueError):
        tb.write_table(df, name, "upsert")


def test_bucketed_table_joins_without_shuffling_sessions(spark, workspace, name, tmp_path):
    tb.write_table(workspace.contract_sessions(), name, path=str(tmp_path / "b"), bucket_by="session_id", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(build_pair_features(workspace.pairs(), spark.table(name)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 2  # the pairs, once per end


def test_csv_round_trip(spark, tmp_path):
    df = make_sessions(
        spark,
        [{"interaction_text": 'say "hi", | then\nleave \\n\r\\e', "content_categories": ["a,b", 'q"q']}, {"os": None, "content_categories": []}],
    )
    path = str(tmp_path / "csv")
    tb.save_sample(df, path)
    back = tb.read_sessions_csv(spark, path)
    assert back.columns == df.columns and dict(back.dtypes) == dict(df.dtypes)
    rows = {r["session_id"]: r for r in back.collect()}
    assert rows["s0"]["interaction_text"] == 'say "hi", | then\nleave \\n\r\\e'
    assert rows["s0"]["content_categories"] == ["a,b", 'q"q'] and rows["s1"]["content_categories"] == []
    assert rows["s1"]["os"] is None and rows["s0"]["session_start"] == df.first()["session_start"]
    assert rows["s0"]["active_hours_profile"] == [1.0] + [0.0] * 23


def test_generic_csv_infers_types(spark, tmp_path):
    path = str(tmp_path / "csv")
    tb.write_csv(spark.range(3).withColumn("x", F.col("id") / 2), path)
    assert dict(tb.read_csv(spark, path).dtypes) == {"id": "int", "x": "double"}
    assert dict(tb.read_csv(spark, path, "id long, x double").dtypes) == {"id": "bigint", "x": "double"}


def test_fallback_order(spark, sessions, name, tmp_path):
    csv = str(tmp_path / "csv")
    tb.save_sample(sessions.drop("first_event_id"), csv, n=25)
    from_csv, segments = tb.load_report_tables(spark, name, "no_segments", csv)
    assert from_csv.count() == 25 and segments.count() == 0 and segments.schema == SEGMENTS_SCHEMA
    nothing, _ = tb.load_report_tables(spark, name, "no_segments")
    assert nothing.count() == 0
    with pytest.raises(AnalysisException):
        tb.load_report_tables(spark, name, "no_segments", str(tmp_path / "absent"))
    tb.write_table(sessions, name, path=str(tmp_path / "t"))
    from_table, _ = tb.load_report_tables(spark, name, "no_segments", csv, limit=40)
    assert from_table.count() == 40
    assert tb.load_report_tables(spark, name, "no_segments", csv)[0].count() == sessions.count()


def test_views_answer_plain_sql(spark, workspace):
    tb.register_views(
        spark,
        {
            "sessions": workspace.contract_sessions(),
            "sessions_enriched": workspace.enriched(),
            "audience_segments": workspace.profiles(),
            "identity_pairs": workspace.scored_pairs(),
        },
    )
    devices = spark.sql(
        "SELECT device_type, COUNT(*) AS n FROM sessions GROUP BY device_type HAVING n > 0 ORDER BY n DESC"
    )
    assert {r["device_type"]: r["n"] for r in devices.collect()} == {
        r["device_type"]: r["n_sessions"] for r in rp.device_distribution(workspace.sessions()).collect()
    }
    joined = spark.sql(
        """SELECT g.segment_label, COUNT(*) AS n FROM sessions_enriched e JOIN sessions s USING (session_id)
           JOIN audience_segments g ON e.segment_id = g.segment_id GROUP BY g.segment_id, g.segment_label"""
    )
    assert joined.agg(F.sum("n")).first()[0] == workspace.sessions().count()
    matched = spark.sql(
        """SELECT a.device_type AS device_a, b.device_type AS device_b, SUM(p.predicted_label) AS m FROM identity_pairs p
           JOIN sessions a ON p.session_id_a = a.session_id JOIN sessions b ON p.session_id_b = b.session_id
           WHERE p.split = 'test' GROUP BY device_a, device_b"""
    )
    want = rp.match_rate_by_devices(workspace.scored_pairs(), workspace.sessions())
    assert matched.agg(F.sum("m")).first()[0] == want.agg(F.sum("n_matched")).first()[0]


def test_browser_paging(workspace):
    enriched = workspace.enriched()
    first = rp.session_browser(enriched, n=100, after="", page_size=10).collect()
    second = rp.session_browser(enriched, n=100, after=first[-1]["session_id"], page_size=10).collect()
    ids = [r["session_id"] for r in first + second]
    assert len(set(ids)) == 20 and ids == sorted(ids)
    assert "interaction_text" not in first[0].asDict()
    few = enriched.where("pages_visited >= 2").count()
    assert rp.session_browser(enriched, n=10, condition="pages_visited >= 2").count() == min(10, few)
    assert "segment_id" not in rp.session_browser(workspace.sessions(), n=5).columns


def test_histogram_edges(spark):
    df = make_sessions(spark, [{"session_duration_s": d} for d in (0, 49, 50, 99, 100)])
    got = {r["bin"]: r["n_sessions"] for r in rp.duration_histogram(df).collect()}
    assert got == {0: 1, 24: 1, 25: 1, 49: 2}
    same = make_sessions(spark, [{"session_duration_s": 7}] * 1 + [{"session_duration_s": 7, "session_id": "x"}])
    assert [tuple(r) for r in rp.duration_histogram(same).collect()] == [("mobile", 0, 2)]


def test_kpis_without_segments(spark, sessions):
    row = rp.kpi_row(sessions, spark.createDataFrame([], SEGMENTS_SCHEMA)).first()
    assert row["n_segments"] == 0 and row["total_sessions"] == sessions.count()
