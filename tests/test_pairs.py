import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import assert_no_all_pairs_join, make_sessions, plan_text
from sessionloom.operators.pairs import (
    build_feature_matrix, build_pair_features, negative_pairs, number_pairs, pair_integrity, positive_pairs,
    checked_pairs, negative_shortfall, require_known_sessions, sample_pairs, sampling_plan, stratified_split,
)
from sessionloom.schemas import DEVICE_CODES, DEVICE_PAIR_CODES, FEATURE_COLS


def _with_users(pairs, sessions):
    users = sessions.select("session_id", "user_id_hash")
    a = users.toDF("session_id_a", "user_a")
    b = users.toDF("session_id_b", "user_b")
    return pairs.join(a, "session_id_a").join(b, "session_id_b")


def test_labels_mean_same_user(sessions):
    pairs = _with_users(sample_pairs(sessions), sessions)
    assert pairs.where((F.col("user_a") == F.col("user_b")) != (F.col("label") == 1)).count() == 0
    assert pairs.where("session_id_a = session_id_b").count() == 0


@pytest.mark.parametrize("per_user, ratio", [(3, 1.5), (2, 1.0), (1, 4.0)])
def test_exact_counts(sessions, per_user, ratio):
    counts = {r["label"]: r["count"] for r in sample_pairs(sessions, per_user, ratio).groupBy("label").count().collect()}
    users = sessions.groupBy("user_id_hash").count().where("count >= 2").count()
    assert counts == {1: users * per_user, 0: int(users * per_user * ratio)}


def test_same_pairs_on_any_layout(sessions):
    one = {tuple(r) for r in sample_pairs(sessions.coalesce(1)).collect()}
    many = {tuple(r) for r in sample_pairs(sessions.repartition(7)).collect()}
    assert one == many
    assert one != {tuple(r) for r in sample_pairs(sessions, seed=1).collect()}


def test_single_session_users_give_no_positives(spark):
    df = make_sessions(spark, [{"user_id_hash": "a"}, {"user_id_hash": "b"}, {"user_id_hash": "b"}])
    rows = positive_pairs(df, 4).collect()
    assert len(rows) == 4
    assert all({r["session_id_a"], r["session_id_b"]} == {"s1", "s2"} for r in rows)


def test_both_orientations_occur(spark):
    df = make_sessions(spark, [{"user_id_hash": "b"}, {"user_id_hash": "b"}])
    assert len({r["session_id_a"] for r in positive_pairs(df, 20).collect()}) == 2


def test_hot_user_sampling(spark):
    """A user with a third of the sessions: counts stay exact, no group is collected."""
    rows = [{"user_id_hash": "hot" if i % 3 == 0 else f"u{i // 3}"} for i in range(900)]
    df = make_sessions(spark, rows)
    plan = sampling_plan(df, 3, 1.5)
    negatives = negative_pairs(df)
    assert negatives.count() == plan["wanted"]
    assert _with_users(negatives, df).where("user_a = user_b").count() == 0
    text = plan_text(sample_pairs(df))
    assert "collect_list" not in text and "collect_set" not in text
    assert_no_all_pairs_join(sample_pairs(df))


def test_tiny_tables_reach_the_target_when_possible(spark):
    df = make_sessions(spark, [{"user_id_hash": u} for u in ("a", "a", "b", "b")])
    assert negative_pairs(df, 3, 1.5).count() == 9
    assert negative_pairs(make_sessions(spark, [{}]), 3, 1.5).count() == 0


def test_one_user_with_nearly_all_sessions_still_reaches_the_target(spark):
    df = make_sessions(spark, [{"user_id_hash": "hot" if i < 400 else f"u{i // 2}"} for i in range(408)])
    row = negative_shortfall(df).first()
    assert row["wanted"] == row["found"] == 22
    alone = make_sessions(spark, [{"user_id_hash": "only"}] * 5)
    assert tuple(negative_shortfall(alone).first()) == (4, 0)


def test_unknown_and_repeated_ids_are_flagged_once(spark):
    sessions = make_sessions(spark, [{}, {}, {"session_id": "twice"}, {"session_id": "twice"}])
    pairs = spark.createDataFrame([("s0", "s1"), ("s0", "gone"), ("twice", "s1"), ("gone", "twice")], "session_id_a string, session_id_b string")
    got = {tuple(r) for r in checked_pairs(pairs, sessions).collect()}
    assert got == {("s0", "s1", False, False), ("s0", "gone", True, False), ("twice", "s1", False, True), ("gone", "twice", True, True)}


def test_split_is_exact_per_label(sessions):
    pairs = sample_pairs(sessions)
    split = stratified_split(pairs, 0.2)
    got = {(r["label"], r["split"]): r["count"] for r in split.groupBy("label", "split").count().collect()}
    for label, total in {r["label"]: r["count"] for r in pairs.groupBy("label").count().collect()}.items():
        assert got[(label, "test")] == int(total * 0.2 + 0.5)
        assert got[(label, "train")] + got[(label, "test")] == total


def test_pair_ids_are_one_to_n(sessions):
    ids = sorted(r["pair_id"] for r in number_pairs(sample_pairs(sessions)).collect())
    assert ids == list(range(1, len(ids) + 1))


def _features(spark, a: dict, b: dict):
    df = make_sessions(spark, [a, b])
    pairs = spark.createDataFrame([("s0", "s1")], "session_id_a string, session_id_b string")
    return build_pair_features(pairs, df).first()


def test_feature_values(spark):
    flat = [1.0 / 24] * 24
    row = _features(
        spark,
        {"session_start": dt.datetime(2024, 1, 1, 10), "content_categories": ["a", "b", "b"], "session_duration_s": 50,
         "active_hours_profile": flat, "scroll_depth_avg": 0.75},
        {"session_start": dt.datetime(2024, 1, 8, 10, 30), "content_categories": ["b", "c"], "device_type": "tablet",
         "ip_prefix_hash": "other", "scroll_depth_avg": 0.25},
    )
    assert row["ip_prefix_match"] == 0 and row["device_fp_match"] == 1
    assert row["device_type_same"] == 0 and row["is_cross_device"] == 1 and row["device_pair_enc"] == 1
    assert row["time_delta_hours"] == 168.5 and row["time_delta_days"] == 7.021
    assert row["same_hour_of_day"] == 1 and row["same_day_of_week"] == 1
    assert row["active_hours_cosine"] == round(1 / 24**0.5, 6)
    assert row["scroll_depth_diff"] == 0.5 and row["duration_ratio"] == 0.5
    assert row["content_jaccard"] == round(1 / 3, 6) and row["n_shared_categories"] == 1


def test_missing_values_give_zero(spark):
    row = _features(
        spark,
        {"ip_prefix_hash": None, "content_categories": None, "active_hours_profile": [0.0] * 24, "session_duration_s": 0},
        {"ip_prefix_hash": None, "content_categories": [], "active_hours_profile": None, "session_duration_s": 0},
    )
    assert row["ip_prefix_match"] == 0 and row["content_jaccard"] == 0.0 and row["n_shared_categories"] == 0
    assert row["active_hours_cosine"] == 0.0 and row["duration_ratio"] == 0.0


def test_device_pair_codes_ignore_order(spark):
    devices = [*DEVICE_CODES, "console"]
    df = make_sessions(spark, [{"device_type": d} for d in devices])
    ids = [(f"s{i}", f"s{j}") for i in range(4) for j in range(4)]
    pairs = spark.createDataFrame(ids, "session_id_a string, session_id_b string")
    for row in build_pair_features(pairs, df).collect():
        a, b = devices[int(row["session_id_a"][1:])], devices[int(row["session_id_b"][1:])]
        name = f"same-{a}" if a == b else f"{a}-{b}"
        want = DEVICE_PAIR_CODES.get(name, DEVICE_PAIR_CODES.get(f"{b}-{a}", -1))
        assert row["device_pair_enc"] == want


def test_matrix_shape_and_no_nulls(sessions):
    pairs = sample_pairs(sessions, 1, 1.0)
    matrix = build_feature_matrix(pairs, sessions)
    assert matrix.count() == pairs.count()
    assert [c for c in matrix.columns if c in FEATURE_COLS] == FEATURE_COLS
    assert matrix.na.drop(subset=FEATURE_COLS).count() == pairs.count()


def test_forced_network_match(spark):
    assert _features(spark, {"ip_prefix_hash": "same"}, {"ip_prefix_hash": "same"})["ip_prefix_match"] == 1


def test_integrity_counts(spark):
    df = make_sessions(spark, [{}, {}, {"session_id": "s1"}])
    pairs = spark.createDataFrame([("s0", "s1"), ("s0", "gone"), ("lost", "gone")], "session_id_a string, session_id_b string")
    assert tuple(pair_integrity(pairs, df).first()) == (3, 1, 2, 1)
    with pytest.raises(KeyError):
        require_known_sessions(pairs, df)
    require_known_sessions(pairs.limit(0), df)


def test_sessions_side_is_shuffled_once(spark, sessions, workspace):
    """Without broadcast both joins share one exchange of the sessions."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = build_pair_features(workspace.pairs(), sessions)
        df.collect()
        assert "ReusedExchange" in plan_text(df)
        assert_no_all_pairs_join(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
