import datetime as dt

from pyspark.sql import functions as F

from conftest import make_sessions
from sessionloom.operators.features import device_code, fill_features, session_features
from sessionloom.functions.numeric import clip, interval_index, ratio, round_half_up, scaled_share


def test_values(spark):
    row = make_sessions(
        spark,
        [{"click_count": 7, "session_duration_s": 90, "pages_visited": 3, "content_categories": ["a", "a", "b"],
          "session_start": dt.datetime(2024, 1, 1, 23, 5)}],
    ).first()
    assert row["click_rate"] == round(7 / 90, 6)
    assert row["pages_per_minute"] == 2.0
    assert row["device_type_enc"] == 0 and row["is_mobile"] == 1
    assert row["hour_of_day"] == 23 and row["day_of_week"] == 0  # a Monday
    assert row["n_content_categories"] == 3  # duplicates count


def test_zero_duration_counts_as_one_second(spark):
    row = make_sessions(spark, [{"session_duration_s": 0, "click_count": 4, "pages_visited": 2}]).first()
    assert row["click_rate"] == 4.0 and row["pages_per_minute"] == 120.0


def test_unknown_device_and_missing_categories(spark):
    row = make_sessions(spark, [{"device_type": "console", "content_categories": None}]).first()
    assert row["device_type_enc"] == -1 and row["is_mobile"] == 0 and row["n_content_categories"] == 0


def test_text_inputs(spark):
    df = spark.createDataFrame(
        [("mobile", 10, 1, 1, "2024-07-07 01:02:03", '["x","y"]'), (None, 10, 1, 1, "bad", "not json")],
        "device_type string, session_duration_s long, pages_visited long, click_count long, session_start string, "
        "content_categories string",
    )
    first, second = session_features(df).collect()
    assert (first["hour_of_day"], first["day_of_week"], first["n_content_categories"]) == (1, 6, 2)
    assert second["hour_of_day"] is None and second["n_content_categories"] == 0
    assert second["device_type_enc"] == -1 and second["is_mobile"] == 0


def test_input_columns_stay(spark):
    df = make_sessions(spark, [{}])
    assert set(df.columns) <= set(session_features(df).columns)


def test_fill_replaces_null_and_nan(spark):
    df = spark.createDataFrame([(None, float("nan"))], "ip_prefix_match int, click_rate_diff double")
    assert tuple(fill_features(df).first()) == (0, 0.0)


def test_scalars(spark):
    df = spark.createDataFrame([(0.125, 2.0, -5)], "x double, y double, z int")
    row = df.select(
        round_half_up("x", 2), clip("y", 0.05, 1.0), clip("z", 0), ratio(F.col("y"), F.lit(0)),
        scaled_share("y", 4), scaled_share("y", 1), interval_index(F.col("x"), [0.1, 0.125, 0.3]), device_code(F.lit("tv")),
    ).first()
    assert tuple(row) == (0.13, 1.0, 0, 0.0, 0.5, 1.0, 2, -1)
