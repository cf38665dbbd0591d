"""Table contracts, feature order and the fixed vocabularies of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Device classes and their codes; unordered device pairs and their codes.
DEVICE_CODES = {"mobile": 0, "desktop": 1, "tablet": 2}
DEVICE_PAIR_CODES = {
    "mobile-desktop": 0,
    "mobile-tablet": 1,
    "desktop-tablet": 2,
    "same-mobile": 3,
    "same-desktop": 4,
    "same-tablet": 5,
}
UNKNOWN_CODE = -1

# The 16 pair features, in model-input order.
FEATURE_COLS = [
    "ip_prefix_match",
    "device_fp_match",
    "device_type_same",
    "device_pair_enc",
    "is_cross_device",
    "time_delta_hours",
    "time_delta_days",
    "same_hour_of_day",
    "same_day_of_week",
    "active_hours_cosine",
    "click_rate_diff",
    "scroll_depth_diff",
    "pages_diff",
    "duration_ratio",
    "content_jaccard",
    "n_shared_categories",
]

def _field(name: str, kind: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, kind, nullable)


_STRING, _LONG, _INT, _DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

RAW_SESSIONS_SCHEMA = T.StructType(
    [
        _field("session_id", _STRING, False),
        _field("real_user_id", _STRING),
        _field("user_id_hash", _STRING, False),
        _field("device_type", _STRING, False),
        _field("os", _STRING),
        _field("browser", _STRING),
        _field("ip_prefix", _STRING),
        _field("ip_prefix_hash", _STRING),
        _field("device_fingerprint_hash", _STRING),
        _field("user_agent_hash", _STRING),
        _field("session_start", T.TimestampType()),
        _field("session_duration_s", _LONG),
        _field("pages_visited", _LONG),
        _field("click_count", _LONG),
        _field("scroll_depth_avg", _DOUBLE),
        _field("content_categories", T.ArrayType(_STRING)),
        _field("interaction_text", _STRING),
        _field("active_hours_profile", T.ArrayType(_DOUBLE)),
    ]
)

SESSIONS_SCHEMA = T.StructType(
    RAW_SESSIONS_SCHEMA.fields
    + [
        _field("click_rate", _DOUBLE),
        _field("pages_per_minute", _DOUBLE),
        _field("device_type_enc", _INT),
        _field("is_mobile", _INT),
        _field("hour_of_day", _INT),
        _field("day_of_week", _INT),
        _field("n_content_categories", _INT),
    ]
)

SESSIONS_ENRICHED_SCHEMA = T.StructType(
    SESSIONS_SCHEMA.fields
    + [
        _field("clean_text", _STRING),
        _field("keywords", _STRING),
        _field("n_keywords", _INT),
        _field("segment_id", _INT),
        _field("embedding_dim", _INT),
    ]
)

IDENTITY_PAIRS_SCHEMA = T.StructType(
    [
        _field("pair_id", _LONG, False),
        _field("session_id_a", _STRING, False),
        _field("session_id_b", _STRING, False),
        _field("label", _INT, False),
        _field("probability", _DOUBLE),
        _field("predicted_label", _INT),
        _field("split", _STRING),
    ]
)

SEGMENTS_SCHEMA = T.StructType(
    [
        _field("segment_id", _INT, False),
        _field("segment_label", _STRING),
        _field("n_sessions", _LONG),
        _field("pct_of_total", _DOUBLE),
        _field("top_keywords", _STRING),
        _field("top_categories", _STRING),
        _field("device_distribution", T.MapType(_STRING, _DOUBLE)),
        _field("avg_scroll_depth", _DOUBLE),
        _field("avg_session_duration_s", _DOUBLE),
        _field("avg_click_count", _DOUBLE),
        _field("avg_pages_visited", _DOUBLE),
        _field("pct_mobile", _DOUBLE),
    ]
)
