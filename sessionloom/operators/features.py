"""Session feature projection and null handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import as_col, flag, round_half_up
from ..schemas import DEVICE_CODES, FEATURE_COLS, UNKNOWN_CODE


def device_code(device: Column | str) -> Column:
    """Numeric device class, -1 when unknown or missing."""
    col, code = as_col(device), F
    for name, value in DEVICE_CODES.items():
        code = code.when(col == name, value)
    return code.otherwise(UNKNOWN_CODE)


def session_features(df: DataFrame) -> DataFrame:
    """Add the engineered session columns in one projection (no shuffle).

    ``content_categories`` may be an array or its JSON text; ``session_start`` may be
    a timestamp or ISO text.
    """
    seconds = F.greatest(F.col("session_duration_s"), F.lit(1))
    types = dict(df.dtypes)
    start = F.col("session_start")
    if types["session_start"] == "string":
        start = F.try_to_timestamp(start)
    categories = F.col("content_categories")
    n_categories = F.json_array_length(categories) if types["content_categories"] == "string" else F.size(categories)
    return df.withColumns(
        {
            "click_rate": round_half_up(F.col("click_count") / seconds, 6),
            "pages_per_minute": round_half_up(F.col("pages_visited") / (seconds / F.lit(60.0)), 4),
            "device_type_enc": device_code("device_type"),
            "is_mobile": flag(F.col("device_type") == "mobile"),
            "session_start": start,
            "hour_of_day": F.hour(start),
            "day_of_week": F.weekday(start),
            # size(null) is -1 or null depending on settings: both mean "no list"
            "n_content_categories": F.greatest(F.coalesce(n_categories, F.lit(0)), F.lit(0)),
        }
    )


def fill_features(df: DataFrame) -> DataFrame:
    """Missing (null or NaN) pair features become 0."""
    return df.na.fill(0, [c for c in FEATURE_COLS if c in df.columns])
