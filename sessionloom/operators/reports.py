"""Analytical queries and report aggregates over sessions, pairs and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_half_up, scaled_share
from ..functions.text import array_to_json, truncate
from ..sources.tables import keep_columns
from .ranking import sample_rows



def _rows() -> Column:
    return F.count(F.lit(1))


# -- analytical queries --------------------------------------------------------------


def device_summary(sessions: DataFrame) -> DataFrame:
    """Sessions and average behaviour by device class, largest first."""
    return (
        sessions.groupBy("device_type")
        .agg(
            _rows().alias("n_sessions"),
            round_half_up(F.avg("session_duration_s"), 1).alias("avg_duration_s"),
            round_half_up(F.avg("scroll_depth_avg"), 3).alias("avg_scroll_depth"),
            round_half_up(F.avg("click_count"), 1).alias("avg_clicks"),
        )
        .orderBy(F.desc("n_sessions"), "device_type")
    )


def user_devices(sessions: DataFrame) -> DataFrame:
    """(user, device, sessions): at most three rows per user, combined before the shuffle."""
    return sessions.groupBy("user_id_hash", "device_type").agg(_rows().alias("n"))


def cross_device_users(sessions: DataFrame, top: int = 20) -> DataFrame:
    """Users seen on more than one device class, most devices first, ties by user."""
    return (
        user_devices(sessions)
        .groupBy("user_id_hash")
        .agg(F.count("device_type").alias("n_device_types"), F.sum("n").alias("total_sessions"))
        .where(F.col("n_device_types") > 1)
        .orderBy(F.desc("n_device_types"), "user_id_hash")
        .limit(top)
    )


def category_sets(sessions: DataFrame, top: int = 20) -> DataFrame:
    """Most frequent category *lists* as JSON text."""
    return (
        sessions.groupBy(array_to_json("content_categories").alias("content_categories"))
        .agg(_rows().alias("n_sessions"))
        .orderBy(F.desc("n_sessions"), "content_categories")
        .limit(top)
    )


def top_categories(sessions: DataFrame, top: int = 20) -> DataFrame:
    """Most frequent single categories."""
    return (
        sessions.select(F.explode("content_categories").alias("category"))
        .groupBy("category")
        .agg(_rows().alias("n_sessions"))
        .orderBy(F.desc("n_sessions"), "category")
        .limit(top)
    )


def hourly_volume(sessions: DataFrame) -> DataFrame:
    return (
        sessions.groupBy("hour_of_day")
        .agg(_rows().alias("n_sessions"), round_half_up(F.avg("scroll_depth_avg"), 3).alias("avg_scroll"))
        .orderBy("hour_of_day")
    )


def segment_overview(enriched: DataFrame, sessions: DataFrame, segments: DataFrame) -> DataFrame:
    """Behaviour per segment with its label.

    Sessions are aggregated per segment before the label join, so the labels meet one row
    per segment instead of every session.
    """
    placed = enriched.select("session_id", "segment_id").join(sessions, "session_id")
    sizes = placed.groupBy("segment_id").agg(
        _rows().alias("n_sessions"),
        round_half_up(F.avg("scroll_depth_avg"), 3).alias("avg_scroll"),
        round_half_up(F.avg("session_duration_s"), 1).alias("avg_duration_s"),
        round_half_up(F.lit(100.0) * F.count_if(F.col("device_type") == "mobile") / _rows(), 6).alias("pct_mobile"),
    )
    return (
        sizes.join(segments.select("segment_id", "segment_label"), "segment_id")
        .select("segment_id", "segment_label", "n_sessions", "avg_scroll", "avg_duration_s", "pct_mobile")
        .orderBy(F.desc("n_sessions"), "segment_id")
    )


def match_rate_by_devices(pairs: DataFrame, sessions: DataFrame, split: str = "test") -> DataFrame:
    """Predicted match rate per ordered device pair on one split."""
    devices = sessions.select("session_id", "device_type")
    dev_a = devices.select(F.col("session_id").alias("session_id_a"), F.col("device_type").alias("device_a"))
    dev_b = devices.select(F.col("session_id").alias("session_id_b"), F.col("device_type").alias("device_b"))
    return (
        pairs.where(F.col("split") == split)
        .select("session_id_a", "session_id_b", "predicted_label")
        .join(dev_a, "session_id_a")
        .join(dev_b, "session_id_b")
        .groupBy("device_a", "device_b")
        .agg(_rows().alias("n_pairs"), F.sum("predicted_label").alias("n_matched"))
        .withColumn("match_rate_pct", round_half_up(F.lit(100.0) * F.col("n_matched") / F.col("n_pairs"), 2))
        .orderBy(F.desc("n_pairs"), "device_a", "device_b")
    )


def confident_pairs(pairs: DataFrame, above: float = 0.80, top: int = 50) -> DataFrame:
    """Predicted matches with probability strictly above the bound, best first, ties by ids."""
    return (
        pairs.where((F.col("predicted_label") == 1) & (F.col("probability") > F.lit(float(above))))
        .orderBy(F.desc("probability"), "session_id_a", "session_id_b")
        .limit(top)
        .select("session_id_a", "session_id_b", round_half_up("probability", 4).alias("match_probability"))
    )


def diverse_users(sessions: DataFrame, top: int = 20) -> DataFrame:
    """Users by number of device classes, then sessions, ties by user."""
    return (
        sessions.groupBy("user_id_hash")
        .agg(
            F.countDistinct("device_type").alias("devices"),
            _rows().alias("sessions"),
            round_half_up(F.avg("scroll_depth_avg"), 3).alias("avg_scroll"),
            round_half_up(F.avg("session_duration_s"), 0).alias("avg_duration"),
        )
        .orderBy(F.desc("devices"), F.desc("sessions"), "user_id_hash")
        .limit(top)
    )


# -- report aggregates ---------------------------------------------------------------


def kpi_row(sessions: DataFrame, segments: DataFrame) -> DataFrame:
    """One row: sessions, unique users, segments."""
    return sessions.agg(
        _rows().alias("total_sessions"), F.countDistinct("user_id_hash").alias("unique_users")
    ).withColumn("n_segments", segments.agg(_rows()).scalar())


def device_distribution(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("device_type").agg(_rows().alias("n_sessions")).orderBy(F.desc("n_sessions"), "device_type")


def hourly_by_device(sessions: DataFrame) -> DataFrame:
    return (
        sessions.groupBy("device_type", "hour_of_day")
        .agg(_rows().alias("n_sessions"))
        .orderBy("device_type", "hour_of_day")
    )


def users_by_device_count(sessions: DataFrame) -> DataFrame:
    """How many users use one, two or three device classes."""
    return (
        user_devices(sessions)
        .groupBy("user_id_hash")
        .agg(F.count("device_type").alias("devices_used"))
        .groupBy("devices_used")
        .agg(_rows().alias("users"))
        .orderBy("devices_used")
    )


def segments_by_size(segments: DataFrame) -> DataFrame:
    return segments.select("segment_id", "segment_label", "n_sessions", "pct_mobile").orderBy("n_sessions", "segment_id")


def segment_radar(segments: DataFrame, top: int = 5) -> DataFrame:
    """Largest segments with behaviour scaled to 0..1."""
    return (
        segments.orderBy(F.desc("n_sessions"), "segment_id")
        .limit(top)
        .select(
            "segment_id",
            "segment_label",
            scaled_share("avg_scroll_depth", 1.0).alias("scroll_depth"),
            scaled_share("avg_click_count", 30.0).alias("click_count"),
            scaled_share("avg_pages_visited", 15.0).alias("pages_per_session"),
        )
    )


# Display names of the segment table.
SEGMENT_TABLE_NAMES = {
    "segment_label": "Label",
    "n_sessions": "Sessions",
    "pct_of_total": "% of Total",
    "top_categories": "Top Categories",
    "pct_mobile": "% Mobile",
    "avg_session_duration_s": "Avg Duration (s)",
}


def segment_table(segments: DataFrame) -> DataFrame:
    return segments.select(*[F.col(c).alias(n) for c, n in SEGMENT_TABLE_NAMES.items()])


def scroll_box_stats(sessions: DataFrame, value: str = "scroll_depth_avg") -> DataFrame:
    """Minimum, exact quartiles (linear interpolation) and maximum per device.

    Values are folded to counts first; a 4-decimal share has at most 10,001 distinct
    values, which bounds what any one percentile aggregate holds.
    """
    counts = sessions.where(F.col(value).isNotNull()).groupBy("device_type", value).agg(_rows().alias("n"))
    boxes = counts.groupBy("device_type").agg(
        F.sum("n").alias("n_sessions"),
        F.min(value).alias("low"),
        F.percentile(value, [0.25, 0.5, 0.75], F.col("n")).alias("q"),
        F.max(value).alias("high"),
    )
    return boxes.select(
        "device_type",
        "n_sessions",
        round_half_up("low", 6).alias("min_value"),
        *[round_half_up(F.col("q")[i], 6).alias(name) for i, name in enumerate(["q1", "median", "q3"])],
        round_half_up("high", 6).alias("max_value"),
    )


def duration_histogram(sessions: DataFrame, bins: int = 50, value: str = "session_duration_s") -> DataFrame:
    """Equal-width bins over the whole range, counted per device; empty bins are absent."""
    low = sessions.agg(F.min(value)).scalar().cast("double")
    high = sessions.agg(F.max(value)).scalar().cast("double")
    ranged = sessions.where(F.col(value).isNotNull()).select(
        "device_type", F.col(value).cast("double").alias("v"), low.alias("low"), high.alias("high")
    )
    width = F.greatest((F.col("high") - F.col("low")) / F.lit(float(bins)), F.lit(1e-9))
    index = F.least(F.floor((F.col("v") - F.col("low")) / width), F.lit(bins - 1)).cast("int")
    return ranged.groupBy("device_type", index.alias("bin")).agg(_rows().alias("n_sessions"))


def scatter_sample(sessions: DataFrame, n: int = 3000, seed: int = 42) -> DataFrame:
    """Seeded sample of pages against clicks."""
    chosen = sample_rows(
        sessions.select("session_id", "device_type", "pages_visited", "click_count"), n, "session_id", seed, "scatter"
    )
    return chosen


# Columns of the session browser.
BROWSER_COLUMNS = [
    "session_id",
    "device_type",
    "os",
    "browser",
    "session_duration_s",
    "pages_visited",
    "click_count",
    "scroll_depth_avg",
    "content_categories",
    "segment_id",
]


def session_browser(
    sessions: DataFrame,
    n: int = 5000,
    condition: Column | str | None = None,
    order: list[Column | str] | None = None,
    after: str | None = None,
    page_size: int | None = None,
) -> DataFrame:
    """Up to n sessions with the display columns that exist, long category text shortened.

    ``condition`` applies to the whole table. The n shown are the first in ``order``, or a seeded
    sample without one. ``after`` continues behind a session id (keyset paging over all rows that
    match) and implies ordering by session id.
    """
    shown = sessions if condition is None else sessions.where(condition)
    if after is not None:
        shown = shown.where(F.col("session_id") > after).orderBy("session_id").limit(n)
    elif order:
        shown = shown.orderBy(*order).limit(n)
    else:
        shown = sample_rows(shown, n, "session_id", seed=0, tag="browse")
    shown = keep_columns(shown, BROWSER_COLUMNS)
    if "content_categories" in shown.columns:
        text = F.col("content_categories")
        if dict(shown.dtypes)["content_categories"] != "string":
            text = array_to_json(text)
        shown = shown.withColumn("content_categories", truncate(text, 40))
    return shown.limit(page_size) if page_size else shown
