"""Sessions cut from a raw event stream table by inactivity gap.

Skew: one user may own a third of all events, so events are first folded into
(user, hour, event type, interest) cells with map-side combining. An hour is
shorter than the inactivity gap, so a cell never spans two sessions, and the
number of cells per user is bounded by the time range (hours x event types x
interests), however many events the user has. Only cells reach the per-user window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

HOUR_US = 3_600_000_000
SESSION_GAP_US = 6 * HOUR_US
INTERESTS = 4


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def event_cells(events: DataFrame) -> DataFrame:
    """Fold events into (user, hour, type, interest) cells; every measure combines map-side."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").cast("long")
    return (
        events.select("user_id", "event_id", "event_type", micros.alias("us"), k.alias("k"))
        .groupBy(
            "user_id",
            F.floor(F.col("us") / F.lit(HOUR_US)).alias("hour_slot"),
            "event_type",
            F.pmod("k", F.lit(INTERESTS)).alias("interest"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("k").alias("sum_k"),
            F.max("k").alias("max_k"),
            F.min("event_id").alias("first_event_id"),
            F.min("us").alias("first_us"),
            F.max("us").alias("last_us"),
        )
    )


def numbered_cells(events: DataFrame, gap_us: int = SESSION_GAP_US) -> DataFrame:
    """The cells with ``sno``, the number of their session within the user, from 1."""
    if gap_us < HOUR_US:
        raise ValueError("the inactivity gap must be at least one hour")
    ordered = W.partitionBy("user_id").orderBy("first_us", "first_event_id")
    previous_end = F.max("last_us").over(ordered.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(F.col("first_us") - previous_end <= gap_us, 0).otherwise(1)
    return (
        event_cells(events)
        .withColumn("opens", opens)
        .withColumn("sno", F.sum("opens").over(ordered.rowsBetween(W.unboundedPreceding, 0)))
        .drop("opens")
    )


def hour_counts(hour: Column, n: Column) -> list[Column]:
    """24 sums of ``n`` by hour of day, named h0 .. h23."""
    return [F.sum(F.when(hour == h, n).otherwise(0)).alias(f"h{h}") for h in range(24)]


def session_measures(events: DataFrame, *extra: Column, gap_us: int = SESSION_GAP_US) -> DataFrame:
    """One row per session with its counts, first event and times, and its user's activity histogram.

    One scan of the events and two shuffles of cells: the fold, and one by user that serves the gap
    window, the session aggregate and the histogram, whose sums over the user's sessions a query
    that does not read it loses altogether. ``extra`` are further aggregates of the cells.
    """
    sessions = numbered_cells(events, gap_us).groupBy("user_id", "sno").agg(
        F.sum("n").alias("pages_visited"),
        F.sum("sum_k").alias("sum_k"),
        F.max("max_k").alias("max_k"),
        F.min("first_event_id").alias("first_event_id"),
        F.min("first_us").alias("first_us"),
        F.sum(F.when(F.col("event_type") == "click", F.col("n")).otherwise(0)).alias("click_count"),
        *extra,
        *hour_counts(F.pmod("hour_slot", F.lit(24)), F.col("n")),
    )
    user = W.partitionBy("user_id")
    total = F.sum("pages_visited").over(user)
    profile = F.array(*[F.sum(f"h{h}").over(user) / total for h in range(24)])
    return sessions.withColumn("active_hours_profile", profile).drop(*[f"h{h}" for h in range(24)])


def activity_histogram(events: DataFrame, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Share of each user's events per hour of day: 24 doubles that sum to 1."""
    per_hour = events.groupBy(user, F.hour(F.col(ts)).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    folded = per_hour.groupBy(user).agg(F.sum("n").alias("total"), *hour_counts(F.col("hour"), F.col("n")))
    return folded.select(
        user, F.array(*[F.col(f"h{h}") / F.col("total") for h in range(24)]).alias("active_hours_profile")
    )
