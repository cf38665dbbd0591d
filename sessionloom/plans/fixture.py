"""Sessions in the raw contract for the driver's event table, which has no device, network or topic.

Those attributes are made here from user and event numbers, so that the operators have columns to
work on. The session cut, counts and times come from the events (``sources.events``). A deployment
brings its own sessions and never imports this module.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip, round_half_up
from ..functions.privacy import device_fingerprint_hash, sha256_hex, user_agent_hash
from ..functions.text import title_list
from ..sources.events import INTERESTS, SESSION_GAP_US, session_measures

# Fixed values of the made-up attributes.
TOPICS = [
    "astronomy", "baking", "board_games", "chess", "cycling", "gardening", "hiking", "jazz",
    "knitting", "local_history", "marine_life", "pottery", "robotics", "theatre", "woodwork",
]
SYSTEMS = {"mobile": ["Pocket", "Handset"], "desktop": ["Deskway", "Bench", "Atelier"], "tablet": ["Pocket", "Slate"]}
BROWSERS = {"mobile": ["Wren", "Finch", "Swift"], "desktop": ["Wren", "Heron", "Kite", "Crane"], "tablet": ["Finch", "Heron"]}


def _pick(values: list[str], index: Column) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def _per_device(device: Column, table: dict[str, list[str]], index: Column) -> Column:
    first, *rest = table.items()
    start = F.when(device == first[0], _pick(first[1], index))
    return reduce(lambda acc, item: acc.when(device == item[0], _pick(item[1], index)), rest, start)


def _device(user: Column, index: Column) -> Column:
    """Ten in twenty mobile, seven desktop, three tablet; of five users one has phones only, one no tablet."""
    kind = F.pmod(user, F.lit(5))
    slot = F.when(kind == 0, F.lit(0)).when(kind == 1, F.pmod(index, F.lit(17))).otherwise(F.pmod(index, F.lit(20)))
    return F.when(slot < 10, "mobile").when(slot < 17, "desktop").otherwise("tablet")


def sessions_from_events(events: DataFrame, gap_us: int = SESSION_GAP_US) -> DataFrame:
    """One row per session, in the raw sessions contract plus ``first_event_id``."""
    user, eid, sno = F.col("user_id"), F.col("first_event_id"), F.col("sno")
    topic = _pick(TOPICS, user + F.col("interest"))
    title = F.concat_ws(" ", "event_type", F.replace(topic, F.lit("_"), F.lit(" ")))
    measured = session_measures(
        events,
        F.bit_or(F.expr("shiftleft(1, cast(interest AS int))")).alias("interests"),
        # a bounded set: at most INTERESTS titles per event type
        F.array_sort(F.collect_set(title)).alias("titles"),
        gap_us=gap_us,
    )
    topics = F.array_compact(
        F.array(*[F.when(F.col("interests").bitwiseAND(1 << i) != 0, _pick(TOPICS, user + i)) for i in range(INTERESTS)])
    )
    device, system, browser = F.col("device_type"), F.col("os"), F.col("browser")
    network_kind = F.pmod(eid, F.lit(10))
    network = F.when(network_kind < 6, F.pmod(user, F.lit(7))).when(network_kind < 9, F.lit(100)).otherwise(F.lit(200))
    return (
        measured.withColumn("device_type", _device(user, eid))
        .withColumn("os", _per_device(device, SYSTEMS, eid))
        .withColumn("browser", _per_device(device, BROWSERS, eid))
        .withColumn("real_user_id", F.concat(F.lit("user_"), user.cast("string")))
        .withColumn("ip_prefix", F.concat_ws(".", (F.pmod(user, F.lit(250)) + 1).cast("string"), network.cast("string")))
        .select(
            F.concat_ws("-", user.cast("string"), sno.cast("string")).alias("session_id"),
            "real_user_id",
            sha256_hex("real_user_id").alias("user_id_hash"),
            "device_type",
            "os",
            "browser",
            "ip_prefix",
            sha256_hex("ip_prefix").alias("ip_prefix_hash"),
            device_fingerprint_hash(F.col("real_user_id"), device, system, sno - 1).alias("device_fingerprint_hash"),
            user_agent_hash(browser, system).alias("user_agent_hash"),
            F.timestamp_micros("first_us").alias("session_start"),
            (F.lit(10) + 3 * F.col("sum_k")).alias("session_duration_s"),
            "pages_visited",
            "click_count",
            round_half_up(clip(F.col("max_k") / F.lit(99.0), 0.05, 1.0), 4).alias("scroll_depth_avg"),
            F.array_sort(topics).alias("content_categories"),
            title_list("titles").alias("interaction_text"),
            "active_hours_profile",
            "first_event_id",
        )
    )
