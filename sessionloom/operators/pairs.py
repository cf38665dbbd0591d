"""Session pairs: sampling, exact stratified split and the 16 pair features."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numeric import flag, round_half_up
from ..functions.sampling import hash_key, hash_number
from ..functions.vectors import cosine, jaccard, l2_norm, shared_count
from ..schemas import DEVICE_PAIR_CODES, FEATURE_COLS, UNKNOWN_CODE
from ..session import materialised
from .features import fill_features
from .ranking import rank_by_hash

# Sessions per group in which neighbours are paired up.
_GROUP_ROWS = 2048
_US_PER_HOUR = 3.6e9
HOURS = 24

PAIR_KEYS = ["label", "draw", "session_id_a", "session_id_b"]


def user_session_counts(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("user_id_hash").agg(F.count(F.lit(1)).alias("n_sessions"))


def eligible_users(sessions: DataFrame, at_least: int = 2) -> DataFrame:
    """Users with enough sessions to form a pair."""
    return user_session_counts(sessions).where(F.col("n_sessions") >= at_least)


def positive_pairs(sessions: DataFrame, n_per_user: int = 3, seed: int = 42) -> DataFrame:
    """``n_per_user`` independent draws of two distinct sessions of each user.

    Under a random hash order the (first, last) sessions are a uniformly random ordered
    pair, so one min and one max per draw do it. Both combine map-side: a user holding
    a third of all sessions costs no more than any other.
    """
    draws = range(n_per_user)
    keyed = sessions.select(
        "user_id_hash",
        "session_id",
        *[F.struct(hash_key("pos", seed, d, F.col("session_id")).alias("h"), "session_id").alias(f"k{d}") for d in draws],
    )
    ends = keyed.groupBy("user_id_hash").agg(
        *[F.min(f"k{d}").alias(f"lo{d}") for d in draws], *[F.max(f"k{d}").alias(f"hi{d}") for d in draws]
    )
    drawn = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(d).alias("draw"),
                    F.col(f"lo{d}.session_id").alias("session_id_a"),
                    F.col(f"hi{d}.session_id").alias("session_id_b"),
                )
                for d in draws
            ]
        )
    )
    return (
        ends.select(drawn.alias("p"))
        .select("p.session_id_a", "p.session_id_b", F.lit(1).alias("label"), "p.draw")
        .where(F.col("session_id_a") != F.col("session_id_b"))
    )


def sampling_plan(sessions: DataFrame, n_per_user: int, ratio: float) -> dict[str, int]:
    """Sizes for the negative sampler from one aggregate row: wanted pairs, draws and groups."""
    n = F.col("n_sessions")
    row = user_session_counts(sessions).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("sessions"),
        F.count_if(n >= 2).alias("users"),
        F.coalesce(F.sum(n.cast("double") * n.cast("double")), F.lit(0.0)).alias("same"),
    ).first()
    total = int(row["sessions"])
    wanted = int(row["users"] * n_per_user * ratio)
    if total < 2 or wanted == 0:
        return {"wanted": wanted, "draws": 0, "groups": 1}
    groups = max(1, total // _GROUP_ROWS)
    accepted = 1.0 - float(row["same"]) / (float(total) * float(total))
    per_draw = max(total - groups, 1)
    draws = math.ceil(1.25 * wanted / (per_draw * accepted)) + 1 if accepted > 0 else 0
    return {"wanted": wanted, "draws": draws, "groups": groups}


def negative_candidates(sessions: DataFrame, draws: range, groups: int, seed: int = 42) -> DataFrame:
    """Random session pairs of different users.

    Per draw every session lands in a random, evenly filled group and is paired with its
    neighbour in hash order, so candidates cost one shuffle and no cross join.
    """
    numbers = F.sequence(F.lit(draws.start), F.lit(draws.stop - 1))
    replicated = sessions.select("session_id", "user_id_hash", F.explode(numbers).alias("draw")).withColumn(
        "h", hash_key("neg", seed, F.col("draw"), F.col("session_id"))
    )
    grouped = replicated.withColumn("g", F.pmod(hash_number("h"), F.lit(groups)))
    order = W.partitionBy("draw", "g").orderBy("h", "session_id")
    return (
        grouped.withColumn("session_id_b", F.lead("session_id").over(order))
        .withColumn("user_b", F.lead("user_id_hash").over(order))
        .where(F.col("user_b").isNotNull() & (F.col("user_id_hash") != F.col("user_b")))
        .select(F.col("session_id").alias("session_id_a"), "session_id_b", F.lit(0).alias("label"), "draw")
    )


def _accepted_candidates(sessions: DataFrame, plan: dict[str, int], seed: int) -> DataFrame:
    """At least the wanted number of candidates, whatever the size of the table.

    The first draws are planned from the acceptance rate. Their pairs are written and counted; while
    they are too few, as many draws again are added. Two users are enough for every draw to have a
    chance, so this ends.
    """
    draws = range(plan["draws"])
    found = materialised(negative_candidates(sessions, draws, plan["groups"], seed), "negatives")
    while found.count() < plan["wanted"]:
        draws = range(draws.stop, 2 * draws.stop)
        more = materialised(negative_candidates(sessions, draws, plan["groups"], seed), "negatives")
        found = found.unionByName(more)
    return found


def negative_pairs(
    sessions: DataFrame, n_per_user: int = 3, ratio: float = 1.5, seed: int = 42, plan: dict[str, int] | None = None
) -> DataFrame:
    """Exactly ``int(positives * ratio)`` different-user pairs; none if all sessions are one user's."""
    plan = plan or sampling_plan(sessions, n_per_user, ratio)
    if plan["draws"] == 0:
        return positive_pairs(sessions, 1, seed).where(F.lit(False))
    candidates = _accepted_candidates(sessions, plan, seed).withColumn(
        "_key", hash_key("pick", seed, F.col("draw"), F.col("session_id_a"), F.col("session_id_b"))
    )
    kept = rank_by_hash(candidates, "_key", ["session_id_a", "session_id_b"], first=plan["wanted"], rank="_rank")
    return kept.drop("_key", "_rank")


def negative_shortfall(
    sessions: DataFrame, n_per_user: int = 3, ratio: float = 1.5, seed: int = 42
) -> DataFrame:
    """One row: negatives wanted and found. They differ only where one user owns every session."""
    plan = sampling_plan(sessions, n_per_user, ratio)
    pairs = negative_pairs(sessions, n_per_user, ratio, seed, plan)
    return pairs.agg(F.lit(plan["wanted"]).cast("bigint").alias("wanted"), F.count(F.lit(1)).alias("found"))


def sample_pairs(
    sessions: DataFrame, n_pos_per_user: int = 3, neg_pos_ratio: float = 1.5, seed: int = 42
) -> DataFrame:
    """Labelled pairs: same-user draws and different-user draws in the given ratio.

    Columns ``session_id_a, session_id_b, label, draw``. The seed fixes the result on any
    cluster size; row order carries no meaning.
    """
    return positive_pairs(sessions, n_pos_per_user, seed).unionByName(
        negative_pairs(sessions, n_pos_per_user, neg_pos_ratio, seed)
    )


def _pair_hash(tag: str, seed: int) -> Column:
    return hash_key(tag, seed, *[F.col(c) for c in ("draw", "session_id_a", "session_id_b")])


def number_pairs(pairs: DataFrame, seed: int = 42) -> DataFrame:
    """Add ``pair_id`` 1..n in seeded hash order."""
    keyed = pairs.withColumn("_key", _pair_hash("pair", seed))
    ranked = rank_by_hash(keyed, "_key", PAIR_KEYS, rank="pair_id")
    return ranked.drop("_key")


def stratified_split(pairs: DataFrame, test_size: float = 0.20, seed: int = 42) -> DataFrame:
    """Add ``split`` = train | test with the exact test share per label (rounded half-up)."""
    keyed = pairs.withColumn("_key", _pair_hash("split", seed))
    ranked = rank_by_hash(keyed, "_key", PAIR_KEYS, by=["label"], rank="_rank")
    sizes = pairs.groupBy("label").agg(
        F.floor(F.count(F.lit(1)) * F.lit(float(test_size)) + F.lit(0.5)).alias("_n_test")
    )
    return (
        ranked.join(F.broadcast(sizes), "label")  # one row per label
        .withColumn("split", F.when(F.col("_rank") <= F.col("_n_test"), "test").otherwise("train"))
        .select(*pairs.columns, "split")
    )


_SESSION_SIDE = [
    "ip_prefix_hash",
    "device_fingerprint_hash",
    "device_type",
    "session_start",
    "hour_of_day",
    "day_of_week",
    "active_hours_profile",
    "click_rate",
    "scroll_depth_avg",
    "pages_per_minute",
    "session_duration_s",
    "content_categories",
]


def pair_side(sessions: DataFrame) -> DataFrame:
    """The session columns a pair needs, packed in one struct with the histogram norm precomputed."""
    return sessions.select(
        "session_id",
        F.struct(*_SESSION_SIDE, l2_norm("active_hours_profile", HOURS).alias("hours_norm")).alias("s"),
    )


def device_pair_code(a: Column, b: Column) -> Column:
    """Code of the unordered device pair, -1 when a device is unknown."""
    code = F
    for name, value in DEVICE_PAIR_CODES.items():
        first, second = name.split("-")
        if first == "same":
            match = (a == second) & (b == second)
        else:
            match = ((a == first) & (b == second)) | ((a == second) & (b == first))
        code = code.when(match, value)
    return code.otherwise(UNKNOWN_CODE)


def pair_feature_columns(a: str, b: str) -> dict[str, Column]:
    """The 16 features of two session structs, keyed and ordered as the model expects."""

    def both(name: str) -> tuple[Column, Column]:
        return F.col(f"{a}.{name}"), F.col(f"{b}.{name}")

    def same(name: str) -> Column:
        left, right = both(name)
        return flag(left == right)

    def gap(name: str) -> Column:
        left, right = both(name)
        return F.abs(left - right)

    dev_a, dev_b = both("device_type")
    start_a, start_b = both("session_start")
    hours = F.abs(F.unix_micros(start_a) - F.unix_micros(start_b)) / F.lit(_US_PER_HOUR)
    dur_a, dur_b = (c.cast("double") for c in both("session_duration_s"))
    cats = both("content_categories")
    columns = {
        "ip_prefix_match": same("ip_prefix_hash"),
        "device_fp_match": same("device_fingerprint_hash"),
        "device_type_same": flag(dev_a == dev_b),
        "device_pair_enc": device_pair_code(dev_a, dev_b),
        "is_cross_device": flag(dev_a != dev_b),
        "time_delta_hours": round_half_up(hours, 2),
        "time_delta_days": round_half_up(hours / F.lit(24.0), 3),
        "same_hour_of_day": same("hour_of_day"),
        "same_day_of_week": same("day_of_week"),
        "active_hours_cosine": round_half_up(
            cosine(*both("active_hours_profile"), *both("hours_norm"), HOURS), 6
        ),
        "click_rate_diff": gap("click_rate"),
        "scroll_depth_diff": gap("scroll_depth_avg"),
        "pages_diff": gap("pages_per_minute"),
        "duration_ratio": F.least(dur_a, dur_b) / F.greatest(dur_a, dur_b, F.lit(1.0)),
        "content_jaccard": round_half_up(jaccard(*cats), 6),
        "n_shared_categories": shared_count(*cats),
    }
    return {name: columns[name] for name in FEATURE_COLS}


def join_sides(pairs: DataFrame, side: DataFrame) -> DataFrame:
    """Attach the packed session of both ends as ``a`` and ``b`` (two equi-joins on a unique key)."""
    left = side.select(F.col("session_id").alias("session_id_a"), F.col("s").alias("a"))
    right = side.select(F.col("session_id").alias("session_id_b"), F.col("s").alias("b"))
    return pairs.join(left, "session_id_a").join(right, "session_id_b")


def build_pair_features(pairs: DataFrame, sessions: DataFrame) -> DataFrame:
    """All columns of ``pairs`` plus the 16 features; pairs whose ids are missing drop out.

    Use :func:`pair_integrity` to count such ids first.
    """
    joined = join_sides(pairs, pair_side(sessions))
    return joined.select(*pairs.columns, *[c.alias(n) for n, c in pair_feature_columns("a", "b").items()])


def build_feature_matrix(pairs: DataFrame, sessions: DataFrame) -> DataFrame:
    """Model input: pairs with null-free features, label kept in the row."""
    return fill_features(build_pair_features(pairs, sessions))


def pair_integrity(pairs: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row: pairs, ids of either side without a session, session ids that are not unique."""
    known = sessions.groupBy("session_id").agg(F.count(F.lit(1)).alias("copies"))
    ends = pairs.select(
        F.explode(
            F.array(
                F.struct(F.lit("a").alias("side"), F.col("session_id_a").alias("session_id")),
                F.struct(F.lit("b").alias("side"), F.col("session_id_b").alias("session_id")),
            )
        ).alias("e")
    ).select("e.side", "e.session_id")
    return (
        ends.join(known, "session_id", "left")
        .agg(
            F.count_if(F.col("side") == "a").alias("n_pairs"),
            F.count_if((F.col("side") == "a") & F.col("copies").isNull()).alias("missing_a"),
            F.count_if((F.col("side") == "b") & F.col("copies").isNull()).alias("missing_b"),
            F.count_if(F.coalesce(F.col("copies"), F.lit(1)) > 1).alias("ambiguous_ends"),
        )
    )


def checked_pairs(pairs: DataFrame, sessions: DataFrame) -> DataFrame:
    """Every pair once, with ``unknown_session`` (an end names no session) and ``ambiguous_session``
    (an end names several)."""
    copies = sessions.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    ends = [copies.select(F.col("session_id").alias(f"session_id_{e}"), F.col("n").alias(f"_n_{e}")) for e in "ab"]
    met = pairs.join(ends[0], "session_id_a", "left").join(ends[1], "session_id_b", "left")
    return met.select(
        *pairs.columns,
        (F.col("_n_a").isNull() | F.col("_n_b").isNull()).alias("unknown_session"),
        (F.coalesce("_n_a", F.lit(1)) + F.coalesce("_n_b", F.lit(1)) > 2).alias("ambiguous_session"),
    )


def require_known_sessions(pairs: DataFrame, sessions: DataFrame) -> None:
    """Raise KeyError when a pair names a session that is missing or not unique."""
    found = pair_integrity(pairs, sessions).first()
    if found["missing_a"] or found["missing_b"] or found["ambiguous_ends"]:
        raise KeyError(f"unusable session ids in pairs: {found.asDict()}")
