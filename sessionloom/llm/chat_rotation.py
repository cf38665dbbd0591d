"""Multi-party perspective rotation: every dialogue once for each participant.

In a participant's rendering their messages are the assistant's, all others' are named users', and
system messages stay system messages (the system takes no part). The mask holds the character spans
(start-end, end exclusive) of the participant's own texts, the only ones to learn from.

A dialogue of any length is rendered in parts of at most ``PART`` turns (turns 0 to 63, 64 to 127,
...); parts put together in order are the whole rendering, so no task ever holds a whole dialogue.

Defined results: messages are ordered by turn, role, text; equal messages on one turn count once; null
text is empty; a null role is the participant ``unknown``; a message without a turn is a part of its
own with null number; a message without a conv_id is a dialogue of its own. A dialogue without
participants, and an empty table, give no row. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = 64
SYSTEM = "system"
END = "<|end|>\n"


def opening(role: Column, speaker: Column) -> Column:
    """Header line of a message seen by ``speaker``."""
    return (
        F.when(role == speaker, F.lit("<|assistant|>\n"))
        .when(role == SYSTEM, F.lit("<|system|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), role, F.lit("|>\n")))
    )


def perspectives(turns: DataFrame, part: int = PART) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` -> conv_id, speaker, part, n_messages, rendered, mask, n_masked."""
    said = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    alone = F.xxhash64("role", "text")
    keyed = said.select(
        "*",
        F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text")).otherwise(0).alias("_row"),
        F.floor(F.col("turn") / part).cast("bigint").alias("part"),
        F.when(F.col("turn").isNull(), alone).otherwise(0).alias("_alone"),
    ).withColumn("_conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")))
    speakers = keyed.where(F.col("role") != SYSTEM).select("_conv", "_row", F.col("role").alias("speaker")).distinct()
    seen = keyed.join(speakers, ["_conv", "_row"])
    message = F.struct("turn", "role", "text")
    grouped = seen.groupBy("_conv", "_row", "conv_id", "speaker", "part", "_alone").agg(
        F.sort_array(F.collect_set(message)).alias("m")
    )
    speaker = F.col("speaker")
    shown = grouped.withColumn(
        "shown",
        F.transform(
            "m",
            lambda x: F.struct(
                F.concat(opening(x.role, speaker), x.text, F.lit("\n" + END)).alias("all"),
                F.length(opening(x.role, speaker)).alias("before"),
                F.length(x.text).alias("own"),
                (x.role == speaker).alias("mine"),
            ),
        ),
    )
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("mask"), F.lit(0).alias("n"))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["before"]
        span = F.concat(start.cast("string"), F.lit("-"), (start + x["own"]).cast("string"))
        mask = F.when(x["mine"], F.concat(state["mask"], F.when(state["mask"] != "", ",").otherwise(""), span)).otherwise(state["mask"])
        return F.struct(
            (state["at"] + F.length(x["all"])).alias("at"),
            mask.alias("mask"),
            (state["n"] + F.when(x["mine"], x["own"]).otherwise(0)).alias("n"),
        )

    return shown.withColumn("state", F.aggregate("shown", empty, add)).select(
        "conv_id",
        "speaker",
        "part",
        F.size("m").cast("bigint").alias("n_messages"),
        F.array_join(F.transform("shown", lambda x: x["all"]), "").alias("rendered"),
        F.col("state.mask").alias("mask"),
        F.col("state.n").cast("bigint").alias("n_masked"),
    )
