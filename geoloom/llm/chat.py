"""Dialogues of several speakers, seen by each of them.

For every participant the whole dialogue is rendered with that participant's turns as the assistant's,
everybody else's as a named user's and system turns as they are. The result has one row per turn and
participant: the rendered segment, its place in the rendered dialogue, and the part to train on (the
assistant's content with its end mark). Joining a dialogue's segments by ``seq`` gives its text.

A dialogue may hold any share of all turns: rows are dealt out by ranges of their order, places are summed
within each range, and the sums of the ranges, few per dialogue, are added up afterwards. No dialogue is
gathered in one task.

Defined cases: null text and null role are empty; a null conv_id is a dialogue like any other; turns come in
the order of turn (null first), speaker and text, so repeated rows follow one another; marks inside a text
get a space so that they end nothing; a dialogue of system turns alone has no participant and no rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm import common

#: Marks of the chat format.
START, END = "<|im_start|>", "<|im_end|>"


def perspectives(conversations: DataFrame, speaker: str = "role", system: str = "system") -> DataFrame:
    """conv_id, participant, seq, turn, role, text, start, end, mask_start, mask_end (offsets in code points)."""
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col(speaker), F.lit("")).alias("speaker"),
        F.coalesce(F.col("text"), F.lit("")).alias("body"),
    )
    people = turns.filter(F.col("speaker") != system).select(
        F.col("conv_id").alias("of"), F.col("speaker").alias("participant")
    )
    # One row per participant, however many turns; the turns' side is split where a dialogue is large.
    seen = turns.join(people.distinct(), F.col("conv_id").eqNullSafe(F.col("of")))
    role = (
        F.when(F.col("speaker") == F.col("participant"), "assistant")
        .when(F.col("speaker") == system, "system")
        .otherwise("user")
    )
    name = F.concat(F.lit(" name="), F.regexp_replace("speaker", "[^A-Za-z0-9_-]", "_"))
    head = F.concat(F.lit(START), F.col("role"), F.when(F.col("role") == "user", name).otherwise(""), F.lit("\n"))
    body = F.regexp_replace("body", r"<\|(im_start|im_end)\|>", r"<| $1|>")
    rows = seen.withColumn("role", role).select(
        "conv_id", "participant", "turn", "speaker", "body", "role", head.alias("head"), F.concat(body, F.lit(END)).alias("content")
    )
    order = ["conv_id", "participant", "turn", "speaker", "body"]
    dealt = rows.repartitionByRange(common.partitions(conversations.sparkSession), *order, F.xxhash64(F.rand(11)))
    dealt = common.stored(dealt.withColumn("part", F.spark_partition_id()), "turns")
    size = F.length("head") + F.length("content") + 1
    dialogue = ["conv_id", "participant"]
    sums = dealt.groupBy(*dialogue, "part").agg(F.sum(size).alias("size"), F.count("*").alias("turns"))
    before = Window.partitionBy(*dialogue).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv_id").alias("of"),
        F.col("participant").alias("by"),
        F.col("part").alias("in"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("turns_before"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("participant") == F.col("by")) & (F.col("part") == F.col("in"))
    here = Window.partitionBy(*dialogue, "part").orderBy(*order[2:])
    ahead = here.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        dealt.withColumn("nth", F.row_number().over(here))
        .withColumn("offset", F.coalesce(F.sum(size).over(ahead), F.lit(0)))
        .join(sums, same)
        .withColumn("start", F.col("offset") + F.col("size_before"))
    )
    trained = F.col("role") == "assistant"
    body_start = F.col("start") + F.length("head")
    return placed.select(
        "conv_id",
        "participant",
        (F.col("nth") + F.col("turns_before")).alias("seq"),
        "turn",
        "role",
        F.concat("head", "content", F.lit("\n")).alias("text"),
        "start",
        (F.col("start") + size).alias("end"),
        F.when(trained, body_start).alias("mask_start"),
        F.when(trained, body_start + F.length("content")).alias("mask_end"),
    )
