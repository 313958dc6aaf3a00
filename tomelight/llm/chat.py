"""Chat formatting by rotation of perspectives.

For every participant of a conversation the whole dialogue is rendered with that
participant as the assistant and all others as users with their names; system turns
stay system turns. Training targets are the contents of the assistant's turns, marked
by character spans.

A conversation is rendered in parts of ``TURNS`` consecutive turn numbers, so that a
very long one is many bounded rows; ``start`` places a part in the whole
rendering. Everything is column expressions; the only shuffles are by conversation and
part, with partial aggregation before them.

Defined results: a null role is the participant "unknown", a null text is empty, a
null turn comes before all others, as part -1; rows with a null conv_id make up one
conversation; turns with equal numbers are ordered by role and text and stand in one part, and
repeated rows are repeated turns; a conversation with only system turns has no participant and
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURNS = 64
SYSTEM = "system"
#: Fixed values of the format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    """A text in which no turn can begin or end."""
    return F.regexp_replace(text, r"<\|(im_start|im_end)\|>", "< |$1| >")


def rotate(turns: DataFrame, part_turns: int = TURNS) -> DataFrame:
    """conv_id, speaker, part, start, text, n_targets, spans: a row per perspective and part."""
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.regexp_replace("role", r"[\s<|>]+", "_"), F.lit("unknown")).alias("role"),
        escaped(F.coalesce("text", F.lit(""))).alias("text"),
    )
    part = F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long")
    said = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    parts = rows.groupBy("conv_id", part.alias("part")).agg(said.alias("said"))
    speakers = (
        rows.filter(F.col("role") != SYSTEM)
        .select("conv_id", F.col("role").alias("speaker"))
        .distinct()
        .select(F.col("conv_id").alias("_conv"), "speaker")
    )
    seen = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    def head(role: Column, speaker: Column) -> Column:
        name = F.when(role == SYSTEM, F.lit(SYSTEM)).when(role == speaker, F.lit("assistant"))
        return F.concat(F.lit(OPEN), F.coalesce(name, F.concat(F.lit("user name="), role)), F.lit("\n"))

    def rendered(speaker: Column) -> Column:
        return F.transform(
            F.col("said"),
            lambda t: F.struct(
                head(t["role"], speaker).alias("head"),
                t["text"].alias("text"),
                (t["role"] == speaker).alias("target"),
            ),
        )

    def spans(pieces: Column) -> Column:
        # Runs over the pieces with the length so far; targets add their span.
        zero = F.struct(
            F.lit(0).cast("int").alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("found")
        )

        def step(acc: Column, p: Column) -> Column:
            begin = acc["at"] + F.length(p["head"])
            end = begin + F.length(p["text"])
            found = F.when(
                p["target"],
                F.concat(acc["found"], F.array(F.struct(begin.alias("begin"), end.alias("end")))),
            ).otherwise(acc["found"])
            return F.struct((end + len(CLOSE)).alias("at"), found.alias("found"))

        return F.aggregate(pieces, zero, step, lambda acc: acc["found"])

    shown = seen.select("conv_id", "speaker", "part", F.inline(F.array(F.struct(rendered(F.col("speaker")).alias("pieces")))))
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"], F.lit(CLOSE))), "")
    made = shown.select(
        "conv_id", "speaker", "part", text.alias("text"), spans(F.col("pieces")).alias("spans")
    )
    order = Window.partitionBy("conv_id", "speaker").orderBy("part")
    before = F.sum(F.length("text").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return made.select(
        "conv_id",
        "speaker",
        "part",
        F.coalesce(before, F.lit(0)).cast("long").alias("start"),
        "text",
        F.size("spans").cast("long").alias("n_targets"),
        "spans",
    )
