"""Dialogues from the perspective of every participant.

For each speaker of a conversation the whole dialogue is rendered with that speaker as the assistant and
everyone else as a named user; the mask marks what the assistant writes. System turns stay system turns in all
perspectives. A conversation is cut into parts of ``PART_TURNS`` turns, so no row and no task holds
a long conversation whole; the positions of its turns come from ranges, not from one window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.text import fresh, numbered

PART_TURNS = 256
SYSTEM = ("system",)
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
NOBODY = "unknown"


def _plain(text):
    """A text that cannot be taken for the marks of a turn."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _name(role):
    """A role that stays in its line of the turn's head: line breaks become spaces."""
    return F.translate(_plain(F.coalesce(role, F.lit(NOBODY))), "\n\r", "  ")


def perspectives(
    turns: DataFrame, system: Sequence[str] = SYSTEM, part_turns: int = PART_TURNS
) -> DataFrame:
    """(conv_id, speaker, part, n_turns, n_masked, text, mask) of every participant of every conversation.

    Turns are in the order of turn, role and text; equal turns are all kept. ``mask`` has the ranges
    [start, end) of the part's text, in code points, that the speaker wrote, each with its closing mark.
    A NULL role speaks as "unknown", a line break in a role is a space; a NULL text is empty; a NULL turn comes first; turns with a NULL conv_id are
    one conversation. A conversation of system turns alone has no participant and gives no row. Other columns
    are ignored; an empty table gives an empty result.
    """
    rows = turns.select(
        "conv_id", "turn", _name(F.col("role")).alias("role"), _plain(F.col("text")).alias("text")
    )
    place = fresh(rows, "__place")
    placed = numbered(rows, ["conv_id"], ["turn", "role", "text"], place).withColumn(
        "part", F.floor(F.col(place) / part_turns).cast("long")
    )
    is_system = F.col("role").isin(list(system))
    speakers = rows.where(~is_system).select(F.col("conv_id").alias("__conv"), F.col("role").alias("speaker")).distinct()
    seen = placed.join(speakers, F.col("conv_id").eqNullSafe(F.col("__conv")))
    masked = F.col("role") == F.col("speaker")
    head = F.concat(
        F.lit(OPEN),
        F.when(is_system, F.lit("system")).when(masked, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), "role")),
        F.lit("\n"),
    )
    body = F.concat("text", F.lit(CLOSE))
    parts = seen.groupBy("conv_id", "speaker", "part").agg(
        # at most part_turns of them
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col(place).alias("place"),
                    head.alias("head"),
                    body.alias("body"),
                    (masked & ~is_system).alias("masked"),
                )
            )
        ).alias("turns")
    )
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))

    def step(state, t):
        start = state["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        here = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (end + 1).alias("at"), F.when(t["masked"], F.concat(state["mask"], here)).otherwise(state["mask"]).alias("mask")
        )

    return parts.select(
        "conv_id",
        "speaker",
        "part",
        F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("turns", lambda t: t["masked"])).cast("long").alias("n_masked"),
        F.concat(F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"])), "\n"), F.lit("\n")).alias("text"),
        F.aggregate("turns", nothing, step)["mask"].alias("mask"),
    )


def perspective_table(turns: DataFrame) -> DataFrame:
    """The perspectives with the mask as text, start:end comma-joined.

    NULLs, empty tables, repeated rows and extra columns are treated as in ``perspectives``; an empty mask is "".
    """
    mask = F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")))
    return perspectives(turns).withColumn("mask", F.array_join(mask, ","))


ORACLE_PERSPECTIVES = """
WITH plain AS (
  SELECT conv_id, turn, translate(replace(coalesce(role, 'unknown'), '<|', '< |'), chr(10) || chr(13), '  ') AS role,
    replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM plain),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM plain WHERE role <> 'system'),
rendered AS (
  SELECT p.conv_id, s.speaker, p.place // 256 AS part, p.place, p.role = s.speaker AS masked,
    '<|im_start|>' || CASE WHEN p.role = 'system' THEN 'system' WHEN p.role = s.speaker THEN 'assistant'
      ELSE 'user name=' || p.role END || chr(10) AS head,
    p.text || '<|im_end|>' AS body
  FROM placed p JOIN speakers s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
spread AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker, part ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start_at
  FROM rendered)
SELECT conv_id, speaker, part, count(*) AS n_turns, count(*) FILTER (WHERE masked) AS n_masked,
  string_agg(head || body, chr(10) ORDER BY place) || chr(10) AS text,
  coalesce(string_agg(CAST(start_at AS BIGINT) || ':' || CAST(start_at + length(body) AS BIGINT), ',' ORDER BY place)
    FILTER (WHERE masked), '') AS mask
FROM spread GROUP BY conv_id, speaker, part
"""
