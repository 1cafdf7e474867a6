"""Multi-party chat formatting by perspective rotation.

Every participant of a conversation (a distinct speaker other than the system) is taken as the assistant once: the
turns of that speaker become assistant turns and carry the training mask, all others become named user turns, the
system's turns stay. A conversation of any length is rendered in pieces of PIECE turns each, so no task gathers an
unbounded conversation, whatever its turns' numbers; the pieces of a perspective, in order, are the dialogue. The
place of a turn is counted over ranges of (conversation, turn), several of which a long conversation fills. Markers that a text
contains are escaped reversibly: "<|" becomes "<\\|", and "<\\|" becomes "<\\\\|". In a speaker's name a backslash is
doubled before that, and a line end becomes a backslash and "n", so that no name can forge a header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.operators.order import numbered

#: Turns in one piece.
PIECE = 64
SYSTEM = "system"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_name(name: Column) -> Column:
    return escaped(F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """(conv, speaker, piece, n_turns, text, mask_starts, mask_ends) for each participant and piece.

    text is the rendered piece; mask_starts and mask_ends are the half-open character ranges, within it, of what the
    assistant says, its end marker included. Turns are ordered by turn number, then speaker, then text.

    Defined results: a null turn number sorts first, then negative ones; a null speaker is the participant "unknown"; a
    null text is empty; repeated rows are repeated turns; a
    conversation of system turns only, and an empty table, give no rows. Turns without a conversation are those of
    the conversation null.
    """
    who = F.coalesce(F.col(speaker), F.lit("unknown"))
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), who.alias("who"), F.coalesce(F.col(text), F.lit("")).alias("said"))
    rows, _ = numbered(rows, ["conv"], ["turn", "who", "said"], "place")
    rows = rows.withColumn("piece", F.floor(F.col("place") / PIECE).cast("long"))
    people = rows.where(F.col("who") != SYSTEM).select(F.col("conv").alias("owner"), F.col("who").alias("speaker")).distinct()
    pieces = rows.groupBy("conv", "piece").agg(F.array_sort(F.collect_list(F.struct("turn", "who", "said"))).alias("turns"))
    both = pieces.join(people, F.col("conv").eqNullSafe(F.col("owner")))

    def head(t: Column) -> Column:
        named = F.concat(F.lit("user name="), escaped_name(t["who"]))
        return F.concat(F.lit("<|start|>"), F.when(t["who"] == SYSTEM, SYSTEM).when(t["who"] == F.col("speaker"), "assistant").otherwise(named), F.lit("\n"))

    parts = F.transform("turns", lambda t: F.struct((t["who"] == F.col("speaker")).alias("own"), head(t).alias("head"), F.concat(escaped(t["said"]), F.lit("<|end|>")).alias("body")))
    shown = both.select("conv", "speaker", "piece", parts.alias("parts"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"), F.array().cast("array<int>").alias("ends"))

    def step(s: Column, p: Column) -> Column:
        begin = s["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        return F.struct(
            (end + 1).alias("at"),
            F.when(p["own"], F.concat(s["starts"], F.array(begin))).otherwise(s["starts"]).alias("starts"),
            F.when(p["own"], F.concat(s["ends"], F.array(end))).otherwise(s["ends"]).alias("ends"),
        )

    mask = F.aggregate("parts", start, step)
    shown = shown.select(
        "conv", "speaker", "piece", F.size("parts").cast("long").alias("n_turns"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("shown"), mask.alias("mask"),
    )
    return shown.select(F.col("conv").alias(conv), "speaker", "piece", "n_turns", F.col("shown").alias("text"), F.col("mask.starts").alias("mask_starts"), F.col("mask.ends").alias("mask_ends"))


def report(turns: DataFrame) -> DataFrame:
    """rotate() with the ranges as text ("start-end", comma-joined) and the number of masked characters."""
    spans = F.zip_with("mask_starts", "mask_ends", lambda a, b: F.concat_ws("-", a.cast("string"), b.cast("string")))
    total = F.aggregate(F.zip_with("mask_starts", "mask_ends", lambda a, b: b - a), F.lit(0), lambda n, x: n + x)
    return rotate(turns).select("conv_id", "speaker", "piece", "n_turns", "text", F.array_join(spans, ",").alias("mask"), total.cast("long").alias("n_masked"))


SQL = rf"""
    WITH r AS (
        SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, who, said) - 1) // {PIECE} AS piece FROM
            (SELECT conv_id, turn, coalesce(role, 'unknown') AS who, coalesce(text, '') AS said FROM conversations)),
    p AS (SELECT DISTINCT conv_id, who AS speaker FROM r WHERE who <> '{SYSTEM}'),
    t AS (
        SELECT r.conv_id, p.speaker, r.piece, r.turn, r.who, r.said, r.who = p.speaker AS own,
               '<|start|>' || CASE WHEN r.who = '{SYSTEM}' THEN r.who WHEN r.who = p.speaker THEN 'assistant'
                   ELSE 'user name=' || regexp_replace(replace(replace(r.who, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') END || chr(10) AS head,
               regexp_replace(r.said, '<(\\*)\|', '<\\\1|', 'g') || '<|end|>' AS body
        FROM r JOIN p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
    o AS (
        SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
            PARTITION BY conv_id, speaker, piece ORDER BY turn NULLS FIRST, who, said ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS begin
        FROM t)
    SELECT conv_id, speaker, piece, count(*) AS n_turns,
           string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, who, said) AS text,
           coalesce(string_agg(begin || '-' || (begin + length(body)), ',' ORDER BY turn NULLS FIRST, who, said) FILTER (own), '') AS mask,
           coalesce(sum(length(body)) FILTER (own), 0)::BIGINT AS n_masked
    FROM o GROUP BY conv_id, speaker, piece
"""
