"""Multi-party perspective rotation of dialogues.

Every participant of a conversation gets a rendering of the whole dialogue in which that
speaker is the assistant, all others are named users and system messages stay system
messages; the mask marks what the speaker said, each turn's end mark included.

A conversation may hold any share of all rows.  Messages get their place by a
range-partitioned sort, are gathered in *parts* of at most ``part_turns`` messages, and a
rendering is the concatenation of its parts in order; offsets count code points within
the part.  No task ever holds a whole conversation.

Defined results: a null role is the speaker ``unknown``, a null text is empty, messages
without a turn come last, ties go by role and text, repeated rows are repeated messages,
rows without a conversation id form one conversation.  A conversation of system messages
alone has no participant and no row.  An empty table gives an empty table; other columns
play no part.  Marks inside names and texts are broken up so that they cannot end a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.operators.ranking import with_position

#: Fixed values of the rendering.
OPEN, CLOSE = "<|start|>", "<|end|>"
SYSTEM = "system"
NOBODY = "unknown"


def safe_name(speaker: Column) -> Column:
    """A name that cannot contain marks or line ends."""
    return F.regexp_replace(speaker, r"[^\p{L}\p{N}_.-]", "_")


def messages(turns: DataFrame) -> DataFrame:
    """conv_id, place (0-based and gapless), speaker, body."""
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(NOBODY)).alias("speaker"),
        F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("body"),
    )
    order = [F.col("turn").asc_nulls_last(), F.col("speaker").asc(), F.col("body").asc()]
    return with_position(rows, order, "place", within=["conv_id"]).select(
        "conv_id", (F.col("place") - 1).alias("place"), "speaker", "body"
    )


def rotate(turns: DataFrame, part_turns: int = 128) -> DataFrame:
    """One row per conversation, participant and part.

    Columns: conv_id, perspective, part, n_messages, n_masked (messages of the
    participant), rendered, mask (``start:end`` joined by commas).
    """
    placed = messages(turns)
    parts = placed.groupBy("conv_id", F.floor(F.col("place") / part_turns).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("place", "speaker", "body"))).alias("said")
    )
    participants = (
        placed.filter(F.col("speaker") != SYSTEM)
        .select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective"))
        .distinct()
    )
    views = parts.join(participants, F.col("conv_id").eqNullSafe(F.col("_conv")))

    def head(m: Column) -> Column:
        return F.concat(
            F.lit(OPEN),
            F.when(m["speaker"] == F.col("perspective"), F.lit("assistant"))
            .when(m["speaker"] == SYSTEM, F.lit(SYSTEM))
            .otherwise(F.concat(F.lit("user name="), safe_name(m["speaker"]))),
            F.lit("\n"),
        )

    pieces = views.withColumn(
        "piece",
        F.transform(
            "said",
            lambda m: F.struct(
                head(m).alias("head"),
                F.concat(m["body"], F.lit(CLOSE)).alias("rest"),
                (m["speaker"] == F.col("perspective")).alias("own"),
            ),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def forward(state: Column, piece: Column) -> Column:
        first = state["at"] + F.length(piece["head"])
        last = first + F.length(piece["rest"])
        span = F.concat(first.cast("string"), F.lit(":"), last.cast("string"))
        return F.struct(
            (last + 1).alias("at"),
            F.when(piece["own"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    return pieces.select(
        "conv_id",
        "perspective",
        F.col("part").cast("bigint").alias("part"),
        F.size("said").cast("bigint").alias("n_messages"),
        F.size(F.filter("piece", lambda p: p["own"])).cast("bigint").alias("n_masked"),
        F.array_join(F.transform("piece", lambda p: F.concat(p["head"], p["rest"], F.lit("\n"))), "").alias("rendered"),
        F.array_join(F.aggregate("piece", start, forward, lambda s: s["spans"]), ",").alias("mask"),
    )


ORACLE = """
WITH m AS (
  SELECT conv_id, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS LAST, coalesce(role, 'unknown'),
      replace(coalesce(text, ''), '<|', '< |')) - 1 AS place
  FROM conversations
), p AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> 'system'
), r AS (
  SELECT m.conv_id, perspective, place // 128 AS part, place, speaker = perspective AS own,
    '<|start|>' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
      ELSE 'user name=' || regexp_replace(speaker, '[^\\p{L}\\p{N}_.-]', '_', 'g') END || chr(10) AS head,
    body || '<|end|>' AS rest
  FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id
), o AS (
  SELECT *, coalesce(sum(length(head) + length(rest) + 1) OVER (PARTITION BY conv_id, perspective, part
    ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS begins
  FROM r
)
SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, count(*) AS n_messages,
  count(*) FILTER (WHERE own) AS n_masked,
  string_agg(head || rest || chr(10), '' ORDER BY place) AS rendered,
  coalesce(string_agg(CAST(begins AS BIGINT) || ':' || CAST(begins + length(rest) AS BIGINT), ','
    ORDER BY place) FILTER (WHERE own), '') AS mask
FROM o GROUP BY conv_id, perspective, part
"""
