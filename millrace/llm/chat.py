"""Chat formatting from every participant's point of view, in DataFrame functions only.

Each participant (a distinct role of a conversation) gets the whole dialogue once, with their own
turns as the assistant's, all other turns as those of named users, and loss spans that cover exactly
their own turns: the text and the mark that ends it.

A dialogue is rendered in segments of at most ``SEGMENT_TURNS`` turns, so that one row stays small
even if one conversation holds a third of all rows; usual conversations have one segment. Turns are
numbered across range partitions, which cut a long conversation like any other run of rows.

Defined cases: turns come in order of turn (null last), then role, then text; repeated rows are
repeated turns. A null role is a participant called ``unknown``; a null text is an empty turn; rows
with a null conv_id are one conversation. Marks inside a text are broken up, so that no text can
open or close a turn. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.llm.registry import query
from millrace.session import settle

SEGMENT_TURNS = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, role, text and ``place``, the 0-based number of the turn in its conversation."""
    order = [F.col(c).asc_nulls_last() for c in ("turn", "role", "text")]
    ranged = turns.select("conv_id", "turn", "role", "text").repartitionByRange(F.col("conv_id").asc_nulls_last(), *order)
    ranged = settle(ranged.withColumn("part", F.spark_partition_id()), "turns")
    counts = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("conv_id").alias("__conv"),
        F.col("part").alias("__part"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
    )
    # Only conversations that a range boundary cuts have an offset, a few per partition.
    offsets = offsets.filter("offset > 0")
    within = Window.partitionBy("part", "conv_id").orderBy(*order)
    placed = ranged.withColumn("__n", F.row_number().over(within) - 1)
    joined = placed.join(
        offsets, placed["conv_id"].eqNullSafe(offsets["__conv"]) & (placed["part"] == offsets["__part"]), "left"
    )
    return joined.select("conv_id", "role", "text", (F.col("__n") + F.coalesce("offset", F.lit(0))).cast("long").alias("place"))


def _name(role: Column) -> Column:
    return F.coalesce(F.regexp_replace(role, r"[^A-Za-z0-9_.\-]", "_"), F.lit("unknown"))


def perspectives(turns: DataFrame, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """One row per conversation, participant and segment.

    Columns: conv_id, participant, segment, n_turns, rendered, and spans, an array of (start, length)
    in characters of ``rendered`` to which the loss applies.
    """
    placed = numbered_turns(turns)
    body = F.concat(F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")), F.lit(CLOSE))
    message = F.struct("place", F.col("role"), _name(F.col("role")).alias("name"), body.alias("body"))
    segments = (
        placed.withColumn("segment", F.floor(F.col("place") / segment_turns).cast("long"))
        .groupBy("conv_id", "segment")
        .agg(F.sort_array(F.collect_list(message)).alias("messages"))
    )
    speakers = turns.select(F.col("conv_id").alias("__conv"), F.col("role").alias("participant")).distinct()
    seen = segments.join(speakers, segments["conv_id"].eqNullSafe(speakers["__conv"])).drop("__conv")
    own = lambda m: m["role"].eqNullSafe(F.col("participant"))
    opened = F.transform(
        "messages",
        lambda m: F.struct(
            own(m).alias("own"),
            F.when(own(m), F.lit(f"{OPEN}assistant\n"))
            .otherwise(F.concat(F.lit(f"{OPEN}user name="), m["name"], F.lit("\n")))
            .alias("head"),
            m["body"].alias("body"),
        ),
    )
    seen = seen.withColumn("__turns", opened)
    lengths = F.transform("__turns", lambda t: F.char_length(t["head"]) + F.char_length(t["body"]) + 1)
    seen = seen.withColumn("__lengths", lengths)
    spans = F.transform(
        "__turns",
        lambda t, i: F.struct(
            t["own"].alias("own"),
            (
                F.aggregate(F.slice("__lengths", 1, i), F.lit(0), lambda a, x: a + x) + F.char_length(t["head"])
            ).alias("start"),
            F.char_length(t["body"]).alias("length"),
        ),
    )
    own_spans = F.transform(
        F.filter("__spans", lambda s: s["own"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))
    )
    rendered = F.concat_ws("", F.transform("__turns", lambda t: F.concat(t["head"], t["body"], F.lit("\n"))))
    return seen.withColumn("__spans", spans).select(
        "conv_id",
        "participant",
        "segment",
        F.size("messages").cast("long").alias("n_turns"),
        rendered.alias("rendered"),
        own_spans.alias("spans"),
    )


CHAT_SQL = f"""
WITH placed AS (
  SELECT conv_id, role, replace(coalesce(text, ''), '<|', '< |') || '{CLOSE}' AS body,
         coalesce(regexp_replace(role, '[^A-Za-z0-9_.\\-]', '_', 'g'), 'unknown') AS name,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) - 1 AS place
  FROM conversations
),
speakers AS (SELECT DISTINCT conv_id, role AS participant FROM conversations),
turns AS (
  SELECT p.conv_id, s.participant, p.place // {SEGMENT_TURNS} AS segment, p.place, p.body,
         p.role IS NOT DISTINCT FROM s.participant AS own,
         CASE WHEN p.role IS NOT DISTINCT FROM s.participant THEN '{OPEN}assistant' || chr(10)
              ELSE '{OPEN}user name=' || p.name || chr(10) END AS head
  FROM placed p JOIN speakers s ON p.conv_id IS NOT DISTINCT FROM s.conv_id
),
offsets AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
             PARTITION BY conv_id, participant, segment ORDER BY place
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start
  FROM turns
)
SELECT conv_id, participant, CAST(segment AS BIGINT) AS segment, count(*) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY place) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN CAST(start AS BIGINT) || '+' || length(body) END, ' ' ORDER BY place), '') AS loss_spans,
       CAST(coalesce(sum(CASE WHEN own THEN length(body) END), 0) AS BIGINT) AS loss_chars
FROM offsets GROUP BY conv_id, participant, segment
"""


@query(CHAT_SQL)
def op10_perspectives(spark, sf_dir: str) -> DataFrame:
    """Every conversation as every participant sees it, with the spans the loss applies to."""
    seen = perspectives(table(spark, sf_dir, "conversations"))
    return seen.select(
        "conv_id",
        "participant",
        "segment",
        "n_turns",
        "rendered",
        F.concat_ws(" ", F.transform("spans", lambda s: F.concat(s["start"], F.lit("+"), s["length"]))).alias("loss_spans"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"]).alias("loss_chars"),
    )
