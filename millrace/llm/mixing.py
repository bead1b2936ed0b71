"""Mixing sources to target weights.

The words of each source are summed, a target is set for each source, and each document is emitted
floor(rate) times plus once more with a probability of the fraction, where the rate is the target
divided by the source's size. The chance comes from a hash of the seed, the doc_id, the source, the text and a
number among rows equal in these, so a rerun or a recomputed task draws the same copies.

Targets: weights are dealt to the sources in order of their names (by code point, a null name last)
and share out all words. A source whose share is above ``ceiling`` times its size stops there, and
what it leaves is shared by weight among the others, until none is above.

Rows equal in doc_id, source and text are numbered where they lie: each part of the input counts its own and starts
after the parts before it, so a group that holds a third of all rows is numbered in many tasks.

Defined cases: a null text has no words; a source without words has target 0 and is not taken; a null counts as an empty
text in the hash; each of several rows with one doc_id, or with a null one, draws for itself, equal rows too, so that
their source comes near its target; which of the equal rows draws what is open where their other columns differ.
An empty table gives an empty table. Columns of the input are kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, table
from millrace.llm.registry import query
from millrace.operators.aggregates import position
from millrace.session import settle

WEIGHTS = (1, 2, 3)
CEILING = 3
SEED = 17
# Hex digits of the hash that are drawn from: 52 bits, which a double holds exactly.
DIGITS = 13
# The upper bits of monotonically_increasing_id hold the number of the partition.
PART_BITS = 33


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """One row per source: source, weight, source_size and target. ``sizes`` has source and size.

    Only the level (target per weight) is found on the driver, from three sums per round; the
    sources themselves stay in a table, however many there are.
    """
    # Settled, since numbering the sources reads them several times.
    totals = settle(sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")), "totals")
    ordered = position(totals.withColumn("__null", F.col("source").isNull()), ["__null", "source"], "__place")
    dealt = F.element_at(F.lit(list(weights)), ((F.col("__place") - 1) % len(weights) + 1).cast("int"))
    sources = settle(ordered.select("source", dealt.cast("long").alias("weight"), "source_size"), "sources")
    cap = F.col("source_size") * ceiling
    level, stopped = None, -1
    while True:
        over = F.lit(False) if level is None else cap <= F.col("weight") * F.lit(level)
        sums = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("open"),
            F.count_if(over).alias("stopped"),
        ).first()
        if sums["stopped"] == stopped or sums["open"] == 0:
            break
        stopped, level = sums["stopped"], (sums["total"] - sums["capped"]) / sums["open"]
    share = F.lit(0.0) if level is None else F.col("weight") * F.lit(float(level))
    return sources.withColumn("target", F.when(share >= cap, cap.cast("double")).otherwise(share))


def numbered(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with ``__key``, a hash of seed, doc_id, source and text, and ``__number`` among rows of one key, from 0."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "source", "text")]
    keyed = docs.withColumn("__key", F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)))
    many = settle(keyed.groupBy("__key").count().filter("count > 1").select("__key"), "many")
    single = keyed.join(many, "__key", "left_anti").withColumn("__number", F.lit(0).cast("long"))
    equal = keyed.join(many, "__key", "left_semi").withColumn("__row", F.monotonically_increasing_id())
    equal = settle(equal, "equal").withColumn("__part", F.shiftright("__row", PART_BITS))
    earlier = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = equal.groupBy("__key", "__part").count()
    starts = starts.select("__key", "__part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__key", "__part").orderBy("__row"))
    placed = equal.withColumn("__place", place).join(starts, ["__key", "__part"])
    placed = placed.withColumn("__number", F.col("__start") + F.col("__place") - 1)
    return single.unionByName(placed.select(*single.columns))


def with_copies(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING, seed: int = SEED
) -> DataFrame:
    """``docs`` with a struct ``__mix``: size, source_size, target, copies."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    targets = source_targets(docs.select("source", size.alias("size")), weights, ceiling)
    sized = numbered(docs, seed).withColumn("__size", size)
    targets = targets.select(F.col("source").alias("__source"), F.struct("source_size", "target").alias("__of"))
    joined = sized.join(targets, sized["source"].eqNullSafe(targets["__source"]))
    rate = F.when(F.col("__of.source_size") > 0, F.col("__of.target") / F.col("__of.source_size")).otherwise(F.lit(0.0))
    chance = F.md5(F.concat_ws(":", "__key", "__number"))
    drawn = F.conv(F.substring(chance, 1, DIGITS), 16, 10).cast("long") / F.lit(float(16**DIGITS))
    copies = F.floor("__rate") + F.when(F.col("__drawn") < F.col("__rate") - F.floor("__rate"), 1).otherwise(0)
    mixed = joined.withColumns({"__rate": rate, "__drawn": drawn}).withColumn(
        "__mix",
        F.struct(
            F.col("__size").alias("size"),
            F.col("__of.source_size").alias("source_size"),
            F.col("__of.target").alias("target"),
            copies.cast("int").alias("copies"),
        ),
    )
    return mixed.select(*docs.columns, "__mix")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING, seed: int = SEED) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as the mix takes it."""
    planned = with_copies(docs, weights, ceiling, seed)
    repeated = planned.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__mix.copies"))))
    return repeated.select(*docs.columns)


MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(source, '') || ':' || coalesce(text, '')) AS key
  FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
),
filled AS (
  SELECT sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         sum({CEILING} * source_size) OVER s AS capped, sum(weight) OVER s AS stopped
  FROM sources WINDOW s AS (ORDER BY {CEILING} * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
),
levels AS (
  SELECT CAST(total AS DOUBLE) / CAST(weights AS DOUBLE) AS level FROM filled
  UNION ALL
  SELECT CAST(total - capped AS DOUBLE) / CAST(weights - stopped AS DOUBLE) FROM filled WHERE weights > stopped
),
targets AS (
  SELECT source, source_size,
         CASE WHEN weight * level >= {CEILING} * source_size THEN CAST({CEILING} * source_size AS DOUBLE)
              ELSE weight * level END AS target
  FROM sources, (SELECT max(level) AS level FROM levels)
),
rates AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         CAST('0x' || substr(md5(key || ':' || CAST(row_number() OVER (PARTITION BY key) - 1 AS VARCHAR)), 1, {DIGITS}) AS BIGINT)
           / CAST({16**DIGITS} AS DOUBLE) AS drawn
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rates
"""


@query(MIX_SQL)
def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """How many words the mix takes from each document."""
    planned = with_copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select(
        "doc_id",
        F.col("__mix.size").alias("size"),
        F.col("__mix.source_size").alias("source_size"),
        F.col("__mix.target").alias("target"),
        (F.col("__mix.size") * F.col("__mix.copies")).cast("long").alias("taken"),
    )
