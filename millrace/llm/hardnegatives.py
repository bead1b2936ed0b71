"""Hard negatives by slot-decomposed selection.

An anchor's positives are its best rows of the same label. Each positive asks for the best rows of another label
whose score lies in a window below it, from ``LOW`` to ``HIGH`` hundredths of the positive's score. The windows of one anchor
overlap, so they are not searched one by one:

1. Anchors and rows meet in pairs of blocks, in which every score is one matrix product; a block leaves at most ``POSITIVES``
   rows per anchor, and the best of these are the positives.
2. The upper limits of an anchor's positives cut its scores into disjoint slots, the highest first; the lowest slot ends at the
   smallest lower limit. Each score falls into one slot. A pair of blocks leaves the best ``NEGATIVES`` rows of each
   slot, a combiner keeps as many per slot and task before anything is moved, and again after.
3. The slots from a positive's own on, one after the other, are in descending order of scores: the first ``NEGATIVES``
   of that suffix merge answer the window, cut at its lower limit.

So a row of the table is held against all anchors, no task sees more than two blocks, and an anchor is never more than
``POSITIVES * NEGATIVES`` rows, whatever its label holds.

Components become integers, floor(256 * x), and scores are exact as long as they fit 64-bit integers.

Defined cases: a row with a null label, a null vector or a null or non-finite component takes no part; a row with a null vec_id
is no anchor, but a positive or negative as any other, after all others in ties. Rows that share a vec_id are different rows: one
is a candidate of the other. Rows of another length than the anchor's are no candidates. An anchor without positives, and a positive without negatives, give no
row. An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.llm.registry import query
from millrace.session import settle

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# The window of negatives, in hundredths of the positive's score.
LOW, HIGH = 30, 90
ANCHOR_BLOCK = 512
ROW_BLOCK = 8192
# Below this, sums of products are exact in double arithmetic.
_EXACT = 2**53
_NO_ID = np.iinfo(np.int64).max


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label") -> DataFrame:
    """(row, vec_id, label, dims, x) of the rows that take part, numbered; written once, so that numbers stay."""
    label = F.col(label) if isinstance(label, str) else label
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    taking = rows.filter(label.isNotNull() & x.isNotNull()).filter(finite)
    kept = taking.select(F.col(key).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.size(x).alias("dims"), x.alias("x"))
    return settle(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")


def dealt(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """``rows`` with a block number that their row numbers spread evenly."""
    return rows.withColumn(name, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))


def integers(column: pa.ChunkedArray, dims: int, scale: int = SCALE) -> np.ndarray:
    """The integer vectors of an array column as rows of a matrix."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(x * scale).astype(np.int64).reshape(len(column), dims)


def products(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; by floating point where that is exact."""
    if float(np.abs(one).max(initial=0)) * float(np.abs(two).max(initial=0)) * one.shape[1] < _EXACT:
        return (one.astype(np.float64) @ two.T.astype(np.float64)).astype(np.int64)
    return one @ two.T


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(int(_NO_ID)).to_numpy()


def _table(columns: dict[str, list], ids: str) -> pa.Table:
    """int64 columns from pieces; the largest number in ``ids`` stands for a null id."""
    out = {n: pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for n, c in columns.items()}
    out[ids] = pa.compute.if_else(pa.compute.equal(out[ids], int(_NO_ID)), pa.scalar(None, pa.int64()), out[ids])
    return pa.table(out)


def first_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids, best first."""
    if len(scores) > k:
        # Scores equal to the kth still matter: the smaller id wins.
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def _meet(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], kernel, kind: str) -> DataFrame:
    """``kernel`` over every pair of a block of anchors and a block of rows of the same length."""
    many_a, many_r = blocks
    to_rows = F.explode(F.sequence(F.lit(0), F.lit(many_r - 1))).alias("r")
    to_anchors = F.explode(F.sequence(F.lit(0), F.lit(many_a - 1))).alias("a")
    asked = dealt(anchors, many_a, "a").select("*", to_rows)
    read = dealt(rows, many_r, "r").select("*", to_anchors)
    return asked.groupBy("dims", "a", "r").cogroup(read.groupBy("dims", "a", "r")).applyInArrow(kernel, kind)


def best_per(found: DataFrame, keys: list[str], k: int, out: str = "rank") -> DataFrame:
    """The ``k`` best rows of each key; Spark keeps as many per key in each task before rows are moved."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn(out, F.row_number().over(order)).filter(F.col(out) <= k)


def positives(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], k: int = POSITIVES) -> DataFrame:
    """(anchor, vec_id, score, place): the ``k`` best other rows of each anchor's label."""

    def same_label(key, asked: pa.Table, read: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor": [], "vec_id": [], "score": []}
        if asked.num_rows and read.num_rows:
            dims = key[0].as_py()
            scores = products(integers(asked.column("x"), dims), integers(read.column("x"), dims))
            ids, numbers, labels = _ids(read.column("vec_id")), read.column("row").to_numpy(), read.column("label").to_numpy()
            for i, (own, label) in enumerate(zip(asked.column("row").to_pylist(), asked.column("label").to_pylist())):
                others = np.flatnonzero((labels == label) & (numbers != own))
                best = others[first_of(scores[i, others], ids[others], k)]
                out["anchor"].append(np.full(len(best), own))
                out["vec_id"].append(ids[best])
                out["score"].append(scores[i, best])
        return _table(out, "vec_id")

    found = _meet(anchors, rows, blocks, same_label, "anchor long, vec_id long, score long")
    return best_per(found, ["anchor"], k, "place")


def limits(chosen: DataFrame, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``chosen`` positives with the lowest and highest score their negatives may have, in exact integers."""
    share = lambda part: F.col("score").cast("decimal(20,0)") * F.lit(part).cast("decimal(6,0)") / F.lit(100).cast("decimal(3,0)")
    least, most = F.ceil(share(low)), F.floor(share(high))
    return chosen.withColumns({"least": least.cast("long"), "most": most.cast("long")})


def slot_best(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], k: int = NEGATIVES) -> DataFrame:
    """(anchor, slot, vec_id, score, place): the ``k`` best rows of another label in every slot of each anchor.

    ``anchors`` carry ``tops``, their slots' upper limits, descending and distinct, and ``floor``, where the last ends.
    """

    def by_slot(key, asked: pa.Table, read: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor": [], "slot": [], "vec_id": [], "score": []}
        if asked.num_rows and read.num_rows:
            dims = key[0].as_py()
            scores = products(integers(asked.column("x"), dims), integers(read.column("x"), dims))
            ids, labels = _ids(read.column("vec_id")), read.column("label").to_numpy()
            wanted = zip(*(asked.column(c).to_pylist() for c in ("row", "label", "tops", "floor")))
            for i, (own, label, tops, floor) in enumerate(wanted):
                inside = np.flatnonzero((labels != label) & (scores[i] <= tops[0]) & (scores[i] >= floor))
                # Slot j holds the scores above the next limit, up to its own.
                slots = len(tops) - np.searchsorted(np.array(tops[::-1]), scores[i, inside], "left") - 1
                for j in range(len(tops)):
                    here = inside[slots == j]
                    best = here[first_of(scores[i, here], ids[here], k)]
                    out["anchor"].append(np.full(len(best), own))
                    out["slot"].append(np.full(len(best), j))
                    out["vec_id"].append(ids[best])
                    out["score"].append(scores[i, best])
        return _table(out, "vec_id")

    found = _meet(anchors, rows, blocks, by_slot, "anchor long, slot long, vec_id long, score long")
    return best_per(found, ["anchor", "slot"], k, "place")


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives_wanted: int = POSITIVES,
    negatives_wanted: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    anchor_block: int = ANCHOR_BLOCK,
    row_block: int = ROW_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of a ``usable`` table.

    ``is_anchor`` tells the anchors by the columns of that table.
    """
    anchors = settle(rows.filter(is_anchor), "anchors")
    counted = anchors.count(), rows.count()
    blocks = -(-counted[0] // anchor_block) or 1, -(-counted[1] // row_block) or 1
    windows = settle(limits(positives(anchors, rows, blocks, positives_wanted), low, high), "windows")
    # A window is empty where the positive's score is negative.
    open_windows = windows.filter("least <= most")
    of_anchor = open_windows.groupBy("anchor").agg(
        F.sort_array(F.collect_set("most"), False).alias("tops"), F.min("least").alias("floor")
    )
    slotted = anchors.join(of_anchor, anchors["row"] == of_anchor["anchor"]).drop("anchor")
    best = slot_best(settle(slotted, "slots"), rows, blocks, negatives_wanted)
    # In order of slot and place the scores of an anchor descend.
    lists = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "place", "score", "vec_id"))).alias("best"))
    asked = open_windows.join(of_anchor, "anchor").join(lists, "anchor")
    own_slot = F.array_position("tops", F.col("most")) - 1
    suffix = F.slice(F.filter("best", lambda b: b["slot"] >= own_slot), 1, negatives_wanted)
    merged = F.filter(suffix, lambda b: b["score"] >= F.col("least"))
    named = asked.join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    return named.select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode(merged).alias("at", "b")
    ).select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("b.vec_id").alias("negative_id"),
        "positive_score",
        F.col("b.score").alias("negative_score"),
    )


NEGATIVES_SQL = f"""
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
),
scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id,
         CAST(list_inner_product(CAST(a.x AS DOUBLE[]), CAST(b.x AS DOUBLE[])) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.row <> b.row AND len(a.x) = len(b.x)
  WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE alike QUALIFY place <= {POSITIVES}
)
SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.anchor, place ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM positives p JOIN scored s ON p.anchor = s.anchor AND NOT alike
  AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""


@query(NEGATIVES_SQL)
def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """The hard negatives of every hundredth vector, after a seventh of the labels were moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable(table(spark, sf_dir, "embeddings"), label=moved)
    return mine(rows, F.col("vec_id") % 100 == 0)
