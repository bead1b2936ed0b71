"""Exact top-k by inner product with vector-approximation files.

Components become integers, floor(256 * x). A vector's approximation is one byte a component: its cell, the upper
eight bits above a shift that the vector's largest component sets. The cells and the query bound the exact score from
both sides, so a scan of the cells orders the vectors by their bounds, and exact vectors are read in that order until
the next bound cannot reach the kth result.

Cells are dealt to blocks, queries too, and each pair of blocks is one bounded task: every query is held against the
cells of all vectors, and no task sees more than a block of each. A first scan finds the kth largest lower bound of every
query over all blocks; a second one names the vectors whose upper bound reaches it. Only these are fetched, and they
meet the queries of their blocks: a pair of blocks fetches a vector once, however many queries ask for it, so a large
group of copies costs a block and not a row for each pair. A task returns at most k rows per query, and the k best of
these are the result. The file of exact vectors is joined with the names of what is fetched; it moves at most once.

Defined cases: a vector that is null or empty, or holds a null, NaN or infinite component, takes no part. A query's own
row is no candidate of it, other rows of its vec_id are. Rows that share a vec_id are one query each. Ties go to the
smaller vec_id, a null one last. Vectors of another length than a query's are no candidates of it. Scores must fit
64-bit integers. Without queries or candidates the result is empty; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.llm.registry import query
from millrace.session import settle

SCALE = 256
# A cell has eight bits, one of them the sign.
CELL_BITS = 8
K = 5
VECTOR_BLOCK = 4096
QUERY_BLOCK = 1024
# Exact vectors read at a time.
STEP = 64
# Below this, sums of products are exact in double arithmetic.
EXACT = 2**53

CELLS = "row long, dims int, shift int, cells binary"


def integer_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(row, vec_id, dims, vector): the integer components of the vectors that take part, as array<long>.

    Written once, so that the numbers of the rows hold; queries are rows of this table.
    """
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    usable = rows.select(F.col(key).cast("long").alias("vec_id"), x.alias("x")).filter(F.size("x") > 0)
    usable = usable.filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    whole = F.transform("x", lambda v: F.floor(v * scale).cast("long"))
    row = F.monotonically_increasing_id().alias("row")
    return settle(usable.select(row, "vec_id", F.size("x").alias("dims"), whole.alias("vector")), "vectors")


def _scores(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; by floating point where that is exact."""
    bound = float(np.abs(one).max(initial=0)) * float(np.abs(two).max(initial=0)) * one.shape[1]
    if bound < EXACT:
        return (one.astype(np.float64) @ two.T.astype(np.float64)).astype(np.int64)
    return one @ two.T


def cells_of(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells of integer rows, a byte a component, and each row's shift."""
    # -1 and 0 need the same bits, as do -128 and 127.
    largest = (vectors ^ (vectors >> 63)).max(axis=1, initial=0)
    shifts = np.maximum(np.frexp(largest.astype(np.float64))[1] - (CELL_BITS - 1), 0).astype(np.int64)
    return (vectors >> shifts[:, None]).astype(np.int8), shifts


def bounds(queries: np.ndarray, cells: np.ndarray, shifts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of every query's score with every vector, from the vectors' cells.

    A component lies at most ``2^shift - 1`` above its cell's lower corner.
    """
    asked, scale = queries.astype(np.float64), np.exp2(shifts)
    low = (asked @ cells.T.astype(np.float64)) * scale
    # Sums that a double does not hold exactly are widened by what rounding can do.
    most = np.outer(np.abs(asked).sum(axis=1), np.exp2(shifts + CELL_BITS - 1))
    slack = np.where(most < EXACT, 0.0, most * ((queries.shape[1] + 8) * 2.0**-51))
    high = low + np.outer(np.where(asked > 0, asked, 0).sum(axis=1), scale - 1) + slack
    low += np.outer(np.where(asked < 0, asked, 0).sum(axis=1), scale - 1) - slack
    return low, high


def _apart(query_rows: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where a vector is not the query's own row."""
    return query_rows[:, None] != rows[None, :]


def block_best(
    query_rows: np.ndarray, queries: np.ndarray, rows: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[list[tuple[int, int, int]], int]:
    """(query, vector, score) by place of the k best vectors of one block, and how many exact reads it took.

    ``vectors`` come in the order in which they win ties.
    """
    low, high = bounds(queries, *cells_of(vectors))
    apart = _apart(query_rows, rows)
    out, reads = [], 0
    for q in range(len(queries)):
        others = np.flatnonzero(apart[q])
        if not len(others):
            continue
        # The kth largest lower bound rules out every vector whose upper bound lies below it.
        top = min(k, len(others))
        certain = np.partition(low[q, others], len(others) - top)[len(others) - top]
        near = others[high[q, others] >= certain]
        near = near[np.argsort(-high[q, near], kind="stable")]
        best_scores, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(near), STEP):
            # Scores equal to the kth still matter: the smaller vec_id wins.
            if len(best) == k and high[q, near[at]] < best_scores[-1]:
                break
            part = near[at : at + STEP]
            reads += len(part)
            best = np.concatenate([best, part])
            best_scores = np.concatenate([best_scores, _scores(queries[q : q + 1], vectors[part])[0]])
            order = np.lexsort((best, -best_scores))[:k]
            best, best_scores = best[order], best_scores[order]
        out += [(q, int(b), int(s)) for b, s in zip(best, best_scores)]
    return out, reads


def _matrix(rows: pa.Table, dims: int) -> np.ndarray:
    flat = rows.column("vector").combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dims)


def _cell_matrix(rows: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray]:
    packed = b"".join(rows.column("cells").to_pylist())
    return np.frombuffer(packed, np.int8).reshape(-1, dims), rows.column("shift").to_numpy().astype(np.int64)


def _table(kind: str, *columns) -> pa.Table:
    names = [part.split()[0] for part in kind.split(", ")]
    types = [{"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[part.split()[1]] for part in kind.split(", ")]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns or [[]] * len(names), types)})


def cell_file(vectors: DataFrame) -> DataFrame:
    """(row, dims, shift, cells): the approximation of ``integer_vectors``, one byte a component, written once."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, shifts = [], []
            for vector in batch.column(2):
                cell, shift = cells_of(vector.values.to_numpy(zero_copy_only=False)[None, :])
                cells.append(cell.tobytes())
                shifts.append(int(shift[0]))
            columns = [batch.column(0), batch.column(1), pa.array(shifts, pa.int32()), pa.array(cells, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "dims", "shift", "cells"])

    return settle(vectors.select("row", "dims", "vector").mapInArrow(packed, CELLS), "cells")


def _block_number(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def _every(blocks: int, name: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias(name)


def nearest(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = K,
    vector_block: int = VECTOR_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of every query; both are ``integer_vectors`` of one table."""
    cells = cell_file(vectors)
    counted = cells.count(), queries.count()
    many_v, many_q = -(-counted[0] // vector_block) or 1, -(-counted[1] // query_block) or 1
    block = ["dims", "v", "q"]
    numbered = queries.select("row", "vec_id", "dims", "vector", _block_number("row", many_q).alias("q"))
    scanned = cells.select("*", _block_number("row", many_v).alias("v"), _every(many_q, "q")).groupBy(*block)

    def reached(key, asked: pa.Table, read: pa.Table) -> pa.Table:
        kind = "row long, low double"
        if not asked.num_rows or not read.num_rows:
            return _table(kind)
        dims, rows = key[0].as_py(), asked.column("row").to_numpy()
        low, _ = bounds(_matrix(asked, dims), *_cell_matrix(read, dims))
        low[~_apart(rows, read.column("row").to_numpy())] = -np.inf
        top = min(k, low.shape[1])
        low = np.partition(low, low.shape[1] - top, axis=1)[:, low.shape[1] - top :].ravel()
        kept = low > -np.inf
        return _table(kind, np.repeat(rows, top)[kept], low[kept])

    asked = numbered.select("row", "dims", "vector", "q", _every(many_v, "v"))
    lows = asked.groupBy(*block).cogroup(scanned).applyInArrow(reached, "row long, low double")
    # A query with fewer than k candidates has no floor.
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.col("low").desc()))
    floors = lows.withColumn("place", place).filter(F.col("place") <= k).filter(F.col("place") == k)
    floors = floors.select("row", F.col("low").alias("floor"))
    floored = numbered.join(floors, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    floored = settle(floored, "floored")

    def named(key, asked: pa.Table, read: pa.Table) -> pa.Table:
        kind = "dims int, v int, q int, row long"
        if not asked.num_rows or not read.num_rows:
            return _table(kind)
        dims, rows = key[0].as_py(), read.column("row").to_numpy()
        _, high = bounds(_matrix(asked, dims), *_cell_matrix(read, dims))
        wanted = (high >= asked.column("floor").to_numpy()[:, None]) & _apart(asked.column("row").to_numpy(), rows)
        rows = rows[wanted.any(axis=0)]
        return _table(kind, *([x.as_py()] * len(rows) for x in key), rows)

    asked = floored.select("row", "dims", "vector", "q", "floor", _every(many_v, "v"))
    wanted = asked.groupBy(*block).cogroup(scanned).applyInArrow(named, "dims int, v int, q int, row long")
    wanted = settle(wanted, "wanted")
    fetched = vectors.select("row", "vec_id", "vector").join(wanted, "row")
    pairs = wanted.groupBy(*(F.col(c).alias(c) for c in block)).count().drop("count")
    asked = floored.select("row", "vec_id", "dims", "vector", "q").join(pairs, ["dims", "q"])
    kind = "query_row long, query_id long, vec_id long, score long"

    def met(key, asked: pa.Table, read: pa.Table) -> pa.Table:
        if not asked.num_rows or not read.num_rows:
            return _table(kind)
        read = read.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        dims, numbers = key[0].as_py(), asked.column("row").to_numpy()
        best, _ = block_best(numbers, _matrix(asked, dims), read.column("row").to_numpy(), _matrix(read, dims), k)
        if not best:
            return _table(kind)
        query, vector, score = (np.array(c, np.int64) for c in zip(*best))
        query_id, vec_id = asked.column("vec_id").take(query), read.column("vec_id").take(vector)
        return pa.table({"query_row": numbers[query], "query_id": query_id, "vec_id": vec_id, "score": score})

    found = asked.groupBy(*block).cogroup(fetched.groupBy(*block)).applyInArrow(met, kind)
    # At most k rows per query and block, of those blocks that hold a vector some query asked for.
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


@query()
def op4_vafile(spark, sf_dir: str) -> DataFrame:
    """The five highest scores of every fiftieth vector among all others."""
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return nearest(vectors.filter("vec_id % 50 = 0"), vectors)
