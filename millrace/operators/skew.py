"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_on(facts: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same name, compared by their common type.

    Adaptive execution broadcasts a side by its measured bytes and splits the partitions of heavy
    keys, so neither the plan nor the result hangs on a row count.
    """
    return facts.join(other, list(on), how)


def _named(columns: Sequence[str], keys: Sequence) -> Column:
    """Whether the row has one of the key values; a single column takes plain values."""
    def equal(key) -> Column:
        values = key if isinstance(key, tuple) else (key,)
        return reduce(Column.__and__, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, values)))

    return reduce(Column.__or__, map(equal, keys))


def salted_join(
    facts: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    hot: Sequence,
    how: str = "inner",
    salts: int = 32,
) -> DataFrame:
    """Equi-join that spreads the key values in ``hot`` over ``salts`` partitions.

    For heavy keys the caller knows, where adaptive splitting is off or comes too late. The rows of
    a hot key are dealt out by their place in the input, so equal rows are spread like any others;
    the matching rows of ``other`` (a side with few rows per key) are repeated once per salt. A null
    key is named by None. ``how`` may be inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do a {how} join")
    on = list(on)
    if not hot:
        return join_on(facts, other, on, how)
    spread = F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(salts)).cast("int")
    copies = F.sequence(F.lit(0), F.lit(salts - 1))
    left = facts.withColumn("__salt", F.when(_named(on, hot), spread).otherwise(F.lit(0)))
    right = other.withColumn("__salt", F.explode(F.when(_named(on, hot), copies).otherwise(F.array(F.lit(0)))))
    return left.join(right, [*on, "__salt"], how).drop("__salt")


# Pieces a partition's worth of a heavy key is cut into, so that pieces even out over the partitions.
PIECES = 16
# Keys that can be found heavy at most; any other holds less than this part of the rows.
HEAVY_KEYS = 2_000


def key_hash(df: DataFrame, on: Sequence[str], kinds: dict) -> Column:
    """One number per key, equal for keys that a join finds equal."""
    columns = [F.col(c).cast(kinds[c]) for c in on]
    # Minus zero and zero are one key.
    return F.xxhash64(*(c + 0.0 if kinds[n].typeName() in ("float", "double") else c for n, c in zip(on, columns)))


def heavy_keys(df: DataFrame, key: Column, partitions: int, most: int = HEAVY_KEYS) -> dict[int, float]:
    """The values of the bigint ``key`` with more than a partition's share of the rows, and their shares, by one pass.

    A frequent-items sketch of bounded size is kept per task and merged, so nothing is shuffled by key. Estimates are
    too low by at most a hundredth of ``1 / most``; a value it overrates is spread for nothing and does no harm.
    """
    sketch = F.expr(f"approx_top_k(__key, {most}, {min(100 * most, 1_000_000)})")
    found = df.select(key.alias("__key")).filter("__key IS NOT NULL").agg(sketch.alias("top"), F.count("*").alias("n")).first()
    return {r["item"]: r["count"] / found["n"] for r in found["top"] or [] if r["count"] * partitions > found["n"]}


def _pieces(key: str, heavy: dict[int, float], partitions: int) -> Column:
    """How many pieces a key is cut into: one, unless it is heavy."""
    cut = F.create_map(*(F.lit(x) for h, share in heavy.items() for x in (h, max(2, int(PIECES * share * partitions)))))
    return F.coalesce(F.try_element_at(cut, F.col(key)), F.lit(1))


def piece_of(key: str, heavy: dict[int, float], partitions: int) -> Column:
    """The piece of its key that a row falls into, by its place in the input, so that equal rows are spread too."""
    return F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), _pieces(key, heavy, partitions)).cast("int")


def balanced_join(facts: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner", partitions: int | None = None) -> DataFrame:
    """Equi-join that finds the heavy keys of ``facts`` itself and spreads each by its share.

    A key with a share of ``s`` is cut into ``16 * s * partitions`` pieces, of which a task gets about as many as any other. The
    matching rows of ``other`` (a side with few rows per key) are repeated once per piece; keys of an ordinary size are not
    touched. Reads the keys of ``facts`` once more. ``how`` as in ``salted_join``; keys must have types of one kind.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"balanced_join cannot do a {how} join")
    on = list(on)
    kinds = {}
    for name in on:
        one, two = facts.schema[name].dataType, other.schema[name].dataType
        if (one.typeName() == "string") != (two.typeName() == "string"):
            raise ValueError(f"cast {name} to one type: a text and a {two.typeName()} are compared by value")
        kinds[name] = facts.select(name).limit(0).union(other.select(name).limit(0)).schema[0].dataType
    partitions = partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(facts, key_hash(facts, on, kinds), partitions)
    if not heavy:
        return join_on(facts, other, on, how)
    left = facts.withColumn("__hash", key_hash(facts, on, kinds))
    left = left.withColumn("__piece", piece_of("__hash", heavy, partitions)).drop("__hash")
    right = other.withColumn("__hash", key_hash(other, on, kinds))
    right = right.withColumn("__piece", F.explode(F.sequence(F.lit(0), _pieces("__hash", heavy, partitions) - 1))).drop("__hash")
    return left.join(right, [*on, "__piece"], how).drop("__piece")
