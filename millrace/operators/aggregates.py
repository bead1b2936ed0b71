"""Grouped aggregates, per-group winners, de-duplication and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.skew import heavy_keys, key_hash, piece_of
from millrace.session import settle

# Rows whose order columns are looked at for each range of a running total.
SAMPLED = 50


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, keys: Sequence[str | Column], value: str | Column, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def mean_by(df: DataFrame, keys: Sequence[str | Column], value: str | Column, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def count_above(df: DataFrame, value: str | Column, threshold: float, name: str = "n_high") -> DataFrame:
    """One row with the number of values above a threshold, counted while scanning."""
    value = F.col(value) if isinstance(value, str) else value
    return df.agg(F.count_if(value > threshold).alias(name))


def _first_in(df: DataFrame, keys: Sequence[str], order: Sequence[Column], even: bool = False, met: bool = False) -> DataFrame:
    """The first row of each key. The rows move once and are sorted once, after the move; rows that have ``met`` stay.

    With ``even`` the keys with more than a partition's share of the rows are found first; their rows go in pieces to many
    tasks, and only the first of each piece meet. All other rows still move once.
    """
    if even:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        kinds = {c: df.schema[c].dataType for c in keys}
        heavy = heavy_keys(df, key_hash(df, keys, kinds), partitions)
        if heavy:
            marked = df.withColumn("__hash", key_hash(df, keys, kinds))
            light = marked.filter(~F.col("__hash").isin(list(heavy))).drop("__hash")
            dealt = marked.filter(F.col("__hash").isin(list(heavy))).withColumn("__piece", piece_of("__hash", heavy, partitions))
            best = _first_in(dealt.drop("__hash"), [*keys, "__piece"], order).drop("__piece")
            return _first_in(light, keys, order).unionByName(_first_in(best, keys, order))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    moved = df if met else df.repartition(*keys)
    return moved.withColumn("__place", place).filter("__place = 1").drop("__place")


def top_one(df: DataFrame, group: Sequence[str], weight: str, label: str, out: str) -> DataFrame:
    """The label with the largest weight per group; equal weights go to the smallest label, null last.

    ``df`` holds one row per group and label, so a group is as long as there are labels.
    """
    best = _first_in(df, group, [F.col(weight).desc(), F.col(label).asc_nulls_last()])
    return best.select(*group, F.col(label).alias(out))


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], many_copies: bool = False, even: bool = False, met: bool = False
) -> DataFrame:
    """One row per key, the first by ``order`` and then by all other columns.

    Most keys are expected to have one row or few. With ``many_copies`` the rows of a key collapse
    before the shuffle, however many there are, at the price of sorting the input first; with ``even`` the
    keys are read once more, and only those that hold very many rows are treated apart; with ``met`` the rows have been
    dealt out by some of the keys and are not moved again.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordered = [c for c in order if c not in keys] + rest
    if not many_copies:
        return _first_in(df, keys, [F.col(c) for c in ordered], even, met)
    winner = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("row"))
    return winner.select(*keys, "row.*").select(*df.columns)


def keep_latest(df: DataFrame, keys: Sequence[str], latest: str | None = None, even: bool = False) -> DataFrame:
    """One row per key: the one with the largest ``latest`` (null last), then the first by all other columns.

    ``even`` as in ``keep_first``.
    """
    newest = [F.col(latest).desc_nulls_last()] if latest else []
    return _first_in(df, keys, newest + [F.col(c) for c in df.columns if c not in keys and c != latest], even)


def collect_children(
    parents: DataFrame, children: DataFrame, key: str, value: str, out: str
) -> DataFrame:
    """Each parent with the sorted distinct values of its children, empty when it has none.

    The values must come from a small domain (roles, types): equal ones merge before the shuffle.
    """
    lists = children.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias(out))
    empty = F.array().cast(lists.schema[out].dataType)
    return parents.join(lists, key, "left").withColumn(out, F.coalesce(out, empty))


def word_counts(df: DataFrame, text: str, pattern: str = r"[ \t\n\x0B\f\r]+") -> DataFrame:
    words = df.select(F.explode(F.split(text, pattern)).alias("word"))
    return count_by(words.filter(F.col("word") != ""), ["word"])


def _groups(values: str, width: int) -> Column:
    """An array cut into arrays of ``width`` values, in order; no value gives no group."""
    last = F.floor((F.size(values) - 1) / width).cast("int")
    starts = F.when(F.size(values) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda g: F.slice(values, g * width + 1, F.lit(width)))


def with_range(df: DataFrame, order: Sequence[str], out: str, ranges: int) -> DataFrame:
    """``df`` with the number of the range each row falls into, ranges following ``order``.

    The bounds are quantiles of the ``SAMPLED`` rows per range whose order columns have the smallest
    hashes, the same for every evaluation. They are written once and lie in three levels, each the firsts
    of the groups of the next: a row looks through the top one, and two joins with tables of at most ``ranges``
    bounds bring it the one group of each level below. So it meets about three times the cube root of their number.
    """
    key = F.struct(*order)
    sample = df.select(key.alias("key")).orderBy(F.xxhash64(*order)).limit(SAMPLED * ranges)
    listed = sample.agg(F.sort_array(F.collect_list("key")).alias("keys"))
    step = F.greatest(F.floor(F.size("keys") / ranges), F.lit(1))
    width = max(2, round(ranges ** (1 / 3)))
    bounds = listed.select(F.filter("keys", lambda k, i: (i > 0) & (i % step == 0)).alias("cuts"))
    bounds = bounds.withColumn("low", _groups("cuts", width)).withColumn("heads", F.transform("low", lambda g: g[0]))
    bounds = bounds.withColumn("high", _groups("heads", width)).withColumn("top", F.transform("high", lambda g: g[0]))
    bounds = settle(bounds.select("top", "high", "low"), "bounds")

    def reached(within: str) -> Column:
        """How many of the bounds lie at or below the row; -1 in a group that is not there."""
        return F.size(F.filter(within, lambda c: c <= key))

    def below(rows: DataFrame, level: str) -> DataFrame:
        groups = bounds.select(F.posexplode(level).alias("__group", "__bounds"))
        # A row below all bounds has no group and stays at 0.
        met = rows.withColumn("__group", F.col(out) - 1).join(F.broadcast(groups), "__group", "left")
        place = F.when(F.col(out) > 0, F.col("__group") * width + reached("__bounds")).otherwise(0)
        return met.withColumn(out, place).select(*df.columns, out)

    placed = df.withColumn("__bounds", bounds.select("top").scalar()).withColumn(out, reached("__bounds")).select(*df.columns, out)
    return below(below(placed, "high"), "low")


def running_total(
    df: DataFrame,
    order: Sequence[str],
    value: str,
    out: str,
    reverse: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Running sum over the whole table in ``order`` (which must be unique), from either end.

    The rows move once, to the ranges of the order; each range is summed by itself and shifted by
    the totals of the ranges before it. Only one row per range meets in a single place. ``df`` is
    read three times (bounds, totals, rows), so settle it first if it is costly to compute.
    """
    ranges = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = with_range(df, order, "__range", ranges)
    direction = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    within = Window.partitionBy("__range").orderBy(*direction).rowsBetween(Window.unboundedPreceding, 0)
    edge = F.col("__range").desc() if reverse else F.col("__range").asc()
    before = Window.orderBy(edge).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("__range")
        .agg(F.sum(value).alias("__sum"))
        .select("__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    )
    # As many rows as there are ranges.
    return (
        ranged.withColumn(out, F.sum(value).over(within))
        .join(F.broadcast(offsets), "__range")
        .withColumn(out, F.col(out) + F.col("__offset"))
        .drop("__range", "__offset")
    )


def running_max(
    df: DataFrame, order: Sequence[str], columns: dict[str, str | Column], earlier: bool = False, partitions: int | None = None
) -> DataFrame:
    """Per row the largest value so far over the whole table in ``order`` (which must be unique): new name to column.

    With ``earlier`` only the rows before count, so the column of the order itself gives the row's predecessor. Nulls are
    passed over; structs give the last row's values of several columns. Moves rows and reads ``df`` as ``running_total`` does.
    """
    ranges = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = with_range(df, order, "__range", ranges)
    within = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if earlier else 0)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    tops = ranged.groupBy("__range").agg(*(F.max(c).alias(f"__top_{n}") for n, c in columns.items()))
    # As many rows as there are ranges.
    tops = tops.select("__range", *(F.max(f"__top_{n}").over(before).alias(f"__before_{n}") for n in columns))
    out = ranged.withColumns({n: F.max(c).over(within) for n, c in columns.items()}).join(F.broadcast(tops), "__range")
    out = out.withColumns({n: F.greatest(F.col(n), F.col(f"__before_{n}")) for n in columns})
    return out.select(*(c for c in df.columns if c not in columns), *columns)


def position(df: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """The 1-based place of each row in the whole table, without a single-partition window."""
    return running_total(df.withColumn("__one", F.lit(1)), order, "__one", out).drop("__one")
