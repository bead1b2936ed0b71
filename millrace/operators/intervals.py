"""Joins on ranges: intervals that overlap, and the next or nearest values, without forming pairs that are dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.aggregates import position, running_max
from millrace.session import settle


def overlaps(left: DataFrame, right: DataFrame, left_ends: tuple[str, str], right_ends: tuple[str, str], width: float) -> DataFrame:
    """All pairs of rows whose closed intervals share a point. Column names of the sides must differ.

    Each row goes to every bin of ``width`` that its interval touches, and rows meet by bin; a pair counts in the first
    bin that both touch and in no other. Choose ``width`` near the usual length of the intervals: a row is copied once per
    bin, and meets the other rows of its bins. An interval with a null end, or that ends before it begins, has no partner.
    """

    def binned(df: DataFrame, ends: tuple[str, str]) -> DataFrame:
        low, high = (F.floor(F.col(c) / width).cast("bigint") for c in ends)
        return df.filter(F.col(ends[0]) <= F.col(ends[1])).withColumn("__bin", F.explode(F.sequence(low, high)))

    met = binned(left, left_ends).join(binned(right, right_ends), "__bin")
    start = F.greatest(F.col(left_ends[0]), F.col(right_ends[0]))
    inside = (start <= F.col(left_ends[1])) & (start <= F.col(right_ends[1]))
    return met.filter(inside & (F.floor(start / width) == F.col("__bin"))).drop("__bin")


def _numbered(right: DataFrame, value: str, ties: Sequence[str], k: int, down: bool) -> DataFrame:
    """The rows of ``right`` that can be among the ``k`` next to any value, with their place in the order of values.

    Of equal values only the first ``k`` can be; they move by value, and Spark drops the rest before that.
    """
    order = Window.partitionBy(value).orderBy(*ties)
    first = right.filter(F.col(value).isNotNull()).withColumn("__tie", F.row_number().over(order)).filter(F.col("__tie") <= k)
    # Downwards the order is that of the negated values, so that ties are still taken first to last.
    keyed = settle(first.withColumn("__key", -F.col(value) if down else F.col(value)), "points")
    return settle(position(keyed, ["__key", "__tie"], "__place"), "places")


def next_values(
    left: DataFrame, right: DataFrame, left_value: str, right_value: str, ties: Sequence[str], k: int, down: bool = False
) -> DataFrame:
    """Per row of ``left`` the ``k`` rows of ``right`` whose values follow its own (at least as large; with ``down`` at most).

    ``ties`` orders rows of ``right`` with equal values and must be unique among them. Both sides are put in one order, in which a row
    of ``left`` finds the place of the first value that follows; the ``k`` rows are then met by place. So a row
    meets ``k`` others, whatever lies between, and a value with very many rows on either side is no heavy key of a comparison.
    Adds ``__nth``, from 1. Column names of the sides must differ.
    """
    points = _numbered(right, right_value, ties, k, down)
    sign = -1 if down else 1
    asked = left.filter(F.col(left_value).isNotNull()).withColumn("__row", F.monotonically_increasing_id())
    asked = settle(asked, "asked")
    # The largest place before a row of the left, in the common order, is that of the last value that does not follow.
    keys = asked.select((F.col(left_value) * sign).alias("key"), F.lit(0).alias("side"), F.col("__row").alias("n"))
    marks = points.select(F.col("__key").alias("key"), F.lit(1).alias("side"), F.col("__place").alias("n"))
    line = settle(keys.unionByName(marks), "line")
    seen = running_max(line, ["key", "side", "n"], {"before": F.when(F.col("side") == 1, F.col("n"))})
    starts = seen.filter("side = 0").select(F.col("n").alias("__row"), F.coalesce("before", F.lit(0)).alias("__before"))
    wanted = starts.select("__row", "__before", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("__nth"))
    wanted = wanted.withColumn("__place", F.col("__before") + F.col("__nth")).drop("__before")
    found = wanted.join(points.drop("__key", "__tie"), "__place").drop("__place")
    return asked.join(found, "__row").drop("__row")


def nearest(left: DataFrame, right: DataFrame, left_key: str, left_value: str, right_value: str, ties: Sequence[str], k: int) -> DataFrame:
    """Per row of ``left`` the ``k`` rows of ``right`` with the nearest values, by distance, then value, then ``ties``.

    ``left_key`` must be unique. Adds ``distance`` and ``place``, from 1. ``k`` rows from either side are enough to find them.
    """
    up = next_values(left, right, left_value, right_value, ties, k)
    down = next_values(left, right, left_value, right_value, ties, k, down=True)
    # Equal values are found from above already.
    both = up.unionByName(down.filter(F.col(right_value) < F.col(left_value))).drop("__nth")
    both = both.withColumn("distance", F.abs(F.col(left_value) - F.col(right_value)))
    order = Window.partitionBy(left_key).orderBy("distance", right_value, *ties)
    return both.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


