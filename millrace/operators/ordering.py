"""Sorting, top-k, paging, sampling, date ranges and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.aggregates import position

MAX_PAGE_SIZE = 500
# Rows a top-k may hold in one place; deeper pages go through distributed positions.
SHALLOW_ROWS = 100_000


def sort_all(df: DataFrame, key: str, tie: Sequence[str], descending: bool = False) -> DataFrame:
    """Global sort. The unique ``tie`` columns let a range exchange split a heavy key value."""
    return df.orderBy(F.col(key).desc() if descending else F.col(key).asc(), *tie)


def top_k(df: DataFrame, weight: str, tie: Sequence[str], k: int) -> DataFrame:
    return df.orderBy(F.col(weight).desc(), *tie).limit(k)


def check_page(page: int, size: int) -> None:
    if page < 1:
        raise ValueError("page must be at least 1")
    if not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError(f"size must be between 1 and {MAX_PAGE_SIZE}")


def page_of(df: DataFrame, order: Sequence[str], unique: Sequence[str], page: int, size: int) -> DataFrame:
    """One page in ascending order, nulls last. Deep pages are cut by position instead of a long top-k."""
    check_page(page, size)
    if page * size <= SHALLOW_ROWS:
        columns = [F.col(c).asc_nulls_last() for c in order]
        return df.orderBy(*columns, *unique).offset((page - 1) * size).limit(size)
    # A flag before each column sorts nulls last where places are counted in ascending order.
    flags = {f"__null_{c}": F.col(c).isNull() for c in order}
    keys = [name for c in order for name in (f"__null_{c}", c)]
    placed = position(df.withColumns(flags), [*keys, *unique], "__pos")
    wanted = placed.filter(F.col("__pos").between((page - 1) * size + 1, page * size))
    return wanted.drop("__pos", *flags)


def with_total(page: DataFrame, population: DataFrame, name: str = "total") -> DataFrame:
    """Add the row count of the unpaged population as a scalar sub-query."""
    return page.withColumn(name, population.agg(F.count("*")).scalar())


def day_series(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("day"))


def sample_rows(df: DataFrame, fraction: float, seed: int, keys: Sequence[str]) -> DataFrame:
    """The rows whose key hashes into the given fraction: the same rows in any file layout."""
    key = F.concat_ws(":", F.lit(str(seed)), *keys)
    drawn = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return df.filter(drawn < int(fraction * 2**32))


def append_all(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def set_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def set_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Copies go before the two sides meet, so a heavy value is one row on each."""
    return a.distinct().intersect(b.select(*a.columns).distinct())


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.distinct().subtract(b.select(*a.columns).distinct())
