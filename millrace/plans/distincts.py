"""Exact distinct counts that merge: a bitmap per day, key and bucket of values, put together over any days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bitmaps(rows: DataFrame, keys: Sequence[str | Column], value: str) -> DataFrame:
    """``keys``, value_bucket and bits: which integers occur as ``value``, 32,768 to a bitmap of 4 KB.

    The bits are set in each task before anything is moved, so a heavy key is one row per task and bucket. Null values count
    for nothing.
    """
    known = rows.filter(F.col(value).isNotNull())
    bucket = F.bitmap_bucket_number(value).alias("value_bucket")
    return known.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))


def merged_bitmaps(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bitmaps of fewer ``keys``: what occurs in any of the rows put together."""
    return stored.groupBy(*keys, "value_bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(stored: DataFrame, keys: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """How many different values each of ``keys`` has over all rows of ``stored``, exactly."""
    merged = merged_bitmaps(stored, keys)
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
