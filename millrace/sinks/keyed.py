"""Keyed upsert over plain Parquet, for lakes without a keyed store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import keep_latest
from millrace.session import settle
from millrace.sinks.files import path_exists, replace_partitions

BUCKETS = 64


def merged(current: DataFrame | None, changes: DataFrame, keys: Sequence[str], latest: str | None = None) -> DataFrame:
    """``current`` with the rows of equal key replaced by those of ``changes``, and new keys added.

    Of several changes of one key the one with the largest ``latest`` counts, then the first by its
    other columns.
    """
    newest = keep_latest(changes, keys, latest)
    if current is None:
        return newest
    return current.join(newest.select(*keys), list(keys), "left_anti").unionByName(newest)


def upsert(
    changes: DataFrame,
    keys: Sequence[str],
    current: str | None,
    target: str,
    latest: str | None = None,
    tasks: int | None = None,
) -> None:
    """Write the table under ``current`` (None for an empty one) with ``changes`` merged in to ``target``.

    A new path each time: readers keep the old table until they are pointed to the new one, and a
    repeated upsert gives the same rows.
    """
    stored = changes.sparkSession.read.parquet(current) if current else None
    rows = merged(stored, changes, keys, latest)
    (rows.repartition(tasks, *keys) if tasks else rows).write.mode("overwrite").parquet(target)


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    """The bucket a row of a keyed table lies in; the same for equal keys, whatever the table's size."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_touched(
    changes: DataFrame, keys: Sequence[str], path: str, partition: str, latest: str | None = None, tasks: int | None = None
) -> int:
    """Merge ``changes`` into the table under ``path``, rewriting only the partitions they fall into.

    ``partition`` is a column of ``changes`` that follows from the keys (``bucket_of``, a day), so equal keys lie in one
    partition and the others are neither read nor written. Only the touched partitions' values pass through the
    driver. Returns how many there were. For one writer at a time; a repeated upsert gives the same rows.
    """
    spark = changes.sparkSession
    # Written once: it is read for the partitions, for the keys to replace and for the rows.
    newest = settle(keep_latest(changes, keys, latest), "changes")
    touched = [row[0] for row in newest.select(partition).distinct().collect()]
    if not touched:
        return 0
    rows = newest
    if path_exists(spark, path):
        stored = spark.read.schema(newest.schema).parquet(path)
        # A plain list of values, so that folders are pruned before anything is read.
        inside = F.col(partition).isin([t for t in touched if t is not None])
        inside = inside | F.col(partition).isNull() if None in touched else inside
        near = stored.filter(inside)
        # Keys may be null; they are equal then too.
        other = newest.select(*(F.col(k).alias(f"__{k}") for k in keys))
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        rows = near.join(other, same, "left_anti").unionByName(newest)
    replace_partitions(rows, path, [partition], tasks)
    return len(touched)
