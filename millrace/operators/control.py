"""Physical controls: partition counts, repartitioning, plan inspection."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def by_key(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Hash-partition by key for a write; group-bys and joins do not need it."""
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows per non-empty partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n_rows"))


def partition_count(df: DataFrame) -> int:
    """Number of non-empty partitions."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def fewer_files(df: DataFrame, present: int, factor: int = 4) -> DataFrame:
    """A quarter (by default) of the ``present`` partitions, without a shuffle."""
    return df.coalesce(max(1, present // factor))


def schema_text(df: DataFrame) -> str:
    return df.schema.simpleString()


@contextmanager
def runtime_filters(spark: SparkSession, fact_bytes: str = "10GB", keys_bytes: str = "10MB") -> Iterator[None]:
    """Joins planned inside filter the scan of a side of at least ``fact_bytes`` by a bloom filter of the other side's keys.

    The other side must be filtered itself and at most ``keys_bytes`` large. Rows that cannot match then go before they are
    shuffled. The plan is made when a result is asked for, so store it inside.
    """
    settings = {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": fact_bytes,
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": keys_bytes,
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
