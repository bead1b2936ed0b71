"""JDBC, wide-column and Kafka sinks. The connector or driver jar comes from the caller's session."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

log = logging.getLogger(__name__)


def append_jdbc(df: DataFrame, options: Mapping[str, str], table: str, on_error: str = "raise") -> bool:
    """Append to a table. ``on_error="skip"`` logs a failure and goes on; the result says which."""
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error must be raise or skip")
    writer = df.write.format("jdbc").options(**options).option("dbtable", table)
    try:
        writer.option("rewriteBatchedStatements", "true").mode("append").save()
    except Exception:
        if on_error == "raise":
            raise
        log.exception("append to %s failed, going on without it", table)
        return False
    return True


def upsert_wide_column(df: DataFrame, keyspace: str, table: str) -> None:
    """Append to a keyed table; the store replaces rows that have the same primary key."""
    writer = df.write.format("org.apache.spark.sql.cassandra").mode("append")
    writer.option("keyspace", keyspace).option("table", table).save()


def kafka_rows(df: DataFrame, key: Column, value: Column) -> DataFrame:
    return df.select(key.cast("binary").alias("key"), value.cast("binary").alias("value"))


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    writer = df.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).save()
