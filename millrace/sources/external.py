"""JDBC, wide-column and Kafka scans. The connector or driver jar comes from the caller's session."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

IDS_PER_PARTITION = 10_000


def jdbc_options(url: str, driver: str, fetch_size: int = 1000, **extra: str) -> dict[str, str]:
    return {"url": url, "driver": driver, "fetchsize": str(fetch_size), **extra}


def read_table(spark: SparkSession, options: Mapping[str, str], table: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def read_query(spark: SparkSession, options: Mapping[str, str], query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def range_options(column: str, low: int, high: int, partitions: int) -> dict[str, str]:
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def read_range(
    spark: SparkSession, options: Mapping[str, str], table: str, column: str, low: int, high: int, partitions: int
) -> DataFrame:
    """Parallel scan by id ranges. The bounds only set the stride, so the range is also filtered."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    df = reader.options(**range_options(column, low, high, partitions)).load()
    return df.filter(F.col(column).between(low, high))


def delta_query(table: str, id_column: str, after: int, columns: Sequence[str] = ("*",)) -> str:
    return f"SELECT {', '.join(columns)} FROM {table} WHERE {id_column} > {int(after)}"


def members_query(table: str, column: str, values: Sequence[int | str], columns: Sequence[str] = ("*",)) -> str:
    quoted = ", ".join(str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'" for v in values)
    return f"SELECT {', '.join(columns)} FROM {table} WHERE {column} IN ({quoted})"


def probe_query(table: str, id_column: str, after: int) -> str:
    return (
        f"SELECT COALESCE(MIN({id_column}), 0) AS min_id, COALESCE(MAX({id_column}), 0) AS max_id, "
        f"COUNT(*) AS n FROM {table} WHERE {id_column} > {int(after)}"
    )


def probe(df: DataFrame, id_column: str, after: int) -> DataFrame:
    """Smallest and largest id past an offset and the number of rows, as one row."""
    return df.filter(F.col(id_column) > after).agg(
        F.coalesce(F.min(id_column), F.lit(0)).alias("min_id"),
        F.coalesce(F.max(id_column), F.lit(0)).alias("max_id"),
        F.count("*").alias("n"),
    )


def choose_partitions(low: int, high: int, wanted: int, max_connections: int | None = None) -> int:
    """About 10,000 ids per partition, at least 2 and at most ``wanted``; 1 for an empty range."""
    if low >= high:
        return 1
    count = max(2, min(wanted, (high - low + 1) // IDS_PER_PARTITION + 1))
    return max(1, min(count, max_connections)) if max_connections else count


def read_wide_column(spark: SparkSession, keyspace: str, table: str) -> DataFrame:
    reader = spark.read.format("org.apache.spark.sql.cassandra")
    return reader.option("keyspace", keyspace).option("table", table).load()


def kafka_options(servers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    if starting not in ("earliest", "latest"):
        raise ValueError("starting must be earliest or latest")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Message key, value and broker time; nothing else is kept."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting)).load()
    return raw.select("key", "value", F.col("timestamp").alias("received_at"))
