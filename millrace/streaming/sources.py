"""Stream sources: files as they arrive, ticks, and JSON messages as typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files under ``path`` (a folder or a glob), a bounded number per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def text_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def ticks(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """Rows that only set the pace of a job."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load()


def json_rows(messages: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Each message as a typed row; a message that is no such object gives nulls."""
    parsed = F.from_json(F.col(column).cast("string"), schema, {"mode": "PERMISSIVE"})
    return messages.select(parsed.alias("row")).select("row.*")
