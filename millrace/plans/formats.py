"""Compare storage formats: write, size and read-back of one table in each of them."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sinks.files import output_metrics, write_csv, write_json, write_parquet, write_text

WRITERS: dict[str, Callable[..., None]] = {
    "csv": write_csv,
    "json": write_json,
    "parquet": write_parquet,
    "text": write_text,
}


def write_as(kind: str, df: DataFrame, path: str, codec: str | None = None) -> None:
    """Write in a format, under its own default codec unless one is named for all formats."""
    WRITERS[kind](df, path, **({"codec": codec} if codec else {}))


def timed(action: Callable[[], None]) -> int:
    """Milliseconds ``action`` takes; it must run a job, not just build a plan."""
    start = time.perf_counter()
    action()
    return round((time.perf_counter() - start) * 1000)


def compute_millis(df: DataFrame) -> int:
    """Time to compute every row without storing any."""
    return timed(lambda: df.write.format("noop").mode("overwrite").save())


def read_back(spark: SparkSession, kind: str, path: str, schema: str) -> DataFrame:
    if kind == "csv":
        return spark.read.schema(schema).option("header", True).csv(path)
    if kind == "text":
        return spark.read.text(path)
    return spark.read.schema(schema).format(kind).load(path)


def read_columns(spark: SparkSession, kind: str, path: str, schema: StructType) -> DataFrame:
    """The written table with all its columns; text lines are cut at the separator and cast."""
    back = read_back(spark, kind, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields))
    if kind != "text":
        return back
    fields = F.split("value", ",")
    return back.select(*(F.get(fields, i).cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)))


def round_trips(
    df: DataFrame, path: str, measures: Sequence[Column], kinds: Sequence[str] = tuple(WRITERS), codec: str | None = None
) -> DataFrame:
    """One row per format: the ``measures`` of the table as it is read back from that format."""
    spark, parts = df.sparkSession, []
    for kind in kinds:
        write_as(kind, df, f"{path}/{kind}", codec)
        back = read_columns(spark, kind, f"{path}/{kind}", df.schema)
        parts.append(back.agg(*measures).select(F.lit(kind).alias("format"), "*"))
    return reduce(DataFrame.unionByName, parts)


def compare_formats(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    kinds: Sequence[str] = ("csv", "json", "parquet", "text"),
    codec: str | None = None,
) -> DataFrame:
    """One row per format: write time, bytes, files, read time and rows read back."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    results = []
    for kind in kinds:
        target = f"{path}/{kind}"
        write_millis = timed(lambda: write_as(kind, df, target, codec))
        size = output_metrics(spark, target).first()
        back = read_back(spark, kind, target, schema)
        results.append((kind, write_millis, size["bytes"], size["files"], compute_millis(back), back.count()))
    return spark.createDataFrame(
        results, "format string, write_millis bigint, bytes bigint, files bigint, read_millis bigint, n_rows bigint"
    )
