"""File sinks: formats, partitioned lakes, dynamic overwrite, single-file reports, output metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_folder

REPORT_ROWS = 100_000
# A compressed text file is read by one task, so it holds at most so many rows.
COMPRESSED_ROWS = 1_000_000


def write_parquet(df: DataFrame, path: str, codec: str = "snappy") -> None:
    df.write.mode("overwrite").option("compression", codec).parquet(path)


def write_observed(df: DataFrame, path: str, **counts: Column) -> dict[str, int]:
    """Write Parquet and count the written rows, and those that meet each condition, on the way."""
    seen = Observation()
    counted = [F.count(F.lit(1)).alias("n_rows"), *(F.count_if(c).alias(name) for name, c in counts.items())]
    write_parquet(df.observe(seen, *counted), path)
    return seen.get


def _text_writer(df: DataFrame, codec: str | None) -> DataFrameWriter:
    """An overwriting writer of text files, plain ones unless a codec is named."""
    writer = df.write.mode("overwrite")
    return writer.option("compression", codec).option("maxRecordsPerFile", COMPRESSED_ROWS) if codec else writer


def write_csv(df: DataFrame, path: str, header: bool = True, codec: str | None = None) -> None:
    _text_writer(df, codec).option("header", header).csv(path)


def write_json(df: DataFrame, path: str, codec: str | None = None) -> None:
    _text_writer(df, codec).option("ignoreNullFields", False).json(path)


def write_text(df: DataFrame, path: str, separator: str = ",", codec: str | None = None) -> None:
    line = F.concat_ws(separator, *(F.col(c).cast("string") for c in df.columns))
    _text_writer(df.select(line.alias("value")), codec).text(path)


def laid_out(df: DataFrame, partition: Sequence[str], tasks: int | None = None) -> DataFrame:
    """``df`` shuffled for a partitioned write, so that each folder gets few files.

    By default a rebalance: small partitions share a task and one that holds a large share of the
    rows is split over several. ``tasks`` fixes the parallelism instead, for very many small
    partitions; ranges over the partition and a row hash split a heavy value there too.
    """
    if tasks is None:
        return df.hint("rebalance", *partition)
    return df.repartitionByRange(tasks, *partition, F.xxhash64(*df.columns))


def write_lake(
    df: DataFrame, path: str, partition: Sequence[str], mode: str = "overwrite", tasks: int | None = None
) -> None:
    """Hive-style partitioned Parquet."""
    laid_out(df, partition, tasks).write.mode(mode).partitionBy(*partition).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition: Sequence[str], tasks: int | None = None) -> None:
    """Rewrite only the partitions that occur in ``df``; all others stay. Safe to repeat."""
    (
        laid_out(df, partition, tasks)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .parquet(path)
    )


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The part files directly under ``path``, for folders that are kept small."""
    fs, folder = _file_system(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders directly under ``path`` whose write has been completed."""
    if not path_exists(spark, path):
        return []
    fs, folder = _file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return sorted(n for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS"))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a target if it is there; returns whether it was."""
    fs, target = _file_system(spark, path)
    return fs.exists(target) and fs.delete(target, True)


def drop_scratch(spark: SparkSession) -> bool:
    """Remove what this application left in the shared folder, when all its results are stored."""
    return delete_path(spark, scratch_folder(spark))


def reachable(spark: SparkSession, path: str) -> bool:
    """The path or its parent exists, so the store, its credentials and the bucket are usable."""
    fs, target = _file_system(spark, path)
    return fs.exists(target) or (target.getParent() is not None and fs.exists(target.getParent()))


def write_report(
    df: DataFrame,
    path: str,
    file_name: str,
    header: bool = True,
    kind: str = "csv",
    single: bool = True,
    max_rows: int = REPORT_ROWS,
) -> str:
    """Export a report as CSV or JSON lines; returns the path to read.

    The caller chooses the form: one file with that name, for which a result of more than
    ``max_rows`` rows raises, or a folder of part files, written in parallel for any size.
    """
    if kind not in ("csv", "json"):
        raise ValueError(f"a report is csv or json, not {kind}")
    spark = df.sparkSession
    target = f"{path}/{file_name}"
    write = (lambda rows, to: write_csv(rows, to, header)) if kind == "csv" else write_json
    if not single:
        write(df, target)
        return target
    # ``take`` stops at the bound, and only constants reach the driver.
    if len(df.select(F.lit(1)).take(max_rows + 1)) > max_rows:
        raise ValueError(f"more than {max_rows} rows do not go into one file; write a folder instead")
    staging = f"{path}/_staging_{file_name}"
    write(df.coalesce(1), staging)
    fs, folder = _file_system(spark, staging)
    parts = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {staging}, found {len(parts)}")
    _, final = _file_system(spark, target)
    fs.delete(final, True)
    if not fs.rename(parts[0], final):
        raise RuntimeError(f"could not move the report to {target}")
    fs.delete(folder, True)
    return target


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file: its folder below ``path`` (empty at the top), name and bytes."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select("path", "length")
    )
    inside = F.substring_index(F.col("path"), path.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
    name = F.substring_index(inside, "/", -1)
    folder = F.when(F.contains(inside, F.lit("/")), F.regexp_replace(inside, "/[^/]*$", "")).otherwise("")
    return listing.select(folder.alias("folder"), name.alias("file"), F.col("length").alias("bytes"))


def output_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Total bytes, number of data files and of partition folders of a written table."""
    return file_sizes(spark, path).agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.count("*").alias("files"),
        F.countDistinct(F.nullif(F.col("folder"), F.lit(""))).alias("partitions"),
    )


def files_per_partition(spark: SparkSession, path: str) -> DataFrame:
    return file_sizes(spark, path).groupBy("folder").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
