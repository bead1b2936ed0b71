"""File scans: CSV, delimited text, log lines, Parquet and date-partitioned lakes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a trip line in file order, with their types.
TRIP_FIELDS = (
    ("trip_id", "bigint"),
    ("driver_id", "int"),
    ("vehicle_type", "string"),
    ("start_time", "string"),
    ("end_time", "string"),
    ("start_location", "string"),
    ("end_location", "string"),
    ("distance_km", "double"),
    ("fare_amount", "double"),
    ("payment_method", "string"),
    ("customer_rating", "double"),
)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a fixed schema; a cell that does not convert is null."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Types come from the data, at the price of one more pass over the files."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_lake_day(spark: SparkSession, path: str, day: str, column: str = "date") -> DataFrame:
    """One day of a date-partitioned lake; the filter prunes all other directories."""
    return spark.read.parquet(path).filter(F.col(column) == F.lit(day).cast("date"))


def trip_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank data lines as an array of untrimmed fields ``f``; header lines are dropped."""
    lines = spark.read.text(path)
    keep = (F.trim("value") != "") & ~F.lower(F.trim("value")).startswith("tripid")
    # Unrolling one value keeps filters above the split, so a line is split once and not per field.
    fields = F.explode(F.array(F.split("value", ",")))
    return lines.filter(keep).select(fields.alias("f")).filter(F.size("f") >= len(TRIP_FIELDS))


def _trimmed(index: int) -> Column:
    return F.trim(F.get("f", F.lit(index)))


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Typed trips; a line with any number that does not parse is dropped as a whole."""
    lines = trip_lines(spark, path)
    columns = [_trimmed(i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(TRIP_FIELDS)]
    numeric = [name for name, kind in TRIP_FIELDS if kind != "string"]
    return lines.select(*columns).dropna(subset=numeric)


def read_long_distances(spark: SparkSession, path: str, above: float = 10.0) -> DataFrame:
    """Vehicle type and distance of long trips; only the distance has to parse."""
    distance = _trimmed(7).try_cast("double")
    return (
        trip_lines(spark, path)
        .select(_trimmed(2).alias("vehicle_type"), distance.alias("distance_km"))
        .filter(F.col("distance_km") > above)
    )


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``time|level|message|user`` lines."""
    parts = F.split("value", r"\|")
    names = ("ts", "level", "message", "user_id")
    return spark.read.text(path).select(*(F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)))
