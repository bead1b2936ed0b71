"""The trip report: clean, derive, aggregate, store by day, read back and export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.times import minutes_between, parse_time
from millrace.operators.aggregates import count_by, mean_by, sum_by
from millrace.operators.ordering import top_k
from millrace.operators.rows import valid_trips
from millrace.sinks.files import write_lake, write_report


def clean_trips(trips: DataFrame) -> DataFrame:
    parsed = trips.withColumn("start_ts", parse_time(F.col("start_time"))).withColumn(
        "end_ts", parse_time(F.col("end_time"))
    )
    return valid_trips(parsed)


def with_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn("duration_minutes", minutes_between(F.col("start_ts"), F.col("end_ts"))).withColumn(
        "trip_date", F.to_date("start_ts")
    )


def distance_by_vehicle(trips: DataFrame) -> DataFrame:
    return mean_by(trips, ["vehicle_type"], "distance_km", "avg_distance_km")


def revenue_by_day(trips: DataFrame) -> DataFrame:
    return sum_by(trips, ["trip_date"], "fare_amount", "total_revenue")


def busiest_routes(trips: DataFrame, k: int = 5) -> DataFrame:
    ends = ["start_location", "end_location"]
    return top_k(count_by(trips, ends, "trips"), "trips", ends, k)


def counts_by_sql(spark: SparkSession, trips: DataFrame, column: str, ordered: bool = False) -> DataFrame:
    """The count per value of one column, as SQL over a temporary view."""
    trips.createOrReplaceTempView("trips")
    order = f" ORDER BY trip_count DESC, {column}" if ordered else ""
    return spark.sql(f"SELECT {column}, COUNT(*) AS trip_count FROM trips GROUP BY {column}{order}")


def store_and_report(spark: SparkSession, trips: DataFrame, lake: str, report: str) -> str:
    """Write the trips by day, average the fare per vehicle from the stored copy, export that."""
    write_lake(trips, lake, ["trip_date"])
    fares = mean_by(spark.read.parquet(lake), ["vehicle_type"], "fare_amount", "avg_fare_amount")
    return write_report(fares, report, "avg_fare_by_vehicle.csv", header=False)
