"""Scans: every file form is written from the supplied tables and read back by the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.frames import table
from millrace.catalog.registry import big, day, dbl, query, sql_day
from millrace.functions.numbers import money
from millrace.operators.skew import join_on
from millrace.session import scratch_path
from millrace.sinks.files import write_csv, write_lake, write_parquet
from millrace.sources.external import probe
from millrace.sources.files import (
    read_csv,
    read_csv_inferred,
    read_csv_strings,
    read_lake_day,
    read_log_lines,
    read_long_distances,
    read_parquet,
    read_trips,
)


@query("""
SELECT l_linenumber AS line, count(*) AS n_rows, sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END)::BIGINT AS n_quantity,
       sum(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END) AS quantity
FROM lineitem GROUP BY l_linenumber""")
def csv_scan_with_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_quantity").cast("string"))
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", quantity.alias("quantity")), path)
    rows = read_csv(spark, path, "order_key bigint, line int, quantity double")
    return rows.groupBy("line").agg(
        F.count("*").alias("n_rows"), F.count("quantity").alias("n_quantity"), F.sum("quantity").alias("quantity")
    )


@query("""
SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey, c_acctbal::VARCHAR AS c_acctbal
FROM customer""")
def csv_scan_all_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "customer").drop("c_mktsegment"), path)
    return read_csv_strings(spark, path)


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), path)
    rows = read_csv_inferred(spark, path)
    kinds = [f.dataType.simpleString() for f in rows.schema.fields]
    # Whole numbers are inferred as int or bigint, as the values ask for.
    if [k.replace("bigint", "int") for k in kinds] != ["int", "string", "int", "double"]:
        raise TypeError(f"inferred {rows.schema.simpleString()}")
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("p_partkey", "p_size")})


TRIPS = """
SELECT l_orderkey * 10 + l_linenumber AS trip_id, l_suppkey AS driver_id, l_returnflag AS vehicle_type,
       o_orderdate AS start_ts, l_shipdate AS end_ts, cn.n_name AS start_location, sn.n_name AS end_location,
       l_quantity AS distance_km, l_extendedprice AS fare_amount, o_orderpriority AS payment_method,
       l_discount AS customer_rating, l_discount >= 0.1 AS bad_distance, l_tax >= 0.08 AS bad_rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey"""


def trip_lines_path(spark: SparkSession, sf_dir: str) -> str:
    """Order lines as trip lines: mixed time forms, some unreadable distances and ratings, a
    header and a blank line per file."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), "n_name")
    places = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    starts = join_on(places, nations, ["nation"]).select(
        F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("start_location")
    )
    depots = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    ends = join_on(depots, nations, ["nation"]).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("end_location")
    )
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem").withColumn("o_orderkey", F.col("l_orderkey"))
    placed = join_on(orders, starts, ["o_custkey"])
    rides = join_on(lineitem, placed, ["o_orderkey"])
    rides = join_on(rides, ends, ["l_suppkey"])
    begin = F.when(
        F.col("l_linestatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    fields = [
        F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        F.col("l_suppkey"),
        F.concat(F.lit(" "), F.col("l_returnflag"), F.lit(" ")),
        begin,
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm"),
        F.col("start_location"),
        F.col("end_location"),
        F.when(F.col("l_discount") >= 0.1, "far").otherwise(F.col("l_quantity").cast("string")),
        F.col("l_extendedprice"),
        F.col("o_orderpriority"),
        F.when(F.col("l_tax") >= 0.08, "n/a").otherwise(F.col("l_discount").cast("string")),
    ]
    lines = rides.select(F.concat_ws(",", *(f.cast("string") for f in fields)).alias("value"))
    extra = spark.createDataFrame([("   ",), ("1,2,short line",)], "value string")
    path = scratch_path(spark, "trips")
    header = "tripId,driverId,vehicleType,startTime,endTime,startLocation,endLocation,distanceKm,fareAmount,paymentMethod,customerRating"
    spark.createDataFrame([(header,)], "value string").coalesce(1).write.text(path)
    lines.unionByName(extra).write.mode("append").text(path)
    return path


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_trips(spark, trip_lines_path(spark, sf_dir))


@query(f"""
SELECT vehicle_type, payment_method, count(*) AS n, sum(distance_km) AS distance_km,
       CAST(sum(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) AS fare, count(DISTINCT driver_id) AS drivers
FROM ({TRIPS}) WHERE NOT bad_distance AND NOT bad_rating GROUP BY ALL""")
def trip_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).groupBy("vehicle_type", "payment_method").agg(
        F.count("*").alias("n"),
        F.sum("distance_km").alias("distance_km"),
        dbl(F.sum(money("fare_amount"))).alias("fare"),
        F.countDistinct("driver_id").alias("drivers"),
    )


@query(f"""
SELECT vehicle_type, distance_km, count(*) AS n FROM ({TRIPS})
WHERE NOT bad_distance AND distance_km > 10 GROUP BY ALL""")
def long_trips_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_long_distances(spark, trip_lines_path(spark, sf_dir))
    return rows.groupBy("vehicle_type", "distance_km").agg(F.count("*").alias("n"))


def log_lines_path(spark: SparkSession, sf_dir: str) -> str:
    events = table(spark, sf_dir, "events")
    fields = (
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
        F.upper("event_type"),
        F.when(F.col("value") > 100, F.concat(F.lit("|ERROR|"), F.col("props"))).otherwise(F.col("props")),
        F.col("user_id").cast("string"),
    )
    path = scratch_path(spark, "logs")
    events.select(F.concat_ws("|", *fields).alias("value")).write.text(path)
    return path


@query("""
SELECT upper(event_type) AS level, count(*) AS n, sum(CASE WHEN value > 100 THEN 1 ELSE 0 END)::BIGINT AS n_shifted
FROM events GROUP BY 1""")
def log_line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_log_lines(spark, log_lines_path(spark, sf_dir))
    return rows.groupBy("level").agg(F.count("*").alias("n"), F.count_if(F.col("message") == "").alias("n_shifted"))


@query("SELECT r_name, n_name FROM region JOIN nation ON n_regionkey = r_regionkey")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    write_parquet(join_on(nation, table(spark, sf_dir, "region"), ["r_regionkey"]), path)
    return read_parquet(spark, path).select("r_name", "n_name")


@query(f"""
SELECT {sql_day('ts')} AS day, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10' GROUP BY ALL""")
def lake_scan_of_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lake")
    write_lake(table(spark, sf_dir, "events").withColumn("date", F.to_date("ts")), path, ["date"])
    rows = read_lake_day(spark, path, "2024-01-10")
    return rows.groupBy(day("date").alias("day"), "event_type").agg(
        F.count("*").alias("n"), dbl(F.sum(money("value"))).alias("total")
    )


@query("""
SELECT coalesce(min(event_id), 0) AS min_id, coalesce(max(event_id), 0) AS max_id, count(*) AS n
FROM events WHERE event_id > 400""")
def offset_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probe(table(spark, sf_dir, "events"), "event_id", 400)


@query("""
SELECT coalesce(min(event_id), 0) AS min_id, coalesce(max(event_id), 0) AS max_id, count(*) AS n
FROM events WHERE event_id > 1000000000000""")
def offset_probe_without_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probe(table(spark, sf_dir, "events"), "event_id", 1_000_000_000_000).select(big("min_id").alias("min_id"), big("max_id").alias("max_id"), "n")
