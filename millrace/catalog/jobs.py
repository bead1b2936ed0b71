"""Whole jobs: trips, profiles, daily summaries, incremental runs, stored reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import frames
from millrace.catalog.frames import CENTS_MEAN, at, table
from millrace.catalog.registry import day, dbl, query, sql_day
from millrace.catalog.scans import TRIPS, trips
from millrace.functions.numbers import money
from millrace.plans import customer_profile, trips as trip_plan
from millrace.plans.daily_summary import daily_summary, refresh_days
from millrace.plans.incremental import IncrementalJob, OffsetTable
from millrace.plans.sales import amount_by_customer, cached, quantity_by_product
from millrace.plans.serving import summary_of
from millrace.session import scratch_path, settle
from millrace.sinks.files import write_lake
from millrace.sources.files import read_lake_day



def summary_sql(transactions: str) -> str:
    return f"""
WITH t AS ({transactions}), c AS (
  SELECT CAST(txn_timestamp AS DATE) AS d, customer_id, category,
         row_number() OVER (PARTITION BY CAST(txn_timestamp AS DATE), customer_id ORDER BY sum(qty) DESC, category) AS rn
  FROM t JOIN ({frames.PRODUCTS}) p USING (product_id) GROUP BY 1, 2, 3)
SELECT {sql_day('CAST(txn_timestamp AS DATE)')} AS day, t.customer_id, CAST(sum(amount) AS DOUBLE) AS total_amount,
       CAST(sum(qty) AS BIGINT) AS total_items, count(DISTINCT product_id) AS distinct_products, any_value(c.category) AS top_category
FROM t LEFT JOIN c ON c.d = CAST(txn_timestamp AS DATE) AND c.customer_id = t.customer_id AND rn = 1
GROUP BY CAST(txn_timestamp AS DATE), t.customer_id"""


SUMMARY = summary_sql(frames.TRANSACTIONS)
EVENT_SUMMARY = summary_sql(frames.EVENT_TRANSACTIONS)


def shown_summary(df: DataFrame) -> DataFrame:
    return df.select(
        day("date").alias("day"), "customer_id", dbl("total_amount").alias("total_amount"),
        "total_items", "distinct_products", "top_category",
    )


@query(SUMMARY)
def daily_customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_summary(daily_summary(frames.transactions(spark, sf_dir), frames.products(spark, sf_dir)))


@query(f"SELECT * FROM ({EVENT_SUMMARY}) WHERE day = '2024-01-17'")
def summary_of_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "summary")
    write_lake(daily_summary(frames.event_transactions(spark, sf_dir), frames.products(spark, sf_dir)), path, ["date"])
    return shown_summary(read_lake_day(spark, path, "2024-01-17"))


@query(f"SELECT * FROM ({EVENT_SUMMARY}) WHERE day = '2024-01-10' AND customer_id = 7")
def summary_of_one_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "summary")
    write_lake(daily_summary(frames.event_transactions(spark, sf_dir), frames.products(spark, sf_dir)), path, ["date"])
    return shown_summary(summary_of(spark.read.parquet(path), "2024-01-10", 7))


@query(EVENT_SUMMARY)
def daily_summary_in_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The early transactions first, then the rest, which also hits days already written; the
    lake must end as if all had come at once, and a run without news must change nothing."""
    rows, products = frames.event_transactions(spark, sf_dir), frames.products(spark, sf_dir)
    lake = scratch_path(spark, "increments")
    offsets = OffsetTable(spark, scratch_path(spark, "offsets"))
    half = rows.agg((F.max("txn_id") / 2).cast("bigint").alias("half")).first()["half"]
    early = rows.filter(F.col("txn_id") <= half)
    for known in (early, rows, rows):
        job = IncrementalJob(
            source="transactions",
            rows=lambda known=known: known,
            offsets=offsets,
            process=lambda delta, known=known: refresh_days(delta, known, products, lake),
        )
        job.run_once()
    return shown_summary(spark.read.parquet(lake))


PROFILE = f"""
WITH t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY txn_timestamp, customer_id, product_id, qty, amount) AS rn
             FROM ({frames.TRANSACTIONS})) WHERE rn = 1),
j AS (SELECT * FROM t JOIN ({frames.CUSTOMERS}) c USING (customer_id) JOIN ({frames.PRODUCTS}) p USING (product_id)),
f AS (SELECT customer_id, category, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, category) AS rn FROM j GROUP BY 1, 2)
SELECT j.customer_id, name, email, gender, CAST(sum(amount) AS DOUBLE) AS total_spend, count(*) AS total_transactions,
       {CENTS_MEAN} AS avg_order_value, {sql_day('min(txn_timestamp)')} AS first_purchase, {sql_day('max(txn_timestamp)')} AS last_purchase,
       any_value(f.category) AS favorite_category
FROM j LEFT JOIN f ON f.customer_id = j.customer_id AND f.rn = 1 GROUP BY j.customer_id, name, email, gender"""


def shown_profile(df: DataFrame) -> DataFrame:
    return df.select(
        "customer_id", "name", "email", "gender",
        dbl("total_spend").alias("total_spend"), "total_transactions", dbl("avg_order_value").alias("avg_order_value"),
        day("first_purchase").alias("first_purchase"), day("last_purchase").alias("last_purchase"), "favorite_category",
    )


@query(PROFILE)
def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customer_profile.clean_transactions(frames.transactions(spark, sf_dir))
    return shown_profile(
        customer_profile.customer_profiles(rows, frames.customers(spark, sf_dir), frames.products(spark, sf_dir))
    )


@query(PROFILE)
def profiles_in_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles rebuilt for the customers of two deltas and merged, the last one twice."""
    # Joined once; each run reads them for its customers and for their history.
    rows, products = settle(frames.transactions(spark, sf_dir), "transactions", "zstd"), frames.products(spark, sf_dir)
    people = frames.customers(spark, sf_dir)
    versions = [scratch_path(spark, "profiles") for _ in range(3)]
    middle = at("1999-06-01 00:00:00")
    early = rows.filter(F.col("txn_timestamp") < middle)
    late = rows.filter(F.col("txn_timestamp") >= middle)
    customer_profile.refresh_profiles(early, early, people, products, None, versions[0])
    customer_profile.refresh_profiles(late, rows, people, products, versions[0], versions[1])
    # Customers without late rows keep the profile of the first run, which has all their rows.
    customer_profile.refresh_profiles(late, rows, people, products, versions[1], versions[2])
    return shown_profile(spark.read.parquet(versions[2]))


CLEAN_TRIPS = f"SELECT * FROM ({TRIPS}) WHERE NOT bad_distance AND NOT bad_rating AND distance_km > 0 AND fare_amount >= 0 AND start_ts < end_ts"


def timed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_plan.with_duration(trip_plan.clean_trips(trips(spark, sf_dir)))


@query(f"SELECT vehicle_type, avg(distance_km) AS avg_distance_km FROM ({CLEAN_TRIPS}) GROUP BY 1")
def trip_distance_by_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_plan.distance_by_vehicle(timed_trips(spark, sf_dir))


@query(f"""
SELECT {sql_day('start_ts')} AS day, CAST(sum(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM ({CLEAN_TRIPS}) GROUP BY 1""")
def trip_revenue_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = timed_trips(spark, sf_dir).withColumn("fare_amount", money("fare_amount"))
    return trip_plan.revenue_by_day(exact).select(day("trip_date").alias("day"), dbl("total_revenue").alias("revenue"))


@query(f"""
SELECT start_location, end_location, count(*) AS trips FROM ({CLEAN_TRIPS}) GROUP BY ALL
ORDER BY trips DESC, start_location, end_location LIMIT 5""")
def trip_busiest_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_plan.busiest_routes(timed_trips(spark, sf_dir))


@query(f"SELECT vehicle_type, count(*) AS trip_count FROM ({CLEAN_TRIPS}) GROUP BY 1")
def trip_counts_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_plan.counts_by_sql(spark, timed_trips(spark, sf_dir), "vehicle_type", ordered=True)


@query(f"SELECT payment_method, count(*) AS trip_count FROM ({CLEAN_TRIPS}) GROUP BY 1")
def payment_counts_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_plan.counts_by_sql(spark, timed_trips(spark, sf_dir), "payment_method")


@query(f"""
SELECT vehicle_type, CAST(min(datediff('second', start_ts, end_ts)) AS DOUBLE) / 60 AS shortest,
       CAST(max(datediff('second', start_ts, end_ts)) AS DOUBLE) / 60 AS longest
FROM ({CLEAN_TRIPS}) GROUP BY 1""")
def trip_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_trips(spark, sf_dir).groupBy("vehicle_type").agg(
        dbl(F.min("duration_minutes")).alias("shortest"), dbl(F.max("duration_minutes")).alias("longest")
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips of up to 94 minutes; the first few lengths give no valid end."""
    k = F.get_json_object("props", "$.k").cast("int")
    end = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), k - 5)
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("vehicle_type"),
        F.date_format("ts", iso).alias("start_time"),
        F.date_format(end, iso).alias("end_time"),
        k.cast("double").alias("distance_km"),
        money("value").alias("fare_amount"),
    )


@query("""
SELECT event_type AS vehicle_type, CAST(avg(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,4))::DOUBLE AS avg_fare
FROM events WHERE CAST(props->>'k' AS INTEGER) > 5 AND value >= 0 GROUP BY 1""")
def trip_report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = trip_plan.with_duration(trip_plan.clean_trips(event_trips(spark, sf_dir)))
    lake, report = scratch_path(spark, "trips-by-day"), scratch_path(spark, "report")
    written = trip_plan.store_and_report(spark, rides, lake, report)
    rows = spark.read.schema("vehicle_type string, fare decimal(18,6)").csv(written)
    return rows.select("vehicle_type", dbl(F.round("fare", 4)).alias("avg_fare"))


@query("""
SELECT 'customer' AS part, o_custkey AS id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY ALL
UNION ALL
SELECT 'product', l_partkey, sum(l_quantity) FROM lineitem GROUP BY ALL""")
def cached_sales_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customerId"), money("o_totalprice").alias("amount"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("productId"), F.col("l_quantity").alias("quantity"))
    by_product = quantity_by_product(lines).select(
        F.lit("product").alias("part"), F.col("productId").alias("id"), dbl("total_quantity").alias("total")
    )
    with cached(orders, materialise=True) as kept:
        by_customer = amount_by_customer(kept).select(
            F.lit("customer").alias("part"), F.col("customerId").alias("id"), dbl("total_amount").alias("total")
        )
        # Stored while the orders are still cached.
        stored = settle(by_customer.unionByName(by_product), "sales")
    return stored


@query("SELECT event_type AS source, max(event_id) AS last_id FROM events GROUP BY 1")
def offsets_never_regress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest id per event type, committed as an offset after the smallest and before it."""
    ends = table(spark, sf_dir, "events").groupBy("event_type").agg(F.min("event_id").alias("low"), F.max("event_id").alias("high"))
    offsets = OffsetTable(spark, scratch_path(spark, "offsets"))
    for moved_to in ("low", "high", "low"):
        offsets.commit(ends.select(F.col("event_type").alias("source"), F.col(moved_to).alias("last_id")))
    return offsets.all()
