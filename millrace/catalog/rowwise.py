"""Projections, filters, splits and life-cycle predicates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import frames
from millrace.catalog.frames import AS_OF, EVENTS_AS_OF, at, table
from millrace.catalog.registry import big, day, dbl, query, sql_day, sql_stamp, stamp
from millrace.functions.payloads import JsonCodec
from millrace.functions.text import is_email, is_phone
from millrace.functions.times import is_iso_date
from millrace.operators import rows
from millrace.operators.joins import restrict_to_keys
from millrace.plans.trips import clean_trips
from millrace.streaming.events import CUSTOMER_EVENT, decode, normalise, split_events


@query("SELECT s_suppkey, s_name FROM supplier")
def column_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")


@query("""
SELECT c_custkey::INTEGER AS customer_id, c_name AS name, try_cast(c_mktsegment AS DOUBLE) AS segment_number,
       c_nationkey::BIGINT AS nation, c_acctbal AS balance
FROM customer""")
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {
        "customer_id": ("c_custkey", "int"),
        "name": ("c_name", "string"),
        "segment_number": ("c_mktsegment", "double"),
        "nation": ("c_nationkey", "bigint"),
        "balance": ("c_acctbal", "double"),
    }
    return rows.typed(table(spark, sf_dir, "customer"), spec)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1 - l_discount) AS net,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross
FROM lineitem""")
def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
        .withColumn("gross", F.col("net") * (1 + F.col("l_tax")))
        .select("l_orderkey", "l_linenumber", "l_partkey", "net", "gross")
    )


@query("SELECT p_partkey AS product_id, p_name AS product_name, p_brand, p_type, p_size FROM part")
def rename_and_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "product_id")
    return renamed.withColumnRenamed("p_name", "product_name").drop("p_retailprice")


@query("SELECT event_id, CAST(props->>'k' AS BIGINT) AS k FROM events")
def struct_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.from_json("props", "k bigint").alias("data")
    return table(spark, sf_dir, "events").select("event_id", data).select("event_id", "data.*")


@query("SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > 950")
def price_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(F.col("p_retailprice") > 950).select("p_partkey", "p_retailprice")


@query("SELECT event_id, user_id FROM events WHERE event_type = 'error'")
def level_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select("event_id", "user_id")


@query("""
SELECT count(*) AS n_lines,
       sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS n_by_field,
       sum(CASE WHEN event_type = 'error' OR value > 100 THEN 1 ELSE 0 END)::BIGINT AS n_by_text
FROM events""")
def raw_line_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.catalog.scans import log_lines_path

    lines = spark.read.text(log_lines_path(spark, sf_dir))
    level = F.get(F.split("value", r"\|"), F.lit(1))
    return lines.agg(
        F.count("*").alias("n_lines"),
        F.count_if(level == "ERROR").alias("n_by_field"),
        F.count_if(F.contains("value", F.lit("|ERROR|"))).alias("n_by_text"),
    )


@query("""
SELECT CASE WHEN event_type = 'signup' THEN 'missing' ELSE 'present' END AS schedule, count(*) AS n
FROM events GROUP BY 1""")
def null_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = frames.notifications(spark, sf_dir)
    missing = notes.filter(F.col("scheduled_for").isNull()).select(F.lit("missing").alias("schedule"))
    present = notes.filter(F.col("scheduled_for").isNotNull()).select(F.lit("present").alias("schedule"))
    return missing.unionByName(present).groupBy("schedule").agg(F.count("*").alias("n"))


def _trips_sql() -> str:
    from millrace.catalog.scans import TRIPS

    return f"""
SELECT start_location, count(*) AS n, sum(distance_km) AS distance_km FROM ({TRIPS})
WHERE NOT bad_distance AND NOT bad_rating AND distance_km > 0 AND fare_amount >= 0 AND start_ts < end_ts GROUP BY 1"""


def valid_trips_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.catalog.scans import trips

    return clean_trips(trips(spark, sf_dir)).groupBy("start_location").agg(
        F.count("*").alias("n"), F.sum("distance_km").alias("distance_km")
    )


query(_trips_sql())(valid_trips_only)


@query("""
SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) AS amount
FROM lineitem WHERE l_returnflag <> 'N' AND l_quantity > 5 AND l_extendedprice > 0""")
def valid_transactions_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("customer_id"),
        F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("product_id"),
        (F.col("l_quantity") - 5).alias("qty"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
    )
    return rows.valid_transactions(lines).agg(F.count("*").alias("n"), dbl(F.sum("amount")).alias("amount"))


@query("""
SELECT CASE WHEN event_type = 'error' THEN 'malformed' ELSE 'valid' END AS part, count(*) AS n,
       count(DISTINCT event_id) AS n_ids
FROM events GROUP BY 1""")
def valid_and_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = frames.customer_event_messages(table(spark, sf_dir, "events"))
    valid, malformed = split_events(decode(messages, JsonCodec(CUSTOMER_EVENT)))
    both = valid.withColumn("part", F.lit("valid")).unionByName(malformed.withColumn("part", F.lit("malformed")))
    return both.groupBy("part").agg(F.count("*").alias("n"), F.countDistinct("value").alias("n_ids"))


@query(f"""
SELECT event_id::VARCHAR AS event_id, customer_id, CAST(CASE WHEN product_raw >= 0 THEN product_raw END AS DOUBLE) AS product_id,
       {sql_stamp('event_at')} AS event_timestamp
FROM ({frames.MESSAGES_SQL}) WHERE NOT broken""")
def normalised_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = frames.customer_event_messages(table(spark, sf_dir, "events"))
    valid, _ = split_events(decode(messages, JsonCodec(CUSTOMER_EVENT)))
    return normalise(valid, F.lit(EVENTS_AS_OF).cast("timestamp")).select(
        "event_id", big("customer_id").alias("customer_id"), dbl("product_id").alias("product_id"), stamp("event_timestamp").alias("event_timestamp")
    )


@query("""
SELECT event_id, CASE WHEN CAST(props->>'k' AS INTEGER) >= 10 THEN CAST(props->>'k' AS DOUBLE) - 10 END AS product_id
FROM events""")
def negative_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = F.get_json_object("props", "$.k").cast("int") - 10
    return table(spark, sf_dir, "events").select("event_id", dbl(F.when(product >= 0, product)).alias("product_id"))


@query(f"""
SELECT {sql_day("CASE WHEN event_type <> 'signup' THEN ts - INTERVAL 1 DAY ELSE ts END")} AS day, count(*) AS n
FROM events GROUP BY 1""")
def first_known_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = F.when(F.col("event_type") != "signup", F.date_format(F.col("ts") - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss"))
    known = F.coalesce(F.try_to_timestamp(stated), F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").groupBy(day(known).alias("day")).agg(F.count("*").alias("n"))


@query(f"""
SELECT 'active' AS life, count(*) AS n FROM ({frames.TASKS}) WHERE NOT is_deleted
UNION ALL SELECT 'deleted', count(*) FROM ({frames.TASKS}) WHERE is_deleted
UNION ALL SELECT 'any', count(*) FROM ({frames.TASKS})""")
def soft_delete_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = frames.tasks(spark, sf_dir)
    # One scan for all three views.
    counts = tasks.agg(
        F.count_if(~F.col("is_deleted")).alias("active"), F.count_if("is_deleted").alias("deleted"), F.count("*").alias("any")
    )
    return counts.select(F.explode(F.create_map(*(x for c in ("active", "deleted", "any") for x in (F.lit(c), F.col(c))))).alias("life", "n"))


@query(f"SELECT task_id, title, status FROM ({frames.TASKS}) WHERE NOT is_deleted")
def active_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.active(frames.tasks(spark, sf_dir)).select("task_id", "title", "status")


@query(f"SELECT task_id, title, status FROM ({frames.TASKS}) WHERE is_deleted")
def deleted_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.deleted(frames.tasks(spark, sf_dir)).select("task_id", "title", "status")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey = 42")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.lookup(table(spark, sf_dir, "customer"), c_custkey=42).select("c_custkey", "c_name", "c_acctbal")


@query(f"""
SELECT o_orderkey, {sql_stamp('o_orderdate')} AS placed FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-06-30'""")
def time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rows.within(table(spark, sf_dir, "orders"), "o_orderdate", datetime(1997, 3, 1), datetime(1997, 6, 30))
    return found.select("o_orderkey", stamp("o_orderdate").alias("placed"))


@query(f"""
SELECT task_id, {sql_stamp('estimated_start')} AS estimated_start FROM ({frames.TASKS})
WHERE NOT is_deleted AND status <> 'Completed' AND estimated_start IS NOT NULL
  AND estimated_start BETWEEN TIMESTAMP '{AS_OF}' AND TIMESTAMP '{AS_OF}' + INTERVAL 7 DAY""")
def tasks_starting_soon(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rows.starting_soon(frames.tasks(spark, sf_dir), at(), at() + F.expr("INTERVAL 7 DAYS"))
    return found.select("task_id", stamp("estimated_start").alias("estimated_start"))


@query(f"""
SELECT task_id, status, {sql_stamp('estimated_end')} AS estimated_end FROM ({frames.TASKS})
WHERE NOT is_deleted AND status <> 'Completed' AND estimated_end < TIMESTAMP '{AS_OF}'""")
def overdue_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rows.overdue_tasks(frames.tasks(spark, sf_dir), at())
    return found.select("task_id", "status", stamp("estimated_end").alias("estimated_end"))


@query(f"""
SELECT allocation_id, equipment_id, {sql_stamp('expected_return_at')} AS expected_return_at FROM ({frames.ALLOCATIONS})
WHERE NOT is_deleted AND status = 'ACTIVE' AND returned_at IS NULL AND expected_return_at < TIMESTAMP '{AS_OF}'""")
def overdue_allocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rows.overdue_allocations(frames.allocations(spark, sf_dir), at())
    return found.select("allocation_id", "equipment_id", stamp("expected_return_at").alias("expected_return_at"))


@query(f"""
SELECT notification_id, task_id FROM ({frames.NOTIFICATIONS})
WHERE NOT is_deleted AND status = 'pending' AND (scheduled_for IS NULL OR scheduled_for <= TIMESTAMP '{EVENTS_AS_OF}')
ORDER BY scheduled_for NULLS FIRST, notification_id LIMIT 50""")
def due_notifications_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.plans.notifications import next_due

    found = next_due(frames.notifications(spark, sf_dir), at(EVENTS_AS_OF), 50)
    return found.select("notification_id", "task_id")


@query("""
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def member_of_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    return table(spark, sf_dir, "customer").filter(wanted).select("c_custkey", "c_mktsegment")


@query("""
SELECT s_suppkey, s_nationkey FROM supplier
WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 2))""")
def member_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "nation").filter(F.col("n_regionkey").isin(1, 2))
    keys = wanted.select(F.col("n_nationkey").alias("s_nationkey"))
    return restrict_to_keys(table(spark, sf_dir, "supplier"), keys, ["s_nationkey"]).select("s_suppkey", "s_nationkey")


@query(f"SELECT equipment_id, asset_tag FROM ({frames.ITEMS}) WHERE NOT is_deleted AND status = 'AVAILABLE' AND type_id = 7")
def available_items_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.available_items(frames.items(spark, sf_dir), 7).select("equipment_id", "asset_tag")


@query("""
SELECT o_orderkey, 'Order ' || o_orderkey || ' is ' || o_orderstatus || ' for ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS line
FROM orders WHERE o_totalprice > 450000 AND o_orderstatus = 'F'""")
def status_guard_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = (F.col("o_totalprice") > 450000) & (F.col("o_orderstatus") == "F")
    line = F.format_string("Order %d is %s for %.2f", "o_orderkey", "o_orderstatus", "o_totalprice")
    return table(spark, sf_dir, "orders").filter(good).select("o_orderkey", line.alias("line"))


@query(r"""
SELECT violations, count(*) AS n FROM (
  SELECT concat_ws('; ',
    CASE WHEN NOT regexp_full_match(email, '[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') THEN 'email' END,
    CASE WHEN NOT regexp_full_match(phone, '[0-9]{10,15}') THEN 'phone' END,
    CASE WHEN name IS NULL THEN 'name' END,
    CASE WHEN length(born) < 10 OR try_cast(born AS DATE) IS NULL THEN 'date' END,
    CASE WHEN NOT (page_limit BETWEEN 1 AND 500) THEN 'limit' END) AS violations
  FROM (
    SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
           CASE WHEN c_nationkey < 5 THEN c_custkey::VARCHAR ELSE lpad(c_custkey::VARCHAR, 12, '0') END AS phone,
           CASE WHEN c_acctbal >= 0 THEN c_name END AS name,
           CASE WHEN c_nationkey > 20 THEN '2024-13-40' WHEN c_nationkey > 18 THEN '2024' ELSE '2024-01-15' END AS born,
           c_nationkey * 25 AS page_limit
    FROM customer))
GROUP BY violations""")
def field_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, nation = F.col("c_name"), F.col("c_nationkey")
    mail = F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@example.com"))
    number = F.col("c_custkey").cast("string")
    people = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", name).otherwise(mail).alias("email"),
        F.when(nation < 5, number).otherwise(F.lpad(number, 12, "0")).alias("phone"),
        F.when(F.col("c_acctbal") >= 0, name).alias("name"),
        F.when(nation > 20, "2024-13-40").when(nation > 18, "2024").otherwise("2024-01-15").alias("born"),
        (nation * 25).alias("page_limit"),
    )
    rules = {
        "email": is_email(F.col("email")),
        "phone": is_phone(F.col("phone")),
        "name": F.col("name").isNotNull(),
        "date": is_iso_date(F.col("born")),
        "limit": F.col("page_limit").between(1, 500),
    }
    return people.groupBy(rows.violations(rules).alias("violations")).agg(F.count("*").alias("n"))
