"""Sorting, top-k, paging, sampling and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import frames
from millrace.catalog.frames import at, table
from millrace.catalog.registry import big, day, dbl, query, sql_stamp, stamp
from millrace.functions.numbers import money
from millrace.operators import ordering
from millrace.operators.aggregates import position, sum_by
from millrace.plans.serving import as_json, customer_events, planned_page


@query("""
SELECT p_partkey, p_retailprice, CAST(row_number() OVER (ORDER BY p_retailprice, p_partkey) AS BIGINT) AS place
FROM part WHERE p_retailprice > 930""")
def filtered_global_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    dear = table(spark, sf_dir, "part").filter(F.col("p_retailprice") > 930).select("p_partkey", "p_retailprice")
    placed = position(dear, ["p_retailprice", "p_partkey"], "place")
    return ordering.sort_all(placed.select("p_partkey", "p_retailprice", big("place").alias("place")), "p_retailprice", ["p_partkey"])


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def global_sort_descending(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return ordering.sort_all(scores, "c_acctbal", ["c_custkey"], descending=True)


@query("""
SELECT o_custkey AS account, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1 ORDER BY total DESC, account LIMIT 10""")
def top_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("account"), money("o_totalprice").alias("amount"))
    totals = ordering.top_k(sum_by(paid, ["account"], "amount", "total"), "total", ["account"], 10)
    return totals.withColumn("total", dbl("total"))


@query("""
SELECT c_custkey, c_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2 ORDER BY total_spent DESC, c_custkey LIMIT 10""")
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), money("o_totalprice").alias("amount"))
    best = ordering.top_k(sum_by(paid, ["c_custkey"], "amount", "total_spent"), "total_spent", ["c_custkey"], 10)
    # Ten rows, so the names come by broadcast.
    named = table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(F.broadcast(best), "c_custkey")
    return named.withColumn("total_spent", dbl("total_spent"))


@query("SELECT event_id, event_type FROM events ORDER BY ts, event_id LIMIT 5")
def first_rows_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").orderBy("ts", "event_id").limit(5).select("event_id", "event_type")


@query("""
SELECT 'events' AS name, (SELECT count(*) > 0 FROM events) AS has_rows
UNION ALL SELECT 'negative orders', (SELECT count(*) > 0 FROM orders WHERE o_totalprice < 0)""")
def existence_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = table(spark, sf_dir, "events").limit(1).agg((F.count("*") > 0).alias("has_rows"))
    none = table(spark, sf_dir, "orders").filter("o_totalprice < 0").limit(1).agg((F.count("*") > 0).alias("has_rows"))
    return some.withColumn("name", F.lit("events")).unionByName(none.withColumn("name", F.lit("negative orders")))


@query("SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 20")
def limit_in_fixed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source").orderBy("doc_id").limit(20)


IN_RANGE = f"SELECT * FROM ({frames.TASKS}) WHERE NOT is_deleted AND estimated_start BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'"
VISIBLE = f"SELECT t.*, full_name FROM ({IN_RANGE}) t JOIN ({frames.USERS}) u ON u.user_id = t.created_by WHERE NOT u.is_deleted"


@query(f"""
SELECT task_id, full_name, {sql_stamp('estimated_start')} AS estimated_start,
       (SELECT count(*) FROM ({IN_RANGE})) AS total, (SELECT count(*) FROM ({VISIBLE})) AS total_visible
FROM ({VISIBLE}) v ORDER BY v.estimated_start NULLS LAST, task_id LIMIT 20 OFFSET 40""")
def page_with_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = planned_page(
        frames.tasks(spark, sf_dir), frames.users(spark, sf_dir), "estimated_start", "task_id",
        at("1997-01-01 00:00:00"), at("1997-12-31 00:00:00"), page=3, size=20,
    )
    return found.select("task_id", "full_name", stamp("estimated_start").alias("estimated_start"), "total", "total_visible")


@query(f"""
SELECT task_id, {sql_stamp('estimated_start')} AS estimated_start, CAST(row_number() OVER (ORDER BY estimated_start NULLS LAST, task_id) AS BIGINT) AS place
FROM ({frames.TASKS}) QUALIFY place > (SELECT count(*) FROM ({frames.TASKS})) - 100""")
def nulls_last_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = frames.tasks(spark, sf_dir).select("task_id", "estimated_start")
    # Positions of the rows with a time and then, after them, of those without.
    flagged = tasks.withColumn("unknown", F.col("estimated_start").isNull())
    placed = position(flagged, ["unknown", "estimated_start", "task_id"], "place")
    placed = placed.filter(F.col("place") > tasks.agg(F.count("*")).scalar() - 100)
    return placed.select("task_id", stamp("estimated_start").alias("estimated_start"), big("place").alias("place"))


@query(f"""
SELECT event_id, {sql_stamp('ts')} AS event_timestamp FROM events
WHERE user_id = 7 AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
ORDER BY CAST(ts AS DATE), ts, event_id LIMIT 25""")
def customer_events_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("customer_id"), F.col("ts").alias("event_timestamp"), F.to_date("ts").alias("event_date")
    )
    found = customer_events(events, 7, "2024-01-05", "2024-01-20", 25)
    return found.select("event_id", stamp("event_timestamp").alias("event_timestamp"))


@query(f"""
SELECT notification_id, {sql_stamp('created_at')} AS created_at FROM ({frames.NOTIFICATIONS})
WHERE status = 'pending' AND NOT is_deleted ORDER BY {sql_stamp('created_at')}, notification_id LIMIT 30""")
def oldest_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.plans import notifications

    found = notifications.oldest_pending(frames.notifications(spark, sf_dir), 30)
    return found.select("notification_id", stamp("created_at").alias("created_at"))


@query(f"""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE CAST('0x' || substr(md5('42:' || l_orderkey || ':' || l_linenumber), 1, 8) AS BIGINT) < {int(0.05 * 2**32)}""")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = ordering.sample_rows(table(spark, sf_dir, "lineitem"), 0.05, seed=42, keys=["l_orderkey", "l_linenumber"])
    return sampled.select("l_orderkey", "l_linenumber", "l_quantity")


@query(f"""
SELECT strftime(d, '%Y-%m-%d') AS day, count(event_id) AS n
FROM (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-02-05', INTERVAL 1 DAY))::DATE AS d)
LEFT JOIN events ON CAST(ts AS DATE) = d GROUP BY 1""")
def every_day_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = ordering.day_series(spark, "2023-12-25", "2024-02-05")
    per_day = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    filled = days.join(per_day, "day", "left")
    return filled.select(day("day").alias("day"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@query("""
SELECT name, count(*) AS n FROM (
  SELECT s_name AS name FROM supplier UNION ALL SELECT s_name FROM supplier WHERE s_acctbal > 0 UNION ALL SELECT n_name FROM nation)
GROUP BY 1""")
def rows_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    rich = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 0).select(F.col("s_name").alias("name"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    return ordering.append_all(names, rich, nations).groupBy("name").agg(F.count("*").alias("n"))


SMALL = "SELECT l_partkey AS part FROM lineitem WHERE l_quantity < 3"
CHEAP = "SELECT l_partkey AS part FROM lineitem WHERE l_extendedprice < 3000"


def _two_sets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    small = lines.filter(F.col("l_quantity") < 3).select(F.col("l_partkey").alias("part"))
    return small, lines.filter(F.col("l_extendedprice") < 3000).select(F.col("l_partkey").alias("part"))


@query(f"{SMALL} UNION {CHEAP}")
def set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.set_union(*_two_sets(spark, sf_dir))


@query(f"{SMALL} INTERSECT {CHEAP}")
def set_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.set_intersection(*_two_sets(spark, sf_dir))


@query(f"{SMALL} EXCEPT {CHEAP}")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.set_difference(*_two_sets(spark, sf_dir))


@query("""
SELECT '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '","rating":' ||
       CASE WHEN s_acctbal > 0 THEN CAST(s_nationkey AS VARCHAR) ELSE 'null' END || '}' AS json
FROM supplier""")
def rows_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = F.when(F.col("s_acctbal") > 0, F.col("s_nationkey")).alias("rating")
    return as_json(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", rating))
