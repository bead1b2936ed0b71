"""Aggregates, per-group winners, distinct, de-duplication and running totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import frames
from millrace.catalog.frames import CENTS_MEAN, table
from millrace.catalog.registry import big, day, dbl, query, sql_day, sql_stamp, stamp
from millrace.functions.numbers import age_band, money
from millrace.operators import aggregates as agg
from millrace.operators.skew import join_on
from millrace.plans.customer_profile import clean_transactions
from millrace.plans.sales import posts_per_age_band, product_aggregates


@query("SELECT c_mktsegment AS city, count(*) AS n FROM customer GROUP BY 1")
def city_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.count_by(table(spark, sf_dir, "customer"), [F.col("c_mktsegment").alias("city")])


@query("SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL")
def events_per_type_and_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.count_by(table(spark, sf_dir, "events"), ["event_type", "user_id"])


@query("""
SELECT l_suppkey AS store, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sales FROM lineitem GROUP BY 1""")
def store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("store"), money("l_extendedprice").alias("amount"))
    return agg.sum_by(sales, ["store"], "amount", "sales").withColumn("sales", dbl("sales"))


@query("""
SELECT o_custkey AS account, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def account_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("account"), money("o_totalprice").alias("amount"))
    return agg.sum_by(paid, ["account"], "amount", "total").withColumn("total", dbl("total"))


@query("""
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem GROUP BY ALL""")
def sums_with_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("quantity"), dbl(F.sum(money("l_extendedprice"))).alias("amount")
    )


@query("""
SELECT c_mktsegment AS department, CAST(avg(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(18,2))::DOUBLE AS avg_salary FROM customer GROUP BY 1""")
def average_per_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    pay = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("department"), money("c_acctbal").alias("salary"))
    means = agg.mean_by(pay, ["department"], "salary", "avg_salary")
    return means.withColumn("avg_salary", dbl(F.round("avg_salary", 2)))


@query("""
SELECT user_id AS device, CAST(hour(ts) AS BIGINT) AS hour, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_value
FROM events GROUP BY ALL""")
def hourly_sensor_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = table(spark, sf_dir, "events")
    return readings.groupBy(F.col("user_id").alias("device"), big(F.hour("ts")).alias("hour")).agg(
        F.count("*").alias("n"), (dbl(F.sum(money("value"))) / F.count("*")).alias("avg_value")
    )


@query("""
SELECT p_name AS product_name, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity,
       CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_amount
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_brand <> 'Brand#3' GROUP BY 1""")
def product_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Summed per part first: the names are looked up once per part.
    per_part = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum("l_quantity").alias("quantity"), F.sum(money("l_extendedprice")).alias("amount")
    )
    name = F.when(F.col("p_brand") != "Brand#3", F.col("p_name")).alias("product_name")
    parts = table(spark, sf_dir, "part").select("p_partkey", name)
    totals = product_aggregates(join_on(per_part, parts, ["p_partkey"]))
    return totals.withColumn("total_amount", dbl("total_amount"))


@query(f"""
SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS total_spend, count(*) AS total_transactions,
       {CENTS_MEAN} AS avg_order_value,
       {sql_stamp('min(txn_timestamp)')} AS first_purchase, {sql_stamp('max(txn_timestamp)')} AS last_purchase
FROM ({frames.TRANSACTIONS}) GROUP BY 1""")
def lifetime_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = frames.transactions(spark, sf_dir).groupBy("customer_id").agg(
        F.sum("amount").cast("decimal(18,2)").alias("spend"),
        F.count("*").alias("total_transactions"),
        F.min("txn_timestamp").alias("first_at"),
        F.max("txn_timestamp").alias("last_at"),
    )
    return totals.select(
        "customer_id",
        dbl("spend").alias("total_spend"),
        "total_transactions",
        dbl((F.col("spend") / F.col("total_transactions")).cast("decimal(18,2)")).alias("avg_order_value"),
        stamp("first_at").alias("first_purchase"),
        stamp("last_at").alias("last_purchase"),
    )


@query(f"""
SELECT {sql_day('txn_timestamp')} AS day, customer_id, CAST(sum(amount) AS DOUBLE) AS total_amount,
       CAST(sum(qty) AS BIGINT) AS total_items, count(DISTINCT product_id) AS distinct_products
FROM ({frames.TRANSACTIONS}) GROUP BY ALL""")
def daily_customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.transactions(spark, sf_dir)
    return rows.groupBy(day("txn_timestamp").alias("day"), "customer_id").agg(
        dbl(F.sum("amount")).alias("total_amount"),
        F.sum("qty").alias("total_items"),
        F.countDistinct("product_id").alias("distinct_products"),
    )


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1")
def exact_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_orderkey").alias("orders")
    )


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_quantity) AS rn FROM lineitem)
WHERE rn = 1""")
def one_row_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity")
    return agg.keep_first(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"]).drop("l_shipdate")


@query(f"""
WITH t AS ({frames.TRANSACTIONS})
SELECT txn_id, customer_id, product_id, CAST(qty AS BIGINT) AS qty, CAST(amount AS DOUBLE) AS amount FROM (
  SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY txn_timestamp, customer_id, product_id, qty, amount) AS rn FROM t)
WHERE rn = 1""")
def one_row_per_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean_transactions(frames.transactions(spark, sf_dir))
    return rows.select("txn_id", "customer_id", "product_id", big("qty").alias("qty"), dbl("amount").alias("amount"))


@query(f"""
SELECT max(o_orderkey) AS max_id, min(o_orderkey) AS min_id, {sql_day('max(o_orderdate)')} AS last_day,
       (SELECT CAST(max(o_orderkey) AS DOUBLE) FROM orders WHERE o_totalprice < 0) AS max_of_none
FROM orders""")
def global_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(
        F.max("o_orderkey").alias("max_id"),
        F.min("o_orderkey").alias("min_id"),
        day(F.max("o_orderdate")).alias("last_day"),
        dbl(F.max(F.when(F.col("o_totalprice") < 0, F.col("o_orderkey")))).alias("max_of_none"),
    )


@query("SELECT (SELECT count(*) FROM lineitem) AS lines, (SELECT count(*) FROM orders) AS orders")
def global_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").agg(F.count("*").alias("lines"))
    return lines.withColumn("orders", table(spark, sf_dir, "orders").agg(F.count("*")).scalar())


# Parts of size 13 have no age.
AGE = "(CASE WHEN p_size <> 13 THEN p_size + 15 END)"
AGE_BANDS = f"""CASE WHEN {AGE} < 25 THEN '15-24' WHEN {AGE} < 35 THEN '25-34' WHEN {AGE} < 45 THEN '35-44'
WHEN {AGE} < 55 THEN '45-54' WHEN {AGE} < 65 THEN '55-64' WHEN {AGE} >= 65 THEN '65+' END"""


def aged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") != 13, F.col("p_size") + 15).alias("age"))


def users_and_posts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    users = aged_parts(spark, sf_dir).withColumnRenamed("p_partkey", "userId")
    return users, table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("userId"))


@query(f"SELECT {AGE_BANDS} AS age_band, count(*) AS posts FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1")
def posts_by_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, posts = users_and_posts(spark, sf_dir)
    return posts_per_age_band(posts, users)


@query(f"SELECT p_partkey, {AGE_BANDS} AS age_band FROM part")
def age_band_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aged_parts(spark, sf_dir).select("p_partkey", age_band(F.col("age")).alias("age_band"))


@query(f"SELECT p_partkey, {AGE_BANDS} AS age_band FROM part")
def age_band_by_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.functions.numbers import age_band_udf

    spark.udf.register("age_band", age_band_udf())
    aged_parts(spark, sf_dir).createOrReplaceTempView("parts_for_bands")
    return spark.sql("SELECT p_partkey, age_band(age) AS age_band FROM parts_for_bands")


@query("""
SELECT c_custkey, coalesce(string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority), '') AS priorities,
       count(DISTINCT o_orderpriority) AS n
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 400000 GROUP BY 1""")
def children_per_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 400000)
    large = large.select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    lists = agg.collect_children(table(spark, sf_dir, "customer"), large, "c_custkey", "o_orderpriority", "list")
    return lists.select("c_custkey", F.array_join("list", "|").alias("priorities"), big(F.size("list")).alias("n"))


@query("SELECT count(*) AS n_high FROM orders WHERE o_totalprice > 300000")
def high_value_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.count_above(table(spark, sf_dir, "orders"), "o_totalprice", 300_000)


WORDS = r"unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'))"


@query(f"SELECT word, count(*) AS n FROM (SELECT {WORDS} AS word FROM documents) WHERE word <> '' GROUP BY 1")
def word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.word_counts(table(spark, sf_dir, "documents"), "text")


@query("""
SELECT p_size % 2 = 0 AS even, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS total, avg(p_size) AS mean,
       min(p_size) AS smallest, max(p_size) AS largest
FROM part GROUP BY 1""")
def group_by_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy((F.col("p_size") % 2 == 0).alias("even")).agg(
        F.count("*").alias("n"),
        F.sum("p_size").alias("total"),
        F.avg("p_size").alias("mean"),
        F.min("p_size").alias("smallest"),
        F.max("p_size").alias("largest"),
    )


@query("""
SELECT r_name, CAST(sum(n_nationkey) AS BIGINT) AS total, product(n_nationkey + 1) AS multiplied, max(n_nationkey) AS largest,
       string_agg(substr(n_name, 1, 1), ',' ORDER BY n_name) AS joined
FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1""")
def folds_to_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    named = join_on(table(spark, sf_dir, "nation"), regions, ["n_regionkey"])
    # A region has few nations, so its list is short; equal initials stay, in order of the names.
    initials = F.transform(F.sort_array(F.collect_list("n_name")), lambda n: F.substring(n, 1, 1))
    return named.groupBy("r_name").agg(
        F.sum("n_nationkey").alias("total"),
        F.product(F.col("n_nationkey") + 1).alias("multiplied"),
        F.max("n_nationkey").alias("largest"),
        F.array_join(initials, ",").alias("joined"),
    )


@query(f"""
WITH c AS (SELECT customer_id, category, count(*) AS cnt FROM ({frames.TRANSACTIONS}) JOIN ({frames.PRODUCTS}) p USING (product_id) GROUP BY ALL)
SELECT customer_id, category AS favorite_category FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY cnt DESC, category) AS rn FROM c) WHERE rn = 1""")
def favourite_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_product = agg.count_by(frames.transactions(spark, sf_dir), ["customer_id", "product_id"], "cnt")
    known = join_on(per_product, frames.products(spark, sf_dir), ["product_id"])
    counts = agg.sum_by(known, ["customer_id", "category"], "cnt", "cnt")
    return agg.top_one(counts, ["customer_id"], "cnt", "category", "favorite_category")


@query(f"""
WITH c AS (SELECT {sql_day('txn_timestamp')} AS day, customer_id, category, sum(qty) AS items
  FROM ({frames.TRANSACTIONS}) JOIN ({frames.PRODUCTS}) p USING (product_id) GROUP BY ALL)
SELECT day, customer_id, category AS top_category FROM (
  SELECT *, row_number() OVER (PARTITION BY day, customer_id ORDER BY items DESC, category) AS rn FROM c) WHERE rn = 1""")
def top_category_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.transactions(spark, sf_dir)
    keys = [day("txn_timestamp").alias("day"), "customer_id", "product_id"]
    per_product = agg.sum_by(rows, keys, "qty", "items")
    known = join_on(per_product, frames.products(spark, sf_dir), ["product_id"])
    sums = agg.sum_by(known, ["day", "customer_id", "category"], "items", "items")
    return agg.top_one(sums, ["day", "customer_id"], "items", "category", "top_category")


@query("""
SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (ORDER BY ts, event_id) AS DOUBLE) AS running
FROM events""")
def running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("ts", "event_id", money("value").alias("value"))
    return agg.running_total(rows, ["ts", "event_id"], "value", "running").select("event_id", dbl("running").alias("running"))


@query("""
SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (ORDER BY ts DESC, event_id DESC) AS DOUBLE) AS remaining
FROM events""")
def reverse_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("ts", "event_id", money("value").alias("value"))
    totals = agg.running_total(rows, ["ts", "event_id"], "value", "remaining", reverse=True)
    return totals.select("event_id", dbl("remaining").alias("remaining"))
