"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import frames
from millrace.catalog.frames import at, table
from millrace.catalog.registry import dbl, query, sql_stamp, stamp
from millrace.functions.numbers import money
from millrace.operators import joins
from millrace.operators.rows import active
from millrace.operators.skew import join_on, salted_join
from millrace.plans.customer_profile import denormalised_sales
from millrace.plans.sales import convert_currency, spend_by_customer


@query("""
SELECT o_orderkey, c_custkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def inner_join_on_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    joined = join_on(orders, table(spark, sf_dir, "customer"), ["c_custkey"])
    return joined.select("o_orderkey", "c_custkey", "c_name", "o_totalprice")


@query("""
SELECT 'half' AS kind, s_suppkey AS id, CAST(s_nationkey AS DOUBLE) AS k FROM supplier
JOIN (SELECT n_nationkey / 2.0 AS k FROM nation) ON CAST(s_nationkey AS DOUBLE) = k
UNION ALL
SELECT 'large', s_suppkey, CAST(k AS DOUBLE) FROM supplier
JOIN (SELECT CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey ELSE n_nationkey + 1099511627776 END AS k FROM nation) ON s_nationkey = k""")
def join_on_mixed_key_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An int key meets halves as doubles, and numbers beyond its own range: both are compared by
    the wider type."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("int").alias("k"))
    key = F.col("n_nationkey").cast("bigint")
    halves = table(spark, sf_dir, "nation").select((key / 2.0).cast("double").alias("k"))
    large = table(spark, sf_dir, "nation").select(F.when(key % 2 == 0, key).otherwise(key + F.lit(2**40)).alias("k"))
    shown = [F.col("s_suppkey").alias("id"), F.col("k").cast("double").alias("k")]
    return (
        join_on(suppliers, halves, ["k"]).select(F.lit("half").alias("kind"), *shown)
        .unionByName(salted_join(suppliers, large, ["k"], hot=[0, 2]).select(F.lit("large").alias("kind"), *shown))
    )


DENORMALISED = """
SELECT customer_id, order_id, item_id, product_name, quantity, city, amount, order_date FROM (
  SELECT c_custkey AS customer_id, o_orderkey AS order_id, l_linenumber AS item_id, p_brand AS product_name,
         CAST(l_quantity AS INTEGER) AS quantity, c_mktsegment AS city, o_totalprice AS amount, o_orderdate AS order_date,
         row_number() OVER (PARTITION BY c_custkey, o_orderkey, l_linenumber ORDER BY p_brand, CAST(l_quantity AS INTEGER)) AS rn
  FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
WHERE rn = 1"""


def denormalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.lower("c_name").alias("email"),
        F.col("c_mktsegment").alias("city"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("amount"),
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("product_name"))
    lines = join_on(table(spark, sf_dir, "lineitem"), parts, ["l_partkey"]).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("item_id"),
        "product_name",
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    return denormalised_sales(customers, orders, lines)


@query(f"""
SELECT city, product_name, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity, count(DISTINCT customer_id) AS customers,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount, {sql_stamp('max(order_date)')} AS last_order
FROM ({DENORMALISED}) GROUP BY ALL""")
def three_table_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return denormalised(spark, sf_dir).groupBy("city", "product_name").agg(
        F.count("*").alias("n"),
        F.sum("quantity").alias("quantity"),
        F.countDistinct("customer_id").alias("customers"),
        dbl(F.sum(money("amount"))).alias("amount"),
        stamp(F.max("order_date")).alias("last_order"),
    )


# Dollar rates per currency; one currency of the data has none.
RATES = (("1-URGENT", 1.0), ("2-HIGH", 1.07), ("3-MEDIUM", 0.012), ("5-LOW", 0.0068))
RATES_SQL = "(VALUES ('1-URGENT', 1.0::DOUBLE), ('2-HIGH', 1.07), ('3-MEDIUM', 0.012), ('5-LOW', 0.0068)) r(currency, rate)"


def converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("txn_id"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("currency")
    )
    return convert_currency(paid, spark.createDataFrame(RATES, "currency string, rate_to_usd double"))


@query(f"""
SELECT o_orderkey AS txn_id, o_orderpriority AS currency, o_totalprice * rate AS amount_usd
FROM orders LEFT JOIN {RATES_SQL} ON currency = o_orderpriority""")
def currency_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return converted(spark, sf_dir).select("txn_id", "currency", "amount_usd")


@query("SELECT o_orderpriority AS currency, count(*) AS n FROM orders GROUP BY 1")
def rows_per_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return converted(spark, sf_dir).groupBy("currency").agg(F.count("*").alias("n"))


@query(f"""
SELECT l_returnflag AS flag, category, count(*) AS n FROM lineitem JOIN ({frames.PRODUCTS}) ON product_id = l_partkey
GROUP BY ALL""")
def dimension_inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Counted per product first, so the lookup sees each product once per flag.
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("product_id"), F.col("l_returnflag").alias("flag"))
    per_product = lines.agg(F.count("*").alias("n"))
    joined = join_on(per_product, frames.products(spark, sf_dir), ["product_id"])
    return joined.groupBy("flag", "category").agg(F.sum("n").alias("n"))


SPEND = """
SELECT o_custkey AS "customerId", c_name AS name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2"""


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customerId"), money("o_totalprice").alias("amount"))
    named = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customerId"), F.col("c_name").alias("name"))
    return spend_by_customer(paid, named).withColumn("total_spent", dbl("total_spent"))


@query(SPEND)
def aggregate_then_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spend(spark, sf_dir)


@query(f"""
WITH t AS ({frames.TRANSACTIONS}), c AS (
  SELECT customer_id, category, sum(qty) AS items, row_number() OVER (PARTITION BY customer_id ORDER BY sum(qty) DESC, category) AS rn
  FROM t JOIN ({frames.PRODUCTS}) p USING (product_id) GROUP BY customer_id, category)
SELECT t.customer_id, CAST(sum(t.qty) AS BIGINT) AS total_items, any_value(c.category) AS top_category
FROM t LEFT JOIN c ON c.customer_id = t.customer_id AND c.rn = 1 GROUP BY t.customer_id""")
def winner_joined_to_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators.aggregates import sum_by, top_one

    per_product = sum_by(frames.transactions(spark, sf_dir), ["customer_id", "product_id"], "qty", "items")
    known = join_on(per_product, frames.products(spark, sf_dir), ["product_id"])
    winners = top_one(sum_by(known, ["customer_id", "category"], "items", "items"), ["customer_id"], "items", "category", "top_category")
    return sum_by(per_product, ["customer_id"], "items", "total_items").join(winners, ["customer_id"], "left")


AFFECTED = "SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-15'"


def affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= at("2001-07-15 00:00:00")).select("o_custkey")


@query(f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN ({AFFECTED})")
def restrict_to_affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.restrict_to_keys(orders, affected(spark, sf_dir), ["o_custkey"])


@query(f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN ({AFFECTED})")
def restrict_by_list_or_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.restrict_adaptive(orders, affected(spark, sf_dir), "o_custkey")


@query("""
SELECT a.n_name AS customer_nation, b.n_name AS supplier_nation, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation a ON a.n_nationkey = c_nationkey
LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation b ON b.n_nationkey = s_nationkey
GROUP BY ALL""")
def one_table_in_two_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    pairs = join_on(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey"), orders, ["l_orderkey"])
    per_pair = pairs.groupBy("o_custkey", "l_suppkey").agg(F.count("*").alias("n"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("from_nation"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("to_nation"))
    placed = join_on(per_pair, suppliers, ["l_suppkey"], "left")
    placed = join_on(placed, customers, ["o_custkey"], "left")
    flows = placed.groupBy("from_nation", "to_nation").agg(F.sum("n").alias("n"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    both = joins.join_roles(flows, nations, "n_nationkey", {"customer": "from_nation", "supplier": "to_nation"})
    return both.select(F.col("customer.n_name").alias("customer_nation"), F.col("supplier.n_name").alias("supplier_nation"), "n")


@query(f"""
SELECT task_id, created_by, full_name FROM ({frames.TASKS}) t JOIN ({frames.USERS}) u ON u.user_id = t.created_by
WHERE NOT u.is_deleted AND NOT t.is_deleted""")
def join_live_creator(spark: SparkSession, sf_dir: str) -> DataFrame:
    creators = active(frames.users(spark, sf_dir)).select(F.col("user_id").alias("created_by"), "full_name")
    joined = join_on(active(frames.tasks(spark, sf_dir)), creators, ["created_by"])
    return joined.select("task_id", "created_by", "full_name")


@query("""
SELECT DISTINCT l_suppkey AS s_suppkey, p_type FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)""")
def bridge_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridge = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_partkey").alias("p_partkey"))
    members = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 5000)
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return joins.join_bridge(members, bridge.distinct(), parts, "s_suppkey", "p_partkey").select("s_suppkey", "p_type").distinct()


@query(f"""
SELECT task_id, 'OVERDUE' AS notification_type FROM ({frames.TASKS}) t
WHERE status = 'Pending' AND NOT EXISTS (
  SELECT 1 FROM ({frames.NOTIFICATIONS}) n WHERE n.task_id = t.task_id AND n.notification_type = 'OVERDUE'
  AND n.status = 'pending' AND NOT n.is_deleted)""")
def skip_when_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    waiting = frames.tasks(spark, sf_dir).filter(F.col("status") == "Pending")
    wanted = waiting.select("task_id", F.lit("OVERDUE").alias("notification_type"))
    return joins.without_pending(wanted, frames.notifications(spark, sf_dir), ["task_id", "notification_type"])


@query(f"""
SELECT CASE WHEN l_partkey IN (SELECT product_id FROM ({frames.PRODUCTS})) THEN 'accepted' ELSE 'rejected' END AS verdict,
       count(*) AS n, count(DISTINCT l_partkey) AS parts
FROM lineitem GROUP BY 1""")
def parent_must_exist(spark: SparkSession, sf_dir: str) -> DataFrame:
    children = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product_id"))
    accepted, rejected = joins.referential_split(children, frames.products(spark, sf_dir), ["product_id"])
    both = accepted.withColumn("verdict", F.lit("accepted")).unionByName(rejected.withColumn("verdict", F.lit("rejected")))
    return both.groupBy("verdict").agg(F.count("*").alias("n"), F.countDistinct("product_id").alias("parts"))


@query(f"""
SELECT allocation_id, asset_tag, u.full_name AS assignee, v.full_name AS allocator
FROM ({frames.ALLOCATIONS}) a
LEFT JOIN ({frames.ITEMS}) i ON i.equipment_id = a.equipment_id
LEFT JOIN ({frames.USERS}) u ON u.user_id = a.employee_id
LEFT JOIN ({frames.USERS}) v ON v.user_id = a.allocated_by_employee_id
WHERE a.status = 'ACTIVE' AND NOT a.is_deleted""")
def enrich_with_item_and_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.plans.messages import with_people

    held = active(frames.allocations(spark, sf_dir)).filter(F.col("status") == "ACTIVE")
    held = with_people(held.select("allocation_id", "equipment_id", "employee_id", "allocated_by_employee_id"), frames.employees(spark, sf_dir))
    tagged = join_on(held, frames.items(spark, sf_dir).select("equipment_id", "asset_tag"), ["equipment_id"], "left")
    people = frames.users(spark, sf_dir).select("user_id", "full_name")
    out = joins.join_roles(tagged, people, "user_id", {"a": "assignee_user_id", "b": "allocator_user_id"})
    return out.select("allocation_id", "asset_tag", F.col("a.full_name").alias("assignee"), F.col("b.full_name").alias("allocator"))


@query("""
SELECT c_custkey, r_name FROM customer JOIN region ON length(c_mktsegment) >= length(r_name) + 2""")
def length_theta_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").withColumn("padded", F.concat("r_name", F.lit("++")))
    pairs = joins.length_pairs(table(spark, sf_dir, "customer"), regions, "c_mktsegment", "padded")
    return pairs.select("c_custkey", "r_name")


@query("""
SELECT p_partkey, (SELECT count(*) FROM customer WHERE length(c_mktsegment) <= length(p_name)) AS matches FROM part""")
def length_theta_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = joins.length_match_counts(table(spark, sf_dir, "part"), table(spark, sf_dir, "customer"), "p_name", "c_mktsegment")
    return counted.select("p_partkey", "matches")
