"""Layout, heavy keys, ranges and logs: joins that move little, and folds that compose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import frames
from millrace.catalog.frames import table
from millrace.catalog.registry import dbl, query
from millrace.functions.numbers import money
from millrace.operators import intervals
from millrace.operators.control import runtime_filters
from millrace.operators.joins import restrict_to_keys
from millrace.operators.layout import join_laid_out, lay_out
from millrace.operators.skew import balanced_join
from millrace.plans import eventlog
from millrace.session import settle


def laid_out_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), "o_custkey", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_linenumber", "l_extendedprice")
    return join_laid_out(lay_out(lines, ["order_id"], 16), lay_out(orders, ["order_id"], 16), ["order_id"])


@query("""
SELECT l_orderkey AS order_id, o_custkey, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def join_of_laid_out_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables bucketed by the order meet bucket by bucket, and are grouped by it, without an exchange."""
    joined = laid_out_join(spark, sf_dir)
    return joined.groupBy("order_id", "o_custkey").agg(F.count("*").alias("n"), dbl(F.sum(money("l_extendedprice"))).alias("total"))


@query("""
SELECT l_orderkey, l_linenumber, p_brand FROM lineitem
JOIN part ON p_partkey = CASE WHEN l_quantity > 25 THEN 1 ELSE l_partkey END""")
def join_with_found_heavy_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the lines name one part, which nobody tells the join."""
    part = F.when(F.col("l_quantity") > 25, 1).otherwise(F.col("l_partkey"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", part.alias("p_partkey"))
    joined = balanced_join(lines, table(spark, sf_dir, "part").select("p_partkey", "p_brand"), ["p_partkey"])
    return joined.select("l_orderkey", "l_linenumber", "p_brand")


def affected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    urgent = table(spark, sf_dir, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400_000))
    return restrict_to_keys(lines, urgent, ["o_orderkey"]).select("o_orderkey", "l_linenumber", "l_quantity")


@query("""
SELECT l_orderkey AS o_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000)""")
def restrict_by_runtime_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the affected orders; a bloom filter of those drops the others where they are read."""
    with runtime_filters(spark, fact_bytes="1MB"):
        return settle(affected_lines(spark, sf_dir), "affected")


@query("""
SELECT p_partkey, c_custkey, abs(length(p_name) - length(c_name)) AS distance, place FROM (
  SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY abs(length(p_name) - length(c_name)), length(c_name), c_custkey) AS place
  FROM part, customer)
WHERE place <= 3""")
def nearest_name_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three customers whose names are the nearest in length to each part's."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.length("p_name").alias("part_length"))
    people = table(spark, sf_dir, "customer").select("c_custkey", F.length("c_name").alias("name_length"))
    found = intervals.nearest(parts, people, "p_partkey", "part_length", "name_length", ["c_custkey"], 3)
    return found.select("p_partkey", "c_custkey", F.col("distance").cast("bigint").alias("distance"), "place")


PRICES = "SELECT o_orderkey, o_totalprice AS price FROM orders"


@query(f"""
SELECT s_suppkey, o_orderkey, nth FROM (
  SELECT s_suppkey, o_orderkey, row_number() OVER (PARTITION BY s_suppkey ORDER BY price, o_orderkey) AS nth
  FROM supplier JOIN ({PRICES}) ON price >= 50 * abs(s_acctbal))
WHERE nth <= 4""")
def next_larger_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four orders whose prices follow fifty times each supplier's balance: a range condition with few rows per left row."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", (F.abs("s_acctbal") * 50).alias("least"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    found = intervals.next_values(suppliers, orders, "least", "price", ["o_orderkey"], 4)
    return found.select("s_suppkey", "o_orderkey", F.col("__nth").alias("nth"))


MINUTE = 60
SPELLS = f"""
SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS began,
       CAST(floor(epoch(ts)) AS BIGINT) + CAST(props->>'k' AS BIGINT) * {MINUTE} AS ended
FROM events"""


@query(f"""
SELECT a.event_id AS purchase, b.event_id AS error, least(a.ended, b.ended) - greatest(a.began, b.began) AS seconds
FROM ({SPELLS}) a JOIN ({SPELLS}) b ON a.event_type = 'purchase' AND b.event_type = 'error' AND a.began <= b.ended AND b.began <= a.ended
WHERE a.user_id % 10 = b.user_id % 10""")
def overlapping_spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases and errors of one group of users whose spells of up to 99 minutes overlap."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    began = F.unix_timestamp(F.col("ts").cast("timestamp"))
    spells = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("user_id") % 10).alias("g"), began.alias("began"), (began + k * MINUTE).alias("ended"))
    one = spells.filter("event_type = 'purchase'").select(F.col("event_id").alias("purchase"), F.col("g").alias("g1"), F.col("began").alias("b1"), F.col("ended").alias("e1"))
    two = spells.filter("event_type = 'error'").select(F.col("event_id").alias("error"), F.col("g").alias("g2"), F.col("began").alias("b2"), F.col("ended").alias("e2"))
    met = intervals.overlaps(one, two, ("b1", "e1"), ("b2", "e2"), 60 * MINUTE).filter("g1 = g2")
    return met.select("purchase", "error", (F.least("e1", "e2") - F.greatest("b1", "b2")).alias("seconds"))


LOG = """
SELECT equipment_id, happened_at, seq, action, ref FROM (
  SELECT l_orderkey AS ref, min(l_partkey) AS equipment_id, max(l_returnflag) AS flag FROM lineitem GROUP BY l_orderkey)
JOIN orders ON o_orderkey = ref, LATERAL (VALUES
  (o_orderdate, 1, 'ALLOCATED', true),
  (o_orderdate + INTERVAL 20 DAY, 0, CASE WHEN flag = 'R' THEN 'RETURNED_DAMAGED' ELSE 'RETURNED' END, o_orderstatus <> 'P'),
  (o_orderdate + INTERVAL 45 DAY, 2, 'REPAIRED', flag = 'R' AND o_orderpriority <> '5-LOW'),
  (o_orderdate + INTERVAL 90 DAY, 3, 'RETIRED', o_totalprice > 495000),
  (o_orderdate + INTERVAL 5 DAY, 4, 'LOST', o_totalprice < 2000)) v(happened_at, seq, action, real) WHERE real"""


def item_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allocations, returns, repairs and retirements of items; some out of turn, some of a kind the rules do not know."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("ref"))
    lines = lines.agg(F.min("l_partkey").alias("equipment_id"), F.max("l_returnflag").alias("flag"))
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "ref")
    damaged = F.col("flag") == "R"

    def event(days: int, seq: int, action, real):
        at = F.col("o_orderdate") + F.expr(f"INTERVAL {days} DAYS")
        return F.when(real, F.struct(at.alias("happened_at"), F.lit(seq).alias("seq"), action.alias("action")))

    happened = F.array_compact(
        F.array(
            event(0, 1, F.lit("ALLOCATED"), F.lit(True)),
            event(20, 0, F.when(damaged, "RETURNED_DAMAGED").otherwise("RETURNED"), F.col("o_orderstatus") != "P"),
            event(45, 2, F.lit("REPAIRED"), damaged & (F.col("o_orderpriority") != "5-LOW")),
            event(90, 3, F.lit("RETIRED"), F.col("o_totalprice") > 495_000),
            event(5, 4, F.lit("LOST"), F.col("o_totalprice") < 2_000),
        )
    )
    return lines.join(orders, "ref").select("equipment_id", "ref", F.inline(happened))


@query(f"""
WITH RECURSIVE log AS (
  SELECT *, row_number() OVER (PARTITION BY equipment_id ORDER BY happened_at, seq, action, ref) AS n FROM ({LOG})),
rules(action, was, becomes) AS (VALUES ('ALLOCATED', 'AVAILABLE', 'ALLOCATED'), ('RETURNED', 'ALLOCATED', 'AVAILABLE'),
  ('RETURNED_DAMAGED', 'ALLOCATED', 'UNDER_MAINTENANCE'), ('REPAIRED', 'UNDER_MAINTENANCE', 'AVAILABLE'),
  ('RETIRED', 'AVAILABLE', 'RETIRED'), ('RETIRED', 'UNDER_MAINTENANCE', 'RETIRED')),
folded AS (
  SELECT equipment_id, status, 0::BIGINT AS accepted, 0::BIGINT AS refused, NULL::BIGINT AS last_ref, 0::BIGINT AS n FROM ({frames.ITEMS})
  UNION ALL
  SELECT f.equipment_id, coalesce(r.becomes, f.status), accepted + (CASE WHEN r.becomes IS NULL THEN 0 ELSE 1 END)::BIGINT,
         refused + (CASE WHEN r.becomes IS NULL THEN 1 ELSE 0 END)::BIGINT, CASE WHEN r.becomes IS NULL THEN last_ref ELSE l.ref END, l.n
  FROM folded f JOIN log l ON l.equipment_id = f.equipment_id AND l.n = f.n + 1 LEFT JOIN rules r ON r.action = l.action AND r.was = f.status)
SELECT equipment_id, arg_max(status, n) AS status, max(accepted) AS accepted, max(refused) AS refused, arg_max(last_ref, n) FILTER (last_ref IS NOT NULL) AS last_ref
FROM folded GROUP BY equipment_id""")
def item_states_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each item is after all events, in their order, and how many of them its state allowed."""
    items = frames.items(spark, sf_dir).select("equipment_id", "status")
    done = eventlog.states_after(items, item_log(spark, sf_dir), "equipment_id", ["happened_at", "seq"], part_events=5)
    return done.select("equipment_id", "status", "accepted", "refused", "last_ref")
