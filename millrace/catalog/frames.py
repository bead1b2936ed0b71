"""The supplied tables, seen as the tables the jobs work on; each view has a SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.skew import join_on

AS_OF = "1998-06-01 00:00:00"
EVENTS_AS_OF = "2024-01-15 12:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def at(text: str = AS_OF) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# sum(amount) / count(*) in whole cents, halves up.
CENTS_MEAN = "CAST((CAST(sum(amount) * 100 AS BIGINT) * 2 + count(*)) // (2 * count(*)) AS DOUBLE) / 100"

TRANSACTIONS = """
SELECT l_orderkey * 10 + l_linenumber AS txn_id, o_custkey AS customer_id, l_partkey AS product_id,
       CAST(l_quantity AS INTEGER) AS qty, CAST(l_extendedprice AS DECIMAL(10,2)) AS amount,
       o_orderdate AS txn_timestamp
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("txn_timestamp"),
    )
    joined = join_on(lines, orders, ["order_key"])
    return joined.select("txn_id", "customer_id", "product_id", "qty", "amount", "txn_timestamp")


# Parts above size 45 are no longer in the catalogue, so some transactions name unknown products.
PRODUCTS = "SELECT p_partkey AS product_id, p_type AS category FROM part WHERE p_size <= 45"


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").filter(F.col("p_size") <= 45)
    return parts.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"))


# Events as transactions: a table with a unique id and a month of days.
EVENT_TRANSACTIONS = """
SELECT event_id AS txn_id, user_id AS customer_id, CAST(props->>'k' AS BIGINT) AS product_id,
       CAST(CAST(props->>'k' AS BIGINT) % 10 + 1 AS INTEGER) AS qty, CAST(value AS DECIMAL(10,2)) AS amount, ts AS txn_timestamp
FROM events"""


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").alias("customer_id"),
        k.alias("product_id"),
        (k % 10 + 1).cast("int").alias("qty"),
        F.col("value").cast("decimal(10,2)").alias("amount"),
        F.col("ts").alias("txn_timestamp"),
    )


CUSTOMERS = """
SELECT c_custkey AS customer_id, c_name AS name,
       lower(replace(c_name, '#', '.')) || '@example.com' AS email, c_mktsegment AS gender
FROM customer"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("gender"),
    )


ALLOCATIONS = """
SELECT o_orderkey AS allocation_id, equipment_id, o_custkey AS employee_id, allocated_by_employee_id,
       o_orderpriority AS purpose, o_orderdate AS allocated_at,
       o_orderdate + INTERVAL 30 DAY AS expected_return_at,
       CASE WHEN o_orderstatus = 'F' THEN last_ship END AS returned_at,
       CASE o_orderstatus WHEN 'F' THEN 'RETURNED' WHEN 'O' THEN 'ACTIVE' ELSE 'CANCELLED' END AS status,
       o_orderdate AS created_at, o_orderdate AS updated_at,
       o_totalprice < 50000 AS is_deleted,
       CASE WHEN o_totalprice < 50000 THEN o_orderdate END AS deleted_at
FROM orders JOIN (
  SELECT l_orderkey, min(l_partkey) AS equipment_id, min(l_suppkey) AS allocated_by_employee_id,
         max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey) l ON l_orderkey = o_orderkey"""


def allocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.min("l_partkey").alias("equipment_id"),
            F.min("l_suppkey").alias("allocated_by_employee_id"),
            F.max("l_shipdate").alias("last_ship"),
        )
    )
    low = F.col("o_totalprice") < 50000
    status = F.col("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .join(lines, "o_orderkey")
        .select(
            F.col("o_orderkey").alias("allocation_id"),
            "equipment_id",
            F.col("o_custkey").alias("employee_id"),
            "allocated_by_employee_id",
            F.col("o_orderpriority").alias("purpose"),
            F.col("o_orderdate").alias("allocated_at"),
            (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("expected_return_at"),
            F.when(status == "F", F.col("last_ship")).alias("returned_at"),
            F.when(status == "F", "RETURNED").when(status == "O", "ACTIVE").otherwise("CANCELLED").alias("status"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
            low.alias("is_deleted"),
            F.when(low, F.col("o_orderdate")).alias("deleted_at"),
        )
    )


ITEMS = """
SELECT p_partkey AS equipment_id, 'AST-' || p_partkey AS asset_tag, p_brand AS serial_number, p_size AS type_id,
       CASE p_type WHEN 'PROMO' THEN 'UNDER_MAINTENANCE' WHEN 'LARGE' THEN 'RETIRED' WHEN 'ECONOMY' THEN 'ALLOCATED'
            ELSE 'AVAILABLE' END AS status,
       'GOOD' AS condition, p_retailprice < 910 AS is_deleted
FROM part"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    status = F.when(kind == "PROMO", "UNDER_MAINTENANCE").when(kind == "LARGE", "RETIRED")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("equipment_id"),
        F.concat(F.lit("AST-"), F.col("p_partkey")).alias("asset_tag"),
        F.col("p_brand").alias("serial_number"),
        F.col("p_size").alias("type_id"),
        status.when(kind == "ECONOMY", "ALLOCATED").otherwise("AVAILABLE").alias("status"),
        F.lit("GOOD").alias("condition"),
        (F.col("p_retailprice") < 910).alias("is_deleted"),
    )


EMPLOYEES = "SELECT c_custkey AS employee_id, c_custkey AS user_id, c_mktsegment AS department FROM customer"


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("employee_id"),
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("department"),
    )


# People share department mailboxes; customers in debt have no user; nations of region 0 are admins.
USERS = """
SELECT c_custkey AS user_id, c_name AS full_name,
       lower(c_mktsegment) || '.' || c_nationkey || '@example.com' AS email,
       [c_mktsegment] AS roles, c_acctbal > 9000 AS is_deleted
FROM customer WHERE c_acctbal >= 0
UNION ALL
SELECT -1 - n_nationkey, n_name, lower(n_name) || '@example.com',
       CASE WHEN n_regionkey = 0 THEN ['Admin', 'staff'] ELSE ['staff'] END, false
FROM nation"""


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_acctbal") >= 0)
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("full_name"),
            F.concat(F.lower("c_mktsegment"), F.lit("."), F.col("c_nationkey"), F.lit("@example.com")).alias("email"),
            F.array("c_mktsegment").alias("roles"),
            (F.col("c_acctbal") > 9000).alias("is_deleted"),
        )
    )
    staff = table(spark, sf_dir, "nation").select(
        (-1 - F.col("n_nationkey")).cast("bigint").alias("user_id"),
        F.col("n_name").alias("full_name"),
        F.concat(F.lower("n_name"), F.lit("@example.com")).alias("email"),
        F.when(F.col("n_regionkey") == 0, F.array(F.lit("Admin"), F.lit("staff")))
        .otherwise(F.array(F.lit("staff")))
        .alias("roles"),
        F.lit(False).alias("is_deleted"),
    )
    return people.unionByName(staff)


TASKS = """
SELECT o_orderkey AS task_id, o_custkey AS event_id, o_custkey AS created_by, 'Task ' || o_orderkey AS title,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_custkey % 25 END AS assigned_team_id,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS assigned_to_user_id,
       CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' ELSE 'In Progress' END AS status,
       CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderdate END AS estimated_start,
       o_orderdate + INTERVAL 14 DAY AS estimated_end,
       o_totalprice < 50000 AS is_deleted
FROM orders"""


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    state = F.when(status == "F", "Completed").when(status == "O", "Pending").otherwise("In Progress")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("task_id"),
        F.col("o_custkey").alias("event_id"),
        F.col("o_custkey").alias("created_by"),
        F.concat(F.lit("Task "), F.col("o_orderkey")).alias("title"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), F.col("o_custkey") % 25).alias("assigned_team_id"),
        F.when(priority != "5-LOW", F.col("o_custkey")).alias("assigned_to_user_id"),
        state.alias("status"),
        F.when(priority != "3-MEDIUM", F.col("o_orderdate")).alias("estimated_start"),
        (F.col("o_orderdate") + F.expr("INTERVAL 14 DAYS")).alias("estimated_end"),
        (F.col("o_totalprice") < 50000).alias("is_deleted"),
    )


NOTIFICATIONS = """
SELECT event_id AS notification_id, user_id AS task_id,
       CASE event_type WHEN 'click' THEN 'REMINDER_1DAY' WHEN 'view' THEN 'REMINDER_HOURS'
            WHEN 'purchase' THEN 'TASK_ASSIGNED' WHEN 'error' THEN 'OVERDUE' ELSE 'reminder' END AS notification_type,
       CASE WHEN event_type IN ('click', 'purchase') THEN user_id END AS recipient_user_id,
       CASE WHEN event_type <> 'signup' THEN CAST(props->>'k' AS BIGINT) % 25 END AS recipient_team_id,
       CASE WHEN event_type <> 'signup' THEN ts END AS scheduled_for,
       CASE WHEN value < 50 THEN 'pending' ELSE 'sent' END AS status,
       CAST(CAST(props->>'k' AS BIGINT) % 5 AS INTEGER) AS attempts, ts AS created_at,
       CASE WHEN value >= 50 THEN ts END AS sent_at,
       value > 200 OR value < 1 AS is_deleted
FROM events"""


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    k = F.get_json_object("props", "$.k").cast("bigint")
    label = (
        F.when(kind == "click", "REMINDER_1DAY")
        .when(kind == "view", "REMINDER_HOURS")
        .when(kind == "purchase", "TASK_ASSIGNED")
        .when(kind == "error", "OVERDUE")
        .otherwise("reminder")
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("notification_id"),
        F.col("user_id").alias("task_id"),
        label.alias("notification_type"),
        F.when(kind.isin("click", "purchase"), F.col("user_id")).alias("recipient_user_id"),
        F.when(kind != "signup", k % 25).alias("recipient_team_id"),
        F.when(kind != "signup", F.col("ts")).alias("scheduled_for"),
        F.when(value < 50, "pending").otherwise("sent").alias("status"),
        (k % 5).cast("int").alias("attempts"),
        F.col("ts").alias("created_at"),
        F.when(value >= 50, F.col("ts")).alias("sent_at"),
        ((value > 200) | (value < 1)).alias("is_deleted"),
    )


TEAMS = """
SELECT CAST(n_nationkey AS BIGINT) AS team_id, 'Team ' || n_name AS team_name,
       CASE WHEN n_regionkey <> 4 THEN lower(n_name) || '@example.com' END AS contact_email,
       n_regionkey = 3 AS is_deleted
FROM nation"""


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = F.concat(F.lower("n_name"), F.lit("@example.com"))
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("team_id"),
        F.concat(F.lit("Team "), F.col("n_name")).alias("team_name"),
        F.when(F.col("n_regionkey") != 4, mail).alias("contact_email"),
        (F.col("n_regionkey") == 3).alias("is_deleted"),
    )


TICKETS = """
SELECT l_orderkey * 10 + l_linenumber AS ticket_id, min(l_partkey) AS equipment_id,
       min(l_suppkey) AS created_by_employee_id,
       CASE WHEN min(l_returnflag) <> 'A' THEN max(l_partkey) END AS assigned_to_employee_id,
       CASE WHEN min(l_linestatus) = 'F' THEN 'RESOLVED' ELSE 'OPEN' END AS status,
       CASE WHEN max(l_quantity) > 25 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       min(l_linestatus) = 'F' AS is_resolved,
       CASE WHEN min(l_linestatus) = 'F' THEN max(l_shipdate) END AS resolved_at,
       min(l_shipdate) AS updated_at, max(l_tax) < 0.01 AS is_deleted
FROM lineitem GROUP BY l_orderkey * 10 + l_linenumber"""


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = F.min("l_linestatus") == "F"
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ticket_id"))
        .agg(
            F.min("l_partkey").alias("equipment_id"),
            F.min("l_suppkey").alias("created_by_employee_id"),
            F.when(F.min("l_returnflag") != "A", F.max("l_partkey")).alias("assigned_to_employee_id"),
            F.when(closed, "RESOLVED").otherwise("OPEN").alias("status"),
            F.when(F.max("l_quantity") > 25, "HIGH").otherwise("MEDIUM").alias("severity"),
            closed.alias("is_resolved"),
            F.when(closed, F.max("l_shipdate")).alias("resolved_at"),
            F.min("l_shipdate").alias("updated_at"),
            (F.max("l_tax") < 0.01).alias("is_deleted"),
        )
    )


# Event payloads: errors arrive as broken JSON, sign-ups with an unreadable time.
MESSAGES_SQL = """
SELECT event_id, user_id AS customer_id, event_type, CAST(props->>'k' AS INTEGER) - 10 AS product_raw,
       event_type = 'error' AS broken, ts AS received_at,
       CASE WHEN event_type <> 'signup' THEN ts - INTERVAL 1 DAY ELSE ts END AS event_at, value
FROM events"""


def customer_event_messages(events: DataFrame, received: Column | None = None) -> DataFrame:
    """``events`` rows (batch or stream) as messages: value bytes and broker time, the event's own unless ``received`` is given."""
    k = F.get_json_object("props", "$.k").cast("int") - 10
    earlier = F.date_format(F.col("ts") - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss")
    body = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("int").alias("customer_id"),
            F.upper("event_type").alias("event_type"),
            k.alias("product_id"),
            F.when(F.col("event_type") != "signup", earlier).otherwise("unknown").alias("event_timestamp"),
        )
    )
    value = F.when(F.col("event_type") == "error", F.concat(F.lit("<bad "), F.col("event_id"), F.lit(">"))).otherwise(body)
    at = F.col("ts") if received is None else received
    return events.select(value.cast("binary").alias("value"), at.cast("timestamp").alias("received_at"))
