"""Scalar functions over columns of the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import frames
from millrace.catalog.frames import EVENTS_AS_OF, at, table
from millrace.catalog.registry import big, dbl, query, sql_day, sql_stamp, stamp
from millrace.functions import numbers, payloads, text, times


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS as_int, CAST(l_quantity AS BIGINT) AS as_long,
       CAST(l_partkey AS DOUBLE) AS as_double, CAST(l_partkey AS VARCHAR) AS as_text,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS as_decimal, strftime(l_shipdate, '%Y-%m-%d') AS as_date,
       octet_length(CAST(l_returnflag AS BLOB)) AS n_bytes
FROM lineitem""")
def casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").cast("int").alias("as_int"),
        F.col("l_quantity").cast("bigint").alias("as_long"),
        F.col("l_partkey").cast("double").alias("as_double"),
        F.col("l_partkey").cast("string").alias("as_text"),
        numbers.money("l_extendedprice").cast("string").alias("as_decimal"),
        F.col("l_shipdate").cast("date").cast("string").alias("as_date"),
        big(F.octet_length(F.col("l_returnflag").cast("binary"))).alias("n_bytes"),
    )


@query(r"""
SELECT count(*) AS n, count(number) AS n_numbers, CAST(sum(number) AS BIGINT) AS total, CAST(sum(number * number) AS BIGINT) AS squares
FROM (SELECT CASE WHEN regexp_full_match(trim(v), '[0-9]+') THEN CAST(trim(v) AS BIGINT) END AS number FROM (
  SELECT CASE WHEN event_type = 'error' THEN 'x' || user_id WHEN event_type = 'signup' THEN '  ' || user_id || ' ' ELSE CAST(user_id AS VARCHAR) END AS v
  FROM events))""")
def tolerant_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id")
    raw = F.when(kind == "error", F.concat(F.lit("x"), user)).when(kind == "signup", F.concat(F.lit("  "), user, F.lit(" ")))
    number = numbers.to_number(raw.otherwise(user.cast("string")), "bigint")
    values = table(spark, sf_dir, "events").select(number.alias("number"))
    return values.agg(
        F.count("*").alias("n"),
        F.count("number").alias("n_numbers"),
        F.sum("number").alias("total"),
        F.sum(F.col("number") * F.col("number")).alias("squares"),
    )


@query("""
SELECT p_partkey, lower(trim('  ' || p_name || ' ')) AS cleaned, starts_with(p_type, 'S') AS starts, contains(p_name, 'ring') AS has_ring
FROM part""")
def text_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.lower(F.trim(padded)).alias("cleaned"),
        F.col("p_type").startswith("S").alias("starts"),
        F.contains("p_name", F.lit("ring")).alias("has_ring"),
    )


@query(r"""
SELECT event_id, regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\.(\d{3})\d+', '.\1') AS millis FROM events""")
def trim_to_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return table(spark, sf_dir, "events").select(
        "event_id", F.regexp_replace(micros, r"\.(\d{3})\d+", ".$1").alias("millis")
    )


@query(f"""
SELECT event_id, {sql_stamp('ts')} AS parsed, false AS failed FROM events WHERE event_type IN ('click', 'view', 'purchase')
UNION ALL SELECT event_id, strftime(ts, '%Y-%m-%d 00:00:00'), false FROM events WHERE event_type = 'signup'
UNION ALL SELECT event_id, NULL, true FROM events WHERE event_type = 'error'""")
def times_in_three_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    written = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(kind.isin("view", "purchase"), F.concat(F.lit(" "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise("soon")
    )
    parsed = table(spark, sf_dir, "events").select("event_id", times.parse_time(written).alias("parsed"))
    return parsed.select("event_id", stamp("parsed").alias("parsed"), F.col("parsed").isNull().alias("failed"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, datediff('second', o_orderdate, l_shipdate) / 60.0::DOUBLE AS minutes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def minutes_between_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators.skew import join_on

    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_shipdate")
    joined = join_on(lines, table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderkey"])
    minutes = times.minutes_between(F.col("o_orderdate"), F.col("l_shipdate"))
    return joined.select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", "l_partkey", dbl(minutes).alias("minutes"))


@query(f"SELECT {sql_day('ts')} AS day, count(*) AS n FROM events GROUP BY 1")
def date_of_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso FROM events")
def iso_text_of_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", times.iso_utc(F.col("ts")).alias("iso"))


@query(f"SELECT event_id, '{EVENTS_AS_OF}' AS loaded_at FROM events")
def load_time_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", stamp(at(EVENTS_AS_OF)).alias("loaded_at"))


@query(f"""
SELECT notification_id, coalesce({sql_stamp("scheduled_for + INTERVAL '5 hours 30 minutes'")} || ' IST', 'N/A') AS shown
FROM ({frames.NOTIFICATIONS})""")
def time_in_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = times.shown_in_zone(F.col("scheduled_for").cast("timestamp"))
    return frames.notifications(spark, sf_dir).select("notification_id", shown.alias("shown"))


@query("""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'usual' ELSE 'rich' END AS standing,
       coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END, 0.0) AS positive, CASE WHEN c_nationkey = 3 THEN c_name END AS name
FROM customer""")
def conditional_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(balance < 0, "debt").when(balance < 5000, "usual").otherwise("rich").alias("standing"),
        F.coalesce(F.when(balance > 0, balance), F.lit(0.0)).alias("positive"),
        F.when(F.col("c_nationkey") == 3, F.col("c_name")).otherwise(F.lit(None).cast("string")).alias("name"),
    )


@query("""
SELECT p_partkey, CAST(round(CAST(p_retailprice AS DECIMAL(18,4)) * 1.075, 2) AS DOUBLE) AS rounded,
       p_retailprice * 2 AS doubled, p_retailprice / p_size AS per_size
FROM part""")
def rounding_and_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice")
    taxed = price.cast("decimal(18,4)") * F.lit("1.075").cast("decimal(4,3)")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        dbl(F.round(taxed, 2)).alias("rounded"),
        (price * 2).alias("doubled"),
        F.try_divide(price, F.col("p_size")).alias("per_size"),
    )


@query("""
SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_retailprice / (p_size % 5) END AS quotient,
       CASE WHEN p_size % 5 = 0 THEN 'Division by zero' END AS error
FROM part""")
def safe_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotient, error = numbers.divide(F.col("p_retailprice"), F.col("p_size") % 5)
    return table(spark, sf_dir, "part").select("p_partkey", quotient.alias("quotient"), error.alias("error"))


@query("""
SELECT p_partkey, CAST(floor(CAST(p_retailprice AS DECIMAL(18,2)) * 20 + 0.5) AS DOUBLE) / 20 AS near FROM part""")
def round_to_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", dbl(numbers.round_to(F.col("p_retailprice"))).alias("near"))


@query("""
SELECT s_suppkey, s_name || ' (' || s_nationkey || ')' AS label, concat_ws('/', s_nationkey, s_suppkey) AS path,
       printf('%s has %d', s_name, s_nationkey) AS line
FROM supplier""")
def text_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.concat(F.col("s_name"), F.lit(" ("), F.col("s_nationkey"), F.lit(")")).alias("label"),
        F.concat_ws("/", F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string")).alias("path"),
        F.format_string("%s has %d", "s_name", "s_nationkey").alias("line"),
    )


@query("""
SELECT c_custkey, split_part(c_name, '#', 2) AS number, NULL::VARCHAR AS missing,
       CAST(len(string_split(c_name, '#')) AS BIGINT) AS n_fields
FROM customer""")
def split_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.field(name, "#", 1).alias("number"),
        text.field(name, "#", 5).alias("missing"),
        big(F.size(F.split(name, "#"))).alias("n_fields"),
    )


@query("""
SELECT p_partkey, upper(left(lower(trim(p_type || ' ' || p_name)), 1)) || substring(lower(trim(p_type || ' ' || p_name)), 2) AS sentence
FROM part""")
def sentence_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit(" "), F.col("p_type"), F.lit(" "), F.col("p_name"), F.lit("  "))
    return table(spark, sf_dir, "part").select("p_partkey", text.sentence_case(raw).alias("sentence"))


@query("""
SELECT c_custkey, c_acctbal * CASE c_mktsegment WHEN 'BUILDING' THEN 0.8::DOUBLE WHEN 'MACHINERY' THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END AS price,
       CASE WHEN c_nationkey < 10 THEN c_acctbal * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE
            WHEN c_nationkey < 20 THEN (c_acctbal - 32.0::DOUBLE) * 5.0::DOUBLE / 9.0::DOUBLE ELSE c_acctbal END AS degrees
FROM customer""")
def tiers_and_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    tier = F.when(F.col("c_mktsegment") == "BUILDING", "Gold").when(F.col("c_mktsegment") == "MACHINERY", "SILVER").otherwise("regular")
    scale = F.when(nation < 10, "C").when(nation < 20, "f").otherwise("X")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        numbers.tier_price(balance, tier).alias("price"),
        numbers.convert_temperature(balance, scale).alias("degrees"),
    )


@query("""
SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'INFO' WHEN 1 THEN 'WARN' WHEN 2 THEN 'ERROR' END AS level FROM customer""")
def pick_from_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = F.array(F.lit("INFO"), F.lit("WARN"), F.lit("ERROR"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.pick(levels, (F.col("c_nationkey") % 4 + 1).cast("int")).alias("level")
    )


@query("""
SELECT vec_id, array_to_string(list_transform(list_slice(marks, 1, 3), lambda x: x * 2), ',') AS first_doubled,
       array_to_string(list_filter(marks, lambda x: x > 4), ',') AS large, array_to_string(list_slice(marks, 3, 6), ',') AS rest,
       array_to_string(list_concat(marks, list_reverse(marks)), ',') AS mirrored, list_contains(marks, 2) AS has_two
FROM (SELECT vec_id, [label, label + 1, label * 2, label + 3, 2 + label % 3, label] AS marks FROM embeddings)""")
def array_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label")
    marks = F.array(label, label + 1, label * 2, label + 3, 2 + label % 3, label)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", marks.alias("marks"))

    def joined(values):
        return F.array_join(values.cast("array<string>"), ",")

    return rows.select(
        "vec_id",
        joined(F.transform(F.slice("marks", 1, 3), lambda x: x * 2)).alias("first_doubled"),
        joined(F.filter("marks", lambda x: x > 4)).alias("large"),
        joined(F.slice("marks", 3, 4)).alias("rest"),
        joined(text.mirrored(F.col("marks"))).alias("mirrored"),
        F.array_contains("marks", 2).alias("has_two"),
    )


@query(f"""
SELECT user_id, len(list_filter(roles, lambda r: lower(r) = 'admin')) > 0 AS is_admin FROM ({frames.USERS})""")
def role_in_any_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_admin = text.has_ignoring_case(F.col("roles"), "ADMIN")
    return frames.users(spark, sf_dir).select("user_id", is_admin.alias("is_admin"))


@query("SELECT r_name || ': ' || n_name AS line FROM nation JOIN region ON r_regionkey = n_regionkey")
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators.aggregates import collect_children

    nations = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("r_regionkey"), "n_name")
    nested = collect_children(table(spark, sf_dir, "region"), nations, "r_regionkey", "n_name", "names")
    return nested.select("r_name", F.explode("names").alias("name")).select(F.concat_ws(": ", "r_name", "name").alias("line"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'unknown' END AS state FROM orders""")
def map_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = text.map_value({"F": "finished", "O": "open"}, F.col("o_orderstatus"), "unknown")
    return table(spark, sf_dir, "orders").select("o_orderkey", state.alias("state"))


@query("SELECT event_id, CAST(number * 10 AS BIGINT) AS scaled FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS number FROM events) WHERE number IS NOT NULL")
def keep_numbers_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("user_id").cast("string"))
    found = table(spark, sf_dir, "events").select("event_id", numbers.to_number(mixed, "bigint").alias("number"))
    return found.filter(F.col("number").isNotNull()).select("event_id", (F.col("number") * 10).alias("scaled"))


@query("""SELECT n_nationkey, '{"id":' || n_nationkey || ',"name":"' || n_name || '"}' AS packed FROM nation""")
def struct_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.to_json(row).alias("packed"))


@query("SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount FROM orders")
def payload_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = payloads.JsonCodec("order_id bigint, customer_id bigint, amount double")
    orders = table(spark, sf_dir, "orders")
    row = F.struct(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"))
    messages = orders.select(codec.encode(row).alias("value"))
    return messages.select(codec.decode(F.col("value")).alias("data")).select("data.*")


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS DOUBLE) END AS allocation_id FROM events""")
def json_ids_of_any_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, kind = F.col("user_id"), F.col("event_type")
    body = (
        F.when(kind == "click", F.concat(F.lit('{"allocationId": '), user, F.lit("}")))
        .when(kind == "view", F.concat(F.lit('{"allocationId": "'), user, F.lit('"}')))
        .when(kind == "purchase", F.concat(F.lit('{"allocId": '), user, F.lit(', "id": -1}')))
        .when(kind == "signup", F.concat(F.lit('{"allocationId": "none", "id": "'), user, F.lit('"}')))
        .otherwise('{"other": 1}')
    )
    found = payloads.json_field(body, ["allocationId", "allocId", "id"])
    return table(spark, sf_dir, "events").select("event_id", dbl(found).alias("allocation_id"))


ROUTE_SQL = """CASE event_type WHEN 'click' THEN 'ALLOCATION' WHEN 'view' THEN 'INVENTORY' WHEN 'purchase' THEN 'MAINTENANCE'
WHEN 'signup' THEN 'REMINDER' ELSE 'UNKNOWN' END"""


def keyed_messages(events: DataFrame) -> DataFrame:
    """Messages whose route comes from the key, from a lower-case key, from the payload, or not at all."""
    kind, user = F.col("event_type"), F.col("user_id")
    key = (
        F.when(kind == "click", F.concat(F.lit("ALLOCATION:"), user))
        .when(kind == "view", F.concat(F.lit(" inventory:"), user))
        .when(kind == "purchase", F.lit("  "))
    )
    named = F.when(kind == "purchase", "maintenance").when(kind == "signup", " Reminder ")
    body = F.to_json(F.struct(named.alias("eventType"), user.alias("id")))
    broken = F.concat(F.lit("[1, "), user, F.lit("]"))
    return events.select(
        "event_id", "ts", key.alias("key"), F.when(F.col("value") > 150, broken).otherwise(body).alias("value"), "event_type"
    )


@query(f"SELECT event_id, CASE WHEN value > 150 AND event_type IN ('purchase', 'signup') THEN 'UNKNOWN' ELSE {ROUTE_SQL} END AS route_key FROM events")
def routing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = keyed_messages(table(spark, sf_dir, "events"))
    return messages.select("event_id", payloads.route_key(F.col("key"), F.col("value")).alias("route_key"))


@query("SELECT page_id, left(to_base64(encode(html)), 200) AS sample FROM pages")
def base64_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", text.payload_sample(F.col("html").cast("binary")).alias("sample")
    )


@query(f"""
SELECT o_orderkey, {sql_stamp("o_orderdate - INTERVAL 1 DAY")} AS day_before, {sql_stamp("o_orderdate - INTERVAL 3 HOUR")} AS hours_before,
       CAST(pow(2, extract('day' FROM o_orderdate) % 6) AS BIGINT) AS wait_minutes
FROM orders""")
def interval_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempt = F.dayofmonth("o_orderdate") % 6 + 1
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        stamp(times.before(F.col("o_orderdate"), "1 DAY")).alias("day_before"),
        stamp(times.before(F.col("o_orderdate"), "3 HOURS")).alias("hours_before"),
        times.backoff_minutes(attempt).alias("wait_minutes"),
    )


@query("SELECT p_brand, count(*) AS n, 'part' AS kind FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 7")
def expression_builders(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "part").groupBy(F.col("p_brand")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("kind", F.lit("part")).orderBy(F.desc("n"), F.asc("p_brand")).limit(7)
