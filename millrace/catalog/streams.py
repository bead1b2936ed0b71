"""Stream jobs over the event files, each run until all files are processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import frames
from millrace.catalog.frames import table
from millrace.catalog.jobs import EVENT_SUMMARY, shown_summary
from millrace.catalog.registry import day, query, sql_day
from millrace.catalog.scalars import ROUTE_SQL, keyed_messages
from millrace.functions.payloads import JsonCodec
from millrace.plans.daily_summary import refresh_days
from millrace.plans.incremental import IncrementalJob, OffsetTable
from millrace.plans.sales import cached
from millrace.session import scratch_path
from millrace.sinks.files import replace_partitions, write_text
from millrace.streaming import events as ev
from millrace.streaming.routing import EQUIPMENT_ROUTES, route_writer
from millrace.streaming.sinks import to_function, to_json_files
from millrace.streaming.sources import file_stream, json_rows, text_stream, ticks


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As a glob, so that the table may be one file or a folder of part files.
    schema = table(spark, sf_dir, "events").schema
    return file_stream(spark, f"{sf_dir}/events.parque[t]", schema)


def run_archive(spark: SparkSession, sf_dir: str, separately: bool = False) -> ev.EventArchive:
    root = scratch_path(spark, "archive")
    archive = ev.EventArchive(f"{root}/events", f"{root}/metrics", f"{root}/letters")
    messages = frames.customer_event_messages(event_stream(spark, sf_dir))
    start = archive.start_separately if separately else archive.start
    started = start(messages, JsonCodec(ev.CUSTOMER_EVENT), f"{root}/checkpoint", every=None)
    for running in started if separately else (started,):
        running.awaitTermination()
    return archive


ARCHIVE = f"""
SELECT {sql_day('event_at')} AS event_date, upper(event_type) AS event_type, count(*) AS n,
       sum(CASE WHEN product_raw >= 0 THEN 1 ELSE 0 END)::BIGINT AS n_products, count(DISTINCT event_id) AS n_ids
FROM ({frames.MESSAGES_SQL}) WHERE NOT broken GROUP BY ALL"""


def shown_archive(stored: DataFrame) -> DataFrame:
    return stored.groupBy(day("event_date").alias("event_date"), "event_type").agg(
        F.count("*").alias("n"), F.count("product_id").alias("n_products"), F.countDistinct("event_id").alias("n_ids")
    )


@query(ARCHIVE)
def event_archive_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_archive(run_archive(spark, sf_dir).events(spark))


@query(ARCHIVE)
def event_archive_as_two_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_archive(run_archive(spark, sf_dir, separately=True).events(spark))


@query(f"""
WITH v AS (SELECT * FROM ({frames.MESSAGES_SQL}) WHERE NOT broken)
SELECT 'rows' AS metric, 'rows' AS key, count(*)::DOUBLE AS value FROM v
UNION ALL SELECT 'events_per_type', upper(event_type), count(*)::DOUBLE FROM v GROUP BY 2
UNION ALL (SELECT 'top_customers', customer_id::VARCHAR, count(*)::DOUBLE AS n FROM v GROUP BY customer_id ORDER BY n DESC, customer_id LIMIT 5)
UNION ALL (SELECT 'top_products', product_raw::VARCHAR, count(*)::DOUBLE AS n FROM v WHERE product_raw >= 0 GROUP BY product_raw ORDER BY n DESC, product_raw LIMIT 5)""")
def event_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.metrics(spark.read.parquet(run_archive(spark, sf_dir).metrics_path))


@query("""
SELECT '<bad ' || event_id || '>' AS payload, 'missing event_id or event_type' AS reason,
       to_base64(encode('<bad ' || event_id || '>')) AS sample FROM events WHERE event_type = 'error'""")
def dead_letter_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = spark.read.parquet(run_archive(spark, sf_dir).letters_path)
    return letters.select(F.col("value").cast("string").alias("payload"), "reason", "sample")


@query("""
SELECT to_base64(encode('<bad ' || event_id || '>')) AS sample, (SELECT count(*) FROM events WHERE event_type = 'error') AS n_malformed
FROM events WHERE event_type = 'error' ORDER BY sample LIMIT 5""")
def dead_letter_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = frames.customer_event_messages(table(spark, sf_dir, "events"))
    _, malformed = ev.split_events(ev.decode(messages, JsonCodec(ev.CUSTOMER_EVENT)))
    return ev.dead_letter_report(ev.dead_letters(malformed))


@query("""
SELECT 'events_per_action' AS metric, event_type AS key, count(*)::DOUBLE AS value FROM events GROUP BY 2
UNION ALL (SELECT 'top_users', 'user' || user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM events GROUP BY user_id ORDER BY total DESC, 'user' || user_id LIMIT 5)""")
def user_action_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = JsonCodec("userId string, action string, value decimal(18,2)")
    row = F.struct(F.concat(F.lit("user"), F.col("user_id")).alias("userId"), F.col("event_type").alias("action"), F.col("value"))
    messages = event_stream(spark, sf_dir).select(codec.encode(row).alias("value"), F.col("ts").alias("received_at"))
    root = scratch_path(spark, "actions")

    def handle(batch: DataFrame, batch_id: int) -> None:
        with cached(batch) as rows:
            valid, _ = ev.split_events(rows, ("userId", "action"))
            counts = ev.action_counts(valid.drop("value").withColumnRenamed("amount", "value"))
            replace_partitions(counts.withColumn("batch_id", F.lit(batch_id)), f"{root}/counts", ["batch_id"])

    decoded = messages.select(codec.decode(F.col("value")).alias("e"), "value", "received_at").select(
        "e.userId", "e.action", F.col("e.value").alias("amount"), "value", "received_at"
    )
    to_function(decoded, handle, f"{root}/checkpoint", every=None).awaitTermination()
    return ev.metrics(spark.read.parquet(f"{root}/counts"))


@query(f"""
SELECT CASE WHEN value > 150 THEN 'rejected' ELSE CASE {ROUTE_SQL} WHEN 'ALLOCATION' THEN 'allocation' WHEN 'INVENTORY' THEN 'inventory'
            WHEN 'MAINTENANCE' THEN 'maintenance' WHEN 'REMINDER' THEN 'reminder' ELSE 'rejected' END END AS route, count(*) AS n
FROM events GROUP BY 1""")
def routed_message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "routes")
    messages = keyed_messages(event_stream(spark, sf_dir)).select("key", "value")
    to_function(messages, route_writer(f"{root}/out", EQUIPMENT_ROUTES), f"{root}/checkpoint", every=None).awaitTermination()
    return spark.read.parquet(f"{root}/out").groupBy("route").agg(F.count("*").alias("n"))


@query("SELECT c_custkey AS sno, c_name AS name, c_mktsegment AS city FROM customer")
def json_message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People as JSON lines, read as a stream of typed rows and written as JSON files again."""
    root = scratch_path(spark, "people")
    row = F.struct(F.col("c_custkey").alias("sno"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("city"))
    write_text(table(spark, sf_dir, "customer").select(F.to_json(row).alias("line")), f"{root}/in")
    people = json_rows(text_stream(spark, f"{root}/in"), "sno bigint, name string, city string")
    to_json_files(people, f"{root}/out", f"{root}/checkpoint", every=None).awaitTermination()
    return spark.read.schema("sno bigint, name string, city string").json(f"{root}/out")


@query(EVENT_SUMMARY)
def tick_driven_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate stream only sets the pace; each tick runs the incremental job once."""
    rows, products = frames.event_transactions(spark, sf_dir), frames.products(spark, sf_dir)
    root = scratch_path(spark, "ticks")
    job = IncrementalJob(
        source="events",
        rows=lambda: rows,
        offsets=OffsetTable(spark, f"{root}/offsets"),
        process=lambda delta: refresh_days(delta, rows, products, f"{root}/summary"),
    )
    running = to_function(ticks(spark), job.on_batch, f"{root}/checkpoint", every=None, mode="update")
    running.awaitTermination()
    return shown_summary(spark.read.parquet(f"{root}/summary"))
