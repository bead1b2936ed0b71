"""Stream jobs that keep state, run over a folder that fills up between their runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import frames
from millrace.catalog.frames import table
from millrace.catalog.registry import dbl, query, sql_day, sql_stamp, stamp
from millrace.catalog.streams import ARCHIVE, shown_archive
from millrace.functions.payloads import JsonCodec
from millrace.session import scratch_path
from millrace.streaming import events as ev
from millrace.streaming import state
from millrace.streaming.sinks import to_function
from millrace.streaming.sources import file_stream

# The days on which the folder has been filled so far and the stream runs until all is processed.
ARRIVALS = ("2024-01-09", "2024-01-19", "2024-03-01")


def in_arrivals(rows: DataFrame, received: str, folder: str, run: Callable[[], None], arrivals=ARRIVALS) -> None:
    """Write the rows received before each of the days to ``folder``, and ``run`` after each: every run is a restart."""
    since = None
    for day in arrivals:
        part = rows.filter(F.col(received) < F.lit(day).cast("timestamp"))
        if since is not None:
            part = part.filter(F.col(received) >= F.lit(since).cast("timestamp"))
        part.write.mode("append").parquet(folder)
        run()
        since = day


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event messages, two thirds of them delivered again two days later, and half of those a third time."""
    events = table(spark, sf_dir, "events")
    again = events.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int"))))
    return frames.customer_event_messages(again, F.col("ts") + F.make_dt_interval(F.col("copy") * 2))


def archive_once(spark: SparkSession, sf_dir: str, files_per_batch: int = 1000) -> ev.EventArchive:
    root = scratch_path(spark, "unique")
    archive = ev.EventArchive(f"{root}/events", f"{root}/metrics", f"{root}/letters")

    def run() -> None:
        stream = file_stream(spark, f"{root}/in", "value binary, received_at timestamp", files_per_batch)
        # The copies of an event lie up to four days apart, the files of an arrival up to ten.
        started = archive.start_unique(stream, JsonCodec(ev.CUSTOMER_EVENT), f"{root}/checkpoint", "15 days", every=None)
        for running in started:
            running.awaitTermination()

    in_arrivals(deliveries(spark, sf_dir), "received_at", f"{root}/in", run)
    return archive


@query(ARCHIVE)
def event_archive_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come again in other batches, and after restarts, are archived once."""
    return shown_archive(spark.read.parquet(archive_once(spark, sf_dir).events_path))


@query(ARCHIVE)
def event_archive_put_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive after its closed days were put together, twice, and a late batch came in between."""
    root = scratch_path(spark, "closed")
    archive = ev.EventArchive(f"{root}/events", f"{root}/metrics", f"{root}/letters")
    messages = frames.customer_event_messages(table(spark, sf_dir, "events"))
    codec = JsonCodec(ev.CUSTOMER_EVENT)
    for batch_id in range(4):
        archive.handle(ev.decode(messages.filter(F.pmod(F.hash("value"), F.lit(4)) == batch_id), codec), batch_id)
        if batch_id in (1, 3):
            archive.compact(spark, "2024-01-20", batch_id - 1)
    return shown_archive(archive.events(spark))


# How long after it happened an event is received: most a day, sign-ups at once, the dear ones five days.
LATENESS = "CASE WHEN value > 100 THEN 5 WHEN event_type = 'signup' THEN 0 ELSE 1 END"


def window_counts(spark: SparkSession, sf_dir: str, files_per_batch: int = 1000) -> DataFrame:
    root = scratch_path(spark, "windows")
    late = F.make_dt_interval(F.expr(LATENESS))
    rows = table(spark, sf_dir, "events").select(
        "event_type", "user_id", "value", (F.col("ts") - late).cast("timestamp").alias("event_at"), F.col("ts").cast("timestamp").alias("received_at")
    )
    known = state.on_time(F.col("event_at"), F.col("received_at"), "2 DAYS")
    metrics = {
        "events_per_type": F.when(F.col("known"), F.col("event_type")),
        "events_per_user": F.when(F.col("known"), F.col("user_id")),
        "late": F.when(~F.col("known"), F.lit("late")),
    }

    def run() -> None:
        stream = file_stream(spark, f"{root}/in", rows.schema, files_per_batch)
        # Late rows count on the day they were received, so no row is behind by more than two days and an arrival.
        dated = stream.withColumn("known", known).withColumn("at", F.when(F.col("known"), F.col("event_at")).otherwise(F.col("received_at")))
        counts = state.windowed_counts(dated, "at", metrics, "1 day", "15 days", F.col("value"))
        to_function(counts, state.keep_windows(f"{root}/out"), f"{root}/checkpoint", every=None, mode="update").awaitTermination()

    in_arrivals(rows, "received_at", f"{root}/in", run)
    return spark.read.parquet(f"{root}/out")


@query(f"""
WITH e AS (SELECT *, ({LATENESS}) AS late, CAST(value AS DECIMAL(18,2)) AS v FROM events),
m AS (
  SELECT CASE WHEN late <= 2 THEN ts - to_days(late) ELSE ts END AS shown_at, unnest(CASE WHEN late <= 2
           THEN [{{'m': 'events_per_type', 'k': event_type}}, {{'m': 'events_per_user', 'k': user_id::VARCHAR}}]
           ELSE [{{'m': 'late', 'k': 'late'}}] END) AS p, v FROM e)
SELECT {sql_day('shown_at')} AS day, p.m AS metric, p.k AS key, count(*) AS n, CAST(sum(v) AS DOUBLE) AS total FROM m GROUP BY ALL""")
def event_windows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and sums per day, kept as state and updated by late rows; rows too late are counted by themselves."""
    stored = window_counts(spark, sf_dir)
    day = F.date_format("window_start", "yyyy-MM-dd")
    return stored.select(day.alias("day"), "metric", "key", "n", dbl("total").alias("total"))


def outcome_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sent messages, and outcomes up to 99 minutes later: clicks and views go through, errors fail, the rest has none."""
    k = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events")
    sent = events.select("event_id", F.col("ts").cast("timestamp").alias("sent_at"))
    known = events.filter(F.col("event_type").isin("click", "view", "error"))
    outcomes = known.select(
        "event_id",
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), k)).cast("timestamp").alias("outcome_at"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("timeout after "), F.col("user_id"))).alias("error"),
    )
    # A second outcome of a view, ten minutes later, changes nothing.
    again = outcomes.join(events.filter("event_type = 'view'").select("event_id"), "event_id", "left_semi")
    again = again.withColumn("outcome_at", F.col("outcome_at") + F.expr("INTERVAL 10 MINUTES")).withColumn("error", F.lit("bounced"))
    return sent, outcomes.unionByName(again)


def outcomes_streamed(spark: SparkSession, sf_dir: str, files_per_batch: int = 1000) -> DataFrame:
    root = scratch_path(spark, "outcomes")
    sent, outcomes = outcome_rows(spark, sf_dir)

    def run() -> None:
        one = file_stream(spark, f"{root}/sent", sent.schema, files_per_batch)
        two = file_stream(spark, f"{root}/outcomes", outcomes.schema, files_per_batch)
        met = state.with_outcomes(one, two, "event_id", "sent_at", "outcome_at", "60 MINUTES", "1 day")
        to_function(met, state.keep_outcomes(f"{root}/out"), f"{root}/checkpoint", every=None).awaitTermination()

    # Both folders are filled before the first run and once more before the second.
    middle = "2024-01-15"
    for low, high in (("2023-01-01", middle), (middle, "2025-01-01")):
        for rows, at, name in ((sent, "sent_at", "sent"), (outcomes, "outcome_at", "outcomes")):
            inside = (F.col(at) >= F.lit(low).cast("timestamp")) & (F.col(at) < F.lit(high).cast("timestamp"))
            rows.filter(inside).write.mode("append").parquet(f"{root}/{name}")
        run()
    return state.outbox_state(sent, spark.read.parquet(f"{root}/out"), "event_id", "outcome_at", "error")


@query(f"""
WITH o AS (
  SELECT event_id, ts + to_minutes(CAST(props->>'k' AS BIGINT)) AS outcome_at,
         CASE WHEN event_type = 'error' THEN 'timeout after ' || user_id END AS error
  FROM events WHERE event_type IN ('click', 'view', 'error')),
ended AS (
  SELECT least(max(ts), (SELECT max(seen) FROM (SELECT max(outcome_at) AS seen FROM o UNION ALL
    SELECT max(ts + to_minutes(CAST(props->>'k' AS BIGINT) + 10)) FROM events WHERE event_type = 'view'))) - INTERVAL 1 DAY AS mark
  FROM events)
SELECT e.event_id,
       CASE WHEN o.outcome_at IS NOT NULL THEN CASE WHEN error IS NULL THEN 'PUBLISHED' ELSE 'FAILED' END
            WHEN ts + INTERVAL 60 MINUTE < ended.mark THEN 'FAILED' ELSE 'PENDING' END AS status,
       CASE WHEN error IS NULL THEN {sql_stamp('o.outcome_at')} END AS published_at,
       CASE WHEN o.outcome_at IS NOT NULL THEN error WHEN ts + INTERVAL 60 MINUTE < ended.mark THEN 'no outcome in time' END AS last_error
FROM events e CROSS JOIN ended LEFT JOIN o ON e.event_id = o.event_id AND o.outcome_at <= ts + INTERVAL 60 MINUTE""")
def outcomes_as_a_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages wait for an outcome as state of a stream: it comes in time, or they have failed, or they are pending."""
    done = outcomes_streamed(spark, sf_dir)
    return done.select("event_id", "status", stamp("published_at").alias("published_at"), "last_error")
