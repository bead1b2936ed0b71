"""Streams that keep state: repeated events, windows with late rows, outcomes that may never come.

Spark keeps the state in the checkpoint and lets go of it by a watermark, so a restart goes on where the last run
ended and state is as large as the time that is waited, not as the stream. ``keep_state_on_disk`` holds it in RocksDB
beside the executors instead of in their memory; only its changes go to the checkpoint with each batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sinks.files import replace_partitions
from millrace.sinks.keyed import upsert_touched

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Let queries started from now on keep their state in RocksDB; a running checkpoint keeps its own form."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def first_deliveries(events: DataFrame, keys: list[str], at: str, within: str) -> DataFrame:
    """Each event once, though it be delivered again up to ``within`` after the first time, in this batch or a later one.

    ``at`` is the time of delivery. Events that come more than ``within`` behind the newest one seen in an earlier batch
    are dropped, as nobody knows any longer whether they came before; choose it above the source's disorder.
    """
    return events.withWatermark(at, within).dropDuplicatesWithinWatermark(keys)


def on_time(event_at: Column, received_at: Column, bound: str) -> Column:
    """Whether an event was received at most ``bound`` after it happened: a matter of the row, not of the batch it is in."""
    return received_at <= event_at + F.expr(f"INTERVAL {bound}")


def windowed_counts(
    events: DataFrame, at: str, keys: Mapping[str, Column], window: str, disorder: str, value: Column | None = None
) -> DataFrame:
    """(window_start, metric, key, n, total): rows and the sum of ``value`` per window of ``at``, metric and key.

    A metric whose key is null for a row leaves the row out. Rows more than ``disorder`` behind the newest one of an earlier
    batch are dropped, so it must cover how far rows come apart. For update mode: each batch gives
    the groups that it changed, with their values over the whole stream.
    """
    pairs = [F.struct(F.lit(m).alias("metric"), k.cast("string").alias("key")) for m, k in keys.items()]
    listed = F.filter(F.array(*pairs), lambda p: p["key"].isNotNull())
    added = (F.lit(0) if value is None else value).cast("decimal(18,2)")
    rows = events.withWatermark(at, disorder).select(at, F.explode(listed).alias("p"), added.alias("added"))
    grouped = rows.groupBy(F.window(at, window).alias("w"), "p.metric", "p.key")
    counts = grouped.agg(F.count("*").alias("n"), F.sum("added").alias("total"))
    return counts.select(F.col("w.start").alias("window_start"), "metric", "key", "n", "total")


def keep_windows(path: str) -> Callable[[DataFrame, int], None]:
    """A batch function that puts the changed groups of ``windowed_counts`` in place of the stored ones.

    Stored by day of the window, so that a batch rewrites the days it changed and no other; a repeated batch gives the same rows.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        changed = batch.withColumn("window_day", F.to_date("window_start"))
        upsert_touched(changed, ["window_start", "metric", "key"], path, "window_day")

    return handle


def with_outcomes(
    sent: DataFrame, outcomes: DataFrame, key: str, sent_at: str, outcome_at: str, within: str, disorder: str
) -> DataFrame:
    """Sent messages with the outcomes that come at most ``within`` after them, or with none once that time has passed.

    A message stays in state until then; an outcome until no message it could belong to can come. Rows of either side more
    than ``disorder`` behind the newest of their side in an earlier batch may be dropped.
    """
    one = sent.withWatermark(sent_at, disorder).alias("s")
    two = outcomes.withColumnRenamed(key, "__key").withWatermark(outcome_at, disorder).alias("o")
    deadline = F.col(sent_at) + F.expr(f"INTERVAL {within}")
    same = (F.col(f"s.{key}") == F.col("__key")) & (F.col(outcome_at) >= F.col(sent_at)) & (F.col(outcome_at) <= deadline)
    return one.join(two, same, "left_outer").drop("__key")


def keep_outcomes(path: str) -> Callable[[DataFrame, int], None]:
    """A batch function that stores what ``with_outcomes`` gave, a partition per batch, which a repeated batch overwrites."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        replace_partitions(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path, ["batch_id"])

    return handle


def outbox_state(outbox: DataFrame, results: DataFrame, key: str, outcome_at: str, error: str) -> DataFrame:
    """``outbox`` with status, published_at and last_error: PENDING while nothing is stored under ``results``.

    Of several outcomes of a message the first counts; a message that got none in time has FAILED.
    """
    # Copies of a key combine before they move, however many outcomes a message has.
    first = results.groupBy(key).agg(F.min(F.struct(F.col(outcome_at).isNull().alias("none"), outcome_at, error)).alias("first"))
    joined = outbox.join(first, key, "left")
    came, failed = F.col(f"first.{outcome_at}").isNotNull(), F.col(f"first.{error}").isNotNull()
    status = F.when(F.col("first").isNull(), "PENDING").when(came & ~failed, "PUBLISHED").otherwise("FAILED")
    reason = F.when(F.col("first").isNull() | (came & ~failed), None).when(came, F.col(f"first.{error}")).otherwise("no outcome in time")
    return joined.withColumns(
        {"status": status, "published_at": F.when(came & ~failed, F.col(f"first.{outcome_at}")), "last_error": reason}
    ).drop("first")
