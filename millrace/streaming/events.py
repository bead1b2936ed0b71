"""The event stream: decode, split off malformed messages, archive by day, count per batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.text import payload_sample
from millrace.operators.rows import split_rows
from millrace.plans.sales import cached
from millrace.session import settle
from millrace.sinks.files import delete_path, replace_partitions
from millrace.streaming.sinks import EVERY, to_function
from millrace.streaming.state import first_deliveries

CUSTOMER_EVENT = "event_id string, customer_id int, event_type string, product_id int, event_timestamp string"
USER_EVENT = "userId string, action string, value double"


def decode(messages: DataFrame, codec) -> DataFrame:
    """Payload fields as columns beside the raw value and the broker time."""
    return messages.select(codec.decode(F.col("value")).alias("e"), "value", "received_at").select(
        "e.*", "value", "received_at"
    )


def split_events(decoded: DataFrame, required: tuple[str, ...] = ("event_id", "event_type")) -> tuple[DataFrame, DataFrame]:
    """``(valid, malformed)``: every message is in exactly one of them."""
    present = F.lit(True)
    for name in required:
        present = present & F.col(name).isNotNull()
    return split_rows(decoded, present)


def normalise(valid: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Negative products become null, an unreadable time falls back to the broker's."""
    at = F.coalesce(F.try_to_timestamp("event_timestamp"), F.col("received_at").cast("timestamp"))
    return (
        valid.withColumn("product_id", F.when(F.col("product_id") >= 0, F.col("product_id")))
        .withColumn("event_timestamp", at)
        .withColumn("event_date", F.to_date("event_timestamp"))
        .withColumn("ingestion_timestamp", ingested_at if ingested_at is not None else F.current_timestamp())
        .drop("value", "received_at")
    )


def counted(events: DataFrame, keys: dict[str, Column], value: Column | None = None) -> DataFrame:
    """(metric, key, value): one sum per metric and key, all from one pass; null keys are left out.

    ``value`` is what a row adds, one by default; a metric's key may be a pair of key and own value.
    """
    one = value if value is not None else F.lit(1)
    pairs = [F.struct(F.lit(m).alias("metric"), k.cast("string").alias("key")) for m, k in keys.items()]
    rows = events.select(F.explode(F.filter(F.array(*pairs), lambda p: p["key"].isNotNull())).alias("p"), one.alias("one"))
    return rows.groupBy("p.metric", "p.key").agg(F.sum("one").alias("value"))


def event_counts(events: DataFrame) -> DataFrame:
    """Rows, events per type, per customer and per product, to be added up over batches."""
    return counted(
        events,
        {
            "rows": F.lit("rows"),
            "events_per_type": F.col("event_type"),
            "top_customers": F.col("customer_id"),
            "top_products": F.col("product_id"),
        },
    )


def action_counts(events: DataFrame) -> DataFrame:
    """Events per action and the sum of values per user, to be added up over batches."""
    actions = counted(events, {"events_per_action": F.col("action")})
    users = counted(events, {"top_users": F.col("userId")}, F.col("value"))
    return actions.withColumn("value", F.col("value").cast(users.schema["value"].dataType)).unionByName(users)


def metrics(counts: DataFrame, k: int = 5, per_batch: bool = False) -> DataFrame:
    """The counts of the whole table, or of each batch, with the ``k`` largest of each ``top_`` metric.

    Ties go to the smaller number, or to the smaller text where keys are no numbers. The ranking
    drops all but ``k`` rows of a metric in each task before they meet.
    """
    batch = ["batch_id"] if per_batch else []
    total = counts.groupBy(*batch, "metric", "key").agg(F.sum("value").alias("value"))
    listed = F.col("metric").startswith("top_")
    order = [F.col("value").desc(), F.col("key").try_cast("bigint"), F.col("key")]
    place = F.row_number().over(Window.partitionBy(*batch, "metric").orderBy(*order))
    best = total.filter(listed).withColumn("place", place).filter(F.col("place") <= k).drop("place")
    every = total.filter(~listed).unionByName(best)
    return every.withColumn("value", F.col("value").cast("double"))


def dead_letters(malformed: DataFrame, reason: str = "missing event_id or event_type") -> DataFrame:
    """The whole raw messages with a reason and a short base64 sample for reports."""
    return malformed.select("value", "received_at", F.lit(reason).alias("reason"), payload_sample(F.col("value")).alias("sample"))


def dead_letter_report(letters: DataFrame, samples: int = 5) -> DataFrame:
    """Samples of the stored dead letters beside their full count."""
    picked = letters.select("sample").orderBy("sample").limit(samples)
    return picked.withColumn("n_malformed", letters.agg(F.count("*")).scalar())


@dataclass
class EventArchive:
    """One query that writes events, counts and dead letters of each micro-batch.

    ``metrics`` makes the metrics of each batch, or of all of them, from the stored counts.

    The source is read once for all outputs. Each output has a partition per batch, which a
    repeated batch overwrites, so a restart neither loses nor doubles rows. The archive is laid
    out by day first and stays prunable by ``event_date``.
    """

    events_path: str
    metrics_path: str
    letters_path: str

    def handle(self, decoded: DataFrame, batch_id: int) -> None:
        with cached(decoded) as rows:
            if rows.isEmpty():
                return
            valid, malformed = split_events(rows)
            batch = F.lit(batch_id).cast("bigint")
            events = normalise(valid)
            replace_partitions(events.withColumn("batch_id", batch), self.events_path, ["event_date", "batch_id"])
            replace_partitions(event_counts(events).withColumn("batch_id", batch), self.metrics_path, ["batch_id"])
            replace_partitions(dead_letters(malformed).withColumn("batch_id", batch), self.letters_path, ["batch_id"])

    def events(self, spark: SparkSession) -> DataFrame:
        """The archived events. Where days have been put together, the batches that went into them do not count again."""
        stored = spark.read.parquet(self.events_path)
        # A day that holds the batches up to number n has the number -1 - n; only these numbers are read here.
        folded = stored.filter("batch_id < 0").groupBy("event_date").agg(F.min("batch_id").alias("__folded"))
        folded = folded.withColumnRenamed("event_date", "__day")
        met = stored.join(F.broadcast(folded), F.col("event_date").eqNullSafe(F.col("__day")), "left")
        counts = F.col("__folded").isNull() | (F.col("batch_id") == F.col("__folded")) | (F.col("batch_id") > -1 - F.col("__folded"))
        return met.filter(counts).drop("__day", "__folded")

    def compact(self, spark: SparkSession, before: str, upto: int) -> int:
        """Put the batches up to number ``upto`` of each day before ``before`` together, and drop their folders.

        A restart repeats only the last batch, so ``upto`` must lie below that. The day's new folder is written by dynamic overwrite
        and counts from then on; what breaks off between that and the end can be repeated. Late events of such a day come
        in folders of their own again, which the next call takes up. Returns the number of days.
        """
        stored = spark.read.parquet(self.events_path)
        old = (F.col("event_date") < F.lit(before).cast("date")) & (F.col("batch_id") <= upto)
        # One row per folder of the days that are due; folders' names alone are read.
        folders = stored.filter(old).select("event_date", "batch_id").distinct().collect()
        number, days = -1 - upto, {}
        for row in folders:
            days.setdefault(row["event_date"], set()).add(row["batch_id"])
        due = [d for d, batches in days.items() if batches - {number}]
        if not due:
            return 0
        rows = self.events(spark).filter(old & F.col("event_date").isin(due)).withColumn("batch_id", F.lit(number).cast("bigint"))
        replace_partitions(settle(rows, "days"), self.events_path, ["event_date", "batch_id"])
        for day in due:
            for batch in days[day] - {number}:
                delete_path(spark, f"{self.events_path}/event_date={day}/batch_id={batch}")
        return len(due)

    def start(self, messages: DataFrame, codec, checkpoint: str, every: str | None = EVERY) -> StreamingQuery:
        return to_function(decode(messages, codec), self.handle, checkpoint, every)

    def start_separately(
        self, messages: DataFrame, codec, checkpoint: str, every: str | None = EVERY
    ) -> tuple[StreamingQuery, StreamingQuery]:
        """The valid and the malformed side as two queries with a checkpoint each. The source is
        then read twice, but one side can be restarted without the other."""
        valid, malformed = split_events(decode(messages, codec))
        return self._start_sides(valid, malformed, checkpoint, every)

    def start_unique(
        self, messages: DataFrame, codec, checkpoint: str, within: str, every: str | None = EVERY
    ) -> tuple[StreamingQuery, StreamingQuery]:
        """As ``start_separately``, but an event that is delivered again up to ``within`` later is archived once, across
        batches and restarts. Dead letters have no id and are all kept, without state."""
        valid, malformed = split_events(decode(messages, codec))
        return self._start_sides(first_deliveries(valid, ["event_id"], "received_at", within), malformed, checkpoint, every)

    def _start_sides(
        self, valid: DataFrame, malformed: DataFrame, checkpoint: str, every: str | None
    ) -> tuple[StreamingQuery, StreamingQuery]:
        def keep(batch: DataFrame, batch_id: int) -> None:
            rows = normalise(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            replace_partitions(rows, self.events_path, ["event_date", "batch_id"])

        def bury(batch: DataFrame, batch_id: int) -> None:
            rows = dead_letters(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            replace_partitions(rows, self.letters_path, ["batch_id"])

        return (
            to_function(valid, keep, f"{checkpoint}/valid", every),
            to_function(malformed, bury, f"{checkpoint}/malformed", every),
        )
