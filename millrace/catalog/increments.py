"""Jobs whose work follows the change: late ids, merged totals and bitmaps, upserts in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import frames
from millrace.catalog.frames import at, table
from millrace.catalog.jobs import EVENT_SUMMARY, PROFILE, shown_profile, shown_summary
from millrace.catalog.registry import query
from millrace.plans.daily_summary import refresh_days
from millrace.plans.distincts import bitmaps, distinct_counts
from millrace.plans.processed import CompleteJob, ProcessedIds
from millrace.plans.profile_states import ProfileStates
from millrace.session import scratch_path, settle
from millrace.sinks.files import write_lake
from millrace.sinks.keyed import bucket_of, upsert_touched


@query(EVENT_SUMMARY)
def daily_summary_with_late_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seventh of the early ids appears only after larger ones were committed, another seventh in a third run; the lake
    must end as if all had come in order."""
    rows, products = frames.event_transactions(spark, sf_dir), frames.products(spark, sf_dir)
    lake, done = scratch_path(spark, "late"), ProcessedIds(spark, scratch_path(spark, "processed"))
    half = rows.agg((F.max("txn_id") / 2).cast("bigint").alias("half")).first()["half"]
    early = rows.filter((F.col("txn_id") <= half) & (F.col("txn_id") % 7 > 1))
    most = rows.filter((F.col("txn_id") > half) | (F.col("txn_id") % 7 > 0))
    for known in (early, most, rows, rows):
        job = CompleteJob(
            source="transactions",
            rows=lambda known=known: known,
            done=done,
            # Days are made from all rows that are known, so a repeated batch is harmless.
            process=lambda delta, known=known: refresh_days(delta, known, products, lake),
        )
        job.run_once()
    return shown_summary(spark.read.parquet(lake))


@query(PROFILE)
def profiles_from_merged_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles after three batches, one of them repeated, folded together in between; no batch reads an earlier one's rows."""
    # Joined once; each batch reads its own span of them.
    rows, products = settle(frames.transactions(spark, sf_dir), "transactions", "zstd"), frames.products(spark, sf_dir)
    people, moment = frames.customers(spark, sf_dir), F.col("txn_timestamp")
    states = ProfileStates(spark, scratch_path(spark, "totals"), scratch_path(spark, "profiles"), buckets=8)
    first, second = at("1997-06-01 00:00:00"), at("1999-06-01 00:00:00")
    parts = [rows.filter(moment < first), rows.filter((moment >= first) & (moment < second)), rows.filter(moment >= second)]
    for batch_id, part in ((0, parts[0]), (1, parts[1]), (1, parts[1])):
        states.add(part, products, people, batch_id)
    states.compact()
    # Batch 1 comes once more, after it was folded in.
    for batch_id, part in ((1, parts[1]), (2, parts[2])):
        states.add(part, products, people, batch_id)
    return shown_profile(states.profiles())


SPANS = (("2024-01-01", "2024-01-07"), ("2024-01-05", "2024-01-25"), ("2024-01-20", "2024-01-20"), ("2024-01-01", "2024-12-31"))


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{first}' AS first_day, '{last}' AS last_day, customer_id, count(DISTINCT product_id) AS n_products "
        f"FROM ({frames.EVENT_TRANSACTIONS}) WHERE CAST(txn_timestamp AS DATE) BETWEEN '{first}' AND '{last}' GROUP BY customer_id"
        for first, last in SPANS
    )
    + ")"
)
def distinct_products_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct products per customer over several spans of days, all from one stored bitmap per day and customer."""
    path = scratch_path(spark, "bitmaps")
    rows = frames.event_transactions(spark, sf_dir).withColumn("day", F.to_date("txn_timestamp"))
    write_lake(bitmaps(rows, ["day", "customer_id"], "product_id"), path, ["day"])
    stored, out = spark.read.parquet(path), None
    for first, last in SPANS:
        counts = distinct_counts(stored.filter(F.col("day").between(first, last)), ["customer_id"], "n_products")
        part = counts.select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"), "customer_id", "n_products")
        out = part if out is None else out.unionByName(part)
    return out


@query("""
SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' AND c_custkey % 50 = 0 THEN 0.0 ELSE c_acctbal END AS balance FROM customer
UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal FROM supplier""")
def keyed_upserts_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, then changed balances of a few, then new keys, the latter twice; each upsert rewrites its buckets alone."""
    path = scratch_path(spark, "buckets")

    def put(rows: DataFrame) -> None:
        upsert_touched(rows.withColumn("bucket", bucket_of(["c_custkey"])), ["c_custkey"], path, "bucket")

    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_acctbal").alias("balance"), "c_mktsegment")
    put(people.drop("c_mktsegment"))
    changed = people.filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_custkey") % 50 == 0))
    put(changed.withColumn("balance", F.lit(0.0)).drop("c_mktsegment"))
    added = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("balance")
    )
    for rows in (added, added.unionByName(added)):
        put(rows)
    return spark.read.parquet(path).drop("bucket")
