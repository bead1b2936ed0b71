"""Sinks, output metrics and physical controls: written from the supplied tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.catalog.frames import table
from millrace.catalog.registry import big, day, query, sql_day
from millrace.operators import control
from millrace.operators.skew import salted_join
from millrace.plans.formats import compare_formats, read_back, round_trips
from millrace.plans.sales import cached
from millrace.session import scratch_path, settle
from millrace.sinks import files
from millrace.sinks.keyed import upsert
from millrace.streaming.sinks import to_function


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


ORDER_ROWS = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"
ORDER_SCHEMA = "o_orderkey bigint, o_orderstatus string, o_totalprice double"


@query(ORDER_ROWS)
def parquet_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    for codec in ("gzip", "snappy"):
        files.write_parquet(order_rows(spark, sf_dir), path, codec)
    return spark.read.parquet(path)


@query(ORDER_ROWS)
def csv_written_with_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    files.write_csv(order_rows(spark, sf_dir), path, header=True)
    return read_back(spark, "csv", path, ORDER_SCHEMA)


@query(ORDER_ROWS)
def csv_written_without_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    files.write_csv(order_rows(spark, sf_dir), path, header=False)
    return spark.read.schema(ORDER_SCHEMA).csv(path)


@query(ORDER_ROWS)
def json_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    files.write_json(order_rows(spark, sf_dir), path)
    return read_back(spark, "json", path, ORDER_SCHEMA)


@query("SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_totalprice > 300000) AS n_high FROM orders")
def counts_of_a_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted while the rows are written, without another pass."""
    seen = files.write_observed(order_rows(spark, sf_dir), scratch_path(spark, "observed"), n_high=F.col("o_totalprice") > 300_000)
    return spark.createDataFrame([(seen["n_rows"], seen["n_high"])], "n_rows bigint, n_high bigint")


@query("SELECT o_orderkey || '|' || o_orderstatus AS value FROM orders")
def text_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "text")
    files.write_text(order_rows(spark, sf_dir).drop("o_totalprice"), path, "|")
    return spark.read.text(path)


EVENT_DAYS = f"SELECT {sql_day('ts')} AS day, event_type, count(*) AS n FROM events GROUP BY ALL"


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.to_date("ts").alias("event_date"))


def per_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy(day("event_date").alias("day"), "event_type").agg(F.count("*").alias("n"))


@query(EVENT_DAYS)
def lake_partitioned_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lake")
    files.write_lake(event_rows(spark, sf_dir), path, ["event_date"])
    return per_day(spark.read.parquet(path))


@query(f"""
SELECT {sql_day('ts')} AS day, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 'rewritten' ELSE event_type END AS event_type, count(*) AS n
FROM events GROUP BY ALL""")
def only_touched_days_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = scratch_path(spark, "lake"), event_rows(spark, sf_dir)
    files.replace_partitions(rows, path, ["event_date"])
    late = rows.filter(F.col("event_date") >= F.lit("2024-01-20").cast("date"))
    files.replace_partitions(late.withColumn("event_type", F.lit("rewritten")), path, ["event_date"])
    return per_day(spark.read.parquet(path))


@query(EVENT_DAYS)
def lake_appended_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.catalog.streams import event_stream

    root = scratch_path(spark, "append")
    rows = event_stream(spark, sf_dir).select("event_id", "event_type", F.to_date("ts").alias("event_date"))

    def append(batch: DataFrame, _batch_id: int) -> None:
        files.write_lake(batch, f"{root}/lake", ["event_date"], mode="append")

    to_function(rows, append, f"{root}/checkpoint", every=None).awaitTermination()
    return per_day(spark.read.parquet(f"{root}/lake"))


@query("SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1")
def report_as_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"))
    path = files.write_report(counts, scratch_path(spark, "report"), "segments.csv")
    return spark.read.schema("segment string, n bigint").option("header", True).csv(path)


@query("""
SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0 ELSE c_acctbal END AS balance FROM customer
UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal FROM supplier""")
def keyed_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, then changed balances of one segment, then new keys, the latter twice."""
    versions = [scratch_path(spark, "keyed") for _ in range(4)]
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_acctbal").alias("balance"), "c_mktsegment")
    upsert(people.drop("c_mktsegment"), ["c_custkey"], None, versions[0])
    changed = people.filter(F.col("c_mktsegment") == "BUILDING").withColumn("balance", F.lit(0.0)).drop("c_mktsegment")
    upsert(changed, ["c_custkey"], versions[0], versions[1])
    added = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("balance")
    )
    upsert(added, ["c_custkey"], versions[1], versions[2])
    upsert(added.unionByName(added), ["c_custkey"], versions[2], versions[3])
    return spark.read.parquet(versions[3])


@query("SELECT count(DISTINCT CAST(ts AS DATE)) AS partitions, true AS has_bytes, true AS few_files FROM events")
def written_output_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lake")
    files.write_lake(event_rows(spark, sf_dir), path, ["event_date"])
    found = files.output_metrics(spark, path)
    few = F.col("files") <= 2 * F.col("partitions")
    return found.select("partitions", (F.col("bytes") > 0).alias("has_bytes"), few.alias("few_files"))


@query("SELECT DISTINCT 'event_type=' || event_type AS folder, true AS has_files FROM events")
def files_in_each_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lake")
    files.write_lake(event_rows(spark, sf_dir), path, ["event_type"])
    return files.files_per_partition(spark, path).select("folder", (F.col("files") > 0).alias("has_files"))


@query("SELECT false AS before_write, true AS after_write, true AS removed, false AS after_removal, count(*) AS n FROM customer")
def target_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = scratch_path(spark, "target"), table(spark, sf_dir, "customer")
    before = files.path_exists(spark, path)
    files.write_text(rows.select("c_name"), path)
    after, removed = files.path_exists(spark, path), files.delete_path(spark, path)
    gone = files.path_exists(spark, path)
    return rows.agg(F.count("*").alias("n")).select(
        F.lit(before).alias("before_write"), F.lit(after).alias("after_write"), F.lit(removed).alias("removed"),
        F.lit(gone).alias("after_removal"), "n",
    )


@query(f"""
SELECT format, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS orders, CAST(sum(l_partkey) AS BIGINT) AS parts,
       CAST(sum(l_suppkey) AS BIGINT) AS suppliers, CAST(sum(l_linenumber) AS BIGINT) AS numbers,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
       CAST(sum(CAST(l_discount + l_tax AS DECIMAL(18,2))) AS DOUBLE) AS rates,
       count(DISTINCT l_returnflag || l_linestatus) AS flags, {sql_day('min(l_shipdate)')} AS first_day, {sql_day('max(l_shipdate)')} AS last_day
FROM lineitem, (SELECT unnest(['csv', 'json', 'parquet', 'text']) AS format) GROUP BY format""")
def storage_format_round_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = lambda c: F.sum(c.cast("decimal(18,2)")).cast("double")
    measures = [
        F.count("*").alias("n"),
        *(F.sum(f"l_{c}").cast("bigint").alias(name) for c, name in (("orderkey", "orders"), ("partkey", "parts"), ("suppkey", "suppliers"), ("linenumber", "numbers"))),
        cents(F.col("l_quantity")).alias("quantity"),
        cents(F.col("l_extendedprice")).alias("price"),
        cents(F.col("l_discount") + F.col("l_tax")).alias("rates"),
        F.count_distinct(F.concat("l_returnflag", "l_linestatus")).alias("flags"),
        day(F.min("l_shipdate")).alias("first_day"),
        day(F.max("l_shipdate")).alias("last_day"),
    ]
    return round_trips(table(spark, sf_dir, "lineitem"), scratch_path(spark, "formats"), measures, codec="snappy")


@query("""
SELECT format, CAST(place AS BIGINT) AS place, (SELECT count(*) FROM lineitem) AS n
FROM (VALUES ('parquet', 1), ('csv', 2), ('json', 3)) AS t(format, place)""")
def storage_format_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats by the bytes they take under one codec, smallest first; the times of the comparison differ by run."""
    rows, path = table(spark, sf_dir, "lineitem"), scratch_path(spark, "formats")
    costs = compare_formats(spark, rows, path, ("csv", "json", "parquet"), codec="snappy")
    place = F.row_number().over(Window.orderBy("bytes")).cast("bigint")
    return costs.select("format", place.alias("place"), F.col("n_rows").alias("n"))


@query("""
SELECT event_type, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1
UNION ALL SELECT 'users', count(DISTINCT user_id) FROM events WHERE event_type = 'error'""")
def cached_filter_used_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    with cached(errors, materialise=True) as kept:
        # Both results are taken and stored while the rows are cached.
        rows = kept.groupBy("event_type").agg(F.count("*").alias("n"))
        users = kept.agg(F.lit("users").alias("event_type"), F.countDistinct("user_id").alias("n"))
        return settle(rows.unionByName(users), "errors")


@query("SELECT 6 AS partitions, count(*) AS n FROM lineitem")
def repartition_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = control.by_key(table(spark, sf_dir, "lineitem").select("l_orderkey"), "l_orderkey", partitions=6)
    rows = control.partition_rows(spread)
    return rows.agg(F.count("*").cast("int").alias("partitions"), F.sum("n_rows").alias("n"))


@query("""
SELECT table_name AS name, count(*) AS n_columns, string_agg(column_name, ',' ORDER BY ordinal_position) AS columns, 3 AS partitions
FROM information_schema.columns WHERE table_name IN ('nation', 'orders', 'lineitem') GROUP BY 1""")
def tables_inspected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a look at the schema text and at the partitions of three tables shows."""
    keys = {"nation": "n_nationkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}
    seen = []
    for name, key in keys.items():
        rows = control.by_key(table(spark, sf_dir, name), key, partitions=3)
        fields = [f.split(":")[0] for f in control.schema_text(rows).removeprefix("struct<").removesuffix(">").split(",")]
        seen.append((name, len(fields), ",".join(fields), control.partition_count(rows)))
    return spark.createDataFrame(seen, "name string, n_columns bigint, columns string, partitions int")


@query("SELECT 2 AS partitions, count(*) AS n FROM lineitem")
def coalesce_to_fewer(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = control.by_key(table(spark, sf_dir, "lineitem").select("l_orderkey"), "l_orderkey", partitions=8)
    rows = control.partition_rows(control.fewer_files(spread, present=8))
    return rows.agg(F.count("*").cast("int").alias("partitions"), F.sum("n_rows").alias("n"))


@query("""
SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, min(ts)::VARCHAR <> '' AS seen FROM events GROUP BY user_id""")
def batches_through_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial sums per Arrow batch in Python, finished by a grouped sum on the JVM."""
    import pandas as pd

    def partial(batches):
        for batch in batches:
            cents = (batch["value"] * 100).round().astype("int64")
            sums = cents.groupby(batch["user_id"]).sum()
            yield pd.DataFrame({"user_id": sums.index.astype("int64"), "cents": sums.to_numpy()})

    sums = table(spark, sf_dir, "events").select("user_id", "value").mapInPandas(partial, "user_id bigint, cents bigint")
    return sums.groupBy("user_id").agg((F.sum("cents") / 100).alias("total"), F.lit(True).alias("seen"))


@query("""
SELECT flag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity
FROM (SELECT CASE WHEN l_returnflag = 'A' THEN 1 ELSE l_partkey + 2 END AS k, l_returnflag AS flag, l_quantity FROM lineitem)
JOIN (SELECT p_partkey + 2 AS k FROM part UNION ALL SELECT 1) USING (k) GROUP BY flag""")
def join_with_one_heavy_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows share one key, which the caller names; the join spreads it over salts."""
    flag = F.col("l_returnflag")
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(flag == "A", F.lit(1).cast("bigint")).otherwise(F.col("l_partkey") + 2).alias("k"), flag.alias("flag"), "l_quantity"
    )
    keys = table(spark, sf_dir, "part").select((F.col("p_partkey") + 2).alias("k"))
    keys = keys.unionByName(spark.range(1, 2).withColumnRenamed("id", "k"))
    joined = salted_join(lines, keys, ["k"], hot=[1])
    return joined.groupBy("flag").agg(F.count("*").alias("n"), big(F.sum("l_quantity")).alias("quantity"))
