"""Incremental jobs, profiles, summaries, generators and connector settings."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.plans import customer_profile, daily_summary as summary, serving, trips as trip_plan
from millrace.plans.incremental import IncrementalJob, OffsetTable, retry
from millrace.session import object_store_conf, scratch_path, settle
from millrace.sinks import external as out
from millrace.sources import external, generate

TXN = "txn_id bigint, customer_id bigint, product_id bigint, qty int, amount decimal(10,2), txn_timestamp timestamp_ntz"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


ROWS = [
    (1, 1, 10, 1, Decimal("5.00"), at(1)),
    (2, 1, 11, 2, Decimal("7.50"), at(1, 5)),
    (3, 2, 10, 1, Decimal("5.00"), at(1)),
    (4, 1, 99, 9, Decimal("1.00"), at(2)),
    (5, 3, None, 1, Decimal("3.00"), at(2)),
]


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([(10, "toys"), (11, "books"), (12, "arts")], "product_id bigint, category string")


@pytest.fixture(scope="module")
def people(spark):
    data = [(1, "Ann", "a@x.co", "f"), (2, "Bob", "b@x.co", "m"), (3, "Cy", "c@x.co", "m")]
    return spark.createDataFrame(data, "customer_id bigint, name string, email string, gender string")


@pytest.mark.parametrize("parts", [1, 7])
def test_daily_summary(spark, rows, products, parts):
    df = spark.createDataFrame(ROWS, TXN).repartition(parts)
    got = rows(summary.daily_summary(df, products))
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert got == [
        (d1, 1, Decimal("12.50"), 3, 2, "books"),
        (d1, 2, Decimal("5.00"), 1, 1, "toys"),
        (d2, 1, Decimal("1.00"), 9, 1, None),
    ]


@pytest.mark.parametrize("parts", [1, 7])
def test_profiles(spark, rows, products, people, parts):
    data = ROWS + [(1, 1, 10, 1, Decimal("5.00"), at(1)), (6, 2, 12, 1, Decimal("2.00"), at(3)), (7, 2, 12, 0, Decimal("2.00"), at(3))]
    clean = customer_profile.clean_transactions(spark.createDataFrame(data, TXN).repartition(parts))
    got = rows(customer_profile.customer_profiles(clean, people, products))
    assert got == [
        (1, "Ann", "a@x.co", "f", Decimal("12.50"), 2, Decimal("6.25"), at(1), at(1, 5), "books"),
        (2, "Bob", "b@x.co", "m", Decimal("7.00"), 2, Decimal("3.50"), at(1), at(3), "arts"),
    ]


def test_incremental_summary_repairs_late_days(spark, rows, products):
    path = scratch_path(spark, "lake")
    offsets = OffsetTable(spark, scratch_path(spark, "offsets"))
    known = {"rows": spark.createDataFrame(ROWS, TXN)}
    job = IncrementalJob(
        "t", lambda: known["rows"], offsets, lambda delta: summary.refresh_days(delta, known["rows"], products, path)
    )
    assert job.run_once() == 5 and offsets.read("t") == 5
    before = rows(spark.read.parquet(path).select("date", "customer_id", "total_items"))
    assert job.run_once() == 0
    # A late row for the first day arrives with a new id.
    late = ROWS + [(6, 2, 11, 4, Decimal("2.00"), at(1, 9))]
    known["rows"] = spark.createDataFrame(late, TXN)
    assert job.run_once() == 1 and offsets.read("t") == 6
    after = rows(spark.read.parquet(path).select("date", "customer_id", "total_items"))
    assert [r for r in after if r not in before] == [(dt.date(2024, 1, 1), 2, 5)]
    assert len(after) == len(before)


def test_offset_stays_when_processing_fails(spark):
    offsets = OffsetTable(spark, scratch_path(spark, "offsets"))

    def broken(delta):
        raise RuntimeError("sink is down")

    job = IncrementalJob("t", lambda: spark.createDataFrame(ROWS, TXN), offsets, broken)
    with pytest.raises(RuntimeError):
        job.run_once()
    assert offsets.read("t") == 0
    job.force_commit = True
    assert job.run_once() == 5 and offsets.read("t") == 5


def test_offsets_never_move_back(spark, rows):
    offsets = OffsetTable(spark, scratch_path(spark, "offsets"))
    for source, value in (("a", 10), ("b", 3), ("a", 50), ("a", 20)):
        offsets.advance(source, value)
    assert rows(offsets.all()) == [("a", 50), ("b", 3)]


def test_retry():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("again")

    retry(flaky, wait_seconds=0)
    assert len(calls) == 3
    with pytest.raises(ZeroDivisionError):
        retry(lambda: 1 / 0, attempts=2, wait_seconds=0)


def test_profile_refresh_twice_is_the_same(spark, rows, products, people):
    df, current = spark.createDataFrame(ROWS, TXN), None
    for delta in (df, df.filter("txn_id = 1"), df.filter("txn_id = 1")):
        target = scratch_path(spark, "profiles")
        customer_profile.refresh_profiles(delta, df, people, products, current, target)
        current = target
    expected = customer_profile.customer_profiles(customer_profile.clean_transactions(df), people, products)
    assert rows(spark.read.parquet(current).select(expected.columns)) == rows(expected)


def test_plan_keeps_partial_aggregates_and_pushes_the_range(spark, plan, products, tmp_path):
    spark.createDataFrame(ROWS, TXN).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    text = plan(summary.daily_summary(stored, products))
    assert "partial_sum" in text
    assert "PushedFilters: [IsNotNull(product_id)]" in text


def test_a_product_listed_twice_counts_once(spark, rows, products):
    df = spark.createDataFrame(ROWS, TXN)
    twice = products.unionByName(products.withColumn("category", F.lit("zz")))
    assert rows(summary.daily_summary(df, twice)) == rows(summary.daily_summary(df, products))


def test_generators_do_not_depend_on_partitions(spark, rows):
    for make in (generate.customers, generate.employees, generate.products, generate.store_sales, generate.sensors, generate.users, generate.students, generate.account_transactions):
        one, many = make(spark, 200, parts=1), make(spark, 200, parts=9)
        assert rows(one) == rows(many) and one.count() == 200


def test_generated_ranges(spark):
    got = generate.customers(spark, 2000).agg(F.min("age"), F.max("age"), F.countDistinct("city")).first()
    assert tuple(got) == (18, 70, 50)
    rides = generate.trips(spark, 500, "2024-06-01 00:00:00")
    timed = trip_plan.with_duration(trip_plan.clean_trips(rides))
    ends = timed.agg(F.count("*"), F.min("duration_minutes"), F.max("duration_minutes"), F.min("distance_km"), F.max("distance_km")).first()
    assert ends[0] == 500 and ends[1] >= 5 and ends[2] <= 54 and ends[3] >= 1 and ends[4] <= 16
    events = generate.customer_events(spark, 3000, "2024-06-01 00:00:00")
    missing = {r[0]: r[1] for r in events.filter("product_id is null").groupBy("event_type").count().collect()}
    assert "CART_ADD" not in missing and 40 < missing["LIKE"] < 180
    assert generate.user_events(spark, 50).select("action").distinct().count() == 5
    assert generate.log_records(spark, 99, F.lit("2024-01-01").cast("timestamp")).filter("level is null or service is null").count() == 0
    assert generate.log_lines(spark, 20, 1_700_000_000_000).filter(~F.col("value").rlike(r"^\d+\|(INFO|WARN|ERROR)\|\w{15}\|\d+$")).count() == 0
    assert generate.sales_records(spark, 100).filter("quantity < 1 or quantity > 10 or amount < 10 or amount >= 510").count() == 0
    assert generate.posts(spark, 50, 10).filter("userId < 1 or userId > 10").count() == 0
    assert generate.payments(spark, 50, 10).filter("customerId < 1 or customerId > 10").count() == 0


def test_partition_choice():
    assert external.choose_partitions(0, 0, 8) == 1
    assert external.choose_partitions(1, 500, 8) == 2
    assert external.choose_partitions(1, 45_000, 8) == 5
    assert external.choose_partitions(1, 10_000_000, 8) == 8
    assert external.choose_partitions(1, 10_000_000, 8, max_connections=3) == 3
    assert (customer_profile.write_tasks(1, 128), customer_profile.write_tasks(20, 128), customer_profile.write_tasks(900, 128)) == (8, 80, 128)


def test_jdbc_texts():
    assert external.delta_query("t", "id", 5, ["id", "v"]) == "SELECT id, v FROM t WHERE id > 5"
    assert external.members_query("t", "day", ["2024-01-01", "o'x"]).endswith("day IN ('2024-01-01', 'o''x')")
    assert external.probe_query("t", "id", 5).endswith("COUNT(*) AS n FROM t WHERE id > 5")
    assert external.range_options("id", 1, 9, 3) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "3"}
    assert external.jdbc_options("u", "d", 50)["fetchsize"] == "50"
    assert external.kafka_options("s", "t", "earliest")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        external.kafka_options("s", "t", "middle")


def test_best_effort_append_goes_on(spark):
    options = external.jdbc_options("jdbc:none:x", "no.such.Driver")
    assert out.append_jdbc(spark.range(1), options, "t", on_error="skip") is False
    with pytest.raises(Exception):
        out.append_jdbc(spark.range(1), options, "t")
    with pytest.raises(ValueError):
        out.append_jdbc(spark.range(1), options, "t", on_error="maybe")


def test_kafka_rows(spark):
    df = out.kafka_rows(spark.range(1), F.col("id").cast("string"), F.lit("{}"))
    assert df.schema.simpleString() == "struct<key:binary,value:binary>"


def test_object_store_settings():
    conf = object_store_conf("https://store.example.com", "eu", "some.Provider")
    assert conf["spark.hadoop.fs.s3a.endpoint.region"] == "eu" and not any("secret" in k for k in conf)


def test_settled_tables_are_read_back(spark):
    df = settle(spark.range(10).withColumn("r", F.rand()))
    assert df.collect() == df.collect()


def test_served_limits(spark):
    events = spark.createDataFrame([], "event_id string, customer_id int, event_timestamp timestamp, event_date date")
    with pytest.raises(ValueError):
        serving.customer_events(events, 1, "2024-01-01", "2024-01-02", 501)


def test_scratch_needs_a_shared_folder_on_a_cluster(tmp_path):
    from types import SimpleNamespace

    from millrace.session import scratch_root

    def session(master, folder):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: folder),
            sparkContext=SimpleNamespace(master=master, applicationId=str(tmp_path)),
        )

    assert scratch_root(session("spark://host:7077", "hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        scratch_root(session("spark://host:7077", None))
    local = scratch_root(session("local[2]", None))
    assert local.startswith("/tmp/run-") and local == scratch_root(session("local[2]", None))


def test_missing_connectors_say_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        external.read_kafka_stream(spark, "host:9092", "t")
    with pytest.raises(Exception, match="(?i)cassandra"):
        external.read_wide_column(spark, "k", "t")
    with pytest.raises(Exception, match="no.such.Driver"):
        external.read_table(spark, external.jdbc_options("jdbc:none:x", "no.such.Driver"), "t")


def test_iso_dates(spark):
    from millrace.functions.times import is_iso_date, shown_in_zone

    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("2024",), ("2024-1-1",)], "t string")
    assert [r[0] for r in df.select(is_iso_date(F.col("t"))).collect()] == [True, False, False, False]
    shown = spark.range(1).select(shown_in_zone(F.lit("2024-01-01 00:00:00").cast("timestamp")), shown_in_zone(F.lit(None).cast("timestamp")))
    assert tuple(shown.first()) == ("2024-01-01 05:30:00 IST", "N/A")


def test_profile_refresh_reads_its_delta_once(spark, products, people):
    seen = spark.sparkContext.accumulator(0)

    def count(n):
        seen.add(1)
        return n

    df = spark.createDataFrame(ROWS, TXN)
    counted = F.udf(count, "bigint").asNondeterministic()
    delta = df.withColumn("customer_id", counted("customer_id"))
    customer_profile.refresh_profiles(delta, df, people, products, None, scratch_path(spark, "profiles"))
    assert seen.value == len(ROWS)


def test_category_totals_move_rows_once(spark, plan, products):
    text = plan(customer_profile.category_totals(spark.createDataFrame(ROWS, TXN), products))
    moved = [line for line in text.splitlines() if "Arguments: hashpartitioning(customer_id" in line]
    assert len(moved) == 1 and "category" in moved[0] and "partial_sum" in text


def test_ranked_groups_of_a_day_are_spread_over_all_tasks(spark, plan, products):
    text = plan(summary.daily_summary(spark.createDataFrame(ROWS, TXN), products))
    assert any("hashpartitioning(date" in line and "REPARTITION_BY_NUM" in line for line in text.splitlines())
