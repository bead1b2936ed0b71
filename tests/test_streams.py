"""Stream jobs: several batches, repeated batches, dead letters, routes."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.payloads import JsonCodec
from millrace.session import scratch_path
from millrace.streaming import events as ev
from millrace.streaming.routing import EQUIPMENT_ROUTES, PLANNER_ROUTES, REJECTED, routed
from millrace.streaming.sinks import to_console, to_function, to_json_files
from millrace.streaming.sources import file_stream, json_rows, text_stream, ticks

GOOD = [
    '{"event_id":"a","customer_id":1,"event_type":"LIKE","product_id":5,"event_timestamp":"2024-01-02T03:04:05Z"}',
    '{"event_id":"b","customer_id":1,"event_type":"LIKE","product_id":-1,"event_timestamp":"soon"}',
    '{"event_id":"c","customer_id":2,"event_type":"CART_ADD","product_id":null,"event_timestamp":null}',
]
BAD = ["not json", '{"event_id":"d"}', '{"event_type":"LIKE"}', ""]


def messages(spark, texts):
    received = dt.datetime(2024, 1, 9)
    df = spark.createDataFrame([(t, received) for t in texts], "t string, received_at timestamp")
    return df.select(F.col("t").cast("binary").alias("value"), "received_at")


def archive(spark):
    root = scratch_path(spark, "archive")
    return ev.EventArchive(f"{root}/events", f"{root}/metrics", f"{root}/letters"), root


def test_decode_split_normalise(spark, rows):
    valid, malformed = ev.split_events(ev.decode(messages(spark, GOOD + BAD), JsonCodec(ev.CUSTOMER_EVENT)))
    assert malformed.count() == len(BAD)
    out = ev.normalise(valid, F.lit("2024-02-01").cast("timestamp"))
    got = rows(out, "event_id", "product_id", F.col("event_date").cast("string"))
    assert got == [("a", 5, "2024-01-02"), ("b", None, "2024-01-09"), ("c", None, "2024-01-09")]
    assert "value" not in out.columns


def test_repeated_batch_changes_nothing(spark):
    kept, _ = archive(spark)
    decoded = ev.decode(messages(spark, GOOD + BAD), JsonCodec(ev.CUSTOMER_EVENT))
    for batch_id in (0, 1, 1):
        kept.handle(decoded, batch_id)
    assert spark.read.parquet(kept.events_path).count() == 2 * len(GOOD)
    assert spark.read.parquet(kept.letters_path).count() == 2 * len(BAD)
    counts = spark.read.parquet(kept.metrics_path)
    metrics = {(r["batch_id"], r["metric"], r["key"]): r["value"] for r in ev.metrics(counts, per_batch=True).collect()}
    assert metrics[1, "rows", "rows"] == 3 and metrics[0, "events_per_type", "LIKE"] == 2
    assert not any(m == "top_products" and k is None for _, m, k in metrics)
    whole = {(r["metric"], r["key"]): r["value"] for r in ev.metrics(counts).collect()}
    assert whole["rows", "rows"] == 6 and whole["events_per_type", "LIKE"] == 4


def test_metrics_do_not_depend_on_the_number_of_batches(spark, rows):
    kinds = [(f"e{i}", i % 7, "LIKE" if i % 3 else "VIEW", i % 11) for i in range(60)]
    events = spark.createDataFrame(kinds, "event_id string, customer_id int, event_type string, product_id int")
    parts = [events.filter(f"customer_id % 3 = {b}") for b in range(3)]
    stored = parts[0].sparkSession.createDataFrame([], "metric string, key string, value bigint")
    for part in parts:
        stored = stored.unionByName(ev.event_counts(part))
    assert rows(ev.metrics(stored)) == rows(ev.metrics(ev.event_counts(events)))
    top = [r for r in rows(ev.metrics(stored)) if r[0] == "top_products"]
    # Five of eleven: the most frequent, ties by number and not by text.
    assert [t[1] for t in sorted(top, key=lambda t: int(t[1]))] == ["0", "1", "2", "3", "4"]


def test_timed_trigger_runs_batches_until_stopped(spark):
    kept, root = archive(spark)
    messages(spark, GOOD + BAD).write.parquet(f"{root}/in")
    stream = file_stream(spark, f"{root}/in", "value binary, received_at timestamp")
    running = kept.start(stream, JsonCodec(ev.CUSTOMER_EVENT), f"{root}/checkpoint", every="200 milliseconds")
    try:
        running.processAllAvailable()
        messages(spark, GOOD).write.mode("append").parquet(f"{root}/in")
        running.processAllAvailable()
        assert running.isActive
    finally:
        running.stop()
    assert spark.read.parquet(kept.events_path).count() == 2 * len(GOOD)


def test_empty_batch_writes_nothing(spark):
    from millrace.sinks.files import path_exists

    kept, _ = archive(spark)
    kept.handle(ev.decode(messages(spark, []), JsonCodec(ev.CUSTOMER_EVENT)), 0)
    assert not path_exists(spark, kept.events_path)


def test_archive_over_several_batches_and_a_restart(spark):
    kept, root = archive(spark)
    source = f"{root}/in"
    messages(spark, GOOD + BAD).repartition(4).write.parquet(source)
    stream = file_stream(spark, source, "value binary, received_at timestamp", files_per_batch=1)
    for _ in range(2):
        kept.start(stream, JsonCodec(ev.CUSTOMER_EVENT), f"{root}/checkpoint", every=None).awaitTermination()
    stored = spark.read.parquet(kept.events_path)
    assert stored.count() == len(GOOD) and stored.select("batch_id").distinct().count() >= 2
    messages(spark, GOOD).write.mode("append").parquet(source)
    kept.start(stream, JsonCodec(ev.CUSTOMER_EVENT), f"{root}/checkpoint", every=None).awaitTermination()
    assert spark.read.parquet(kept.events_path).count() == 2 * len(GOOD)


def test_failing_batch_fails_the_query(spark):
    import pytest

    def broken(batch, batch_id):
        raise RuntimeError("no space")

    root = scratch_path(spark, "broken")
    spark.range(3).write.parquet(f"{root}/in")
    query = to_function(file_stream(spark, f"{root}/in", "id bigint"), broken, f"{root}/checkpoint", every=None)
    with pytest.raises(Exception):
        query.awaitTermination()


def test_dead_letter_report(spark):
    letters = ev.dead_letters(messages(spark, [f"bad {i}" for i in range(9)]))
    report = ev.dead_letter_report(letters).collect()
    assert len(report) == 5 and {r["n_malformed"] for r in report} == {9}
    assert all("\n" not in r["sample"] and len(r["sample"]) <= 200 for r in report)


def test_long_payload_sample(spark):
    import base64

    raw = bytes(range(256)) * 4
    df = spark.createDataFrame([(bytearray(raw), dt.datetime(2024, 1, 1))], "value binary, received_at timestamp")
    assert ev.dead_letters(df).first()["sample"] == base64.b64encode(raw).decode()[:200]


def test_routes(spark):
    cases = [
        ("ALLOCATION:1", "{}", "allocation"), ("equipment", "{}", "inventory"), (None, '{"eventType":"damaged"}', "maintenance"),
        ("REMINDER", "[1]", REJECTED), ("other", "{}", REJECTED), (None, "junk", REJECTED),
    ]
    df = spark.createDataFrame(cases, "key string, value string, expected string")
    for row in routed(df, EQUIPMENT_ROUTES).collect():
        assert row["route"] == row["expected"]
    assert routed(df.limit(1), PLANNER_ROUTES).first()["route"] == REJECTED


def test_action_metrics(spark, rows):
    df = spark.createDataFrame([("u1", "click", 2.0), ("u1", "view", 3.0), ("u2", "click", 1.0)], ev.USER_EVENT)
    got = rows(ev.metrics(ev.action_counts(df), k=1))
    assert got == [("events_per_action", "click", 2.0), ("events_per_action", "view", 1.0), ("top_users", "u1", 5.0)]


def test_json_files_and_console(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"sno": 1, "name": "x", "city": "y"}\nbroken\n')
    people = json_rows(text_stream(spark, str(tmp_path / "in")), "sno int, name string, city string")
    to_json_files(people, str(tmp_path / "out"), str(tmp_path / "ck"), every=None).awaitTermination()
    got = spark.read.schema("sno int, name string, city string").json(str(tmp_path / "out"))
    assert got.count() == 2 and got.filter("sno = 1").count() == 1
    to_console(people, every=None).awaitTermination()


def test_ticks_run_a_function(spark):
    seen = []
    to_function(ticks(spark), lambda batch, i: seen.append(i), scratch_path(spark, "ck"), every=None, mode="update").awaitTermination()
    assert seen == [0]
