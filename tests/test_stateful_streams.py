"""State of streams over batches and restarts: repeated events, windows, outcomes, and the tables they update."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from millrace.catalog import stateful
from millrace.functions.payloads import JsonCodec
from millrace.session import scratch_path
from millrace.sinks.keyed import bucket_of, upsert_touched
from millrace.streaming import events as ev
from millrace.streaming import state
from millrace.streaming.sinks import to_function
from millrace.streaming.sources import file_stream

FOLDER = "/root/testdata/sf0.001"


def at(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def messages(spark, rows):
    texts = [
        (None if i is None else f'{{"event_id":"{i}","customer_id":1,"event_type":"LIKE","product_id":5}}', t) for i, t in rows
    ]
    df = spark.createDataFrame([(t or "broken", r) for t, r in texts], "t string, received_at timestamp")
    return df.select(F.col("t").cast("binary").alias("value"), "received_at")


@pytest.fixture()
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    state.keep_state_on_disk(spark)
    yield
    spark.conf.set(name, before)


def archive_runs(spark, runs, within="2 days", files_per_batch=1000):
    root = scratch_path(spark, "unique")
    archive = ev.EventArchive(f"{root}/events", f"{root}/metrics", f"{root}/letters")
    for rows in runs:
        messages(spark, rows).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = file_stream(spark, f"{root}/in", "value binary, received_at timestamp", files_per_batch)
        for query in archive.start_unique(stream, JsonCodec(ev.CUSTOMER_EVENT), f"{root}/checkpoint", within, every=None):
            query.awaitTermination()
    stored = spark.read.parquet(archive.events_path)
    letters = spark.read.parquet(archive.letters_path).count()
    return sorted(r["event_id"] for r in stored.collect()), letters


def test_repeats_in_a_batch_over_batches_and_restarts(spark, rocksdb):
    runs = [
        [("a", at(1)), ("a", at(1, 1)), (None, at(1)), ("b", at(1, 2))],
        [("a", at(2)), ("c", at(2)), (None, at(2)), (None, at(2))],
        [("c", at(2, 5)), ("b", at(2, 1)), ("d", at(3))],
    ]
    # Every broken message is kept, equal ones too.
    assert archive_runs(spark, runs) == (["a", "b", "c", "d"], 3)


def test_state_is_let_go_after_the_bound(spark):
    # The second delivery comes eight days after the first, whose state is gone by then.
    runs = [[("a", at(1)), (None, at(1))], [("b", at(9))], [("a", at(9, 1))], [("b", at(9, 2))]]
    assert archive_runs(spark, runs) == (["a", "a", "b"], 1)


def test_archive_of_single_files_equals_that_of_all(spark, rows):
    for files in (1, 1000):
        archive = stateful.archive_once(spark, FOLDER, files)
        stored = spark.read.parquet(archive.events_path)
        sent = spark.read.parquet(f"{FOLDER}/events.parquet").filter("event_type <> 'error'")
        assert rows(stored, "event_id") == rows(sent, F.col("event_id").cast("string"))
        assert stored.select("batch_id").distinct().count() >= 3


def test_windows_do_not_depend_on_the_files_of_a_batch(spark, rows):
    columns = [F.col("window_start").cast("string"), "metric", "key", "n", "total"]
    assert rows(stateful.window_counts(spark, FOLDER, 1), *columns) == rows(stateful.window_counts(spark, FOLDER), *columns)


def test_windows_repeat_harmlessly_and_touch_only_their_days(spark, rows):
    path = scratch_path(spark, "windows")
    kind = "window_start timestamp, metric string, key string, n bigint, total decimal(28,2)"
    first = spark.createDataFrame([(at(1), "m", "x", 3, None), (at(2), "m", "x", 1, None), (at(2), "m", None, 1, None)], kind)
    keep = state.keep_windows(path)
    keep(first, 0)
    files = lambda day: sorted(os.listdir(f"{path}/window_day=2024-01-0{day}"))
    before = files(1)
    second = spark.createDataFrame([(at(2), "m", "x", 5, None), (at(3), "m", "y", 1, None), (at(2), "m", None, 2, None)], kind)
    for batch in (1, 1):
        keep(second, batch)
    got = rows(spark.read.parquet(path), F.dayofmonth("window_start"), "key", "n")
    assert got == [(1, "x", 3), (2, "x", 5), (2, None, 2), (3, "y", 1)]
    assert files(1) == before


def test_late_rows_update_their_window_and_too_late_ones_are_dropped(spark, rows):
    root = scratch_path(spark, "late")
    kind = "at timestamp, kind string"
    for run in ([(at(1), "x"), (at(5), "x")], [(at(3), "x"), (at(5), "y")], [(at(1), "x")], [(at(9), "x")]):
        spark.createDataFrame(run, kind).coalesce(1).write.mode("append").parquet(f"{root}/in")
        counts = state.windowed_counts(file_stream(spark, f"{root}/in", kind), "at", {"kinds": F.col("kind")}, "1 day", "3 days")
        to_function(counts, state.keep_windows(f"{root}/out"), f"{root}/checkpoint", every=None, mode="update").awaitTermination()
    got = rows(spark.read.parquet(f"{root}/out"), F.dayofmonth("window_start"), "key", "n")
    assert got == [(1, "x", 1), (3, "x", 1), (5, "x", 1), (5, "y", 1), (9, "x", 1)]


def test_outcomes_come_in_time_or_have_failed(spark, rows):
    root = scratch_path(spark, "outcomes")
    sent_kind, outcome_kind = "id bigint, sent_at timestamp", "id bigint, outcome_at timestamp, error string"
    sent = [
        [(1, at(1, 8)), (2, at(1, 9)), (3, at(1, 9)), (4, at(1, 9))],
        [(5, at(1, 20))],
        [(6, at(2, 8))],
    ]
    outcomes = [
        [(1, at(1, 8, 30), None), (99, at(1, 9), None)],
        # Number 2 has its outcome after a restart, 3 a failure, 4 one that comes too late.
        [(2, at(1, 9, 50), None), (2, at(1, 9, 40), None), (3, at(1, 9, 10), "full"), (4, at(1, 10, 1), None), (5, at(1, 19), None)],
        [(98, at(2, 9), None)],
    ]
    plans = []
    for one, two in zip(sent, outcomes):
        spark.createDataFrame(one, sent_kind).write.mode("append").parquet(f"{root}/sent")
        spark.createDataFrame(two, outcome_kind).write.mode("append").parquet(f"{root}/outcomes")
        met = state.with_outcomes(
            file_stream(spark, f"{root}/sent", sent_kind),
            file_stream(spark, f"{root}/outcomes", outcome_kind),
            "id", "sent_at", "outcome_at", "60 MINUTES", "2 hours",
        )
        query = to_function(met, state.keep_outcomes(f"{root}/out"), f"{root}/checkpoint", every=None)
        query.awaitTermination()
        plans.append(query._jsq.explainInternal(False))
    assert all("StreamingSymmetricHashJoin" in p for p in plans)
    outbox = spark.createDataFrame([r for part in sent for r in part], sent_kind)
    done = state.outbox_state(outbox, spark.read.parquet(f"{root}/out"), "id", "outcome_at", "error")
    got = rows(done, "id", "status", F.date_format("published_at", "HH:mm"), "last_error")
    assert got == [
        (1, "PUBLISHED", "08:30", None),
        (2, "PUBLISHED", "09:40", None),
        (3, "FAILED", None, "full"),
        (4, "FAILED", None, "no outcome in time"),
        (5, "FAILED", None, "no outcome in time"),
        (6, "PENDING", None, None),
    ]


def test_outcomes_do_not_depend_on_the_files_of_a_batch(spark, rows):
    columns = ["event_id", "status", F.col("published_at").cast("string"), "last_error"]
    # One file at a time and side: the arrivals of this fixture are two weeks long, so both runs wait for all of a side.
    assert rows(stateful.outcomes_streamed(spark, FOLDER, 1000), *columns) == rows(stateful.outcomes_streamed(spark, FOLDER, 500), *columns)


def listed(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_upsert_rewrites_only_touched_buckets(spark, rows):
    path = scratch_path(spark, "bucketed")
    table = lambda data: spark.createDataFrame(data, "k bigint, v string, seen int")
    bucketed = lambda df: df.withColumn("bucket", bucket_of(["k"], 64))
    all_rows = table([(i, "old", 0) for i in range(2000)] + [(None, "old", 0)])
    assert upsert_touched(bucketed(all_rows), ["k"], path, "bucket") == 64
    before = listed(path)
    changes = bucketed(table([(i, "new", s) for i in range(5) for s in (1, 2)] + [(5000 + i, "new", 1) for i in range(4)] + [(None, "new", 1)]))
    for _ in range(2):
        touched = upsert_touched(changes, ["k"], path, "bucket", latest="seen")
        assert touched <= 10
    after = listed(path)
    assert len(set(before) & set(after)) == len(before) - touched
    assert all(before[f] == after[f] for f in set(before) & set(after))
    got = {r["k"]: (r["v"], r["seen"]) for r in spark.read.parquet(path).collect()}
    assert len(got) == 2005 and got[None] == ("new", 1) and got[3] == ("new", 2) and got[7] == ("old", 0) and got[5003] == ("new", 1)
    assert spark.read.parquet(path).count() == 2005
    assert upsert_touched(changes.limit(0), ["k"], path, "bucket") == 0


def test_closed_days_are_put_together_and_repeats_are_harmless(spark, rows):
    root = scratch_path(spark, "closed")
    archive = ev.EventArchive(f"{root}/events", f"{root}/metrics", f"{root}/letters")

    def batch(number, data):
        archive.handle(ev.decode(messages(spark, data), JsonCodec(ev.CUSTOMER_EVENT)), number)

    folders = lambda day: sorted(os.listdir(f"{root}/events/event_date=2024-01-0{day}"))
    ids = lambda: rows(archive.events(spark), "event_id")
    for number in range(4):
        batch(number, [(f"a{number}", at(1)), (f"b{number}", at(5))])
    want = ids()
    assert archive.compact(spark, "2024-01-03", 2) == 1 and ids() == want
    assert folders(1) == ["batch_id=-3", "batch_id=3"] and len(folders(5)) == 4
    # The last batch comes again, and a late event of the closed day; a folder that should have gone is still there.
    batch(3, [("a3", at(1)), ("b3", at(5))])
    batch(4, [("late", at(1))])
    spark.read.parquet(f"{root}/events/event_date=2024-01-01/batch_id=-3").write.parquet(f"{root}/events/event_date=2024-01-01/batch_id=1")
    assert ids() == sorted([*want, ("late",)])
    assert archive.compact(spark, "2024-01-03", 4) == 1 and archive.compact(spark, "2024-01-03", 4) == 0
    assert folders(1) == ["batch_id=-5"] and ids() == sorted([*want, ("late",)])
