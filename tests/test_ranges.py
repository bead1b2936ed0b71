"""Laid-out tables, heavy keys that are found, runtime filters, interval and nearest joins, folded logs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.catalog import ranges as queries
from millrace.operators import intervals
from millrace.operators.control import runtime_filters
from millrace.operators.layout import join_laid_out, lay_out
from millrace.operators.aggregates import keep_first, keep_latest
from millrace.operators.skew import balanced_join, heavy_keys, join_on, key_hash, piece_of
from millrace.plans import equipment
from millrace.plans.eventlog import ITEM_EVENTS, ITEM_STATES, fold_log, states_after
from millrace.session import settle

FOLDER = "/root/testdata/sf0.001"


def test_laid_out_tables_join_without_an_exchange(spark, plan, rows):
    joined = queries.laid_out_join(spark, FOLDER)
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert "Exchange" not in plan(joined.groupBy("order_id").count())
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "k bigint, v string")
    right = spark.createDataFrame([(2, "x"), (3, "y"), (None, "z")], "k bigint, w string")
    for how in ("inner", "left", "full", "left_anti"):
        got = join_laid_out(lay_out(left, ["k"], 3), lay_out(right, ["k"], 3), ["k"], how)
        assert rows(got) == rows(left.join(right, "k", how))


@pytest.fixture()
def fixed_tasks(spark):
    """Shuffles of sixteen tasks that nothing puts together or splits afterwards."""
    names = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def rows_per_task(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]


def test_a_key_with_half_of_the_rows_stays_even(spark, fixed_tasks):
    facts = settle(spark.range(64_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("k"), "id"), "facts")
    other = settle(spark.range(64_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")), "other")
    plainly = rows_per_task(join_on(facts, other, ["k"]))
    assert max(plainly) > 5 * sum(plainly) / 16
    joined = balanced_join(facts, other, ["k"])
    spread = rows_per_task(joined)
    assert sum(spread) == 64_000 and max(spread) < 2 * sum(spread) / 16
    assert joined.filter("w <> 2 * k").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_balanced_join_equals_a_join(spark, rows, how):
    rnd = random.Random(3)
    data = [(rnd.choice([None, 1, 1, 1, 2, 2, rnd.randint(3, 40)]), rnd.choice([0.0, -0.0, 2.5]), i) for i in range(400)]
    facts = spark.createDataFrame(data, "k int, d double, i int").repartition(5)
    other = spark.createDataFrame([(None, 0.0, "n"), *((k, d, f"{k}") for k in range(1, 30) for d in (0.0, 2.5)), (1, 0.0, "again")], "k bigint, d double, w string")
    for on in (["k"], ["k", "d"]):
        right = other if len(on) == 2 else other.drop("d")
        left = facts if len(on) == 2 else facts.drop("d")
        got, want = balanced_join(left, right, on, how, partitions=20), join_on(left, right, on, how)
        assert got.columns == want.columns
        assert rows(got) == rows(want) and got.count() > 0
    with pytest.raises(ValueError):
        balanced_join(facts, other.withColumn("k", F.col("k").cast("string")), ["k"])


def test_heavy_keys_are_found_with_their_shares(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 10 < 4, 1).when(F.col("id") % 10 < 6, 2).otherwise(F.col("id")).alias("k"))
    found = heavy_keys(df, F.col("k").cast("bigint"), 8)
    assert set(found) == {1, 2} and found[1] == pytest.approx(0.4, abs=0.01) and found[2] == pytest.approx(0.2, abs=0.01)
    assert heavy_keys(df.limit(0), F.col("k").cast("bigint"), 8) == {}


def test_a_runtime_filter_reaches_the_scan(spark, plan, rows):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    usual = spark.conf.get(name)
    try:
        with runtime_filters(spark, fact_bytes="1KB"):
            df = queries.affected_lines(spark, FOLDER)
            assert "might_contain" in plan(df) and "bloom_filter_agg" in plan(df)
            got = rows(df)
        assert spark.conf.get(name) == usual
        plainly = queries.affected_lines(spark, FOLDER)
        assert "might_contain" not in plan(plainly) and got == rows(plainly) and len(got) > 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_overlaps_by_brute_force(spark, plan, rows):
    rnd = random.Random(4)

    def spells(n, seed):
        out = [(i, a := rnd.randint(-50, 400), a + rnd.randint(-2, 60)) for i in range(n)]
        return [*out, (n, None, 5), (n + 1, 3, None)]

    one, two = spells(80, 1), spells(60, 2)
    left = spark.createDataFrame(one, "i int, a int, b int")
    right = spark.createDataFrame(two, "j int, c int, d int")
    want = sorted(
        (i, j) for i, a, b in one for j, c, d in two if None not in (a, b, c, d) and a <= b and c <= d and a <= d and c <= b
    )
    want = sorted(want, key=repr)
    for width in (7, 30, 1000):
        got = intervals.overlaps(left, right, ("a", "b"), ("c", "d"), width)
        assert rows(got, "i", "j") == want
        assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


@pytest.mark.parametrize("k", [1, 4])
def test_next_and_nearest_by_brute_force(spark, plan, rows, k):
    rnd = random.Random(k)
    one = [(i, rnd.choice([None, rnd.randint(0, 40), rnd.randint(0, 400)])) for i in range(120)]
    # One value holds a third of the right side.
    two = [(i, rnd.choice([30, rnd.randint(0, 300), rnd.randint(100, 120)])) for i in range(150)] + [(500, None)]
    left, right = spark.createDataFrame(one, "i int, x int").repartition(4), spark.createDataFrame(two, "j int, y int").repartition(3)
    for down in (False, True):
        want = []
        for i, x in one:
            side = [(y, j) for j, y in two if x is not None and y is not None and (y <= x if down else y >= x)]
            want += [(i, j, n + 1) for n, (_, j) in enumerate(sorted(side, key=lambda t: (-t[0] if down else t[0], t[1]))[:k])]
        got = intervals.next_values(left, right, "x", "y", ["j"], k, down)
        assert rows(got, "i", "j", "__nth") == sorted(want, key=repr)
    near = []
    for i, x in one:
        best = sorted((abs(x - y), y, j) for j, y in two if y is not None) if x is not None else []
        near += [(i, j, d, n + 1) for n, (d, _, j) in enumerate(best[:k])]
    found = intervals.nearest(left, right, "i", "x", "y", ["j"], k)
    assert rows(found, "i", "j", "distance", "place") == sorted(near, key=repr)
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    assert intervals.nearest(left, right.limit(0), "i", "x", "y", ["j"], k).count() == 0
    assert intervals.nearest(left.limit(0), right, "i", "x", "y", ["j"], k).count() == 0


def simulated(items, log):
    out = {}
    for key, state in items:
        accepted = refused = 0
        ref = None
        for _, _, action, r in sorted(e[1:] for e in log if e[0] == key):
            to = ITEM_EVENTS.get(action, {}).get(state)
            accepted, refused = accepted + (to is not None), refused + (to is None)
            state, ref = (to, r) if to else (state, ref)
        out[key] = (state, accepted, refused, ref)
    return out


@pytest.mark.parametrize("part_events,ranges", [(1, 1), (3, 5), (7, 16), (10_000, 2)])
def test_folded_states_by_simulation(spark, part_events, ranges):
    rnd = random.Random(9)
    actions = [*ITEM_EVENTS, "ALLOCATED", "RETURNED", "LOST"]
    # Entity 0 has half of all events; some events are equal in time.
    log = [(0 if i % 2 else rnd.randint(1, 30), dt.datetime(2024, 1, 1 + rnd.randint(0, 20)), rnd.randint(0, 3), rnd.choice(actions), i) for i in range(900)]
    log = [e for e in log if e[3] != "RETIRED" or e[0] % 3]
    log.append((None, dt.datetime(2024, 1, 1), 0, "ALLOCATED", 1))
    items = [(i, rnd.choice(ITEM_STATES)) for i in range(25)] + [(99, "AVAILABLE"), (28, "BROKEN")]
    table = spark.createDataFrame(log, "k int, at timestamp, seq int, action string, ref bigint").repartition(3)
    entities = spark.createDataFrame(items, "k int, status string")
    done = states_after(entities, table, "k", ["at", "seq"], part_events=part_events, ranges=ranges)
    got = {r["k"]: (r["status"], r["accepted"], r["refused"], r["last_ref"]) for r in done.collect()}
    order = [(k, at, seq, action, ref) for k, at, seq, action, ref in log]
    assert got == simulated(items, order)


def test_the_fold_moves_the_rows_once(spark, plan):
    log = spark.read.parquet(f"{FOLDER}/orders.parquet").select(
        F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("at"), F.lit("ALLOCATED").alias("action"), F.col("o_orderkey").alias("ref")
    )
    text = plan(fold_log(log, "k", ["at"]))
    main = text[: text.index("(1)")]
    # The rows by range, then one small row per key and range.
    assert main.count("Exchange\n") + main.count("Exchange (") <= 3 and "hashpartitioning(__range" in text


def test_the_fold_equals_the_steps_one_after_the_other(spark, rows):
    items = [(i, "AVAILABLE", "GOOD", False) for i in range(1, 7)]
    table = spark.createDataFrame(items, "equipment_id bigint, status string, condition string, is_deleted boolean")
    kind = "request_id bigint, equipment_id bigint, employee_id bigint, allocated_by_employee_id bigint, purpose string, expected_return_at timestamp"
    held = None
    log = []
    for day, (wanted, returned) in enumerate([([(1, 1), (2, 2), (3, 1)], []), ([(4, 1), (5, 3)], [(1, "DAMAGED")]), ([(6, 1), (7, 4)], [(2, "GOOD"), (5, "GOOD")])]):
        at = dt.datetime(2024, 1, 1 + day)
        now = F.lit(at)
        if returned:
            back = spark.createDataFrame([(r, c, None, 1) for r, c in returned], "allocation_id bigint, condition_on_return string, return_notes string, actor_employee_id bigint")
            done = equipment.take_back(back, held, table, now)
            changed = done["items"].select("equipment_id", "status", "condition")
            table = settle(equipment.apply_changes(table.withColumn("updated_at", now), changed, "equipment_id", now).drop("updated_at"), "items")
            of = dict(held.select("allocation_id", "equipment_id").collect())
            log += [(of[r], at, 0, "RETURNED_DAMAGED" if c == "DAMAGED" else "RETURNED", r) for r, c in returned]
        requests = spark.createDataFrame([(r, e, 1, 1, "p", None) for r, e in wanted], kind)
        granted, changed, _, _ = equipment.allocate(requests, table, now)
        changed = changed.select("equipment_id", "status", "condition")
        new = settle(granted.select("allocation_id", "equipment_id", "employee_id", "status"), "granted")
        table = settle(equipment.apply_changes(table.withColumn("updated_at", now), changed, "equipment_id", now).drop("updated_at"), "items")
        held = new if held is None else held.unionByName(new)
        log += [(e, at, 1, "ALLOCATED", r) for r, e in wanted]
    events = spark.createDataFrame(log, "equipment_id bigint, at timestamp, seq int, action string, ref bigint")
    start = spark.createDataFrame(items, "equipment_id bigint, status string, condition string, is_deleted boolean")
    folded = states_after(start, events, "equipment_id", ["at", "seq"], part_events=2, ranges=3)
    assert rows(folded, "equipment_id", "status") == rows(table, "equipment_id", "status")
    assert {r["status"] for r in table.collect()} == {"AVAILABLE", "ALLOCATED", "UNDER_MAINTENANCE"}


def test_copies_of_a_heavy_key_are_dealt_out(spark, fixed_tasks, plan, rows):
    key = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 20_000)
    df = settle(spark.range(60_000).select(key.alias("k"), (F.xxhash64("id") % 100).alias("o"), F.col("id").alias("v")), "copies")
    for first in (lambda even: keep_first(df, ["k"], ["o"], even=even), lambda even: keep_latest(df, ["k"], "o", even=even)):
        assert rows(first(True)) == rows(first(False))
    text = plan(keep_first(df, ["k"], ["o"], even=True))
    assert text.count("hashpartitioning(k") == 3 and "__piece" in text
    heavy = heavy_keys(df, key_hash(df, ["k"], {"k": df.schema["k"].dataType}), 16)
    assert len(heavy) == 1
    dealt = df.withColumn("h", F.xxhash64("k")).withColumn("__piece", piece_of("h", heavy, 16))
    spread = rows_per_task(dealt.repartition("k", "__piece"))
    assert max(spread) < 2 * sum(spread) / 16
