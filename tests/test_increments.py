"""Work that follows the change: gaps of ids, commits put together, merged totals, bitmaps, running maxima."""

import datetime as dt
import os
import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggregates import running_max, running_total, with_range
from millrace.plans.customer_profile import clean_transactions, customer_profiles
from millrace.plans.distincts import bitmaps, distinct_counts, merged_bitmaps
from millrace.plans.incremental import OffsetTable
from millrace.plans.processed import GAPS, CompleteJob, ProcessedIds, gaps_left, rows_in_gaps
from millrace.plans.profile_states import ProfileStates
from millrace.session import scratch_path, settle

TXN = "txn_id bigint, customer_id bigint, product_id bigint, qty int, amount decimal(10,2), txn_timestamp timestamp_ntz"


@pytest.mark.parametrize("seed,n", [(1, 10), (2, 200), (3, 2500)])
def test_gaps_by_brute_force(spark, seed, n):
    rnd, gaps, x = random.Random(seed), [], 1
    while x < n:
        lo = x + rnd.randint(0, 5)
        hi = lo + rnd.randint(0, 9)
        gaps.append((lo, hi, rnd.randint(1, 5)))
        # Some gaps adjoin each other.
        x = hi + 1 + rnd.choice([0, 0, 3])
    ids = [i for i in range(-2, n + 20) if rnd.random() < 0.4]
    ids += ids[:3]
    table = spark.createDataFrame(gaps, GAPS)
    rows = spark.createDataFrame([(i, f"v{i}", -i) for i in ids], "id bigint, v string, place int").repartition(5)
    inside = sorted(i for i in ids if any(a <= i <= b for a, b, _ in gaps))
    found = rows_in_gaps(rows, table, "id")
    assert found.columns == rows.columns
    assert sorted((r["id"], r["v"], r["place"]) for r in found.collect()) == [(i, f"v{i}", -i) for i in inside]
    want = []
    for lo, hi, since in gaps:
        free = [i for i in range(lo, hi + 1) if i not in inside]
        runs = [i for i in free if i - 1 not in free]
        want += [(i, next(j for j in range(i, hi + 1) if j + 1 not in free), since) for i in runs]
    left = gaps_left(table, spark.createDataFrame([(i,) for i in inside], "id bigint"), "id")
    assert sorted(tuple(r) for r in left.collect()) == sorted(want)


class Ledger:
    """Adds up what a job hands over."""

    def __init__(self):
        self.seen = []

    def add(self, batch):
        self.seen += [r["txn_id"] for r in batch.collect()]


def job_over(spark, done, ledger, ids, patience=10):
    table = spark.createDataFrame([(i, "x") for i in ids], "txn_id bigint, v string")
    return CompleteJob("t", lambda: table, done, ledger.add, patience=patience)


def test_ids_that_appear_late_count_once(spark):
    done, ledger = ProcessedIds(spark, scratch_path(spark, "done")), Ledger()
    visible = [[1, 2, 5, 6, 9], [1, 2, 4, 5, 6, 9, 12], [1, 2, 3, 4, 5, 6, 7, 8, 9, 12], list(range(1, 13)), list(range(1, 13))]
    counts = [job_over(spark, done, ledger, ids).run_once() for ids in visible]
    assert counts == [5, 2, 3, 2, 0]
    assert sorted(ledger.seen) == list(range(1, 13))
    state = done.read("t")
    assert (state.last_id, state.version, state.gaps.count()) == (12, 5, 0)
    assert done.read("other").last_id == 0


def test_gaps_are_given_up_after_the_patience(spark):
    done, ledger = ProcessedIds(spark, scratch_path(spark, "done")), Ledger()
    for ids in ([1, 5], [1, 5, 9], [1, 5, 9, 10]):
        job_over(spark, done, ledger, ids, patience=2).run_once()
    # The gap of the first run was open for two more runs, that of the second for one.
    assert sorted(tuple(r)[:2] for r in done.read("t").gaps.collect()) == [(6, 8)]
    job_over(spark, done, ledger, range(1, 11), patience=2).run_once()
    assert sorted(ledger.seen) == [1, 5, 6, 7, 8, 9, 10]


def test_a_failed_batch_comes_again(spark):
    done, ledger = ProcessedIds(spark, scratch_path(spark, "done")), Ledger()
    job_over(spark, done, ledger, [1, 4]).run_once()
    job = job_over(spark, done, ledger, [1, 2, 4, 7])
    job.process = lambda batch: 1 / 0
    with pytest.raises(ZeroDivisionError):
        job.run_once()
    assert done.read("t").last_id == 4
    job.process = ledger.add
    assert job.run_once() == 2 and sorted(ledger.seen) == [1, 2, 4, 7]


def test_sources_and_commits_keep_few_files(spark):
    path = scratch_path(spark, "done")
    done, ledger = ProcessedIds(spark, path), Ledger()
    for n in range(1, 6):
        job_over(spark, done, ledger, range(1, 2 * n)).run_once()
    job = job_over(spark, done, ledger, [3])
    job.source = "b/ ü"
    assert job.run_once() == 1 and done.read("b/ ü").last_id == 3 and done.read("t").last_id == 9
    parts = [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]
    assert len(parts) <= 6


def test_commits_are_put_together(spark, rows):
    path = scratch_path(spark, "offsets")
    offsets = OffsetTable(spark, path, loose=4)
    for n in (5, 1, 9, 3, 9, 2, 4, 8, 7, 6, 1):
        offsets.advance("a", n)
        offsets.advance("b", -n)
    assert rows(offsets.all()) == [("a", 9), ("b", -1)]
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) <= 5


def transactions(seed, n, first_id):
    rnd = random.Random(seed)
    return [
        (
            first_id + i, rnd.randint(1, 12), rnd.choice([10, 11, 12, 13, 99, None]), 1,
            Decimal(rnd.randint(0, 5000)) / 100, dt.datetime(2024, 1, rnd.randint(1, 28), rnd.randint(0, 23)),
        )
        for i in range(n)
    ]


def test_merged_totals_equal_a_recomputation(spark, rows, plan):
    products = spark.createDataFrame([(10, "toys"), (11, "books"), (12, "toys"), (13, None)], "product_id bigint, category string")
    people = spark.createDataFrame([(i, f"n{i}", "e", "f") for i in range(1, 11)], "customer_id bigint, name string, email string, gender string")
    parts = [transactions(s, 40, 1000 * s) for s in range(4)]
    states = ProfileStates(spark, scratch_path(spark, "totals"), scratch_path(spark, "profiles"), buckets=4)
    tables = [spark.createDataFrame(p + p[:5], TXN) for p in parts]
    assert states.totals().count() == 0
    for step in (0, 1, 1, "fold", 0, 2, "fold", "fold", 2, 3, 3):
        states.compact() if step == "fold" else states.add(tables[step], products, people, step)
    states.add(tables[0].limit(0), products, people, 9)
    everything = spark.createDataFrame([r for p in parts for r in p], TXN)
    want = customer_profiles(clean_transactions(everything), people, products)
    assert rows(states.profiles().select(want.columns)) == rows(want)
    assert states.folded() == 2
    # The batch reads itself and the products, and nothing that is stored.
    delta = settle(tables[3], "delta")
    text = plan(states.of_batch(delta, settle(products, "products"), 7))
    assert "totals" not in text and text.count("Location: InMemoryFileIndex") == 2


def test_bitmaps_merge_over_days(spark, rows):
    rnd = random.Random(5)
    data = [(rnd.randint(1, 9), rnd.randint(1, 4), rnd.choice([None, 0, -1, -40_000, rnd.randint(1, 200_000), rnd.randint(1, 20)])) for _ in range(3000)]
    table = spark.createDataFrame(data, "day int, k int, v bigint")
    stored = settle(bitmaps(table, ["day", "k"], "v"), "bitmaps")
    for first, last in ((1, 9), (3, 5), (9, 9)):
        want = {k: len({v for d, q, v in data if q == k and first <= d <= last and v is not None}) for k in range(1, 5)}
        assert dict(distinct_counts(stored.filter(F.col("day").between(first, last)), ["k"]).collect()) == want
    whole = merged_bitmaps(merged_bitmaps(stored, ["k"]), [])
    assert distinct_counts(whole, []).collect()[0][0] == len({v for _, _, v in data if v is not None})


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_running_max_in_any_layout(spark, partitions):
    rnd = random.Random(2)
    data = [(i, rnd.choice([None, rnd.randint(0, 1000)])) for i in range(500)]
    df = spark.createDataFrame(rnd.sample(data, len(data)), "i int, v int").repartition(7)
    got = {r["i"]: r for r in running_max(df, ["i"], {"so_far": "v"}, partitions=partitions).collect()}
    earlier = {r["i"]: r for r in running_max(df, ["i"], {"before": "i"}, earlier=True, partitions=partitions).collect()}
    top = None
    for i, v in data:
        top = v if top is None or (v is not None and v > top) else top
        assert got[i]["so_far"] == top
        assert earlier[i]["before"] == (i - 1 if i else None)


@pytest.mark.parametrize("ranges", [1, 2, 5, 27, 300])
def test_ranges_follow_the_order(spark, ranges):
    df = spark.range(3000).select((F.xxhash64("id") % 500).alias("a"), F.when(F.col("id") % 9 > 0, F.col("id")).alias("b"))
    found = with_range(df, ["a", "b"], "r", ranges).collect()
    ordered = sorted(found, key=lambda r: (r["a"], r["b"] is not None, r["b"] or 0))
    numbers = [r["r"] for r in ordered]
    assert numbers == sorted(numbers) and numbers[0] == 0
    assert 0.5 * ranges <= len(set(numbers)) <= 2 * ranges
    assert len(found) == 3000 and with_range(df.limit(0), ["a", "b"], "r", ranges).count() == 0


def test_many_ranges_cost_little_more_than_few(spark):
    df = settle(spark.range(100_000).select(F.xxhash64("id").alias("k"), "id"), "numbers")

    def seconds(ranges):
        start = time.time()
        assert running_total(df, ["k"], "id", "t", partitions=ranges).agg(F.max("t")).first()[0] > 0
        return time.time() - start

    seconds(100)
    assert min(seconds(1600) for _ in range(2)) < 1.5 * max(seconds(100) for _ in range(2)) + 0.5


def test_a_batch_moves_its_rows_to_customers_once(spark, rows, plan):
    products = spark.createDataFrame([(10, "toys"), (10, "zz"), (11, "toys"), (12, None)], "product_id bigint, category string")
    states = ProfileStates(spark, scratch_path(spark, "totals"), scratch_path(spark, "profiles"), buckets=4)
    delta = spark.createDataFrame(transactions(7, 60, 1), TXN)
    made = states.of_batch(delta, products, 3)
    moved = [line for line in plan(made).splitlines() if "Arguments: hashpartitioning(customer_id" in line]
    assert len(moved) == 1
    known = [r for r in transactions(7, 60, 1) if r[2] in (10, 11, 12) and r[4] > 0]
    want = {}
    for _, customer, product, _, amount, _ in known:
        key = (customer, None if product == 12 else "toys")
        spend, n = want.get(key, (0, 0))
        want[key] = (spend + amount, n + 1)
    assert rows(made, "customer_id", "category", "spend", "n") == sorted(((*k, *v) for k, v in want.items()), key=repr)
