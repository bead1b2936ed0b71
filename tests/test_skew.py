"""Heavy keys: results must not change and the work must be spread."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import skew
from millrace.operators.aggregates import keep_first, keep_latest, position, running_total, top_one
from millrace.operators.joins import join_roles, restrict_adaptive, restrict_to_keys


@pytest.fixture(scope="module")
def facts(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 500)
    return spark.range(0, 30_000, 1, 4).select(key.cast("bigint").alias("k"), "id")


@pytest.fixture(scope="module")
def names(spark):
    return spark.range(0, 400).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(facts, names, rows, how):
    plain = skew.join_on(facts, names, ["k"], how)
    salted = skew.salted_join(facts, names, ["k"], [7, None], how)
    assert rows(salted.select(plain.columns)) == rows(plain)


def test_salted_join_refuses_other_joins(facts, names):
    with pytest.raises(ValueError):
        skew.salted_join(facts, names, ["k"], [7], "full")


def test_keys_meet_by_their_common_type(spark, rows):
    facts = spark.createDataFrame([(1,), (2,)], "k int")
    halves = spark.createDataFrame([(1.5, "x"), (2.0, "y")], "k double, v string")
    large = spark.createDataFrame([(2**40, "x"), (1, "y")], "k bigint, v string")
    for hot in ([], [1], [2], [1, 2]):
        assert rows(skew.salted_join(facts, halves, ["k"], hot), "k", "v") == [(2, "y")]
        assert rows(skew.salted_join(facts, large, ["k"], hot), "k", "v") == [(1, "y")]


def test_rows_without_anything_but_the_key_are_spread(spark):
    keys = spark.range(0, 200_000, 1, 4).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("k"))
    names = spark.range(0, 200_000).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = skew.salted_join(keys, names, ["k"], [7], salts=64)
        per_task = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(per_task) == 200_000
    assert max(per_task) < 2 * sum(per_task) / len(per_task)


def test_restriction_forms_agree(facts, rows):
    keys = facts.filter("id < 40").select("k")
    listed = restrict_adaptive(facts, keys, "k")
    joined = restrict_adaptive(facts, keys, "k", max_in_list=1)
    assert rows(listed) == rows(joined) == rows(restrict_to_keys(facts, keys, ["k"]))


def test_list_restriction_reaches_the_scan(spark, plan):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    keys = orders.filter("o_orderkey < 20").select("o_custkey")
    assert "In(o_custkey" in plan(restrict_adaptive(orders, keys, "o_custkey"))


def test_roles_keep_unmatched(spark, rows):
    people = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    facts = spark.createDataFrame([(10, 1, 2), (11, 2, None), (12, 9, 1)], "f bigint, x bigint, y bigint")
    out = join_roles(facts, people, "id", {"one": "x", "two": "y"})
    assert rows(out, "f", "one.name", "two.name") == [(10, "a", "b"), (11, "b", None), (12, None, "a")]


def test_keep_first_ignores_partitioning(facts, rows):
    copies = facts.select(F.coalesce("k", F.lit(-1)).alias("k"), (F.col("id") % 50).alias("o"), F.col("id").alias("v"))
    one = rows(keep_first(copies.repartition(1), ["k"], ["o"]))
    assert one == rows(keep_first(copies.repartition(7), ["k"], ["o"]))
    assert len({k for k, _, _ in one}) == len(one)


def test_rows_move_before_they_are_sorted(spark, facts, plan):
    """No sort below an exchange: the rows of a key are sorted once, where they meet."""
    for df in (
        keep_first(facts, ["k"], ["id"]),
        top_one(facts.withColumn("l", F.col("id").cast("string")), ["k"], "id", "l", "best"),
        keep_latest(facts, ["k"], "id"),
    ):
        lines = [x for x in plan(df).split("\n") if "- " in x or x.startswith("*")]
        names = [x.strip(" +-*:").split(" (")[0] for x in lines[: next(i for i, x in enumerate(lines) if "Range" in x) + 1]]
        assert "Exchange" in names and names.count("Sort") == 1
        assert names.index("Sort") < names.index("Exchange")


def test_keep_first_forms_agree(facts, rows):
    copies = facts.select(F.coalesce("k", F.lit(-1)).alias("k"), (F.col("id") % 50).alias("o"), F.col("id").alias("v"))
    assert rows(keep_first(copies, ["k"], ["o"])) == rows(keep_first(copies, ["k"], ["o"], many_copies=True))


def test_null_labels_come_last(spark, rows):
    df = spark.createDataFrame([("g", None, 5), ("g", "a", 5), ("h", None, 1)], "g string, l string, w int")
    assert rows(top_one(df, ["g"], "w", "l", "best")) == [("g", "a"), ("h", None)]


def test_running_total_moves_the_rows_once(spark, plan):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_custkey")
    text = plan(running_total(orders, ["o_orderkey"], "o_custkey", "total"))
    moved = [x for x in text.split("\n") if "hashpartitioning(__range" in x or "rangepartitioning" in x]
    assert sum("rangepartitioning" in x for x in moved) == 0


def test_winner_ties_go_to_the_first_label(spark, rows):
    df = spark.createDataFrame([("g", "b", 5), ("g", "a", 5), ("g", "c", 1), ("h", "z", 1)], "g string, l string, w int")
    assert rows(top_one(df, ["g"], "w", "l", "best")) == [("g", "a"), ("h", "z")]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_running_total_in_any_layout(facts, partitions):
    pandas = facts.toPandas().sort_values("id")
    pandas["expected"] = pandas["id"].cumsum()
    got = running_total(facts.repartition(5), ["id"], "id", "total", partitions=partitions).toPandas().sort_values("id")
    assert got["total"].tolist() == pandas["expected"].tolist()


def test_positions(facts):
    got = position(facts.select("id").repartition(5), ["id"]).orderBy("id").toPandas()
    assert got["position"].tolist() == list(range(1, len(got) + 1))
