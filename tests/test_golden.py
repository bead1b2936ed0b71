"""Small documented inputs and the results they must give."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import numbers, payloads, text, times
from millrace.operators import aggregates, joins, ordering, rows as rowwise
from millrace.plans import sales
from millrace.sources import generate


def test_currency_conversion(spark, rows):
    paid = spark.createDataFrame(
        [(1001, 500.0, "INR"), (1002, 20.0, "EUR"), (1003, 35.0, "USD"), (1004, 10000.0, "JPY"), (1005, 12.0, "EUR"), (1006, 1.0, "XXX")],
        "txn_id bigint, amount double, currency string",
    )
    rates = spark.createDataFrame([("USD", 1.0), ("EUR", 1.07), ("INR", 0.012), ("JPY", 0.0068)], "currency string, rate_to_usd double")
    out = sales.convert_currency(paid, rates)
    got = {r["txn_id"]: r["amount_usd"] for r in out.collect()}
    assert got[1006] is None
    assert [round(got[i], 2) for i in range(1001, 1006)] == [6.0, 21.4, 35.0, 68.0, 12.84]
    assert rows(aggregates.count_by(out, ["currency"])) == [("EUR", 2), ("INR", 1), ("JPY", 1), ("USD", 1), ("XXX", 1)]


def test_generated_currency_tables(spark):
    out = sales.convert_currency(generate.fx_transactions(spark), generate.fx_rates(spark))
    assert out.count() == 15 and out.filter("amount_usd is null").count() == 0


def test_sales_aggregates(spark, rows):
    data = [("C001", "P10", 2, 500.0), ("C002", "P12", 1, 120.0), ("C001", "P11", 4, 900.0), ("C003", "P14", 3, 250.0), ("C002", "P10", 5, 1000.0)]
    df = spark.createDataFrame(data, "customerId string, productId string, quantity int, amount double")
    assert rows(sales.amount_by_customer(df)) == [("C001", 1400.0), ("C002", 1120.0), ("C003", 250.0)]
    assert rows(sales.quantity_by_product(df)) == [("P10", 7), ("P11", 4), ("P12", 1), ("P14", 3)]


def test_high_value_count(spark):
    df = spark.createDataFrame([(300.0,), (520.0,), (1500.0,), (450.0,), (700.0,)], "amount double")
    assert aggregates.count_above(df, "amount", 500).first()[0] == 3


def test_word_counts(spark, rows):
    df = spark.createDataFrame([("Scala is powerful",), ("Scala is concise",), ("Functional programming is powerful",)], "t string")
    expected = [("Functional", 1), ("Scala", 2), ("concise", 1), ("is", 3), ("powerful", 2), ("programming", 1)]
    assert rows(aggregates.word_counts(df, "t")) == expected


def test_tolerant_numbers(spark, rows):
    df = spark.createDataFrame([("10",), ("20",), ("x",), ("30",)], "t string")
    n = numbers.to_number("t")
    assert rows(df.filter(n.isNotNull()).select(n * n)) == [(100,), (400,), (900,)]


def test_length_pairs(spark, rows):
    names = spark.createDataFrame([("Asha",), ("Bala",), ("Chitra",)], "name string")
    subjects = spark.createDataFrame([("Math",), ("Physics",)], "subject string")
    pairs = joins.length_pairs(names, subjects, "name", "subject")
    assert rows(pairs, "name", "subject") == [("Asha", "Math"), ("Bala", "Math"), ("Chitra", "Math")]
    counted = joins.length_match_counts(names, subjects, "name", "subject")
    assert rows(counted, "name", "matches") == [("Asha", 1), ("Bala", 1), ("Chitra", 1)]


def test_division_tiers_temperatures_rounding(spark):
    df = spark.createDataFrame([(10.0, 2.0), (5.0, 0.0), (8.0, 4.0)], "a double, b double")
    value, error = numbers.divide(F.col("a"), F.col("b"))
    assert [tuple(r) for r in df.select(value, error).collect()] == [(5.0, None), (None, "Division by zero"), (2.0, None)]
    tiers = spark.createDataFrame([("gold",), ("Silver",), ("regular",)], "t string")
    assert [r[0] for r in tiers.select(numbers.tier_price(F.lit(1000.0), F.col("t"))).collect()] == [800.0, 900.0, 1000.0]
    degrees = spark.createDataFrame([(0.0, "C"), (212.0, "F"), (50.0, "X")], "v double, s string")
    assert [r[0] for r in degrees.select(numbers.convert_temperature(F.col("v"), F.col("s"))).collect()] == [32.0, 100.0, 50.0]
    money = spark.createDataFrame([(10.23, 5.19)], "a double, b double")
    near = money.select(numbers.round_to(F.col("a") + F.col("b")), numbers.round_to(F.col("a") - F.col("b"))).first()
    assert (float(near[0]), float(near[1])) == (15.4, 5.05)


def test_arrays_and_text(spark):
    df = spark.createDataFrame([([1, 2, 3], "  heLLO wORLD ")], "a array<int>, t string")
    assert df.select(text.mirrored(F.col("a"))).first()[0] == [1, 2, 3, 3, 2, 1]
    assert df.select(text.sentence_case(F.col("t"))).first()[0] == "Hello world"
    assert df.select(text.pick(F.col("a"), F.lit(9))).first()[0] is None


def test_running_sums(spark, rows):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, n int")
    assert rows(aggregates.running_total(df, ["id"], "n", "s"), "id", "s") == [(1, 1), (2, 3), (3, 6)]
    assert rows(aggregates.running_total(df, ["id"], "n", "s", reverse=True), "id", "s") == [(1, 6), (2, 5), (3, 3)]


def test_time_forms(spark):
    written = ["2024-05-01T10:20:30.123456", "2024-05-01 10:20:30", "2024-05-01T10:20", " 2024-05-01T10:20:30.5 ", "soon", None]
    df = spark.createDataFrame([(w,) for w in written], "t string")
    got = [r[0] for r in df.select(F.date_format(times.parse_time(F.col("t")), "HH:mm:ss.SSS")).collect()]
    assert got == ["10:20:30.123", "10:20:30.000", "10:20:00.000", "10:20:30.500", None, None]


def test_route_keys(spark):
    cases = [
        ("ALLOCATION:17", "{}", "ALLOCATION"),
        ("inventory", "{}", "INVENTORY"),
        ("  ", '{"eventType": " damaged "}', "DAMAGED"),
        (None, '{"eventType": "Reminder"}', "REMINDER"),
        (None, "{}", "UNKNOWN"),
    ]
    df = spark.createDataFrame(cases, "k string, v string, expected string")
    for row in df.select(payloads.route_key(F.col("k"), F.col("v")).alias("got"), "expected").collect():
        assert row["got"] == row["expected"]


def test_json_objects_and_ids(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("[1]",), ("x",), ("{bad",), ("{}",), (None,)], "v string")
    assert [r[0] for r in df.select(payloads.is_json_object(F.col("v"))).collect()] == [True, False, False, False, True, False]
    ids = spark.createDataFrame([('{"allocationId": "7"}',), ('{"allocId": 8}',), ('{"allocationId": "x", "id": 9}',), ("{}",)], "v string")
    assert [r[0] for r in ids.select(payloads.json_field(F.col("v"), ["allocationId", "allocId", "id"])).collect()] == [7, 8, 9, None]


def test_violations(spark):
    df = spark.createDataFrame([("a@b.co", "0123456789"), ("a@b", "12"), (None, None)], "mail string, phone string")
    rules = {"mail": text.is_email(F.col("mail")), "phone": text.is_phone(F.col("phone"))}
    assert [r[0] for r in df.select(rowwise.violations(rules)).collect()] == ["", "mail; phone", "mail; phone"]


def test_split_is_complete(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "n int")
    kept, rest = rowwise.split_rows(df, F.col("n") > 0)
    assert (kept.count(), rest.count()) == (1, 2)


def test_paging(spark, rows, monkeypatch):
    df = spark.range(1, 101).withColumn("k", F.col("id") % 3)
    shallow = rows(ordering.page_of(df, ["k"], ["id"], 4, 10))
    monkeypatch.setattr(ordering, "SHALLOW_ROWS", 0)
    assert rows(ordering.page_of(df, ["k"], ["id"], 4, 10)) == shallow and len(shallow) == 10
    for page, size in ((0, 10), (1, 0), (1, 501)):
        with pytest.raises(ValueError):
            ordering.page_of(df, ["k"], ["id"], page, size)


def test_deep_pages_exist_and_keep_nulls_last(spark, rows):
    df = spark.range(0, 100_600).withColumn("t", F.when(F.col("id") >= 300, F.col("id")))
    got = rows(ordering.page_of(df, ["t"], ["id"], 201, 500))
    # After 100,300 rows with a time come those without, by id.
    assert sorted(r[0] for r in got) == [*range(200), *range(100_300, 100_600)]
    assert sum(r[1] is None for r in got) == 200


def test_seeded_sample_does_not_depend_on_the_layout(spark, rows):
    df = spark.range(0, 1000, 1, 4)
    first = rows(ordering.sample_rows(df, 0.05, 7, ["id"]))
    assert first == rows(ordering.sample_rows(df.repartition(3), 0.05, 7, ["id"])) and 20 < len(first) < 90
