"""File sources and sinks."""

import pytest
from pyspark.sql import functions as F

from millrace.plans.formats import compare_formats, round_trips
from millrace.sinks import files
from millrace.sinks.keyed import upsert
from millrace.sources import files as scans
from millrace.session import scratch_path

LINES = [
    "1, 5 ,AUTO,2024-05-01T10:00:00.123456,2024-05-01T10:30:00,A,B,12.5,100.0,CASH,4.5",
    "2,6,BIKE,2024-05-01 10:00:00,2024-05-01 10:05:00,A,C,3.0,20,UPI,n/a",
    "3,6,BIKE,2024-05-01 10:00:00,2024-05-01 10:05:00,A,C,far,20,UPI,4",
    "x,6,TAXI,2024-05-01 10:00:00,2024-05-01 10:05:00,A,C,11,20,UPI,4",
    "   ",
    "1,2,3",
]
HEADER = "TripId,driverId,vehicleType,startTime,endTime,startLocation,endLocation,distanceKm,fareAmount,paymentMethod,customerRating"


@pytest.mark.parametrize("header", [True, False])
def test_trip_lines(spark, rows, tmp_path, header):
    path = tmp_path / "trips.csv"
    path.write_text("\n".join(([HEADER] if header else []) + LINES) + "\n")
    assert rows(scans.read_trips(spark, str(path)), "trip_id", "driver_id", "vehicle_type") == [(1, 5, "AUTO")]
    # The long-trip branch needs the distance alone, so it also keeps the row with a bad id.
    assert rows(scans.read_long_distances(spark, str(path))) == [("AUTO", 12.5), ("TAXI", 11.0)]


def test_csv_cells_that_do_not_convert(spark, rows, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,amount\n1,2.5\n2,many\n,3\n")
    assert rows(scans.read_csv(spark, str(path), "id int, amount double")) == [(1, 2.5), (2, None), (None, 3.0)]
    assert rows(scans.read_csv_strings(spark, str(path)))[0] == ("1", "2.5")


def test_log_lines(spark, rows, tmp_path):
    path = tmp_path / "log.txt"
    path.write_text("1|ERROR|disk|7\n2|INFO|fine\n")
    assert rows(scans.read_log_lines(spark, str(path))) == [("1", "ERROR", "disk", "7"), ("2", "INFO", "fine", None)]


def test_one_day_is_pruned(spark, plan, tmp_path):
    df = spark.range(100).withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")))
    files.write_lake(df, str(tmp_path / "lake"), ["date"])
    day = scans.read_lake_day(spark, str(tmp_path / "lake"), "2024-01-03")
    assert day.count() == 20
    assert "PartitionFilters: [isnotnull(date" in plan(day)


def test_heavy_partition_is_split(spark, tmp_path):
    df = spark.range(0, 20_000, 1, 4).withColumn("p", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20))
    files.write_lake(df, str(tmp_path / "lake"), ["p"], tasks=8)
    per = {r["folder"]: r["files"] for r in files.files_per_partition(spark, str(tmp_path / "lake")).collect()}
    assert per["p=0"] > 1
    assert spark.read.parquet(str(tmp_path / "lake")).count() == 20_000


def test_untouched_partitions_survive(spark, rows, tmp_path):
    path = str(tmp_path / "lake")
    files.replace_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    for _ in range(2):
        files.replace_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path), "v", "p") == [(1, "a"), (9, "b")]


def test_report_is_the_form_the_caller_asks_for(spark, tmp_path):
    df = spark.range(0, 50, 1, 5)
    single = files.write_report(df, str(tmp_path / "a"), "r.csv")
    folder = files.write_report(df, str(tmp_path / "b"), "r.csv", single=False)
    lines = files.write_report(df, str(tmp_path / "c"), "r.json", kind="json")
    assert (tmp_path / "a" / "r.csv").is_file() and (tmp_path / "b" / "r.csv").is_dir() and (tmp_path / "c" / "r.json").is_file()
    assert [p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith(".")] == ["r.csv"]
    for path in (single, folder):
        assert spark.read.option("header", True).csv(path).count() == 50
    assert spark.read.schema("id bigint").json(lines).distinct().count() == 50
    with pytest.raises(ValueError):
        files.write_report(df, str(tmp_path / "d"), "r.csv", max_rows=10)
    with pytest.raises(ValueError):
        files.write_report(df, str(tmp_path / "d"), "r.xml", kind="xml")


def test_cleanup_and_reachability(spark, tmp_path):
    path = str(tmp_path / "x")
    files.write_text(spark.range(3), path)
    assert files.path_exists(spark, path) and files.reachable(spark, path)
    assert files.delete_path(spark, path) and not files.delete_path(spark, path)
    assert files.reachable(spark, path) and not files.reachable(spark, path + "/no/where")


def test_metrics_of_an_output(spark, tmp_path):
    files.write_parquet(spark.range(0, 10, 1, 3), str(tmp_path / "t"))
    found = files.output_metrics(spark, str(tmp_path / "t")).first()
    on_disk = [p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-")]
    assert (found["files"], found["partitions"]) == (len(on_disk), 0)
    assert found["bytes"] == sum(p.stat().st_size for p in on_disk)


def test_codec(spark, tmp_path):
    files.write_parquet(spark.range(5), str(tmp_path / "z"), "gzip")
    assert any(p.name.endswith(".gz.parquet") for p in (tmp_path / "z").iterdir())


def test_formats_keep_all_rows(spark, tmp_path):
    out = compare_formats(spark, spark.range(1000).withColumn("s", F.lit("text")), str(tmp_path / "f")).collect()
    assert {r["format"]: r["n_rows"] for r in out} == dict.fromkeys(("csv", "json", "parquet", "text"), 1000)
    size = {r["format"]: r["bytes"] for r in out}
    assert size["parquet"] < size["csv"] < size["json"]


def test_upserts_replace_rows_of_equal_key(spark, rows):
    paths = [scratch_path(spark, "keyed") for _ in range(4)]
    upsert(spark.createDataFrame([(i, "old", 0) for i in range(20)], "k int, v string, at int"), ["k"], None, paths[0])
    change = spark.createDataFrame([(3, "new", 2), (3, "older", 1), (99, "new", 1)], "k int, v string, at int")
    for before, after in zip(paths, paths[1:3]):
        upsert(change, ["k"], before, after, latest="at")
    expected = [(i, "new" if i == 3 else "old") for i in range(20)] + [(99, "new")]
    assert rows(spark.read.parquet(paths[2]), "k", "v") == sorted(expected, key=repr)
    upsert(change.limit(0), ["k"], paths[2], paths[3], tasks=3)
    assert spark.read.parquet(paths[3]).count() == 21
    # The earlier version is untouched.
    assert spark.read.parquet(paths[0]).filter("v = 'new'").count() == 0


def test_formats_under_one_codec_keep_all_rows(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "COMPRESSED_ROWS", 100)
    df = spark.range(1000).repartition(2).withColumn("s", F.when(F.col("id") > 0, F.concat(F.lit("some longer text "), "id")))
    measures = [F.count("*").alias("n"), F.sum("id").alias("ids"), F.count_distinct(F.nullif("s", F.lit(""))).alias("texts")]
    out = round_trips(df, str(tmp_path / "f"), measures, codec="snappy")
    assert rows(out) == [(kind, 1000, 499500, 999) for kind in ("csv", "json", "parquet", "text")]
    for kind in ("csv", "json", "text"):
        parts = [p.name for p in (tmp_path / "f" / kind).iterdir() if p.name.startswith("part-")]
        # One task reads a compressed file, so a task of 500 rows writes several.
        assert len(parts) == 10 and all(name.endswith(".snappy") for name in parts)


def test_format_costs_under_one_codec(spark, tmp_path):
    df = spark.range(20000).select("id", F.lit("a text that repeats").alias("s"))
    plain, packed = (
        {r["format"]: r for r in compare_formats(spark, df, str(tmp_path / name), codec=codec).collect()}
        for name, codec in (("plain", None), ("packed", "snappy"))
    )
    assert all(packed[kind]["n_rows"] == 20000 for kind in packed)
    assert all(packed[kind]["bytes"] < plain[kind]["bytes"] / 2 for kind in ("csv", "json", "text"))
