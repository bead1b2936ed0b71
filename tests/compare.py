"""Run registered queries beside their SQL and compare names, row counts and values.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "<null>"
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return repr(value) if isinstance(value, float) else str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(plain(v) for v in row) for row in frame.itertuples(index=False, name=None))


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    a, b = sorted(spark_frame.columns), sorted(sql_frame.columns)
    if a != b:
        return f"columns {a} and {b}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} rows and {len(sql_frame)}"
    if len(spark_frame) == 0:
        return "no rows on either side"
    left, right = rows_of(spark_frame), rows_of(sql_frame)
    for x, y in zip(left, right):
        if x != y:
            return f"columns {a}\n   spark {x}\n   sql   {y}"
    return None


def main(folder: str, wanted: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from millrace.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, build in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            got = build(spark, folder).toPandas()
            took = time.time() - start
            if name not in oracles:
                print(f"rows {name} {len(got)} {took:.2f}s", flush=True)
                continue
            problem = differences(got, con.execute(oracles[name]).df())
        except Exception as error:  # noqa: BLE001
            took, problem = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        if problem:
            bad += 1
            print(f"BAD  {name}: {problem}", flush=True)
        else:
            print(f"ok   {name} {len(got)} rows {took:.2f}s", flush=True)
    from millrace.sinks.files import drop_scratch

    drop_scratch(spark)
    print(f"{bad} bad of {len(queries)}; without SQL: {[n for n in queries if n not in oracles]}")
    return 1 if bad else 0


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    sys.exit(main(folder, args[1:]))
