"""The query registry and the output forms both engines agree on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the equivalent SQL when there is one."""

    def add(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return add


def dbl(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def big(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def day(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def stamp(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def sql_day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def sql_stamp(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"
