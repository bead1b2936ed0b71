"""Row-level work: typed projections, validity rules, life-cycle filters."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typed(df: DataFrame, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{output: (input, type)}``; values that do not convert become null."""
    return df.select(*(F.col(src).try_cast(kind).alias(out) for out, (src, kind) in spec.items()))


def split_rows(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """``(kept, rest)``. A null verdict counts as false, so every row is in exactly one part."""
    verdict = F.coalesce(keep, F.lit(False))
    return df.filter(verdict), df.filter(~verdict)


def violations(rules: Mapping[str, Column]) -> Column:
    """The names of the broken rules joined by ``; ``, empty for a clean row."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return F.concat_ws("; ", *broken)


def active(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_deleted"))


def deleted(df: DataFrame) -> DataFrame:
    return df.filter("is_deleted")


def by_life(df: DataFrame, include_deleted: bool = False) -> DataFrame:
    return df if include_deleted else active(df)


def lookup(df: DataFrame, **keys) -> DataFrame:
    """The row with the given key values, or none."""
    for name, value in keys.items():
        df = df.filter(F.col(name) == value)
    return df.limit(1)


def within(df: DataFrame, column: str, start: datetime, end: datetime) -> DataFrame:
    return df.filter(F.col(column).between(F.lit(start), F.lit(end)))


def valid_transactions(df: DataFrame) -> DataFrame:
    return df.filter(
        F.col("customer_id").isNotNull()
        & F.col("product_id").isNotNull()
        & (F.col("qty") > 0)
        & (F.col("amount") > 0)
    )


def valid_trips(df: DataFrame) -> DataFrame:
    """Positive distance, no negative fare, both times known, and an end after the start."""
    return df.filter(
        (F.col("distance_km") > 0) & (F.col("fare_amount") >= 0) & (F.col("start_ts") < F.col("end_ts"))
    )


def starting_soon(tasks: DataFrame, start: Column, end: Column) -> DataFrame:
    return active(tasks).filter(
        F.col("estimated_start").between(start, end) & (F.col("status") != "Completed")
    )


def overdue_tasks(tasks: DataFrame, as_of: Column) -> DataFrame:
    return active(tasks).filter((F.col("estimated_end") < as_of) & (F.col("status") != "Completed"))


def overdue_allocations(allocations: DataFrame, as_of: Column) -> DataFrame:
    return active(allocations).filter(
        (F.col("status") == "ACTIVE")
        & F.col("returned_at").isNull()
        & (F.col("expected_return_at") < as_of)
    )


def due_notifications(notifications: DataFrame, as_of: Column) -> DataFrame:
    return active(notifications).filter(
        (F.col("status") == "pending")
        & (F.col("scheduled_for").isNull() | (F.col("scheduled_for") <= as_of))
    )


def available_items(items: DataFrame, type_id: int | None = None) -> DataFrame:
    found = active(items).filter(F.col("status") == "AVAILABLE")
    return found if type_id is None else found.filter(F.col("type_id") == type_id)
