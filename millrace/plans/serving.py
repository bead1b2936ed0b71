"""Reads that serve one customer or one day from the stored lakes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.payloads import row_json
from millrace.operators.ordering import MAX_PAGE_SIZE, page_of
from millrace.operators.skew import join_on


def summary_of(summaries: DataFrame, day: str, customer_id: int) -> DataFrame:
    """The summary row of a customer on a day, or none; the day prunes the other partitions."""
    day_rows = summaries.filter(F.col("date") == F.lit(day).cast("date"))
    return day_rows.filter(F.col("customer_id") == customer_id).limit(1)


def customer_events(events: DataFrame, customer_id: int, first: str, last: str, limit: int = 20) -> DataFrame:
    """A customer's events of a date range in date order."""
    if not 1 <= limit <= MAX_PAGE_SIZE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE_SIZE}")
    days = F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    found = events.filter(days & (F.col("customer_id") == customer_id))
    return found.orderBy("event_date", "event_timestamp", "event_id").limit(limit)


def as_json(df: DataFrame) -> DataFrame:
    return df.select(row_json(df).alias("json"))


def planned_page(
    rows: DataFrame, users: DataFrame, time_column: str, unique: str, start, end, page: int, size: int
) -> DataFrame:
    """One page of active rows in a time range with their live creator, rows without a time last.

    ``total`` counts the rows in range, ``total_visible`` those whose creator is not deleted.
    """
    in_range = rows.filter(~F.col("is_deleted") & F.col(time_column).between(F.lit(start), F.lit(end)))
    creators = users.filter(~F.col("is_deleted")).select(F.col("user_id").alias("created_by"), "full_name")
    visible = join_on(in_range, creators, ["created_by"])
    paged = page_of(visible, [time_column], [unique], page, size)
    # One pass over the range gives both totals.
    marked = join_on(in_range, creators.withColumn("__seen", F.lit(True)), ["created_by"], "left")
    totals = marked.agg(F.struct(F.count("*").alias("all"), F.count("__seen").alias("visible"))).scalar()
    counted = paged.withColumn("__totals", totals)
    return counted.withColumns({"total": F.col("__totals.all"), "total_visible": F.col("__totals.visible")}).drop("__totals")
