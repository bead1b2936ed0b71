"""Time column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(text: Column) -> Column:
    """ISO with milliseconds, then a space-separated form, then any form Spark reads; else null."""
    trimmed = F.trim(text)
    millis = F.regexp_replace(trimmed, r"\.(\d{3})\d+", ".$1")
    return F.coalesce(
        F.try_to_timestamp(millis, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS")),
        F.try_to_timestamp(trimmed, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(trimmed),
    )


def is_iso_date(text: Column) -> Column:
    """A whole calendar date; a bare year or month is none."""
    return text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(text).isNotNull()


def minutes_between(start: Column, end: Column) -> Column:
    """Difference of the whole seconds, in minutes."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def shown_in_zone(ts: Column, zone: str = "Asia/Kolkata", label: str = "IST") -> Column:
    """A UTC time as people in the zone read it; ``N/A`` for null."""
    local = F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(F.concat(local, F.lit(f" {label}")), F.lit("N/A"))


def before(ts: Column, interval: str) -> Column:
    return ts - F.expr(f"INTERVAL {interval}")


def backoff_minutes(attempt: Column) -> Column:
    """1, 2, 4, 8 … minutes after the first, second, third … failure."""
    return F.pow(F.lit(2), attempt - 1).cast("long")


def plus_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))
