"""Route messages by key to typed outputs; unknown and non-object messages become dead letters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.payloads import is_json_object, route_key
from millrace.sinks.files import replace_partitions

# Routing keys and the output each of them belongs to.
EQUIPMENT_ROUTES = {
    "ALLOCATION": "allocation",
    "INVENTORY": "inventory",
    "EQUIPMENT": "inventory",
    "MAINTENANCE": "maintenance",
    "DAMAGED": "maintenance",
    "REMINDER": "reminder",
}
PLANNER_ROUTES = {"EVENT": "event", "TEAM": "team", "TASK": "task", "NOTIFICATION": "notification"}
REJECTED = "rejected"


def route(key: Column, payload: Column, routes: Mapping[str, str]) -> Column:
    wanted = route_key(key, payload)
    target = F.lit(REJECTED)
    for name, output in routes.items():
        target = F.when(wanted == name, F.lit(output)).otherwise(target)
    return F.when(is_json_object(payload), target).otherwise(F.lit(REJECTED))


def routed(messages: DataFrame, routes: Mapping[str, str]) -> DataFrame:
    """``messages`` (key, value as text) with their routing key and output."""
    return messages.withColumn("route_key", route_key(F.col("key"), F.col("value"))).withColumn(
        "route", route(F.col("key"), F.col("value"), routes)
    )


def route_writer(path: str, routes: Mapping[str, str]):
    """A batch function that stores each output in its own partition, repeatable per batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = routed(batch, routes).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        replace_partitions(rows, path, ["route", "batch_id"])

    return handle
