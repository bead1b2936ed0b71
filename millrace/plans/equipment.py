"""Equipment allocation as set-based steps: allocate, return, escalate, maintain.

Every step takes the tables and an ``as_of`` time and gives the rows to write; nothing reads the
clock, so a step can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import keep_latest
from millrace.operators.rows import active, available_items, overdue_allocations
from millrace.operators.skew import join_on


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def outbox_rows(
    df: DataFrame, event_type: str, payload: Column, as_of: Column, ticket: Column | None = None
) -> DataFrame:
    """PENDING outbox events with a JSON payload."""
    return df.select(
        F.lit(event_type).alias("event_type"),
        F.col("allocation_id"),
        (ticket if ticket is not None else F.lit(None).cast("bigint")).alias("ticket_id"),
        payload.alias("payload"),
        F.lit("PENDING").alias("status"),
        as_of.alias("created_at"),
        F.lit(None).cast("timestamp").alias("published_at"),
        F.lit(None).cast("string").alias("last_error"),
    )


def overdue_payload(as_of: Column) -> Column:
    return F.to_json(
        F.struct(
            F.lit("OVERDUE_REMINDER").alias("eventType"),
            F.col("allocation_id").alias("allocationId"),
            F.col("equipment_id").alias("equipmentId"),
            F.col("employee_id").alias("employeeId"),
            iso(F.col("expected_return_at")).alias("expectedReturnAt"),
            iso(as_of).alias("notifiedAt"),
        )
    )


def escalate_overdue(allocations: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(updated allocations, overdue log, outbox events)`` for what is late at ``as_of``."""
    late = overdue_allocations(allocations, as_of)
    updated = late.withColumn("status", F.lit("OVERDUE")).withColumn("updated_at", as_of)
    log = late.select(
        "allocation_id",
        as_of.alias("notified_at"),
        F.lit("FIRST").alias("reminder_type"),
        F.col("employee_id").alias("recipient_employee_id"),
        F.lit("EMAIL").alias("channel"),
    )
    return updated, log, outbox_rows(late, "REMINDER", overdue_payload(as_of), as_of)


def overdue_reminders(allocations: DataFrame, as_of: Column) -> DataFrame:
    """The reminder events alone, for a scheduler that leaves the allocations as they are."""
    late = overdue_allocations(allocations, as_of)
    return outbox_rows(late, "OVERDUE_REMINDER", overdue_payload(as_of), as_of)


def allocate(
    requests: DataFrame, items: DataFrame, as_of: Column
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(allocations, changed items, outbox events, rejected)`` for a batch of requests.

    An item goes to its first request by request id. The winner is the minimum per item, so an
    item wanted by very many needs no ranking of all its requests. Requests for unknown or
    unavailable items, and later ones, come back with a reason.
    """
    free = available_items(items).select("equipment_id", "condition")
    columns = requests.columns
    state = items.select("equipment_id", F.lit(True).alias("known"), ((F.col("status") == "AVAILABLE") & ~F.col("is_deleted")).alias("free"))
    first = requests.groupBy("equipment_id").agg(F.min("request_id").alias("first_request"))
    # Items and first requests have one row per item each; the many requests meet them salted.
    facts = first.join(state, "equipment_id", "left")
    judged = join_on(requests, facts, ["equipment_id"], "left")
    reason = (
        F.when(F.col("known").isNull(), F.lit("Equipment not found"))
        .when(~F.col("free"), F.lit("Equipment is not available for allocation"))
        .when(F.col("request_id") != F.col("first_request"), F.lit("Equipment was given to an earlier request"))
    )
    judged = judged.withColumn("reason", reason)
    rejected = judged.filter(F.col("reason").isNotNull()).select(*columns, "reason")
    granted = judged.filter(F.col("reason").isNull()).select(*columns)
    never = F.lit(None).cast("timestamp")
    allocations = granted.select(
        F.col("request_id").alias("allocation_id"),
        "equipment_id",
        "employee_id",
        "allocated_by_employee_id",
        "purpose",
        as_of.alias("allocated_at"),
        "expected_return_at",
        never.alias("returned_at"),
        F.lit("ACTIVE").alias("status"),
        as_of.alias("created_at"),
        as_of.alias("updated_at"),
        F.lit(False).alias("is_deleted"),
        never.alias("deleted_at"),
    )
    changed = (
        free.join(granted.select("equipment_id"), "equipment_id")
        .withColumn("status", F.lit("ALLOCATED"))
        .withColumn("updated_at", as_of)
    )
    payload = F.to_json(
        F.struct(
            F.lit("ALLOCATED").alias("action"),
            F.col("equipment_id").alias("equipmentId"),
            F.col("employee_id").alias("employeeId"),
            F.col("allocated_by_employee_id").alias("allocatedBy"),
            iso(as_of).alias("allocatedAt"),
        )
    )
    return allocations, changed, outbox_rows(allocations, "INVENTORY_UPDATE", payload, as_of), rejected


def take_back(
    returns: DataFrame, allocations: DataFrame, items: DataFrame, as_of: Column
) -> dict[str, DataFrame]:
    """Returned allocations, changed items, maintenance tickets, outbox events and rejects.

    ``returns`` holds one row per allocation: allocation_id, condition_on_return, return_notes,
    actor_employee_id. A ticket takes the allocation's id, which is unique per return.
    """
    known = allocations.select(
        "allocation_id", "equipment_id", "employee_id", F.col("status").alias("allocation_status")
    )
    # One row per allocation on both sides.
    matched = returns.join(known, "allocation_id", "left")
    present = active(items).select("equipment_id", F.lit(True).alias("item_known"))
    matched = join_on(matched, present, ["equipment_id"], "left")
    reason = (
        F.when(F.col("allocation_status").isNull(), F.lit("Allocation not found"))
        .when(F.col("allocation_status") != "ACTIVE", F.lit("Allocation is not active or already returned"))
        .when(F.col("item_known").isNull(), F.lit("Equipment not found"))
    )
    matched = matched.withColumn("reason", reason)
    good = matched.filter(F.col("reason").isNull())
    damaged = good.filter(F.col("condition_on_return") == "DAMAGED")
    ticket_payload = F.to_json(
        F.struct(
            F.col("equipment_id").alias("equipmentId"),
            F.col("allocation_id").alias("ticketId"),
            F.lit("MEDIUM").alias("severity"),
            iso(as_of).alias("reportedAt"),
        )
    )
    return_payload = F.to_json(
        F.struct(
            F.lit("RETURNED").alias("action"),
            F.col("equipment_id").alias("equipmentId"),
            F.col("employee_id").alias("employeeId"),
            iso(as_of).alias("returnedAt"),
            F.col("condition_on_return").alias("condition"),
        )
    )
    alerts = outbox_rows(damaged, "MAINTENANCE_ALERT", ticket_payload, as_of, F.col("allocation_id"))
    updates = outbox_rows(good, "INVENTORY_UPDATE", return_payload, as_of)
    return {
        "allocations": good.select(
            "allocation_id",
            F.lit("RETURNED").alias("status"),
            as_of.alias("returned_at"),
            "condition_on_return",
            "return_notes",
        ),
        "items": good.select(
            "equipment_id",
            F.when(F.col("condition_on_return") == "DAMAGED", "UNDER_MAINTENANCE").otherwise("AVAILABLE").alias("status"),
            F.col("condition_on_return").alias("condition"),
        ),
        "tickets": damaged.select(
            F.col("allocation_id").alias("ticket_id"),
            "equipment_id",
            "allocation_id",
            as_of.alias("issue_reported_at"),
            F.coalesce("return_notes", F.lit("Equipment returned as DAMAGED")).alias("issue_notes"),
            F.lit("OPEN").alias("status"),
            F.lit("MEDIUM").alias("severity"),
            F.col("actor_employee_id").alias("created_by_employee_id"),
            F.lit(False).alias("is_resolved"),
        ),
        "events": alerts.unionByName(updates),
        "rejected": matched.filter(F.col("reason").isNotNull()).select(*returns.columns, "reason"),
    }


def apply_changes(
    current: DataFrame,
    changes: DataFrame,
    key: str,
    as_of: Column,
    touched: str = "updated_at",
    latest: str | None = None,
    even: bool = False,
) -> DataFrame:
    """Partial update: a null in ``changes`` keeps the old value, a changed row gets the audit time.

    Of several changes of one key the one with the largest ``latest`` counts, then the first by its
    other columns; ``even`` spreads the changes of a key that has very many. This holds for all updates of this module.
    """
    changes = keep_latest(changes, [key], latest, even)
    fields = [c for c in changes.columns if c not in (key, latest)]
    incoming = changes.select(key, F.lit(True).alias("__hit"), *(F.col(c).alias(f"__{c}") for c in fields))
    joined = current.join(incoming, key, "left")
    for name in fields:
        joined = joined.withColumn(name, F.coalesce(F.col(f"__{name}"), F.col(name)))
    joined = joined.withColumn(touched, F.when(F.col("__hit"), as_of).otherwise(F.col(touched)))
    return joined.select(*current.columns)


def _set_on_live_rows(
    rows: DataFrame, changes: DataFrame, key: str, fields: list[str], as_of: Column, latest: str | None, even: bool
) -> DataFrame:
    """Take the fields over as given, nulls too, on rows that are not deleted, with the audit time."""
    one = keep_latest(changes, [key], latest, even)
    out = rows.join(one.select(key, F.struct(*fields).alias("__new")), key, "left")
    hit = F.col("__new").isNotNull() & ~F.col("is_deleted")
    for name in fields:
        out = out.withColumn(name, F.when(hit, F.col(f"__new.{name}")).otherwise(F.col(name)))
    return out.withColumn("updated_at", F.when(hit, as_of).otherwise(F.col("updated_at"))).select(*rows.columns)


def update_ticket_status(
    tickets: DataFrame, changes: DataFrame, as_of: Column, latest: str | None = None, even: bool = False
) -> DataFrame:
    """``changes``: ticket_id, status, is_resolved, resolved_at, each taken over as given. Deleted
    tickets stay as they are."""
    return _set_on_live_rows(tickets, changes, "ticket_id", ["status", "is_resolved", "resolved_at"], as_of, latest, even)


def reassign_tickets(
    tickets: DataFrame, changes: DataFrame, as_of: Column, latest: str | None = None, even: bool = False
) -> DataFrame:
    """``changes``: ticket_id, assigned_to_employee_id; a null takes the ticket from its assignee."""
    return _set_on_live_rows(tickets, changes, "ticket_id", ["assigned_to_employee_id"], as_of, latest, even)


def mark_returned(
    allocations: DataFrame, changes: DataFrame, as_of: Column, latest: str | None = None, even: bool = False
) -> DataFrame:
    """``changes``: allocation_id, returned_at. The listed live allocations become RETURNED at that time."""
    done = changes.withColumn("status", F.lit("RETURNED"))
    return _set_on_live_rows(allocations, done, "allocation_id", ["status", "returned_at"], as_of, latest, even)


def set_deleted(df: DataFrame, ids: DataFrame, key: str, as_of: Column, to_deleted: bool = True) -> DataFrame:
    """Soft delete or restore the listed rows; rows already in that state stay as they are."""
    marked = df.join(ids.select(key).distinct().withColumn("__hit", F.lit(True)), key, "left")
    change = F.coalesce(F.col("__hit"), F.lit(False)) & (F.col("is_deleted") != F.lit(to_deleted))
    deleted_at = as_of if to_deleted else F.lit(None)
    return (
        marked.withColumn("__change", change)
        .withColumn("is_deleted", F.when(F.col("__change"), F.lit(to_deleted)).otherwise(F.col("is_deleted")))
        .withColumn("deleted_at", F.when(F.col("__change"), deleted_at).otherwise(F.col("deleted_at")))
        .withColumn("updated_at", F.when(F.col("__change"), as_of).otherwise(F.col("updated_at")))
        .select(*df.columns)
    )


def replace_children(current: DataFrame, given: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Drop all child rows of the listed parents and put the given ones in their place."""
    kept = join_on(current, parents.select(key).distinct(), [key], "left_anti")
    return kept.unionByName(given)


def settle_outbox(
    events: DataFrame, outcomes: DataFrame, as_of: Column, latest: str | None = None, even: bool = False
) -> DataFrame:
    """``outcomes``: event_id, error. Without an error an event becomes PUBLISHED, with one FAILED;
    events without an outcome stay as they are."""
    outcomes = keep_latest(outcomes, ["event_id"], latest, even)
    joined = events.join(outcomes.select("event_id", F.lit(True).alias("hit"), "error"), "event_id", "left")
    sent = F.col("hit") & F.col("error").isNull()
    lost = F.col("hit") & F.col("error").isNotNull()
    return (
        joined.withColumn("published_at", F.when(sent, as_of).otherwise(F.col("published_at")))
        .withColumn("last_error", F.when(F.col("hit"), F.col("error")).otherwise(F.col("last_error")))
        .withColumn("status", F.when(sent, "PUBLISHED").when(lost, "FAILED").otherwise(F.col("status")))
        .select(*events.columns)
    )
