"""Edge cases of the equipment and task workflows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace.plans import equipment, notifications

NOW = dt.datetime(2024, 3, 1)


def now():
    return F.lit(NOW)


def test_one_item_goes_to_one_request(spark, rows):
    items = spark.createDataFrame(
        [(1, "AVAILABLE", "GOOD", False), (2, "ALLOCATED", "GOOD", False), (3, "AVAILABLE", "GOOD", True)],
        "equipment_id bigint, status string, condition string, is_deleted boolean",
    )
    data = [(10, 1), (9, 1), (11, 2), (12, 3), (13, 4)]
    requests = spark.createDataFrame([(r, e, 5, 6, "p", NOW) for r, e in data],
        "request_id bigint, equipment_id bigint, employee_id bigint, allocated_by_employee_id bigint, purpose string, expected_return_at timestamp")
    granted, changed, events, rejected = equipment.allocate(requests, items, now())
    assert rows(granted, "allocation_id", "equipment_id") == [(9, 1)]
    assert rows(changed, "equipment_id", "status") == [(1, "ALLOCATED")]
    assert json.loads(events.first()["payload"])["action"] == "ALLOCATED"
    assert rows(rejected, "request_id", "reason") == [
        (10, "Equipment was given to an earlier request"),
        (11, "Equipment is not available for allocation"),
        (12, "Equipment is not available for allocation"),
        (13, "Equipment not found"),
    ]


def test_damaged_return_opens_a_ticket(spark, rows):
    items = spark.createDataFrame([(1, False), (2, False)], "equipment_id bigint, is_deleted boolean")
    held = spark.createDataFrame([(10, 1, 5, "ACTIVE"), (11, 2, 5, "RETURNED"), (12, 7, 5, "ACTIVE")],
        "allocation_id bigint, equipment_id bigint, employee_id bigint, status string")
    returns = spark.createDataFrame([(10, "DAMAGED", None, 8), (11, "GOOD", None, 8), (12, "GOOD", None, 8), (99, "GOOD", None, 8)],
        "allocation_id bigint, condition_on_return string, return_notes string, actor_employee_id bigint")
    out = equipment.take_back(returns, held, items, now())
    assert rows(out["items"]) == [(1, "UNDER_MAINTENANCE", "DAMAGED")]
    assert rows(out["tickets"], "equipment_id", "issue_notes", "severity") == [(1, "Equipment returned as DAMAGED", "MEDIUM")]
    assert rows(out["events"], "event_type") == [("INVENTORY_UPDATE",), ("MAINTENANCE_ALERT",)]
    assert rows(out["rejected"], "allocation_id", "reason") == [
        (11, "Allocation is not active or already returned"), (12, "Equipment not found"), (99, "Allocation not found"),
    ]


def test_recipient_with_two_roles_gets_one_message(spark, rows, plan):
    users = spark.createDataFrame(
        [(1, "a@x.co", ["staff"]), (2, "b@x.co", ["ADMIN"]), (3, "a@x.co", ["admin"]), (4, " ", ["admin"])],
        "user_id bigint, email string, roles array<string>",
    )
    asked = spark.createDataFrame([(100, 1, 2), (101, 2, None)], "event_id bigint, x bigint, y bigint")
    got = notifications.expand_recipients(asked, [("Assignee", "x"), ("AllocatedBy", "y")], users, ["event_id"])
    assert rows(got, "event_id", "email", "role") == [
        (100, "a@x.co", "Assignee"), (100, "b@x.co", "AllocatedBy"), (101, "a@x.co", "Admin"), (101, "b@x.co", "Assignee"),
    ]
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def tasks(spark, start):
    return spark.createDataFrame(
        [(1, 7, "Paint", start, 3, 4)],
        "task_id bigint, event_id bigint, title string, estimated_start timestamp, assigned_to_user_id bigint, assigned_team_id bigint",
    )


NO_NOTES = "task_id bigint, notification_type string, status string, is_deleted boolean"


def test_reminders_ahead_of_a_start(spark, rows):
    none = spark.createDataFrame([], NO_NOTES)
    for start, expected in (
        (NOW + dt.timedelta(days=2), ["REMINDER_1DAY", "REMINDER_HOURS", "TASK_ASSIGNED"]),
        (NOW + dt.timedelta(hours=10), ["REMINDER_HOURS", "TASK_ASSIGNED"]),
        (NOW + dt.timedelta(hours=3), ["TASK_ASSIGNED"]),
        (None, []),
    ):
        got = notifications.plan_reminders(tasks(spark, start), none, now())
        assert [r[0] for r in rows(got, "notification_type")] == expected


def test_pending_types_are_not_planned_again(spark, rows):
    pending = spark.createDataFrame(
        [(1, "REMINDER_1DAY", "pending", False), (1, "REMINDER_HOURS", "pending", True), (1, "TASK_ASSIGNED", "sent", False)], NO_NOTES
    )
    got = notifications.plan_reminders(tasks(spark, NOW + dt.timedelta(days=2)), pending, now())
    assert rows(got, "notification_type") == [("REMINDER_HOURS",), ("TASK_ASSIGNED",)]


def test_backoff_and_alert(spark, rows):
    failed = spark.createDataFrame(
        [(1, 5, 0, None), (2, 5, 2, None), (3, 5, 4, "no route"), (4, None, 4, None)],
        "notification_id bigint, task_id bigint, attempts int, reason string",
    )
    again, alerts = notifications.retry_failed(failed, now())
    assert rows(again, "notification_id", "attempts", "scheduled_for") == [
        (1, 1, NOW + dt.timedelta(minutes=1)), (2, 3, NOW + dt.timedelta(minutes=4)),
    ]
    assert rows(alerts, "replaces_id", "message") == [
        (3, "Issue Alert: Notification for task 5 failed after 5 attempts. no route"),
        (4, "Issue Alert: Notification for task -1 failed after 5 attempts."),
    ]


def test_delivery(spark, rows):
    schema = "notification_id bigint, attempts int, status string, sent_at timestamp"
    df = spark.createDataFrame([(1, 0, "pending", None), (2, 2, "pending", None), (3, 0, "pending", None)], schema)
    outcomes = spark.createDataFrame([(1, True), (2, False)], "notification_id bigint, delivered boolean")
    assert rows(notifications.record_delivery(df, outcomes, now())) == [(1, 0, "sent", NOW), (2, 3, "failed", None), (3, 0, "pending", None)]


def test_of_repeated_changes_the_latest_counts(spark, rows):
    schema = "notification_id bigint, attempts int, status string, sent_at timestamp"
    df = spark.createDataFrame([(1, 0, "pending", None)], schema)
    twice = spark.createDataFrame([(1, True, 1), (1, False, 2)], "notification_id bigint, delivered boolean, at int")
    assert rows(notifications.record_delivery(df, twice, now(), latest="at")) == [(1, 1, "pending", None)]
    tickets = spark.createDataFrame([(1, 5, False, NOW), (2, 5, True, NOW)],
        "ticket_id bigint, assigned_to_employee_id bigint, is_deleted boolean, updated_at timestamp")
    moves = spark.createDataFrame([(1, 8, 1), (1, None, 2), (2, 9, 1)], "ticket_id bigint, assigned_to_employee_id bigint, at int")
    moved = equipment.reassign_tickets(tickets, moves, now(), latest="at")
    assert rows(moved, "ticket_id", "assigned_to_employee_id") == [(1, None), (2, 5)]
    titles = spark.createDataFrame([(1, "old", NOW)], "id bigint, title string, updated_at timestamp")
    change = spark.createDataFrame([(1, "b", 2), (1, "a", 1)], "id bigint, title string, at int")
    assert rows(equipment.apply_changes(titles, change, "id", now(), latest="at"), "id", "title") == [(1, "b")]


def test_mark_returned(spark, rows):
    held = spark.createDataFrame([(1, "ACTIVE", None, False, None), (2, "ACTIVE", None, True, None)],
        "allocation_id bigint, status string, returned_at timestamp, is_deleted boolean, updated_at timestamp")
    back = spark.createDataFrame([(1, NOW), (1, NOW), (2, NOW), (3, NOW)], "allocation_id bigint, returned_at timestamp")
    got = rows(equipment.mark_returned(held, back, now()), "allocation_id", "status", "returned_at")
    assert got == [(1, "RETURNED", NOW), (2, "ACTIVE", None)]


def test_outbox(spark, rows):
    schema = "event_id bigint, status string, published_at timestamp, last_error string"
    old = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "PENDING", None, None), (2, "PENDING", old, None), (3, "FAILED", None, "x"), (4, "PENDING", None, None)], schema)
    outcomes = spark.createDataFrame([(1, None), (2, "boom"), (3, None)], "event_id bigint, error string")
    assert rows(equipment.settle_outbox(df, outcomes, now())) == [
        (1, "PUBLISHED", NOW, None), (2, "FAILED", old, "boom"), (3, "PUBLISHED", NOW, None), (4, "PENDING", None, None),
    ]


def test_addresses(spark, rows):
    notes = spark.createDataFrame([(1, 1, 5), (2, 9, 5), (3, None, 5), (4, None, 6), (5, None, 7), (6, None, None), (7, 9, None)],
        "notification_id bigint, recipient_user_id bigint, recipient_team_id bigint")
    users = spark.createDataFrame([(1, "u@x.co")], "user_id bigint, email string")
    teams = spark.createDataFrame([(5, "t@x.co", False), (6, None, False), (7, "gone@x.co", True)],
        "team_id bigint, contact_email string, is_deleted boolean")
    got = rows(notifications.recipient_address(notes, users, teams), "notification_id", "email")
    assert got == [
        (1, "u@x.co"), (2, "team-5@example.com"), (3, "t@x.co"), (4, "team-6@example.com"), (5, "team-7@example.com"),
        (6, "no-reply@example.com"), (7, "no-reply@example.com"),
    ]


def test_soft_delete_only_from_the_other_state(spark, rows):
    schema = "id bigint, is_deleted boolean, deleted_at timestamp, updated_at timestamp"
    old = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, False, None, old), (2, True, old, old), (3, False, None, old)], schema)
    ids = spark.createDataFrame([(1,), (2,)], "id bigint")
    assert rows(equipment.set_deleted(df, ids, "id", now())) == [(1, True, NOW, NOW), (2, True, old, old), (3, False, None, old)]
    assert rows(equipment.set_deleted(df, ids, "id", now(), to_deleted=False)) == [(1, False, None, old), (2, False, None, NOW), (3, False, None, old)]


def test_admins_are_added_where_the_rows_of_a_message_have_met(spark, rows, plan):
    staff = [(i, f"admin{i // 2}@x.co", ["Admin"]) for i in range(10, 40)] + [(1, "a@x.co", ["staff"]), (2, " admin5@x.co", None), (3, None, ["admin"])]
    users = spark.createDataFrame(staff, "user_id bigint, email string, roles array<string>")
    asked = spark.createDataFrame(
        [(100, 1, "t"), (100, 1, "s"), (101, 2, "t"), (None, None, "t"), (102, 99, "t")], "event_id bigint, x bigint, text string"
    )
    got = notifications.expand_recipients(asked, [("Assignee", "x")], users, ["event_id"], carried=["text"])
    want = [(event, f"admin{k}@x.co", "Admin", 2 * k, text) for event, text in ((100, "s"), (101, "t"), (None, "t"), (102, "t")) for k in range(5, 20)]
    want.remove((101, "admin5@x.co", "Admin", 10, "t"))
    want += [(100, "a@x.co", "Assignee", 1, "s"), (101, "admin5@x.co", "Assignee", 2, "t")]
    assert rows(got, "event_id", "email", "role", "user_id", "text") == sorted(want, key=repr)
    # What moves by message are the rows of the roles and one for the admins, not one per admin.
    moved = [line for line in plan(got).splitlines() if "Arguments: hashpartitioning(event_id" in line]
    assert moved and not any("email" in line for line in moved)
