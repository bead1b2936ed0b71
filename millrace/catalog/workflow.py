"""Equipment and task workflows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import frames
from millrace.catalog.frames import AS_OF, EVENTS_AS_OF, at, table
from millrace.catalog.registry import big, dbl, query, sql_stamp, stamp
from millrace.plans import equipment, messages, notifications

LATE = f"SELECT * FROM ({frames.ALLOCATIONS}) WHERE NOT is_deleted AND status = 'ACTIVE' AND returned_at IS NULL AND expected_return_at < TIMESTAMP '{AS_OF}'"
ISO = "%Y-%m-%dT%H:%M:%SZ"
NOW_ISO = AS_OF.replace(" ", "T") + "Z"
OVERDUE_JSON = f"""'{{"eventType":"OVERDUE_REMINDER","allocationId":' || allocation_id || ',"equipmentId":' || equipment_id ||
',"employeeId":' || employee_id || ',"expectedReturnAt":"' || strftime(expected_return_at, '{ISO}') || '","notifiedAt":"{NOW_ISO}"}}'"""


@query(f"SELECT allocation_id, 'OVERDUE' AS status, '{AS_OF}' AS updated_at FROM ({LATE})")
def escalated_allocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    updated, _, _ = equipment.escalate_overdue(frames.allocations(spark, sf_dir), at())
    return updated.select("allocation_id", "status", stamp("updated_at").alias("updated_at"))


@query(f"""
SELECT allocation_id, '{AS_OF}' AS notified_at, 'FIRST' AS reminder_type, employee_id AS recipient_employee_id, 'EMAIL' AS channel
FROM ({LATE})""")
def escalation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, log, _ = equipment.escalate_overdue(frames.allocations(spark, sf_dir), at())
    return log.withColumn("notified_at", stamp("notified_at"))


@query(f"SELECT 'REMINDER' AS event_type, allocation_id, {OVERDUE_JSON} AS payload, 'PENDING' AS status FROM ({LATE})")
def escalation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, events = equipment.escalate_overdue(frames.allocations(spark, sf_dir), at())
    return events.select("event_type", "allocation_id", "payload", "status")


@query(f"SELECT 'OVERDUE_REMINDER' AS event_type, allocation_id, {OVERDUE_JSON} AS payload, 'PENDING' AS status FROM ({LATE})")
def overdue_reminder_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = equipment.overdue_reminders(frames.allocations(spark, sf_dir), at())
    return events.select("event_type", "allocation_id", "payload", "status")


# Every order line wants its part; customers stand for both people.
REQUESTS = """
SELECT o_orderkey AS request_id, equipment_id, o_custkey AS employee_id, by_id AS allocated_by_employee_id
FROM orders JOIN (SELECT l_orderkey, min(l_partkey) + CASE WHEN max(l_returnflag) = 'A' THEN 1000000000 ELSE 0 END AS equipment_id,
                         min(l_suppkey) AS by_id FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"""
JUDGED = f"""
SELECT r.*, CASE WHEN i.equipment_id IS NULL THEN 'Equipment not found'
  WHEN i.status <> 'AVAILABLE' OR i.is_deleted THEN 'Equipment is not available for allocation'
  WHEN request_id <> min(request_id) OVER (PARTITION BY r.equipment_id) THEN 'Equipment was given to an earlier request' END AS reason
FROM ({REQUESTS}) r LEFT JOIN ({frames.ITEMS}) i ON i.equipment_id = r.equipment_id"""


def _allocate(spark: SparkSession, sf_dir: str):
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        (F.min("l_partkey") + F.when(F.max("l_returnflag") == "A", 1_000_000_000).otherwise(0)).alias("equipment_id"),
        F.min("l_suppkey").alias("allocated_by_employee_id"),
    )
    requests = table(spark, sf_dir, "orders").join(lines, "o_orderkey").select(
        F.col("o_orderkey").alias("request_id"),
        "equipment_id",
        F.col("o_custkey").alias("employee_id"),
        "allocated_by_employee_id",
        F.col("o_orderpriority").alias("purpose"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("expected_return_at"),
    )
    return equipment.allocate(requests, frames.items(spark, sf_dir), at())


@query(f"SELECT request_id AS allocation_id, equipment_id, employee_id, 'ACTIVE' AS status FROM ({JUDGED}) WHERE reason IS NULL")
def granted_allocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    granted, _, _, _ = _allocate(spark, sf_dir)
    return granted.select("allocation_id", "equipment_id", "employee_id", "status")


@query(f"SELECT reason, count(*) AS n, count(DISTINCT equipment_id) AS items FROM ({JUDGED}) WHERE reason IS NOT NULL GROUP BY 1")
def rejected_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, _, rejected = _allocate(spark, sf_dir)
    return rejected.groupBy("reason").agg(F.count("*").alias("n"), F.countDistinct("equipment_id").alias("items"))


@query(f"SELECT equipment_id, 'ALLOCATED' AS status, 'GOOD' AS condition FROM ({JUDGED}) WHERE reason IS NULL")
def items_after_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, changed, _, _ = _allocate(spark, sf_dir)
    return changed.select("equipment_id", "status", "condition")


@query(f"""
SELECT request_id AS allocation_id, '{{"action":"ALLOCATED","equipmentId":' || equipment_id || ',"employeeId":' || employee_id ||
  ',"allocatedBy":' || allocated_by_employee_id || ',"allocatedAt":"{NOW_ISO}"}}' AS payload
FROM ({JUDGED}) WHERE reason IS NULL""")
def allocation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, events, _ = _allocate(spark, sf_dir)
    return events.select("allocation_id", "payload")


RETURNS = f"""
SELECT a.allocation_id, a.equipment_id, a.employee_id, a.allocated_by_employee_id AS actor,
       CASE WHEN purpose IN ('1-URGENT', '2-HIGH') THEN 'DAMAGED' ELSE 'GOOD' END AS condition_on_return,
       CASE WHEN purpose = '1-URGENT' THEN 'broken by ' || employee_id END AS return_notes,
       CASE WHEN a.status <> 'ACTIVE' THEN 'Allocation is not active or already returned'
            WHEN i.equipment_id IS NULL THEN 'Equipment not found' END AS reason
FROM ({frames.ALLOCATIONS}) a LEFT JOIN (SELECT * FROM ({frames.ITEMS}) WHERE NOT is_deleted) i ON i.equipment_id = a.equipment_id"""


def _take_back(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    held = frames.allocations(spark, sf_dir)
    returns = held.select(
        "allocation_id",
        F.when(F.col("purpose").isin("1-URGENT", "2-HIGH"), "DAMAGED").otherwise("GOOD").alias("condition_on_return"),
        F.when(F.col("purpose") == "1-URGENT", F.concat(F.lit("broken by "), F.col("employee_id"))).alias("return_notes"),
        F.col("allocated_by_employee_id").alias("actor_employee_id"),
    )
    return equipment.take_back(returns, held, frames.items(spark, sf_dir), at())


@query(f"""
SELECT allocation_id, 'RETURNED' AS status, '{AS_OF}' AS returned_at, condition_on_return, return_notes FROM ({RETURNS}) WHERE reason IS NULL""")
def returned_allocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _take_back(spark, sf_dir)["allocations"]
    return done.withColumn("returned_at", stamp("returned_at"))


@query(f"""
SELECT status, condition, count(*) AS n, count(DISTINCT equipment_id) AS items FROM (
  SELECT equipment_id, CASE condition_on_return WHEN 'DAMAGED' THEN 'UNDER_MAINTENANCE' ELSE 'AVAILABLE' END AS status,
         condition_on_return AS condition FROM ({RETURNS}) WHERE reason IS NULL) GROUP BY ALL""")
def items_after_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = _take_back(spark, sf_dir)["items"]
    return changed.groupBy("status", "condition").agg(F.count("*").alias("n"), F.countDistinct("equipment_id").alias("items"))


@query(f"""
SELECT allocation_id AS ticket_id, equipment_id, coalesce(return_notes, 'Equipment returned as DAMAGED') AS issue_notes,
       'OPEN' AS status, 'MEDIUM' AS severity, actor AS created_by_employee_id
FROM ({RETURNS}) WHERE reason IS NULL AND condition_on_return = 'DAMAGED'""")
def tickets_from_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _take_back(spark, sf_dir)["tickets"]
    return made.select("ticket_id", "equipment_id", "issue_notes", "status", "severity", "created_by_employee_id")


@query(f"""
SELECT 'MAINTENANCE_ALERT' AS event_type, allocation_id, '{{"equipmentId":' || equipment_id || ',"ticketId":' || allocation_id ||
  ',"severity":"MEDIUM","reportedAt":"{NOW_ISO}"}}' AS payload
FROM ({RETURNS}) WHERE reason IS NULL AND condition_on_return = 'DAMAGED'
UNION ALL
SELECT 'INVENTORY_UPDATE', allocation_id, '{{"action":"RETURNED","equipmentId":' || equipment_id || ',"employeeId":' || employee_id ||
  ',"returnedAt":"{NOW_ISO}","condition":"' || condition_on_return || '"}}'
FROM ({RETURNS}) WHERE reason IS NULL""")
def return_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _take_back(spark, sf_dir)["events"].select("event_type", "allocation_id", "payload")


@query(f"SELECT reason, count(*) AS n FROM ({RETURNS}) WHERE reason IS NOT NULL GROUP BY 1")
def rejected_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _take_back(spark, sf_dir)["rejected"].groupBy("reason").agg(F.count("*").alias("n"))


@query(f"""
SELECT ticket_id, CASE WHEN hit THEN 'RESOLVED' ELSE status END AS status, CASE WHEN hit THEN true ELSE is_resolved END AS is_resolved,
       CASE WHEN hit THEN '{AS_OF}' ELSE {sql_stamp('resolved_at')} END AS resolved_at,
       CASE WHEN hit THEN '{AS_OF}' ELSE {sql_stamp('updated_at')} END AS updated_at
FROM (SELECT *, severity = 'HIGH' AND NOT is_deleted AS hit FROM ({frames.TICKETS}))""")
def ticket_status_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = frames.tickets(spark, sf_dir)
    changes = tickets.filter(F.col("severity") == "HIGH").select(
        "ticket_id", F.lit("RESOLVED").alias("status"), F.lit(True).alias("is_resolved"), at().alias("resolved_at")
    )
    updated = equipment.update_ticket_status(tickets, changes, at())
    return updated.select(
        "ticket_id", "status", "is_resolved", stamp("resolved_at").alias("resolved_at"), stamp("updated_at").alias("updated_at")
    )


@query(f"""
SELECT ticket_id, CASE WHEN hit THEN CASE WHEN severity = 'HIGH' THEN created_by_employee_id END ELSE assigned_to_employee_id END AS assigned_to,
       CASE WHEN hit THEN '{AS_OF}' ELSE {sql_stamp('updated_at')} END AS updated_at
FROM (SELECT *, status = 'OPEN' AND NOT is_deleted AS hit FROM ({frames.TICKETS}))""")
def reassigned_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open tickets of high severity go to whoever reported them, the others back to nobody. Each
    change comes twice, the older one with somebody else."""
    tickets = frames.tickets(spark, sf_dir)
    to = F.when(F.col("severity") == "HIGH", F.col("created_by_employee_id")).alias("assigned_to_employee_id")
    asked = tickets.filter(F.col("status") == "OPEN")
    newer = asked.select("ticket_id", to, F.lit(2).alias("asked"))
    older = asked.select("ticket_id", F.lit(-1).cast("bigint").alias("assigned_to_employee_id"), F.lit(1).alias("asked"))
    moved = equipment.reassign_tickets(tickets, newer.unionByName(older), at(), latest="asked")
    return moved.select("ticket_id", F.col("assigned_to_employee_id").alias("assigned_to"), stamp("updated_at").alias("updated_at"))


@query(f"""
SELECT allocation_id, CASE WHEN hit THEN 'RETURNED' ELSE status END AS status,
       CASE WHEN hit THEN {sql_stamp('expected_return_at')} ELSE {sql_stamp('returned_at')} END AS returned_at,
       CASE WHEN hit THEN '{AS_OF}' ELSE {sql_stamp('updated_at')} END AS updated_at
FROM (SELECT *, status = 'ACTIVE' AND NOT is_deleted AS hit FROM ({frames.ALLOCATIONS}))""")
def allocations_marked_returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.allocations(spark, sf_dir)
    done = rows.filter(F.col("status") == "ACTIVE").select("allocation_id", F.col("expected_return_at").alias("returned_at"))
    marked = equipment.mark_returned(rows, done, at())
    return marked.select("allocation_id", "status", stamp("returned_at").alias("returned_at"), stamp("updated_at").alias("updated_at"))


@query(f"""
SELECT task_id, title || CASE WHEN hit THEN ' (moved)' ELSE '' END AS title, CASE WHEN hit AND status = 'Pending' THEN 'Blocked' ELSE status END AS status,
       CASE WHEN hit THEN '{AS_OF}' ELSE {sql_stamp('estimated_end')} END AS estimated_end
FROM (SELECT *, assigned_team_id IS NOT NULL AS hit FROM ({frames.TASKS}))""")
def partial_task_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = frames.tasks(spark, sf_dir)
    changes = tasks.filter(F.col("assigned_team_id").isNotNull()).select(
        "task_id",
        F.concat(F.col("title"), F.lit(" (moved)")).alias("title"),
        F.when(F.col("status") == "Pending", "Blocked").alias("status"),
    )
    updated = equipment.apply_changes(tasks, changes, "task_id", at(), touched="estimated_end")
    return updated.select("task_id", "title", "status", stamp("estimated_end").alias("estimated_end"))


LISTED = "allocation_id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '3-MEDIUM')"


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "3-MEDIUM")
    return chosen.select(F.col("o_orderkey").alias("allocation_id"))


@query(f"""
SELECT allocation_id, is_deleted OR ({LISTED}) AS is_deleted,
       CASE WHEN ({LISTED}) AND NOT is_deleted THEN '{AS_OF}' ELSE {sql_stamp('deleted_at')} END AS deleted_at,
       CASE WHEN ({LISTED}) AND NOT is_deleted THEN '{AS_OF}' ELSE {sql_stamp('updated_at')} END AS updated_at
FROM ({frames.ALLOCATIONS})""")
def soft_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = equipment.set_deleted(frames.allocations(spark, sf_dir), _listed(spark, sf_dir), "allocation_id", at())
    return out.select("allocation_id", "is_deleted", stamp("deleted_at").alias("deleted_at"), stamp("updated_at").alias("updated_at"))


@query(f"""
SELECT allocation_id, is_deleted AND NOT ({LISTED}) AS is_deleted,
       CASE WHEN ({LISTED}) THEN NULL ELSE {sql_stamp('deleted_at')} END AS deleted_at,
       CASE WHEN ({LISTED}) AND is_deleted THEN '{AS_OF}' ELSE {sql_stamp('updated_at')} END AS updated_at
FROM ({frames.ALLOCATIONS})""")
def restores(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = equipment.set_deleted(
        frames.allocations(spark, sf_dir), _listed(spark, sf_dir), "allocation_id", at(), to_deleted=False
    )
    return out.select("allocation_id", "is_deleted", stamp("deleted_at").alias("deleted_at"), stamp("updated_at").alias("updated_at"))


@query("""
SELECT DISTINCT l_suppkey AS user_id, l_returnflag AS role FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 2000)
UNION ALL SELECT s_suppkey, 'probation' FROM supplier WHERE s_acctbal < 2000""")
def replaced_child_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    roles = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("user_id"), F.col("l_returnflag").alias("role")).distinct()
    poor = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") < 2000).select(F.col("s_suppkey").alias("user_id"))
    return equipment.replace_children(roles, poor.withColumn("role", F.lit("probation")), poor, "user_id")


STARTS = f"SELECT * FROM ({frames.TASKS}) WHERE estimated_start IS NOT NULL"
PLANNED = f"""
SELECT task_id, 'REMINDER_1DAY' AS notification_type, 'Reminder: Task ''' || title || ''' starts in 1 day' AS message,
       estimated_start - INTERVAL 1 DAY AS due_at FROM ({STARTS}) WHERE estimated_start - INTERVAL 1 DAY > TIMESTAMP '{AS_OF}'
UNION ALL
SELECT task_id, 'REMINDER_HOURS', 'Reminder: Task ''' || title || ''' starts in a few hours', estimated_start - INTERVAL 3 HOUR
FROM ({STARTS}) WHERE estimated_start - INTERVAL 3 HOUR > TIMESTAMP '{AS_OF}'
UNION ALL
SELECT task_id, 'TASK_ASSIGNED', 'You have been assigned task ''' || title || ''' for event ' || event_id, TIMESTAMP '{AS_OF}' FROM ({STARTS})"""
NOT_PENDING = f"""NOT EXISTS (SELECT 1 FROM ({frames.NOTIFICATIONS}) n WHERE n.task_id = p.task_id
  AND n.notification_type = p.notification_type AND n.status = 'pending' AND NOT n.is_deleted)"""


@query(f"SELECT task_id, notification_type, message, {sql_stamp('due_at')} AS scheduled_for FROM ({PLANNED}) p WHERE {NOT_PENDING}")
def planned_reminders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = notifications.plan_reminders(frames.tasks(spark, sf_dir), frames.notifications(spark, sf_dir), at())
    return rows.select("task_id", "notification_type", "message", stamp("scheduled_for").alias("scheduled_for"))


@query(f"""
SELECT task_id, 'Reminder: Task ''' || title || ''' scheduled at ' || strftime(estimated_start, '{ISO}') AS message,
       {sql_stamp('due_at')} AS scheduled_for
FROM (SELECT *, unnest([estimated_start - INTERVAL 24 HOUR, estimated_start - INTERVAL 3 HOUR]) AS due_at FROM ({STARTS}))
WHERE due_at > TIMESTAMP '{AS_OF}'""")
def planned_simple_reminders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = notifications.plan_simple_reminders(frames.tasks(spark, sf_dir), at())
    return rows.select("task_id", "message", stamp("scheduled_for").alias("scheduled_for"))


@query(f"""
SELECT task_id, recipient_user_id, message FROM (
  SELECT task_id, CAST(assigned_to_user_id AS DOUBLE) AS recipient_user_id, 'OVERDUE' AS notification_type,
         'Overdue: Task ''' || title || ''' is overdue (expected end ' || strftime(estimated_end, '{ISO}') || ')' AS message
  FROM ({frames.TASKS}) WHERE NOT is_deleted AND status <> 'Completed' AND estimated_end < TIMESTAMP '{AS_OF}') p WHERE {NOT_PENDING}""")
def planned_overdue_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = notifications.plan_overdue(frames.tasks(spark, sf_dir), frames.notifications(spark, sf_dir), at())
    return rows.select("task_id", dbl("recipient_user_id").alias("recipient_user_id"), "message")


OUTCOME = """CASE WHEN notification_type IN ('REMINDER_1DAY', 'TASK_ASSIGNED') THEN true
WHEN notification_type <> 'reminder' THEN false END"""


@query(f"""
SELECT notification_id, CASE WHEN ok THEN 'sent' WHEN NOT ok AND attempts + 1 >= 3 THEN 'failed' ELSE status END AS status,
       CAST(attempts + CASE WHEN NOT ok THEN 1 ELSE 0 END AS BIGINT) AS attempts,
       CASE WHEN ok THEN '{EVENTS_AS_OF}' ELSE {sql_stamp('sent_at')} END AS sent_at
FROM (SELECT *, {OUTCOME} AS ok FROM ({frames.NOTIFICATIONS}))""")
def delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.notifications(spark, sf_dir)
    kind = F.col("notification_type")
    delivered = F.when(kind.isin("REMINDER_1DAY", "TASK_ASSIGNED"), True).when(kind != "reminder", False)
    outcomes = rows.select("notification_id", delivered.alias("delivered")).filter(F.col("delivered").isNotNull())
    done = notifications.record_delivery(rows, outcomes, at(EVENTS_AS_OF))
    return done.select("notification_id", "status", big("attempts").alias("attempts"), stamp("sent_at").alias("sent_at"))


FAILED = f"SELECT *, CASE WHEN notification_type = 'OVERDUE' THEN 'mailbox full' END AS reason FROM ({frames.NOTIFICATIONS}) WHERE status = 'pending' AND NOT is_deleted"


def _retry(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    waiting = frames.notifications(spark, sf_dir).filter((F.col("status") == "pending") & ~F.col("is_deleted"))
    failed = waiting.withColumn("reason", F.when(F.col("notification_type") == "OVERDUE", "mailbox full"))
    return notifications.retry_failed(failed, at(EVENTS_AS_OF))


@query(f"""
SELECT notification_id, CAST(attempts + 1 AS BIGINT) AS attempts,
       {sql_stamp(f"TIMESTAMP '{EVENTS_AS_OF}' + to_minutes(CAST(pow(2, attempts) AS BIGINT))")} AS scheduled_for
FROM ({FAILED}) WHERE attempts + 1 < 5""")
def retries_with_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    again, _ = _retry(spark, sf_dir)
    return again.select("notification_id", big("attempts").alias("attempts"), stamp("scheduled_for").alias("scheduled_for"))


@query(f"""
SELECT notification_id AS replaces_id, 'issue_alert' AS notification_type,
       trim('Issue Alert: Notification for task ' || task_id || ' failed after ' || (attempts + 1) || ' attempts. ' || coalesce(reason, '')) AS message
FROM ({FAILED}) WHERE attempts + 1 >= 5""")
def issue_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, alerts = _retry(spark, sf_dir)
    return alerts.select("replaces_id", "notification_type", "message")


@query(f"""
SELECT notification_id FROM ({frames.NOTIFICATIONS}) WHERE status = 'pending' AND NOT is_deleted
  AND (scheduled_for IS NULL OR scheduled_for <= TIMESTAMP '2024-01-01 12:00:00') ORDER BY created_at, notification_id LIMIT 60""")
def due_of_oldest_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = notifications.due_of_oldest(frames.notifications(spark, sf_dir), at("2024-01-01 12:00:00"), 60)
    return found.select("notification_id")


@query(f"""
SELECT notification_id, CASE WHEN u.email IS NOT NULL THEN u.email
  WHEN n.recipient_user_id IS NULL AND t.contact_email IS NOT NULL THEN t.contact_email
  WHEN n.recipient_team_id IS NOT NULL THEN 'team-' || n.recipient_team_id || '@example.com' ELSE 'no-reply@example.com' END AS email
FROM ({frames.NOTIFICATIONS}) n LEFT JOIN ({frames.USERS}) u ON u.user_id = n.recipient_user_id
LEFT JOIN (SELECT * FROM ({frames.TEAMS}) WHERE NOT is_deleted) t ON t.team_id = n.recipient_team_id""")
def recipient_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    addressed = notifications.recipient_address(
        frames.notifications(spark, sf_dir), frames.users(spark, sf_dir), frames.teams(spark, sf_dir)
    )
    return addressed.select("notification_id", "email")


def first_per_mail(candidates: str) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id, email ORDER BY priority, user_id) AS rn FROM ({candidates})) WHERE rn = 1"""


ADMINS = f"SELECT user_id, email FROM ({frames.USERS}) WHERE len(list_filter(roles, lambda r: lower(r) = 'admin')) > 0"
OVERDUE_PEOPLE = first_per_mail(f"""
SELECT allocation_id AS event_id, 0 AS priority, 'Assignee' AS role, user_id, email FROM ({LATE}) JOIN ({frames.USERS}) ON user_id = employee_id
UNION ALL SELECT allocation_id, 1, 'AllocatedBy', user_id, email FROM ({LATE}) JOIN ({frames.USERS}) ON user_id = allocated_by_employee_id
UNION ALL SELECT allocation_id, 2, 'Admin', user_id, email FROM ({LATE}), ({ADMINS})""")


@query(f"SELECT event_id, email, role, user_id FROM ({OVERDUE_PEOPLE})")
def recipients_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators.rows import overdue_allocations

    late = overdue_allocations(frames.allocations(spark, sf_dir), at())
    asked = late.select(F.col("allocation_id").alias("event_id"), "employee_id", "allocated_by_employee_id")
    roles = [("Assignee", "employee_id"), ("AllocatedBy", "allocated_by_employee_id")]
    return notifications.expand_recipients(asked, roles, frames.users(spark, sf_dir), ["event_id"])


@query(f"""
SELECT r.event_id, r.email, r.role, '[Reminder] Allocation #' || r.event_id AS subject,
       'Equipment: ' || asset_tag || ' / SN:' || serial_number || ' (id=' || l.equipment_id || '); expected return: ' ||
       strftime(l.expected_return_at, '{ISO}') AS body
FROM ({OVERDUE_PEOPLE}) r JOIN ({LATE}) l ON l.allocation_id = r.event_id JOIN ({frames.ITEMS}) i ON i.equipment_id = l.equipment_id""")
def overdue_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = frames.allocations(spark, sf_dir)
    events = equipment.overdue_reminders(held, at()).select(F.col("allocation_id").alias("event_id"), "payload")
    return messages.overdue_messages(
        events, held, frames.items(spark, sf_dir), frames.employees(spark, sf_dir), frames.users(spark, sf_dir)
    )


HOLDINGS = f"""
SELECT allocation_id AS event_id, employee_id, allocated_by_employee_id, equipment_id, status,
       CASE status WHEN 'ACTIVE' THEN 'CREATE' WHEN 'RETURNED' THEN 'RETURN' ELSE 'DAMAGED' END AS event_type
FROM ({frames.ALLOCATIONS}) WHERE NOT is_deleted"""
HOLDERS = first_per_mail(f"""
SELECT event_id, 0 AS priority, 'Assignee' AS role, user_id, email FROM ({HOLDINGS}) JOIN ({frames.USERS}) ON user_id = employee_id
UNION ALL SELECT event_id, 1, 'AllocatedBy', user_id, email FROM ({HOLDINGS}) JOIN ({frames.USERS}) ON user_id = allocated_by_employee_id
UNION ALL SELECT event_id, 2, 'Admin', user_id, email FROM ({HOLDINGS}), ({ADMINS})""")


@query(f"""
SELECT r.event_id, r.email, r.role, CASE
  WHEN role = 'Assignee' AND event_type = 'CREATE' THEN '[Allocation Assigned] Allocation #' || r.event_id || ' - ' || asset_tag
  WHEN role = 'AllocatedBy' AND event_type = 'CREATE' THEN '[Allocation Created] Allocation #' || r.event_id
  WHEN role <> 'Admin' AND event_type = 'RETURN' THEN '[Allocation Returned] Allocation #' || r.event_id
  WHEN role = 'Admin' AND event_type = 'DAMAGED' THEN '[Maintenance Alert] Allocation #' || r.event_id
  ELSE '[Allocation Notification] Allocation #' || r.event_id END AS subject
FROM ({HOLDERS}) r JOIN ({HOLDINGS}) h ON h.event_id = r.event_id JOIN ({frames.ITEMS}) i ON i.equipment_id = h.equipment_id""")
def allocation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = frames.allocations(spark, sf_dir)
    status = F.col("status")
    kind = F.when(status == "ACTIVE", "CREATE").when(status == "RETURNED", "RETURN").otherwise("DAMAGED")
    payload = F.concat(F.lit('{"allocationId":'), F.col("allocation_id"), F.lit("}"))
    events = held.filter(~F.col("is_deleted")).select(F.col("allocation_id").alias("event_id"), kind.alias("event_type"), payload.alias("payload"))
    rows = messages.allocation_messages(
        events, held, frames.items(spark, sf_dir), frames.employees(spark, sf_dir), frames.users(spark, sf_dir)
    )
    return rows.select("event_id", "email", "role", "subject")


@query(f"""
SELECT event_id, unnest(list_distinct(['u' || user_id || '@example.com', 'desk@example.com'])) AS email, '[Reminder] ' || event_type AS subject
FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, 'u' || user_id || '@example.com', '[Reminder] ' || event_type FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, email, '[Reminder] ' || event_type FROM events, ({ADMINS}) WHERE event_type IN ('signup', 'error')""")
def reminder_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, mail = F.col("event_type"), F.concat(F.lit("u"), F.col("user_id"), F.lit("@example.com"))
    payload = (
        F.when(kind == "click", F.concat(F.lit('{"emails":[" '), mail, F.lit('","desk@example.com","'), mail, F.lit('",""]}')))
        .when(kind == "view", F.concat(F.lit('{"email":"'), mail, F.lit('"}')))
        .when(kind == "purchase", F.concat(F.lit('{"allocationId":'), F.col("event_id"), F.lit("}")))
        .otherwise("{}")
    )
    events = table(spark, sf_dir, "events").select("event_id", "event_type", payload.alias("payload"))
    return messages.reminder_messages(events, frames.users(spark, sf_dir))


PLANNER = "SELECT o_orderkey AS event_id, o_custkey AS created_by, o_orderkey % 1000 AS actor, CASE o_orderstatus WHEN 'F' THEN 'DELETE' WHEN 'O' THEN 'CREATE' ELSE 'MOVE' END AS action FROM orders"
PLANNER_PEOPLE = first_per_mail(f"""
SELECT event_id, 0 AS priority, 'Manager' AS role, user_id, email FROM ({PLANNER}) JOIN ({frames.USERS}) ON user_id = created_by
UNION ALL SELECT event_id, 1, 'Actor', user_id, email FROM ({PLANNER}) JOIN ({frames.USERS}) ON user_id = actor""")


@query(f"""
SELECT r.event_id, email, role, CASE action WHEN 'DELETE' THEN '[Event Deleted] ' WHEN 'CREATE' THEN '[Event Created] ' ELSE '[Event Notification] ' END ||
       'Order ' || r.event_id AS subject
FROM ({PLANNER_PEOPLE}) r JOIN ({PLANNER}) p ON p.event_id = r.event_id""")
def planner_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, status = table(spark, sf_dir, "orders"), F.col("o_orderstatus")
    key = F.col("o_orderkey")
    events = orders.select(
        key.alias("event_id"),
        key.alias("entry_id"),
        F.when(status == "F", "DELETE").when(status == "O", "CREATE").otherwise("MOVE").alias("action"),
        (key % 1000).alias("actor_user_id"),
    )
    entries = orders.select(key.alias("entry_id"), F.concat(F.lit("Order "), key).alias("title"), F.col("o_custkey").alias("created_by"))
    rows = messages.planner_messages(events, entries, frames.users(spark, sf_dir))
    return rows.select("event_id", "email", "role", "subject")


ASSIGNED = f"""
SELECT task_id AS event_id, title, CASE status WHEN 'Completed' THEN 'DELETE' WHEN 'Pending' THEN 'ASSIGN' ELSE 'OTHER' END AS action,
       u.email AS user_mail, t.contact_email AS team_mail
FROM ({frames.TASKS}) k LEFT JOIN ({frames.USERS}) u ON u.user_id = k.assigned_to_user_id
LEFT JOIN (SELECT * FROM ({frames.TEAMS}) WHERE NOT is_deleted) t ON t.team_id = k.assigned_team_id"""
TASK_SUBJECT = "CASE action WHEN 'DELETE' THEN '[Task Deleted] ' WHEN 'ASSIGN' THEN '[Task Assigned] ' ELSE '[Task Notification] ' END || title AS subject"


@query(f"""
SELECT event_id, user_mail AS email, 'AssignedUser' AS role, {TASK_SUBJECT} FROM ({ASSIGNED}) WHERE user_mail IS NOT NULL
UNION ALL SELECT event_id, team_mail, 'AssignedTeam', {TASK_SUBJECT} FROM ({ASSIGNED}) WHERE team_mail IS NOT NULL AND team_mail IS DISTINCT FROM user_mail
UNION ALL SELECT event_id, 'no-reply@example.com', 'Recipient', {TASK_SUBJECT} FROM ({ASSIGNED}) WHERE user_mail IS NULL AND team_mail IS NULL""")
def task_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks, status = frames.tasks(spark, sf_dir), F.col("status")
    action = F.when(status == "Completed", "DELETE").when(status == "Pending", "ASSIGN").otherwise("OTHER")
    events = tasks.select(F.col("task_id").alias("event_id"), "task_id", action.alias("action"))
    return messages.task_messages(events, tasks, frames.teams(spark, sf_dir), frames.users(spark, sf_dir))


@query(f"""
SELECT e.event_id, CASE WHEN u.email IS NOT NULL THEN u.email WHEN ru IS NULL AND t.contact_email IS NOT NULL THEN t.contact_email
         WHEN rt IS NOT NULL THEN 'team-' || rt || '@example.com' ELSE 'no-reply@example.com' END AS email,
       CASE e.kind WHEN 'stored' THEN '[' || n.notification_type || '] Notification ' || n.notification_id WHEN 'lost' THEN '[PING] (no-id)' ELSE '[NOTIFICATION] (ad-hoc)' END AS subject,
       CASE e.kind WHEN 'stored' THEN 'stored text' WHEN 'lost' THEN 'payload text' ELSE '(no message)' END AS body
FROM (SELECT event_id, user_id, CASE event_type WHEN 'error' THEN 'lost' WHEN 'signup' THEN 'adhoc' ELSE 'stored' END AS kind FROM events) e
JOIN ({frames.NOTIFICATIONS}) n ON n.notification_id = e.event_id
CROSS JOIN LATERAL (SELECT CASE WHEN e.kind = 'stored' THEN n.recipient_user_id WHEN e.kind = 'lost' THEN e.user_id END AS ru,
                           CASE WHEN e.kind = 'stored' THEN n.recipient_team_id WHEN e.kind = 'adhoc' THEN e.user_id END AS rt) x
LEFT JOIN ({frames.USERS}) u ON u.user_id = ru LEFT JOIN (SELECT * FROM ({frames.TEAMS}) WHERE NOT is_deleted) t ON t.team_id = rt""")
def notification_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, event, user = F.col("event_type"), F.col("event_id"), F.col("user_id")
    payload = (
        F.when(kind == "error", F.concat(F.lit('{"notificationId":'), -1 - event, F.lit(',"notificationType":"PING","message":"payload text","recipientUserId":'), user, F.lit("}")))
        .when(kind == "signup", F.concat(F.lit('{"recipientTeamId":'), user, F.lit("}")))
        .otherwise(F.concat(F.lit('{"notificationId":'), event, F.lit(',"message":"payload text"}')))
    )
    events = table(spark, sf_dir, "events").select("event_id", payload.alias("payload"))
    stored = frames.notifications(spark, sf_dir).withColumn("message", F.lit("stored text"))
    return messages.notification_messages(events, stored, frames.users(spark, sf_dir), frames.teams(spark, sf_dir))


TICKET_EVENTS = f"""
SELECT ticket_id AS event_id, ticket_id, CASE WHEN is_deleted THEN 'TICKET_DELETED' WHEN status = 'OPEN' THEN 'TICKET_CREATED' ELSE 'OTHER' END AS event_type,
       status, severity, created_by_employee_id, assigned_to_employee_id FROM ({frames.TICKETS})"""
TICKET_PEOPLE = first_per_mail(f"""
SELECT event_id, 0 AS priority, 'Creator' AS role, user_id, email FROM ({TICKET_EVENTS}) JOIN ({frames.USERS}) ON user_id = created_by_employee_id
UNION ALL SELECT event_id, 1, 'Assigned', user_id, email FROM ({TICKET_EVENTS}) JOIN customer ON c_custkey = assigned_to_employee_id
  JOIN ({frames.USERS}) ON user_id = assigned_to_employee_id
UNION ALL SELECT event_id, 2, 'Admin', user_id, email FROM ({TICKET_EVENTS}), ({ADMINS})""")


@query(f"""
SELECT role, email, subject_kind, body, count(*) AS n FROM (
  SELECT r.role, r.email, CASE event_type WHEN 'TICKET_DELETED' THEN 'Ticket Deleted' WHEN 'TICKET_CREATED' THEN 'Ticket Created' ELSE 'Ticket Notification' END AS subject_kind,
         'Status: ' || status || '; severity: ' || severity || '; assigned to: ' ||
         CASE WHEN assigned_to_employee_id IS NULL THEN 'Unassigned' ELSE 'someone' END AS body
  FROM ({TICKET_PEOPLE}) r JOIN ({TICKET_EVENTS}) e ON e.event_id = r.event_id) GROUP BY ALL""")
def ticket_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = frames.tickets(spark, sf_dir)
    kind = F.when(F.col("is_deleted"), "TICKET_DELETED").when(F.col("status") == "OPEN", "TICKET_CREATED").otherwise("OTHER")
    # One event in two forms: the id as a number under its name, or as text under ``id``.
    named = F.when(F.col("severity") == "HIGH", F.concat(F.lit('{"ticketId":'), F.col("ticket_id"), F.lit("}")))
    payload = named.otherwise(F.concat(F.lit('{"id":"'), F.col("ticket_id"), F.lit('"}')))
    events = tickets.select(F.col("ticket_id").alias("event_id"), kind.alias("event_type"), payload.alias("payload"))
    rows = messages.ticket_messages(
        events, tickets.withColumnRenamed("status", "ticket_status"), frames.employees(spark, sf_dir), frames.users(spark, sf_dir)
    )
    subject_kind = F.regexp_extract("subject", r"^\[Maintenance\] (.*) #\d+$", 1)
    body = F.regexp_replace("body", r"\d+$", "someone")
    return rows.groupBy("role", "email", subject_kind.alias("subject_kind"), body.alias("body")).agg(F.count("*").alias("n"))


HELD = f"""
SELECT equipment_id, min(allocation_id) AS allocation_id, arg_min(employee_id, allocation_id) AS employee_id,
       arg_min(allocated_by_employee_id, allocation_id) AS by_id
FROM ({frames.ALLOCATIONS}) WHERE status = 'ACTIVE' AND NOT is_deleted GROUP BY equipment_id"""
ITEM_EVENTS = f"""
SELECT i.equipment_id AS event_id, i.equipment_id, CASE i.status WHEN 'RETIRED' THEN 'DELETE' WHEN 'AVAILABLE' THEN 'CREATE' ELSE i.status END AS event_type,
       h.allocation_id, h.employee_id, h.by_id FROM ({frames.ITEMS}) i LEFT JOIN ({HELD}) h ON h.equipment_id = i.equipment_id"""
ITEM_PEOPLE = first_per_mail(f"""
SELECT event_id, 0 AS priority, 'Assignee' AS role, user_id, email FROM ({ITEM_EVENTS}) JOIN ({frames.USERS}) ON user_id = employee_id
UNION ALL SELECT event_id, 1, 'AllocatedBy', user_id, email FROM ({ITEM_EVENTS}) JOIN ({frames.USERS}) ON user_id = by_id
UNION ALL SELECT event_id, 2, 'Admin', user_id, email FROM ({ITEM_EVENTS}), ({ADMINS})""")


@query(f"""
SELECT r.event_id, r.email, r.role, '[Inventory] ' || CASE event_type WHEN 'CREATE' THEN 'Equipment Created: id=' WHEN 'DELETE' THEN 'Equipment Deleted: id='
         ELSE 'Notification: ' || event_type || ' id=' END || equipment_id AS subject,
       coalesce('allocationId=' || allocation_id || ' assignee=' || employee_id || ' status=ACTIVE', 'no active allocation') AS body
FROM ({ITEM_PEOPLE}) r JOIN ({ITEM_EVENTS}) e ON e.event_id = r.event_id""")
def inventory_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators.aggregates import keep_first

    items = frames.items(spark, sf_dir)
    status = F.col("status")
    kind = F.when(status == "RETIRED", "DELETE").when(status == "AVAILABLE", "CREATE").otherwise(status)
    payload = F.concat(F.lit('{"equipment_id":"'), F.col("equipment_id"), F.lit('"}'))
    events = items.select(F.col("equipment_id").alias("event_id"), kind.alias("event_type"), payload.alias("payload"))
    live = frames.allocations(spark, sf_dir).filter((status == "ACTIVE") & ~F.col("is_deleted"))
    held = keep_first(live.select("equipment_id", "allocation_id", "employee_id", "allocated_by_employee_id", "status"), ["equipment_id"], ["allocation_id"])
    return messages.inventory_messages(events, held, frames.employees(spark, sf_dir), frames.users(spark, sf_dir))


TEAM_EVENTS = "SELECT -1 - n_nationkey AS event_id, n_nationkey AS team_id, CASE WHEN n_regionkey = 0 THEN 'CREATE' WHEN n_regionkey = 1 THEN 'RESTORE' ELSE 'MERGE' END AS action FROM nation"
TEAM_PEOPLE = f"""
SELECT event_id, 0 AS priority, 'TeamContact' AS role, NULL AS user_id, contact_email AS email FROM ({TEAM_EVENTS}) e JOIN ({frames.TEAMS}) t ON t.team_id = e.team_id WHERE contact_email IS NOT NULL
UNION ALL SELECT event_id, 1, 'Member', user_id, email FROM ({TEAM_EVENTS}) e JOIN customer ON (CASE WHEN c_nationkey = 4 THEN -1 ELSE c_nationkey END) = e.team_id
  JOIN ({frames.USERS}) u ON u.user_id = c_custkey"""


@query(f"""
SELECT e.event_id, coalesce(r.email, 'no-reply@example.com') AS email, coalesce(r.role, 'Fallback') AS role,
       '[' || CASE action WHEN 'CREATE' THEN 'Team Created' WHEN 'RESTORE' THEN 'Team Restored' ELSE 'Team Notification' END || '] ' || team_name AS subject
FROM ({TEAM_EVENTS}) e JOIN ({frames.TEAMS}) t ON t.team_id = e.team_id LEFT JOIN ({first_per_mail(TEAM_PEOPLE)}) r ON r.event_id = e.event_id""")
def team_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = F.col("n_regionkey")
    events = table(spark, sf_dir, "nation").select(
        (-1 - F.col("n_nationkey")).alias("event_id"),
        F.col("n_nationkey").cast("bigint").alias("team_id"),
        F.when(region == 0, "CREATE").when(region == 1, "RESTORE").otherwise("MERGE").alias("action"),
    )
    # The people of one nation belong to a team that is not there, which leaves that nation's team empty.
    team = F.when(F.col("c_nationkey") == 4, -1).otherwise(F.col("c_nationkey")).cast("bigint").alias("team_id")
    members = table(spark, sf_dir, "customer").select(team, F.col("c_custkey").alias("user_id"))
    rows = messages.team_messages(events, frames.teams(spark, sf_dir), members, frames.users(spark, sf_dir))
    return rows.select("event_id", "email", "role", "subject")


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN 'PUBLISHED' WHEN 'error' THEN 'FAILED' ELSE 'PENDING' END AS status,
       CASE WHEN event_type = 'error' THEN 'timeout after ' || user_id END AS last_error,
       CASE WHEN event_type = 'click' THEN '2024-01-15 12:00:00' END AS published_at
FROM events""")
def outbox_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    outbox = events.select(
        "event_id", F.lit("PENDING").alias("status"), F.lit(None).cast("timestamp_ntz").alias("published_at"), F.lit(None).cast("string").alias("last_error")
    )
    failed = F.when(F.col("event_type") == "error", F.concat(F.lit("timeout after "), F.col("user_id")))
    outcomes = events.filter(F.col("event_type").isin("click", "error")).select("event_id", failed.alias("error"))
    done = equipment.settle_outbox(outbox, outcomes, at(EVENTS_AS_OF))
    return done.select("event_id", "status", "last_error", stamp("published_at").alias("published_at"))
