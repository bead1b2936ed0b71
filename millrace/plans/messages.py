"""Message rows (recipient, subject, body) for equipment events; nothing is sent from here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.payloads import json_field
from millrace.functions.times import shown_in_zone
from millrace.operators.skew import join_on
from millrace.plans.notifications import DEFAULT_ADDRESS, expand_recipients, first_per_address, recipient_address

# Subjects per event type.
TICKET_SUBJECTS = {
    "TICKET_CREATED": "Ticket Created",
    "TICKET_STATUS_UPDATED": "Ticket Updated",
    "TICKET_ASSIGNED": "Ticket Assigned",
    "TICKET_DELETED": "Ticket Deleted",
}
INVENTORY_SUBJECTS = {
    "CREATE": "Equipment Created: id=",
    "UPDATE": "Equipment Updated: id=",
    "DELETE": "Equipment Deleted: id=",
}


def by_type(table: dict[str, str], event_type: Column, other: Column) -> Column:
    chosen = other
    for name, text in reversed(table.items()):
        chosen = F.when(event_type == name, F.lit(text)).otherwise(chosen)
    return chosen


def with_people(allocations: DataFrame, employees: DataFrame) -> DataFrame:
    """User ids of the assignee and of the allocator."""
    who = employees.select("employee_id", "user_id")
    assigned = who.select("employee_id", F.col("user_id").alias("assignee_user_id"))
    out = join_on(allocations, assigned, ["employee_id"], "left")
    by = who.select(F.col("employee_id").alias("allocated_by_employee_id"), F.col("user_id").alias("allocator_user_id"))
    return join_on(out, by, ["allocated_by_employee_id"], "left")


def equipment_text() -> Column:
    """How a message names a piece of equipment, known or not."""
    known = F.concat(
        F.col("asset_tag"), F.lit(" / SN:"), F.col("serial_number"), F.lit(" (id="), F.col("equipment_id"), F.lit(")")
    )
    return F.coalesce(known, F.concat(F.lit("(equipment id="), F.col("equipment_id"), F.lit(")")))


def with_allocation(
    events: DataFrame, fields: list[str], allocations: DataFrame, items: DataFrame, employees: DataFrame
) -> DataFrame:
    """Events joined to the allocation their payload names, its item and its people. Events of
    unknown allocations drop out."""
    ids = json_field(F.col("payload"), fields)
    stated = F.get_json_object("payload", "$.expectedReturnAt").alias("stated")
    kept = [c for c in ("event_id", "event_type") if c in events.columns]
    named = events.select(*kept, ids.alias("allocation_id"), stated).filter(F.col("allocation_id").isNotNull())
    found = join_on(named, with_people(allocations, employees), ["allocation_id"])
    tags = items.select("equipment_id", "asset_tag", "serial_number")
    return join_on(found, tags, ["equipment_id"], "left")


ALLOCATION_ROLES = [("Assignee", "assignee_user_id"), ("AllocatedBy", "allocator_user_id")]


def overdue_messages(
    events: DataFrame, allocations: DataFrame, items: DataFrame, employees: DataFrame, users: DataFrame
) -> DataFrame:
    """Overdue reminders for the assignee, the allocator and all admins.

    ``events`` holds event_id and a JSON payload; the allocation may be named by any of three
    fields, as a number or as text.
    """
    found = with_allocation(events, ["allocationId", "allocId", "id"], allocations, items, employees)
    content = found.select(
        "event_id",
        F.concat(F.lit("[Reminder] Allocation #"), F.col("allocation_id")).alias("subject"),
        F.concat(
            F.lit("Equipment: "), equipment_text(), F.lit("; expected return: "),
            F.coalesce("stated", shown_in_zone(F.col("expected_return_at").cast("timestamp"))),
        ).alias("body"),
        "assignee_user_id",
        "allocator_user_id",
    )
    return _addressed(content, ALLOCATION_ROLES, users)


def allocation_subject(role: Column, event_type: Column) -> Column:
    """The subject stem for a recipient role and an event type."""
    role, kind = F.lower(role), F.upper(event_type)
    new, back = kind.isin("CREATE", "ALLOCATION"), kind == "RETURN"
    return (
        F.when((role == "assignee") & new, "[Allocation Assigned] Allocation #")
        .when((role == "allocatedby") & new, "[Allocation Created] Allocation #")
        .when(role.isin("assignee", "allocatedby") & back, "[Allocation Returned] Allocation #")
        .when((role == "admin") & kind.isin("MAINTENANCE", "MAINTENANCE_ALERT", "DAMAGED"), "[Maintenance Alert] Allocation #")
        .when(kind.isin("OVERDUE_REMINDER", "OVERDUE", "REMINDER"), "[Reminder] Allocation #")
        .otherwise("[Allocation Notification] Allocation #")
    )


def allocation_messages(
    events: DataFrame, allocations: DataFrame, items: DataFrame, employees: DataFrame, users: DataFrame
) -> DataFrame:
    """Allocation notes for the assignee, the allocator and all admins, worded per role."""
    found = with_allocation(events, ["allocationId"], allocations, items, employees)
    content = found.select(
        "event_id",
        "event_type",
        "allocation_id",
        "asset_tag",
        F.concat(F.lit("Equipment: "), equipment_text(), F.lit("; status: "), F.coalesce("status", F.lit("N/A"))).alias("body"),
        "assignee_user_id",
        "allocator_user_id",
    )
    out = _addressed(content, ALLOCATION_ROLES, users, ["event_type", "allocation_id", "asset_tag", "body"])
    stem = allocation_subject(F.col("role"), F.col("event_type"))
    kind = F.upper("event_type")
    tail = (
        F.when((F.lower("role") == "assignee") & kind.isin("CREATE", "ALLOCATION"), F.concat(F.lit(" - "), F.coalesce("asset_tag", F.lit(""))))
        .when(kind.isin("OVERDUE_REMINDER", "OVERDUE", "REMINDER"), " is overdue")
        .otherwise("")
    )
    return out.withColumn("subject", F.concat(stem, F.col("allocation_id"), tail)).drop("event_type", "allocation_id", "asset_tag")


def split_reminders(events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(explicit, overdue, general)`` reminders: those that list addresses (one row each), those
    that name an allocation, and the rest, which go to the admins."""
    many = F.from_json(F.get_json_object("payload", "$.emails"), "array<string>")
    single = F.array(F.get_json_object("payload", "$.email"))
    listed = F.concat(F.transform(F.coalesce(many, F.array().cast("array<string>")), lambda e: F.trim(e)), single)
    listed = F.array_distinct(F.filter(listed, lambda e: e.isNotNull() & (e != "")))
    sorted_out = events.withColumn("emails", listed).withColumn(
        "names_allocation", json_field(F.col("payload"), ["allocationId"]).isNotNull()
    )
    direct = F.size("emails") > 0
    explicit = sorted_out.filter(direct).select("event_id", "event_type", F.explode("emails").alias("email"))
    rest = sorted_out.filter(~direct)
    overdue, general = rest.filter("names_allocation"), rest.filter(~F.col("names_allocation"))
    return explicit, overdue.select(events.columns), general.select(events.columns)


def reminder_messages(events: DataFrame, users: DataFrame) -> DataFrame:
    """General reminders: to the listed addresses, else to all admins. Overdue ones go through
    ``overdue_messages``."""
    explicit, _, general = split_reminders(events)
    subject = F.concat(F.lit("[Reminder] "), F.col("event_type")).alias("subject")
    to_admins = expand_recipients(general, [], users, ["event_id", "event_type"])
    return explicit.select("event_id", "email", subject).unionByName(to_admins.select("event_id", "email", subject))


def ticket_messages(events: DataFrame, tickets: DataFrame, employees: DataFrame, users: DataFrame) -> DataFrame:
    """Maintenance notes for the creator, the assigned person and all admins."""
    ids = json_field(F.col("payload"), ["ticketId", "id"])
    named = events.select("event_id", "event_type", ids.alias("ticket_id")).filter(F.col("ticket_id").isNotNull())
    who = employees.select("employee_id", "user_id")
    made = who.select(F.col("employee_id").alias("created_by_employee_id"), F.col("user_id").alias("creator_user_id"))
    given = who.select(F.col("employee_id").alias("assigned_to_employee_id"), F.col("user_id").alias("assigned_user_id"))
    staffed = join_on(tickets, made, ["created_by_employee_id"], "left")
    staffed = join_on(staffed, given, ["assigned_to_employee_id"], "left")
    found = join_on(named, staffed, ["ticket_id"])
    kind = by_type(TICKET_SUBJECTS, F.col("event_type"), F.lit("Ticket Notification"))
    content = found.select(
        "event_id",
        F.concat(F.lit("[Maintenance] "), kind, F.lit(" #"), F.col("ticket_id")).alias("subject"),
        F.concat(
            F.lit("Status: "), F.col("ticket_status"), F.lit("; severity: "), F.col("severity"), F.lit("; assigned to: "),
            F.coalesce(F.col("assigned_to_employee_id").cast("string"), F.lit("Unassigned")),
        ).alias("body"),
        "creator_user_id",
        "assigned_user_id",
    )
    return _addressed(content, [("Creator", "creator_user_id"), ("Assigned", "assigned_user_id")], users)


def inventory_messages(
    events: DataFrame, active_allocations: DataFrame, employees: DataFrame, users: DataFrame
) -> DataFrame:
    """Inventory notes for the people of the item's active allocation, if any, and all admins."""
    ids = json_field(F.col("payload"), ["equipmentId", "equipment_id", "id"])
    named = events.select("event_id", "event_type", ids.alias("equipment_id")).filter(F.col("equipment_id").isNotNull())
    held = with_people(active_allocations, employees).select(
        "equipment_id", "allocation_id", "employee_id", "status", "assignee_user_id", "allocator_user_id"
    )
    found = join_on(named, held, ["equipment_id"], "left")
    other = F.concat(F.lit("Notification: "), F.col("event_type"), F.lit(" id="))
    details = F.coalesce(
        F.concat(F.lit("allocationId="), F.col("allocation_id"), F.lit(" assignee="), F.col("employee_id"), F.lit(" status="), F.col("status")),
        F.lit("no active allocation"),
    )
    content = found.select(
        "event_id",
        F.concat(F.lit("[Inventory] "), by_type(INVENTORY_SUBJECTS, F.col("event_type"), other), F.col("equipment_id")).alias("subject"),
        details.alias("body"),
        "assignee_user_id",
        "allocator_user_id",
    )
    return _addressed(content, [("Assignee", "assignee_user_id"), ("AllocatedBy", "allocator_user_id")], users)


def team_messages(events: DataFrame, teams: DataFrame, members: DataFrame, users: DataFrame) -> DataFrame:
    """Team notes for the contact address first and then the active members."""
    labels = {"CREATE": "Team Created", "UPDATE": "Team Updated", "DELETE": "Team Deleted", "RESTORE": "Team Restored"}
    found = join_on(events, teams.select("team_id", "team_name", "contact_email"), ["team_id"])
    content = found.select(
        "event_id",
        F.concat(F.lit("["), by_type(labels, F.col("action"), F.lit("Team Notification")), F.lit("] "), F.col("team_name")).alias("subject"),
        F.concat(F.col("action"), F.lit(" performed on team "), F.col("team_name")).alias("body"),
    )
    none = F.lit(None).cast("bigint")
    contacts = found.select("event_id", F.lit(0).alias("priority"), F.lit("TeamContact").alias("role"), none.alias("user_id"), F.col("contact_email").alias("email"))
    staff = join_on(members, users.select("user_id", "email"), ["user_id"])
    joined = join_on(staff.select("team_id", "user_id", "email"), events.select("team_id", "event_id"), ["team_id"])
    people = joined.select("event_id", F.lit(1).alias("priority"), F.lit("Member").alias("role"), F.col("user_id").cast("bigint").alias("user_id"), "email")
    chosen = first_per_address(contacts.unionByName(people), ["event_id"])
    # An event without recipients keeps its row and goes to the default address.
    addressed = join_on(content, chosen, ["event_id"], "left")
    return addressed.select(
        "event_id",
        F.coalesce("email", F.lit(DEFAULT_ADDRESS)).alias("email"),
        F.coalesce("role", F.lit("Fallback")).alias("role"),
        "subject",
        "body",
    )


def planner_messages(events: DataFrame, entries: DataFrame, users: DataFrame) -> DataFrame:
    """Notes about planned events for their manager and the acting user.

    ``events``: event_id, entry_id, action, actor_user_id; ``entries``: entry_id, title, created_by.
    """
    labels = {"CREATE": "Event Created", "UPDATE": "Event Updated", "DELETE": "Event Deleted", "RESTORED": "Event Restored"}
    found = join_on(events, entries.select("entry_id", "title", "created_by"), ["entry_id"])
    content = found.select(
        "event_id",
        F.concat(F.lit("["), by_type(labels, F.col("action"), F.lit("Event Notification")), F.lit("] "), F.col("title")).alias("subject"),
        F.concat(F.col("action"), F.lit(" of event "), F.col("entry_id")).alias("body"),
        "created_by",
        "actor_user_id",
    )
    return _addressed(content, [("Manager", "created_by"), ("Actor", "actor_user_id")], users, with_admins=False)


def task_messages(events: DataFrame, tasks: DataFrame, teams: DataFrame, users: DataFrame) -> DataFrame:
    """Notes about tasks for the assigned user and then the assigned team's contact address; a
    task with neither goes to the default address. ``events``: event_id, task_id, action."""
    labels = {"CREATE": "Task Created", "ASSIGN": "Task Assigned", "STATUS": "Task Status", "DELETE": "Task Deleted"}
    wanted = tasks.select("task_id", "title", "assigned_to_user_id", "assigned_team_id")
    people = users.select(F.col("user_id").alias("assigned_to_user_id"), F.trim("email").alias("user_email"))
    contacts = teams.filter(~F.col("is_deleted")).select(F.col("team_id").alias("assigned_team_id"), F.trim("contact_email").alias("team_email"))
    # The addresses go onto the tasks, so each event carries at most two and needs no grouping.
    wanted = join_on(wanted, people, ["assigned_to_user_id"], "left")
    wanted = join_on(wanted, contacts, ["assigned_team_id"], "left")
    found = join_on(events, wanted, ["task_id"])

    def entry(role: str, email: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), email.alias("email"))

    user, team = F.nullif(F.col("user_email"), F.lit("")), F.nullif(F.col("team_email"), F.lit(""))
    both = F.array(entry("AssignedUser", user), entry("AssignedTeam", F.when(user.isNull() | (user != team), team)))
    real = F.filter(both, lambda e: e["email"].isNotNull())
    chosen = F.when(F.size(real) > 0, real).otherwise(F.array(entry("Recipient", F.lit(DEFAULT_ADDRESS))))
    subject = F.concat(F.lit("["), by_type(labels, F.col("action"), F.lit("Task Notification")), F.lit("] "), F.col("title"))
    return found.withColumn("to", F.explode(chosen)).select("event_id", "to.email", "to.role", subject.alias("subject"))


def notification_messages(events: DataFrame, notifications: DataFrame, users: DataFrame, teams: DataFrame) -> DataFrame:
    """Delivery rows for notification payloads: the stored row's recipient and text where the
    payload names one, else what the payload itself says."""
    def text(name: str) -> Column:
        return F.get_json_object("payload", f"$.{name}")

    stored = notifications.select(
        "notification_id",
        F.col("recipient_user_id").alias("stored_user"),
        F.col("recipient_team_id").alias("stored_team"),
        F.col("notification_type").alias("stored_type"),
        F.col("message").alias("stored_message"),
        F.lit(True).alias("stored"),
    )
    asked = events.select("event_id", "payload", text("notificationId").try_cast("bigint").alias("notification_id"))
    joined = join_on(asked, stored, ["notification_id"], "left")
    hit = F.col("stored").isNotNull()

    def either(column: str, name: str) -> Column:
        return F.when(hit, F.col(column)).otherwise(text(name).try_cast("bigint"))

    addressed = recipient_address(
        joined.withColumn("recipient_user_id", either("stored_user", "recipientUserId")).withColumn(
            "recipient_team_id", either("stored_team", "recipientTeamId")
        ),
        users,
        teams,
    )
    kind = F.coalesce(F.when(hit, F.nullif("stored_type", F.lit(""))).otherwise(text("notificationType")), F.lit("NOTIFICATION"))
    tail = (
        F.when(hit, F.concat(F.lit("Notification "), F.col("notification_id")))
        .when(F.col("notification_id").isNotNull(), "(no-id)")
        .otherwise("(ad-hoc)")
    )
    body = F.coalesce(F.when(hit, F.col("stored_message")), text("message"), F.lit("(no message)"))
    return addressed.select(
        "event_id", "email", F.concat(F.lit("["), kind, F.lit("] "), tail).alias("subject"), body.alias("body")
    )


def _addressed(
    content: DataFrame,
    roles: list[tuple[str, str]],
    users: DataFrame,
    texts: list[str] | None = None,
    with_admins: bool = True,
) -> DataFrame:
    people = expand_recipients(content, roles, users, ["event_id"], with_admins, texts or ["subject", "body"])
    return people.drop("user_id")
