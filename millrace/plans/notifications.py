"""Task notifications: reminders, overdue notes, delivery outcomes, retries, recipients."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import has_ignoring_case
from millrace.functions.times import backoff_minutes, before, plus_minutes
from millrace.operators.aggregates import keep_first, keep_latest
from millrace.operators.joins import without_pending
from millrace.operators.rows import due_notifications, overdue_tasks
from millrace.operators.skew import join_on, salted_join

# Notification types, attempt limits and fallback addresses.
ONE_DAY = "REMINDER_1DAY"
FEW_HOURS = "REMINDER_HOURS"
ASSIGNED = "TASK_ASSIGNED"
OVERDUE = "OVERDUE"
MAX_DELIVERY_ATTEMPTS = 3
MAX_BACKOFF_ATTEMPTS = 5
DEFAULT_ADDRESS = "no-reply@example.com"

# The target that stands for all admins.
ADMINS = "admins"


def pending_rows(df: DataFrame, kind: Column, message: Column, at: Column, as_of: Column) -> DataFrame:
    return df.select(
        "event_id",
        "task_id",
        F.col("assigned_to_user_id").alias("recipient_user_id"),
        F.col("assigned_team_id").alias("recipient_team_id"),
        kind.alias("notification_type"),
        message.alias("message"),
        at.alias("scheduled_for"),
        F.lit("pending").alias("status"),
        F.lit(0).alias("attempts"),
        as_of.alias("created_at"),
    )


def plan_reminders(tasks: DataFrame, existing: DataFrame, as_of: Column) -> DataFrame:
    """One day and three hours before a start that is still ahead, and the assignment itself.

    A type that is already pending for its task is left out; a task without a start gets nothing.
    """
    start, title = F.col("estimated_start"), F.col("title")

    def entry(kind: str, at: Column, message: Column, due: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), at.alias("at"), message.alias("message"), due.alias("due"))

    day, hours = before(start, "1 DAY"), before(start, "3 HOURS")
    entries = F.array(
        entry(ONE_DAY, day, F.concat(F.lit("Reminder: Task '"), title, F.lit("' starts in 1 day")), day > as_of),
        entry(FEW_HOURS, hours, F.concat(F.lit("Reminder: Task '"), title, F.lit("' starts in a few hours")), hours > as_of),
        entry(
            ASSIGNED,
            as_of,
            F.concat(F.lit("You have been assigned task '"), title, F.lit("' for event "), F.col("event_id")),
            F.lit(True),
        ),
    )
    spread = tasks.filter(start.isNotNull()).withColumn("e", F.explode(F.filter(entries, lambda e: e["due"])))
    rows = pending_rows(spread, F.col("e.kind"), F.col("e.message"), F.col("e.at"), as_of)
    return without_pending(rows, existing, ["task_id", "notification_type"])


def plan_simple_reminders(tasks: DataFrame, as_of: Column) -> DataFrame:
    """A reminder 24 hours and 3 hours before each start that is still ahead, equal times once."""
    start = F.col("estimated_start")
    times = F.filter(F.array_distinct(F.array(before(start, "24 HOURS"), before(start, "3 HOURS"))), lambda t: t > as_of)
    spread = tasks.filter(start.isNotNull()).withColumn("at", F.explode(times))
    message = F.concat(
        F.lit("Reminder: Task '"), F.col("title"), F.lit("' scheduled at "),
        F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    )
    return pending_rows(spread, F.lit("reminder"), message, F.col("at"), as_of)


def plan_overdue(tasks: DataFrame, existing: DataFrame, as_of: Column) -> DataFrame:
    """An immediate note for every overdue task that has none pending."""
    late = overdue_tasks(tasks, as_of)
    message = F.concat(
        F.lit("Overdue: Task '"), F.col("title"), F.lit("' is overdue (expected end "),
        F.date_format("estimated_end", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(")"),
    )
    rows = pending_rows(late, F.lit(OVERDUE), message, as_of, as_of)
    return without_pending(rows, existing, ["task_id", "notification_type"])


def next_due(notifications: DataFrame, as_of: Column, limit: int) -> DataFrame:
    """The longest-waiting due notifications, unscheduled ones first."""
    due = due_notifications(notifications, as_of)
    return due.orderBy(F.col("scheduled_for").asc_nulls_first(), "notification_id").limit(limit)


def oldest_pending(notifications: DataFrame, limit: int) -> DataFrame:
    waiting = notifications.filter((F.col("status") == "pending") & ~F.col("is_deleted"))
    return waiting.orderBy("created_at", "notification_id").limit(limit)


def due_of_oldest(notifications: DataFrame, as_of: Column, limit: int) -> DataFrame:
    """The oldest pending page of those whose time has come."""
    due = F.col("scheduled_for").isNull() | (F.col("scheduled_for") <= as_of)
    return oldest_pending(notifications.filter(due), limit)


def record_delivery(
    notifications: DataFrame,
    outcomes: DataFrame,
    as_of: Column,
    max_attempts: int = MAX_DELIVERY_ATTEMPTS,
    latest: str | None = None,
    even: bool = False,
) -> DataFrame:
    """``outcomes`` (notification_id, delivered): sent with its time, or one more failed attempt.

    Of several outcomes of a notification the one with the largest ``latest`` counts, then a failure.
    ``even`` spreads the outcomes of a notification that has very many.
    """
    one = keep_latest(outcomes, ["notification_id"], latest, even).select("notification_id", "delivered")
    joined = notifications.join(one, "notification_id", "left")
    sent, lost = F.col("delivered"), ~F.col("delivered")
    attempts = F.col("attempts") + F.when(lost, 1).otherwise(0)
    return (
        joined.withColumn("attempts", attempts)
        .withColumn("sent_at", F.when(sent, as_of).otherwise(F.col("sent_at")))
        .withColumn(
            "status",
            F.when(sent, "sent").when(lost & (F.col("attempts") >= max_attempts), "failed").otherwise(F.col("status")),
        )
        .select(*notifications.columns)
    )


def retry_failed(
    failed: DataFrame, as_of: Column, max_attempts: int = MAX_BACKOFF_ATTEMPTS
) -> tuple[DataFrame, DataFrame]:
    """``(rescheduled, alerts)`` for pending notifications with a ``reason``.

    The wait doubles per attempt; after the last one an issue alert takes the place of the row.
    """
    counted = failed.withColumn("attempts", F.col("attempts") + 1)
    again = counted.filter(F.col("attempts") < max_attempts)
    given_up = counted.filter(F.col("attempts") >= max_attempts)
    rescheduled = again.withColumn("scheduled_for", plus_minutes(as_of, backoff_minutes(F.col("attempts")))).withColumn(
        "created_at", as_of
    )
    message = F.trim(
        F.concat(
            F.lit("Issue Alert: Notification for task "), F.coalesce(F.col("task_id"), F.lit(-1)),
            F.lit(" failed after "), F.col("attempts"), F.lit(" attempts. "), F.coalesce("reason", F.lit("")),
        )
    )
    alerts = given_up.select(
        F.col("notification_id").alias("replaces_id"),
        "task_id",
        F.lit("issue_alert").alias("notification_type"),
        message.alias("message"),
        as_of.alias("scheduled_for"),
        F.lit("pending").alias("status"),
        F.lit(0).alias("attempts"),
    )
    return rescheduled.drop("reason"), alerts


def first_per_address(
    recipients: DataFrame, message_keys: Sequence[str], carried: Sequence[str] = (), met: bool = False
) -> DataFrame:
    """One recipient per message and address: the first by priority, then by user id.

    ``recipients`` holds the message keys, priority, role, user_id, email and what is ``carried`` along
    with a message. Rows are ranked per message and address, so no message's recipients are ranked as one group. They are
    moved for it unless those of a message have ``met``.
    """
    named = recipients.withColumn("email", F.trim("email")).filter(F.col("email") != "")
    rows = named.select(*message_keys, "email", "priority", "user_id", "role", *carried)
    best = keep_first(rows, [*message_keys, "email"], ["priority", "user_id", "role"], met=met)
    return best.select(*message_keys, "email", "role", "user_id", *carried)


def admins_of(users: DataFrame) -> DataFrame:
    """Users who hold the admin role in any spelling."""
    return users.filter(has_ignoring_case(F.col("roles"), "admin"))


def expand_recipients(
    messages: DataFrame,
    roles: list[tuple[str, str]],
    users: DataFrame,
    message_keys: Sequence[str],
    with_admins: bool = True,
    carried: Sequence[str] = (),
    salts: int = 32,
) -> DataFrame:
    """The people each message goes to, in role order: the users in the role columns, then admins.

    ``roles`` lists (role, user column); ``carried`` names columns of the messages to keep. A message
    asks for targets, each a user or all admins, and meets the users in one join. All messages ask for the
    admins, so that one target is dealt over ``salts``: as many as there are tasks, for very many messages.
    The admins, one per address, are sent to the tasks only after the rows of a message have met: what moves
    is a row per role and one for all admins, however many they are.
    """
    targets = [recipient_target(i, role, user_target(F.col(column))) for i, (role, column) in enumerate(roles)]
    people = users.select(user_target(F.col("user_id")).alias("target"), F.col("user_id").cast("bigint"), "email")
    if with_admins:
        targets.append(recipient_target(len(roles), "Admin", F.lit(ADMINS)))
    kept = [*message_keys, *carried]
    asked = messages.select(*kept, F.explode(F.array(*targets)).alias("t")).select(*kept, "t.*")
    named = salted_join(asked.filter(F.col("target").isNotNull()), people, ["target"], hot=[ADMINS], how="left", salts=salts)
    named = named.filter(F.col("email").isNotNull() | (F.col("target") == ADMINS))
    # A message's rows grow by the admins where they lie, so their tasks are not put together by what was moved.
    partitions = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = named.repartition(partitions, *message_keys)
    if with_admins:
        admins = admins_of(users).select(
            # Not a constant, so that this stays a join by key.
            F.when(F.size("roles") > 0, ADMINS).alias("target"),
            F.trim("email").alias("admin_email"),
            F.col("user_id").cast("bigint").alias("admin_id"),
        )
        admins = keep_first(admins.filter(F.col("admin_email") != ""), ["target", "admin_email"], ["admin_id"])
        to_all = F.col("target") == ADMINS
        named = join_on(named, F.broadcast(admins), ["target"], "left").withColumns(
            {
                "email": F.when(to_all, F.col("admin_email")).otherwise(F.col("email")),
                "user_id": F.when(to_all, F.col("admin_id")).otherwise(F.col("user_id")),
            }
        )
    return first_per_address(named, message_keys, carried, met=True)


def user_target(user_id: Column) -> Column:
    return F.concat(F.lit("user "), user_id.cast("bigint").cast("string"))


def recipient_target(priority: int, role: str, target: Column) -> Column:
    return F.struct(F.lit(priority).alias("priority"), F.lit(role).alias("role"), target.alias("target"))


def recipient_address(notifications: DataFrame, users: DataFrame, teams: DataFrame) -> DataFrame:
    """The address of each notification: the user's, else the team's, else a default.

    A notification that names a user does not fall through to the team's contact address.
    """
    people = users.select(F.col("user_id").alias("recipient_user_id"), F.col("email").alias("__user_email"))
    contacts = teams.filter(~F.col("is_deleted")).select(
        F.col("team_id").alias("recipient_team_id"), F.col("contact_email").alias("__team_email")
    )
    out = join_on(notifications, people, ["recipient_user_id"], "left")
    out = join_on(out, contacts, ["recipient_team_id"], "left")
    team_box = F.concat(F.lit("team-"), F.col("recipient_team_id"), F.lit("@example.com"))
    contact = F.when(F.col("recipient_user_id").isNull(), F.col("__team_email"))
    address = F.coalesce(F.col("__user_email"), contact, team_box, F.lit(DEFAULT_ADDRESS))
    return out.withColumn("email", address).drop("__user_email", "__team_email")
