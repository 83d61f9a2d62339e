"""Deadline reminders, written as a table of messages to send."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import rules
from ..functions.dates import signed_days_to

PLAN_DAYS, UPDATE_DAYS, DEADLINE_DAYS = 2, 6, 3
ESCALATED_FROM = 3
# The day from which a missing plan counts: issues are concluded, everything else is recommended.
PLAN_SINCE = {fv.AUDIT_ISSUE: "concluded_date"}


def plan_since(kind: str) -> str:
    return PLAN_SINCE.get(kind, "recommend_date")


def warning_type(as_of: dt.date | str, planned_from: str = "recommend_date") -> Column:
    """1 no plan, 2 no update, 3 overdue, 4 due soon; a later one overrides."""
    waiting = F.col("status").contains(fv.NOT_STARTED_MARK)
    running = F.col("status").contains(fv.IN_PROGRESS_MARK)
    to_deadline = signed_days_to(F.col("deadline"), as_of)
    return rules.last_match([
        (waiting & (signed_days_to(F.col(planned_from), as_of) <= -PLAN_DAYS), 1),
        (running & (signed_days_to(F.col("update_date"), as_of) <= -UPDATE_DAYS), 2),
        (running & (to_deadline < 0), 3),
        (running & (to_deadline >= 0) & (to_deadline < DEADLINE_DAYS), 4),
    ])


def due_actions(actions: DataFrame, kind: str, as_of: dt.date | str) -> DataFrame:
    """Actions of one kind's list that call for a reminder, with the days the message names."""
    days = {1: plan_since(kind), 2: "update_date", 3: "deadline", 4: "deadline"}
    return (
        actions.withColumns({"kind": F.lit(kind), "warning_type": warning_type(as_of, plan_since(kind))})
        .where(F.col("warning_type").isNotNull())
        .withColumn("days", rules.first_match(
            [(F.col("warning_type") == k, F.abs(signed_days_to(F.col(c), as_of))) for k, c in days.items()]
        ))
    )


def _by_type(formats: dict[int, str], *values: Column) -> Column:
    return rules.first_match([(F.col("warning_type") == k, F.format_string(text, *values)) for k, text in formats.items()])


def message_body(link: str) -> Column:
    headline = _by_type(fv.MAIL_HEADLINES, F.col("kind"), F.col("no"), F.col("yearmonth"), F.col("days"))
    request = _by_type(fv.MAIL_REQUESTS, F.col("risk_owner"))
    return F.concat_ws(
        "\n",
        F.format_string(fv.MAIL_GREETING, F.col("assignee")),
        headline,
        F.lit(" "),
        request,
        F.lit(fv.MAIL_DETAIL_TITLE),
        F.col("content"),
        F.lit(fv.MAIL_LINK_TITLE),
        F.lit(link),
        F.lit(fv.MAIL_RULER),
        F.lit(fv.MAIL_CLOSING),
    )


def reminders(actions: DataFrame, contacts: DataFrame, kind: str, as_of: dt.date | str, link: str,
              escalate_to: list[str]) -> DataFrame:
    """Outbox rows of actions whose assignee has a contact; types 3 and 4 also go to ``escalate_to``."""
    own = F.array("contact")
    also = F.when(F.col("warning_type") >= ESCALATED_FROM, F.array(*[F.lit(a) for a in escalate_to]))
    return due_actions(actions, kind, as_of).join(contacts, "assignee").select(
        "kind",
        "no",
        "assignee",
        "warning_type",
        F.coalesce(F.concat(own, also), own).alias("recipients"),
        F.format_string(fv.MAIL_SUBJECT, F.col("kind"), F.upper("risk_owner")).alias("subject"),
        message_body(link).alias("body"),
    )


def reminder_errors(actions: DataFrame, contacts: DataFrame, kind: str, as_of: dt.date | str) -> DataFrame:
    """Due actions nobody can be written to about: the assignee has no contact."""
    return due_actions(actions, kind, as_of).join(contacts, "assignee", "left_anti").select(
        "kind", "no", "assignee", "warning_type"
    )
