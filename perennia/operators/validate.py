"""Row-level checks that need no other event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.functions.money import NUMBER_TEST
from perennia.schema import (
    ALL_TYPES,
    AMOUNT_OUT_OF_RANGE,
    CORRUPT,
    CORRUPT_COLUMN,
    CUSTOMER,
    IGNORED_TYPE,
    IGNORED_VERB,
    INVALID_AMOUNT,
    INVALID_EVENT_TIME,
    MISSING,
    NEW,
    ORDER,
    SITE_VISIT,
    UPDATE,
    UPSERTED,
)

BAD_TIME_POLICIES = ("null_week", "skip")


def _in(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def fault(columns: list[str], bad_time: str = "null_week") -> Column:
    """Why an event can never be applied, NULL for a valid event.

    `bad_time` says what an unreadable time does to a visit: it counts in a week of its own
    (`null_week`) or the event is dropped (`skip`). Other types never need the time.
    """
    if bad_time not in BAD_TIME_POLICIES:
        raise ValueError(f"unknown bad_time policy {bad_time!r}, expected one of {BAD_TIME_POLICIES}")
    order = f"type = '{ORDER}'"
    upserted = f"type IN {_in(UPSERTED)}"

    checks: list[tuple[str, str]] = []
    if CORRUPT_COLUMN in columns:
        checks.append((f"{CORRUPT_COLUMN} IS NOT NULL", CORRUPT))
    checks.append(("type IS NULL", MISSING + "type"))
    if "event_time" in columns:
        checks.append(("event_time IS NULL", MISSING + "event_time"))
    checks += [
        (f"type NOT IN {_in(ALL_TYPES)}", IGNORED_TYPE),
        ("key IS NULL", MISSING + "key"),
        (f"type <> '{CUSTOMER}' AND customer_id IS NULL", MISSING + "customer_id"),
    ]
    if "total_amount" in columns:
        checks.append((f"{order} AND total_amount IS NULL", MISSING + "total_amount"))
        checks.append((f"{order} AND amount IS NULL AND {NUMBER_TEST}", AMOUNT_OUT_OF_RANGE))
    # The amount is read before the verb: a junk NEW creates no order.
    checks += [
        (f"{order} AND amount IS NULL", INVALID_AMOUNT),
        (f"{upserted} AND verb IS NULL", MISSING + "verb"),
        (f"{upserted} AND verb NOT IN {_in((NEW, UPDATE))}", IGNORED_VERB),
    ]
    if bad_time == "skip":
        checks.append((f"type = '{SITE_VISIT}' AND event_date IS NULL", INVALID_EVENT_TIME))
    return F.expr("CASE " + " ".join(f"WHEN {check} THEN '{reason}'" for check, reason in checks) + " END")


def valid_events(log: DataFrame, bad_time: str = "null_week") -> DataFrame:
    """Only the events that the fold may look at."""
    return log.where(fault(log.columns, bad_time).isNull())
