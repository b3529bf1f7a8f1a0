"""Lenient reading of event times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted shape: an ISO date, optionally followed by a time of day and a zone. The date may also be written with
# slashes or without separators, hour and minute may be separated by a dot or, like the seconds, by nothing.
_DATE = r"\d{4}-\d{1,2}-\d{1,2}"
_TIME = r"(([01]?\d|2[0-3])([:.][0-5]?\d([:.][0-5]?\d([.,]\d+)?)?)?|([01]\d|2[0-3])[0-5]\d([0-5]\d([.,]\d+)?)?)"
_ZONE = r"(Z|UTC|GMT|[+-]\d{2}(:?\d{2})?)"
EVENT_TIME_PATTERN = rf"^\s*{_DATE}([T ]\s*{_TIME}\s*{_ZONE}?)?\s*$"


def _dashed(text: Column) -> Column:
    slashes = F.regexp_replace(text, r"^(\s*\d{4})/(\d{1,2})/(\d{1,2})(?!\d)", "$1-$2-$3")
    return F.regexp_replace(slashes, r"^(\s*\d{4})(\d{2})(\d{2})(?=[T ]|$)", "$1-$2-$3")


def event_date(text: Column) -> Column:
    """The date as written (no zone shift); NULL when the text is no valid date and time."""
    dashed = F.when(text.rlike(r"^\s*\d{4}-"), text).otherwise(_dashed(text))
    return F.when(dashed.rlike(EVENT_TIME_PATTERN), dashed.try_cast("date"))


def event_timestamp(text: Column) -> Column:
    """The moment, where Spark can read the time of day, else the beginning of the date; NULL without a date."""
    return F.when(event_date(text).isNotNull(), F.coalesce(text.try_cast("timestamp"), event_date(text).cast("timestamp")))
