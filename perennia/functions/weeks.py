"""Week functions and the count of distinct weeks.

`sunday_u`         Sunday-start week of the year, days before the first Sunday are week 0
`iso`              Monday-start ISO week of the year
`sunday_calendar`  the Sunday that starts the calendar week (knows the year)

The first two ignore the year on purpose: week 1 of two years is one week.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POLICIES = ("sunday_u", "iso", "sunday_calendar")

# Bit (and printed week) of a date that could not be read; real weeks are 0 to 53.
UNKNOWN_WEEK_BIT = 54
# Its code where weeks are numbers; before any date.
UNKNOWN_WEEK_CODE = -(1 << 31)


def week_start(date: Column) -> Column:
    """The Sunday on or before `date`."""
    return F.date_sub(F.next_day(date, "SUN"), 7)


def week_of(date: Column, policy: str = "sunday_u") -> Column:
    """Week of a DATE under the named policy; NULL for NULL."""
    if policy == "sunday_u":
        return F.call_function("div", F.dayofyear(date) + 7 - F.dayofweek(date), F.lit(7)).cast("int")
    if policy == "iso":
        return F.weekofyear(date)
    if policy == "sunday_calendar":
        return week_start(date)
    raise ValueError(f"unknown week policy {policy!r}, expected one of {POLICIES}")


def week_bits(date: Column, policy: str = "sunday_u", null_is_week: bool = True) -> Column:
    """A BIGINT with the bit of the week set, for `bit_or`; only for weeks of the year."""
    week = week_of(date, policy)
    if null_is_week:
        week = F.coalesce(week, F.lit(UNKNOWN_WEEK_BIT))
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), week)


def distinct_week_code(date: Column, policy: str = "sunday_u") -> Column:
    """An INT per week under any policy, for counting by groups; an unreadable date (NULL) is a week of its own."""
    week = week_of(date, policy)
    if policy == "sunday_calendar":
        week = F.unix_date(week)
    return F.coalesce(week, F.lit(UNKNOWN_WEEK_CODE))


def distinct_weeks(date: Column, counted: Column, policy: str = "sunday_u", null_is_week: bool = True) -> Column:
    """Aggregate: number of distinct weeks over the rows where `counted` holds.

    A week of the year is below 64, so `bit_or` of one long holds the whole set: it combines
    before the shuffle and needs no second shuffle as COUNT(DISTINCT) does. Calendar weeks are
    unbounded and use COUNT(DISTINCT), whose partial step also leaves one row per customer and week.
    """
    if policy == "sunday_calendar":
        week = week_of(date, policy)
        if null_is_week:
            week = F.coalesce(week, F.lit("0001-01-01").cast("date"))
        return F.count_distinct(F.when(counted, week))
    bits = F.bit_or(F.when(counted, week_bits(date, policy, null_is_week)))
    return F.coalesce(F.bit_count(bits), F.lit(0)).cast("bigint")
