"""Customer lifetime value of the `fold` policy.

LTV = weeks_per_year x (revenue per visit x visits per week) x lifespan, computed on the factors
rounded to two decimals and rounded again. Every known customer is listed, with 0.00 where there is
nothing to divide by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.functions.money import count_ratio, lifetime_value, per_unit
from perennia.functions.weeks import distinct_weeks, week_start
from perennia.operators.fold import Entities
from perennia.schema import AMOUNT, CUSTOMER_FIELDS, ORDER, SITE_VISIT

WEEKS_PER_YEAR = 52
LIFESPAN_YEARS = 10


def customer_metrics(facts: DataFrame, week_policy: str = "sunday_u") -> DataFrame:
    """(customer_id, visits, weeks, revenue) in one aggregation over visits and orders.

    A customer with a third of all facts is combined before the shuffle.
    """
    is_visit = F.col("type") == SITE_VISIT
    return (
        facts.where(F.col("type").isin(SITE_VISIT, ORDER))
        .groupBy("customer_id")
        .agg(
            F.count_if(is_visit).alias("visits"),
            distinct_weeks(F.col("event_date"), is_visit, week_policy).alias("weeks"),
            F.sum(F.when(F.col("type") == ORDER, F.col("amount"))).alias("revenue"),
        )
    )


def with_metrics(entities: Entities, week_policy: str = "sunday_u") -> DataFrame:
    """Every customer with visits, weeks and revenue; 0 where there are none."""
    return attach_metrics(entities.customer, customer_metrics(entities.facts, week_policy))


def attach_metrics(customer: DataFrame, metrics: DataFrame) -> DataFrame:
    """Customers with their row of metrics, 0 for those without one."""
    joined = customer.join(metrics, "customer_id", "left")
    return joined.withColumns(
        {
            "visits": F.coalesce("visits", F.lit(0).cast("bigint")),
            "weeks": F.coalesce("weeks", F.lit(0).cast("bigint")),
            "revenue": F.coalesce("revenue", F.lit(0).cast(AMOUNT)),
        }
    )


def score(
    metrics: DataFrame,
    weeks: Column | None = None,
    weeks_per_year: int = WEEKS_PER_YEAR,
    lifespan_years: int | float = LIFESPAN_YEARS,
) -> DataFrame:
    """Add revenue_per_visit, visits_per_week and ltv to rows with visits, weeks and revenue."""
    weeks = F.col("weeks") if weeks is None else weeks
    rated = metrics.withColumns(
        {
            "revenue_per_visit": per_unit(F.col("revenue"), F.col("visits")),
            "visits_per_week": count_ratio(F.col("visits"), weeks),
        }
    )
    value = lifetime_value(F.col("revenue_per_visit"), F.col("visits_per_week"), weeks_per_year, lifespan_years)
    return rated.withColumn("ltv", value)


def ltv(
    entities: Entities,
    week_policy: str = "sunday_u",
    weeks_per_year: int = WEEKS_PER_YEAR,
    lifespan_years: int | float = LIFESPAN_YEARS,
) -> DataFrame:
    """Lifetime value of every customer."""
    return score(
        with_metrics(entities, week_policy), weeks_per_year=weeks_per_year, lifespan_years=lifespan_years
    )


def result_columns(scored: DataFrame) -> DataFrame:
    """The published columns of a lifetime value result."""
    attributes = [c for c in CUSTOMER_FIELDS if c in scored.columns]
    return scored.select("customer_id", *attributes, "revenue_per_visit", "visits_per_week", "ltv")


def frame_weeks(dated: DataFrame, date: str = "event_date") -> DataFrame:
    """One row `weeks`: the Sunday weeks from the first to the last date, idle ones included."""
    first, last = week_start(F.min(date)), week_start(F.max(date))
    span = F.call_function("div", F.date_diff(last, first), F.lit(7)) + 1
    return dated.agg(F.coalesce(span, F.lit(0)).cast("bigint").alias("weeks"))


def ltv_timeframe(
    entities: Entities,
    weeks_per_year: int = WEEKS_PER_YEAR,
    lifespan_years: int | float = LIFESPAN_YEARS,
) -> DataFrame:
    """Lifetime value over the time frame of the whole data: idle weeks lower the visits per week.

    The frame reaches from the first to the last current fact; what was never applied does not
    stretch it. It is one number and enters as a scalar subquery.
    """
    frame = frame_weeks(entities.facts).scalar()
    metrics = with_metrics(entities).withColumn("weeks", frame)
    return score(metrics, weeks_per_year=weeks_per_year, lifespan_years=lifespan_years)
