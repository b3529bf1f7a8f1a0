"""Counts, histograms and data-quality reports over a log or over entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.functions.weeks import UNKNOWN_WEEK_BIT, week_of
from perennia.operators.dispositions import event_dispositions
from perennia.operators.fold import Entities
from perennia.operators.lookup import HOT_ROWS
from perennia.operators.rank import top_per_group
from perennia.operators.validate import fault
from perennia.plans.ltv import with_metrics
from perennia.schema import APPLIED, CUSTOMER, NEW, ORDER, SITE_VISIT


def ingest_summary(log: DataFrame) -> DataFrame:
    """One row: all events, rejected ones included, and the distinct customers accepted."""
    accepted = fault(log.columns).isNull() & (F.col("type") == CUSTOMER) & (F.col("verb") == NEW)
    return log.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct(F.when(accepted, F.col("key"))).alias("distinct_customers"),
    )


def events_by_type_verb(log: DataFrame) -> DataFrame:
    return log.groupBy("type", "verb").agg(F.count(F.lit(1)).alias("events"))


def disposition_counts(log: DataFrame, bad_time: str = "null_week", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Events per (type, disposition)."""
    judged = event_dispositions(log, bad_time, hot_rows)
    return judged.groupBy("type", "disposition").agg(F.count(F.lit(1)).alias("events"))


def rejects_by_reason(log: DataFrame, bad_time: str = "null_week", hot_rows: int = HOT_ROWS) -> DataFrame:
    counts = disposition_counts(log, bad_time, hot_rows).where(F.col("disposition") != APPLIED)
    return counts.groupBy(F.col("disposition").alias("reason")).agg(F.sum("events").alias("events"))


def weekly_visit_histogram(facts: DataFrame, week_policy: str = "sunday_u") -> DataFrame:
    """Visits per customer and week; unreadable times are the week NULL."""
    visits = facts.where(F.col("type") == SITE_VISIT)
    return visits.groupBy("customer_id", week_of(F.col("event_date"), week_policy).alias("week")).agg(
        F.count(F.lit(1)).alias("visits")
    )


def visit_week_map(facts: DataFrame, week_policy: str = "sunday_u") -> DataFrame:
    """The histogram as one map week -> visits per customer.

    A customer has at most 55 weeks of the year, unreadable times being week 54, so the map is bounded.
    """
    if week_policy == "sunday_calendar":
        raise ValueError("calendar weeks are unbounded; use weekly_visit_histogram")
    weekly = weekly_visit_histogram(facts, week_policy)
    entry = F.struct(F.coalesce("week", F.lit(UNKNOWN_WEEK_BIT)).alias("week"), F.col("visits"))
    entries = F.array_sort(F.collect_list(entry))
    return weekly.groupBy("customer_id").agg(F.map_from_entries(entries).alias("weeks"))


def revenue_per_customer(facts: DataFrame) -> DataFrame:
    """Sum of the current order amounts."""
    return facts.where(F.col("type") == ORDER).groupBy("customer_id").agg(F.sum("amount").alias("revenue"))


def visits_per_customer(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("type") == SITE_VISIT).groupBy("customer_id").agg(F.count(F.lit(1)).alias("visits"))


def orphan_facts(entities: Entities) -> DataFrame:
    """Current visits and orders, per customer id, whose customer does not exist.

    Facts are counted per customer before the anti join, so an orphan with very many facts is one row.
    """
    owned = entities.facts.where(F.col("type").isin(SITE_VISIT, ORDER))
    counted = owned.groupBy("customer_id").agg(
        F.count_if(F.col("type") == SITE_VISIT).alias("visits"),
        F.count_if(F.col("type") == ORDER).alias("orders"),
    )
    return counted.join(entities.customer.select("customer_id"), "customer_id", "left_anti")


def customers_without_visits(entities: Entities) -> DataFrame:
    return with_metrics(entities).where(F.col("visits") == 0).drop("visits", "weeks")


def ltv_by_place(scored: DataFrame, outer: str, inner: str) -> DataFrame:
    """Customers and total value per (outer, inner), per outer, and overall.

    `level` tells a total (1: of an outer place, 3: of all) from customers whose place is not known (0).
    """
    return scored.rollup(outer, inner).agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.count(F.lit(1)).alias("customers"), F.sum("ltv").alias("total_ltv"), F.max("ltv").alias("top_ltv")
    )


def top_per_segment(scored: DataFrame, segment: str, k: int) -> DataFrame:
    return top_per_group(scored, segment, k)

