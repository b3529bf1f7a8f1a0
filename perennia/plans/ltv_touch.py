"""Customer lifetime value of the `touch` policy: every accepted event of a customer is one visit.

A customer exists from the first NEW CUSTOMER or SITE_VISIT on. From then: customer events count each,
pages and images count once per customer, and orders follow NEW/UPDATE rules within their customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.functions.money import count_ratio, lifetime_value, per_unit
from perennia.functions.weeks import week_bits
from perennia.operators.lookup import HOT_ROWS, attach_first
from perennia.operators.validate import valid_events
from perennia.schema import ALL_TYPES, AMOUNT, CUSTOMER, CUSTOMER_FIELDS, MONEY, NEW, ORDER, SITE_VISIT, UPDATE


def alive_events(log: DataFrame, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Valid events, with column `owner`, from the one on that brought their customer into being.

    They come in two parts: events that can bring a customer into being, which all count and need not
    meet the others of their customer, and the rest, of which those after the first of these count.
    """
    events = valid_events(log.where(F.col("type").isin(*ALL_TYPES)))
    owned = events.withColumn("owner", F.when(F.col("type") == CUSTOMER, F.col("key")).otherwise(F.col("customer_id")))
    creates = (F.col("type") == SITE_VISIT) | ((F.col("type") == CUSTOMER) & (F.col("verb") == NEW))
    position = F.when(creates, F.col("seq"))
    others = attach_first(owned.where(~creates), ["owner"], position, "born_seq", hot_rows=hot_rows, groups=owned)
    return owned.where(creates), others.where(F.col("seq") > F.col("born_seq")).drop("born_seq")


def customer_touches(log: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(customer_id, first_seq, visits, weeks, revenue) of every customer that came into being."""
    creators, others = alive_events(log.withColumn("week_bit", week_bits(F.col("event_date"))), hot_rows)

    # Pages and images count once per customer; a customer event is its own group by its position.
    own_seq = F.when(F.col("type") == CUSTOMER, F.col("seq"))
    once = (
        creators.unionByName(others.where(F.col("type") != ORDER))
        .groupBy("owner", "type", "key", own_seq.alias("own_seq"))
        .agg(F.min_by("week_bit", "seq").alias("week_bit"), F.min("seq").alias("first_seq"))
        .select(
            "owner", "first_seq", F.lit(1).cast("bigint").alias("visits"), "week_bit", F.lit(None).cast(AMOUNT).alias("amount")
        )
    )

    sales = others.where(F.col("type") == ORDER)
    is_new = F.col("verb") == NEW
    placed = attach_first(sales, ["owner", "key"], F.when(is_new, F.col("seq")), "placed_seq", hot_rows=hot_rows)
    accepted = placed.where(
        (F.col("seq") == F.col("placed_seq")) | ((F.col("verb") == UPDATE) & (F.col("seq") > F.col("placed_seq")))
    )
    per_order = (
        accepted.groupBy("owner", "key")
        .agg(
            F.count(F.lit(1)).alias("visits"),
            F.bit_or("week_bit").alias("week_bit"),
            F.max_by("amount", "seq").alias("amount"),
            F.min("seq").alias("first_seq"),
        )
        .drop("key")
    )

    return (
        once.unionByName(per_order)
        .groupBy(F.col("owner").alias("customer_id"))
        .agg(
            F.min("first_seq").alias("first_seq"),
            F.sum("visits").alias("visits"),
            F.bit_count(F.bit_or("week_bit")).cast("bigint").alias("weeks"),
            F.coalesce(F.sum("amount"), F.lit(0).cast(AMOUNT)).alias("revenue"),
        )
    )


def touch_ltv(
    log: DataFrame, weeks_per_year: int = 52, lifespan_years: int | float = 10, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(customer_id, first_seq, visits, weeks, revenue, revenue_per_visit, visits_per_week, ltv).

    Revenue per visit is 0 unless revenue is positive.
    """
    touches = customer_touches(log, hot_rows)
    rated = touches.withColumns(
        {
            "revenue_per_visit": F.when(
                F.col("revenue") > 0, per_unit(F.col("revenue"), F.col("visits"))
            ).otherwise(F.lit(0).cast(MONEY)),
            "visits_per_week": count_ratio(F.col("visits"), F.col("weeks")),
        }
    )
    value = lifetime_value(F.col("revenue_per_visit"), F.col("visits_per_week"), weeks_per_year, lifespan_years)
    return rated.withColumn("ltv", value)


def touch_profiles(log: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Attributes of every customer that came into being: those of its last customer event, if any."""
    creators, others = alive_events(log, hot_rows)
    alive = creators.unionByName(others)
    position = F.when(F.col("type") == CUSTOMER, F.col("seq"))
    fields = [F.max_by(F.col(c), position).alias(c) for c in CUSTOMER_FIELDS if c in log.columns]
    return alive.groupBy(F.col("owner").alias("customer_id")).agg(F.max(position).alias("profile_seq"), *fields)
