"""Event logs and entity relations derived from star-schema tables; all are plain projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.functions.money import parse_amount
from perennia.operators.fold import Entities, customer_rows, fold
from perennia.schema import AMOUNT, CUSTOMER, CUSTOMER_FIELDS, FACT_FIELDS, IMAGE, ORDER, SITE_VISIT

# Which event type of the clickstream plays which entity event.
ROLE = {"signup": CUSTOMER, "view": SITE_VISIT, "click": IMAGE, "purchase": ORDER}


def event_log_from_tables(events: DataFrame, types: tuple[str, ...] | None = None) -> DataFrame:
    """The four-type event log out of the clickstream table `events`, or only some of its types.

    Keys are derived so that every rule has work: pages and images repeat, two users share order
    keys (an UPDATE then moves revenue), some times and amounts are unreadable, and `error` rows are
    of no known type. `types` filters the source column, which the scan can use; a filter on the
    derived `type` could not reach it.
    """
    if types is not None:
        events = events.where(F.col("event_type").isin(*[name for name, role in ROLE.items() if role in types]))
    # A generator parses the JSON once per row. As a plain function it would be inlined, and parsed
    # again, wherever a filter or column uses `k`.
    parsed = events.select("*", F.json_tuple("props", "k").alias("k_text")).withColumn("k", F.expr("int(k_text)"))
    roles = " ".join(f"WHEN '{name}' THEN '{role}'" for name, role in ROLE.items())
    return parsed.selectExpr(
        "event_id AS seq",
        f"CASE event_type {roles} ELSE 'OTHER' END AS type",
        "CASE WHEN event_type = 'click' THEN 'UPLOAD' WHEN event_type = 'view' THEN 'NEW'"
        " WHEN k % 3 = 0 THEN 'UPDATE' ELSE 'NEW' END AS verb",
        "CASE event_type WHEN 'signup' THEN user_id WHEN 'purchase' THEN (user_id div 2) * 10 + k % 7"
        " ELSE event_id div 2 END AS key",
        "user_id AS customer_id",
        "ts",
        "CASE WHEN k % 19 <> 0 THEN date(ts) END AS event_date",
        "CASE WHEN event_type = 'purchase' THEN"
        " if(k % 17 = 0, 'N/A', concat(CAST(value AS DECIMAL(18,2)), ' USD')) END AS total_amount",
        "CASE WHEN event_type = 'signup' AND k % 7 <> 0 THEN concat('Name', k) END AS last_name",
        "CASE WHEN event_type = 'signup' AND k % 11 <> 0 THEN concat('City', k % 10) END AS adr_city",
        "CASE WHEN event_type = 'signup' THEN concat('State', k % 5) END AS adr_state",
        "CASE WHEN event_type = 'view' THEN if(event_id % 2 = 0, props, concat('[', props, ']')) END AS tags",
        "CASE WHEN event_type = 'click' AND k % 4 <> 0 THEN concat('Make', k % 4) END AS camera_make",
        "CASE WHEN event_type = 'click' THEN concat('Model', k % 9) END AS camera_model",
    ).withColumn("amount", parse_amount(F.col("total_amount")))


def entities_from_tables(
    events: DataFrame, bad_time: str = "null_week", columns: tuple[str, ...] = FACT_FIELDS
) -> Entities:
    """Current entities of the clickstream table; each side scans only the event types it needs."""
    people, facts = (CUSTOMER,), (SITE_VISIT, IMAGE, ORDER)
    return Entities(
        customer=customer_rows(fold(event_log_from_tables(events, people), people, bad_time, CUSTOMER_FIELDS)),
        facts=fold(event_log_from_tables(events, facts), facts, bad_time, columns),
    )


def relations_from_orders(customer: DataFrame, nation: DataFrame, orders: DataFrame):
    """(customer, site_visit, orders) relations: every order is one visit and one revenue fact."""
    people = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("last_name"),
        F.col("n_name").alias("adr_city"),
        F.col("c_mktsegment").alias("adr_state"),
    )
    facts = orders.select(
        F.col("o_orderkey").alias("key"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("event_date"),
        F.col("o_totalprice").cast(AMOUNT).alias("amount"),
    )
    return people, facts.drop("amount"), facts
