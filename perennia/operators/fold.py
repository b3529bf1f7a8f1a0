"""Fold of out-of-order inserts and updates into current entity rows.

Applied one by one in order, events of one key do this: the first NEW inserts, later NEWs are
refused, UPDATEs before it are refused, and each later UPDATE replaces the whole row. The outcome is
the last UPDATE if it came after the first NEW, else that NEW. So two pairs of aggregates hold it,

    min(NEW seq) with its row        max(UPDATE seq) with its row

and both merge in any order. They combine before the shuffle, which leaves one row per key and task
even when a third of the log has the same key, and they run unchanged as a streaming aggregation.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from perennia.operators.validate import valid_events
from perennia.schema import (
    ALL_TYPES,
    AMOUNT,
    CUSTOMER,
    CUSTOMER_FIELDS,
    FACT_FIELDS,
    FIRST_WINS,
    IMAGE,
    NEW,
    ORDER,
    PAYLOAD,
    SITE_VISIT,
)

# True for a valid event that can create its entity, and the positions of those that do or change it.
OPENS = "(type IN (" + ", ".join(f"'{t}'" for t in FIRST_WINS) + f") OR verb = '{NEW}')"
_OPENED = f"CASE WHEN {OPENS} THEN seq END"
_CHANGED = f"CASE WHEN NOT {OPENS} THEN seq END"


def opens() -> Column:
    return F.expr(OPENS)


def partial_state(valid: DataFrame, *keys: str, columns: tuple[str, ...] = PAYLOAD) -> DataFrame:
    """The mergeable aggregates per key; also valid on a streaming DataFrame.

    A fixed-width position (a number) gives each column its own `min_by`/`max_by`: Catalyst drops
    those a query does not read, and without text columns the aggregate stays a hash aggregate.
    A wide position (that of files) would be stored again with each column, so there one struct
    holds position and columns; name only the `columns` needed.
    """
    columns = [c for c in columns if c in valid.columns and c not in keys]
    if isinstance(valid.schema["seq"].dataType, StructType):
        row = f"struct({', '.join(['seq', *columns])})"
        packed = valid.groupBy(*keys).agg(
            F.expr(f"min(CASE WHEN {OPENS} THEN {row} END) AS opened"),
            F.expr(f"max(CASE WHEN NOT {OPENS} THEN {row} END) AS changed"),
        )
        flat = [f"{part}.{c} AS {c}_{part}" for c in columns for part in ("opened", "changed")]
        return packed.selectExpr(*keys, "opened.seq AS first_seq", "changed.seq AS changed_seq", *flat)
    aggregates = [f"min({_OPENED}) AS first_seq", f"max({_CHANGED}) AS changed_seq"]
    for c in columns:
        aggregates.append(f"min_by({c}, {_OPENED}) AS {c}_opened")
        aggregates.append(f"max_by({c}, {_CHANGED}) AS {c}_changed")
    return valid.groupBy(*keys).agg(*map(F.expr, aggregates))


def _payload(partial: DataFrame) -> list[str]:
    return [c.removesuffix("_opened") for c in partial.columns if c.endswith("_opened")]


def merge_partials(partials: DataFrame, *keys: str) -> DataFrame:
    """One row per key out of several `partial_state` results; merging a result twice does no harm."""
    aggregates = ["min(first_seq) AS first_seq", "max(changed_seq) AS changed_seq"]
    for c in _payload(partials):
        aggregates.append(f"min_by({c}_opened, first_seq) AS {c}_opened")
        aggregates.append(f"max_by({c}_changed, changed_seq) AS {c}_changed")
    return partials.groupBy(*keys).agg(*map(F.expr, aggregates))


def resolve(partial: DataFrame, *keys: str) -> DataFrame:
    """Current rows out of the aggregates of `partial_state`; keys without a NEW have none."""
    rows = [f"if(changed_seq > first_seq, {c}_changed, {c}_opened) AS {c}" for c in _payload(partial)]
    last = "if(changed_seq > first_seq, changed_seq, first_seq) AS last_seq"
    return partial.where("first_seq IS NOT NULL").selectExpr(*keys, "first_seq", last, *rows)


def fold(
    log: DataFrame,
    types: tuple[str, ...] = ALL_TYPES,
    bad_time: str = "null_week",
    columns: tuple[str, ...] = PAYLOAD,
) -> DataFrame:
    """One current row per (type, key) of the given entity types, with those of `columns` the log has.

    A single type is grouped by key alone, so the result is partitioned by key for the next join.
    """
    wanted = valid_events(log.where(F.col("type").isin(*types)), bad_time)
    keys = ("key",) if len(types) == 1 else ("type", "key")
    state = resolve(partial_state(wanted, *keys, columns=columns), *keys)
    return state.select(F.lit(types[0]).alias("type"), *state.columns) if len(types) == 1 else state


class Entities(NamedTuple):
    """Current customers, and the current facts: visits, images and orders in one DataFrame.

    Facts share one DataFrame so that an analytic over visits and orders scans the log once; the
    views below filter it, and Catalyst pushes that filter down to the scan.
    """

    customer: DataFrame
    facts: DataFrame

    def _view(self, kind: str, key: str, columns: tuple[str, ...]) -> DataFrame:
        rows = self.facts.where(F.col("type") == kind)
        return rows.select(F.col("key").alias(key), *[c for c in columns if c in rows.columns])

    @property
    def site_visit(self) -> DataFrame:
        return self._view(SITE_VISIT, "page_id", ("customer_id", "event_time", "event_date", "tags", "first_seq"))

    @property
    def image(self) -> DataFrame:
        return self._view(
            IMAGE, "image_id", ("customer_id", "event_time", "event_date", "camera_make", "camera_model", "first_seq")
        )

    @property
    def orders(self) -> DataFrame:
        columns = ("customer_id", "amount", "event_time", "event_date", "first_seq", "last_seq")
        return self._view(ORDER, "order_id", columns)


def entities(log: DataFrame, bad_time: str = "null_week", columns: tuple[str, ...] = FACT_FIELDS) -> Entities:
    """Current entity tables of a log; facts carry those of `columns` the log has."""
    return Entities(
        customer=customer_rows(fold(log, (CUSTOMER,), bad_time, CUSTOMER_FIELDS)),
        facts=fold(log, (SITE_VISIT, IMAGE, ORDER), bad_time, columns),
    )


def customer_rows(state: DataFrame) -> DataFrame:
    """Customers out of folded rows."""
    people = state.where(F.col("type") == CUSTOMER)
    fields = [c for c in CUSTOMER_FIELDS if c in people.columns]
    return people.select(F.col("key").alias("customer_id"), *fields, "first_seq", "last_seq")


def entities_of_state(state: DataFrame) -> Entities:
    """Entities out of folded rows of all types, such as a stored streaming state."""
    return Entities(customer=customer_rows(state), facts=state.where(F.col("type") != CUSTOMER))


def entities_of(customer: DataFrame, site_visit: DataFrame, orders: DataFrame) -> Entities:
    """Entities out of ready relations keyed by `key`: visits (customer_id, event_date), orders (+ amount)."""
    no_amount = F.lit(None).cast(AMOUNT).alias("amount")
    visits = site_visit.select(F.lit(SITE_VISIT).alias("type"), "key", "customer_id", "event_date", no_amount)
    sales = orders.select(F.lit(ORDER).alias("type"), "key", "customer_id", "event_date", "amount")
    return Entities(customer=customer, facts=visits.unionByName(sales))
