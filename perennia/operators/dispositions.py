"""What became of every single event, and the table of those not applied."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.operators.fold import opens
from perennia.operators.lookup import HOT_ROWS, attach_first
from perennia.operators.validate import fault
from perennia.schema import (
    APPLIED,
    CORRUPT_COLUMN,
    DUPLICATE_KEY,
    DUPLICATE_NEW,
    FIRST_WINS,
    UPDATE_WITHOUT_KEY,
)


# Columns that were not in the event itself.
_DERIVED = (CORRUPT_COLUMN, "seq", "event_date", "ts", "amount", "source_type")


def event_dispositions(
    log: DataFrame, bad_time: str = "null_week", hot_rows: int = HOT_ROWS, known: DataFrame | None = None
) -> DataFrame:
    """The log with a column `disposition`; one row per event.

    `known` (type, key, first_seq) has the positions at which keys were created by events that are not in the log.
    """
    marked = log.withColumn("_fault", fault(log.columns, bad_time))
    # Faulty events belong to no group.
    valid = F.col("_fault").isNull()
    opened = F.when(opens(), F.col("seq"))
    groups, position = None, opened
    if known is not None:
        here = marked.where(valid).select("type", "key", opened.alias("_opened"), "_fault")
        there = known.select("type", "key", F.col("first_seq").alias("_opened"), F.lit(None).cast("string").alias("_fault"))
        groups, position = here.unionByName(there), F.col("_opened")
    located = attach_first(marked, ["type", "key"], position, "_first_seq", valid, hot_rows, groups)
    seq, first = F.col("seq"), F.col("_first_seq")
    disposition = (
        F.when(F.col("_fault").isNotNull(), F.col("_fault"))
        .when(opens() & (seq == first), APPLIED)
        .when(F.col("type").isin(*FIRST_WINS), DUPLICATE_KEY)
        .when(opens(), DUPLICATE_NEW)
        .when(seq > first, APPLIED)
        .otherwise(UPDATE_WITHOUT_KEY)
    )
    return located.withColumn("disposition", disposition).select(*log.columns, "disposition")


def reject_rows(judged: DataFrame) -> DataFrame:
    """Events not applied of a log with dispositions: (reason, type, verb, key, seq, raw), raw being the event as JSON text."""
    columns = [c for c in judged.columns if c != "disposition"]
    event = F.to_json(F.struct(*[c for c in columns if c not in _DERIVED]))
    raw = F.coalesce(F.col(CORRUPT_COLUMN), event) if CORRUPT_COLUMN in columns else event
    # A log stores unknown types under one name, and the original beside it.
    kind = F.coalesce("source_type", "type").alias("type") if "source_type" in columns else F.col("type")
    return judged.where(F.col("disposition") != APPLIED).select(
        F.col("disposition").alias("reason"), kind, "verb", "key", "seq", raw.alias("raw")
    )


def rejects(log: DataFrame, bad_time: str = "null_week", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Events not applied, as `reject_rows` has them."""
    return reject_rows(event_dispositions(log, bad_time, hot_rows))
