"""The ingest job: raw files to event log, entity tables, rejects and a summary."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from perennia.operators.dispositions import rejects
from perennia.operators.fold import Entities, entities
from perennia.sinks import write_rejects
from perennia.sources.event_log import log_rows, write_event_log
from perennia.sources.json_events import read_events


class Summary(NamedTuple):
    total_events: int
    distinct_customers: int


def _keep_schema(rows: DataFrame, folder: str, name: str) -> None:
    """An empty file that holds the schema: a partitioned folder without rows has no file to take it from."""
    rows.limit(0).write.mode("overwrite").parquet(f"{folder}/schema/{name}")


def read_stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table that `ingest` wrote: event_log, customer, facts or rejects; typed even if it has no rows."""
    schema = spark.read.parquet(f"{folder}/schema/{name}").schema
    return spark.read.schema(schema).parquet(f"{folder}/{name}")


def ingest(events: DataFrame, folder: str, bad_time: str = "null_week") -> Summary:
    """Store events as a log and as current entities below `folder`, replacing what is there.

    Customers are counted while their table is written, events from the footers of the log's files.
    """
    write_event_log(events, f"{folder}/event_log", mode="overwrite")
    _keep_schema(log_rows(events), folder, "event_log")
    return _derive(read_stored(events.sparkSession, folder, "event_log"), folder, bad_time)


def _derive(log: DataFrame, folder: str, bad_time: str) -> Summary:
    """Replace the entity tables and the rejects by those of the log."""
    known = Observation("customers")
    current, refused = entities(log, bad_time), rejects(log, bad_time)
    people = current.customer.observe(known, F.count(F.lit(1)).alias("total"))
    people.write.mode("overwrite").parquet(f"{folder}/customer")
    current.facts.write.mode("overwrite").partitionBy("type").parquet(f"{folder}/facts")
    write_rejects(refused, f"{folder}/rejects")
    for name, rows in (("customer", current.customer), ("facts", current.facts), ("rejects", refused)):
        _keep_schema(rows, folder, name)
    # The number of rows is in the footers of the log's files.
    return Summary(log.count(), known.get["total"])


def ingest_more(events: DataFrame, folder: str, bad_time: str = "null_week") -> Summary:
    """Add events to a store that `ingest` wrote and bring its tables up to date; the counts are those of the store.

    The log only grows; entities and rejects follow from all of it, since a late NEW may change what
    became of events long stored. Positions must not repeat from call to call, as those of files do not.
    """
    write_event_log(events, f"{folder}/event_log", mode="append")
    return _derive(read_stored(events.sparkSession, folder, "event_log"), folder, bad_time)


def ingest_files(spark: SparkSession, input_path: str, folder: str, glob: str = "*") -> Summary:
    """`ingest` of a folder of JSON array files."""
    return ingest(read_events(spark, input_path, glob), folder)


def stored_entities(spark: SparkSession, folder: str) -> Entities:
    """Entities that `ingest` wrote."""
    return Entities(customer=read_stored(spark, folder, "customer"), facts=read_stored(spark, folder, "facts"))
