"""The typed Parquet event log, partitioned by type and event date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennia.schema import ALL_TYPES


PARTITIONING = ("type", "event_date")


def log_rows(events: DataFrame) -> DataFrame:
    """Events as the log stores them: unknown types share the name OTHER, so that their number does
    not matter to the folders; the original stays in `source_type`."""
    kind = F.when(F.col("type").isNull() | F.col("type").isin(*ALL_TYPES), F.col("type")).otherwise("OTHER")
    source = F.coalesce("source_type", "type") if "source_type" in events.columns else F.col("type")
    return events.withColumn("source_type", source).withColumn("type", kind)


def write_event_log(events: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write events to a log that a reader of one type or period need not scan whole.

    REBALANCE lets AQE split a hot type and day over many files and put small ones together.
    """
    log = log_rows(events).hint("rebalance", *PARTITIONING)
    log.write.mode(mode).partitionBy(*PARTITIONING).parquet(path)


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """The log written by `write_event_log`; filters on type and event date prune its folders."""
    log = spark.read.parquet(path)
    return log.withColumns({"type": F.col("type").cast("string"), "event_date": F.col("event_date").cast("date")})


def union_logs(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Events of several logs as one; a field one of them lacks is NULL.

    Their positions must be of one kind and must not repeat from log to log, as those of files do not.
    """
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
