"""Continuous ingest, entity state, weekly counts, removal of repeats and a refreshed top list.

All jobs run until the available input is used up (`availableNow`) unless another trigger is given.
`folder` and `checkpoint` must be shared by all executors; see `session.work_folder`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perennia.functions.weeks import week_start
from perennia.operators.fold import entities_of_state, merge_partials, partial_state, resolve
from perennia.operators.rank import top_x
from perennia.operators.validate import valid_events
from perennia.plans.ltv import ltv, result_columns
from perennia.plans.store import BUCKETS, upsert
from perennia.plans.value_store import KEEP, refresh_value
from perennia.schema import ALL_TYPES, FIRST_WINS, SITE_VISIT
from perennia.sources.event_log import PARTITIONING, log_rows
from perennia.streaming.compaction import compact, live_folders

AVAILABLE_NOW = {"availableNow": True}
_KEYS = ("type", "key")


def _known(log: DataFrame, bad_time: str) -> DataFrame:
    return valid_events(log.where(F.col("type").isin(*ALL_TYPES)), bad_time)


def _write_batch(rows: DataFrame, folder: str, batch: int) -> None:
    # A batch that is tried again replaces its own files, so each counts once.
    rows.write.mode("overwrite").parquet(f"{folder}/batch={batch}")


def _write_state(rows: DataFrame, folder: str, batch: int, compact_every: int) -> None:
    _write_batch(rows, folder, batch)
    if compact_every and (batch + 1) % compact_every == 0:
        compact(rows.sparkSession, folder)


def stream_to_log(events: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append arriving events to the typed, partitioned event log."""
    return (
        log_rows(events)
        .writeStream.format("parquet")
        .partitionBy(*PARTITIONING)
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def stream_state(
    log: DataFrame,
    folder: str,
    checkpoint: str,
    bad_time: str = "null_week",
    trigger: dict | None = None,
    compact_every: int = 0,
) -> StreamingQuery:
    """Entity state as a streaming aggregation in update mode.

    Each batch writes the keys it changed. The state keeps one row per key for ever, since any later
    UPDATE counts; there is no watermark, so no lateness is too late. After every `compact_every`
    batches (0: never) those before are merged, see `compaction`.
    """
    state = partial_state(_known(log, bad_time), *_KEYS)
    return (
        state.writeStream.outputMode("update")
        .foreachBatch(lambda rows, batch: _write_state(rows, folder, batch, compact_every))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def stream_partials(
    log: DataFrame,
    folder: str,
    checkpoint: str,
    bad_time: str = "null_week",
    trigger: dict | None = None,
    compact_every: int = 0,
) -> StreamingQuery:
    """Entity state without a state store: each batch writes its own mergeable aggregates.

    After every `compact_every` batches (0: never) those before are merged, see `compaction`.
    """

    def write(rows: DataFrame, batch: int) -> None:
        _write_state(partial_state(_known(rows, bad_time), *_KEYS), folder, batch, compact_every)

    return (
        log.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def read_state(spark: SparkSession, folder: str) -> DataFrame:
    """Current rows per (type, key) of a `stream_state` or `stream_partials` folder, compacted or not."""
    batches = spark.read.parquet(*live_folders(spark, folder))
    return resolve(merge_partials(batches, *_KEYS), *_KEYS)


def stream_top(
    log: DataFrame,
    folder: str,
    checkpoint: str,
    x: int,
    week_policy: str = "sunday_u",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Refresh the x customers of highest value after every batch, in `folder`/top/batch=N.

    The value stacks two aggregations, which one streaming query cannot; so each batch merges its
    aggregates into a snapshot of the state and the value is computed from that as a batch query.
    Two snapshots take turns: batch N reads that of N-1 and replaces that of N-2, so a batch that is
    tried again finds what it read the first time, and storage stays at twice the state.
    """

    def refresh(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        current, previous = f"{folder}/state/slot={batch % 2}", f"{folder}/state/slot={(batch - 1) % 2}"
        partials = partial_state(_known(rows, "null_week"), *_KEYS)
        if batch > 0:
            partials = merge_partials(partials.unionByName(spark.read.parquet(previous)), *_KEYS)
        partials.write.mode("overwrite").parquet(current)
        state = resolve(spark.read.parquet(current), *_KEYS)
        top = top_x(ltv(entities_of_state(state), week_policy), x)
        _write_batch(result_columns(top), f"{folder}/top", batch)

    return (
        log.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def read_top(spark: SparkSession, folder: str) -> DataFrame:
    """The list of the last batch of `stream_top`."""
    lists = spark.read.parquet(f"{folder}/top")
    return lists.where(F.col("batch") == lists.agg(F.max("batch")).scalar()).drop("batch")


def stream_store(
    log: DataFrame,
    folder: str,
    checkpoint: str,
    bad_time: str = "null_week",
    week_policy: str = "sunday_u",
    buckets: int = BUCKETS,
    keep: int = KEEP,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Entities, rejects and values after every batch, each brought up to date by what the batch changed.

    `folder`/events is a store for the readers of `plans.store`, `folder`/values one for those of `plans.value_store`. A
    late NEW takes its updates out of the rejects; an order that moves is taken from one customer and given to the other.
    Unlike `stream_top` a batch reads and writes the buckets it touches, not the whole state. A batch that is tried again
    finds its number in the store and is not added twice; so a folder belongs to one checkpoint.
    """

    def refresh(rows: DataFrame, batch: int) -> None:
        upsert(rows, f"{folder}/events", bad_time, buckets, batch_id=batch)
        refresh_value(rows.sparkSession, f"{folder}/events", f"{folder}/values", week_policy, buckets=buckets, keep=keep)

    return (
        log.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def stream_weekly_visits(
    log: DataFrame, folder: str, checkpoint: str, bad_time: str = "null_week", trigger: dict | None = None
) -> StreamingQuery:
    """The visits of a log as mergeable state, from which `read_weekly_visits` counts.

    Accepted visits only, each page once, whenever it arrives: no watermark drops a late one.
    """
    return stream_partials(log.where(F.col("type") == SITE_VISIT), folder, checkpoint, bad_time, trigger)


def read_weekly_visits(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted visits per Sunday-to-Saturday week; unreadable times are the week NULL."""
    visits = read_state(spark, folder)
    return visits.groupBy(week_start(F.col("event_date")).alias("week_start")).agg(F.count(F.lit(1)).alias("visits"))


def stream_first_seen(
    log: DataFrame, folder: str, checkpoint: str, bad_time: str = "null_week", trigger: dict | None = None
) -> StreamingQuery:
    """Valid visits and images without repeated keys: the first to arrive stays, repeats are dropped however late.

    The state keeps every key for ever (in RocksDB, on disk), since a watermark would drop late rows
    whose key never came before. For the first by event time use `stream_state`.
    """
    valid = valid_events(log.where(F.col("type").isin(*FIRST_WINS)), bad_time)
    return (
        valid.dropDuplicates(list(_KEYS))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )
