"""An event store that takes new events without folding the old ones again.

The mergeable state of the fold (see `operators.fold`) lies in hash buckets of (type, key), and so do the rejects.
`upsert` merges the state of the new events into the buckets they touch and rewrites those alone; what became of
old events changes only where a late NEW comes before all others of its key, and there the stored rejects
say which updates now apply. The log only grows, and is asked only for the events that such a NEW displaced.

Nothing is replaced in place. Each run writes folders of its own, and a manifest names those that make up a version: writing
it is the commit. A run that fails leaves the version before it as it was, and readers keep the one they opened.

    folder/manifest/00000003.json                     what version 3 consists of
    folder/log/run=<run>/type=../event_date=..        events as they came
    folder/state/<run>/bucket=..                      first and last positions per key, with their columns
    folder/rejects/<run>/bucket=..                    events not applied
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perennia.operators.dispositions import event_dispositions, reject_rows
from perennia.operators.fold import Entities, entities_of_state, merge_partials, partial_state, resolve
from perennia.operators.validate import valid_events
from perennia.plans.ingest import Summary
from perennia.schema import ALL_TYPES, CUSTOMER, DUPLICATE_KEY, DUPLICATE_NEW, FIRST_WINS, UPDATE_WITHOUT_KEY
from perennia.sources.event_log import log_rows, write_event_log

#: A bucket should stay near 200 MB, so a store of 10^11 keys takes some 100,000.
BUCKETS = 64
_KEYS = ("type", "key")


class Manifest(NamedTuple):
    """One version: runs of the log, the run each bucket of state and rejects was written by, and counts."""

    version: int = 0
    buckets: int = BUCKETS
    bad_time: str = "null_week"
    events: int = 0
    log: tuple[str, ...] = ()
    state: dict[int, str] = {}
    rejects: dict[int, str] = {}
    customers: dict[int, int] = {}
    # The last batch of a stream that is in it.
    batch: int = -1


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, folder: str) -> list[int]:
    path, files = _files(spark, folder)
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def read_manifest(spark: SparkSession, folder: str, version: int | None = None) -> Manifest | None:
    """The given version, or the last one that was written to its end; None for a folder without any."""
    for v in reversed(_versions(spark, folder)) if version is None else [version]:
        text = "".join(r.value for r in spark.read.text(f"{folder}/manifest/{v:08d}.json", wholetext=True).collect())
        try:
            found = json.loads(text)
        except ValueError:
            continue  # a run was stopped while it committed
        found["log"] = tuple(found["log"])
        for name in ("state", "rejects", "customers"):
            found[name] = {int(k): x for k, x in found[name].items()}
        return Manifest(**found)
    return None


def _commit(spark: SparkSession, folder: str, manifest: Manifest) -> None:
    """Make a version visible; fails if another writer was first."""
    _, files = _files(spark, folder)
    out = files.create(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest/{manifest.version:08d}.json"), False)
    out.write(bytearray(json.dumps(manifest._asdict()).encode()))
    out.close()


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col("type").cast("string"), F.col("key").cast("string")), F.lit(buckets)).cast("int")


def _keep_schema(rows: DataFrame, folder: str, name: str) -> None:
    rows.limit(0).write.mode("ignore").parquet(f"{folder}/schema/{name}")


def _read(spark: SparkSession, folder: str, name: str, paths: list[str]) -> DataFrame:
    """Rows of these folders, typed even if there are none."""
    kind = spark.read.parquet(f"{folder}/schema/{name}").schema
    return spark.read.schema(kind).parquet(*paths) if paths else spark.createDataFrame([], kind)


def _log(spark: SparkSession, folder: str, runs: tuple[str, ...]) -> DataFrame:
    """The events of these runs."""
    if not runs:
        return _read(spark, folder, "log", [])
    kind = spark.read.parquet(f"{folder}/schema/log").schema
    reader = spark.read.schema(kind).option("basePath", f"{folder}/log")
    return reader.parquet(*[f"{folder}/log/run={run}" for run in runs]).drop("run")


def _buckets(spark: SparkSession, folder: str, name: str, runs: dict[int, str], wanted: set[int] | None = None) -> DataFrame:
    """The rows of the wanted buckets, or of all; the files of others are not opened."""
    paths = [f"{folder}/{name}/{run}/bucket={b}" for b, run in sorted(runs.items()) if wanted is None or b in wanted]
    return _read(spark, folder, name, paths)


def _write_buckets(rows: DataFrame, folder: str, name: str, run: str, buckets: int) -> None:
    _keep_schema(rows, folder, name)
    out = rows.withColumn("bucket", bucket_of(buckets)).hint("rebalance", "bucket")
    out.write.partitionBy("bucket").parquet(f"{folder}/{name}/{run}")


def _written(spark: SparkSession, folder: str, name: str, run: str, count: Column) -> dict[int, int]:
    """For each bucket that the run wrote, the rows that `count` counts."""
    kind = spark.read.parquet(f"{folder}/schema/{name}").schema.add("bucket", "integer")
    rows = spark.read.schema(kind).parquet(f"{folder}/{name}/{run}").groupBy("bucket").agg(F.count(count).alias("n"))
    return {r["bucket"]: r["n"] for r in rows.collect()}


def _first_rows(state: DataFrame) -> DataFrame:
    date = ["event_date_opened"] if "event_date_opened" in state.columns else []
    return state.where("first_seq IS NOT NULL").select(*_KEYS, "first_seq", *date)


def _displaced(old_log: DataFrame, old: DataFrame, fresh: DataFrame) -> DataFrame:
    """The old log's events that had created their key until a NEW of the fresh state came before them."""
    earlier = fresh.where("first_seq IS NOT NULL").select(*_KEYS, F.col("first_seq").alias("now_first"))
    gone = _first_rows(old).join(earlier, list(_KEYS)).where("now_first < first_seq").drop("now_first")
    gone = gone.withColumnsRenamed({"first_seq": "seq", "event_date_opened": "event_date"})
    if "event_date" not in gone.columns:
        return old_log.join(gone, [*_KEYS, "seq"], "left_semi")
    # By type and date only those folders of the log are read.
    dated = old_log.where("event_date IS NOT NULL").join(gone, [*_KEYS, "event_date", "seq"], "left_semi")
    undated = old_log.where("event_date IS NULL").join(gone.where("event_date IS NULL").drop("event_date"), [*_KEYS, "seq"], "left_semi")
    return dated.unionByName(undated)


def upsert(
    events: DataFrame, folder: str, bad_time: str = "null_week", buckets: int = BUCKETS, batch_id: int | None = None
) -> Summary:
    """Add events to the store in `folder`, which begins with its first; returns the counts of the whole store.

    The result is that of one ingest of all events, whatever order they come in. Positions (`seq`) must not repeat
    from call to call, as those of files do not. `bad_time` and `buckets` are fixed by the first call. A stream numbers its
    batches by `batch_id`: one that is already in the store is not added again.
    """
    spark = events.sparkSession
    before = read_manifest(spark, folder)
    if before is None:
        before = Manifest(buckets=buckets, bad_time=bad_time)
    elif before.bad_time != bad_time:
        raise ValueError(f"the store was made with bad_time {before.bad_time!r}")
    if batch_id is not None and batch_id <= before.batch:
        return Summary(before.events, sum(before.customers.values()))
    version = max([before.version, *_versions(spark, folder)]) + 1
    run, count = f"{version:08d}-{uuid.uuid4().hex}", before.buckets

    _keep_schema(log_rows(events), folder, "log")
    write_event_log(events, f"{folder}/log/run={run}")
    batch = _log(spark, folder, (run,))
    touched = {r["bucket"] for r in batch.select(bucket_of(count).alias("bucket")).distinct().collect()}

    fresh = partial_state(valid_events(batch.where(F.col("type").isin(*ALL_TYPES)), bad_time), *_KEYS)
    _keep_schema(fresh, folder, "state")
    old = _buckets(spark, folder, "state", before.state, touched)
    _write_buckets(merge_partials(old.unionByName(fresh, allowMissingColumns=True), *_KEYS), folder, "state", run, count)
    customer = F.when((F.col("type") == CUSTOMER) & F.col("first_seq").isNotNull(), 1)
    customers = _written(spark, folder, "state", run, customer)
    state = _buckets(spark, folder, "state", dict.fromkeys(customers, run))

    firsts = _first_rows(state).select(*_KEYS, "first_seq")
    refused = reject_rows(event_dispositions(batch, bad_time, known=firsts))
    _keep_schema(refused, folder, "rejects")
    if before.log:
        stored = _buckets(spark, folder, "rejects", before.rejects, touched)
        # An update that came before its key did applies, now that an earlier NEW is known.
        known = stored.join(firsts, list(_KEYS), "left")
        still = known.where((F.col("reason") != UPDATE_WITHOUT_KEY) | F.col("first_seq").isNull() | (F.col("seq") < F.col("first_seq")))
        old_log = _log(spark, folder, before.log)
        again = F.when(F.col("type").isin(*FIRST_WINS), DUPLICATE_KEY).otherwise(DUPLICATE_NEW)
        displaced = reject_rows(_displaced(old_log, old, fresh).withColumn("disposition", again))
        refused = refused.unionByName(still.drop("first_seq")).unionByName(displaced)
    _write_buckets(refused, folder, "rejects", run, count)
    with_rejects = _written(spark, folder, "rejects", run, F.lit(1))

    def now(old_runs: dict[int, str], written: dict[int, int]) -> dict[int, str]:
        return {b: r for b, r in old_runs.items() if b not in touched} | dict.fromkeys(written, run)

    after = Manifest(
        version,
        count,
        bad_time,
        before.events + batch.count(),
        (*before.log, run),
        now(before.state, customers),
        now(before.rejects, with_rejects),
        {b: n for b, n in before.customers.items() if b not in touched} | customers,
        before.batch if batch_id is None else batch_id,
    )
    _commit(spark, folder, after)
    return Summary(after.events, sum(after.customers.values()))


def _opened(spark: SparkSession, folder: str, version: int | None) -> Manifest:
    found = read_manifest(spark, folder, version)
    if found is None:
        raise FileNotFoundError(f"no store in {folder}")
    return found


def store_summary(spark: SparkSession, folder: str, version: int | None = None) -> Summary:
    """Counts of a version, the last one unless told otherwise."""
    found = _opened(spark, folder, version)
    return Summary(found.events, sum(found.customers.values()))


def store_entities(spark: SparkSession, folder: str, version: int | None = None) -> Entities:
    """Current entities: one row per key is stored, so nothing is shuffled."""
    found = _opened(spark, folder, version)
    return entities_of_state(resolve(_buckets(spark, folder, "state", found.state), *_KEYS))


def store_rejects(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """Events not applied, as `dispositions.rejects` gives them for the whole log."""
    found = _opened(spark, folder, version)
    return _buckets(spark, folder, "rejects", found.rejects)


def store_log(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """All events, with filters on type and date pruning folders."""
    found = _opened(spark, folder, version)
    return _log(spark, folder, found.log)


def unused_runs(spark: SparkSession, folder: str, keep: int = 1) -> list[str]:
    """Folders that none of the last `keep` complete versions names, for a clean-up when no reader is on an older one."""
    manifests = [m for v in _versions(spark, folder) if (m := read_manifest(spark, folder, v))][-keep:]
    named = {f"log/run={r}" for m in manifests for r in m.log}
    named |= {f"{name}/{r}" for m in manifests for name in ("state", "rejects") for r in getattr(m, name).values()}
    _, files = _files(spark, folder)
    found = []
    for name in ("log", "state", "rejects"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        if files.exists(path):
            found += [f"{name}/{status.getPath().getName()}" for status in files.listStatus(path)]
    return sorted(f"{folder}/{run}" for run in set(found) - named)
