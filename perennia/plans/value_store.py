"""Customer value brought up to date by what changed in an event store (see `plans.store`).

An event may take from one customer and give to another: an UPDATE moves an order, an earlier NEW replaces a visit. So the value
is kept as sums that can be taken back, one row per customer and week with its visits and revenue:

1. the manifests of two versions of the store tell which of its buckets changed; only those are read, before and after;
2. each current fact counts -1 before and +1 after, so what did not change cancels out in one aggregation that
   combines before the shuffle; what is left are the changes;
3. they are added to the buckets of the customers they touch, and those customers' buckets are valued again.

A week counts while its visits are above 0. That holds for calendar weeks as well as for weeks of the year, and needs no set.
Every bucket keeps its highest customers, so a list of them is read from these, and not from all customers.

Versions are committed by a manifest as in the store: a run that fails leaves the version before it.

    folder/manifest/00000003.json           the store's version that is valued, and the run of each bucket
    folder/weeks/<run>/bucket=..            visits and revenue per customer and week
    folder/scored/<run>/bucket=..           valued customers
    folder/top/<run>/bucket=..              the `keep` highest of each bucket
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perennia.functions.weeks import distinct_week_code
from perennia.operators.fold import customer_rows, resolve
from perennia.operators.rank import top_x
from perennia.plans.ltv import LIFESPAN_YEARS, WEEKS_PER_YEAR, attach_metrics, score
from perennia.plans.store import Manifest, _buckets, _commit, _keep_schema, _versions, read_manifest
from perennia.schema import CUSTOMER_FIELDS, ORDER, SITE_VISIT
from perennia.session import cut

#: A bucket should stay near 200 MB, as in the store.
BUCKETS = 64
#: So many customers of each bucket are kept apart; a longer list is read from all customers.
KEEP = 1000
_KEYS = ("type", "key")
_PERSON = ("customer_id", *CUSTOMER_FIELDS, "first_seq", "last_seq")


class Values(NamedTuple):
    """One version: the store's version it values, how, and the run each bucket was written by."""

    version: int = 0
    source: int = 0
    buckets: int = BUCKETS
    keep: int = KEEP
    week_policy: str = "sunday_u"
    weeks_per_year: int = WEEKS_PER_YEAR
    lifespan_years: float = LIFESPAN_YEARS
    weeks: dict[int, str] = {}
    scored: dict[int, str] = {}


def read_values(spark: SparkSession, folder: str, version: int | None = None) -> Values | None:
    """The given version, or the last one written to its end; None for a folder without any."""
    for v in reversed(_versions(spark, folder)) if version is None else [version]:
        text = "".join(r.value for r in spark.read.text(f"{folder}/manifest/{v:08d}.json", wholetext=True).collect())
        try:
            found = json.loads(text)
        except ValueError:
            continue  # a run was stopped while it committed
        for name in ("weeks", "scored"):
            found[name] = {int(k): x for k, x in found[name].items()}
        return Values(**found)
    return None


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col("customer_id").cast("string")), F.lit(buckets)).cast("int")


def _signed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Current rows before and after, told apart by `sign`."""
    return before.withColumn("sign", F.lit(-1)).unionByName(after.withColumn("sign", F.lit(1)), allowMissingColumns=True)


def _added(rows: DataFrame) -> DataFrame:
    """Visits and revenue per customer and week, of the rows that come to anything."""
    sums = rows.groupBy("customer_id", "week").agg(F.sum("visits").alias("visits"), F.sum("revenue").alias("revenue"))
    return sums.where("visits <> 0 OR revenue <> 0")


def fact_changes(before: DataFrame, after: DataFrame, week_policy: str = "sunday_u") -> DataFrame:
    """(customer_id, week, visits, revenue) to add, from current facts before and after; orders have no week."""
    facts = _signed(before, after).where(F.col("type").isin(SITE_VISIT, ORDER))
    is_visit = F.col("type") == SITE_VISIT
    amount = F.when(is_visit, F.lit(0)).otherwise(F.coalesce("amount", F.lit(0)))
    return _added(
        facts.select(
            "customer_id",
            F.when(is_visit, distinct_week_code(F.col("event_date"), week_policy)).alias("week"),
            F.when(is_visit, F.col("sign")).otherwise(0).cast("bigint").alias("visits"),
            F.when(F.col("sign") < 0, -amount).otherwise(amount).alias("revenue"),
        )
    )


def customer_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """The customer rows that are new or not as they were; none ever goes."""
    rows = _signed(before, after)
    columns = [c for c in rows.columns if c != "sign"]
    return rows.groupBy(*columns).agg(F.sum("sign").alias("more")).where("more > 0").drop("more")


def _people(spark: SparkSession, folder: str, runs: dict[int, str], touched: set[int], changed: DataFrame) -> DataFrame:
    """Customers of the touched buckets as they are now; `changed` rows take the place of those stored."""
    if not any(b in runs for b in touched):
        return changed
    stored = _buckets(spark, folder, "scored", runs, touched)
    columns = [c for c in changed.columns if c != "customer_id"]
    both = stored.select(*changed.columns).withColumn("age", F.lit(0)).unionByName(changed.withColumn("age", F.lit(1)))
    newest = both.groupBy("customer_id").agg(F.max_by(F.struct(*columns), F.col("age")).alias("row"))
    return newest.select("customer_id", "row.*")


def _write(rows: DataFrame, folder: str, name: str, run: str) -> None:
    _keep_schema(rows.drop("bucket"), folder, name)
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{folder}/{name}/{run}")


def _written(spark: SparkSession, folder: str, name: str, run: str) -> list[int]:
    """The buckets that the run wrote."""
    kind = spark.read.parquet(f"{folder}/schema/{name}").schema.add("bucket", "integer")
    rows = spark.read.schema(kind).parquet(f"{folder}/{name}/{run}").select("bucket").distinct()
    return [r["bucket"] for r in rows.collect()]


def _highest(scored: DataFrame, keep: int) -> DataFrame:
    """The first `keep` of each bucket, in the order of `rank.top_x`; each task first cuts to as many."""
    order = Window.partitionBy("bucket").orderBy(F.desc("ltv"), F.asc("first_seq"), F.asc("customer_id"))
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep).drop("place")


def _rows_of(state: DataFrame) -> DataFrame:
    """Customer rows out of folded rows, with every column of one."""
    people = customer_rows(state)
    missing = [F.lit(None).cast("string").alias(c) for c in CUSTOMER_FIELDS if c not in people.columns]
    return people.select("*", *missing).select(*_PERSON)


def refresh_value(
    spark: SparkSession,
    store: str,
    folder: str,
    week_policy: str = "sunday_u",
    weeks_per_year: int = WEEKS_PER_YEAR,
    lifespan_years: float = LIFESPAN_YEARS,
    buckets: int = BUCKETS,
    keep: int = KEEP,
) -> Values:
    """Bring the values in `folder` up to the last version of the event store; returns the version that now holds.

    What is read follows the store's buckets that changed, what is written the buckets of customers that did. The first call
    values all; it fixes the policy, its numbers, `buckets` and `keep`. The store's version that was valued last
    must still be there (see `store.unused_runs`); if it is gone, value anew in another folder.
    """
    now = read_manifest(spark, store)
    if now is None:
        raise FileNotFoundError(f"no store in {store}")
    before = read_values(spark, folder)
    if before is None:
        before = Values(0, 0, buckets, keep, week_policy, weeks_per_year, lifespan_years)
    elif (before.week_policy, before.weeks_per_year, before.lifespan_years) != (week_policy, weeks_per_year, lifespan_years):
        raise ValueError(f"the values were made with {before.week_policy!r}, {before.weeks_per_year}, {before.lifespan_years}")
    if before.source == now.version:
        return before
    then = read_manifest(spark, store, before.source) if before.source else Manifest()
    if then is None:
        raise FileNotFoundError(f"version {before.source} of the store is gone")
    moved = {b for b, run in now.state.items() if then.state.get(b) != run}
    version = max([before.version, *_versions(spark, folder)]) + 1
    run = f"{version:08d}-{uuid.uuid4().hex}"

    old = resolve(_buckets(spark, store, "state", then.state, moved), *_KEYS)
    new = resolve(_buckets(spark, store, "state", now.state, moved), *_KEYS)
    facts = cut(fact_changes(old, new, before.week_policy).withColumn("bucket", _bucket(before.buckets)))
    people = cut(customer_changes(_rows_of(old), _rows_of(new)).withColumn("bucket", _bucket(before.buckets)))
    with_facts = {r["bucket"] for r in facts.select("bucket").distinct().collect()}
    touched = with_facts | {r["bucket"] for r in people.select("bucket").distinct().collect()}

    _keep_schema(facts.drop("bucket"), folder, "weeks")
    stored = _buckets(spark, folder, "weeks", before.weeks, with_facts)
    sums = _added(stored.unionByName(facts.drop("bucket")))
    _write(sums.withColumn("bucket", _bucket(before.buckets)), folder, "weeks", run)
    weeks = _replaced(before.weeks, with_facts, _written(spark, folder, "weeks", run), run)

    per_week = _buckets(spark, folder, "weeks", weeks, touched)
    metrics = per_week.groupBy("customer_id").agg(
        F.sum("visits").alias("visits"), F.count_if(F.col("week").isNotNull()).alias("weeks"), F.sum("revenue").alias("revenue")
    )
    everybody = _people(spark, folder, before.scored, touched, people.drop("bucket"))
    valued = score(
        attach_metrics(everybody, metrics), weeks_per_year=before.weeks_per_year, lifespan_years=before.lifespan_years
    )
    _write(valued.withColumn("bucket", _bucket(before.buckets)), folder, "scored", run)
    scored = _replaced(before.scored, touched, _written(spark, folder, "scored", run), run)

    kind = spark.read.parquet(f"{folder}/schema/scored").schema.add("bucket", "integer")
    _write(_highest(spark.read.schema(kind).parquet(f"{folder}/scored/{run}"), before.keep), folder, "top", run)
    after = before._replace(version=version, source=now.version, weeks=weeks, scored=scored)
    _commit(spark, folder, after)
    return after


def _replaced(old: dict[int, str], touched: set[int], written: Iterable[int], run: str) -> dict[int, str]:
    return {b: r for b, r in old.items() if b not in touched} | dict.fromkeys(written, run)


def _opened(spark: SparkSession, folder: str, version: int | None) -> Values:
    found = read_values(spark, folder, version)
    if found is None:
        raise FileNotFoundError(f"no values in {folder}")
    return found


def stored_values(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """Every customer with visits, weeks, revenue and value, as `ltv` gives them; nothing is shuffled."""
    return _buckets(spark, folder, "scored", _opened(spark, folder, version).scored)


def stored_top(spark: SparkSession, folder: str, x: int, version: int | None = None) -> DataFrame:
    """The x customers of highest value, from the highest of each bucket where those are enough."""
    found = _opened(spark, folder, version)
    # A bucket that was valued by a run has its highest in the same run.
    return top_x(_buckets(spark, folder, "top" if x <= found.keep else "scored", found.scored), x)
