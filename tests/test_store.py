"""The store that takes new events: equal to one ingest of all, by buckets, by versions."""

import json
import os
import random

import pytest
from fixtures import D1_EVENTS, customer, image, order, visit
from helpers import log_of, write_array
from pyspark.sql import functions as F

from perennia import entities, ltv, read_events
from perennia.operators.dispositions import rejects
from perennia.plans import store
from perennia.plans.store import read_manifest, store_entities, store_log, store_rejects, store_summary, unused_runs, upsert
from perennia.sources.event_log import log_rows
from perennia.sources.tables import event_log_from_tables


def same(spark, folder, log, bad_time="null_week"):
    """The store against the fold and the dispositions of all events at once."""
    now, want = store_entities(spark, folder), entities(log, bad_time)
    for name in ("customer", "facts"):
        columns = sorted(set(getattr(now, name).columns) & set(getattr(want, name).columns))
        got = sorted(map(str, getattr(now, name).select(*columns).collect()))
        assert got == sorted(map(str, getattr(want, name).select(*columns).collect())), name
    columns = ["reason", "type", "verb", "key", "seq"]
    got = sorted(map(str, store_rejects(spark, folder).select(*columns).collect()))
    assert got == sorted(map(str, rejects(log_rows(log), bad_time).select(*columns).collect()))
    assert store_summary(spark, folder) == (log.count(), want.customer.count())
    assert store_log(spark, folder).count() == log.count()


@pytest.mark.parametrize("bad_time", ["null_week", "skip"])
def test_table_log_in_random_batches(spark, folder, bad_time):
    """Late NEWs, moved orders, repeated pages, junk: batches in no order of time."""
    log = event_log_from_tables(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    part = F.pmod(F.xxhash64("seq", F.lit(7)), F.lit(3))
    for k in (2, 0, 1):
        upsert(log.where(part == k), folder, bad_time, buckets=4)
    same(spark, folder, log, bad_time)


def random_events(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        time = f"2018-01-{rng.randint(1, 9):02d}T00:00:00.{rng.randint(0, 9)}00Z" if rng.random() < 0.9 else "junk"
        key, who = f"k{rng.randrange(6)}", f"c{rng.randrange(3)}"
        verb = rng.choice(["NEW", "UPDATE"])
        out.append(
            rng.choice(
                [
                    customer(who, time, f"n{i}", "X", "Y", verb),
                    order(key, time, who, rng.choice([f"{i} USD", "N/A"]), verb),
                    visit(key, time, who),
                    image(key, time, who),
                    {"type": "FOO", "verb": "NEW", "key": key, "event_time": time},
                    {"type": "ORDER", "verb": verb, "event_time": time, "customer_id": who, "total_amount": "1 USD"},
                ]
            )
        )
    return out


def test_random_files_one_by_one(spark, folder):
    """File positions; every file is a batch, the last times may come first."""
    events = random_events(11, 120)
    for i in range(4):
        path = write_array(folder, events[30 * i : 30 * i + 30], f"f{i}.txt")
        upsert(read_events(spark, path), folder + "-store", buckets=3)
    write_array(folder, "[{}] junk", "f9.txt")
    upsert(read_events(spark, folder + "/f9.txt"), folder + "-store")
    same(spark, folder + "-store", read_events(spark, folder))


def test_a_late_new_turns_rejects_into_events(spark, folder):
    early, mid, late = (f"2018-01-0{d}T00:00:00.000Z" for d in (1, 2, 3))
    out = folder + "-store"
    first = [customer("c", mid, "old", "X", "Y", "UPDATE"), customer("c", late, "later", "X", "Y"), visit("p", mid, "c")]
    upsert(read_events(spark, write_array(folder, first, "a.txt")), out, buckets=3)
    assert {r.reason for r in store_rejects(spark, out).collect()} == {"UPDATE_WITHOUT_KEY"}
    assert store_entities(spark, out).customer.first().last_name == "later"
    second = [customer("c", early, "new", "X", "Y"), visit("p", early, "d")]
    upsert(read_events(spark, write_array(folder, second, "b.txt")), out)
    assert store_entities(spark, out).customer.first().last_name == "old"
    refused = {r.reason: json.loads(r.raw) for r in store_rejects(spark, out).collect()}
    assert set(refused) == {"DUPLICATE_NEW", "DUPLICATE_KEY"}
    assert refused["DUPLICATE_NEW"]["last_name"] == "later" and refused["DUPLICATE_KEY"]["event_time"] == mid
    same(spark, out, read_events(spark, folder))


def test_only_touched_buckets_are_read_and_written(spark, folder):
    out = folder + "-store"
    people = [customer(f"c{i}", "2018-01-01T00:00:00.000Z", f"n{i}", "X", "Y") for i in range(2000)]
    upsert(log_of(spark, folder, people), out, buckets=100)
    before = read_manifest(spark, out)
    assert len(before.state) == 100
    more = [customer("c7", "2018-01-02T00:00:00.000Z", "moved", "X", "Y", "UPDATE")]
    upsert(read_events(spark, write_array(folder, more, "more.txt")), out)
    after = read_manifest(spark, out)
    changed = [b for b in after.state if after.state[b] != before.state[b]]
    assert len(changed) == 1
    run = after.state[changed[0]]
    stored = spark.read.parquet(f"{out}/state/{run}")
    read = store._buckets(spark, out, "state", before.state, set(changed))
    assert 0 < read.count() == stored.count() < 60
    assert {f.split("bucket=")[1].split("/")[0] for f in read.inputFiles()} == {str(changed[0])}
    assert store_entities(spark, out).customer.where("customer_id = 'c7'").first().last_name == "moved"
    # Current rows need no shuffle.
    assert "Exchange" not in store_entities(spark, out).facts._jdf.queryExecution().executedPlan().toString()


def test_a_failed_run_leaves_the_old_version(spark, folder, monkeypatch):
    out = folder + "-store"
    upsert(log_of(spark, folder, D1_EVENTS[:15]), out, buckets=3)
    rows = [str(r) for r in ltv(store_entities(spark, out)).orderBy("customer_id").collect()]

    def fails(*_):
        raise RuntimeError("stopped")

    rest = read_events(spark, write_array(folder, D1_EVENTS[15:], "rest.txt"))
    with monkeypatch.context() as m:
        m.setattr(store, "_commit", fails)
        with pytest.raises(RuntimeError):
            upsert(rest, out)
    assert [str(r) for r in ltv(store_entities(spark, out)).orderBy("customer_id").collect()] == rows
    assert store_summary(spark, out).total_events == 15
    # Stopped while it committed: the version is not complete.
    with open(f"{out}/manifest/00000002.json", "w") as file:
        file.write('{"version": 2, ')
    assert store_summary(spark, out).total_events == 15
    assert {p.split("/")[-2] for p in unused_runs(spark, out) if "00000002-" in p} == {"log", "state", "rejects"}
    assert not [p for p in unused_runs(spark, out) if "00000001-" in p and "/rejects/" not in p]
    upsert(rest, out)
    assert [r.customer_id for r in ltv(store_entities(spark, out)).orderBy(F.desc("ltv")).collect()][0] == "96f55c7d8005"
    same(spark, out, read_events(spark, folder))
    # The version before is still there for who opened it.
    assert store_summary(spark, out, version=1).total_events == 15


def test_a_version_is_written_once(spark, folder):
    out = folder + "-store"
    upsert(log_of(spark, folder, D1_EVENTS), out, buckets=3)
    with pytest.raises(Exception, match="(?i)exist"):
        store._commit(spark, out, read_manifest(spark, out))
    with pytest.raises(ValueError):
        upsert(log_of(spark, folder, D1_EVENTS), out, bad_time="skip")


def test_stores_without_rows(spark, folder):
    out = folder + "-store"
    with pytest.raises(FileNotFoundError):
        store_entities(spark, out)
    os.makedirs(folder + "-none")
    assert upsert(read_events(spark, folder + "-none"), out, buckets=3) == (0, 0)
    assert ltv(store_entities(spark, out)).count() == 0 and store_rejects(spark, out).count() == 0
    log = log_of(spark, folder, D1_EVENTS)
    upsert(log, out)
    same(spark, out, log)
