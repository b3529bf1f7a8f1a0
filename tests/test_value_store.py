"""Values brought up to date by changes: equal to the value of all events at once, by buckets, by versions."""

import os

import pytest
from fixtures import customer, order, visit
from helpers import write_array
from pyspark.sql import functions as F
from test_store import random_events

from perennia import entities, ltv, read_events, stream_events, top_x
from perennia.operators.dispositions import rejects
from perennia.plans import value_store
from perennia.plans.store import store_rejects, upsert
from perennia.plans.value_store import fact_changes, read_values, refresh_value, stored_top, stored_values
from perennia.sources.event_log import log_rows
from perennia.sources.tables import event_log_from_tables
from perennia.streaming import jobs

DAY = "2018-01-0{}T00:00:00.000Z".format


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def same(spark, values, log, bad_time="null_week", week_policy="sunday_u"):
    want = ltv(entities(log, bad_time), week_policy)
    assert rows(stored_values(spark, values)) == rows(want)
    for x in (3, 50):
        got = stored_top(spark, values, x).select("customer_id", "ltv").collect()
        assert got == top_x(want, x).select("customer_id", "ltv").collect()


@pytest.mark.parametrize("bad_time, week_policy", [("null_week", "sunday_u"), ("skip", "sunday_calendar")])
def test_table_log_in_random_batches(spark, folder, bad_time, week_policy):
    """Late NEWs, moved orders, repeated pages: batches in no order of time, values after each."""
    log = event_log_from_tables(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    part = F.pmod(F.xxhash64("seq", F.lit(7)), F.lit(3))
    seen = None
    for k in (2, 0, 1) if bad_time == "null_week" else (2, 0):
        batch = log.where(part == k)
        seen = batch if seen is None else seen.unionByName(batch)
        upsert(batch, folder + "/events", bad_time, buckets=4)
        refresh_value(spark, folder + "/events", folder + "/values", week_policy, buckets=3, keep=10)
        same(spark, folder + "/values", seen, bad_time, week_policy)


def test_several_batches_at_once(spark, folder):
    """Events of files; the values follow after two batches, and after the other two."""
    events = random_events(12, 160)
    for i in range(4):
        path = write_array(folder, events[40 * i : 40 * i + 40], f"f{i}.txt")
        upsert(read_events(spark, path), folder + "-events", buckets=3)
        if i % 2:
            refresh_value(spark, folder + "-events", folder + "-values", buckets=2, keep=1)
            same(spark, folder + "-values", read_events(spark, folder))


def test_an_order_is_taken_from_one_customer_and_given_to_the_other(spark, folder):
    first = [customer(c, DAY(1), c, "X", "Y") for c in "ab"] + [visit(f"p{c}", DAY(2), c) for c in "ab"]
    events, values = folder + "-events", folder + "-values"
    upsert(read_events(spark, write_array(folder, [*first, order("o", DAY(3), "a", "10 USD")], "1.txt")), events, buckets=2)
    refresh_value(spark, events, values, buckets=2)
    assert {r.customer_id: int(r.revenue) for r in stored_values(spark, values).collect()} == {"a": 10, "b": 0}
    moved = [order("o", DAY(4), "b", "25 USD", "UPDATE"), visit("pa", DAY(1), "b")]
    # Facts of a customer that is not known yet are kept for them.
    moved += [order("q", DAY(5), "new", "7 USD"), visit("pn", DAY(5), "new")]
    upsert(read_events(spark, write_array(folder, moved, "2.txt")), events)
    refresh_value(spark, events, values)
    got = {r.customer_id: (int(r.revenue), r.visits, r.weeks) for r in stored_values(spark, values).collect()}
    # The page was first seen by the other customer, as it now turns out.
    assert got == {"a": (0, 0, 0), "b": (25, 2, 1)}
    upsert(read_events(spark, write_array(folder, [customer("new", DAY(6), "n", "X", "Y")], "4.txt")), events)
    refresh_value(spark, events, values)
    assert stored_values(spark, values).where("customer_id = 'new'").first().revenue == 7
    same(spark, values, read_events(spark, folder))


def test_only_changes_are_left_of_facts_before_and_after(spark):
    kind = "type string, customer_id string, event_date date, amount decimal(28,6)"
    same_row, null_row = "('ORDER', 'a', null, 5)", "('SITE_VISIT', null, null, null)"
    before = spark.sql(f"SELECT * FROM VALUES {same_row}, {null_row}, ('ORDER', 'b', null, 3) AS t(type, customer_id, event_date, amount)")
    after = spark.sql(f"SELECT * FROM VALUES {same_row}, {null_row}, ('ORDER', 'c', null, 3) AS t(type, customer_id, event_date, amount)")
    typed = [d.selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in kind.split(", ")]) for d in (before, after)]
    changes = fact_changes(*typed).collect()
    assert sorted((r.customer_id, int(r.revenue), r.visits) for r in changes) == [("b", -3, 0), ("c", 3, 0)]


def test_only_touched_buckets_are_written(spark, folder):
    people = [customer(f"c{i}", DAY(1), f"n{i}", "X", "Y") for i in range(300)]
    visits = [visit(f"p{i}", DAY(2), f"c{i}") for i in range(300)]
    events, values = folder + "-events", folder + "-values"
    upsert(read_events(spark, write_array(folder, people + visits, "all.txt")), events, buckets=20)
    before = refresh_value(spark, events, values, buckets=20)
    assert len(before.scored) == len(before.weeks) == 20
    assert refresh_value(spark, events, values) == before
    upsert(read_events(spark, write_array(folder, [order("o", DAY(3), "c7", "10 USD")], "one.txt")), events)
    after = refresh_value(spark, events, values)
    changed = [b for b in after.scored if after.scored[b] != before.scored[b]]
    assert len(changed) == 1 and [b for b in after.weeks if after.weeks[b] != before.weeks[b]] == changed
    run = after.scored[changed[0]]
    assert 0 < spark.read.parquet(f"{values}/scored/{run}").count() < 60
    same(spark, values, read_events(spark, folder))
    # Reading them needs no shuffle.
    assert "Exchange" not in stored_values(spark, values)._jdf.queryExecution().executedPlan().toString()


def test_a_failed_run_leaves_the_old_version(spark, folder, monkeypatch):
    events, values = folder + "-events", folder + "-values"
    upsert(read_events(spark, write_array(folder, random_events(3, 60), "a.txt")), events, buckets=3)
    refresh_value(spark, events, values, buckets=2)
    old = rows(stored_values(spark, values))
    upsert(read_events(spark, write_array(folder, random_events(4, 60), "b.txt")), events)

    def fails(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(value_store, "_commit", fails)
        with pytest.raises(RuntimeError):
            refresh_value(spark, events, values)
    assert rows(stored_values(spark, values)) == old
    with open(f"{values}/manifest/00000002.json", "w") as file:
        file.write('{"version": 2, ')
    assert rows(stored_values(spark, values)) == old
    assert refresh_value(spark, events, values).version == 3
    same(spark, values, read_events(spark, folder))
    assert rows(stored_values(spark, values, version=1)) == old
    with pytest.raises(ValueError):
        refresh_value(spark, events, values, week_policy="iso")


def test_values_without_rows(spark, folder):
    events, values = folder + "-events", folder + "-values"
    with pytest.raises(FileNotFoundError):
        refresh_value(spark, events, values)
    with pytest.raises(FileNotFoundError):
        stored_values(spark, values)
    os.makedirs(folder + "-none")
    upsert(read_events(spark, folder + "-none"), events, buckets=3)
    refresh_value(spark, events, values, buckets=2)
    assert stored_values(spark, values).count() == 0 and stored_top(spark, values, 5).count() == 0
    upsert(read_events(spark, write_array(folder, random_events(5, 60), "a.txt")), events)
    refresh_value(spark, events, values)
    same(spark, values, read_events(spark, folder))


def test_streamed_store(spark, folder):
    """Batches in no order of time; then one more after a restart, and one that comes twice."""
    events = random_events(13, 120)
    for i in range(2):
        write_array(folder, events[i * 40 : i * 40 + 40], f"f{i}.txt")
    out = folder + "-out"

    def run():
        stream = stream_events(spark, folder, 1)
        jobs.stream_store(stream, out, out + "/checkpoint", buckets=3, keep=2).awaitTermination()

    run()
    same(spark, out + "/values", read_events(spark, folder))
    write_array(folder, events[80:], "f9.txt")
    run()
    log = read_events(spark, folder)
    same(spark, out + "/values", log)
    columns = ["reason", "type", "verb", "key", "seq"]
    assert rows(store_rejects(spark, out + "/events").select(columns)) == rows(rejects(log_rows(log)).select(columns))
    # A batch that is tried again after its events were committed.
    again = upsert(read_events(spark, folder + "/f9.txt"), out + "/events", batch_id=2)
    assert again.total_events == log.count()
    assert read_values(spark, out + "/values").source == 3
