import os

import pytest
from fixtures import D1_EVENTS, D1_RESULT
from helpers import LAYOUTS, write_array
from pyspark.sql import functions as F
from test_random import random_events

from perennia import entities, fold, ltv, read_event_log, read_events, stream_events, top_x
from perennia.streaming import jobs


@pytest.fixture
def arrivals(spark, folder):
    """Random events in six files that arrive as six batches, in no order of time."""
    events = random_events(5, 420)
    for i in range(6):
        write_array(folder, events[i * 70 : (i + 1) * 70], f"part{i}.txt")
    return folder


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("start", [jobs.stream_state, jobs.stream_partials])
def test_streamed_state_is_the_batch_state(spark, arrivals, start):
    out = arrivals + "-out"
    query = start(stream_events(spark, arrivals, 1), out + "/state", out + "/checkpoint")
    query.awaitTermination()
    state = jobs.read_state(spark, out + "/state")
    assert spark.read.parquet(out + "/state").select("batch").distinct().count() == 6
    assert rows(state) == rows(fold(read_events(spark, arrivals)))


def test_state_goes_on_after_a_restart(spark, arrivals):
    out = arrivals + "-out"
    jobs.stream_state(stream_events(spark, arrivals, 2), out + "/state", out + "/checkpoint").awaitTermination()
    write_array(arrivals, random_events(6, 80), "part9.txt")
    jobs.stream_state(stream_events(spark, arrivals, 2), out + "/state", out + "/checkpoint").awaitTermination()
    assert rows(jobs.read_state(spark, out + "/state")) == rows(fold(read_events(spark, arrivals)))


def test_refreshed_top_list(spark, arrivals):
    out = arrivals + "-out"
    jobs.stream_top(stream_events(spark, arrivals, 3), out, out + "/checkpoint", x=3).awaitTermination()
    want = top_x(ltv(entities(read_events(spark, arrivals))), 3).collect()
    got = jobs.read_top(spark, out).orderBy(F.desc("ltv")).collect()
    assert [(r.customer_id, r.ltv) for r in got] == [(r.customer_id, r.ltv) for r in want]


def test_streamed_log(spark, folder):
    for i in range(3):
        write_array(folder, D1_EVENTS[i * 10 : i * 10 + 10], f"part{i}.txt")
    out = folder + "-out"
    jobs.stream_to_log(stream_events(spark, folder, 1), out + "/log", out + "/checkpoint").awaitTermination()
    log = read_event_log(spark, out + "/log")
    assert [r.customer_id for r in top_x(ltv(entities(log)), 9).collect()] == [r[0] for r in D1_RESULT]


def _visits(spark, folder, times, files_per_trigger=1):
    for i, group in enumerate(times):
        events = [{"type": "SITE_VISIT", "verb": "NEW", "key": t, "event_time": t + "T10:00:00Z", "customer_id": "c"} for t in group]
        # Files arrive in the order of their modification times.
        os.utime(write_array(folder, events, f"part{i}.txt"), (10**9 + i, 10**9 + i))
    return stream_events(spark, folder, files_per_trigger)


# Weeks and months late, and one page twice.
ARRIVAL = [["2018-01-06", "2018-01-07"], ["2018-06-01"], ["2018-06-02"], ["2018-01-08", "2018-01-07"], ["2018-04-01"]]


def test_weekly_counts_are_those_of_accepted_visits(spark, folder):
    out = folder + "-out"
    jobs.stream_weekly_visits(_visits(spark, folder, ARRIVAL), out + "/weeks", out + "/checkpoint").awaitTermination()
    got = {str(r.week_start): r.visits for r in jobs.read_weekly_visits(spark, out + "/weeks").collect()}
    assert got == {"2017-12-31": 1, "2018-01-07": 2, "2018-05-27": 2, "2018-04-01": 1}


def test_repeated_keys_are_removed_and_late_ones_kept(spark, folder):
    out = folder + "-out"
    jobs.stream_first_seen(_visits(spark, folder, ARRIVAL), out + "/first", out + "/checkpoint").awaitTermination()
    assert sorted(r.key for r in spark.read.parquet(out + "/first").collect()) == sorted({t for group in ARRIVAL for t in group})


@pytest.mark.parametrize("layout", LAYOUTS)
def test_streamed_arrays_of_any_layout(spark, folder, layout):
    for i in range(3):
        write_array(folder, D1_EVENTS[i * 10 : i * 10 + 10], f"part{i}.txt", layout)
    write_array(folder, '[{"type": "IMAGE"}] [', "part3.txt")
    out = folder + "-out"
    jobs.stream_to_log(stream_events(spark, folder, 1), out + "/log", out + "/checkpoint").awaitTermination()
    log = read_event_log(spark, out + "/log")
    assert [r.customer_id for r in top_x(ltv(entities(log)), 9).collect()] == [r[0] for r in D1_RESULT]
    assert log.where("_corrupt_record is not null").count() == 1
