import json
import os
from decimal import Decimal

import pytest
from fixtures import D1_EVENTS, D1_RESULT, SAMPLE_EVENTS, customer, order, visit
from helpers import LAYOUTS, log_of, write_array
from pyspark.sql import functions as F

from perennia import (
    entities,
    ingest_files,
    ltv,
    read_event_lines,
    read_event_log,
    read_events,
    result_columns,
    stored_entities,
    top_x,
    union_logs,
    write_event_log,
)
from perennia.functions.times import event_date
from perennia.operators.dispositions import rejects
from perennia.operators.rank import top_per_group
from perennia.plans.ingest import ingest, ingest_more, read_stored
from perennia.sources.json_events import from_json_lines, to_json_lines


def ids(log):
    return [r.customer_id for r in result_columns(top_x(ltv(entities(log)), 10)).collect()]


EXPECTED = [row[0] for row in D1_RESULT]


def test_sample_events_read_whole(spark, folder):
    log = log_of(spark, folder, SAMPLE_EVENTS)
    rows = {r.type: r for r in log.collect()}
    assert float(rows["ORDER"].amount) == 12.34
    assert rows["IMAGE"].camera_make == "Canon"
    assert json.loads(rows["SITE_VISIT"].tags) == [{"some key": "some value"}]
    assert rows["CUSTOMER"].last_name == "Smith"


def test_all_files_of_the_folder_only(spark, folder):
    write_array(folder, D1_EVENTS[:10], "a.txt")
    write_array(folder, D1_EVENTS[10:], "b.json")
    assert read_events(spark, folder).count() == 30
    assert read_events(spark, folder, glob="*.txt").count() == 10


def test_positions_follow_the_array(spark, folder):
    log = log_of(spark, folder, D1_EVENTS)
    keys = [r.key for r in log.orderBy("seq.pos").collect()]
    assert keys == [e["key"] for e in D1_EVENTS]


def test_json_lines(spark, folder):
    # Equal times: the line number decides, also across the splits of one file.
    time = "2018-01-01T00:00:00.000Z"
    events = [customer("c", time, "first", "X", "Y")]
    events += [customer("c", time, f"n{i}", "X", "Y", "UPDATE") for i in range(5000)]
    with open(folder + "/e.json", "w") as f:
        f.write("\n".join(json.dumps(e) for e in events) + "\n{broken\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        log = read_event_lines(spark, folder)
        assert log.rdd.getNumPartitions() > 3
        row = entities(log).customer.first()
        assert row.last_name == "n4999"
        assert log.where(F.col("_corrupt_record").isNotNull()).count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_lines_of_the_golden_data(spark, folder):
    with open(folder + "/e.json", "w") as f:
        f.write("\n".join(json.dumps(e) for e in D1_EVENTS))
    assert ids(read_event_lines(spark, folder)) == EXPECTED


def test_json_round_trip(spark, folder):
    log = log_of(spark, folder, D1_EVENTS)
    back = from_json_lines(to_json_lines(log, "seq"))
    assert ids(back) == EXPECTED


def test_event_log(spark, folder):
    extra = [{"type": f"T{i}", "verb": "NEW", "key": "k", "event_time": "2018-01-01T00:00:00Z"} for i in range(3)]
    events = log_of(spark, folder, D1_EVENTS + extra)
    write_event_log(events, folder + "-log")
    log = read_event_log(spark, folder + "-log")
    assert ids(log) == EXPECTED
    assert {r.type for r in log.select("type").distinct().collect()} == {"CUSTOMER", "SITE_VISIT", "IMAGE", "ORDER", "OTHER"}
    assert log.where("type = 'OTHER'").select("source_type").distinct().count() == 3
    plan = entities(log).customer._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(type" in plan
    # Images are not read for the lifetime value, nor are their columns.
    scans = [s for s in ltv(entities(log))._jdf.queryExecution().executedPlan().toString().split("FileScan")[1:]]
    assert all("SITE_VISIT,ORDER" in s or "= CUSTOMER" in s for s in scans)
    assert all("camera_model" not in s.split("ReadSchema")[1].split("\n")[0] for s in scans)


def test_union_of_logs(spark, folder):
    first = log_of(spark, folder + "/", D1_EVENTS)
    more = [visit("z", "2018-03-01T00:00:00Z", EXPECTED[3]), order("zo", "2018-03-01T00:00:00Z", EXPECTED[3], "950.00 USD")]
    second = log_of(spark, _sub(folder), more).drop("tags", "camera_make")
    rows = {r.customer_id: r for r in ltv(entities(union_logs(first, second))).collect()}
    assert float(rows[EXPECTED[3]].revenue) == 1000.0


def _sub(folder):
    import os

    path = folder + "-second"
    os.makedirs(path)
    return path


def test_ingest_job(spark, folder):
    write_array(folder, D1_EVENTS, "input.txt")
    out = folder + "-out"
    assert ingest_files(spark, folder, out) == (30, 4)
    assert ingest_files(spark, folder, out) == (30, 4)
    current = stored_entities(spark, out)
    assert [r.customer_id for r in top_x(ltv(current), 10).collect()] == EXPECTED
    assert (current.site_visit.count(), current.image.count(), current.orders.count()) == (10, 8, 8)
    assert spark.read.parquet(out + "/event_log").count() == 30


@pytest.mark.parametrize("layout", LAYOUTS)
def test_arrays_of_any_layout(spark, folder, layout):
    write_array(folder, D1_EVENTS[:20], "a.txt", layout)
    write_array(folder, D1_EVENTS[20:], "b.txt", layout)
    log = read_events(spark, folder)
    assert ids(log) == EXPECTED and log.select("seq").distinct().count() == 30
    assert log.where("_corrupt_record is not null").count() == 0
    if layout != "indented":
        lines = read_event_lines(spark, folder)
        assert ids(lines) == EXPECTED and lines.select("seq").distinct().count() == 30
        assert lines.where("_corrupt_record is not null").count() == 0


@pytest.mark.parametrize("layout", LAYOUTS)
def test_equal_times_keep_the_order_of_the_array(spark, folder, layout):
    time = "2018-01-01T00:00:00.000Z"
    write_array(folder, [customer("c", time, "old", "X", "Y"), customer("c", time, "new", "X", "Y", "UPDATE"), order("o", time, "c", "5 USD")], "a.txt", layout)
    assert entities(read_events(spark, folder)).customer.first().last_name == "new"


WHOLE = '[{"type": "IMAGE", "key": "1"}]'


@pytest.mark.parametrize(
    "text", [WHOLE + " " + WHOLE, WHOLE + "," + WHOLE, WHOLE + " xx", WHOLE + ', "x": 1', WHOLE[:-1], "null", "{}", "7", '{"type": "IMAGE"}', "[[]]"]
)
def test_what_is_not_one_array_is_corrupt(spark, folder, text):
    write_array(folder, text, "a.txt")
    write_array(folder, [], "b.txt")
    rows = read_events(spark, folder).collect()
    assert [(r._corrupt_record, r.type) for r in rows] == [(text, None)]


def test_lines_with_several_events_or_junk(spark, folder):
    event = '{"type": "IMAGE", "key": "%d"}'
    lines = [event % 1 + ", " + event % 2, event % 3 + event % 4, "[", event % 5 + ",", "]", "  ", event % 6 + " xx", "[" + event % 7 + "]", "null"]
    write_array(folder, "\n".join(lines), "a.txt")
    rows = read_event_lines(spark, folder).collect()
    assert sorted(r.key for r in rows if r.key) == ["1", "2", "5", "7"]
    assert sorted(r._corrupt_record for r in rows if r._corrupt_record) == sorted([lines[1], lines[6]])
    assert len({r.seq for r in rows}) == len(rows)


def test_stores_without_rows(spark, folder):
    os.makedirs(folder + "-in")
    assert ingest_files(spark, folder + "-in", folder + "-none") == (0, 0)
    current = stored_entities(spark, folder + "-none")
    assert (current.customer.count(), current.facts.count(), ltv(current).count()) == (0, 0, 0)
    assert read_stored(spark, folder + "-none", "rejects").count() == 0
    write_array(folder, [e for e in D1_EVENTS if e["type"] == "CUSTOMER"], "a.txt")
    ingest(read_events(spark, folder), folder + "-people")
    assert ltv(stored_entities(spark, folder + "-people")).count() == 4


def test_added_events_equal_one_ingest(spark, folder):
    out = folder + "-out"
    write_array(folder, D1_EVENTS[15:], "b.txt")
    ingest(read_events(spark, folder, glob="b.txt"), out)
    write_array(folder, D1_EVENTS[:15], "a.txt")
    assert ingest_more(read_events(spark, folder, glob="a.txt"), out) == (30, 4)
    assert [r.customer_id for r in top_x(ltv(stored_entities(spark, out)), 10).collect()] == EXPECTED


def test_unknown_types_keep_their_name(spark, folder):
    events = log_of(spark, folder, [{"type": "FOO", "verb": "NEW", "key": "k", "event_time": "2018-01-01T00:00:00Z"}])
    write_event_log(events, folder + "-log")
    write_event_log(read_event_log(spark, folder + "-log"), folder + "-again")
    log = read_event_log(spark, folder + "-again")
    assert [(r.type, r.source_type) for r in log.collect()] == [("OTHER", "FOO")]
    assert rejects(log).first().type == "FOO"


def test_wide_and_fine_amounts(spark, folder):
    time = "2018-01-01T00:00:00.000Z"
    amounts = ["250000000000000.00 USD", "0.00004 USD", "1e30 USD", "nan USD"]
    log = log_of(spark, folder, [order(f"o{i}", time, "c", a) for i, a in enumerate(amounts)])
    got = {r.order_id: r.amount for r in entities(log).orders.collect()}
    assert got == {"o0": Decimal("250000000000000"), "o1": Decimal("0.00004")}
    assert {r.key: r.reason for r in rejects(log).collect()} == {"o2": "AMOUNT_OUT_OF_RANGE", "o3": "INVALID_AMOUNT"}


def test_dates_of_other_shapes(spark):
    texts = ["2018/01/20", "2018/1/2 10:00", "20180120T124552Z", "20180120", "2018-01-20T23:55-05:00", "2018/01/200", "201801", "20/01/2018"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(event_date(F.col("t")).alias("d")).collect()
    assert [str(r.d) for r in rows] == ["2018-01-20", "2018-01-02", "2018-01-20", "2018-01-20", "2018-01-20", "None", "None", "None"]


def test_top_2000_per_group_is_cut_before_the_shuffle(spark):
    rows = spark.range(20_000).selectExpr("id AS customer_id", "id % 3 AS g", "id * 7 % 10007 AS ltv")
    top = top_per_group(rows, "g", 2000)
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert top.count() == 6000
