"""The prose scenarios of the event format, one test each."""

import pytest
from fixtures import customer, image, order, visit
from helpers import log_of, write_array
from pyspark.errors import AnalysisException

from perennia import entities, event_dispositions, ingest_files, ltv, read_events, rejects, result_columns
from perennia.plans.reports import ingest_summary, rejects_by_reason

T = "2018-01-0{}T10:00:00.000Z".format


def outcomes(log, bad_time="null_week"):
    rows = event_dispositions(log, bad_time).orderBy("seq").collect()
    return [r.disposition for r in rows]


def values(log, bad_time="null_week"):
    rows = result_columns(ltv(entities(log, bad_time))).collect()
    return {r.customer_id: (float(r.revenue_per_visit), float(r.visits_per_week), float(r.ltv)) for r in rows}


def test_update_order_before_new(spark, folder):
    log = log_of(spark, folder, [order("o", T(1), "c", "1.00 USD", "UPDATE"), order("o", T(2), "c", "2.00 USD")])
    assert outcomes(log) == ["UPDATE_WITHOUT_KEY", "APPLIED"]
    assert [(r.reason, r.key) for r in rejects(log).collect()] == [("UPDATE_WITHOUT_KEY", "o")]


def test_update_customer_before_new(spark, folder):
    log = log_of(spark, folder, [customer("c", T(1), "A", "X", "MD", "UPDATE")])
    assert outcomes(log) == ["UPDATE_WITHOUT_KEY"]
    assert entities(log).customer.count() == 0


def test_junk_amount(spark, folder):
    log = log_of(spark, folder, [order("o", T(1), "c", "12,5 USD"), order("o", T(2), "c", "2.00 USD", "UPDATE")])
    assert outcomes(log) == ["INVALID_AMOUNT", "UPDATE_WITHOUT_KEY"]


@pytest.mark.parametrize("bad_time, expected", [("null_week", (5.0, 1.0, 2600.0)), ("skip", (10.0, 1.0, 5200.0))])
def test_junk_event_time(spark, folder, bad_time, expected):
    log = log_of(
        spark,
        folder,
        [
            customer("c", T(1), "A", "X", "MD"),
            visit("p1", T(2), "c"),
            visit("p2", "2018-01-2000T10:00:00.000Z", "c"),
            order("o", "not a time", "c", "10.00 USD"),
        ],
    )
    assert values(log, bad_time) == {"c": expected}
    assert ("INVALID_EVENT_TIME" in outcomes(log, bad_time)) == (bad_time == "skip")


def test_no_visits_is_zero(spark, folder):
    log = log_of(spark, folder, [customer("c", T(1), "A", "X", "MD"), order("o", T(2), "c", "9.00 USD")])
    assert values(log) == {"c": (0.0, 0.0, 0.0)}


def test_summary_counts_every_event(spark, folder):
    events = [
        customer("c", T(1), "A", "X", "MD"),
        customer("c", T(2), "A", "X", "MD"),
        customer("d", T(3), "A", "X", "MD", "UPDATE"),
        {"type": "SURVEY", "verb": "NEW", "key": "s", "event_time": T(4)},
        order("o", T(5), "c", "junk"),
    ]
    write_array(folder, events, "in.txt")
    row = ingest_summary(read_events(spark, folder)).first()
    assert (row.total_events, row.distinct_customers) == (5, 1)
    assert ingest_files(spark, folder, folder + "-out") == (5, 1)
    stored = spark.read.parquet(folder + "-out/rejects")
    assert stored.count() == 4


def test_optional_fields(spark, folder):
    log = log_of(
        spark,
        folder,
        [
            customer("a", T(1), None, None, None),
            customer("b", T(1), "B", "Rome", "MD"),
            customer("b", T(2), None, "Oslo", None, "UPDATE"),
            customer("n", T(1), None, "Bonn", "VA"),
        ],
    )
    rows = {r.customer_id: (r.last_name, r.adr_city, r.adr_state) for r in entities(log).customer.collect()}
    assert rows == {"a": (None, None, None), "b": (None, "Oslo", None), "n": (None, "Bonn", "VA")}


def test_order_of_the_array_does_not_matter(spark, folder):
    events = [
        customer("c", T(3), "New", "Rome", "MD", "UPDATE"),
        order("o", T(4), "c", "7.00 USD", "UPDATE"),
        visit("p", T(5), "c"),
        order("o", T(2), "c", "5.00 USD"),
        customer("c", T(1), "Old", "Rome", "MD"),
    ]
    log = log_of(spark, folder, events[:2], events[2:])
    assert entities(log).customer.first().last_name == "New"
    assert values(log) == {"c": (7.0, 1.0, 3640.0)}


def test_equal_times_keep_array_order(spark, folder):
    log = log_of(spark, folder, [customer("c", T(1), "First", "X", "Y", "UPDATE"), customer("c", T(1), "Second", "X", "Y")])
    assert outcomes(log) == ["UPDATE_WITHOUT_KEY", "APPLIED"]


def test_empty_and_missing_folder(spark, folder):
    log = read_events(spark, folder)
    assert (log.count(), "event_date" in log.columns) == (0, True)
    assert tuple(ingest_summary(log).first()) == (0, 0)
    assert values(log) == {}
    with pytest.raises(AnalysisException):
        read_events(spark, folder + "/none")


def test_another_image(spark, folder):
    log = log_of(spark, folder, [image("i1", T(1), "c"), image("i2", T(2), "c"), image("i2", T(3), "d")])
    assert {(r.image_id, r.customer_id) for r in entities(log).image.collect()} == {("i1", "c"), ("i2", "c")}
    assert outcomes(log) == ["APPLIED", "APPLIED", "DUPLICATE_KEY"]


def test_customer_verbs(spark, folder):
    log = log_of(
        spark,
        folder,
        [
            customer("c", T(1), "1", "X", "Y"),
            customer("c", T(2), "2", "X", "Y"),
            customer("c", T(3), "3", "X", "Y", "UPDATE"),
            customer("c", T(4), "4", "X", "Y", "DELETE"),
        ],
    )
    assert outcomes(log) == ["APPLIED", "DUPLICATE_NEW", "APPLIED", "IGNORED_VERB"]
    assert entities(log).customer.first().last_name == "3"


def test_order_moves_to_another_customer(spark, folder):
    log = log_of(
        spark,
        folder,
        [
            customer("a", T(1), "A", "X", "Y"),
            customer("b", T(1), "B", "X", "Y"),
            visit("pa", T(1), "a"),
            visit("pb", T(1), "b"),
            order("o", T(2), "a", "5.00 USD"),
            order("o", T(3), "b", "8.00 USD", "UPDATE"),
        ],
    )
    assert values(log) == {"a": (0.0, 1.0, 0.0), "b": (8.0, 1.0, 4160.0)}


def test_missing_required_fields_and_corrupt_files(spark, folder):
    events = [
        {"type": "SITE_VISIT", "verb": "NEW", "key": "p", "event_time": T(1)},
        {"type": "ORDER", "verb": "NEW", "key": "o", "event_time": T(1), "customer_id": "c"},
        {"type": "IMAGE", "verb": "UPLOAD", "event_time": T(1), "customer_id": "c"},
        {"verb": "NEW", "key": "x", "event_time": T(1)},
        {"type": "CUSTOMER", "key": "c", "event_time": T(1)},
        {"type": "CUSTOMER", "verb": "NEW", "key": "c"},
        {"type": "ORDER", "key": "o", "event_time": T(1), "customer_id": "c", "total_amount": "1 USD"},
    ]
    log = log_of(spark, folder, events, "[{broken", [])
    got = {r.reason: r.events for r in rejects_by_reason(log).collect()}
    assert got == {
        "MISSING_customer_id": 1,
        "MISSING_total_amount": 1,
        "MISSING_key": 1,
        "MISSING_type": 1,
        "MISSING_verb": 2,
        "MISSING_event_time": 1,
        "CORRUPT": 1,
    }
    assert rejects(log).where("reason = 'CORRUPT'").first().raw == "[{broken"
