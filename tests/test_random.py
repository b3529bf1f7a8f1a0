"""Random out-of-order events against the one-by-one application."""

import random
from collections import Counter

import pytest
from brute import fold_values, run_fold, touch_values
from helpers import log_of

from perennia import entities, event_dispositions, ltv, touch_ltv
from perennia.plans.ltv_touch import touch_profiles


def random_events(seed, n=600):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = rng.choice(["CUSTOMER", "SITE_VISIT", "SITE_VISIT", "IMAGE", "ORDER", "ORDER", "SURVEY"])
        customer = "hot" if rng.random() < 0.35 else f"c{rng.randrange(12)}"
        time = f"201{rng.randrange(7, 9)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}T10:{i % 60:02}:00.{i:03}Z"
        if rng.random() < 0.05:
            time = f"2018-01-2000T{i:04}"
        e = {"type": kind, "verb": rng.choice(["NEW", "UPDATE"]), "event_time": time}
        if kind == "CUSTOMER":
            e["key"] = customer
            for field in ("last_name", "adr_city", "adr_state"):
                if rng.random() < 0.8:
                    e[field] = f"{field}{rng.randrange(5)}"
            if rng.random() < 0.05:
                e["verb"] = "DELETE"
        else:
            e["customer_id"] = customer
            e["key"] = "hotkey" if rng.random() < 0.3 else f"k{rng.randrange(40)}"
        if kind == "ORDER":
            e["total_amount"] = rng.choice(["N/A", "10.00 USD", f"{rng.randrange(1, 99999) / 100} USD", "-3.335 USD"])
        out.append(e)
    return out


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark, tmp_path_factory):
    events = random_events(request.param)
    folder = str(tmp_path_factory.mktemp("random"))
    log = log_of(spark, folder, events[:200], events[200:350], events[350:]).cache()
    # Each file keeps its array order, so list order breaks ties as file and position do.
    return sorted(events, key=lambda e: e["event_time"]), log


def test_state_and_values(case):
    events, log = case
    state, _ = run_fold(events)
    current = entities(log)
    customers = {r.customer_id: r for r in current.customer.collect()}
    assert set(customers) == {k for t, k in state if t == "CUSTOMER"}
    for key, row in customers.items():
        e = state["CUSTOMER", key]
        assert (row.last_name, row.adr_city, row.adr_state) == tuple(e.get(f) for f in ("last_name", "adr_city", "adr_state"))
    facts = {(r.type, r.key): r for r in current.facts.collect()}
    assert set(facts) == {s for s in state if s[0] != "CUSTOMER"}
    for slot, row in facts.items():
        assert (row.customer_id, row.event_time) == (state[slot]["customer_id"], state[slot]["event_time"])
    got = {r.customer_id: (r.revenue_per_visit, r.visits_per_week, r.ltv) for r in ltv(current).collect()}
    assert got == fold_values(state)


@pytest.mark.parametrize("hot_rows", [0, 20, 10**6])
def test_dispositions(case, hot_rows):
    events, log = case
    _, outcome = run_fold(events)
    rows = event_dispositions(log, hot_rows=hot_rows).collect()
    got = Counter((r.type, r.key, r.event_time, r.verb, r.disposition) for r in rows)
    assert got == Counter((e["type"], e["key"], e["event_time"], e["verb"], d) for e, d in zip(events, outcome))


@pytest.mark.parametrize("hot_rows", [20, 10**6])
def test_touch(case, hot_rows):
    events, log = case
    got = {r.customer_id: (r.visits, r.weeks, r.ltv) for r in touch_ltv(log, hot_rows=hot_rows).collect()}
    assert got == touch_values(events)


def test_touch_profiles(case):
    events, log = case
    known = touch_values(events)
    assert {r.customer_id for r in touch_profiles(log).collect()} == set(known)


def test_hot_groups_are_spread(case, spark):
    _, log = case
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = event_dispositions(log, hot_rows=20)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The joined rows are partitioned by the spreading column, too, and no window gathers a key.
    assert sum("_part" in line for line in plan.splitlines() if "Exchange hashpartitioning(" in line) >= 2
    assert "Window" not in plan
