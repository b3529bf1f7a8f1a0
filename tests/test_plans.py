"""Shapes of physical plans that matter at scale."""

import __spark_entry__ as driver
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def plan_of(spark):
    """Plan as for large tables: nothing is small enough to broadcast by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda name: driver.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def lines(plan, *words):
    return [line for line in plan.splitlines() if all(w in line for w in words)]


def test_value_needs_three_shuffles_and_hash_aggregates(plan_of):
    plan = plan_of("ltv_fold_top10")
    assert len(lines(plan, "Exchange")) == 3
    # Facts fold and customer sums by hash; only the text attributes of customers are sorted.
    assert len(lines(plan, "HashAggregate")) == 4
    assert len(lines(plan, "SortAggregate")) == 2
    assert "TakeOrderedAndProject" in plan
    assert "Window" not in plan


def test_type_filters_and_columns_reach_the_scan(plan_of):
    plan = plan_of("ltv_fold_all")
    scans = lines(plan, "FileScan")
    assert len(scans) == 2
    assert any("EqualTo(event_type,signup)" in s for s in scans)
    assert any("In(event_type" in s for s in scans)
    assert not any("ts:" in s for s in scans if "EqualTo(event_type,signup)" in s)


def test_weeks_need_no_second_shuffle(plan_of):
    assert len(lines(plan_of("ltv_cross_year_u"), "Exchange hashpartitioning(customer_id")) == 2
    assert len(lines(plan_of("visits_per_week"), "Exchange")) == 3


def test_top_per_segment_cuts_before_the_shuffle(plan_of):
    plan = plan_of("top_per_segment")
    assert lines(plan, "WindowGroupLimit", "Partial")


def test_dense_rank_windows_over_k_values_only(plan_of):
    plan = plan_of("ltv_sql_dense_rank_top10")
    below_window = plan.split("Window [dense_rank", 1)[1].splitlines()[1:3]
    assert any("TakeOrderedAndProject(limit=10" in line for line in below_window)


@pytest.mark.parametrize("name", sorted(driver._QUERIES))
def test_no_python_and_no_cross_join(plan_of, name):
    if name.startswith(("stream_", "ingested_", "upserted_", "event_log_")):
        pytest.skip("runs jobs; its parts are covered by the other queries")
    plan = plan_of(name)
    for word in ("Python", "Pandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
