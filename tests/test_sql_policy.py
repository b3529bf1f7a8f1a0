import pytest
from fixtures import C1, C4, C5, C10, D1_EVENTS, D2_CUSTOMERS, D2_ORDERS, D2_RESULT, D2_VISITS
from helpers import log_of
from pyspark.sql import functions as F

from perennia import entities, ltv_sql
from perennia.operators.lookup import join_unique
from perennia.sources.inline import inline_relation


def d2(spark):
    people = inline_relation(spark, D2_CUSTOMERS, "customer_id string, event_date string, last_name string, adr_city string, adr_state string", "d2_customer")
    visits = inline_relation(spark, D2_VISITS, "key string, event_date string, customer_id string")
    sales = inline_relation(spark, D2_ORDERS, "key string, event_date string, customer_id string, amount string")
    return (
        people,
        visits.withColumn("event_date", F.to_date("event_date")),
        sales.withColumn("amount", F.col("amount").cast("decimal(18,4)")),
    )


@pytest.mark.parametrize("hot_rows", [0, 1, 10**6])
def test_repeated_customer_fans_out(spark, hot_rows):
    rows = ltv_sql(*d2(spark), k=4, hot_rows=hot_rows).collect()
    assert {(r.customer_id, r.last_name): (r.ltv, r["rank"]) for r in rows} == D2_RESULT
    assert len(rows) == 5
    assert spark.table("d2_customer").count() == 5


def test_k(spark):
    assert sorted(r.last_name for r in ltv_sql(*d2(spark), k=2).collect()) == ["Bill", "Linda"]


def test_all_without_rank(spark):
    assert ltv_sql(*d2(spark)).count() == 5


def test_rank_is_given_before_the_join(spark):
    people, visits, sales = d2(spark)
    known = people.where("last_name <> 'Linda'")
    ranks = sorted(r["rank"] for r in ltv_sql(known, visits, sales, k=4).collect())
    assert ranks == [1, 3, 4, 4]


def test_visitor_without_orders_and_customer_without_visits(spark):
    people, visits, sales = d2(spark)
    rows = ltv_sql(people, visits, sales.where("customer_id not like '%8f48'"), k=4).collect()
    assert [r.ltv for r in rows if r.last_name == "Bill"] == [0.0]
    rows = ltv_sql(people, visits.where("customer_id not like '%8f48'"), sales, k=4).collect()
    assert "Bill" not in {r.last_name for r in rows}


def test_equal_rows_of_a_hot_customer_are_kept_and_spread(spark):
    rows = spark.createDataFrame([("a", 1)], "k string, v int").select(F.explode(F.array_repeat("k", 5000)).alias("k"), "v")
    rows = rows.repartition(16).unionByName(spark.createDataFrame([("b", 2)], "k string, v int"))
    unique = spark.createDataFrame([("a", 10), ("b", 20), ("c", 30)], "k string, w int")
    joined = join_unique(rows, unique, "k", hot_rows=100)
    assert {(r.k, r.w): r["count"] for r in joined.groupBy("k", "w").count().collect()} == {("a", 10): 5000, ("b", 20): 1}


def test_policies_agree_on_the_golden_data(spark, folder):
    current = entities(log_of(spark, folder, D1_EVENTS))
    rows = ltv_sql(current.customer, current.site_visit, current.orders, k=4).collect()
    assert {r.customer_id: (r.ltv, r["rank"]) for r in rows} == {
        C5: (845000.0, 1), C10: (684450.0, 2), C1: (650000.0, 3), C4: (26000.0, 4),
    }


def test_no_window_over_the_whole_data(spark):
    plan = ltv_sql(*d2(spark), k=2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
