import json
import random

from fixtures import D1_EVENTS, D1_RESULT
from helpers import log_of

from perennia import entities, ltv, result_columns, top_x
from perennia.operators.rank import dense_rank_x
from perennia.sinks import result_document, write_result

def ranked(log, x=20):
    rows = result_columns(top_x(ltv(entities(log)), x)).collect()
    return [
        [r.customer_id, [r.last_name, r.adr_city, r.adr_state, float(r.revenue_per_visit), float(r.visits_per_week), float(r.ltv)]]
        for r in rows
    ]


def test_golden(spark, folder):
    assert ranked(log_of(spark, folder, D1_EVENTS)) == D1_RESULT


def test_order_and_split_do_not_matter(spark, folder):
    shuffled = random.Random(7).sample(D1_EVENTS, len(D1_EVENTS))
    assert ranked(log_of(spark, folder, shuffled[:7], shuffled[7:20], shuffled[20:])) == D1_RESULT


def test_x_limits_and_repeats(spark, folder):
    log = log_of(spark, folder, D1_EVENTS)
    assert ranked(log, 2) == D1_RESULT[:2]
    assert ranked(log, 2) == D1_RESULT[:2]


def test_result_document(spark, folder):
    scored = ltv(entities(log_of(spark, folder, D1_EVENTS)))
    assert json.loads(result_document(scored, 20).first().value) == D1_RESULT
    write_result(scored, 3, folder + "/out")
    assert json.loads(spark.read.text(folder + "/out").first().value) == D1_RESULT[:3]


def test_dense_rank(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 4.0), (4, 3.0), (5, 3.0)], "customer_id int, ltv double")
    assert sorted((r.customer_id, r["rank"]) for r in dense_rank_x(rows, 2).collect()) == [(1, 1), (2, 1), (3, 2)]
    assert dense_rank_x(rows, 9).count() == 5
    wide = dense_rank_x(rows, 2, broadcast_ranks=0)
    assert sorted((r.customer_id, r["rank"]) for r in wide.collect()) == [(1, 1), (2, 1), (3, 2)]
