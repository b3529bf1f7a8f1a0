"""Every registered query of the subpackage: SQL, or the test that compares it with something plainer; native plans."""

import importlib

import pytest
from compare import compare, connect

import corpus_pipeline
from perennia.llm.oracles import ORACLES
from perennia.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

#: Where SQL cannot express a query: module and test.
COMPARED = {
    "op3_personal_data": ("test_pii", "base"),
    "op7_toxicity": ("test_toxicity", "test_short_words_can_be_toxic"),
    "op8_packing": ("test_packing", "test_query"),
    "op9_bpe": ("test_bpe", "test_query_equals_library"),
    "op12_vector_packing": ("test_vector_packing", "test_query"),
}


def test_every_query_is_compared():
    assert set(QUERIES) == set(ORACLES) | set(COMPARED)
    for module, name in COMPARED.values():
        assert hasattr(importlib.import_module(module), name)
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), QUERIES[name], ORACLES[name], SF) is None


@pytest.mark.parametrize("name", ["op3_personal_data", "op4_chat_format", "op6_exact_dedup", "op10_url_filter"])
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
