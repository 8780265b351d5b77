"""Registered queries with SQL, compared as whole results; plans of the native ones."""

import pytest
from check_queries import compare, connect

from nestmetrics import llm

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_result_equals_sql(spark, name):
    verdict = compare(llm.queries()[name](spark, SF), connect(SF), llm.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op9_licenses", "op11_chat_format"])
def test_native_plans(spark, name):
    plan = llm.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"):
        assert word not in plan
