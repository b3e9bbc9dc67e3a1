"""Operators that are asked to stay in DataFrame expressions."""

import pytest
from blotter.llm.queries import QUERIES
from plan import planned


@pytest.mark.parametrize("name", ["op3_quality_rules", "op5_chat_formatting"])
def test_no_python(spark, name):
    plan = planned(QUERIES[name](spark, "/root/testdata/sf0.001"))
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"):
        assert operator not in plan
