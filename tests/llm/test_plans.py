"""Native operators run no Python on executors, and no query joins without a key."""

import re

import pytest

from colloquia.llm import queries

NATIVE = ("op1_chat_format", "op2_secret_scan", "op3_url_filter", "op7_quality_rules", "op8_decontaminate")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_plan(spark, sf_dir, name):
    text = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)
    assert name not in NATIVE or not re.search("Python|Pandas|InArrow", text)
