"""Removal of questions that contain a replaced text: every plan gives the same rows."""

import pytest

from colloquia.operators import questions as q

LONG = "What did the captain say about the weather"
ROWS = [
    (1, f"{LONG} that day?"), (1, "Something else entirely?"), (None, f"Once more: {LONG}?"), (None, "Kept without an id"), (2, None), (3, ""), (4, "short"), (5, "a short one"), (5, "a short one"), (6, "x"), (7, "What did the captain say"),
    (8, "é" * 11 + "ü"), (9, "aaaaaaaaaaaaaaaaaaaaaaaab"),
]


@pytest.mark.parametrize("gone", [[LONG], [LONG, "short"], ["x", "é" * 11 + "ü", LONG, LONG, None, ""], ["aaaaaaaaaaaaab", "zzz"], [], ["What did the captain say about"]])
def test_all_plans_agree(spark, gone):
    qa = spark.createDataFrame([(*r, "z", 0) for r in ROWS], "qid long, question string, q_text string, _n int")
    removed = spark.createDataFrame([(g,) for g in gone], "q_text string")
    want = sorted((r for r in ROWS if not any(g and g in (r[1] or "") for g in gone)), key=str)
    for rows in (10_000, 0):
        kept = q.remove_replaced(qa, removed, rows)
        assert kept.columns == qa.columns
        assert sorted(((r.qid, r.question) for r in kept.collect()), key=str) == want
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
