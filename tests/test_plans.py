"""Plans of the registered queries: column pruning, no Python, no products, no unkeyed window over rows."""

import re

import pytest

from colloquia.plans import catalogue

BATCH = [n for n in catalogue.QUERIES if n != "running_blind_accuracy"]
#: Joins without an equal key: one row with one row.
KEYLESS = {"dataset_stats"}
#: Windows without a partition: over one row per record, per distinct name or per threshold.
UNKEYED = {"session_renumber", "merged_record", "speaker_first_seen", "overlap_curve", "best_threshold"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_plan(spark, sf_dir, name):
    text = plan(catalogue.QUERIES[name](spark, sf_dir))
    assert not re.search("Python|Pandas|Arrow", text.replace("ArrowEvalPython", "Python"))
    assert "CartesianProduct" not in text or name == "dataset_stats"
    assert "BroadcastNestedLoopJoin" not in text or name in KEYLESS
    assert "SinglePartition" not in re.sub(r"(?s)HashAggregate.*", "", text) or "Window" not in text or name in UNKEYED


def test_columns_are_pruned(spark, sf_dir):
    text = plan(catalogue.QUERIES["role_counts"](spark, sf_dir))
    assert re.search(r"ReadSchema: struct<role:string>", text)
    assert "text" not in re.search(r"ReadSchema: (\S+)", plan(catalogue.QUERIES["blind_accuracy"](spark, sf_dir)))[1]
