"""Sinks, caches, small scalars, and the stream's result sink."""

import json

from pyspark.sql import functions as F

from colloquia.functions import text
from colloquia.sources import nested, sinks
from colloquia.streaming import blind


def test_round_trip(spark, tmp_path):
    qa = [{"qid": i, "question": f"é {i}", "option": ["A. x"], "answer": None} for i in (3, 1, 2)]
    files = spark.createDataFrame([(0, json.dumps({"filename": "f", "qa": qa, "conversation": {}}))], "doc int, value string")
    flat = nested.questions_of(nested.normalized(nested.records_of(files)))
    back = sinks.nested_records(flat, ["record_idx"], "qa_idx", ["qid", "question", "option", "answer"])
    assert json.loads(back.first()["record"])["qa"] == qa
    sinks.write_json(back, str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0])["qa"] == qa


def test_grouped_results(spark):
    rows = spark.createDataFrame([(1, 1, "b"), (1, 0, "a"), (2, 0, None)], "conv_idx int, question_idx int, response string")
    got = {r.conv_idx: json.loads(r.results) for r in sinks.grouped_results(rows).collect()}
    assert got == {1: [{"response": "a"}, {"response": "b"}], 2: [{"response": None}]}


def test_versions(spark, tmp_path):
    for v, n in (("v0", 2), ("v1", 1), ("v0", 3)):
        sinks.write_version(spark.range(n).toDF("qid"), str(tmp_path), v)
    got = {r.version: r.n for r in sinks.read_versions(spark, str(tmp_path)).groupBy("version").agg(F.count("*").alias("n")).collect()}
    assert got == {"v0": 3, "v1": 1}


def test_cache_keeps_the_last(spark):
    rows = spark.createDataFrame([("a", 1, 0.1), ("a", 2, 0.2), ("b", 1, 0.3)], "id string, pos int, gap double")
    assert sorted((r.id, r.gap) for r in nested.latest_by_id(rows, "id", "pos").collect()) == [("a", 0.2), ("b", 0.3)]


def test_replayed_batches_leave_one_copy(spark, tmp_path):
    batch = spark.createDataFrame([(1, 0, "x"), (1, 0, "x"), (2, 0, "y")], "qid long, round int, response string")
    for _ in range(2):
        blind.append_results(batch, 7, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 2


def test_scalars(spark):
    row = spark.range(1).select(
        text.token_estimate(F.lit("abcde")).alias("t"), text.preview(F.lit("x" * 50)).alias("p"), text.duration(F.lit(125.9)).alias("d"), text.answer_offset(F.lit("Q? \n"), F.lit("yes")).alias("o")
    ).first()
    assert (row.t, len(row.p), row.d, row.o) == (2, 40, "2m 5s", 11)


def test_orders(spark):
    keys = spark.createDataFrame([(k,) for k in ("B", "a", "10", "9", "-1")], "k string")
    assert [r.k for r in keys.orderBy(*text.mixed_order_lower(F.col("k"))).collect()] == ["9", "10", "-1", "a", "B"]
    files = spark.createDataFrame([(f"p_{n}.json",) for n in (10, 2, 1)], "file string")
    assert [r.file for r in files.orderBy(*nested.episode_order(F.col("file"))).collect()] == ["p_1.json", "p_2.json", "p_10.json"]


def test_output_path():
    assert sinks.output_path("a/b.json", "_x.log") == "result/b_x.log" and sinks.output_path("a", "b", "c") == "c"
