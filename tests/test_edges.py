"""Edge rows of the operators: expected values are written out, not computed."""

import json

import pytest
from pyspark.sql import functions as F

from colloquia.functions import mcq, text
from colloquia.operators import questions as q
from colloquia.operators import ranking, transcript
from colloquia.sources import nested, sinks


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())) if values else spark.range(1)
    return df.select(expression.alias("x")).first()["x"]


RECORD = {
    "qa": {"10": {"question": "ten"}, "2": {"question": "two"}},
    "conversation": {
        "speaker_1": "Ann", "speaker_3": "Cy", "speaker_a": "Ann", "session_10": [{"speaker": 3, "text": "late", "dia_id": "D10:1"}], "session_2_date_time": "Monday",
        "session_2": [{"speaker": None, "text": "it rains", "dia_id": "D2:1"}, {"speaker": "speaker_1", "text": "hi", "dia_id": "D2:2"}, {"speaker": "Bo", "dia_id": "D2:3"}, "junk"], "session_1_time": "x",
    },
}


@pytest.fixture(scope="module")
def loaded(spark):
    docs = [json.dumps([RECORD, RECORD]), json.dumps(RECORD), json.dumps({"10": {"qa": [{"question": "b"}]}, "2": {"qa": [{"question": "a"}]}}), "[" + json.dumps(RECORD)]
    files = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc int, value string")
    return nested.normalized(nested.records_of(files))


def test_containers(loaded):
    rows = loaded.groupBy("doc").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("record_idx", "qa"))).alias("r")).collect()
    by = {r.doc: r for r in rows}
    assert {k: r.n for k, r in by.items()} == {0: 2, 1: 1, 2: 2, 3: 1}  # the truncated array gives what stands before the cut
    assert [json.loads(x)["question"] for x in by[0].r[0].qa] == ["two", "ten"]
    assert [json.loads(r.qa[0])["question"] for r in by[2].r] == ["a", "b"]


def test_transcript(loaded):
    records = loaded.where("doc = 1")
    turns = transcript.speaker_name(nested.turns_of(records), nested.speakers_of(records))
    got = transcript.session_transcript(turns).first()["transcript"]
    assert got == "--- Turn started at Monday ---\nNone: it rains\nAnn: hi\n\n--- Turn started at Unknown time ---\nCy: late"


def test_two_party_headers(spark):
    rows = [(0, 0, None, None, None, None), (0, 1, "t", 0, "Ann", "hi"), (0, 1, "t", 1, "Bo", "yes")]
    df = spark.createDataFrame(rows, "record_idx int, key_idx int, session_ts string, turn_idx int, speaker string, text string").withColumns({"speaker_a": F.lit("Ann"), "speaker_b": F.lit("speaker_b")})
    assert transcript.two_party_transcript(df).first()["transcript"] == "\n--- Turn started at Unknown time ---\n\n--- Turn started at t ---\nAnn: hi\nspeaker_b: yes"


def test_without_evidence(spark):
    turns = spark.createDataFrame([(0, 1, "noon", 0, "D1:1"), (0, 1, "noon", 1, "D1:2"), (0, 2, "dusk", 0, "D2:1")], "record_idx int, session_no int, session_ts string, turn_idx int, dia_id string")
    ev = spark.createDataFrame([(0, 7, "D1:2", ""), (0, 7, "N/A", "from session_2_date_time"), (0, 7, "", None)], "record_idx int, qid int, dia_id string, utterance string")
    got = sorted((r.session_no, r.turn_idx, r.session_ts) for r in transcript.without_evidence(turns, ev).collect())
    assert got == [(1, 0, "noon"), (2, 0, None)]


@pytest.mark.parametrize(("answer", "letter"), [("Because ...", "B"), ("Error: x", "E"), ("  F", "F"), ("because", None), ("", None)])
def test_letters(spark, answer, letter):
    assert one(spark, text.option_letter(F.col("a")), a=answer) == letter


MCQ = [("(A)", "A", False), ("[b]", "B", False), ("AB", "AB", False), ("(A)(B)", "", True), ("Bad", "ABD", False), ("The answer is (D)", "D", False), ("answer depends", "D", False), ("x (A) y (C)", "AC", False), ("<think>A</think>c", "C", False), ('{"answer": "B"}', "B", False), ("", "", False), ("option e.", "E", False), ('{"answer": 5}', "", False)]


def test_mcq(spark):
    df = spark.createDataFrame([(r,) for r, _, _ in MCQ], "r string")
    got = df.select("r", F.array_join(mcq.predicted(F.col("r")), "").alias("l"), mcq.malformed(F.col("r")).alias("m")).collect()
    assert [(r.r, r.l, r.m) for r in got] == MCQ


def test_mcq_candidates(spark):
    df = spark.createDataFrame([(["C", "", "B. two", "A"], "A", "(B)"), (None, "a", "A"), ([], None, "A"), (["D"], "A", "(A)(B)")], "f array<string>, a string, r string")
    got = [r.x for r in df.select(mcq.score(F.col("f"), F.col("a"), F.col("r")).alias("x")).collect()]
    assert [g.mcq_score for g in got] == [1.0, 1.0, 0.0, 0.0]
    assert got[0].matched_answer == "B. two" and got[0].ground_truth_options == [["C"], ["B"]] and got[3].prediction_malformed


def items(spark, rows):
    return spark.createDataFrame(rows, "qid long, question string, option array<string>, answer string")


def test_shuffle(spark):
    seven = [f"{c}. body {c}" for c in "ABCDEGH"]
    rows = [(1, "Q?\n\n  You need to select one", seven, "B"), (2, "Q", ["A. x", "F． none"], "F"), (3, "Q", ["A x", "B. y"], "F"), (4, "Q", ["A. same", "B. same"], "B. same"), (5, "Q", None, None)]
    got = {r.qid: r for r in q.shuffle_options(items(spark, rows), "s").collect()}
    assert got[1].stem == "Q?" and len(got[1].new_option) == 6 and got[1].dropped_options == 2
    assert got[1].new_answer.endswith("body B") or got[1].new_answer == "B"
    assert got[2].new_option[-1] == "F． none" and got[2].new_answer == "F． none"
    assert got[3].new_answer == "F" and got[3].new_option[-1] == text.CANNOT_INFER and any(o.endswith(". A x") for o in got[3].new_option)
    assert got[4].new_answer == "A. same" and got[5].new_option == [text.CANNOT_INFER]
    for r in got.values():
        assert [o[0] for o in r.new_option] == list("ABCDE"[: len(r.new_option) - 1]) + ["F"]


def test_accuracy_is_strict(spark):
    rows = [(1, s) for s in (1, 0)] + [(2, s) for s in (1, 1, 0)]
    got = {r.qid: r.result for r in q.blind_accuracy(spark.createDataFrame(rows, "qid int, score int"), ["qid"]).collect()}
    assert got == {1: "good", 2: "suspected"}


def test_sufficiency(spark):
    a = "array<struct<round:int,result:string>>"
    df = spark.createDataFrame([(1, "right", [(5, "right")]), (2, "right", [(4, "right"), (5, "wrong")]), (3, None, None), (4, "maybe_wrong", []), (5, "right", None)], f"qid int, c string, a {a}")
    assert sorted(r.qid for r in df.where(q.sufficient(F.col("c"), F.col("a"))).collect()) == [2, 5]


def test_ablation(spark):
    rows = [(1, r, "A", "A", 1) for r in range(1, 8)] + [(2, 1, "A", "A", 1), (2, 2, "A", "B", 1), (2, 3, "A", "A", 1), (3, 1, "A", "A", 0), (3, 2, "A", "A", 1)]
    got = q.ablation_rounds(spark.createDataFrame(rows, "qid int, round int, answer string, response string, n_used int"))
    assert {r.qid: r.n for r in got.groupBy("qid").agg(F.count("*").alias("n")).collect()} == {1: 5, 2: 2, 3: 1}


def test_curve(spark):
    rows = [(i, i % 4, float(i)) for i in range(8)] + [(90, 3, float("nan")), (91, 3, None)]
    curve = ranking.overlap_curve(spark.createDataFrame(rows, "qid long, k int, loss double"), "qid", "k", "loss")
    got = {r.x: r for r in curve.collect()}
    assert got[0].y == 8 and got[0].jaccard == 1.0 and got[0].delta_j == 0.0
    assert got[3].y == 2 and got[3].jaccard == 0.0 and got[7].y == 0 and got[7].delta_j == 0.0
    assert ranking.best_threshold(curve).first()["best_x"] == 4
    with pytest.raises(ValueError):
        ranking.overlap_curve(spark.createDataFrame(rows[8:], "qid long, k int, loss double"), "qid", "k", "loss")


def test_global_rank_with_ties(spark):
    rows = [(i, float(i % 3)) for i in range(500)] + [(900, None)]
    got = {r.i: r.rank for r in ranking.global_rank(spark.createDataFrame(rows, "i int, v double"), "v", ["i"], buckets=7).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    assert got == {i: n for n, (i, _) in enumerate(order)}
    same = ranking.global_rank(spark.createDataFrame([(i, 1.0) for i in range(300)], "i int, v double"), "v", ["i"], buckets=8)
    assert all(r.i == r.rank for r in same.collect())
    assert ranking.global_rank(spark.createDataFrame([], "i int, v double"), "v", ["i"]).count() == 0


def test_min_k(spark):
    df = spark.createDataFrame([([1.0, 5.0, 3.0, 2.0, 4.0, 0.0, 0.0, 0.0, 0.0, 0.0],), ([2.0],), ([],)], "l array<double>")
    assert [r.x for r in df.select(ranking.min_k_loss(F.col("l")).alias("x")).collect()] == [4.5, 2.0, None]
    offsets = F.array(*[F.lit(i * 2) for i in range(3)])
    x = spark.range(1).select(ranking.min_k_confidence(F.array(F.lit(1.0), F.lit(7.0), F.lit(3.0)), offsets, F.lit(3)).alias("x")).first()["x"]
    assert x == -3.0


def test_gap_ties(spark):
    rows = [(1, 1.0, 0.5, 0.5, 0.5), (2, 1.0, 0.9, 0.5, 0.5), (3, 1.0, None, None, 0.2), (4, None, None, None, None)]
    got = {r.qid: r.best_type for r in q.gaps(spark.createDataFrame(rows, "qid int, conf_orig double, conf_para double, conf_bt double, conf_noise double")).collect()}
    assert got == {1: "para", 2: "bt", 3: "noise", 4: "para"}


def test_sample_needs_enough(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "qid int, category int")
    assert ranking.stratified_sample(df, "category", [1], 2, F.col("qid"), "qid").count() == 2
    with pytest.raises(ValueError):
        ranking.stratified_sample(df, "category", [1, 2], 2, F.col("qid"), "qid")


@pytest.mark.parametrize("limit", [10_000, 0])
def test_remove_replaced(spark, limit):
    qa = spark.createDataFrame([(1, "say hello to all the world"), (2, "other"), (3, None), (4, "ab")], "qid long, question string")
    gone = spark.createDataFrame([("hello to all the",), ("b",), ("",), (None,)], "q_text string")
    assert sorted(r.qid for r in q.remove_replaced(qa, gone, limit).collect()) == [2, 3]


def test_versions_and_incremental(spark):
    rows = [("a", "v0", 1), ("a", "v1", 1), ("a", "v1", 1), (None, "v2", 2), (None, "v3", 2)]
    got = q.incremental(spark.createDataFrame(rows, "key string, version string, n int"), ["key"], "version")
    assert sorted((r.key or "", r.version) for r in got.collect()) == [("", "v2"), ("a", "v0")]
    assert one(spark, text.version_of(F.col("f")), f="my_v2_v3.json") == "v3"


def test_summary_reproduces_published_tables(spark):
    published = {
        "A": ([37, 47, 26, 21, 26, 28], [30, 37, 21, 18, 24, 23], ["0.8108", "0.7872", "0.8077", "0.8571", "0.9231", "0.8214"], "0.8270"),
        "B": ([70, 66, 44, 49, 50, 47], [54, 47, 30, 35, 38, 33], ["0.7714", "0.7121", "0.6818", "0.7143", "0.7600", "0.7021"], "0.7270"),
    }
    for counts, right, means, overall in published.values():
        rows = [(str(c + 1), float(i < right[c])) for c, n in enumerate(counts) for i in range(n)]
        report = sinks.metrics_report(q.metrics_summary(spark.createDataFrame(rows, "category string, mcq_score double")))
        lines = [x.split("|") for x in report.splitlines() if x.count("|") == 2][1:]
        assert [x[2].strip() for x in lines] == [*means, overall] and [int(x[1]) for x in lines] == [*counts, sum(counts)]
    empty = q.metrics_summary(spark.createDataFrame([], "category string, mcq_score double"))
    assert "No results to summarize." in sinks.metrics_report(empty)


def test_result_layouts(spark):
    entry = {"answer": "A", "response": "A", "category": 3}
    docs = [{"0": [entry, 5], "10": {"qa": [entry]}}, [{"qa": [entry, entry]}], {"qa": [entry]}]
    got = [nested.result_entries(spark.createDataFrame([(json.dumps(d),)], "value string"), "value").count() for d in docs]
    assert got == [2, 2, 1]


def test_jsonl_fallback(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}\n\n[{"x": 2}, {"x": 3}]\n')
    (tmp_path / "b.json").write_text('[{"x": 4},\n {"x": 5}]')
    got = sorted(json.loads(r.value)["x"] for r in nested.read_json_or_lines(spark, str(tmp_path)).collect())
    assert got == [1, 2, 3, 4, 5]


def test_ascii_json(spark):
    assert one(spark, sinks.ascii_json(F.to_json(F.array(F.col("a")))), a="é🙂x") == '["\\u00e9\\ud83d\\ude42x"]'


def test_mixed_order(spark):
    df = spark.createDataFrame([(k,) for k in ("b", "10", "2", "a")], "k string")
    assert [r.k for r in df.orderBy(*text.mixed_order(F.col("k"))).collect()] == ["2", "10", "a", "b"]


def test_loss_ids(spark):
    df = spark.createDataFrame([("a", "1", 5, 9), ("", None, 0, 9), (None, None, 4, 9)], "o string, i string, g int, p int")
    assert [r.x for r in df.select(nested.loss_item_id(F.col("o"), F.col("i"), F.col("g"), F.col("p")).alias("x")).collect()] == ["a:1", "idx:9", "idx:4"]


def test_character_groups(spark):
    rows = [(1, "Ann", "1"), (2, "Ann", "7"), (3, "Unknown", "1"), (4, "Unknown", "1"), (5, "Bo", "2"), (6, None, "x"), (7, None, "3")]
    got = {r.character: r.category_counts for r in q.character_groups(spark.createDataFrame(rows, "qid int, character string, category string")).collect()}
    assert got == {"Ann": "1:1 2:0 3:0 4:0 5:0 6:0", None: "1:0 2:0 3:1 4:0 5:0 6:0"}
