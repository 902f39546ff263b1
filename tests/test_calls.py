"""Full-context answers, perturbations and ablation over recorded and computed responses."""

import json

import pytest
from pyspark.sql import functions as F

from colloquia import cli
from colloquia.plans import ablation, full_context, perturb
from colloquia.plans.pipeline import Responses
from colloquia.sources import nested, sinks


def test_full_context(spark, tmp_path):
    qa = spark.createDataFrame([(0, 1, "Why?", ["A. x", "B. y"], "B", "3"), (0, 2, "Who?\nYou need to select the correct answer from the following options: A", ["p", "q"], "A", None)], "record_idx int, qid long, question string, option array<string>, answer string, category string").withColumn("character", F.lit("Ann"))
    history = spark.createDataFrame([(0, "\n".join(f"line {i}" for i in range(20)))], "record_idx int, transcript string")

    def call(prompt):
        if "Who?" in prompt:
            assert "You need" not in prompt and "A. p\nB. q" in prompt
            return full_context.OVERFLOW
        return "(B)" if "line 17" not in prompt and "line 15" in prompt else full_context.OVERFLOW

    none = spark.createDataFrame([], "step string, qid long, round int, response string")
    got = {r.qid: r for r in full_context.score(full_context.answer(qa, history, Responses(none, call, 2, str(tmp_path / "r")))).collect()}
    assert (got[1].response, got[1].mcq_score, got[1].max_context_exceeded, got[1].category) == ("(B)", 1.0, 1, 3)
    assert (got[2].response, got[2].status, got[2].category) == (None, "overflow", -1)


def test_perturb(spark, tmp_path):
    qa = spark.createDataFrame([(1, "Ann", 1, "What is it?", "tea"), (2, "Bo", 2, "Old one?", "no")], "qid long, character string, category int, question string, answer string")
    processed = spark.createDataFrame([(2, 1.0, 0.0, 0.5, 0.5)], "qid long, conf_orig double, conf_para double, conf_bt double, conf_noise double")
    none = spark.createDataFrame([], "step string, qid long, round int, response string")
    responses = Responses(none, lambda p: f"<{p.splitlines()[1]}>", 2, str(tmp_path / "r"))
    made = {r.variant: r.question for r in perturb.variants(qa.where("qid = 1"), responses).collect()}
    assert made == {"para": "<What is it?>", "bt": "<<<What is it?>>>", "noise": "<What is it?>"}
    at = len("What is it?\nAnswer: ")
    rows = [(1, "orig", [9.0, 1.0], [0, at]), (1, "para", [2.0], [at + 2]), (1, "bt", [5.0], [at + 6]), (1, "noise", [], [])]
    tokens = spark.createDataFrame(rows, "qid long, variant string, nll array<double>, offsets array<int>")
    got = {r.id: r for r in perturb.run(qa, responses, tokens, processed).collect()}
    assert got[1].best_type == "noise" and got[1].best_gap == 998.0 and got[1].best_question == "<What is it?>" and got[1].challenge_rank == 1
    assert got[2].best_type == "para" and got[2].best_gap == 1.0 and got[2].best_question == "Old one?"


@pytest.mark.parametrize(("letter", "used", "rounds"), [("A", True, 5), ("B", True, 1), ("A", False, 1)])
def test_ablation(spark, tmp_path, letter, used, rounds):
    turns = spark.createDataFrame([(0, 1, None, i, "Ann", f"fact {i}", f"D1:{i}", None, None) for i in range(9)], "record_idx int, session_no int, session_ts string, turn_idx int, speaker string, text string, dia_id string, img_url string, blip_caption string")
    qa = spark.createDataFrame([(0, 7, "Q?", "A. x", [("D1:0", "u")])], "record_idx int, qid long, question string, answer string, evidence_dialogues array<struct<dia_id:string,utterance:string>>")

    def call(prompt):
        facts = [x.split()[-1] for x in prompt.splitlines() if x.startswith("Ann: fact")]
        return "ok " + json.dumps({"answer": letter, "evidence_dialogues": [{"dia_id": f"D1:{facts[0]}", "utterance": "u"}] if used else []})

    none = spark.createDataFrame([], "step string, qid long, round int, response string")
    got = ablation.run(qa, turns, Responses(none, call, 1, str(tmp_path / "r"))).orderBy("round").collect()
    assert len(got) == rounds and [len(r.all_evidence) for r in got] == list(range(1, rounds + 1))
    assert got[-1].result == ("right" if letter == "A" else "wrong")
    if rounds == 5:
        assert [r.used[0].dia_id for r in got] == [f"D1:{i}" for i in range(1, 6)]


def test_commands_write_their_outputs(spark, tmp_path, capsys):
    turns = [{"speaker": "Ann", "text": "tea"}, {"speaker": "x", "text": "no"}]
    qa = [{"qid": 5, "question": "What?", "option": ["A. tea", "B. no"], "answer": "A", "category": 1, "character": "Ann"}, {"question": "Who?", "option": ["p", "q"], "answer": "B", "category": 2}]
    (tmp_path / "set.json").write_text(json.dumps([{"conversation": {"speaker_a": "Ann", "speaker_b": "Bo", "session_1": turns, "session_1_date_time": "May", "note": "x"}, "qa": qa}]))
    rows = [("full_context", 5, 0, "(A)"), ("full_context", 2, 0, "(A)"), ("perturb_para", 5, 0, "Which?"), ("perturb_para", 2, 0, "Whom?"), ("perturb_noise", 5, 0, "N What?")]
    rows += [("perturb_bt", 5, i, f"b{i}") for i in range(3)]
    spark.createDataFrame(rows, "step string, qid long, round int, response string").write.parquet(str(tmp_path / "r"))
    at = len("What?\nAnswer: ")
    spark.createDataFrame([(5, "orig", [1.0], [at]), (5, "para", [4.0], [at + 9]), (2, "orig", [2.0], [99])], "qid long, variant string, nll array<double>, offsets array<int>").write.parquet(str(tmp_path / "t"))
    cli.main(["full-context", "--input_file", str(tmp_path / "set.json"), "--responses", str(tmp_path / "r"), "--output_file", str(tmp_path / "out")])
    got = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    results = json.loads(got[0]["results"])
    assert [r["response"] for r in results] == ["(A)", "(A)"] and "--- Turn started at May ---\nAnn: tea\nBo: no\n\n--- Turn started at Unknown time ---" in results[0]["answer_prompt"]
    assert "ALL        | 2      | 0.5000" in (tmp_path / "out_mcq_summary.log").read_text()
    cli.main(["perturb", "--input", str(tmp_path / "set.json"), "--responses", str(tmp_path / "r"), "--tokens", str(tmp_path / "t"), "--output", str(tmp_path / "hard"), "--replaced", str(tmp_path / "new")])
    hard = spark.read.json(str(tmp_path / "hard")).orderBy("challenge_rank").collect()
    assert [(r.id, r.best_type) for r in hard] == [(5, "bt"), (2, "para")] or [(r.id, r.best_type) for r in hard] == [(2, "para"), (5, "bt")]
    assert sorted(r.question for r in spark.read.json(str(tmp_path / "new")).collect()) == ["Whom?", "b2"]
    assert "'replaced': 2, 'missing': 0" in capsys.readouterr().out


def test_results_of_complete_conversations_are_finalized(spark, tmp_path):
    asked = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 1), (3, 0)], "conv_idx int, question_idx int")
    said = spark.createDataFrame([(1, 1, "b"), (1, 0, "a"), (2, 0, "c")], "conv_idx int, question_idx int, response string")
    sinks.finalize_results(said, asked, str(tmp_path / "final"))
    got = spark.read.parquet(str(tmp_path / "final")).collect()
    assert [(r.conv_idx, [x["response"] for x in json.loads(r.results)]) for r in got] == [(1, ["a", "b"])]


def test_documents_and_lines_are_told_apart(spark, tmp_path):
    (tmp_path / "a b.json").write_text('[{"i": 1},\n {"i": 2}]')
    (tmp_path / "c.json").write_text('\n{"i": 3}\n\n[{"i": 4}, {"i": 5}]\n')
    (tmp_path / "d.json").write_text('{"i":\n6}')
    (tmp_path / "e.json").write_text("")
    got = nested.read_json_or_lines(spark, str(tmp_path)).select("file", F.get_json_object("value", "$.i").cast("int").alias("i")).collect()
    assert sorted(r.i for r in got) == [1, 2, 3, 4, 5, 6]


def test_arrays_that_are_cut_off(spark):
    whole = json.dumps([{"a": 'x}]{["\\', "b": [{"c": 1}]}, {"a": "é"}, {"a": {"d": {}}}], ensure_ascii=False)
    ends = [i + 1 for i in range(len(whole)) if isinstance(_try(whole[: i + 1] + "]"), list)]
    rows = [(n, whole[:n]) for n in range(1, len(whole) + 1)]
    got = spark.createDataFrame(rows, "n int, value string").select("n", F.coalesce(F.size(nested.container(F.col("value"))), F.lit(0)).alias("k")).collect()
    for r in got:
        good = [len(_try(whole[:e] + "]")) for e in ends if e <= r.n]
        assert r.k == (3 if r.n == len(whole) else max(good, default=0)), r


def _try(text):
    try:
        return json.loads(text)
    except ValueError:
        return None
