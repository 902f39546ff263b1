"""The question pipeline end to end with recorded and with live responses, the command line, configuration."""

import json

import pytest

from colloquia import cli
from colloquia.config import Config
from colloquia.plans import pipeline, provider


def question(i, who="Ann"):
    return {"character": who, "category": i % 6 + 1, "question": f"What about {i}?", "option": [f"{c}. body {i}{c}" for c in "ABCDE"], "answer": "B", "evidence_dialogues": [{"dia_id": "D1:1", "utterance": "u"}]}


@pytest.fixture(scope="module")
def scripts(tmp_path_factory):
    root = tmp_path_factory.mktemp("scripts")
    for n in (2, 10, 1):
        talk = {"speaker_1": "Ann", "speaker_2": "Bo", "session_1_date_time": "noon", "session_1": [{"speaker": "Ann", "text": f"hello {n}", "dia_id": f"D{n}:1"}]}
        qa = [question(n * 100 + i, "Ann" if i % 2 else "Bo") for i in range(4)] if n != 10 else []
        (root / f"play_{n}.json").write_text(json.dumps({"filename": f"play_{n}", "qa": qa, "conversation": talk}))
    return root


def call(prompt: str) -> str:
    if prompt.startswith("Write multiple"):
        return "```json\n" + json.dumps({"qa": [{"character": "Ann", "category": 2, "question": "New one?", "option": ["A. p", "B. q"], "answer": "A"}]}) + "\n```"
    if prompt.startswith("Answer from this"):
        lines = [x for x in prompt.splitlines() if x[1:3] == ". "]
        hit = [x[0] for x in lines if x.endswith("B")]
        return "Sure: " + json.dumps({"answer": hit[0] if hit else "A"})
    if prompt.startswith("Name the kind"):
        return " 多跳 \n"
    if prompt.startswith("Merge these"):
        gone = json.loads(prompt.split("\n", 1)[1])[0]["question"]
        return "x [" + json.dumps({"character": "Ann", "category": 3, "question": "Why all that?", "option": ["A. one", "B. two"], "answer": "A", "label": "memory_update", "original_qa": [gone]}) + "] y"
    return json.dumps({"option": "A", "option_w_content": "A. x"})


def test_live_then_recorded(spark, scripts, tmp_path):
    none = spark.createDataFrame([], "step string, qid long, round int, response string")
    live = pipeline.Responses(none, call, 2, str(tmp_path / "responses"))
    made = pipeline.run(spark, f"{scripts}/*.json", str(tmp_path / "live"), live, seed="7")
    v = {k: df.count() for k, df in made.items()}
    assert v["v0"] == v["v1"] == 10 and v["v2"] < v["v1"] and v["v4"] == v["v3"] == v["final"]
    first = made["v0"].orderBy("qid").first()
    assert first.filename == "play_1" and first.option[-1].startswith("F.")
    assert {r.label for r in made["v2"].select("label").collect()} == {"多跳"}
    assert made["v3"].where("label = '记忆更新'").count() >= 1
    got = made["v4"].select("qid", "pollution_check.*").collect()
    assert all(r.total_count == 10 and r.result in ("good", "suspected") for r in got)
    table = spark.read.parquet(str(tmp_path / "responses")).select("step", "qid", "round", "response")
    again = pipeline.run(spark, f"{scripts}/*.json", str(tmp_path / "again"), pipeline.Responses(table), seed="7")
    for name in ("v0", "v2", "final"):
        columns = [c for c in made[name].columns if c != "version"]
        assert made[name].select(*columns).exceptAll(again[name].select(*columns)).isEmpty()


def test_files_by_name(spark, scripts, tmp_path):
    names = sorted(f.name for f in scripts.glob("*.json"))
    by_name = [r.filename for r in pipeline.load(spark, f"{scripts}/*.json", by_name=True)[0].orderBy("record_idx").collect()]
    by_number = [r.filename for r in pipeline.load(spark, f"{scripts}/*.json")[0].orderBy("record_idx").collect()]
    assert by_name == [n.removesuffix(".json") for n in names] and sorted(by_name) == sorted(by_number) and by_number != by_name
    (tmp_path / "a_1.json").write_text(json.dumps([{"conversation": {"session_1": []}, "filename": str(i)} for i in range(3)]))
    assert [r.filename for r in pipeline.load(spark, str(tmp_path), by_name=True)[0].collect()] == ["0"]


def test_provider_status(spark):
    ask = spark.createDataFrame([("s", 1, 0, "good"), ("s", 2, 0, "bad")], "step string, qid long, round int, prompt string")

    def flaky(prompt):
        if prompt == "bad":
            raise RuntimeError("limit")
        return prompt.upper()

    got = {r.qid: (r.response, r.status) for r in provider.live(ask, flaky, 2, tries=2).collect()}
    assert got == {1: ("GOOD", "ok"), 2: (None, "RuntimeError")}


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"pipeline": {"temp_dir": "t"}, "steps": {"step_2_label": {"llm": {"model": "m", "api_key": "k"}, "enable": True}}, "tools": {"option_perturbation": {"llm": {"gen_model": "g", "score_model": "s"}}}}))
    c = Config.load(str(path))
    assert c.pipeline.version_path("v1", "play") == "t/play_v1" and c.step_model("step_2_label").model == "m" and c.step_flag("step_2_label", "enable")
    assert c.perturbation_models() == ("g", "s") and "k" not in c.summary().split("[m]")[0].split("step_2")[1]
    with pytest.raises(KeyError):
        c.step("step_9")
    with pytest.raises(FileNotFoundError):
        Config.load(str(tmp_path / "none.json"))


def test_command_line(spark, tmp_path, capsys):
    qa = [question(i) | {"only_evidence_check": {"result": "right" if i % 3 else "maybe_wrong"}, "label": "x"} for i in range(24)]
    for v in ("v0", "v1"):
        (tmp_path / f"play_{v}.json").write_text(json.dumps([{"filename": "one", "qa": qa}, {"qa": qa[:3]}]))
    cli.main(["stats", "--input-dir", str(tmp_path), "--output", str(tmp_path / "stats"), "--output-csv", str(tmp_path / "s.csv")])
    rows = (tmp_path / "s.csv").read_text(encoding="utf-8-sig").splitlines()
    assert rows[0].split(",")[2:] == ["<unknown>", "one", "sum"] and rows[1].split(",")[:2] == ["v0", "1"]
    cli.main(["sample", "--input", str(tmp_path / "play_v0.json"), "--output", str(tmp_path / "q.csv")])
    assert len((tmp_path / "q.csv").read_text().splitlines()) == 13
    losses = [{"outer_id": "a", "inner_id": i, "avg_loss": i / 3, "pollution_check": {"all_responses_and_scores": [{"score": int(j < i)} for j in range(10)]}} for i in range(10)]
    (tmp_path / "l.json").write_text(json.dumps(losses))
    cli.main(["overlap", "--input", str(tmp_path / "l.json"), "--out-prefix", str(tmp_path / "o")])
    assert "best threshold:" in capsys.readouterr().out and len((tmp_path / "o.csv").read_text().splitlines()) == 12
    (tmp_path / "r.json").write_text(json.dumps({"0": [{"answer": "B", "response": "(B)", "category": 1}, {"answer": "A", "response": "C"}]}))
    cli.main(["score", "--input", str(tmp_path / "r.json"), "--output", str(tmp_path / "scored"), "--summary", str(tmp_path / "m.log")])
    assert "Unknown" in (tmp_path / "m.log").read_text() and "0.5000" in (tmp_path / "m.log").read_text()
    cli.main(["show"])
