"""Evidence ablation: answer without the evidence, name what was used, take that away too; five rounds at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import transcript
from ..sources.sinks import staged
from .pipeline import Responses, request

EVIDENCE = "array<struct<dia_id:string,utterance:string>>"


def run(questions: DataFrame, turns: DataFrame, responses: Responses, rounds: int = 5) -> DataFrame:
    """(qid, round, answer, used, result, all_evidence) of the rounds that were reached.

    questions: record_idx, qid, question, answer, evidence_dialogues. A round whose answer is wrong, can't be read or
    names no evidence is a question's last. all_evidence is what had been taken away in that round. The rounds
    are a fixed number of joins; each is one request per question still open.
    """
    typed = F.transform(F.coalesce("evidence_dialogues", F.array().cast(EVIDENCE)), lambda e: F.struct(e["dia_id"].alias("dia_id"), e["utterance"].alias("utterance")))
    now, out = questions.select("record_idx", "qid", "question", F.col("answer").alias("key"), typed.alias("gone")), None
    for r in range(1, rounds + 1):
        gone = now.select("record_idx", "qid", F.explode_outer("gone").alias("e")).select("record_idx", "qid", "e.*")
        left = transcript.without_evidence(turns, gone).withColumnRenamed("record_idx", "_r").withColumn("record_idx", F.col("qid"))
        scripts = transcript.session_transcript(left).select(F.col("record_idx").alias("qid"), "transcript")
        asked = now.join(scripts, "qid", "left")
        prompt = F.concat_ws("\n", F.lit("Answer as JSON with answer and evidence_dialogues."), F.coalesce("transcript", F.lit("")), "question")
        got = responses.answer(request(asked, "ablation", F.col("qid"), F.lit(r), prompt)).select("qid", text.clean_json(F.col("response")).alias("json"))
        said = F.get_json_object("json", "$.answer")
        used = F.coalesce(F.from_json(F.get_json_object("json", "$.evidence_dialogues"), EVIDENCE), F.array().cast(EVIDENCE))
        read = now.join(got.where(F.try_parse_json("json").isNotNull()), "qid")
        right = F.coalesce(text.option_letter(F.col("key")) == text.option_letter(said), F.lit(False))
        done = read.select("record_idx", "qid", "question", "key", "gone", F.lit(r).alias("round"), said.alias("answer"), used.alias("used"), F.when(right, "right").otherwise("wrong").alias("result"))
        done = staged(done)  # a round's calls are made once
        one = done.select("qid", "round", "answer", "used", "result", F.col("gone").alias("all_evidence"))
        out = one if out is None else out.unionByName(one)
        now = done.where((F.col("result") == "right") & (F.size("used") > 0)).select("record_idx", "qid", "question", "key", F.concat("gone", "used").alias("gone"))
    return out


def with_rounds(questions: DataFrame, turns: DataFrame, responses: Responses, rounds: int = 5) -> DataFrame:
    """``questions`` with ``iterative_evidence_ablation``: those whose check is right get the rounds that were reached.

    Others pass unchanged. questions as ``run`` takes them, with only_evidence_check and iterative_evidence_ablation.
    """
    pending = F.coalesce(F.col("only_evidence_check.result") == "right", F.lit(False))
    entry = "struct<round:int,answer:string,result:string>"
    reached = run(questions.where(pending), turns, responses, rounds).select("qid", F.struct("round", "answer", "result").cast(entry).alias("e"))
    listed = reached.groupBy("qid").agg(F.array_sort(F.collect_list("e")).alias("_rounds"))
    done = F.when(pending, F.coalesce("_rounds", F.array().cast(f"array<{entry}>"))).otherwise(F.col("iterative_evidence_ablation"))
    return questions.join(listed, "qid", "left").withColumn("iterative_evidence_ablation", done).drop("_rounds")
