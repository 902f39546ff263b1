"""The question pipeline v0 to final, offline: every model call is a row of a response table.

Each step is a function of DataFrames; each version is a Parquet table, which is the barrier
after the calls. ``Responses`` is the one place that may call a live model.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import questions as q
from ..operators import transcript
from ..operators.ranking import global_rank
from ..sources import nested, sinks
from .provider import answered, recorded


@dataclass
class Responses:
    """Recorded responses (step, qid, round, response) and, if given, a live call for what is missing."""

    table: DataFrame
    call: Callable[[str], str] | None = None
    parallel: int = 4
    path: str = ""

    def answer(self, requests: DataFrame) -> DataFrame:
        if self.call is None:
            return recorded(requests, self.table)
        return answered(requests, self.table, self.call, self.parallel, self.path)


def request(df: DataFrame, step: str, qid: Column, round_: Column, prompt: Column) -> DataFrame:
    return df.select(F.lit(step).alias("step"), qid.cast("long").alias("qid"), round_.cast("int").alias("round"), prompt.alias("prompt"))


def load(spark: SparkSession, path: str, by_name: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, turns, speakers) of all JSON files under ``path``, episodes in numeric order or in that of their names.

    By name only a file's first record counts.
    """
    files = nested.read_documents(spark, path)
    number = F.lit(0) if by_name else F.coalesce(F.regexp_extract("file", r"_(\d+)\.json$", 1).try_cast("int"), F.lit(2**30))
    parts = nested.records_of(files.withColumn("_n", number)).withColumnRenamed("record_idx", "_in_file")
    parts = parts.where("_in_file = 0") if by_name else parts
    ordered = global_rank(parts, "_n", ["file", "_in_file"], "record_idx")
    records = nested.normalized(ordered.select("record_idx", "file", "record")).withColumn("filename", F.coalesce("filename", "file"))
    records = records.where(F.coalesce(F.size(F.json_object_keys("conversation")), F.lit(0)) > 0)
    speakers = nested.speakers_of(records)
    return records, transcript.speaker_name(nested.turns_of(records), speakers), speakers


def generate(records: DataFrame, turns: DataFrame, speakers: DataFrame, responses: Responses) -> DataFrame:
    """v0: questions that records bring along, else one call per record and speaker."""
    have = nested.questions_of(records.where(F.size("qa") > 0)).drop("item")
    bare = records.where(F.size("qa") == 0).select("record_idx", "filename")
    named = speakers.groupBy("record_idx", "name").agg(F.min("ordinal").alias("ordinal"))
    whole = transcript.session_transcript(turns)
    asked = bare.join(named, "record_idx").join(whole, "record_idx").withColumn("_id", F.col("record_idx") * 100_000 + F.least("ordinal", F.lit(99_999)))
    prompt = F.concat(F.lit("Write multiple-choice questions about "), "name", F.lit(" in six categories as a JSON object with a list qa.\n"), "transcript")
    got = responses.answer(request(asked, "generate", F.col("_id"), F.lit(0), prompt))
    listed = asked.select("record_idx", "filename", "ordinal", F.col("_id").alias("qid")).join(got.select("qid", "response"), "qid").drop("qid")
    made = listed.select("record_idx", "filename", F.posexplode(nested.qa_list(F.get_json_object(text.strict_json_object(F.col("response")), "$.qa"))).alias("i", "item"), "ordinal")
    made = made.withColumn("q", F.from_json("item", nested.QA)).select("record_idx", "filename", (F.col("ordinal") * 1000 + F.col("i")).cast("int").alias("qa_idx"), "q.*")
    both = have.unionByName(made)
    numbered = global_rank(both.withColumn("_r", F.col("record_idx").cast("double")), "_r", ["qa_idx"], "qid_new", start=1).drop("_r")
    return numbered.withColumn("qid", F.coalesce("qid", "qid_new")).drop("qid_new")


def shuffled(questions: DataFrame, seed: str) -> DataFrame:
    out = q.shuffle_options(questions, seed)
    return out.withColumns({"option": F.col("new_option"), "answer": F.col("new_answer"), "question": F.col("stem")}).drop("new_option", "new_answer", "stem", "rendered_question", "dropped_options")


def rendered() -> Column:
    return F.concat_ws("\n", "question", F.array_join("option", "\n"), F.lit(text.INSTRUCTION))


def evidence_json() -> Column:
    """Evidence and reasoning of a question as JSON; what is missing is an empty list."""
    empty = F.lit("[]")
    return F.concat_ws("\n", F.coalesce(F.to_json("evidence_dialogues"), empty), F.coalesce(F.to_json("reasoning_steps"), empty))


def evidence_context(questions: DataFrame, turns: DataFrame, mode: str = "default") -> DataFrame:
    """(qid, context) that a prompt of each mode builds on.

    only: the evidence itself; except: the conversation without it; default: all of the
    conversation. questions: record_idx, qid, evidence_dialogues, reasoning_steps.
    """
    if mode == "only":
        return questions.select("qid", evidence_json().alias("context"))
    if mode == "except":
        named = questions.select("record_idx", "qid", F.explode_outer("evidence_dialogues").alias("e")).select("record_idx", "qid", "e.dia_id", "e.utterance")
        left = transcript.without_evidence(turns, named).drop("record_idx").withColumnRenamed("qid", "record_idx")
        whole = transcript.session_transcript(left).withColumnRenamed("record_idx", "qid")
        joined = questions.select("qid").join(whole, "qid", "left")
    elif mode == "default":
        joined = questions.select("record_idx", "qid").join(transcript.session_transcript(turns), "record_idx", "left")
    else:
        raise ValueError(f"unknown mode {mode}")
    return joined.select("qid", F.coalesce("transcript", F.lit("")).alias("context"))


def check_evidence(questions: DataFrame, responses: Responses) -> DataFrame:
    """v1: whether evidence and reasoning alone give the right letter; nothing is dropped."""
    prompt = F.concat(F.lit("Answer from this evidence alone, as JSON with an answer.\n"), evidence_json(), F.lit("\n"), rendered())
    got = responses.answer(request(questions, "check", F.col("qid"), F.lit(0), prompt)).select("qid", "response", "status")
    joined = questions.join(got, "qid")
    said = F.coalesce(F.get_json_object(text.clean_json(F.col("response")), "$.answer"), F.when(F.col("status") == "recorded", F.col("response")))
    return joined.withColumn("only_evidence_check", F.struct(q.verdict(F.col("answer"), said).alias("result"), F.col("response").alias("response"))).drop("response", "status")


def label(questions: DataFrame, turns: DataFrame, responses: Responses) -> DataFrame:
    """v2: sufficient questions only, each with a label; an unanswered one gets the text null."""
    rounds = F.transform(F.coalesce("iterative_evidence_ablation", F.array().cast("array<struct<round:int,answer:string,result:string>>")), lambda r: F.struct(r["round"].alias("round"), r["result"].alias("result")))
    kept = questions.where(q.sufficient(F.col("only_evidence_check.result"), rounds))
    asked = kept.join(transcript.session_transcript(turns), "record_idx", "left")
    prompt = F.concat(F.lit("Name the kind of reasoning that this question asks for: " + ", ".join(text.LABELS[:4]) + "\n"), F.coalesce("transcript", F.lit("")), F.lit("\n"), "question")
    got = responses.answer(request(asked, "label", F.col("qid"), F.lit(0), prompt)).select("qid", F.coalesce(text.strip(F.col("response")), F.lit("null")).alias("label"))
    return kept.drop("label").join(got, "qid")


REFINED = "struct<character:string,category:string,question:string,option:array<string>,answer:string,label:string,reasoning:string,is_conflict:boolean,original_qa:array<string>>"


def refine(questions: DataFrame, responses: Responses) -> DataFrame:
    """v3: each character's questions rewritten together; refined questions join the originals they don't replace."""
    groups = q.character_groups(questions).where("character is not null").select("character")
    asked = q.compact_clusters(questions.withColumn("episode_index", F.col("record_idx"))).join(groups, "character", "left_semi").withColumn("_id", F.xxhash64("character"))
    prompt = F.concat(F.lit("Merge these questions of one character into harder ones, as a JSON array.\n"), "cluster")
    got = responses.answer(request(asked, "refine", F.col("_id"), F.lit(0), prompt)).select(F.col("qid").alias("_id"), "response")
    items = asked.select("character", "_id").join(got, "_id").select("character", F.posexplode(F.from_json(text.json_array(F.col("response")), f"array<{REFINED}>")).alias("i", "r"))
    numbered = global_rank(items.withColumn("_i", F.col("i").cast("double")), "_i", ["character"], "refined_idx").select("refined_idx", "r.*")
    merged = q.merge_refined(questions, numbered)
    rest = questions.select("character", "question", "record_idx", "filename", "category", "option", "answer").dropDuplicates(["character", "question"])
    new = numbered.select("character", "question", F.lit(None).cast("long").alias("record_idx"), F.lit(None).cast("string").alias("filename"), "category", "option", "answer").dropDuplicates(["character", "question"])
    details = rest.unionByName(new).dropDuplicates(["character", "question"]).withColumnRenamed("character", "_c").withColumnRenamed("question", "_q")
    return merged.join(details, F.col("character").eqNullSafe(F.col("_c")) & (F.col("question") == F.col("_q"))).drop("_c", "_q").withColumnRenamed("new_qid", "qid")


def blind(questions: DataFrame, responses: Responses, rounds: int = 10, threshold: float = 0.5) -> DataFrame:
    """v4: how often the right letter comes without any script; more than the threshold is suspected."""
    asked = questions.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    got = responses.answer(request(asked, "blind", F.col("qid"), F.col("round"), F.concat(F.lit("Answer as JSON with option.\n"), rendered())))
    letter = F.get_json_object(text.clean_json(F.col("response")), "$.option")
    scored = got.where("response is not null").join(questions.select("qid", "answer"), "qid").withColumn("score", q.round_score(F.col("answer"), letter))
    accuracy = q.blind_accuracy(scored.select("qid", "round", "response", "score"), ["qid"], threshold, listed=True)
    checked = accuracy.select("qid", F.struct("result", "correct_count", "total_count", F.format_string("%.4f", "accuracy").alias("accuracy"), "all_responses").alias("pollution_check"))
    return q.backfill(questions, checked, ["qid"])


def run(spark: SparkSession, path: str, out: str, responses: Responses, seed: str = "0", start: int = 0, end: int = 5, by_name: bool = False) -> dict[str, DataFrame]:
    """Run steps ``start`` to ``end``; each version is written under ``out`` and read again. Returns the versions made."""
    records, turns, speakers = load(spark, path, by_name)
    made: dict[str, DataFrame] = {}

    def version(name: str) -> DataFrame:
        return spark.read.parquet(f"{out}/version={name}")

    def write(name: str, df: DataFrame) -> None:
        sinks.write_version(df, out, name)
        made[name] = version(name)

    steps = [
        lambda: write("v0", shuffled(generate(records, turns, speakers, responses), f"{seed}-0")),
        lambda: write("v1", check_evidence(version("v0"), responses)),
        lambda: write("v2", label(version("v1"), turns, responses)),
        lambda: write("v3", refine(version("v2"), responses)),
        lambda: write("v4", blind(shuffled(version("v3"), f"{seed}-4"), responses)),
        lambda: write("final", version("v4")),
    ]
    for number, step in enumerate(steps):
        if start <= number <= end:
            step()
    return made


def evaluate(results: DataFrame) -> DataFrame:
    """Scored results (conv_key, question_idx, category, mcq columns) of result entries (item JSON)."""
    from ..functions import mcq

    fixed = F.when(nested.first_char(F.get_json_object("item", "$.answer_fixed")) == "[", F.from_json(F.get_json_object("item", "$.answer_fixed"), "array<string>")).otherwise(F.array(F.get_json_object("item", "$.answer_fixed")))
    fields = F.from_json("item", "category string, answer string, response string")
    parsed = results.withColumns({"_f": fields, "_fixed": fixed})
    has = F.array_contains(F.json_object_keys("item"), "category")
    scored = parsed.withColumn("r", mcq.score(F.col("_fixed"), F.col("_f.answer"), F.col("_f.response")))
    return scored.select("conv_key", "question_idx", F.when(has, F.col("_f.category")).otherwise("Unknown").alias("category"), "r.*")
