"""Answers from the whole script: requests with trim levels, result rows, scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.text import image_suffix
from ..operators import questions as q
from ..operators import transcript
from ..sources import nested
from ..sources.sinks import staged
from .pipeline import Responses, request

#: Response text by which a provider says that a prompt is too long, and cuts that are tried.
OVERFLOW, TRIMS = "CONTEXT_OVERFLOW", 5


def prompt_parts(history: Column, question: Column, options: Column, trim: Column) -> dict[str, Column]:
    """history_slice, stem and options_text of a prompt whose history lost ``trim`` tenths, latest lines first."""
    lines = text.option_lines(F.coalesce(options, F.array().cast("array<string>")))
    stem = text.question_stem(question, lines)
    return {
        "history_slice": F.when(trim == 0, history).otherwise(transcript.trimmed(history, trim)),
        "stem": F.when(stem != "", stem).otherwise(text.strip(F.coalesce(question, F.lit("")))),
        "options_text": F.array_join(lines, "\n"),
    }


def histories(records: DataFrame, figure_view: bool = False) -> DataFrame:
    """(record_idx, transcript) of records (record_idx, conversation): each key but speakers and times, in its own order.

    A key whose value isn't a list of turns makes a header alone.
    """
    entries = records.select("record_idx", F.from_json("conversation", nested.MAP).alias("m"))
    keys = entries.select("record_idx", "m", F.posexplode(F.map_entries("m")).alias("key_idx", "e")).where(~F.col("e.key").isin("speaker_a", "speaker_b") & ~F.regexp_like("e.key", F.lit(r"(_date_time|_timestamp)$")))
    listed = F.when(nested.first_char(F.col("e.value")) == "[", F.from_json("e.value", "array<string>"))
    whole = F.filter(listed, lambda t: F.array_contains(F.json_object_keys(t), "speaker") & F.array_contains(F.json_object_keys(t), "text"))
    rows = keys.select("record_idx", "m", "key_idx", "e", F.posexplode_outer(whole).alias("turn_idx", "turn")).withColumn("t", F.from_json("turn", nested.TURN))
    name = lambda k: F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(k))
    typed = rows.select(
        "record_idx", "key_idx", F.try_element_at("m", F.concat("e.key", F.lit("_date_time"))).alias("session_ts"), "turn_idx", F.coalesce("t.speaker", F.lit("")).alias("speaker"),
        image_suffix(F.coalesce("t.text", F.when(F.col("turn").isNotNull(), "None")), F.col("t.img_url"), F.col("t.blip_caption"), figure_view).alias("text"), name("speaker_a").alias("speaker_a"), name("speaker_b").alias("speaker_b"),
    )
    return transcript.two_party_transcript(typed)


def requests(questions: DataFrame, histories: DataFrame, trim: int) -> DataFrame:
    """One request per question; histories (record_idx, transcript) are built once per record and joined."""
    joined = questions.join(histories, "record_idx", "left")
    parts = prompt_parts(F.coalesce("transcript", F.lit("")), F.col("question"), F.col("option"), F.lit(trim))
    prompt = F.concat_ws("\n", parts["history_slice"], F.lit("Answer with one option letter."), parts["stem"], parts["options_text"])
    return request(joined, "full_context", F.col("qid"), F.lit(trim), prompt)


def answer(questions: DataFrame, histories: DataFrame, responses: Responses, trims: int = TRIMS) -> DataFrame:
    """Result rows: question fields with defaults, response, answer_prompt, max_context_exceeded, status.

    A question whose prompt overflows is asked again with a shorter history, ``trims`` times at most: a
    bounded loop of joins. The last overflow keeps a null response and says so in ``status``.
    """
    open_, done = questions, None
    for trim in range(trims + 1):
        asked = requests(open_, histories, trim)
        got = staged(responses.answer(asked).withColumn("trim", F.lit(trim)))
        over = F.coalesce(F.col("response") == OVERFLOW, F.lit(False))
        final = got if trim == trims else got.where(~over)
        done = final if done is None else done.unionByName(final)
        open_ = open_.join(got.where(over).select("qid"), "qid", "left_semi")
    over = F.coalesce(F.col("response") == OVERFLOW, F.lit(False))
    rows = done.select(
        "qid", F.when(~over, F.col("response")).alias("response"), F.col("prompt").alias("answer_prompt"), (F.col("trim") > 0).cast("int").alias("max_context_exceeded"),
        F.when(over, "overflow").otherwise(F.col("status")).alias("status"),
    )
    fixed = F.col("answer_fixed") if "answer_fixed" in questions.columns else F.lit(None).cast("array<string>")
    kept = questions.select(
        "record_idx", "qid", F.coalesce("question", F.lit("")).alias("question"), F.coalesce("answer", F.lit("")).alias("answer"), fixed.alias("answer_fixed"),
        F.coalesce(F.col("category").cast("int"), F.lit(-1)).alias("category"), F.coalesce("option", F.array().cast("array<string>")).alias("option"), "character",
    )
    return kept.join(rows, "qid")


def score(results: DataFrame) -> DataFrame:
    from ..functions import mcq

    return results.withColumn("_r", mcq.score(F.col("answer_fixed"), F.col("answer"), F.col("response"))).select(*results.columns, "_r.*")


def summary(results: DataFrame) -> DataFrame:
    return q.metrics_summary(score(results))
