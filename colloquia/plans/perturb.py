"""Question perturbations: three variants per question, confidences from token losses, the challenge set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import questions as q
from ..operators.ranking import min_k_confidence
from ..sources.sinks import staged
from .pipeline import Responses, request

#: Instruction of each variant; back-translation is asked step by step, each from the last answer.
STEPS = {
    "para": ("Rewrite the question in other words.",),
    "bt": ("Translate into German.", "Translate into French.", "Translate into English."),
    "noise": ("Put one irrelevant sentence before the question.",),
}


def variants(qa: DataFrame, responses: Responses) -> DataFrame:
    """(qid, variant, question) of each variant; chains are a fixed number of joins."""
    out = None
    for name, steps in STEPS.items():
        now = qa.select("qid", F.col("question").alias("said"), "answer")
        for i, instruction in enumerate(steps):
            extra = F.concat(F.lit("\nAnswer: "), "answer") if name == "noise" else F.lit("")
            got = responses.answer(request(now, f"perturb_{name}", F.col("qid"), F.lit(i), F.concat(F.lit(instruction + "\n"), "said", extra)))
            got = staged(got)
            now = now.drop("said").join(got.where("response is not null").select("qid", text.strip(F.col("response")).alias("said")), "qid")
        one = now.select("qid", F.lit(name).alias("variant"), F.col("said").alias("question"))
        out = one if out is None else out.unionByName(one)
    return out


def confidences(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """(qid, variant, conf) of (qid, variant, question, answer) from token losses (qid, variant, nll array, offsets array).

    Tokens that start in the answer count, told by character offsets in the prompt; -999 without any.
    """
    joined = rows.join(tokens, ["qid", "variant"], "left")
    empty = F.array().cast("array<double>")
    conf = min_k_confidence(F.coalesce("nll", empty), F.coalesce("offsets", F.array().cast("array<int>")), text.answer_offset(F.col("question"), F.col("answer")))
    return joined.select("qid", "variant", conf.alias("conf"))


def challenge_set(qa: DataFrame, made: DataFrame, conf: DataFrame) -> DataFrame:
    """Ranked rows: id, character, category, original_question, best_question, best_type, best_gap, conf_orig.

    The text that was measured is the text that is kept.
    """
    wide = conf.groupBy("qid").pivot("variant", ["orig", *STEPS]).agg(F.first("conf"))
    named = wide.select("qid", *[F.col(v).alias(f"conf_{v}") for v in ("orig", *STEPS)])
    best = q.gaps(qa.select("qid", "character", "category", F.col("question").alias("original_question")).join(named, "qid"))
    text_of = made.select("qid", F.col("variant").alias("best_type"), F.col("question").alias("_text"))
    joined = best.join(text_of, ["qid", "best_type"], "left")
    ranked = q.challenge_rank(joined, "qid")
    return ranked.select(
        "challenge_rank", F.col("qid").alias("id"), "character", "category", "original_question", F.coalesce("_text", "original_question").alias("best_question"), "best_type", F.col("gap").alias("best_gap"), "conf_orig"
    )


def run(qa: DataFrame, responses: Responses, tokens: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    """The challenge set of qa (qid, character, category, question, answer).

    processed (qid, conf_orig, conf_para, conf_bt, conf_noise) holds questions measured before; they aren't asked again.
    """
    new = qa if processed is None else qa.join(processed.select("qid"), "qid", "left_anti")
    made = variants(new, responses)
    texts = made.unionByName(new.select("qid", F.lit("orig").alias("variant"), "question")).join(new.select("qid", "answer"), "qid")
    conf = confidences(texts, tokens)
    if processed is not None:
        old = processed.select("qid", F.explode(F.array(*[F.struct(F.lit(v).alias("variant"), F.col(f"conf_{v}").alias("conf")) for v in ("orig", *STEPS)])).alias("c")).select("qid", "c.*")
        conf = conf.unionByName(old)
    return challenge_set(qa, made, conf)


def replaced_dataset(qa: DataFrame, challenge: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(qa with best questions in the place of originals, one row: replaced, missing).

    qa: qid, question, ...; challenge as ``run`` gives it. Of equal originals the last by rank wins.
    """
    out = q.replace_by_text(qa, challenge.select("original_question", "best_question", F.col("challenge_rank").alias("pos")))
    return out, replaced_totals(out)


def replaced_totals(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if("replaced").alias("replaced"), F.count_if(~F.col("replaced")).alias("missing"))
