"""Question items: option shuffle, sufficiency, blind accuracy, refinement merge, version statistics, perturbations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CANNOT_INFER, INSTRUCTION, core_stem, map_label, option_letter, perplexity, strip, strip_letter_prefix
from ..sources.sinks import staged
from .ranking import global_rank, mean_loss, min_k_loss


def is_fallback(option: Column) -> Column:
    return F.startswith(strip(option), F.lit("F.")) | F.startswith(strip(option), F.lit("F．"))


def shuffle_options(qa: DataFrame, seed: str, qid: str = "qid") -> DataFrame:
    """Shuffle option bodies A to E by a seeded hash; F stays last and is added where missing.

    Adds stem, new_option, new_answer and rendered_question; options beyond five bodies are dropped, as
    ``dropped_options`` says. qa: qid, question, option array, answer.
    """
    options = F.transform(F.coalesce("option", F.array().cast("array<string>")), lambda o: strip(F.coalesce(o, F.lit(""))))
    answer = strip(F.coalesce("answer", F.lit("")))
    parted = qa.select(
        "*",
        F.filter(options, lambda o: ~is_fallback(o)).alias("_ae"),
        F.get(F.reverse(F.filter(options, is_fallback)), F.lit(0)).alias("_f"),
        answer.alias("_answer"),
        core_stem(F.col("question")).alias("stem"),
    )
    letter_at = F.ascii(F.upper("_answer")) - 65
    by_letter = strip_letter_prefix(F.get(F.col("_ae"), letter_at))
    is_letter = F.regexp_like("_answer", F.lit(r"^[A-Za-z]$"))
    body = F.when(is_letter, F.when(letter_at < F.size("_ae"), by_letter).otherwise(F.col("_answer"))).otherwise(strip_letter_prefix(F.col("_answer")))
    keyed = F.transform("_ae", lambda o, i: F.struct(F.md5(F.concat_ws("|", F.lit(seed), F.col(qid).cast("string"), i.cast("string")).cast("binary")).alias("key"), i.alias("i"), strip_letter_prefix(o).alias("body")))
    mixed = F.slice(F.array_sort(keyed), F.lit(1), F.lit(5))
    lettered = F.transform(mixed, lambda o, i: F.concat(F.chr(F.lit(65) + i), F.lit(". "), o["body"]))
    out = parted.select("*", body.alias("_body"), F.transform(mixed, lambda o: o["body"]).alias("_bodies"), lettered.alias("_lettered"))
    at = F.array_position("_bodies", F.col("_body"))
    found = F.when(at > 0, F.get("_lettered", (at - 1).cast("int")))
    right = F.when(F.col("_f").isNotNull() & F.startswith("_answer", F.lit("F")), F.col("_f")).otherwise(F.coalesce(found, "_answer"))
    listed = F.concat("_lettered", F.array(F.coalesce("_f", F.lit(CANNOT_INFER))))
    done = out.select("*", listed.alias("new_option"), right.alias("new_answer"), F.greatest(F.size("_ae") - 5, F.lit(0)).alias("dropped_options"))
    rendered = F.concat_ws("\n", "stem", F.array_join("new_option", "\n"), F.lit(INSTRUCTION))
    return done.withColumn("rendered_question", rendered).drop("_ae", "_f", "_answer", "_body", "_bodies", "_lettered")


def sufficient(check_result: Column, ablation: Column) -> Column:
    """Keeps a question: evidence alone answers it, and no fifth ablation round does. A missing check fails."""
    late = F.exists(F.coalesce(ablation, F.array().cast("array<struct<round:int,result:string>>")), lambda r: (r["round"] == 5) & (r["result"] == "right"))
    return (F.coalesce(check_result, F.lit("")) == "right") & ~late


def included(version: Column, check_result: Column, ablation: Column) -> Column:
    """Whether statistics of a version count a question: checks from v1 on, ablation from v2 on."""
    late = F.exists(F.coalesce(ablation, F.array().cast("array<struct<round:int,result:string>>")), lambda r: (r["round"] == 5) & (r["result"] == "right"))
    checked = version.isin("v1", "v2", "v3", "v4")
    return ~(checked & (F.coalesce(check_result, F.lit("")) != "right")) & ~(version.isin("v2", "v3", "v4") & late)


#: Reasons of an exclusion.
CHECK_REASON, ABLATION_REASON = "only_evidence_check.result=", "iterative_evidence_ablation round=5 result=right"


def exclusion_reason(version: Column, check_result: Column) -> Column:
    bad = version.isin("v1", "v2", "v3", "v4") & (F.coalesce(check_result, F.lit("")) != "right")
    return F.when(bad, F.concat(F.lit(CHECK_REASON), F.coalesce(check_result, F.lit("N/A")))).otherwise(ABLATION_REASON)


def verdict(answer: Column, response: Column) -> Column:
    """right where both name the same option letter, else maybe_wrong."""
    return F.when(option_letter(answer).isNotNull() & (option_letter(answer) == option_letter(response)), "right").otherwise("maybe_wrong")


def ablation_rounds(rounds: DataFrame, last: int = 5) -> DataFrame:
    """Recorded rounds that a live run would have reached: up to the first that is wrong or names no evidence.

    rounds: qid, round, answer, response, n_used. Adds result.
    """
    result = F.when(option_letter(F.col("answer")).isNotNull() & (option_letter(F.col("answer")) == option_letter(F.col("response"))), "right").otherwise("wrong")
    judged = rounds.where(F.col("round").between(1, last)).withColumn("result", result)
    stop = F.when((F.col("result") == "wrong") | (F.coalesce("n_used", F.lit(0)) == 0), F.col("round"))
    before = Window.partitionBy("qid").orderBy("round").rowsBetween(Window.unboundedPreceding, -1)
    return judged.withColumn("_stop", F.min(stop).over(before)).where("_stop is null").drop("_stop")


def round_score(answer: Column, response_option: Column) -> Column:
    return F.when(F.coalesce(option_letter(answer) == response_option, F.lit(False)), 1).otherwise(0)


def blind_accuracy(responses: DataFrame, keys: list[str], threshold: float = 0.5, listed: bool = False) -> DataFrame:
    """Per question over all rounds: correct_count, total_count, accuracy, result (suspected above the threshold).

    responses: keys, score and, where ``listed``, round and response. Counts combine before the shuffle.
    """
    aggs = [F.count_if(F.col("score") == 1).alias("correct_count"), F.count("*").alias("total_count")]
    if listed:
        aggs.append(F.array_sort(F.collect_list(F.struct("round", "response", "score"))).alias("all_responses"))
    out = responses.groupBy(*keys).agg(*aggs).withColumn("accuracy", F.col("correct_count") / F.col("total_count"))
    return out.withColumn("result", F.when(F.col("accuracy") > threshold, "suspected").otherwise("good"))


def backfill(qa: DataFrame, accuracy: DataFrame, keys: list[str]) -> DataFrame:
    return qa.join(accuracy, keys, "left")


#: Characters at a removed text's start that it and a question which contains it are joined on.
HEAD = 12


def _heads(text: Column, lengths: list[int]) -> Column:
    """Hashes of all pieces of ``text`` with one of the lengths."""
    pieces = lambda n: F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.xxhash64(F.substr(text, i, F.lit(n))))
    return F.array_distinct(F.flatten(F.array(*[F.when(F.length(text) >= n, pieces(n)).otherwise(F.array().cast("array<bigint>")) for n in lengths])))


def remove_replaced(qa: DataFrame, removed: DataFrame, broadcast_rows: int = 10_000) -> DataFrame:
    """Questions that contain none of the removed texts (removed: q_text); a null question contains none.

    Whether a row goes depends on its question alone, so rows are told apart by that and copies go
    together. Texts and questions meet on a hash of the text's first ``HEAD`` characters (all of a
    shorter text), which each containing question also holds; up to ``broadcast_rows`` texts are
    broadcast, more are joined by a shuffle of hashes.
    """
    texts = removed.where(F.col("q_text").isNotNull() & (F.col("q_text") != "")).select("q_text").distinct()
    keyed = texts.withColumn("_n", F.least(F.length("q_text"), F.lit(HEAD)))
    counts = {r["_n"]: r["count"] for r in keyed.groupBy("_n").count().collect()}  # HEAD rows at most
    if not counts:
        return qa
    keyed = keyed.select("q_text", F.xxhash64(F.substr("q_text", F.lit(1), F.col("_n"))).alias("_head"))
    asked = qa.where(F.col("question").isNotNull()).select(F.col("question").alias("_asked")).distinct()
    if sum(counts.values()) <= broadcast_rows:
        pairs = asked.withColumn("_head", F.explode(_heads(F.col("_asked"), sorted(counts)))).join(F.broadcast(keyed), "_head")
    else:
        places = asked.select(F.xxhash64("_asked").alias("_h"), F.explode(_heads(F.col("_asked"), sorted(counts))).alias("_head"))
        pairs = places.join(keyed, "_head").select("_h", "q_text").join(asked.withColumn("_h", F.xxhash64("_asked")), "_h")
    gone = pairs.where(F.contains(F.col("_asked"), F.col("q_text"))).select("_asked").distinct()
    return qa.join(gone, qa["question"] == gone["_asked"], "left_anti")


def merge_refined(originals: DataFrame, refined: DataFrame) -> DataFrame:
    """Originals that stay and refined questions, with new qids from 1: originals first.

    Questions that speak of a ``session`` go on both sides; originals that refined memory updates replace go;
    labels of refined questions are mapped. originals: qid, character, question, label; refined also
    refined_idx and original_qa.
    """
    new = refined.where(~F.contains(F.coalesce("question", F.lit("")), F.lit("session")))
    gone = new.where("label = 'memory_update'").select(F.explode("original_qa").alias("q_text"))
    kept = remove_replaced(originals.where(~F.contains(F.coalesce("question", F.lit("")), F.lit("session"))), gone)
    both = kept.select(F.lit(0).alias("_part"), F.col("qid").alias("_order"), "character", "question", "label").unionByName(
        new.select(F.lit(1).alias("_part"), F.col("refined_idx").alias("_order"), "character", "question", map_label(F.col("label")).alias("label"))
    )
    both = staged(both)  # ranks take several passes
    sizes = both.groupBy("_part").count().collect()
    first = {r["_part"]: r["count"] for r in sizes}.get(0, 0)
    ranked = [global_rank(both.where(F.col("_part") == p), "_order", ["question"], "new_qid", start=1 + first * p) for p in (0, 1)]
    return ranked[0].unionByName(ranked[1]).drop("_part", "_order")


def assign_missing_qids(qa: DataFrame, order: list[str]) -> DataFrame:
    """Ids 1, 2, ... for rows without one, by ``order``; those that have one keep it."""
    numbered = global_rank(qa.where("qid is null"), order[0], order[1:], "_new", start=1)
    return qa.where("qid is not null").unionByName(numbered.withColumn("qid", F.col("_new")).drop("_new").select(*qa.columns))


def character_groups(qa: DataFrame, least: int = 2) -> DataFrame:
    """(character, n, category_counts) of characters with enough questions; Unknown is skipped, null is one of its own."""
    counts = [F.count_if(F.col("category").cast("string").try_cast("int") == i).alias(f"c{i}") for i in range(1, 7)]
    groups = qa.where(F.coalesce("character", F.lit("")) != "Unknown").groupBy("character").agg(F.count("*").alias("n"), *counts).where(F.col("n") >= least)
    return groups.select("character", "n", category_text([F.col(f"c{i}") for i in range(1, 7)]).alias("category_counts"))


def category_text(counts: list[Column]) -> Column:
    """``1:n 2:n ...`` for categories 1 to 6, zeros included."""
    return F.concat_ws(" ", *[F.concat(F.lit(f"{i}:"), F.coalesce(c, F.lit(0)).cast("string")) for i, c in enumerate(counts, 1)])


def compact_clusters(qa: DataFrame) -> DataFrame:
    """(character, cluster): each character's questions as JSON by episode, for a refinement prompt."""
    row = F.struct("episode_index", "qid", F.to_json(F.struct("qid", "episode_index", "character", "question", "option", "answer"), {"ignoreNullFields": "false"}).alias("json"))
    gathered = qa.groupBy("character").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return gathered.select("character", F.concat(F.lit("["), F.array_join(F.transform("rows", lambda r: r["json"]), ", "), F.lit("]")).alias("cluster"))


def version_counts(rows: DataFrame, by: str) -> DataFrame:
    """(version, script, ``by``, n) of included rows; null and empty values aren't counted."""
    kept = rows.where(included(F.col("version"), F.col("check_result"), F.col("ablation")))
    return kept.where(F.col(by).isNotNull() & (F.col(by).cast("string") != "")).groupBy("version", "script", F.col(by).cast("string").alias(by)).agg(F.count("*").alias("n"))


def excluded(rows: DataFrame) -> DataFrame:
    """Rows that statistics leave out, with exclusion_reason."""
    out = rows.where(~included(F.col("version"), F.col("check_result"), F.col("ablation")))
    return out.withColumn("exclusion_reason", exclusion_reason(F.col("version"), F.col("check_result")))


def incremental(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows whose key no earlier file has; copies within a file stay. First places are aggregated before the join."""
    first = rows.groupBy(*keys).agg(F.min(order).alias("_first"))
    same = None
    for c in keys:
        one = rows[c].eqNullSafe(first[c])
        same = one if same is None else same & one
    return rows.join(first, same & (rows[order] == first["_first"]), "left_semi")


def stats_pivot(counts: DataFrame, scripts: list[str]) -> DataFrame:
    """(version, category, a column per script, sum): zero where the version has the script, blank where it hasn't."""
    have = counts.groupBy("version").agg(F.collect_set("script").alias("_have"))
    wide = counts.groupBy("version", "category").pivot("script", scripts).agg(F.sum("n"))
    cells = [F.when(F.array_contains("_have", s), F.coalesce(F.col(f"`{s}`"), F.lit(0))).alias(s) for s in scripts]
    total = sum((F.coalesce(F.col(f"`{s}`"), F.lit(0)) for s in scripts), F.lit(0))
    return wide.join(have, "version").select("version", "category", *cells, total.cast("long").alias("sum"))


VARIANTS = ("para", "bt", "noise")


def gaps(rows: DataFrame) -> DataFrame:
    """Add gap_para, gap_bt, gap_noise, gap and best_type; a missing gap loses, ties go to the first variant."""
    out = rows.withColumns({f"gap_{v}": F.col("conf_orig") - F.col(f"conf_{v}") for v in VARIANTS})
    ranked = F.array(*[F.struct(F.coalesce(f"gap_{v}", F.lit(-1e9)).alias("g"), F.lit(-i).alias("o"), F.lit(v).alias("v")) for i, v in enumerate(VARIANTS)])
    return out.withColumns({"gap": F.greatest(*[f"gap_{v}" for v in VARIANTS]), "best_type": F.array_max(ranked)["v"]})


def challenge_rank(rows: DataFrame, pos: str) -> DataFrame:
    """Add ``challenge_rank`` from 1: largest gap first, rows without one last."""
    return global_rank(rows.withColumn("_neg", -F.col("gap")), "_neg", [pos], "challenge_rank", start=1).drop("_neg")


def replace_by_text(qa: DataFrame, best: DataFrame) -> DataFrame:
    """Questions replaced where their stripped text is an original's; the last of equal originals wins.

    best: original_question, best_question, pos. Adds ``replaced``.
    """
    latest = best.groupBy(strip(F.col("original_question")).alias("_text")).agg(F.max_by("best_question", "pos").alias("_best"))
    joined = qa.withColumn("_text", strip(F.col("question"))).join(latest, "_text", "left")
    return joined.withColumns({"replaced": F.col("_best").isNotNull(), "question": F.coalesce("_best", "question")}).drop("_text", "_best")


def loss_columns(rows: DataFrame, nll: str = "nll") -> DataFrame:
    return rows.withColumns({"avg_loss": mean_loss(F.col(nll)), "mink_loss": min_k_loss(F.col(nll)), "answer_len": F.size(nll)}).withColumn("ppl", perplexity(F.col("avg_loss")))


def metrics_summary(scored: DataFrame) -> DataFrame:
    """(category, n, mcq) by category and ALL, the micro average; a null category is None."""
    by = scored.select(F.coalesce(F.col("category").cast("string"), F.lit("None")).alias("category"), "mcq_score")
    both = by.rollup("category").agg(F.count("*").alias("n"), F.avg("mcq_score").alias("mcq"), F.grouping("category").alias("g")).where("n > 0")
    return both.select(F.when(F.col("g") == 1, "ALL").otherwise(F.col("category")).alias("category"), "n", "mcq")
