"""Command line: the pipeline with recorded responses, statistics, sampling, overlap, evaluation."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import VERSIONS, Config
from .operators import questions as q
from .operators import ranking
from .plans import full_context, perturb, pipeline
from .sources import nested, sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="colloquia")
    sub = top.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run pipeline steps over recorded responses")
    run.add_argument("dataset")
    run.add_argument("--responses", required=True, help="Parquet of (step, qid, round, response)")
    run.add_argument("--start", type=int, default=0)
    run.add_argument("--end", type=int, default=5)
    run.add_argument("--seed", default="0")
    run.add_argument("--by-name", action="store_true", help="take files in the order of their names, and the first record of each")
    run.add_argument("--config")
    show = sub.add_parser("show", help="print configuration and versions")
    show.add_argument("--config")
    stats = sub.add_parser("stats", help="category statistics of version files")
    stats.add_argument("--input-dir", default="temp")
    stats.add_argument("--output", default="result/category_stats")
    stats.add_argument("--output-csv", default="result/category_stats.csv")
    sample = sub.add_parser("sample", help="two questions of each category")
    sample.add_argument("--input", required=True)
    sample.add_argument("--output", default="result/random_questions.csv")
    sample.add_argument("--seed", default="0")
    sample.add_argument("--per-category", type=int, default=2)
    overlap = sub.add_parser("overlap", help="overlap curve of losses and blind rounds")
    overlap.add_argument("--input", required=True)
    overlap.add_argument("--metric", default="avg_loss")
    overlap.add_argument("--threshold", type=float, default=0.5)
    overlap.add_argument("--out-prefix", default="calibration_result")
    score = sub.add_parser("score", help="score result files and write the summary")
    score.add_argument("--input", required=True)
    score.add_argument("--output")
    score.add_argument("--summary")
    full = sub.add_parser("full-context", help="answer questions from whole conversations, score and summarize")
    full.add_argument("--input_file", required=True)
    full.add_argument("--responses", required=True, help="Parquet of (step, qid, round, response)")
    full.add_argument("--output_file")
    full.add_argument("--figure_view", action="store_true")
    gap = sub.add_parser("perturb", help="perturb questions and rank them by lost confidence")
    gap.add_argument("--input", required=True)
    gap.add_argument("--responses", required=True, help="Parquet of (step, qid, round, response)")
    gap.add_argument("--tokens", required=True, help="Parquet of token losses (qid, variant, nll, offsets)")
    gap.add_argument("--processed", help="JSON Lines of (id, conf_orig, conf_para, conf_bt, conf_noise) measured before")
    gap.add_argument("--output", default="result/final_challenge_set")
    gap.add_argument("--replaced", help="write the questions with best ones in their place here")
    return top


def version_rows(spark: SparkSession, directory: str):
    """Questions of all version files in the columns that statistics use."""
    records = nested.version_files(spark, directory)
    rows = records.select("file", "version", F.coalesce("filename", F.lit("<unknown>")).alias("script"), F.explode("qa").alias("item")).withColumn("q", F.from_json("item", nested.QA))
    late = F.transform("q.iterative_evidence_ablation", lambda r: F.struct(r["round"].alias("round"), r["result"].alias("result")))
    return rows.select("file", "version", "script", "q.*", F.col("q.only_evidence_check.result").alias("check_result"), late.alias("ablation"))


def stats(spark: SparkSession, args) -> None:
    rows = version_rows(spark, args.input_dir)
    counts = q.version_counts(rows, "category")
    scripts = [r[0] for r in counts.select("script").distinct().orderBy(F.lower("script")).limit(1001).collect()]  # columns of a report
    if len(scripts) > 1000:
        raise ValueError("more than 1000 scripts are too many columns for a report")
    sinks.write_report_csv(q.stats_pivot(counts, scripts), args.output_csv, ["version", "category"], bom=True)
    gone = q.incremental(q.excluded(rows), ["script", "question", "character"], "file")
    counts.write.mode("overwrite").json(f"{args.output}/category_counts")
    q.version_counts(rows, "label").write.mode("overwrite").json(f"{args.output}/label_counts")
    gone.select("file", "version", "script", "qid", "character", "category", "label", "question", "option", "answer", "exclusion_reason").write.mode("overwrite").json(f"{args.output}/excluded_questions")


def sample(spark: SparkSession, args) -> None:
    rows = nested.questions_of(nested.normalized(nested.records_of(nested.read_documents(spark, args.input))))
    typed = rows.withColumn("category", F.col("category").try_cast("int"))
    key = F.md5(F.concat_ws("|", F.lit(args.seed), "record_idx", "qa_idx").cast("binary"))
    picked = ranking.stratified_sample(typed, "category", list(range(1, 7)), args.per_category, key, "qa_idx")
    sinks.write_report_csv(sinks.sample_rows(picked), args.output, ["Category", "question"])


def loss_items(spark: SparkSession, path: str, metric: str, threshold: float):
    """(qid, k, loss) of loss records; of equal ids the last counts its rounds."""
    lines = nested.read_json_or_lines(spark, path)
    typed = "outer_id string, inner_id string, global_index bigint, pollution_check struct<all_responses_and_scores:array<struct<score:string>>>, all_responses_and_scores array<struct<score:string>>"
    rows = lines.select(F.from_json("value", typed).alias("r"), F.get_json_object("value", f"$.{metric}").try_cast("double").alias("loss"), F.monotonically_increasing_id().alias("pos"))
    scores = F.coalesce("r.pollution_check.all_responses_and_scores", "r.all_responses_and_scores", F.array().cast("array<struct<score:string>>"))
    qid = nested.loss_item_id(F.col("r.outer_id"), F.col("r.inner_id"), F.col("r.global_index"), F.col("pos"))
    items = rows.select(qid.alias("qid"), ranking.blind_correct(F.transform(scores, lambda s: s["score"]), threshold).alias("k"), "loss", "pos")
    return items.groupBy("qid").agg(F.max_by(F.struct("k", "loss"), "pos").alias("x")).select("qid", "x.*")


def overlap(spark: SparkSession, args) -> None:
    curve = ranking.overlap_curve(loss_items(spark, args.input, args.metric, args.threshold), "qid", "k", "loss")
    sinks.write_report_csv(curve, f"{args.out_prefix}.csv", ["x"])
    print("best threshold:", ranking.best_threshold(curve).first()["best_x"])


def score(spark: SparkSession, args) -> None:
    entries = nested.result_entries(nested.read_documents(spark, args.input), "value")
    scored = pipeline.evaluate(entries)
    scored.write.mode("overwrite").json(sinks.output_path(args.input, "_mcq_scored", args.output))
    report = sinks.metrics_report(q.metrics_summary(scored))
    with open(sinks.output_path(args.input, "_mcq_summary.log", args.summary), "w", encoding="utf-8") as f:
        f.write(report)
    print(report)


def questions_in(spark: SparkSession, path: str):
    """(records, questions) of a dataset file; questions without a qid are numbered by place."""
    records = nested.normalized(nested.records_of(nested.read_documents(spark, path)))
    questions = ranking.global_rank(nested.questions_of(records), "record_idx", ["qa_idx"], "place", start=1)
    return records, questions.withColumn("qid", F.coalesce("qid", "place")).drop("place")


def full_context_run(spark: SparkSession, args) -> None:
    """Raw results grouped by conversation as JSON Lines, and the summary as text."""
    records, questions = questions_in(spark, args.input_file)
    results = full_context.answer(questions, full_context.histories(records, args.figure_view), pipeline.Responses(spark.read.parquet(args.responses)))
    results = sinks.staged(results)
    numbered = results.withColumnsRenamed({"record_idx": "conv_idx", "qid": "question_idx"})
    path = sinks.output_path(args.input_file, "_full_context_raw", args.output_file)
    sinks.write_json(sinks.grouped_results(numbered).select(F.to_json(F.struct("conv_idx", "results")).alias("record")), path)
    report = sinks.metrics_report(full_context.summary(results))
    with open(f"{path}_mcq_summary.log", "w", encoding="utf-8") as f:
        f.write(report)
    print(report)


def perturb_run(spark: SparkSession, args) -> None:
    """The challenge set as JSON Lines by rank; with ``--replaced`` also the questions that it changes."""
    _, questions = questions_in(spark, args.input)
    qa = questions.select("qid", "character", "category", "question", "answer")
    old = spark.read.json(args.processed).withColumnRenamed("id", "qid") if args.processed else None
    made = sinks.staged(perturb.run(qa, pipeline.Responses(spark.read.parquet(args.responses)), spark.read.parquet(args.tokens), old))
    made.orderBy("challenge_rank").write.mode("overwrite").json(args.output)
    print("questions:", made.count())
    if args.replaced:
        changed, totals = perturb.replaced_dataset(questions, made)
        changed.drop("replaced").write.mode("overwrite").json(args.replaced)
        print(totals.first().asDict())


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    config = Config.load(args.config) if getattr(args, "config", None) else Config()
    if args.command == "show":
        print(config.summary(), *[f"{k}: {v}" for k, v in VERSIONS.items()], sep="\n")
        return
    spark = SparkSession.builder.appName("colloquia").getOrCreate()
    if args.command == "run":
        began = time.time()
        responses = pipeline.Responses(spark.read.parquet(args.responses))
        made = pipeline.run(spark, f"{config.pipeline.input_dir}/{args.dataset}/*.json", f"{config.pipeline.temp_dir}/{args.dataset}", responses, args.seed, args.start, args.end, args.by_name)
        print({k: v.count() for k, v in made.items()}, f"{time.time() - began:.0f} s")
    else:
        {"stats": stats, "sample": sample, "overlap": overlap, "score": score, "full-context": full_context_run, "perturb": perturb_run}[args.command](spark, args)


if __name__ == "__main__":
    main()
