"""Outputs: nested JSON, CSV with a byte-order mark, text reports, version tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEEP_NULLS = {"ignoreNullFields": "false"}


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path under spark.checkpoint.dir.

    Where that isn't set, a local session (tests) takes a temporary folder; a cluster raises, for
    its executors share no local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="colloquia-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/colloquia/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it again."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_version(df: DataFrame, path: str, version: str) -> None:
    """One version of a table, replaced as a whole, beside the others."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={version}")


def read_versions(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def nested_records(questions: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    """(keys, record): each group's questions as a JSON array under ``qa``, in order, nulls kept."""
    item = F.struct(order, F.to_json(F.struct(*fields), KEEP_NULLS).alias("json"))
    grouped = questions.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"))
    body = F.concat(F.lit('{"qa": ['), F.array_join(F.transform("items", lambda x: x["json"]), ", "), F.lit("]}"))
    return grouped.select(*keys, body.alias("record"))


def grouped_results(results: DataFrame) -> DataFrame:
    """(conv_idx, results): result rows of each conversation as one ordered JSON array."""
    rows = [c for c in results.columns if c not in ("conv_idx", "question_idx")]
    item = F.struct("question_idx", F.to_json(F.struct(*rows), KEEP_NULLS).alias("json"))
    grouped = results.groupBy("conv_idx").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return grouped.select("conv_idx", F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["json"]), ", "), F.lit("]")).alias("results"))


def complete_conversations(results: DataFrame, questions: DataFrame) -> DataFrame:
    """Add ``done`` to (conv_idx, n_results, n_questions): whether a conversation has a result for each question.

    Both sides are counts per conversation before they are joined; conversations without results stay.
    """
    have = results.groupBy("conv_idx").agg(F.count("*").alias("n_results"))
    want = questions.groupBy("conv_idx").agg(F.count("*").alias("n_questions"))
    both = want.join(have, "conv_idx", "left").withColumn("n_results", F.coalesce("n_results", F.lit(0)))
    return both.select("conv_idx", "n_results", "n_questions", (F.col("n_results") >= F.col("n_questions")).alias("done"))


def finalize_results(batches: DataFrame, questions: DataFrame, path: str) -> None:
    """Group the results of complete conversations and replace the table at ``path``, by the writer's own commit."""
    done = complete_conversations(batches, questions).where("done").select("conv_idx")
    grouped_results(batches.join(done, "conv_idx", "left_semi")).write.mode("overwrite").parquet(path)


def write_json(records: DataFrame, path: str, column: str = "record") -> None:
    """One JSON record per line, in parallel part files."""
    records.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def ascii_json(c: Column) -> Column:
    """JSON text with every character beyond ASCII escaped."""
    units = F.transform(F.split(c, ""), lambda ch: F.when(F.octet_length(ch) == 1, ch).otherwise(F.concat_ws("", F.transform(F.sequence(F.lit(0), (F.length(F.hex(F.encode(ch, "utf-16be"))) / 4 - 1).cast("int")), lambda i: F.concat(F.lit("\\u"), F.lower(F.substr(F.hex(F.encode(ch, "utf-16be")), (i * 4 + 1).cast("int"), F.lit(4))))))))
    return F.array_join(units, "")


def sample_rows(picked: DataFrame) -> DataFrame:
    """The six columns of the review export."""
    cell = lambda name: F.coalesce(ascii_json(F.to_json(name)), F.lit("[]"))
    return picked.select(
        F.concat(F.lit("类别"), F.col("category").cast("string")).alias("Category"), F.coalesce("question", F.lit("")).alias("question"), cell("option").alias("option"),
        F.coalesce("answer", F.lit("")).alias("answer"), cell("evidence_dialogues").alias("evidence_dialogues"), cell("reasoning_steps").alias("reasoning_steps"),
    )


def write_report_csv(rows: DataFrame, path: str, order: list[str], bom: bool = False, max_rows: int = 100_000) -> None:
    """A small report as one local CSV file, by the driver; raises where it isn't small."""
    import csv

    got = rows.orderBy(*order).limit(max_rows + 1).collect()
    if len(got) > max_rows:
        raise ValueError(f"a report has {max_rows} rows at most; write a table instead")
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(rows.columns)
        writer.writerows(["" if v is None else v for v in r] for r in got)


#: Title, empty text, column header and row of the metrics report.
REPORT_TITLE, REPORT_EMPTY = "   FULL CONTEXT MCQ SUMMARY", "No results to summarize."
REPORT_HEAD, REPORT_ROW = f"{'Category':<10} | {'Count':<6} | {'MCQ':<8}", "{:<10} | {:<6} | {:<8.4f}"


def metrics_report(summary: DataFrame) -> str:
    """The fixed-width text of metrics_summary: categories in mixed order, then ALL."""
    rows = {r["category"]: (r["n"], r["mcq"]) for r in summary.collect()}  # one row per category
    line = "=" * 40
    out = ["", line, REPORT_TITLE, line]
    if not rows.get("ALL", (0,))[0]:
        return "\n".join([*out, REPORT_EMPTY, ""])
    key = lambda c: (0, int(c), "") if c.lstrip("-").isdigit() else (1, 0, c)
    body = [REPORT_ROW.format(c, *rows[c]) for c in [*sorted((c for c in rows if c != "ALL"), key=key), "ALL"]]
    rule = "-" * len(REPORT_HEAD)
    return "\n".join([*out, REPORT_HEAD, rule, *body[:-1], rule, body[-1], line, ""])


def output_path(source: str, suffix: str, given: str | None = None) -> str:
    """The given path, or ``result/`` with the input's stem and the suffix."""
    return given or os.path.join("result", os.path.splitext(os.path.basename(source))[0] + suffix)
