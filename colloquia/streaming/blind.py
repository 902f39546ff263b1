"""Streaming forms: running blind accuracy, and incremental results written exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.questions import round_score
from ..sources.sinks import shared_folder

ROUNDS = 10


def running_accuracy(responses: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Stateful counts per question over a stream of (qid, answer, response_option)."""
    scored = responses.withColumn("score", round_score(F.col("answer"), F.col("response_option")))
    counts = scored.groupBy("qid").agg(F.count_if(F.col("score") == 1).alias("correct_count"), F.count("*").alias("total_count"))
    accuracy = F.col("correct_count") / F.col("total_count")
    return counts.withColumns({"accuracy": accuracy, "result": F.when(accuracy > threshold, "suspected").otherwise("good")})


def append_results(batch: DataFrame, batch_id: int, path: str) -> None:
    """foreachBatch sink: a batch replaces its own folder, so a replayed batch leaves one copy."""
    batch.dropDuplicates(["qid", "round"]).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")


def write_changes(batch: DataFrame, batch_id: int, path: str) -> None:
    """foreachBatch sink of updates: the questions that a batch changed, in a folder of its own."""
    batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")


def latest(changes: DataFrame) -> DataFrame:
    """The last row of each question (qid) over the batches that changed it."""
    rest = [c for c in changes.columns if c not in ("qid", "batch")]
    return changes.groupBy("qid").agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select("qid", *[F.col(f"_r.{c}").alias(c) for c in rest])


def run_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drain the conversation files as a stream, and return the table of running accuracies.

    State stays on the executors, changes go to a table in the shared folder, and nothing is gathered.
    """
    source = f"{sf_dir}/conversations.parquet"
    schema = spark.read.parquet(source).schema
    # A source of one file is listed by its folder and name; a folder by its parts.
    alone = spark.read.parquet(source).inputFiles()[0].endswith("/conversations.parquet")
    path, options = (sf_dir, {"pathGlobFilter": "conversations.parquet"}) if alone else (source, {})
    turns = spark.readStream.schema(schema).options(**options).parquet(path)
    rounds = turns.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(ROUNDS))))
    at = (F.col("conv_id") + F.col("turn") * ((F.col("round") * F.col("turn")) % 3 + 1)) % 6
    pick = lambda p: F.substr(F.lit("ABCDEF"), p.cast("int") + 1, F.lit(1))
    answers = rounds.select((F.col("conv_id") * 100 + F.col("turn")).alias("qid"), pick((F.col("conv_id") + F.col("turn")) % 6).alias("answer"), pick(at).alias("response_option"))
    counted, out = running_accuracy(answers), shared_folder(spark)
    sink = counted.writeStream.outputMode("update").foreachBatch(lambda batch, i: write_changes(batch, i, f"{out}/changes"))
    sink.option("checkpointLocation", f"{out}/progress").trigger(availableNow=True).start().awaitTermination()
    changes = spark.read.schema(counted.schema.add("batch", "integer")).option("basePath", f"{out}/changes").parquet(f"{out}/changes/batch=*")
    return latest(changes)
