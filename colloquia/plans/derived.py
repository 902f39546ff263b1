"""Question items, rounds, losses and versions derived from ``conversations`` by integer arithmetic.

Each table has a Spark form and the same as SQL, so both engines see equal inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 10

QA_SQL = """qa AS (SELECT conv_id, turn, conv_id * 100 + turn AS qid, CAST((conv_id + turn) % 6 + 1 AS INTEGER) AS category,
 role AS character, text AS question, substr('ABCDEF', CAST((conv_id + turn) % 6 AS INTEGER) + 1, 1) AS answer FROM conversations)"""

RESPONSES_SQL = f"""{QA_SQL}, responses AS (SELECT qa.*, CAST(r.round AS INTEGER) AS round,
 substr('ABCDEF', CAST((conv_id + turn * ((r.round * turn) % 3 + 1)) % 6 AS INTEGER) + 1, 1) AS response_option
 FROM qa, range(1, 11) AS r(round))"""

OPTIONS_SQL = f"""{QA_SQL}, items AS (SELECT *, list_transform(range(0, CAST(3 + qid % 4 AS INTEGER)),
 lambda i: substr('ABCDEFG', CAST(i AS INTEGER) + 1, 1) || '. body ' || CAST((qid * 7 + i * 13) % 97 AS VARCHAR)) AS bodies FROM qa)"""

TURNS_SQL = """turns AS (SELECT conv_id AS record_idx, CAST(turn // 3 + 1 AS INTEGER) AS session_no,
 CASE WHEN (turn // 3) % 2 = 0 THEN 'Day ' || CAST(turn // 3 AS VARCHAR) END AS session_ts, turn AS turn_idx, role AS speaker, text,
 'D' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS dia_id FROM conversations)"""

LOSSES_SQL = f"""{QA_SQL}, losses AS (SELECT qid, conv_id, turn, CAST((conv_id * 13 + turn * 29) % 97 AS DOUBLE) / 10 AS loss,
 CAST((conv_id * 7 + turn * 3) % 11 AS INTEGER) AS k FROM qa)"""

VERSIONS_SQL = f"""{QA_SQL}, versions AS (SELECT qa.*, 'v' || CAST(v.v AS VARCHAR) AS version, 'script' || CAST(conv_id % 3 AS VARCHAR) AS script,
 CASE (qid + v.v) % 5 WHEN 0 THEN 'maybe_wrong' WHEN 1 THEN NULL ELSE 'right' END AS check_result, (qid * 3 + v.v) % 7 = 0 AS late_right,
 CASE WHEN qid % 4 = 0 THEN NULL WHEN qid % 4 = 1 THEN '' ELSE 'label' || CAST(qid % 3 AS VARCHAR) END AS label
 FROM qa, range(0, 5) AS v(v) WHERE (qid + v.v) % 11 <> 0)"""


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def letter(position: Column) -> Column:
    return F.substr(F.lit("ABCDEF"), position.cast("int") + 1, F.lit(1))


def qa_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = (F.col("conv_id") + F.col("turn")) % 6
    return conversations(spark, sf_dir).select(
        "conv_id", "turn", (F.col("conv_id") * 100 + F.col("turn")).alias("qid"), (at + 1).cast("int").alias("category"),
        F.col("role").alias("character"), F.col("text").alias("question"), letter(at).alias("answer"),
    )


def blind_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each question in each of the rounds: the rounds are a fixed short list, so rows grow by a constant."""
    rounds = qa_items(spark, sf_dir).withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(ROUNDS))))
    at = (F.col("conv_id") + F.col("turn") * ((F.col("round") * F.col("turn")) % 3 + 1)) % 6
    return rounds.withColumn("response_option", letter(at))


def option_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three to six lettered options per question, two of which may have equal bodies."""

    def one(i):
        return F.concat(F.substr(F.lit("ABCDEFG"), i + 1, F.lit(1)), F.lit(". body "), ((F.col("qid") * 7 + i * 13) % 97).cast("string"))

    return qa_items(spark, sf_dir).withColumn("bodies", F.transform(F.sequence(F.lit(0), (F.col("qid") % 4 + 2).cast("int")), one))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.floor(F.col("turn") / 3)
    return conversations(spark, sf_dir).select(
        F.col("conv_id").alias("record_idx"), (third + 1).cast("int").alias("session_no"), F.when(third % 2 == 0, F.concat(F.lit("Day "), third.cast("string"))).alias("session_ts"),
        F.col("turn").alias("turn_idx"), F.col("role").alias("speaker"), "text", F.concat(F.lit("D"), F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("dia_id"),
        F.lit(None).cast("string").alias("img_url"), F.lit(None).cast("string").alias("blip_caption"),
    )


def losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_items(spark, sf_dir).select(
        "qid", "conv_id", "turn", (((F.col("conv_id") * 13 + F.col("turn") * 29) % 97).cast("double") / 10).alias("loss"), ((F.col("conv_id") * 7 + F.col("turn") * 3) % 11).cast("int").alias("k")
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = qa_items(spark, sf_dir).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(4)))).where((F.col("qid") + F.col("v")) % 11 != 0)
    case = (F.col("qid") + F.col("v")) % 5
    late = F.when((F.col("qid") * 3 + F.col("v")) % 7 == 0, F.lit("right")).otherwise(F.lit("wrong"))
    return rows.select(
        *[c for c in rows.columns if c != "v"], F.concat(F.lit("v"), F.col("v").cast("string")).alias("version"), F.concat(F.lit("script"), (F.col("conv_id") % 3).cast("string")).alias("script"),
        F.when(case == 0, "maybe_wrong").when(case != 1, "right").alias("check_result"), F.array(F.struct(F.lit(1).alias("round"), F.lit("right").alias("result")), F.struct(F.lit(5).alias("round"), late.alias("result"))).alias("ablation"),
        F.when(F.col("qid") % 4 == 0, None).when(F.col("qid") % 4 == 1, "").otherwise(F.concat(F.lit("label"), (F.col("qid") % 3).cast("string"))).alias("label"),
    )
