"""A corpus pipeline: language ID, near duplicates, decontamination, PII, tokens.

Each stage takes (spark, docs, sf_dir) and works on every row that its predecessor kept; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquia.llm import bpe, decontaminate, language, neardup, pii, queries
from colloquia.llm.common import fresh, table, written

#: A document of which no learned language contains this part of the n-grams is in none of them.
LEAST_LANGUAGE_SHARE = 0.2

#: Near copies share 80 % of their shingles of five words.
NEAR_COPY = neardup.JaccardParams(shingle=5, percent=80)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in none of the learned languages, go."""
    found = [fresh(docs, name) for name in ("lang_pred", "score", "share")]
    judged = language.identify(docs, queries.language_model(docs), "text", *found)
    return judged.where((F.col(found[0]) != language.UNKNOWN) & (F.col(found[2]) >= LEAST_LANGUAGE_SHARE)).drop(*found)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of smallest id and text hash stays; documents without words stay.

    Rows that share id and text are one document listed more than once, and one row stays.
    """
    linked = neardup.link_rows(docs.select("doc_id", "text"), NEAR_COPY)
    key, mark = fresh(docs, "k"), fresh(docs, "text_hash")
    first = linked.where(F.col("root") == F.struct("k", "a")).select(F.col("k").alias(key), F.col("a").alias(mark)).distinct()
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), mark: F.xxhash64(F.coalesce("text", F.lit("")))})
    return keyed.join(first, [key, mark], "left_semi").dropDuplicates([key, mark]).drop(key, mark)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.drop_leaks(docs, leaks)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in their texts is put as its kind in brackets."""
    spans, redacted = fresh(docs, "spans"), fresh(docs, "redacted")
    clean = pii.find_pii(docs, pii.train(), "text", spans, redacted)
    text = F.when(F.col("text").isNotNull(), F.col(redacted))
    new = {"text": text, "n_chars": F.coalesce(F.length(text), F.lit(0)).cast("long")}
    return clean.withColumns({c: new[c] for c in new if c in docs.columns}).drop(spans, redacted)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, instead of its text; columns named ``ids`` and ``n_tokens`` are the stage's own."""
    encoded = bpe.encode_texts(docs, *queries.tokenizer())
    return encoded.drop("text").withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("tokens", token_stage),
]

#: No stage but the joins can be put in SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
