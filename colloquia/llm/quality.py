"""Quality rules, line first (native).

Each line is judged by itself (symbol-heavy, navigation, boilerplate, unfinished stub), failing
lines go, and a document that loses too large a share of its words is rejected. Document
counts (words, symbols, repeated lines, repeated word windows) form the base verdict.
Everything is one narrow projection: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words_of

#: Wording of licence, rights and consent lines.
BOILERPLATE = (
    r"(?i)(licen[sc]ed under|all rights reserved|copyright \(c\)|creative commons"
    r"|cookie policy|privacy policy|terms of (use|service)|subscribe to our|javascript is disabled)"
)
#: ``under the ... license``, from the start of a run of its characters and the run's first ``under the``, so a line is passed once.
LICENCE = r"(?i)(?<![a-z0-9 .-])(?>[a-z0-9 .-]*?under the )[a-z0-9 .-]*licen[sc]e"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    max_symbol_percent: int = 10  # of a line's non-space characters, "!" included
    max_pipe_percent: int = 20  # "|" tokens of a line's words: navigation bars
    stub_words: int = 4  # shorter lines must end like a sentence
    max_lost_percent: int = 50  # words that failing lines take with them


def repeated_words(words: Column, window: int) -> Column:
    """Words covered by windows of ``window`` words found at two or more places of the text.

    Windows are compared by 64-bit hashes within one document. Sorted (hash, position) pairs
    put equal windows side by side, so the cost is n log n for any text.
    """
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - window), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)]))

    def covered(positions: Column) -> Column:
        gaps = F.transform(positions, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(positions, i + 1), p + window) - p))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def found(pairs: Column) -> Column:
        twins = F.filter(pairs, lambda x, i: (F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"]))
        return let(F.array_sort(F.transform(twins, lambda x: x["p"])), covered)

    def ranked(hs: Column) -> Column:
        pairs = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(let(pairs, found))

    return F.when(n <= window, F.lit(0)).otherwise(let(hashes, ranked)).cast("long")


def boilerplate(line: Column) -> Column:
    """Whether a line has such wording; the licence pattern is tried only where its first words stand."""
    return F.regexp_like(line, F.lit(BOILERPLATE)) | (F.regexp_like(line, F.lit("(?i)under the ")) & F.regexp_like(line, F.lit(LICENCE)))


def line_fails(line: Column, rules: QualityRules) -> Column:
    """Whether a line with a word breaks a line rule; lines without words never fail."""
    solid = F.regexp_replace(line, r"[\x20\x09-\x0D]+", "")
    symbols = F.length(F.regexp_replace(solid, r"[^#*$%&|<>!]+", ""))
    pipes = F.length(F.regexp_replace(solid, r"[^|]+", ""))
    words = words_of(line)
    return (F.length(solid) > 0) & (
        (symbols * 100 > F.length(solid) * rules.max_symbol_percent)
        | (pipes * 100 > F.size(words) * rules.max_pipe_percent)
        | boilerplate(line)
        | ((F.size(words) < rules.stub_words) & ~F.regexp_like(line, F.lit(r"[.!?:;…。！？][\x20\x09-\x0D\"')\]»”]*$")))
    )


def judge_quality(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, counts, base_failed, cleaned text, kept.

    Null text counts as no words and fails (n_words < min_words). Empty tables give empty
    results, repeated rows give repeated results, other input columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    counted = source.select(
        "doc_id",
        "t",
        let(words_of(F.col("t")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w, rules.window).alias("n_repeat_words"),
        )).alias("s"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(F.split("t", "\n", -1), lambda lines: let(
            F.filter(lines, lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))),
            lambda full: F.struct(
                (F.size(full) - F.size(F.array_distinct(full))).cast("long").alias("n_dup_lines"),
                F.filter(lines, lambda x: ~line_fails(x, rules)).alias("kept_lines"),
            ),
        )).alias("l"),
    )
    failed = (F.col("n_words") < rules.min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent)
    flat = counted.select(
        "doc_id",
        "s.n_words",
        "s.word_chars",
        "n_symbols",
        "l.n_dup_lines",
        "s.n_repeat_words",
        F.array_join("l.kept_lines", "\n").alias("clean_text"),
    ).withColumn("base_failed", failed)
    left = F.size(words_of(F.col("clean_text")))
    return flat.withColumn("n_clean_words", left.cast("long")).withColumn(
        "kept", ~F.col("base_failed") & ((F.col("n_words") - F.col("n_clean_words")) * 100 <= F.col("n_words") * rules.max_lost_percent)
    )
