"""Multiple-choice scoring as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, strip, strip_prediction

#: Patterns of the answer rules, in the order in which they are tried; the first two stand for a whole text.
ONLY_LETTERS = r"[A-Fa-f]{1,5}"
ONE_LETTER = r"[\[(]?\s*[A-Fa-f]\s*[\])]?"
TWO_ROUND = r"\([A-Fa-f]\)\([A-Fa-f]\)"
TWO_SQUARE = r"\[[A-Fa-f]\]\[[A-Fa-f]\]"
LEADING = r"^(?:option\s*)?([A-Fa-f])(?:[\s\)\]\.:,-]|$)"
PHRASE = r"(?:answer|final answer|correct answer|choose|pick|option)\s*(?:is|:)?\s*[\[(]?([A-Fa-f])[\])]?"
TOKEN = r"\(([A-Fa-f])\)|\[([A-Fa-f])\]|(?:option\s+)([A-Fa-f])\b"
KEY_LEADING = r"^([A-Fa-f])(?:[\s\)\]\.:,-]|$)"

#: White space, word ends and letter case are those of Unicode.
WIDE, ANY_CASE = "(?U)", "(?iU)"


def letters(c: Column) -> Column:
    """Sorted distinct letters of a text, in upper case."""
    return F.array_sort(F.array_distinct(F.split(F.upper(c), "")))


def none() -> Column:
    return F.array().cast("array<string>")


def holds(text: Column, pattern: str, flags: str = WIDE) -> Column:
    return F.regexp_like(text, F.lit(flags + pattern))


def whole(text: Column, pattern: str) -> Column:
    return holds(text, f"^(?:{pattern})$")


def first(text: Column, pattern: str) -> Column:
    """The letter that the pattern's group names, in upper case."""
    return F.array(F.upper(F.regexp_extract(text, ANY_CASE + pattern, 1)))


def is_malformed(compact: Column) -> Column:
    """Two bracketed letters side by side, where no earlier rule holds."""
    return ~(whole(compact, ONLY_LETTERS) | whole(compact, ONE_LETTER)) & (holds(compact, TWO_ROUND) | holds(compact, TWO_SQUARE))


def parse_compact(compact: Column) -> Column:
    """Letters that a stripped response names; the first rule that holds decides."""
    tokens = F.transform(F.regexp_extract_all(compact, F.lit(ANY_CASE + TOKEN), F.lit(0)), lambda m: F.upper(F.regexp_extract(m, r"([A-Fa-f])\W*$", 1)))
    return (
        F.when(compact == "", none())
        .when(whole(compact, ONLY_LETTERS), letters(compact))
        .when(whole(compact, ONE_LETTER), first(compact, "([A-F])"))
        .when(holds(compact, TWO_ROUND) | holds(compact, TWO_SQUARE), none())
        .when(holds(compact, LEADING, ANY_CASE), first(compact, LEADING))
        .when(holds(compact, PHRASE, ANY_CASE), first(compact, PHRASE))
        .otherwise(F.array_sort(F.array_distinct(tokens)))
    )


def predicted(response: Column) -> Column:
    """Sorted letters of a response."""
    return let(strip_prediction(response), parse_compact)


def malformed(response: Column) -> Column:
    return let(strip_prediction(response), is_malformed)


def truth(answer: Column) -> Column:
    """Sorted letters of an answer key: a leading letter, else what a prediction would give."""
    def of(raw: Column) -> Column:
        return F.when(holds(raw, KEY_LEADING, ANY_CASE), first(raw, KEY_LEADING)).otherwise(predicted(raw))

    return let(strip(F.coalesce(answer, F.lit(""))), of)


def candidates(fixed: Column, answer: Column) -> Column:
    """Answer keys to try: the fixed list without nulls and blanks, else the answer, else one empty text."""
    kept = F.filter(F.coalesce(fixed, none()), lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.coalesce(answer, F.lit(""))))


def score(fixed: Column, answer: Column, response: Column) -> Column:
    """Struct of mcq_score, prediction_malformed, predicted_options, ground_truth_options, matched_answer.

    Keys are tried in order; the list of ground truths ends with the first that matches.
    """
    def judged(parsed: Column) -> Column:
        pred, bad = parsed["pred"], parsed["bad"]
        hit = lambda k: ~bad & (F.size(k) > 0) & (k == pred)
        return F.transform(candidates(fixed, answer), lambda k: let(truth(k), lambda t: F.struct(k.alias("key"), t.alias("letters"), hit(t).alias("hit"))))

    def summed(s: Column) -> Column:
        first = F.array_position(F.transform(s["tried"], lambda t: t["hit"]), True).cast("int")
        upto = F.when(first > 0, F.slice(s["tried"], F.lit(1), first)).otherwise(s["tried"])
        return F.struct(
            F.when(first > 0, 1.0).otherwise(0.0).alias("mcq_score"),
            s["parsed"]["bad"].alias("prediction_malformed"),
            s["parsed"]["pred"].alias("predicted_options"),
            F.filter(F.transform(upto, lambda t: t["letters"]), lambda x: F.size(x) > 0).alias("ground_truth_options"),
            F.get(s["tried"], first - 1)["key"].alias("matched_answer"),
        )

    parsed = let(strip_prediction(response), lambda c: F.struct(parse_compact(c).alias("pred"), is_malformed(c).alias("bad")))
    return let(let(parsed, lambda p: F.struct(p.alias("parsed"), judged(p).alias("tried"))), summed)
