"""Scalar text functions over questions, answers and model responses, as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Markers that end a question's stem, the instruction and the fallback option of a rendered
#: question, the key of a question without text, and the marks in model responses.
SELECT_MARKER = "You need to select"
STEM_MARKERS = ("Please provide the option corresponding to the only correct answer", "You need to select the correct answer from the following options:")
INSTRUCTION = "Please provide the option corresponding to the only correct answer, enclosed in parentheses, e.g., (X)."
CANNOT_INFER = "F. Cannot infer the answer based on the given information."
UNKNOWN_QUESTION = "UNKNOWN_QUESTION"
THINK_END, FINAL_ANSWER = "</think>", "Final Answer:"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for a ``body`` that names it several times; nested rules would else grow as a power."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    """Both ends without white space of any kind, as Unicode has it."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def option_letter(c: Column) -> Column:
    """First letter A-F after leading white space, whatever follows it; else null."""
    return null_if_empty(F.regexp_extract(c, r"^\s*([A-F])", 1))


def clean_json(c: Column) -> Column:
    """Model output cut to the span from its first brace to its last; quotes unescaped, fences dropped."""
    plain = F.regexp_replace(F.replace(c, F.lit("\\'"), F.lit("'")), r"```(?:json)?", "")
    span = F.regexp_extract(plain, r"(?s)\{.*\}", 0)
    return strip(F.coalesce(null_if_empty(span), plain))


def json_array(c: Column) -> Column:
    """Text from the first bracket to the last; null without one."""
    return null_if_empty(F.regexp_extract(c, r"(?s)\[.*\]", 0))


def strict_json_object(c: Column) -> Column:
    """The text without code fences at its ends if it is a JSON object, else null."""
    bare = strip(F.regexp_replace(strip(c), r"^```(?:json)?\s*|\s*```$", ""))
    return F.when(F.try_parse_json(bare).isNotNull() & bare.startswith("{") & bare.endswith("}"), bare)


def after_first(c: Column, mark: str) -> Column:
    return let(c, lambda t: F.when(F.instr(t, mark) > 0, strip(F.substr(t, F.instr(t, mark) + len(mark)))).otherwise(t))


def strip_prediction(c: Column) -> Column:
    """The answer part of a response: after the think tag, after the final-answer mark, out of a JSON object."""
    def of(text: Column) -> Column:
        found = [F.when(F.schema_of_variant(F.variant_get(F.try_parse_json(text), f"$.{k}", "variant")) == "STRING", null_if_empty(strip(F.get_json_object(text, f"$.{k}")))) for k in ("answer", "final_answer", "response")]
        return F.when(text.startswith("{") & text.endswith("}"), F.coalesce(*found, text)).otherwise(text)

    return let(after_first(after_first(strip(F.coalesce(c, F.lit(""))), THINK_END), FINAL_ANSWER), of)


def strip_letter_prefix(c: Column) -> Column:
    """Without ``X. ``, whatever one character X is."""
    bare = strip(F.coalesce(c, F.lit("")))
    return strip(F.regexp_replace(bare, r"(?s)^.\. ", ""))


def core_stem(question: Column) -> Column:
    """Text before the blank line and the select marker, else all of it."""
    head = F.regexp_extract(question, r"(?s)^(.*?)\n\s*\n\s*" + SELECT_MARKER, 1)
    return F.when(F.regexp_like(question, F.lit(r"(?s)\n\s*\n\s*" + SELECT_MARKER)), strip(head)).otherwise(question)


def core_question(question: Column) -> Column:
    """First line of the stem before the select marker, else the first line that isn't blank, else UNKNOWN_QUESTION."""
    head = strip(F.regexp_extract(question, r"(?s)^\s*(.*?)\s*\n\s*\n\s*" + SELECT_MARKER, 1))
    lines = F.filter(F.transform(F.split(question, "\n"), strip), lambda x: x != "")
    marked = strip(F.split(strip(F.split(head, "\n\n")[0]), "\n")[0])
    plain = F.coalesce(F.get(lines, F.lit(0)), F.lit(UNKNOWN_QUESTION))
    return F.when(F.regexp_like(question, F.lit(r"(?s)\n\s*\n\s*" + SELECT_MARKER)), marked).otherwise(plain)


def option_lines(options: Column) -> Column:
    """Each option with its letter in front, unless it carries one already."""

    def one(o: Column, i: Column) -> Column:
        text, letter = strip(o), F.chr(F.lit(65) + i)
        return F.when(F.startswith(text, F.concat(letter, F.lit("."))) | (F.substring(text, 2, 2) == ". "), text).otherwise(F.concat(letter, F.lit(". "), text))

    return F.transform(options, one)


def question_stem(question: Column, lines: Column) -> Column:
    """The question before any marker and before the first option line."""
    text = strip(F.coalesce(question, F.lit("")))
    for mark in STEM_MARKERS:
        text = let(text, lambda t: F.when(F.instr(t, mark) > 0, strip(F.substr(t, F.lit(1), F.instr(t, mark) - 1))).otherwise(t))
    first = F.concat(F.lit("\n"), F.get(lines, F.lit(0)))
    return let(text, lambda t: F.when(F.coalesce(F.position(first, t), F.lit(0)) > 0, strip(F.substr(t, F.lit(1), F.position(first, t) - 1))).otherwise(t))


def version_of(file_name: Column) -> Column:
    """``v`` and what stands between the last ``_v`` and ``.json`` of a file name."""
    return F.concat(F.lit("v"), F.split(F.element_at(F.split(file_name, "_v"), -1), r"\.json")[0])


def session_time_key(utterance: Column) -> Column:
    return null_if_empty(F.regexp_extract(utterance, r"(session_\d+)_date_time", 1))


def token_estimate(json: Column) -> Column:
    """Half the characters, where no tokenizer is at hand."""
    return F.floor(F.length(json) / 2).cast("long")


def perplexity(avg_loss: Column) -> Column:
    return F.when(avg_loss.isNotNull(), F.exp(F.least(avg_loss, F.lit(20.0))))


def answer_prompt(question: Column, answer: Column) -> Column:
    return F.concat(F.regexp_replace(question, r"(?U)\s+$", ""), F.lit("\nAnswer: "), answer)


def answer_offset(question: Column, answer: Column) -> Column:
    """Index of the answer's first character in the prompt."""
    return F.length(answer_prompt(question, answer)) - F.length(answer)


#: Labels of refined questions and what they become.
LABEL_MAP = {"memory_update": "记忆更新", "integrated_logic": "事实提取（多对话）"}
#: Labels offered when questions are labelled, and the one never offered.
LABELS = ("事实提取（单对话）", "事实提取（多对话）", "记忆更新（失效的记忆，更新的记忆）", "多跳", "弃权")


def map_label(label: Column) -> Column:
    out = label
    for code, text in LABEL_MAP.items():
        out = F.when(label == code, text).otherwise(out)
    return out


def image_suffix(text: Column, url: Column, caption: Column, figure_view: bool) -> Column:
    if not figure_view:
        return text
    return F.when(url.isNotNull() & caption.isNotNull(), F.concat(text, F.lit(" [Image: "), url, F.lit("] with caption: "), caption)).otherwise(text)


def preview(question: Column, n: int = 40) -> Column:
    return F.substring(question, 1, n)


def duration(seconds: Column) -> Column:
    return F.format_string("%dm %ds", F.floor(seconds / 60).cast("int"), F.floor(seconds % 60).cast("int"))


def mixed_order(key: Column) -> list[Column]:
    """Sort columns for keys of which some are whole numbers: those first and by value, then text."""
    number = key.try_cast("bigint")
    return [number.isNull(), number, key]


def mixed_order_lower(key: Column) -> list[Column]:
    """As mixed_order, for keys of digits alone; other text by its lower case."""
    number = F.when(F.regexp_like(key, F.lit(r"^\d+$")), key.try_cast("bigint"))
    return [number.isNull(), number, F.lower(key)]
