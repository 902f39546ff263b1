"""The registered queries of the training-data operators: thin digests over the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, language, neardup, pii, quality, secrets, substrings, urls
from .common import table
from .oracles import ORACLES  # noqa: F401


def sha(text: Column) -> Column:
    return F.sha2(F.encode(text, "utf-8"), 256)


#: The log of the extra conversation: both messages say the same in the end.
SAID = r"\### Assistant: </turn> ok"
EXTRA_LOG = (
    (-7, 1, chat.START, 1, "user", "a draft"), (-7, 2, chat.EDIT, 1, "user", SAID), (-7, 3, chat.START, 2, "assistant", "an answer "), (-7, 4, chat.DELTA, 2, "assistant", "that goes"),
    (-7, 5, chat.REGENERATE, 2, "assistant", None), (-7, 6, chat.DELTA, 2, "assistant", SAID[:7]), (-7, 7, chat.DELTA, 2, "assistant", SAID[7:]),
)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = chat.log_of_turns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    extra = spark.createDataFrame(EXTRA_LOG, "conv_id long, seq long, kind string, message long, role string, text string")
    turns = log.unionByName(extra)
    rendered = chat.render_chat(chat.fold_events(turns))
    read = rendered.select("conv_id", "formatted", "mask", chat.parse_chat(F.col("formatted")).alias("turns"))
    digests = read.select(
        "conv_id",
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("turns").cast("long").alias("n_turns"),
        sha(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")).alias("turns_sha256"),
        F.array_join(chat.masked_texts(F.col("turns"), F.col("mask")), "").alias("loss"),
    )
    return digests.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"), "formatted_chars")


def span_digests(rows: DataFrame, base: Callable[[Column], Column], kinds: list[str]) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans, from an array of (start, ord, kind, end)."""
    own = F.filter("spans", base)

    def count(kind: str) -> Column:
        return F.size(F.filter(own, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", *map(count, kinds), sha(secrets.joined(own)).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = [r.kind for r in secrets.BASE_RULES]
    return span_digests(secrets.scan_secrets(table(spark, sf_dir, "documents")), lambda s: s["kind"].isin(*kinds), kinds)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = urls.train(urls.labelled_urls(spark))
    return urls.judge_urls(table(spark, sf_dir, "pages"), weights)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def language_model(docs: DataFrame) -> language.LanguageModel:
    return language.train(docs.where(~held_out()).select("doc_id", "text", "lang"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = language.identify(docs.select("doc_id", "text"), language_model(docs))
    return judged.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "share")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.train())
    return span_digests(found, lambda s: s["base"], list(pii.KINDS))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "n_windows", "at_word", F.round("similarity", 9).alias("similarity"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed", sha(F.col("kept_text")).alias("kept_sha256"))


def tokenizer() -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer()
    encoded = bpe.encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern)
    read_back = bpe.decode_ids(encoded.select("doc_id", "ids"), ranks)
    return read_back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_secret_scan": op2_secret_scan,
    "op3_url_filter": op3_url_filter,
    "op4_language_id": op4_language_id,
    "op5_pii": op5_pii,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_quality_rules": op7_quality_rules,
    "op8_decontaminate": op8_decontaminate,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_byte_bpe": op10_byte_bpe,
}
