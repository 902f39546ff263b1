"""Language ID by bit-sliced Bloom filters over character n-grams.

Every slot of the filter holds one bit per language, so one lookup (the AND of a few slots)
returns all languages that contain an n-gram. Per-language popcounts over a text, corrected for
each language's false-positive rate, decide. The filter's size is fixed by parameters; it is
broadcast, and texts never leave their row.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import slices
from .common import fresh, written

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageParams:
    gram: int = 3
    sample_docs: int = 500  # labelled rows per language that the filters are fitted on
    min_share: float = 0.01  # of a language's sample documents that hold an n-gram
    ratio: float = 0.3  # an n-gram belongs to languages with this part of its largest relative frequency
    max_grams: int = 20_000  # most common n-grams kept per language: bounds the filter
    max_languages: int = 256  # more labels raise: the filter has a bit slice for each
    slots_log2: int = 19
    probes: int = 3


@dataclass
class LanguageModel:
    params: LanguageParams
    languages: list[str]
    slots: list[np.ndarray]  # one array per 64 languages
    false_rate: np.ndarray


@cache
def _letters() -> np.ndarray:
    """Of each code point: itself in lower case if a letter, else a space."""
    table = np.full(0x110000, 32, np.uint32)
    for cp in range(0x110000):
        if unicodedata.category(chr(cp))[0] == "L":
            low = chr(cp).lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


class Grams:
    """Packed character n-grams of a text, letters only; all else is a space."""

    def __init__(self, gram: int):
        self.gram, self.table = gram, _letters()

    def of(self, text: str) -> np.ndarray:
        cp = self.table[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        space = cp == 32
        if space.any():
            keep = ~(space & np.append(True, space[:-1]))  # runs of other characters count once
            cp = cp[keep]
        if not len(cp) or (len(cp) == 1 and cp[0] == 32):
            return np.empty(0, np.uint64)
        edge = np.array([32], np.uint32)
        cp = np.concatenate([edge[: int(cp[0] != 32)], cp, edge[: int(cp[-1] != 32)]]).astype(np.uint64)
        n = len(cp) - self.gram + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        out = cp[:n].copy()
        for i in range(1, self.gram):
            out *= np.uint64(0x100000001B3)
            out += cp[i : i + n]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        return out


def pieces(text: str, size: int = 1_000_000):
    """Parts of a long text, so that memory doesn't grow with it."""
    for at in range(0, len(text), size):
        yield text[at : at + size]


def probes(grams: np.ndarray, params: LanguageParams):
    mask = np.uint64((1 << params.slots_log2) - 1)
    for i in range(params.probes):
        yield ((grams >> np.uint64(i * 20)) & mask).astype(np.int64)


def labelled_sample(docs: DataFrame, text: str, id_col: str, lang: str, params: LanguageParams) -> DataFrame:
    """At most sample_docs labelled rows (l, t) per language, chosen by a hash of id and text.

    Rows that share id and text are one row; rows that share an id but not the text are told apart.
    A language with fewer rows keeps them all. Rows without label, text or id teach nothing.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(id_col).isNotNull())
    ids = labelled.groupBy(F.col(lang).cast("string").alias("l")).agg(F.approx_count_distinct(id_col).alias("n"))
    counts = {r["l"]: r["n"] for r in ids.limit(params.max_languages + 1).collect()}
    if len(counts) > params.max_languages:
        raise ValueError(f"more than {params.max_languages} languages are labelled")
    # Different ids are no more than different rows, so the rate leaves enough of them; it only spares the ranking work.
    rate = F.lit(1.0)
    for name, n in counts.items():
        rate = F.when(F.col("l") == name, min(1.0, (3 * params.sample_docs + 30) / n)).otherwise(rate)
    rows = labelled.where(F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("l"), F.col(text).alias("t"), F.xxhash64(F.lit(11), F.col(id_col), F.col(text)).alias("h"))
    near = rows.where(F.pmod("h", F.lit(1_000_000)) < rate * 1_000_000)
    first = Window.partitionBy("l").orderBy("h")
    return near.dropDuplicates(["l", "h"]).withColumn("r", F.row_number().over(first)).where(F.col("r") <= params.sample_docs).select("l", "t")


def gram_counts(sample: DataFrame, params: LanguageParams) -> DataFrame:
    """(l, g, n, d) of the sample's rows (l, t): how often a language's rows hold an n-gram, and how many do."""

    def count(batches):
        grams = Grams(params.gram)
        for batch in slices(batches, "t"):
            held: dict[str, list] = {}
            for name, value in zip(batch.column("l").to_pylist(), batch.column("t"), strict=True):
                parts = [np.unique(grams.of(part), return_counts=True) for part in pieces(value.as_py())]
                if parts:
                    held.setdefault(name, []).append(_merged(parts)[:2])
            for name, parts in held.items():
                keys, times, rows = _merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(times), pa.array(rows)], names=["l", "g", "n", "d"])

    return sample.mapInArrow(count, "l string, g long, n long, d long").groupBy("l", "g").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, sums of counts, number of parts that hold the key)"""
    keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    times = np.bincount(where, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)
    return keys, times, np.bincount(where, minlength=len(keys))


def members(counted: DataFrame, sizes: DataFrame, params: LanguageParams) -> DataFrame:
    """(l, g) of the n-grams that belong to each language. sizes: (l, rows) of the sample.

    An n-gram belongs to a language if min_share of its sampled rows hold it and its relative
    frequency there is at least ``ratio`` of the largest in any language; of those the max_grams
    most frequent are kept.
    """
    total = Window.partitionBy("l")
    shared = counted.join(F.broadcast(sizes), "l").withColumn("share", F.col("n") / F.sum("n").over(total))
    top = shared.withColumn("top", F.max("share").over(Window.partitionBy("g")))
    own = top.where((F.col("d") >= params.min_share * F.col("rows")) & (F.col("share") >= params.ratio * F.col("top")))
    return own.withColumn("r", F.row_number().over(total.orderBy(F.desc("share"), "g"))).where(F.col("r") <= params.max_grams).select("l", "g")


def train(docs: DataFrame, params: LanguageParams = LanguageParams(), text: str = "text", id_col: str = "doc_id", lang: str = "lang") -> LanguageModel:
    """Fit the filters on the labelled rows of ``docs``.

    The driver gathers the members alone, max_grams (16 bytes each) of max_languages at most. A language of
    which no sampled row has a letter is not learned.
    """
    sample = written(labelled_sample(docs, text, id_col, lang, params))
    sizes = sample.groupBy("l").agg(F.count("*").alias("rows"))
    rows = members(gram_counts(sample, params), sizes, params).toArrow()
    names, keys = rows.column("l").combine_chunks().dictionary_encode(), rows.column("g").to_numpy().view(np.uint64)
    languages = sorted(names.dictionary.to_pylist())
    place = np.array([languages.index(x) for x in names.dictionary.to_pylist()], np.int64)
    own = place[names.indices.to_numpy(zero_copy_only=False)] if languages else np.empty(0, np.int64)
    slots = [np.zeros(1 << params.slots_log2, np.uint64) for _ in range((len(languages) + 63) // 64)]
    for i in range(len(languages)):
        for p in probes(keys[own == i], params):
            slots[i // 64][p] |= np.uint64(1 << (i % 64))
    filled = np.array([np.mean(slots[i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(len(languages))])
    return LanguageModel(params, languages, slots, filled**params.probes)


class Identifier:
    """Scores texts; one per Python worker."""

    def __init__(self, model: LanguageModel):
        self.m, self.grams = model, Grams(model.params.gram)
        size = len(model.languages)
        kind = np.uint8 if size <= 8 else np.uint64
        self.slots = [s.astype(kind) for s in model.slots]
        self.bits = [kind(1 << (i % 64)) for i in range(size)]

    def popcounts(self, text: str) -> tuple[np.ndarray, int]:
        counts, n = np.zeros(len(self.bits)), 0
        for part in pieces(text):
            grams = self.grams.of(part)
            n += len(grams)
            held = [None] * len(self.slots)
            for p in probes(grams, self.m.params):
                held = [s[p] if h is None else h & s[p] for h, s in zip(held, self.slots, strict=True)]
            counts += [np.count_nonzero(held[i // 64] & b) for i, b in enumerate(self.bits)]
        return counts, n

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, share of n-grams that the language contains)"""
        if not text or not self.bits:
            return UNKNOWN, 0.0, 0.0
        counts, n = self.popcounts(text)
        if not n:
            return UNKNOWN, 0.0, 0.0
        true = np.maximum(0, (counts - n * self.m.false_rate) / (1 - self.m.false_rate))
        order = np.argsort(-true, kind="stable")
        best = true[order[0]]
        second = true[order[1]] if len(order) > 1 else 0.0
        return self.m.languages[order[0]], float(best / (best + second)) if best else 0.0, float(min(1.0, best / n))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "lang_pred", score: str = "score", share: str = "share") -> DataFrame:
    """Add ``out`` (a learned language, or ``und`` for null text and text without a letter), ``score`` and ``share``.

    score is the best language's part of the two largest corrected popcounts, from 0 to 1; share
    the part of n-grams that the best language contains. A model without languages answers und.
    Other columns stay, but for any of the added names, whatever their case.
    """
    value = F.col(text)
    hold = fresh(docs, "t")
    docs = docs.withColumn(hold, value).drop(out, score, share)
    columns = [c for c in docs.columns if c != hold]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        judge = Identifier(shared.value)
        for batch in slices(batches, hold):
            got = [judge(v.as_py()) for v in batch.column(hold)]
            new = [pa.array([g[i] for g in got], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *new], names=[*columns, out, score, share])

    schema = docs.drop(hold).limit(0).schema.add(out, "string").add(score, "double").add(share, "double")
    return docs.mapInArrow(run, schema)
