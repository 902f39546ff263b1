"""Benchmark decontamination by SimHash over item-sized windows (native).

Windows of a document that share no word shingle with any item can't reach the similarity, so
windows are laid only where one is shared: as the shared shingle stands in the item. Each gets a
SimHash fingerprint over its words. The index cuts fingerprints into blocks; two within the radius
differ in few bits of some block, so each item is entered under all values that near in each of
its blocks, and a window looks up its own. Weighted-shingle similarity then decides exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, words_of, written


@dataclass(frozen=True)
class LeakParams:
    shingle: int = 5
    similarity: float = 0.8
    radius: int = 19  # of 64 bits
    blocks: int = 4  # of a fingerprint, 64 / blocks bits each
    broadcast_shingles: int = 2_000_000  # item shingles up to this count are broadcast; beyond, joins shuffle

    @property
    def probe(self) -> int:
        """Bits in which some block of two fingerprints within the radius differs at most."""
        return self.radius // self.blocks


def word_list(text: Column) -> Column:
    return words_of(F.lower(text))


def shingle_hashes(words: Column, k: int) -> Column:
    """Hash of each k-word shingle, by position; a shorter sequence gives none."""
    one = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])
    return F.when(F.size(words) < k, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(words) - k), one))


def simhash(words: Column) -> Column:
    """64-bit SimHash over words; each occurrence weighs once."""

    def of(hashes: Column) -> Column:
        def bit(b: Column) -> Column:
            votes = F.aggregate(hashes, F.lit(0), lambda a, h: a + F.when(F.getbit(h, b) == 1, 1).otherwise(-1))
            return F.when(votes > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

        return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), bit), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def block_keys(print_: Column, blocks: int) -> Column:
    """array<struct<block, value>> of the fingerprint's blocks, which cover all 64 bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = []
    for i in range(blocks):
        width = edges[i + 1] - edges[i]
        value = F.shiftrightunsigned(print_, edges[i]).bitwiseAND(F.lit((1 << width) - 1))
        parts.append(F.struct(F.lit(i).alias("block"), value.alias("value")))
    return F.array(*parts)


def indexed(items: DataFrame, fingerprint: str, params: LeakParams) -> DataFrame:
    """Rows of ``items`` with ``key``: each block's value and all that differ from it in ``probe`` bits or fewer.

    The number of keys of an item depends on the parameters alone (10,068 by default).
    """
    masks = [str(x) for x in range(1 << -(-64 // params.blocks)) if x.bit_count() <= params.probe]
    own = items.withColumn("key", F.explode(block_keys(F.col(fingerprint), params.blocks)))
    near = own.withColumn("mask", F.explode(F.split(F.lit(",".join(masks)), ",").cast("array<bigint>")))
    return near.withColumn("key", F.struct(F.col("key.block").alias("block"), F.col("key.value").bitwiseXOR(F.col("mask")).alias("value"))).drop("mask")


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of minima over sum of maxima of the two lists' shingle counts."""

    def of(common: Column) -> Column:
        count = lambda xs, d: F.size(F.filter(xs, lambda x: x == d))
        single = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
        both = F.when(single, F.size(common)).otherwise(F.aggregate(common, F.lit(0), lambda s, d: s + F.least(count(a, d), count(b, d))))
        return let(both, lambda m: m.cast("double") / (F.size(a) + F.size(b) - m))

    return let(F.array_intersect(a, b), of)


def shingle_texts(words: Column, k: int) -> Column:
    """The shingles themselves; a sequence of fewer words is one shingle."""
    one = lambda i: F.array_join(F.slice(words, i, F.lit(k)), " ")
    return F.when(F.size(words) < k, F.array(F.array_join(words, " "))).otherwise(F.transform(F.sequence(F.lit(1), F.size(words) - k + 1), one))


def find_leaks(docs: DataFrame, bench: DataFrame, params: LeakParams = LeakParams(), text: str = "text", id_col: str = "doc_id", item_text: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, text_hash, item_id, n_windows, at_word, similarity.

    A window is laid for each shared shingle where the item would stand around it, or at the text's
    edge. n_windows counts different laid windows that reach the similarity; at_word is the first
    word (from 0) of the first of the most similar ones. Words are compared in lower
    case. Null or empty texts and items without words match nothing; items of fewer words than a
    shingle match as a whole sequence; rows that share an id are told apart by ``text_hash``.
    Other columns of either input are ignored.
    """
    k = params.shingle
    items = bench.select(F.col(item_col).alias("item_id"), word_list(F.col(item_text)).alias("iw")).where(F.size("iw") > 0).distinct()
    items = items.select("item_id", "iw", F.size("iw").alias("m"), F.least(F.size("iw"), F.lit(k)).alias("k"), simhash(F.col("iw")).alias("ifp"))
    items = written(items.withColumn("i", F.monotonically_increasing_id()))
    widths = sorted(r["k"] for r in items.select("k").distinct().collect())  # one to k different numbers
    parts = F.array(*[F.when(F.col("k") == w, shingle_hashes(F.col("iw"), w)) for w in widths]) if widths else F.array().cast("array<array<bigint>>")
    seeds = items.select("m", "k", F.posexplode(F.flatten(F.array_compact(parts))).alias("item_at", "h")).distinct()
    if seeds.count() <= params.broadcast_shingles:
        seeds = F.broadcast(seeds)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("text_hash", F.xxhash64("t"))
    listed = texts.select("doc_id", "text_hash", word_list(F.col("t")).alias("w"))
    places = None
    for width in widths:
        at = listed.select("doc_id", "text_hash", F.size("w").alias("n"), F.posexplode(shingle_hashes(F.col("w"), width)).alias("at", "h"))
        hits = at.join(seeds.where(F.col("k") == width) if len(widths) > 1 else seeds, "h")
        places = hits if places is None else places.unionByName(hits)
    out = "doc_id bigint, text_hash bigint, item_id bigint, n_windows bigint, at_word int, similarity double"
    if places is None:
        return docs.sparkSession.createDataFrame([], out)
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("item_at"), F.col("n") - F.col("m")))
    laid = places.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct(start.alias("start"), "m")).alias("laid"))
    back = texts.join(laid.withColumnRenamed("doc_id", "d").withColumnRenamed("text_hash", "x").hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("x")))
    cut = let(word_list(F.col("t")), lambda w: F.transform("laid", lambda p: F.struct(p["start"].alias("start"), p["m"].alias("m"), F.slice(w, p["start"] + 1, p["m"]).alias("ww"))))
    windows = back.select("doc_id", "text_hash", F.explode(cut).alias("p")).select("doc_id", "text_hash", "p.*")
    # Rows that share id and text lay the same windows; one of each goes on.
    windows = windows.dropDuplicates(["doc_id", "text_hash", "start", "m"]).withColumns({"fp": simhash(F.col("ww")), "w": F.monotonically_increasing_id()})
    windows = written(windows)
    # Fingerprints and ids meet first; words are fetched for pairs within the radius.
    asked = windows.select("w", "m", "fp", F.explode(block_keys(F.col("fp"), params.blocks)).alias("key"))
    # The index grows with the items, and more than the planner sees: it is never broadcast.
    met = asked.join(indexed(items.select("i", "m", "ifp"), "ifp", params).hint("merge"), ["m", "key"])
    pairs = met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= params.radius).select("w", "i").distinct()
    both = pairs.join(windows.drop("m", "fp"), "w").join(items.select("i", "item_id", "iw"), "i")
    similar = weighted_similarity(shingle_texts(F.col("ww"), k), shingle_texts(F.col("iw"), k))
    leaks = both.withColumn("similarity", similar).where(F.col("similarity") >= params.similarity)
    found = leaks.groupBy("doc_id", "text_hash", "item_id").agg(F.count_distinct("w").alias("n_windows"), F.max(F.struct(F.col("similarity"), (-F.col("start")).alias("s"))).alias("best"))
    return found.select("doc_id", "text_hash", "item_id", "n_windows", (-F.col("best.s")).cast("int").alias("at_word"), "best.similarity")


def drop_leaks(docs: DataFrame, leaks: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item, with their own columns."""
    known, mark, own = fresh(docs, "leak_id"), fresh(docs, "leak_hash"), fresh(docs, "own_hash")
    marked = leaks.select(F.col("doc_id").alias(known), F.col("text_hash").alias(mark)).distinct()
    keyed = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    return keyed.join(marked, F.col(id_col).eqNullSafe(F.col(known)) & (F.col(own) == F.col(mark)), "left_anti").drop(own)
