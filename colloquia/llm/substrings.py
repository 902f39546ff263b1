"""Substring dedup: repeated windows found level by level, doubling their length.

Levels go from a quarter of the length (or less, for longer windows) over each doubling to the
length itself. At a level each full window stands for its least shorter window (equal windows have
equal ones), so a part of the places is shuffled; only where that shorter window is found twice is
the full window tried at the next level. Full windows that start earlier elsewhere are the result.
Exact copies of a text are settled by a text hash before, so they don't carry their windows
through the levels.

Of equal windows in one slice of a task only one goes to the place where equals meet; the others
are known to be repeated, or to come later, and are spread. So what meets there grows with the
number of slices that hold a window, of some megabytes each, however many texts hold it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import slices
from .common import fresh, written
from .grams import WordHashes, mix, sliding_min, windows

#: Hash bits of the levels before the last; collisions only let more places reach the full length.
LEVEL_BITS = 48
#: Among the living hashes of a text: it holds a window of full length twice.
SELF = -1


def level_sizes(length: int) -> list[int]:
    """Window lengths of the levels, each about twice the one before; the last is ``length``."""
    sizes = [length]
    while sizes[0] // 2 >= 5 or len(sizes) == 1:
        sizes.insert(0, max(1, sizes[0] // 2))
    return sizes


class Levels:
    """Window hashes of a text at each level."""

    def __init__(self, length: int):
        self.length, self.sizes, self.hashes = length, level_sizes(length), WordHashes()

    def words(self, text: str) -> np.ndarray:
        return self.hashes.of(text.encode())

    def full(self, words: np.ndarray) -> np.ndarray:
        return windows(words, self.length).view(np.int64)

    def least(self, words: np.ndarray, level: int) -> np.ndarray:
        """Of each full window its least window of the level's size."""
        size = self.sizes[level]
        return (sliding_min(windows(words, size), self.length - size + 1) >> np.uint64(64 - LEVEL_BITS)).astype(np.int64)

    def open(self, words: np.ndarray, level: int, alive) -> np.ndarray:
        """Mask of the full windows that ``level`` has to look at: those alive after the level before."""
        n = max(0, len(words) - self.length + 1)
        if not level or not n:
            return np.ones(n, bool)
        least = self.least(words, level - 1)
        new = np.append(True, least[1:] != least[:-1])
        return np.isin(least[new], alive)[np.cumsum(new) - 1]


def repeated_places(hashes: np.ndarray) -> np.ndarray:
    """Positions of values that occur more than once; most texts have none, which a plain sort tells."""
    ordered = np.sort(hashes)
    again = ordered[1:] == ordered[:-1]
    return np.flatnonzero(np.isin(hashes, ordered[1:][again])) if again.any() else np.empty(0, np.int64)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask of n words covered by windows at ``starts``."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:n]) > 0


def _row(columns: dict[str, list[np.ndarray]], kinds: dict[str, type]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, kinds[c]), *x]).astype(kinds[c])) for c, x in columns.items()], names=list(columns))


def level_windows(texts: DataFrame, length: int, level: int, key: str, mark: str, text: str, gone: str, alive: str | None, marked: bool) -> DataFrame:
    """(p, k, a, h) of a level: least windows of the full windows that are open, one of each in a text.

    p is the window's hash, on which equals meet. h holds it where the window is known to be
    repeated, for the text itself repeats it or another text of the slice holds it; p of all but one
    of a slice's equals spreads them. Rows marked ``gone`` have none. a is the text's hash, or 0 if
    not ``marked``.
    """

    def run(batches):
        levels = Levels(length)
        for batch in slices(batches, text):
            out = {c: [] for c in ("p", "k", "a", "h")}
            sure = [np.empty(0, bool)]
            before = batch.column(alive) if alive else [None] * batch.num_rows
            for k, a, value, skip, own in zip(*(batch.column(c).to_pylist() for c in (key, mark, text, gone)), before, strict=True):
                words = levels.words("" if skip else value)
                own = own.values.to_numpy() if own is not None else None
                mask = levels.open(words, level, own)
                if not mask.any():
                    continue
                least = levels.least(words, level)
                h = np.unique(least[mask])
                twice = repeated_places(levels.full(words)) if own is None or (own == SELF).any() else []
                sure.append(np.isin(h, least[twice]))
                if len(twice):
                    h = np.append(h, SELF)
                    sure.append(np.ones(1, bool))
                out["k"].append(np.full(len(h), k))
                out["a"].append(np.full(len(h), a if marked else 0))
                out["h"].append(h)
            h, k, known = (np.concatenate([np.empty(0, t), *x]).astype(t) for t, x in ((np.int64, out["h"]), (np.int64, out["k"]), (bool, sure)))
            _, first, group, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            other = np.ones(len(h), bool)
            other[first] = False
            other |= h == SELF
            out["p"] = [np.where(other, mix(h.view(np.uint64), k.view(np.uint64)).view(np.int64), h)]
            new = _row(out, dict.fromkeys(out, np.int64))
            yield new.set_column(3, "h", pa.array(h, mask=~(known | (times > 1)[group])))

    return texts.mapInArrow(run, "p long, k long, a long, h long")


def full_windows(texts: DataFrame, length: int, key: str, mark: str, text: str, alive: str, marked: bool) -> DataFrame:
    """(p, k, a, s, sure) of the full windows that are open at the last level.

    sure says that the window goes whatever other slices hold: the text holds it before, or an
    earlier text of the slice does; p spreads such rows, else it is the window's hash. a is the
    text's hash, or 0 if not ``marked``.
    """

    def run(batches):
        levels = Levels(length)
        kinds = {"p": np.int64, "k": np.int64, "a": np.int64, "s": np.int32, "sure": bool}
        for batch in slices(batches, text):
            out = {c: [] for c in kinds}
            for k, a, value, own in zip(*(batch.column(c) for c in (key, mark, text, alive)), strict=True):
                words = levels.words(value.as_py())
                starts = np.flatnonzero(levels.open(words, len(levels.sizes) - 1, own.values.to_numpy()))
                if not len(starts):
                    continue
                full = levels.full(words)[starts]
                late = np.ones(len(starts), bool)
                late[np.unique(full, return_index=True)[1]] = False
                out["p"].append(full)
                out["k"].append(np.full(len(starts), k.as_py()))
                out["a"].append(np.full(len(starts), a.as_py() if marked else 0))
                out["s"].append(starts)
                out["sure"].append(late)
            row = {c: np.concatenate([np.empty(0, kinds[c]), *x]).astype(kinds[c]) for c, x in out.items()}
            order = np.lexsort((row["a"], row["k"], row["sure"], row["p"]))
            same = row["p"][order]
            row["sure"][order[1:][same[1:] == same[:-1]]] = True
            spread = mix(mix(row["p"].view(np.uint64), row["k"].view(np.uint64)), row["s"].astype(np.uint64)).view(np.int64)
            row["p"] = np.where(row["sure"], spread, row["p"])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in row.values()], names=list(row))

    return texts.mapInArrow(run, "p long, k long, a long, s int, sure boolean")


def whole_windows(texts: DataFrame, length: int, key: str, mark: str, text: str, alive: str) -> DataFrame:
    """(g, k, a, s): hash and first place in its text of each full window that is open at the last level."""

    def run(batches):
        levels = Levels(length)
        kinds = {"g": np.int64, "k": np.int64, "a": np.int64, "s": np.int32}
        for batch in slices(batches, text):
            out = {c: [] for c in kinds}
            for k, a, value, own in zip(*(batch.column(c) for c in (key, mark, text, alive)), strict=True):
                words = levels.words(value.as_py())
                starts = np.flatnonzero(levels.open(words, len(levels.sizes) - 1, own.values.to_numpy()))
                if len(starts):
                    g, first = np.unique(levels.full(words)[starts], return_index=True)
                    for c, x in (("g", g), ("k", np.full(len(g), k.as_py())), ("a", np.full(len(g), a.as_py())), ("s", starts[first])):
                        out[c].append(x)
            yield _row(out, kinds)

    return texts.mapInArrow(run, "g long, k long, a long, s int")


def open_texts(texts: DataFrame, first: DataFrame, length: int, names: tuple[str, str, str, str, str], marked: bool) -> DataFrame:
    """Texts that the last level has to look at, with the hashes (``found``) that are alive after the one before.

    names: key, text hash, text, copy and found columns; first: ``texts`` with the copy column.
    """
    key, mark, text, copy, found = names
    keys = [key, mark] if marked else [key]
    rows, alive = first, None
    for level in range(len(level_sizes(length)) - 1):
        seen = level_windows(rows, length, level, key, mark, text, copy, alive, marked)
        twice = seen.withColumn("n", F.count("*").over(Window.partitionBy("p"))).where((F.col("n") > 1) | F.col("h").isNotNull())
        own = twice.groupBy(*[F.col(x).alias(c) for x, c in zip("ka", keys, strict=False)]).agg(F.collect_set(F.coalesce("h", "p")).alias(found))
        rows, alive = texts.withColumn(copy, F.lit(False)).join(own, keys), found
    return rows


def later_copies(names: DataFrame, keys: list[str], key: str, mark: str, other: str) -> DataFrame:
    """(keys) of rows whose text a row of smaller id has. names: (key, mark, other), one row per input row.

    Groups of copies that hold a 10,000th of all rows or more, which are 10,000 at most, are
    broadcast, so that no group meets in one task; the others are joined by a shuffle.
    """
    groups = written(names.groupBy(mark, other).agg(F.min(key).alias("_first"), F.max(key).alias("_last"), F.count("*").alias("_n")).where("_first < _last"))
    large = F.col("_n") * 10_000 >= groups.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    several = groups.drop("_last")
    spread = names.join(F.broadcast(several.where(large).drop("_n")), [mark, other])
    rest = names.join(several.where(~large).drop("_n"), [mark, other])
    return spread.unionByName(rest).where(F.col(key) > F.col("_first")).select(*keys).distinct()


def remove_repeats(docs: DataFrame, length: int = 20, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Add ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one space) to each row.

    A word goes if a window of ``length`` words that covers it also starts earlier: in a row of
    smaller id, or earlier in the same row. A null id comes before all others; rows that share an
    id but not the text come in the order of a text hash; rows that share both are one document
    listed more than once, each with the same result. Null text has no words. Input columns
    stay, but for any named like the three added ones, whatever their case.
    """
    if length < 2:
        raise ValueError("a window has two words at least")
    added = ("n_words", "n_removed", "kept_text")
    docs = docs.drop(*added)
    k, a, own, copy, found, other = (fresh(docs, x) for x in ("key", "text_hash", "text", "copy", "found", "other_hash"))
    keyed = docs.withColumns({
        k: F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))), a: F.xxhash64(F.coalesce(text, F.lit(""))), own: F.coalesce(text, F.lit(""))
    })
    names = keyed.select(k, a, F.xxhash64(F.lit(1), own).alias(other))
    ids = names.groupBy(k).agg(F.min(a).alias("x"), F.max(a).alias("y"), F.count("*").alias("n")).agg(F.max(F.col("x") < F.col("y")), F.max("n")).first()
    alone = not ids[0]  # each id has one text, so ids alone tell texts apart and rows are smaller
    keys = [k] if alone else [k, a]
    slim = keyed.select(k, a, own)
    dealt = slim.repartition(*keys) if (ids[1] or 1) == 1 else slim.dropDuplicates(keys)

    later = later_copies(names, keys, k, a, other).withColumn(copy, F.lit(True))
    rows = open_texts(dealt, dealt.join(later, keys, "left"), length, (k, a, own, copy, found), not alone)

    full = full_windows(rows, length, k, a, own, found, not alone)
    order = F.col("k") if alone else F.struct("k", "a")
    behind = full.withColumn("o", F.min(order).over(Window.partitionBy("p"))).where(F.col("sure") | (order > F.col("o")))
    gone = behind.groupBy(*[F.col(x).alias(c) for x, c in zip("ka", keys, strict=False)]).agg(F.collect_list("s").alias(found))
    return _cleaned(docs, keyed, dealt, later, gone, keys, length, text, id_col, (own, copy, found), (ids[1] or 1) == 1)


def _cleaned(docs: DataFrame, keyed: DataFrame, dealt: DataFrame, later: DataFrame, gone: DataFrame, keys: list[str], length: int, text: str, id_col: str, names: tuple[str, str, str], single: bool) -> DataFrame:
    """Rows of ``docs`` without the words of ``later`` rows and of the windows that are ``gone``."""
    own, copy, found = names
    added = ("n_words", "n_removed", "kept_text")
    rest = [c for c in docs.columns if c != text]

    def clean(batches):
        for batch in slices(batches, own):
            n_words, n_removed, kept = [], [], []
            for value, skip, starts in zip(*(batch.column(c) for c in (own, copy, found)), strict=True):
                words = value.as_py().encode().split()
                n, removed = len(words), 0
                if n >= length and skip.as_py():
                    removed, words = n, []
                elif starts.is_valid:
                    mask = covered(starts.values.to_numpy(), length, n)
                    removed = int(mask.sum())
                    words = [w for w, g in zip(words, mask.tolist(), strict=True) if not g]
                n_words.append(n)
                n_removed.append(removed)
                kept.append(b" ".join(words).decode())
            new = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), batch.column(own), *new], names=[*rest, text, *added])

    source = keyed
    if not single:  # equal rows may be many: tables by themselves let adaptive execution split a skewed join
        later, gone = written(later), written(gone)
    elif set(docs.columns) == {id_col, text} and dict(docs.dtypes)[id_col] == "bigint":  # the shuffle that the levels use serves here too
        source = dealt.withColumn(id_col, F.when(F.col(keys[0]) != -(2**63), F.col(keys[0])))
    schema = docs.select(*rest, text).schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    return source.join(later, keys, "left").join(gone, keys, "left").mapInArrow(clean, schema)


def doubled(windows: DataFrame, length: int) -> DataFrame:
    """(k, a, s, length): windows (g, k, a, s) found at two places or more, at ``length`` and each doubling of it.

    Only where two repeated windows stand end to end is one of twice the length tried; its hash is
    that of the two. Levels end when none survives: after the logarithm of the longest repeat.
    """
    rows, out = windows, None
    while True:
        repeated = rows.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g")
        alive = written(rows.join(repeated, "g", "left_semi"))
        if out is not None and alive.isEmpty():
            return out
        level = alive.select("k", "a", "s", F.lit(length).alias("length"))
        out = level if out is None else out.unionByName(level)
        after = alive.select("k", "a", (F.col("s") - length).alias("s"), F.col("g").alias("g2"))
        rows = alive.join(after, ["k", "a", "s"]).select(F.xxhash64("g", "g2").alias("g"), "k", "a", "s")
        length *= 2


def repeated_passages(docs: DataFrame, length: int = 20, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, start, length) of windows of words found at two places or more, at each doubled length.

    Copies of a text count as places; of places within one text the first is taken. Rows that share id and text are one document.
    """
    source = docs.select(F.col(id_col).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    source = source.select(F.coalesce("k", F.lit(-(2**63))).alias("k"), F.xxhash64("t").alias("a"), "t").dropDuplicates(["k", "a"])
    rows = open_texts(source, source.withColumn("copy", F.lit(False)), length, ("k", "a", "t", "copy", "alive"), True)
    levels = doubled(whole_windows(rows, length, "k", "a", "t", "alive"), length)
    return levels.select(F.when(F.col("k") != -(2**63), F.col("k")).alias("doc_id"), F.col("a").alias("text_hash"), F.col("s").alias("start"), "length")
