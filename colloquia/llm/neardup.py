"""N-gram Jaccard join over documents, with count-vector R-trees.

A document's set of word shingles is hashed into groups; the group counts are a point. The sum
of coordinate minima bounds how many shingles two sets share, for points and, by an R-tree's
upper corners, for whole subtrees. Pairs that survive the bound are verified on the sets.

Points of unlike texts of one length lie close together in every coordinate, so boxes over a
whole corpus prune next to nothing (figures in the README). The trees are therefore built
within blocks of sets that agree on a few least hashes; a linked pair shares no block with a
probability below 1e-10 (at 80 percent below 1e-7). Large blocks of sets that don't link are cut
finer, by more least hashes. Equal sets are one node throughout. Within a block all nodes are first
tried against one leader, then components against the largest one; only nodes of components
that are still apart are compared further, all with all.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import written
from .components import components
from .grams import WordHashes, mix, windows


#: Largest count that a coordinate can hold.
FULL = 0xFFFF


@dataclass(frozen=True)
class JaccardParams:
    shingle: int = 4
    percent: int = 85  # two sets link when 100 * intersection >= percent * union
    groups: int = 256  # coordinates of a point
    bands: int = 32
    rows: int = 4  # least hashes per band
    star_rounds: int = 3  # tries of each block's components against one of them, before all pairs
    block: int = 4096  # points that one tree holds; larger blocks are cut finer, what is still larger is split into pairs of parts
    fine_bands: int = 96  # bands of the sets in such blocks; a pair at 85 percent shares none with a probability of 6e-14
    fine_rows: int = 8
    broadcast_ids: int = 50_000  # sets to fetch up to this count are broadcast as ids; beyond, texts are joined by a shuffle

    @property
    def smallest(self) -> int:
        """Two different sets can't link if both are smaller than this."""
        n = 1
        while 100 * (n - 1) < self.percent * n:
            n += 1
        return n - 1


def shingle_set(text: str, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles, A-Z in lower case; fewer words are one shingle."""
    h = hashes.of(text.encode().lower())
    if 0 < len(h) < k:
        whole = np.full(1, len(h), np.uint64)
        for x in h:
            whole = mix(whole, x[None])
        return whole
    return np.unique(windows(h, k))


class Signer:
    def __init__(self, params: JaccardParams, seed: int = 20_240):
        self.p = params
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 2**32, params.bands * params.rows, np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
        self.b = rng.integers(0, 2**32, params.bands * params.rows, np.uint64).astype(np.uint32)[:, None]
        self.salt = rng.integers(0, 2**63, params.bands, np.uint64)

    def counts(self, s: np.ndarray) -> np.ndarray:
        counts = np.bincount((s >> np.uint64(17)).astype(np.int64) % self.p.groups, minlength=self.p.groups)
        return np.minimum(counts, FULL).astype(np.uint16)

    def digest(self, s: np.ndarray) -> tuple[int, int]:
        """Two 64-bit sums that name the set."""
        x = mix(s, np.full(1, 7, np.uint64))
        return int(s.sum(dtype=np.uint64).view(np.int64)), int(x.sum(dtype=np.uint64).view(np.int64))

    def keys(self, s: np.ndarray) -> np.ndarray:
        """A key per band, equal for two sets if their least hashes of the band are."""
        low = (s >> np.uint64(32)).astype(np.uint32)[None]
        least = np.full(self.p.bands * self.p.rows, 0xFFFFFFFF, np.uint32)
        for at in range(0, low.shape[1], 1024):
            least = np.minimum(least, (low[:, at : at + 1024] * self.a + self.b).min(axis=1))
        rows = least.astype(np.uint64).reshape(self.p.bands, self.p.rows)
        key = self.salt
        for r in range(self.p.rows):
            key = mix(key, rows[:, r])
        return key.view(np.int64)


def sign(docs: DataFrame, p: JaccardParams) -> DataFrame:
    """(k, a, n, s1, s2, bands, counts) of each row of docs (k, a, t)."""

    def run(batches):
        signer, hashes = Signer(p), WordHashes()
        for batch in slices(batches, "t"):
            out = {c: [] for c in ("n", "s1", "s2", "counts")}
            bands, ends = [np.empty(0, np.int64)], [0]
            for value in batch.column("t"):
                s = shingle_set(value.as_py(), p.shingle, hashes)
                s1, s2 = signer.digest(s)
                if len(s) >= p.smallest:
                    bands.append(signer.keys(s))
                ends.append(ends[-1] + p.bands * (len(s) >= p.smallest))
                for c, v in (("n", len(s)), ("s1", s1), ("s2", s2), ("counts", signer.counts(s).tobytes())):
                    out[c].append(v)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(bands)))
            kinds = {"n": pa.int64(), "s1": pa.int64(), "s2": pa.int64()}
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("a"), *(pa.array(out[c], t) for c, t in kinds.items()), lists, pa.array(out["counts"], pa.binary())], names=["k", "a", *kinds, "bands", "counts"])

    return docs.mapInArrow(run, "k long, a long, n long, s1 long, s2 long, bands array<long>, counts binary")


def fits(shared: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets with so many shared shingles and that sum of sizes reach the percentage."""
    return (100 + percent) * shared >= percent * sizes


class CountTree:
    """R-tree over points in an order that keeps components together: packed leaves, fixed fan-out.

    A node keeps its upper corner, its smallest set size, and its component if it has only one.
    """

    LEAF, FAN = 16, 8

    def __init__(self, points: np.ndarray, sizes: np.ndarray, comp: np.ndarray, percent: int):
        self.percent = percent
        self.order = np.lexsort((sizes, comp))
        self.points, self.sizes, self.comp = points[self.order].astype(np.int64), sizes[self.order], comp[self.order]
        self.levels = [self._pack(self.points, self.sizes, self.comp, self.comp, self.LEAF)]
        while len(self.levels[-1][1]) > 1:
            self.levels.append(self._pack(*self.levels[-1], self.FAN))

    @staticmethod
    def _pack(high, low, first, last, width):
        at = np.arange(0, len(low), width)
        return np.maximum.reduceat(high, at), np.minimum.reduceat(low, at), np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)

    def _alive(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if level < 0:
            high, low, first, last = self.points, self.sizes, self.comp, self.comp
        else:
            high, low, first, last = self.levels[level]
        differ = (first[a] != last[a]) | (first[b] != last[b]) | (first[a] != first[b])
        keep = np.flatnonzero(differ)
        alive = np.zeros(len(a), bool)
        for some in np.array_split(keep, max(1, len(keep) // 20_000)):
            alive[some] = fits(np.minimum(high[a[some]], high[b[some]]).sum(axis=1), low[a[some]] + low[b[some]], self.percent)
        return alive

    def pairs(self):
        """Yield arrays (i, j) of input positions in different components that survive the bound."""
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            alive = self._alive(level, a, b)
            a, b = a[alive], b[alive]
            if not len(a):
                continue
            if level < 0:
                yield self.order[a], self.order[b]
                continue
            width, count = (self.LEAF, len(self.sizes)) if level == 0 else (self.FAN, len(self.levels[level - 1][1]))
            step = np.arange(width)
            for lo in range(0, len(a), 2000):
                x = np.broadcast_to((a[lo : lo + 2000, None, None] * width) + step[:, None], (len(a[lo : lo + 2000]), width, width)).ravel()
                y = np.broadcast_to((b[lo : lo + 2000, None, None] * width) + step[None, :], (len(a[lo : lo + 2000]), width, width)).ravel()
                ok = (x < count) & (y < count) & ((x < y) if level == 0 else (x <= y))
                stack.append((level - 1, x[ok], y[ok]))


def block_pairs(ids: np.ndarray, comp: np.ndarray, sizes: np.ndarray, points: np.ndarray, starts: np.ndarray, percent: int):
    """Yield (u, v) of surviving pairs within groups of rows that begin at ``starts``; small groups of one size go together."""
    lengths = np.diff(np.append(starts, len(ids)))
    for length in np.unique(lengths):
        own = starts[lengths == length]
        if length < 2:
            continue
        if length > 48:
            for s in own:
                part = slice(s, s + length)
                for i, j in CountTree(points[part], sizes[part], comp[part], percent).pairs():
                    yield ids[part][i], ids[part][j]
            continue
        i, j = np.triu_indices(length, 1)
        for some in np.array_split(own, max(1, len(own) * len(i) // 50_000)):
            a, b = (some[:, None] + i).ravel(), (some[:, None] + j).ravel()
            a, b = (x[comp[a] != comp[b]] for x in (a, b))
            good = fits(np.minimum(points[a], points[b]).sum(axis=1), sizes[a] + sizes[b], percent)
            yield ids[a[good]], ids[b[good]]


def _points(column: pa.Array, groups: int) -> np.ndarray:
    """Counts by row; a full one stands for any number."""
    counts = np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, groups).astype(np.int64)
    counts[counts == FULL] = 1 << 40
    return counts


def bounded(pairs: DataFrame, nodes: DataFrame, p: JaccardParams) -> DataFrame:
    """Pairs (u, v) whose points allow enough shared shingles."""
    side = lambda c, m: nodes.select(F.col("id").alias(c), F.col("n").alias(f"n{m}"), F.col("counts").alias(f"c{m}"))
    both = pairs.join(side("u", 1), "u").join(side("v", 2), "v")

    def run(batches):
        for batch in batches:
            shared = np.minimum(_points(batch.column("c1"), p.groups), _points(batch.column("c2"), p.groups)).sum(axis=1)
            sizes = batch.column("n1").to_numpy() + batch.column("n2").to_numpy()
            yield batch.select(["u", "v"]).filter(pa.array(fits(shared, sizes, p.percent)))

    return both.mapInArrow(run, "u long, v long")


def sets_of(ids: DataFrame, nodes: DataFrame, docs: DataFrame, p: JaccardParams) -> DataFrame:
    """(id, shingles) for node ids, from one document of each."""
    want = nodes.join(ids, "id", "left_semi").select("k", "a", "id", F.col("s1").alias("w1"), F.col("s2").alias("w2"))
    want = written(want)
    if want.count() <= p.broadcast_ids:
        want = F.broadcast(want)

    def run(batches):
        signer, hashes = Signer(p), WordHashes()
        for batch in slices(batches, "t"):
            ids, flat, ends = [], [np.empty(0, np.uint64)], [0]
            for node, w1, w2, text in zip(*(batch.column(c).to_pylist() for c in ("id", "w1", "w2", "t")), strict=True):
                s = shingle_set(text, p.shingle, hashes)
                if signer.digest(s) == (w1, w2):  # rows of one id may differ in text
                    ids.append(node)
                    flat.append(s)
                    ends.append(ends[-1] + len(s))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], names=["id", "shingles"])

    return docs.join(want, ["k", "a"]).mapInArrow(run, "id long, shingles array<long>").dropDuplicates(["id"])


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, p: JaccardParams) -> DataFrame:
    """Pairs (u, v) that link, by exact intersection of their sets; copies of (u, v) may repeat no more than given."""
    pairs = written(bounded(pairs, nodes, p))
    ids = pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    sets = written(sets_of(ids, nodes, docs, p))
    side = lambda c, m: sets.select(F.col("id").alias(c), F.col("shingles").alias(m))
    both = pairs.join(side("u", "x"), "u").join(side("v", "y"), "v")
    shared = F.size(F.array_intersect("x", "y")).cast("long")
    return both.where((100 + p.percent) * shared >= p.percent * (F.size("x") + F.size("y"))).select("u", "v")


def labelled(blocks: DataFrame, stars: DataFrame) -> DataFrame:
    """Blocks (band, id) with the component of each id."""
    return blocks.join(stars.select(F.col("u").alias("id"), F.col("v").alias("comp")), "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def component_stars(blocks: DataFrame, stars: DataFrame, salt: int) -> DataFrame:
    """Pairs (u, v) of one node of each component of a block with one of its largest component."""
    comps = labelled(blocks, stars).groupBy("band", "comp").agg(F.count("*").alias("n"), F.min_by("id", F.xxhash64("id", F.lit(salt))).alias("node"))
    largest = comps.groupBy("band").agg(F.max_by(F.struct("comp", "node"), F.struct("n", "node")).alias("top"), F.count("*").alias("m")).where("m > 1")
    pairs = comps.join(largest.select("band", F.col("top.comp").alias("c"), F.col("top.node").alias("x")), "band").where("comp != c")
    return pairs.select(F.least("node", "x").alias("u"), F.greatest("node", "x").alias("v")).distinct()


def mixed(blocks: DataFrame, stars: DataFrame) -> DataFrame:
    """(band, m) of the blocks that hold more than one component, with their number of nodes."""
    return labelled(blocks, stars).groupBy("band").agg(F.min("comp").alias("a"), F.max("comp").alias("z"), F.count("*").alias("m")).where("a < z").select("band", "m")


def finer_blocks(blocks: DataFrame, nodes: DataFrame, docs: DataFrame, stars: DataFrame, p: JaccardParams) -> DataFrame:
    """``blocks`` with finer ones in the place of those that hold more than one component and over ``block`` nodes.

    Sets of such a block agree on more least hashes before they meet again, so a block of many
    sets that look alike but don't link costs its size, not its square.
    """
    crowded = written(mixed(blocks, stars).where(F.col("m") > p.block).select("band"))
    if crowded.isEmpty():
        return blocks
    deep = replace(p, bands=p.fine_bands, rows=p.fine_rows)

    def run(batches):
        signer = Signer(deep, 40_480)
        for batch in batches:
            for node, own in zip(batch.column("id").to_pylist(), batch.column("shingles"), strict=True):
                keys = signer.keys(own.values.to_numpy().view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), node))], names=["band", "id"])

    inside = blocks.join(crowded, "band", "left_semi").select("id").distinct()
    fine = written(sets_of(inside, nodes, docs, p).mapInArrow(run, "band long, id long"))
    several = fine.groupBy("band").agg(F.count("*").alias("m")).where("m > 1").select("band")
    return written(blocks.join(crowded, "band", "left_anti").select("band", "id").unionByName(fine.join(several, "band", "left_semi")))


def mixed_blocks(blocks: DataFrame, nodes: DataFrame, stars: DataFrame, p: JaccardParams) -> DataFrame:
    """Pairs (u, v) of different components within blocks, through trees over their points."""
    comp = labelled(blocks, stars).join(nodes.select("id", "n", "counts"), "id")
    parts = F.ceil(F.col("m") / p.block).cast("int")
    dealt = comp.join(mixed(blocks, stars).select("band", parts.alias("parts")), "band").withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumns({"x": F.least("own", "with"), "y": F.greatest("own", "with")}).select("band", "x", "y", "id", "comp", "n", "counts")
    dealt = dealt.repartition("band", "x", "y").sortWithinPartitions("band", "x", "y")

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            rest = yield from take(table, False)
        if rest is not None:
            yield from take(rest, True)

    def take(table, last):
        """Work on the groups that are complete; return the rows of the one that may go on."""
        names = [table.column(c).to_numpy() for c in ("band", "x", "y")]
        new = np.append(True, np.any([c[1:] != c[:-1] for c in names], axis=0)) if len(table) else np.empty(0, bool)
        starts = np.flatnonzero(new)
        if not len(starts):
            return None
        upto = len(table) if last else int(starts[-1])
        full = table.slice(0, upto)
        if upto:
            points = _points(full.column("counts"), p.groups)
            ids, comps, sizes = (full.column(c).to_numpy() for c in ("id", "comp", "n"))
            for u, v in block_pairs(ids, comps, sizes, points, starts[starts < upto], p.percent):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])
        return None if last else table.slice(upto)

    return dealt.mapInArrow(run, "u long, v long").distinct()


def link_rows(docs: DataFrame, params: JaccardParams = JaccardParams(), text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: k, a, n, root.

    k is the id (-2^63 if null), a the hash of the text, n the number of shingles; root is the
    smallest (k, a) that links reach, so rows that share an id are told apart.
    """
    p = params
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("a", F.xxhash64("t"))
    signed = written(sign(keyed, p))
    name = ["s1", "s2", "n"]
    nodes = signed.where("n > 0").groupBy(*name).agg(F.min(F.struct("k", "a")).alias("o"), F.first("bands").alias("bands"), F.first("counts").alias("counts"))
    nodes = written(nodes.select(*name, "o.k", "o.a", "bands", "counts").withColumn("id", F.monotonically_increasing_id()))
    bands = nodes.select("id", F.explode("bands").alias("band"))
    led = bands.groupBy("band").agg(F.count("*").alias("m"), F.min_by("id", F.xxhash64("id")).alias("leader")).where("m > 1").drop("m")
    blocks = written(bands.join(led, "band"))
    tried = written(blocks.where("id != leader").select(F.least("id", "leader").alias("u"), F.greatest("id", "leader").alias("v")).distinct())
    blocks, stars = blocks.drop("leader"), components(verified(tried, nodes, keyed, p))
    for salt in range(1, p.star_rounds):
        new = written(component_stars(blocks, stars, salt).join(tried, ["u", "v"], "left_anti"))
        stars = components(stars.unionByName(verified(new, nodes, keyed, p)))
        tried = tried.unionByName(new)
    blocks = finer_blocks(blocks, nodes, keyed, stars, p)
    more = mixed_blocks(blocks, nodes, stars, p).join(tried, ["u", "v"], "left_anti")
    links = written(verified(more, nodes, keyed, p))
    if not links.isEmpty():
        stars = components(stars.unionByName(links))
    rooted = nodes.select(*name, "id", "k", "a").join(stars.select(F.col("u").alias("id"), F.col("v").alias("comp")), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    roots = rooted.join(rooted.groupBy("comp").agg(F.min(F.struct("k", "a")).alias("root")), "comp").select(*name, "root")
    out = signed.select("k", "a", *name).join(roots, name, "left")
    return out.select("k", "a", "n", F.coalesce("root", F.struct("k", "a")).alias("root"))


def link_components(docs: DataFrame, params: JaccardParams = JaccardParams(), text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    component_id is the smallest id that links reach; a null id sorts before all others. Null
    text and text without words have no shingles and no links; equal texts link. Rows may share
    an id. Other columns are ignored. Shingles are compared by 64-bit hashes.
    """
    null_low = lambda c: F.when(c != -(2**63), c)
    rows = link_rows(docs, params, text, id_col)
    return rows.select(null_low(F.col("k")).alias("doc_id"), F.col("n").alias("n_shingles"), null_low(F.col("root.k")).alias("component_id"))
