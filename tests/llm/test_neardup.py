"""Operator 6 against all pairs of exact shingle sets, and its parts."""

import re
import random

import numpy as np
import pytest

from colloquia.llm import components, neardup, queries

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def shingles(text):
    w = [x for x in SPACE.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def plain(rows):
    """rows (id, text) -> sorted (id, n_shingles, component_id)"""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted((i for i in range(len(rows)) if sets[i]), key=lambda i: len(sets[i]))
    for at, i in enumerate(order):
        for j in order[at + 1 :]:
            if 100 * len(sets[i]) < 85 * len(sets[j]):
                break
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return sorted((k, len(sets[i]), least[find(i)]) for i, (k, _) in enumerate(rows))


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_whole_table(spark, sf):
    path = f"/root/testdata/sf{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(rows)
    assert got(queries.op6_jaccard_join(spark, path)) == want
    assert any(k != c for k, _, c in want)


def chains(seed, count, length, edits):
    """Texts drifting from one another, so that many pairs lie about the threshold."""
    rng = random.Random(seed)
    rows, text = [], [f"w{rng.randrange(10_000)}" for _ in range(length)]
    for i in range(count):
        rows.append((i, " ".join(text)))
        text = list(text)
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10_000)}"
    return rows


@pytest.mark.parametrize(("length", "edits"), [(200, 8), (30, 3), (12, 2), (900, 40)])
def test_chains(spark, length, edits):
    rows = chains(length, 120, length, edits)
    small = neardup.JaccardParams(block=16, broadcast_ids=0)
    for params in (neardup.JaccardParams(), small):
        assert got(neardup.link_components(spark.createDataFrame(rows, "doc_id long, text string"), params)) == plain(rows)


def test_many_sets_that_look_alike_but_do_not_link(spark):
    """Forms of one template, filled in differently: blocks are large and nothing in them links but a few pairs."""
    rng = random.Random(8)
    form = [f"t{i}" for i in range(120)]
    rows = [(i, " ".join(form[:at] + [f"f{rng.randrange(10**6)}" for _ in range(8)] + form[at:])) for i, at in ((i, rng.randrange(20, 100)) for i in range(300))]
    rows = [(i, " ".join(w if rng.random() > 0.04 else f"z{rng.randrange(10**6)}" for w in t.split())) for i, t in rows]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(rows)
    assert 5 <= sum(k != c for k, _, c in want) < 60
    for params in (neardup.JaccardParams(block=20), neardup.JaccardParams(block=20, fine_rows=1, fine_bands=32, broadcast_ids=0)):
        assert got(neardup.link_components(docs, params)) == want


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "A b"), (5, "a B"), (6, "a b c"), (7, "a b c d"), (8, "a\x0bb\tc  D"), (9, "é É b c"), (9, "other text entirely here now"), (10, "é É B c"), (10, None), (12, "x " * 40_000)]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, n int, counts string")
    assert got(neardup.link_components(df)) == plain(rows)
    assert neardup.link_components(df.where("false")).count() == 0
    nulls = neardup.link_components(spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in nulls) == [(0, None), (3, None), (3, None)]


def test_tree_loses_no_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 12, (40, 64))
    points = np.repeat(base, 10, axis=0) + (rng.random((400, 64)) < 0.03)
    sizes, comp = points.sum(axis=1), rng.integers(0, 200, 400)
    tree = neardup.CountTree(points, sizes, comp, 85)
    have = {(min(a, b), max(a, b)) for x, y in tree.pairs() for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    want = {(i, j) for i in range(400) for j in range(i + 1, 400) if comp[i] != comp[j] and 185 * np.minimum(points[i], points[j]).sum() >= 85 * (sizes[i] + sizes[j])}
    assert have == want and want


@pytest.mark.parametrize("one_task", [0, 10_000])
def test_components(spark, one_task):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {x: x for p in links for x in p}
    for _ in range(len(links)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    out = {r.u: r.v for r in components.components(spark.createDataFrame(links, "u long, v long"), one_task).collect()}
    assert out == {a: b for a, b in root.items() if a != b}
    assert components.components(spark.createDataFrame([], "u long, v long"), one_task).count() == 0
