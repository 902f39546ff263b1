"""Operator 8 against every window of every document, and its edges."""

import re
from collections import Counter

import numpy as np

from colloquia.llm import decontaminate, queries

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split((text or "").lower()) if w]


def grams(w, k=5):
    return Counter([tuple(w)] if len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def plain(docs, items, least=0.8):
    out = {}
    for d, t in docs:
        w = words(t)
        for i, u in items:
            v = words(u)
            if not v or not w:
                continue
            want = grams(v)
            best = max((sum((g & want).values()) / sum((g | want).values()) for g in (grams(w[s : s + len(v)]) for s in range(max(1, len(w) - len(v) + 1)))), default=0)
            if best >= least:
                out[d, i] = best
    return out


def test_table(spark):
    path = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    have = [(d, w) for d, w in docs if set(words(w)) & {x for _, t in items for x in words(t)}]
    shared = {(d, i) for d, t in have for i, u in items if set(grams(words(t))) & set(grams(words(u)))}
    want = plain([d for d in docs if any(d[0] == s[0] for s in shared)], items)
    got = {(r.doc_id, r.item_id): r.similarity for r in queries.op8_decontaminate(spark, path).collect()}
    assert got.keys() == want.keys() and want
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_edges(spark):
    rng = np.random.default_rng(3)
    pick = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 500, n))
    a, b, c = pick(40), pick(30), "Only Three words"
    aw = a.split()
    docs = [
        (1, None), (2, ""), (3, pick(50) + " " + a.upper() + "\n" + pick(20)), (4, " ".join(aw[:20] + ["zzz"] + aw[20:])), (5, " ".join(aw[:36])), (6, " ".join(aw[:20])), (7, pick(5) + "\tonly THREE   words " + pick(5)),
        (8, b + " " + b), (8, a), (None, b), (9, b), (9, b), (10, "only three"), (11, "x " * 5000 + b),
    ]
    items = [(1, a), (2, b), (3, c), (4, None), (5, " "), (6, a), (7, "x " * 30)]
    d = spark.createDataFrame([(*x, 1, "q") for x in docs], "doc_id long, text string, item_id int, h string")
    i = spark.createDataFrame([(*x, "q") for x in items], "item_id long, text string, doc_id string")
    got = sorted((r.doc_id or -1, r.item_id, round(r.similarity, 6)) for r in decontaminate.find_leaks(d, i).collect())
    want = {}
    for x, t in docs:
        for (_, item), s in plain([(x, t)], items).items():
            want.setdefault((x or -1, t), {})[item] = round(s, 6)
    assert got == sorted((x, item, s) for (x, _), found in want.items() for item, s in found.items())
    kept = decontaminate.drop_leaks(d, decontaminate.find_leaks(d, i))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6, 10]
    assert decontaminate.find_leaks(d.where("false"), i).count() == 0 == decontaminate.find_leaks(d, i.where("false")).count()
    many = decontaminate.LeakParams(broadcast_shingles=0)
    assert sorted((r.doc_id or -1, r.item_id, round(r.similarity, 6)) for r in decontaminate.find_leaks(d, i, many).collect()) == got


def test_index_guarantees_the_radius(spark):
    rng = np.random.default_rng(4)
    p = decontaminate.LeakParams()
    rows = []
    for n in range(60):
        x = int(rng.integers(-(2**63), 2**63 - 1))
        flips = rng.choice(64, p.radius, replace=False)
        y = (x & (2**64 - 1)) ^ sum(1 << int(f) for f in flips)
        rows.append((n, x, y - 2**64 if y >= 2**63 else y))
    df = spark.createDataFrame(rows, "n int, x long, y long")
    index = decontaminate.indexed(df.select("n", "x"), "x", p)
    assert index.where("n = 0").count() == 10_068
    asked = df.select("n", decontaminate.F.explode(decontaminate.block_keys(df.y, p.blocks)).alias("key"))
    assert asked.join(index, ["n", "key"]).select("n").distinct().count() == 60


def test_columns_may_clash(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "x " + item, 5, 6, 7, "a"), (2, "clean text", 8, 9, 10, "b")], "doc_id long, text string, _leak_id int, _leak_hash int, text_hash int, W string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontaminate.drop_leaks(docs, decontaminate.find_leaks(docs, bench))
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "clean text", 8, 9, 10, "b")]


def test_long_item_with_repeats(spark):
    item = " ".join(["a b c d e f"] * 300)
    docs = spark.createDataFrame([(1, item), (2, "a b c d e f " * 280)], "doc_id long, text string")
    got = decontaminate.find_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted((r.doc_id, round(r.similarity, 3)) for r in got.collect()) == [(1, 1.0), (2, 0.933)]
