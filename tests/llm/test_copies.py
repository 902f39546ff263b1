"""Operator 9 against a plain restatement, with edges."""

import hashlib

import pytest

from colloquia.llm import queries, substrings


def plain(rows, length=20):
    """rows: (doc_id, text) in order of id; later equal windows lose their words."""
    first, out = {}, []
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    for at, (_, w) in enumerate(docs):
        for s in range(len(w) - length + 1):
            first.setdefault(tuple(w[s : s + length]), (at, s))
    for at, (i, w) in enumerate(docs):
        gone = set()
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] < (at, s):
                gone.update(range(s, s + length))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_whole_table(spark, sf):
    path = f"/root/testdata/sf{sf}"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect())
    got = queries.op9_substring_dedup(spark, path).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == plain(rows)


def test_edges(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [
        (1, None), (2, ""), (3, " ".join(words[:19])), (4, " ".join(words[:19])), (5, " ".join(words[:40])), (6, "x " + "\t".join(words[10:30]) + "\x0b\n y"), (7, "a " * 50),
        (8, " ".join(words[:40])), (9, "é b " * 21), (10, " ".join(["q"] * 5 + words)), (11, " ".join(words[1:21])),
    ]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n_words int, _key string")
    got = substrings.remove_repeats(df)
    assert got.columns == ["doc_id", "_key", "text", "n_words", "n_removed", "kept_text"]
    have = sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got.collect())
    assert have == plain(rows)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (3, text), (3, text), (4, "z " + text), (None, text)]
    got = sorted((r.doc_id or 0, r.n_removed) for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 0), (0, 0), (3, 30), (3, 30), (4, 30)]
    twice = sorted(r.n_removed for r in substrings.remove_repeats(spark.createDataFrame([(3, text)] * 2, "doc_id long, text string")).collect())
    assert twice == [0, 0]


def test_empty(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_other_lengths(spark):
    rows = [(i, " ".join(f"v{(i * 7 + j * j) % 23}" for j in range(40))) for i in range(12)]
    for length in (2, 3, 5, 8, 13):
        got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length)
        have = sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got.collect())
        assert have == plain(rows, length)


def test_passages_double_until_none_survives(spark):
    words = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(words[:100])), (2, " ".join(["x"] + words[20:100])), (3, " ".join(words[200:230])), (4, "y " + " ".join(words[205:230])), (5, " ".join(words[150:190])), (5, " ".join(words[150:190])), (None, " ".join(words[0:11]))]
    got = {tuple(r) for r in substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), 10).drop("text_hash").collect()}
    want, length = set(), 10
    docs = {i: t.split() for i, t in rows}
    while True:
        places = {}
        for i, w in docs.items():
            for s in range(len(w) - length + 1):
                places.setdefault(tuple(w[s : s + length]), []).append((i, s, length))
        level = {p for own in places.values() if len(own) > 1 for p in own}
        if not level:
            break
        want |= level
        length *= 2
    assert got == want and max(x[2] for x in got) == 80


def test_windows_that_many_texts_hold(spark, monkeypatch):
    """Passages in nearly every text, in one slice or in many: the rows are the same, and few windows meet."""
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join([f"a{i}"] * (i % 3) + words[: 25 + i % 40] + [f"b{i}", f"b{i * 7}"])) for i in range(60)] + [(100, " ".join(words[:60] * 2)), (None, " ".join(words[5:50])), (101, " ".join(words[5:50]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(sorted(rows, key=lambda r: -1 if r[0] is None else r[0]))
    for parts in (1, 5, 40):
        got = substrings.remove_repeats(docs.repartition(parts)).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got), key=lambda r: -1 if r[0] is None else r[0]) == want
    many = docs.where("doc_id IS NOT NULL").selectExpr("doc_id AS k", "xxhash64(text) AS a", "text AS t", "false AS gone").coalesce(1)
    seen = substrings.level_windows(many, 20, 0, "k", "a", "t", "gone", None, True)
    assert seen.groupBy("p").count().agg({"count": "max"}).first()[0] == 1


def test_null_ids_are_spread(spark):
    rows = [(None, " ".join(f"v{i}x{j}" for j in range(40))) for i in range(200)] + [(1, " ".join(f"v3x{j}" for j in range(40)) + " y")]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    assert {(r.doc_id, r.n_removed) for r in got.collect()} == {(None, 0), (1, 40)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 100


def test_a_row_listed_very_often(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(7, text)] * 300 + [(9, text)] * 3 + [(2, "q " + text), (7, "other " * 30)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted({(r.doc_id, r.n_words, r.n_removed) for r in got}) == [(2, 31, 0), (7, 30, 29), (7, 30, 30), (9, 30, 30)] and len(got) == len(rows)
