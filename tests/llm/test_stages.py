"""The pipeline's stages on their own, against all pairs and on rows with odd ids."""

import re

import corpus_pipeline as cp

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def shingles(text, k=5):
    w = [x for x in SPACE.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def least_of_groups(rows):
    """rows (id, text) -> ids that are the smallest of their group at 5 words and 80 %, by all pairs"""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted((i for i in range(len(rows)) if sets[i]), key=lambda i: len(sets[i]))
    for at, i in enumerate(order):
        for j in order[at + 1 :]:
            if 100 * len(sets[i]) < 80 * len(sets[j]):
                break
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return sorted(least.values())


def test_near_copies_by_five_words(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    kept = cp.near_duplicate_stage(spark, docs, path)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == least_of_groups(rows)


def test_appended_words_are_a_near_copy(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(1, text), (2, text + "".join(f" x{i}" for i in range(20))), (3, text + "".join(f" y{i}" for i in range(25)))]  # 96/116 and 96/121
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in cp.near_duplicate_stage(spark, docs, "").collect()) == [1, 3]


def test_rows_that_share_an_id_are_told_apart(spark):
    text = " ".join(f"w{i}" for i in range(100))
    other = " ".join(f"v{i}" for i in range(100))
    rows = [(None, text), (None, text + " x"), (None, text + " y"), (1, other), (7, other + " z"), (7, "own words of seven alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in cp.near_duplicate_stage(spark, docs, "").collect()]
    assert len(kept) == 3 and {r for r in kept if r[0]} == {(1, other), (7, "own words of seven alone here")}
