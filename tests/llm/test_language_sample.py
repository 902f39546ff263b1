"""Operator 4: the labelled sample on odd tables, and the filters against exact n-gram sets."""

import unicodedata
from collections import Counter

import pytest

from colloquia.llm import language

EN, DE = "the cat and the dog are here ", "der hund und die katze sind hier "


def predicted(spark, model, texts):
    got = language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    return [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("one_id", [1, 7, 8, 90])
def test_rows_that_share_an_id(spark, one_id):
    rows = [(one_id, f"{EN}{i}", "en") for i in range(2000)] + [(10_000 + i, f"{DE}{i}", "de") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    params = language.LanguageParams(sample_docs=100)
    sample = {r["l"]: r["count"] for r in language.labelled_sample(docs, "text", "doc_id", "lang", params).groupBy("l").count().collect()}
    assert sample == {"en": 100, "de": 40}
    assert predicted(spark, language.train(docs, params), ["the dog", "der hund"]) == ["en", "de"]


def test_equal_rows_are_one(spark):
    docs = spark.createDataFrame([(5, EN, "en")] * 3000 + [(6, DE, "de")], "doc_id long, text string, lang string")
    sample = language.labelled_sample(docs, "text", "doc_id", "lang", language.LanguageParams()).collect()
    assert sorted(r.l for r in sample) == ["de", "en"]
    assert predicted(spark, language.train(docs), ["the dog", "der hund"]) == ["en", "de"]


def test_four_rows_of_two_languages(spark):
    rows = [(1, "the cat sleeps", "en"), (2, "one dog barks", "en"), (3, "der hund bellt", "de"), (4, "eine katze miaut", "de")]
    m = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert predicted(spark, m, [t for _, t, _ in rows]) == [x for _, _, x in rows]


def test_too_many_labels_raise(spark):
    docs = spark.range(30).selectExpr("id AS doc_id", "'some words' AS text", "'l' || id AS lang")
    with pytest.raises(ValueError, match="more than 20"):
        language.train(docs, language.LanguageParams(max_languages=20))


def plain_grams(text, k=3):
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if unicodedata.category(c)[0] == "L" else " " for c in text)
    words = " ".join(low.split(" ")).split()
    padded = f" {' '.join(words)} " if words else ""
    return [padded[i : i + k] for i in range(len(padded) - k + 1)]


def test_filters_against_exact_sets(spark):
    p = language.LanguageParams()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r for r in docs.select("doc_id", "text", "lang").collect()]
    times, holds, sizes = {}, {}, Counter()
    for text, lang in {(r.text, r.lang, r.doc_id): (r.text, r.lang) for r in rows if r.lang and r.text is not None}.values():
        own = Counter(plain_grams(text))
        times.setdefault(lang, Counter()).update(own)
        holds.setdefault(lang, Counter()).update(own.keys())
        sizes[lang] += 1
    assert max(sizes.values()) <= p.sample_docs
    share = {x: {g: n / sum(c.values()) for g, n in c.items()} for x, c in times.items()}
    member = {x: {g for g, s in own.items() if holds[x][g] >= p.min_share * sizes[x] and s >= p.ratio * max(o.get(g, 0) for o in share.values())} for x, own in share.items()}
    assert max(map(len, member.values())) <= p.max_grams
    m = language.train(docs)
    assert m.languages == sorted(member)
    judge = language.Identifier(m)
    for r in rows:
        grams = plain_grams(r.text or "")
        lang, score, part = judge(r.text)
        assert (lang == language.UNKNOWN) == (not grams)
        if grams:
            exact = {x: sum(g in own for g in grams) / len(grams) for x, own in member.items()}
            assert exact[lang] >= max(exact.values()) - 0.01 and abs(part - exact[lang]) < 0.02
