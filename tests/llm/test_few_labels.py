"""Operator 4 on languages with few labelled rows."""

from colloquia.llm import language


def test_three_labelled_rows_make_a_language(spark):
    rows = [(i, "the cat and the dog are here " * 3, "en") for i in range(40)]
    rows += [(100 + i, "der hund und die katze sind hier " * 3, "de") for i in range(3)] + [(200, "le chien et le chat sont ici " * 3, "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = language.train(docs)
    got = language.identify(spark.createDataFrame([(1, "the dog"), (2, "der hund und"), (3, "le chien et")], "doc_id long, text string"), m).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id)] == ["en", "de", "fr"]
    assert all(r.share > 0.9 for r in got)
