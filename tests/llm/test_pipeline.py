"""The corpus pipeline against the brute-force versions of its stages."""

import re

import corpus_pipeline as cp
from colloquia.llm import bpe, common, pii, queries

from .test_leaks import grams, plain as plain_leaks, words
from .test_models import plain_spans
from .test_neardup import plain as plain_links


def test_pipeline(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    judged = {r.doc_id: r for r in queries.op4_language_id(spark, path).collect()}
    ids = [i for i in rows if judged[i].lang_pred != "und" and judged[i].share >= cp.LEAST_LANGUAGE_SHARE]
    # The language stage by what the table says: rows of a labelled language with a letter stay, junk may go.
    assert all(i in set(ids) for i, r in rows.items() if r.lang and r.source != "junk" and re.search("[^\\W\\d_]{3}", r.text or "")) and len(ids) > 0.9 * len(rows)
    ids = [i for i, _, root in plain_links([(i, rows[i].text) for i in ids]) if i == root]
    items = [tuple(r) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    wanted = {g for _, t in items for g in grams(words(t))}
    suspects = [(i, rows[i].text) for i in ids if wanted & set(grams(words(rows[i].text)))]
    leaks = {i for i, _ in plain_leaks(suspects, items)}
    assert leaks
    ids = [i for i in ids if i not in leaks]
    out = {r.doc_id: r for r in cp.run(spark, path).collect()}
    assert sorted(out) == sorted(ids)
    model, (ranks, _) = pii.train(), queries.tokenizer()
    tokens = {v: k for k, v in ranks.items()}
    for i in ids:
        text = pii.redact(rows[i].text, pii.find_spans(model, [rows[i].text])[0])
        assert b"".join(tokens[t] for t in out[i].ids).decode() == text
        left = plain_spans(text)
        assert not left, (i, left)
        assert text == rows[i].text or "[" in text
        assert out[i].n_tokens == len(out[i].ids) and out[i].n_chars == len(text)


def test_stages_keep_columns_and_edges(spark):
    odd = [(1, None, None, "s", 0), (2, "", "en", "s", 0), (3, "123 456", "en", "s", 7), (None, "The thing that other there", "en", "s", 5), (None, "The thing that other there", "en", "s", 5), (5, "zzzz qqqq", None, None, None)]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 60")
    clash = ("42.5 as Score", "'x' as share", "'y' as spans", "7 as _leak_id", "'z' as redacted", "8 as k", "9 as lang_pred", "10 as _share", "11 as text_hash", "12 as root")
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).selectExpr("*", *clash)
    own = [c.split()[-1] for c in clash]
    for name, stage in cp.STAGES[:-1]:
        new = stage(spark, docs, "/root/testdata/sf0.001")
        assert new.columns == docs.columns and new.dtypes == docs.dtypes, name
        assert 0 < new.count() <= docs.count()
        assert new.select(*own).distinct().collect() == docs.select(*own).distinct().collect(), name
        if name != "pii":
            kept = [r for r in new.select("doc_id", "text", "lang", "source", "n_chars").collect()]
            assert set(kept) <= set(docs.select("doc_id", "text", "lang", "source", "n_chars").collect())
        assert stage(spark, docs.where("false"), "/root/testdata/sf0.001").count() == 0
    last = cp.token_stage(spark, docs, "")
    assert last.count() == docs.count() and last.select(*own).distinct().collect() == docs.select(*own).distinct().collect()
    assert bpe.MEMO


def test_written_tables_can_be_dropped(spark):
    kept = common.written(spark.range(3).toDF("id"))
    assert kept.count() == 3
    common.drop_written(spark)
    common.drop_written(spark)
