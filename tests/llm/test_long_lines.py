"""Operator 7: boilerplate wording in plain and in linear form, and very long lines."""

import random
import re
import time

import pytest

from colloquia.llm import oracles, quality


def test_both_forms_agree(spark):
    rng = random.Random(4)
    parts = ["under the ", "Under The ", "licence", "LICENSE", "x ", ".", "-", "é", "MIT ", "under", " the ", "licensed under", "ü ", "copyright (c)"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for i in range(6000)]
    got = spark.createDataFrame(rows, "i int, s string").select("i", quality.boilerplate(quality.F.col("s")).alias("hit")).collect()
    plain = re.compile(oracles.BOILERPLATE, re.ASCII)
    assert all(r.hit == bool(plain.search(rows[r.i][1])) for r in got) and len({r.hit for r in got}) == 2


@pytest.mark.parametrize("piece", ["under the ", "licensed ", "a ", ". ", "| ", "terms of ", "under the licen "])
def test_long_lines(spark, piece):
    docs = spark.createDataFrame([(1, piece * 40_000)], "doc_id long, text string")
    began = time.time()
    row = quality.judge_quality(docs).collect()[0]
    assert row.n_words == len((piece * 40_000).split()) and row.base_failed
    assert time.time() - began < 30
