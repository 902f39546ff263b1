"""Answer parsing where white space, word ends and case are beyond ASCII, against the standard library's rules."""

from colloquia.functions import mcq

CASES = {
    "A\u00a0because": ["A"], "option\u2003c": ["C"], "The answer\u00a0is\u00a0D": ["D"], "[\u00a0b\u00a0]": ["B"], "option A\u00e9": ["A"], "see option A\u00e9": ["A"], "A\u00e9": [], "(A)\u00a0(B)": ["A", "B"],
    "x option\u00a0B, (C)": ["B"], "\u3000e\u3000": ["E"], "ANSWER: f": ["F"], "picks nothing": [], "(a)(b)": [],
}


def test_letters(spark):
    rows = list(enumerate(CASES))
    got = spark.createDataFrame(rows, "i int, s string").select("i", mcq.predicted(mcq.F.col("s")).alias("p"), mcq.truth(mcq.F.col("s")).alias("t")).collect()
    assert {rows[r.i][1]: r.p for r in got} == CASES
    assert {rows[r.i][1]: r.t for r in got}["A\u00a0because"] == ["A"]
