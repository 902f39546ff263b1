"""Operator 10 against tiktoken, a plain merge loop and exact round trips."""

import hashlib
import random

import pytest

from colloquia.llm import bpe, queries


@pytest.fixture(scope="module")
def made():
    ranks, pattern = queries.tokenizer()
    return ranks, pattern, bpe.Vocabulary.build(ranks)


def test_whole_table(spark, made, tmp_path):
    tiktoken = pytest.importorskip("tiktoken")
    enc = tiktoken.Encoding("own", pat_str=made[1], mergeable_ranks=made[0], special_tokens={})
    odd = [(100001, None), (100002, ""), (100003, "<|endoftext|> \r\n\t  x"), (100004, "🙂" * 70 + "é ıſK"), (100004, "a" * 3000 + "7" * 500), (None, "  　 don't WE'LL")]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    docs.selectExpr("*", "'x' as ids", "1 as decoded", "2 as _ids").write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for r in docs.collect():
        ids = enc.encode_ordinary(r.text or "")
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((str(r.doc_id), len(ids), sha, hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op10_byte_bpe(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


def test_extra_columns_stay(spark, made):
    df = spark.createDataFrame([(1, "ab", "x", 5)], "doc_id long, text string, ids string, _ids int")
    got = bpe.encode_texts(df, made[0], made[1])
    assert got.columns == ["doc_id", "text", "_ids", "ids"] and bpe.decode_ids(got, made[0]).first().decoded == b"ab"
    assert bpe.encode_texts(df.where("false"), made[0], made[1]).count() == 0


def plain(made, data):
    ranks, _, v = made
    parts = [data[i : i + 1] for i in range(len(data))]
    while pairs := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]:
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_appends_and_edits(made):
    rng, encoder = random.Random(5), bpe.Encoder(made[2])
    for _ in range(200):
        data = bytes(rng.choices(b"aaabb the,.\n\xc3\xa9xyz0011", k=rng.randint(0, 60)))
        table = bpe.PrefixTable(encoder, data[:20])
        table.append(data[20:])
        assert table.ids() == plain(made, data)
        a = rng.randint(0, len(data))
        b = rng.randint(a, len(data))
        new = bytes(rng.choices(b"abthe ", k=rng.randint(0, 5)))
        table.replace(a, b, new)
        assert table.data == data[:a] + new + data[b:] and table.ids() == plain(made, table.data)


def test_edit_stays_near(made):
    encoder = bpe.Encoder(made[2])
    table = bpe.PrefixTable(encoder, b"the quick brown fox " * 60)
    assert table.replace(40, 41, b"z") < 200
    assert table.ids() == plain(made, table.data)


@pytest.mark.parametrize("bad", [-1, 10**6])
def test_unknown_ids_raise(spark, made, bad):
    rows = spark.createDataFrame([([bad],)], "ids array<int>")
    with pytest.raises(Exception, match="IndexError"):
        bpe.decode_ids(rows, made[0]).collect()


def test_memo_keeps_no_long_pieces(made):
    memo = bpe._Memo(lambda piece: tuple(piece.encode()))
    assert memo["a" * 10_000] == (97,) * 10_000 and not memo and memo["ab"] == (97, 98) and len(memo) == 1
