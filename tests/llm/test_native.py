"""Operators 1, 2, 3 and 7 against plain Python over whole tables, and their edge cases."""

import hashlib
import math
import re

import pytest

from colloquia.llm import chat, quality, queries, secrets, urls

SPACE = re.compile(r"[\x20\x09-\x0D]+")
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "a b c d e f g h i " * 3), (5, "a b c d e f g h i " * 3), (6, "x\n\nx\nx y\n" * 4),
    (None, "token=abcdefgh"), (7, 'token=secret=abcdefgh token:token: abcdefg Password : "q1w2e3r4" API_KEY=12345'), (8, "AKIA" + "Z" * 16 + " AKIAAKIA" + "9" * 12 + " AKIA12"),
    (9, "é" * 5 + "0123456789abcdef01234567 " + "f" * 23 + " " + "ü0" * 30), (10, "ghp_" + "z" * 36 + " -----BEGIN RSA PRIVATE KEY-----"), (11, "w " * 30000),
]


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("edge")
    rows = [(i, t, "doc", "kinds", [1]) for i, t in EDGES]
    spark.createDataFrame(rows, "doc_id long, text string, doc string, kinds string, spans array<int>").write.parquet(f"{path}/documents.parquet")
    return str(path)


def documents(spark, path):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_quality(text):
    words = [w for w in SPACE.split(text) if w]
    n = len(words)
    at = {}
    for i in range(n - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


@pytest.mark.parametrize("where", ["sf", "edge"])
def test_quality(spark, where, sf_dir, edge_dir):
    path = sf_dir if where == "sf" else edge_dir
    got = queries.op7_quality_rules(spark, path).collect()
    want = sorted((i is not None, i or 0, *plain_quality(t)) for i, t in documents(spark, path))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_line_rules(spark):
    prose = "This is a plain line of ordinary prose that ends well."
    text = "\n".join([prose] * 1 + ["Home | News | Sport | Help", "Licensed under the Apache License, Version 2.0.", "Menu", "Another sentence follows here, with words that nothing above has."])
    row = quality.judge_quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.clean_text == prose + "\n" + "Another sentence follows here, with words that nothing above has." and row.kept
    bar = spark.createDataFrame([(1, prose + "\n" + " | ".join(["word"] * 40))], "doc_id long, text string")
    assert not quality.judge_quality(bar).first().kept


@pytest.mark.parametrize("where", ["sf", "edge"])
def test_secrets(spark, where, sf_dir, edge_dir):
    path = sf_dir if where == "sf" else edge_dir
    got = queries.op2_secret_scan(spark, path).collect()
    want = []
    for i, t in documents(spark, path):
        base = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
        spans = [(m.start(), 0, "assign", m.end()) for m in base.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        spans.sort()
        n = [sum(s[1] == k for s in spans) for k in range(3)]
        want.append((i is not None, i or 0, *n, sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans))))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == sorted(want)
    if where == "edge":
        assert sum("hosting:0:40,pem:41:72" in r.spans for r in got) == 1


def test_trigram_queries():
    q = {r.kind: secrets.trigram_query(r.pattern) for r in secrets.RULES}
    assert q["hex"] == [] and q["access"] == [frozenset({"aki", "kia"})]
    assert frozenset({"tok", "oke", "ken"}) in q["assign"] and frozenset({"api", "pi_", "i_k", "_ke", "key"}) in q["assign"]
    assert all(q[k] for k in ("pem", "chat", "hosting", "jwt"))


def plain_chat(turns):
    out = {}
    for c in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == c), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        own = [(r or "", x or "") for _, _, r, x in own]
        loss = "".join(x for r, x in own if r == "assistant")
        out[c] = (len(own), sha("".join(f"{r}\n{x}\n" for r, x in own)), len(loss), sha(loss))
    return out


def test_chat(spark, tmp_path, sf_dir):
    said = r"\### Assistant: </turn> ok"
    extra = [(900, 0, "user", "x### a: b</turn>\n\\"), (900, 0, "user", None), (900, 2, None, "</turn>"), (901, 5, "a: b\\: </turn>", "#### #### : é🙂"), (901, 5, "assistant", ""), (901, 6, "assistant", "<")]
    extra += [(902, 3, "assistant", "twice")] * 2 + [(None, None, "assistant", "no id")]
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    both = table.unionByName(spark.createDataFrame(extra, table.schema)).selectExpr("*", "turn as message", "role as line", "1 as seq")
    both.write.parquet(str(tmp_path / "conversations.parquet"))
    rows = [tuple(r)[:4] for r in both.collect()] + [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in queries.op1_chat_format(spark, str(tmp_path)).collect()}
    assert got == plain_chat(rows)


def test_fold(spark):
    log = [
        (1, 1, "start", 1, "user", "Hi"), (1, 2, "start", 2, "assistant", "He"), (1, 3, "delta", 2, None, "llo"), (1, 4, "edit", 1, None, "Hi there"), (1, 5, "start", 3, "user", "more"),
        (1, 6, "regenerate", 2, "assistant", "Good"), (1, 7, "delta", 2, None, " day"), (2, 1, "delta", 1, "assistant", None),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, kind string, message long, role string, text string")
    got = sorted(map(tuple, chat.fold_events(events).collect()))
    assert got == [(1, 1, "user", "Hi there"), (1, 2, "assistant", "Good day"), (2, 1, "assistant", "")]


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    m = re.match(r"[^/?#]*", rest)
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[0])
    path = re.match(r"[^?#]*", rest[m.end() :])[0]
    fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=lambda x: len(x[0]), default=None)


def test_urls(spark, tmp_path, sf_dir):
    odd = [None, "", "http://", "x", "HTTP://WWW.Example.NET/en/1?x", "http://net/", "http://a.net", "http://anet/", "http://ÄB.example.com/de/#", "a://b://c/d", "http://o.org?/fr/", "http://o.org/fr/\nx?y"]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()] + [(10000 + i, u) for i, u in enumerate(odd)]
    spark.createDataFrame([(*r, "bad", "x") for r in rows], "page_id long, url string, bad string, host string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r for r in queries.op3_url_filter(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, u in rows:
        host, path, rule = plain_url(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule and rule[0])
        assert got[i].verdict == (rule[1] if rule else "block" if got[i].bad >= 0.5 else "allow")


#: Hosts that stand in no labelled table and no fixture, and that no parameter was chosen by.
BAD_HOSTS = """luckycasino.net pokerroom.com viagraonline.com freespinsnow.com bettingtips.io pornvideos.net adultfriend.com xxxchat.com warezforum.net cheapmeds.org spammail.net replica-bags.com
 slotsmania.com adservers.net trackpixel.io paydayloan.co.uk linkfarm.info jackpots.com pillshop.net freemoneynow.com""".split()
GOOD_HOSTS = """cambridge.org economist.com reuters.com scielo.br rust-lang.org postgresql.org uniprot.org ecb.europa.eu smithsonianmag.com lichess.org archlinux.org duolingo.com bonappetit.com discogs.com
 louvre.fr rijksmuseum.nl tuebingen.de swissinfo.ch cnrs.fr weatherbug.com""".split()


def test_url_model_on_other_hosts(spark):
    weights = urls.train(urls.labelled_urls(spark))
    hosts = [(h, True) for h in BAD_HOSTS] + [(h, False) for h in GOOD_HOSTS]
    rows = spark.createDataFrame([(i, f"https://{h}/a/{i}") for i, (h, _) in enumerate(hosts)], "page_id long, url string")
    got = {r.page_id: r.bad for r in urls.judge_urls(rows, weights, rules=()).collect()}
    wrong = [(hosts[i], round(p, 2)) for i, p in got.items() if (p >= 0.5) != hosts[i][1]]
    assert len(wrong) <= 6, wrong


def plain_score(url, weights, p=urls.UrlModelParams()):
    """The logistic score restated over the hashes of the grams, which the engine gives."""
    host, path, _ = plain_url(url)
    zero = lambda t: re.sub("[0-9]", "0", t)
    grams = lambda t: [t[i : i + p.gram] for i in range(max(1, len(t) - p.gram + 1))]
    return [(g, 1) for g in grams("^" + zero(host) + "$")] + [(g, 2) for g in grams(zero(path))]


def test_url_scores_and_training_by_plain_python(spark):
    p = urls.UrlModelParams(buckets=64, epochs=3)
    table = spark.createDataFrame([(f"http://{w}.com/{i}", float(w in urls.UNWANTED)) for i, w in enumerate((*urls.UNWANTED[:6], *urls.ORDINARY[:6]))], "url string, bad double")
    rows = [tuple(r) for r in table.selectExpr("url", "bad", "xxhash64(url) AS o").collect()]
    pairs = {g for u, _, _ in rows for g in plain_score(u, None, p)}
    bucket = {(r.g, r.s): r.b for r in spark.createDataFrame(list(pairs), "g string, s int").selectExpr("g", "s", f"pmod(xxhash64(g, s), {p.buckets}) AS b").collect()}
    w = [0.0] * (p.buckets + 1)

    def logit(x):
        return sum(w[i] for i in x) / math.sqrt(max(1, len(x))) + w[-1]

    feats = {u: sorted({bucket[g] for g in plain_score(u, None, p)}) for u, _, _ in rows}
    for e in range(p.epochs):
        for u, y, _ in sorted(rows, key=lambda r: r[2]):
            x = feats[u]
            error = y - 1 / (1 + math.exp(-logit(x)))
            rate = p.rate / (1 + 0.2 * e)
            for i in x:
                w[i] += error * rate / math.sqrt(len(x))
            w[-1] += error * rate * 0.1
    have = urls.train(table, p)
    assert len(have) == len(w) and all(abs(a - b) < 1e-9 for a, b in zip(have, w, strict=True))
    pages = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(rows)], "page_id long, url string")
    for r in urls.judge_urls(pages, have, (), p).collect():
        assert abs(r.bad - 1 / (1 + math.exp(-logit(feats[rows[r.page_id][0]])))) < 1e-9 and r.verdict == ("block" if r.bad >= 0.5 else "allow")


def test_empty_tables(spark, tmp_path, sf_dir):
    for name in ("documents", "conversations", "pages"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").where("false").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert queries.op1_chat_format(spark, str(tmp_path)).count() == 1
    for query in (queries.op2_secret_scan, queries.op3_url_filter, queries.op7_quality_rules):
        assert query(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_turns_are_streamed(spark, chunk):
    turns = [(1, 0, "user", "abcdefg"), (1, 1, None, None), (1, 2, "assistant", "é" * 9), (1, 2, "assistant", ""), (2, None, "user", "x" * 10_000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    log = chat.log_of_turns(df, chunk=chunk)
    assert log.where("kind = 'delta'").count() == sum(-(-len(t[3] or "") // chunk) for t in turns)
    got = sorted((r.conv_id, r.message, r.role, r.text) for r in chat.fold_events(log).collect())
    assert got == [(1, 1, "user", "abcdefg"), (1, 2, "", ""), (1, 3, "assistant", ""), (1, 4, "assistant", "é" * 9), (2, 1, "user", "x" * 10_000)]
