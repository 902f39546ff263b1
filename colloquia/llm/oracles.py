"""SQL twins, for DuckDB, of the operators that SQL can express."""

from __future__ import annotations

from . import quality, secrets

WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def chat() -> str:
    said = quoted(r"\### Assistant: </turn> ok")
    esc = r"replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ')"
    return f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -7, 0, 'user', {said} UNION ALL SELECT -7, 1, 'assistant', {said}),
 g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS t,
 coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS l, CAST(sum(length(role) + length({esc}) + 14) AS BIGINT) AS formatted_chars FROM turns GROUP BY conv_id)
 SELECT conv_id, n_turns, sha256(t) AS turns_sha256, length(l) AS loss_chars, sha256(l) AS loss_sha256, formatted_chars FROM g"""


def secret_scan() -> str:
    parts = []
    for i, r in enumerate(secrets.RULES):
        rx = quoted(r.pattern)
        start = "CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0) AS BIGINT)"
        keep = f"list_filter(range(1, len(h) + 1), lambda i: length(g[i]) >= {r.min_chars})"
        parts.append(f"(SELECT list_transform({keep}, lambda i: {{'s': {start}, 'o': {i}, 'k': '{r.kind}', 'e': {start} + length(h[i])}}) FROM (SELECT string_split_regex(t, {rx}) AS p, regexp_extract_all(t, {rx}) AS h, regexp_extract_all(t, {rx}, {1 if r.min_chars else 0}) AS g))")
    every = parts[0]
    for p in parts[1:]:
        every = f"list_concat({every}, {p})"
    text = "array_to_string(list_transform({x}, lambda s: s.k || ':' || CAST(s.s AS VARCHAR) || ':' || CAST(s.e AS VARCHAR)), ',')"
    base = "list_filter(x, lambda s: s.o < 3)"
    counts = ", ".join(f"CAST(len(list_filter(x, lambda s: s.o = {i})) AS BIGINT) AS n_{r.kind}" for i, r in enumerate(secrets.BASE_RULES))
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS (SELECT doc_id, list_sort({every}) AS x FROM d)
 SELECT doc_id, {counts}, sha256(coalesce({text.format(x=base)}, '')) AS base_sha256, coalesce({text.format(x="x")}, '') AS spans FROM f"""


def jaccard() -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(text=low)} AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM d)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
 JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 85 * (p.n + q.n - i)),
 reach AS (SELECT doc_id AS id, doc_id AS r FROM documents UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.id)
 SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.r AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(r) AS r FROM reach GROUP BY id) c ON c.id = d.doc_id"""


#: The line wording of operator 7 in plain form, for an engine whose patterns always take linear time.
BOILERPLATE = (
    r"(?i)(licen[sc]ed under|under the [a-z0-9 .-]*licen[sc]e|all rights reserved|copyright \(c\)|creative commons"
    r"|cookie policy|privacy policy|terms of (use|service)|subscribe to our|javascript is disabled)"
)


def quality_rules() -> str:
    r = quality.QualityRules()
    solid = r"regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')"
    stub = r"[.!?:;…。！？][\x20\x09-\x0D\"')\]»”]*$"
    fails = f"""(length({solid}) > 0 AND (length(regexp_replace({solid}, '[^#*$%&|<>!]+', '', 'g')) * 100 > length({solid}) * {r.max_symbol_percent}
 OR length(regexp_replace({solid}, '[^|]+', '', 'g')) * 100 > len({WORDS.format(text="line")}) * {r.max_pipe_percent} OR regexp_matches(line, {quoted(BOILERPLATE)})
 OR (len({WORDS.format(text="line")}) < {r.stub_words} AND NOT regexp_matches(line, {quoted(stub)}))))"""
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
 win AS (SELECT doc_id, i, array_to_string(w[i:i + {r.window - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {r.window - 2})) AS i FROM d)),
 again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win),
 rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + {r.window})) AS p FROM again WHERE c > 1) GROUP BY doc_id),
 lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
 l AS (SELECT doc_id, count(*) FILTER (length({solid}) > 0) - count(DISTINCT line) FILTER (length({solid}) > 0) AS n_dup_lines, sum(CASE WHEN {fails} THEN 0 ELSE len({WORDS.format(text="line")}) END) AS clean FROM lines GROUP BY doc_id),
 o AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, l.n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, l.clean
 FROM d JOIN l USING (doc_id) LEFT JOIN rep USING (doc_id)),
 b AS (SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words AS base_failed FROM o)
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND (n_words - clean) * 100 <= n_words * {r.max_lost_percent} AS kept FROM b"""


def substrings(length: int = 20) -> str:
    return f"""WITH d AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
 win AS (SELECT doc_id, s, array_to_string(w[s:s + {length - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {length - 2})) AS s FROM d)),
 later AS (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS r FROM win),
 gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + {length})) AS p FROM later WHERE r > 1),
 words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
 kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
 SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""


def decontaminate() -> str:
    """Each window laid around a shared shingle, against each item of its length, without fingerprints."""
    grams = "CASE WHEN len({w}) < 5 THEN [array_to_string({w}, ' ')] ELSE list_transform(range(1, len({w}) - 3), lambda i: array_to_string({w}[i:i + 4], ' ')) END"
    seeds = "CASE WHEN len({w}) < {k} THEN [] ELSE list_transform(range(1, len({w}) - {k} + 2), lambda i: array_to_string({w}[i:i + {k} - 1], ' ')) END"
    return f"""WITH d AS (SELECT DISTINCT doc_id, text, {WORDS.format(text="lower(coalesce(text, ''))")} AS w FROM documents),
 b AS (SELECT DISTINCT item_id, w, len(w) AS m, least(len(w), 5) AS k FROM (SELECT item_id, {WORDS.format(text="lower(coalesce(text, ''))")} AS w FROM benchmark) WHERE len(w) > 0),
 bs AS (SELECT m, k, unnest(s) AS g, generate_subscripts(s, 1) AS p FROM (SELECT m, k, {seeds.format(w="w", k="k")} AS s FROM b)),
 ds AS (SELECT doc_id, text, len(w) AS n, k, unnest(s) AS g, generate_subscripts(s, 1) AS p FROM (SELECT d.*, k, {seeds.format(w="w", k="k")} AS s FROM d, (SELECT DISTINCT k FROM b))),
 laid AS (SELECT DISTINCT doc_id, text, m, greatest(0, least(ds.p - bs.p, n - m)) AS s0 FROM ds JOIN bs USING (k, g)),
 win AS (SELECT row_number() OVER () AS id, doc_id, text, s0, m, {grams.format(w="ww")} AS g FROM (SELECT doc_id, text, s0, m, w[s0 + 1:s0 + m] AS ww FROM laid JOIN d USING (doc_id, text))),
 it AS (SELECT row_number() OVER () AS i, item_id, m, {grams.format(w="w")} AS g FROM b),
 wc AS (SELECT id, m, x, count(*) AS c FROM (SELECT id, m, unnest(g) AS x FROM win) GROUP BY ALL), ic AS (SELECT i, m, x, count(*) AS c FROM (SELECT i, m, unnest(g) AS x FROM it) GROUP BY ALL),
 met AS (SELECT id, i, sum(least(wc.c, ic.c)) AS s FROM wc JOIN ic USING (m, x) GROUP BY id, i),
 good AS (SELECT doc_id, text, item_id, s0, id, CAST(s AS DOUBLE) / (len(win.g) + len(it.g) - s) AS similarity FROM met JOIN win USING (id) JOIN it USING (i) WHERE CAST(s AS DOUBLE) / (len(win.g) + len(it.g) - s) >= 0.8)
 SELECT doc_id, item_id, count(DISTINCT id) AS n_windows, CAST(arg_min(s0, {{'a': -similarity, 'b': s0}}) AS INTEGER) AS at_word, round(max(similarity), 9) AS similarity FROM good GROUP BY doc_id, text, item_id"""


ORACLES = {
    "op1_chat_format": chat(),
    "op2_secret_scan": secret_scan(),
    "op6_jaccard_join": jaccard(),
    "op7_quality_rules": quality_rules(),
    "op8_decontaminate": decontaminate(),
    "op9_substring_dedup": substrings(),
}
