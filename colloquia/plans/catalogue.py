"""Registered queries over the reference-side operators, each with its SQL twin.

Every query runs over its whole tables. Inputs that the tables lack are derived by arithmetic
(``derived``) in both engines.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import mcq, text
from ..operators import questions as q
from ..operators import ranking, transcript
from ..sources import nested, sinks
from ..streaming import blind as stream
from . import ablation, full_context, perturb, pipeline
from . import derived as d
from .pipeline import Responses
from .provider import recorded, totals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


# Conversations


@query("SELECT count(DISTINCT conv_id) AS conversations, count(DISTINCT (conv_id, turn // 3)) AS sessions, count(*) AS turns, count(*) AS questions FROM conversations")
def dataset_stats(spark, sf):
    turns = d.turns(spark, sf)
    return transcript.dataset_stats(turns.select("record_idx").distinct(), turns, d.qa_items(spark, sf))


@query("SELECT conv_id, count(*) AS n_turns, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations GROUP BY conv_id")
def turns_per_conversation(spark, sf):
    return d.conversations(spark, sf).groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.sum(F.length("text")).alias("n_chars"))


@query("SELECT role, count(*) AS n FROM conversations GROUP BY role")
def role_counts(spark, sf):
    return d.conversations(spark, sf).groupBy("role").agg(F.count("*").alias("n"))


SESSIONS_SQL = f"""WITH {d.TURNS_SQL}, parts AS (SELECT record_idx, session_no, chr(10) || '--- Turn started at ' || coalesce(max(session_ts), 'Unknown time') || ' ---' || chr(10)
 || string_agg(speaker || ': ' || text, chr(10) ORDER BY turn_idx) AS part FROM turns GROUP BY record_idx, session_no),
 whole AS (SELECT record_idx, {strip_sql("string_agg(part, chr(10) ORDER BY session_no)")} AS t FROM parts GROUP BY record_idx)"""


@query(f"{SESSIONS_SQL} SELECT record_idx, md5(t) AS md5, length(t) AS n_chars FROM whole")
def transcript_md5(spark, sf):
    whole = transcript.session_transcript(d.turns(spark, sf))
    return whole.select("record_idx", F.md5(F.encode("transcript", "utf-8")).alias("md5"), F.length("transcript").cast("long").alias("n_chars"))


@query(f"{SESSIONS_SQL} SELECT record_idx, md5(array_to_string(string_split(t, chr(10))[1:5], chr(10))) AS md5 FROM whole")
def transcript_head_trim(spark, sf):
    whole = transcript.session_transcript(d.turns(spark, sf))
    return whole.select("record_idx", F.md5(F.encode(transcript.head_lines(F.col("transcript"), 5), "utf-8")).alias("md5"))


@query(f"""WITH {d.TURNS_SQL}, parts AS (SELECT record_idx, session_no, chr(10) || '--- Turn started at ' || coalesce(max(session_ts), 'Unknown time') || ' ---' || chr(10)
 || string_agg(CASE WHEN speaker = 'user' THEN 'user' ELSE 'assistant' END || ': ' || text, chr(10) ORDER BY turn_idx) AS part FROM turns GROUP BY record_idx, session_no)
 SELECT record_idx, md5(string_agg(part, chr(10) ORDER BY session_no)) AS md5 FROM parts GROUP BY record_idx""")
def transcript_two_party(spark, sf):
    keyed = d.turns(spark, sf).withColumns({"key_idx": F.col("session_no"), "speaker_a": F.lit("user"), "speaker_b": F.lit("assistant")})
    return transcript.two_party_transcript(keyed).select("record_idx", F.md5(F.encode("transcript", "utf-8")).alias("md5"))


@query("""SELECT name, row_number() OVER (ORDER BY conv_id, turn, name) AS position FROM
 (SELECT role AS name, min(conv_id * 1000 + turn) // 1000 AS conv_id, min(conv_id * 1000 + turn) % 1000 AS turn FROM conversations GROUP BY role)""")
def speaker_first_seen(spark, sf):
    speakers = d.turns(spark, sf).select("record_idx", F.col("turn_idx").alias("ordinal"), F.concat(F.lit(" "), "speaker", F.lit("\t")).alias("name"))
    return transcript.first_appearance(speakers).withColumn("position", F.col("position").cast("long"))


@query(f"WITH {d.TURNS_SQL} SELECT record_idx, session_no, turn_idx, dense_rank() OVER (ORDER BY record_idx, session_no) AS global_session FROM turns")
def session_renumber(spark, sf):
    return transcript.renumber_sessions(d.turns(spark, sf)).select("record_idx", "session_no", "turn_idx", "global_session")


@query("""SELECT key, row_number() OVER (ORDER BY try_cast(key AS BIGINT) IS NULL, try_cast(key AS BIGINT), key) AS position FROM
 (SELECT CASE WHEN conv_id % 3 = 0 THEN 'k' || CAST(conv_id AS VARCHAR) ELSE CAST(conv_id AS VARCHAR) END AS key FROM conversations GROUP BY conv_id)""")
def mixed_key_order(spark, sf):
    key = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("k"), F.col("conv_id").cast("string"))).otherwise(F.col("conv_id").cast("string"))
    keys = d.conversations(spark, sf).select("conv_id").distinct().select(key.alias("key"))
    number = F.col("key").try_cast("double")
    return ranking.global_rank(keys.withColumn("_n", number), "_n", ["key"], "position", start=1).drop("_n")


EVIDENCE_SQL = f"""WITH {d.TURNS_SQL}, {d.QA_SQL}, evidence AS (
 SELECT conv_id AS record_idx, qid, 'D' || CAST(conv_id AS VARCHAR) || ':' || CAST((turn + 1) % 4 AS VARCHAR) AS dia_id, NULL AS utterance FROM qa
 UNION ALL SELECT conv_id, qid, 'N/A', 'see session_' || CAST(turn + 1 AS VARCHAR) || '_date_time' FROM qa)"""


def _evidence(spark, sf):
    qa = d.qa_items(spark, sf)
    named = qa.select(F.col("conv_id").alias("record_idx"), "qid", F.concat(F.lit("D"), F.col("conv_id").cast("string"), F.lit(":"), ((F.col("turn") + 1) % 4).cast("string")).alias("dia_id"), F.lit(None).cast("string").alias("utterance"))
    times = qa.select(F.col("conv_id").alias("record_idx"), "qid", F.lit("N/A").alias("dia_id"), F.concat(F.lit("see session_"), (F.col("turn") + 1).cast("string"), F.lit("_date_time")).alias("utterance"))
    return named.unionByName(times)


@query(f"""{EVIDENCE_SQL} SELECT k.qid, t.record_idx, t.turn_idx, CASE WHEN z.qid IS NULL THEN t.session_ts END AS session_ts FROM (SELECT DISTINCT record_idx, qid FROM evidence) k
 JOIN turns t USING (record_idx) LEFT JOIN (SELECT DISTINCT qid, CAST(regexp_extract(utterance, 'session_(\\d+)_date_time', 1) AS INTEGER) AS s FROM evidence WHERE dia_id = 'N/A') z
 ON z.qid = k.qid AND z.s = t.session_no WHERE NOT EXISTS (SELECT 1 FROM evidence e WHERE e.qid = k.qid AND e.dia_id = t.dia_id AND e.dia_id <> 'N/A')""")
def transcript_without_evidence(spark, sf):
    return transcript.without_evidence(d.turns(spark, sf), _evidence(spark, sf)).select("qid", "record_idx", "turn_idx", "session_ts")


@query(f"""{EVIDENCE_SQL} SELECT e.qid, count(*) AS n_evidence, count(t.dia_id) AS n_found FROM evidence e LEFT JOIN turns t ON t.record_idx = e.record_idx AND t.dia_id = e.dia_id GROUP BY e.qid""")
def evidence_turn_coverage(spark, sf):
    turns = d.turns(spark, sf).select("record_idx", "dia_id", F.lit(True).alias("found"))
    return _evidence(spark, sf).join(turns, ["record_idx", "dia_id"], "left").groupBy("qid").agg(F.count("*").alias("n_evidence"), F.count("found").alias("n_found"))


# Evidence checks


@query(f"WITH {d.VERSIONS_SQL} SELECT version, qid FROM versions WHERE check_result = 'right' AND NOT late_right")
def sufficiency_filter(spark, sf):
    return d.versions(spark, sf).where(q.sufficient(F.col("check_result"), F.col("ablation"))).select("version", "qid")


@query(f"""WITH {d.RESPONSES_SQL}, judged AS (SELECT qid, round, CASE WHEN answer = response_option THEN 'right' ELSE 'wrong' END AS result, (qid + round) % 4 AS n_used FROM responses WHERE round <= 5),
 stops AS (SELECT *, min(CASE WHEN result = 'wrong' OR n_used = 0 THEN round END) OVER (PARTITION BY qid ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM judged)
 SELECT qid, round, result FROM stops WHERE s IS NULL""")
def ablation_stop(spark, sf):
    rounds = d.blind_responses(spark, sf).select("qid", "round", "answer", F.col("response_option").alias("response"), ((F.col("qid") + F.col("round")) % 4).alias("n_used"))
    return q.ablation_rounds(rounds).select("qid", "round", "result")


@query(f"WITH {d.VERSIONS_SQL} SELECT version, coalesce(check_result, '') = 'right' AS pending, count(*) AS n FROM versions GROUP BY 1, 2")
def evidence_pending_split(spark, sf):
    rows = d.versions(spark, sf).withColumn("pending", F.coalesce("check_result", F.lit("")) == "right")
    return rows.groupBy("version", "pending").agg(F.count("*").alias("n"))


# Options


SHUFFLE_SQL = f"""WITH {d.OPTIONS_SQL}, ae AS (SELECT *, list_filter(bodies, lambda o: o[1:2] <> 'F.') AS ae, list_filter(bodies, lambda o: o[1:2] = 'F.') AS f FROM items),
 parts AS (SELECT qid, answer, question, ae, f, unnest(ae) AS o, generate_subscripts(ae, 1) - 1 AS i FROM ae),
 ranked AS (SELECT *, substr(o, 4) AS body, row_number() OVER (PARTITION BY qid ORDER BY md5('s1|' || CAST(qid AS VARCHAR) || '|' || CAST(i AS VARCHAR)), i) AS r FROM parts),
 mixed AS (SELECT qid, any_value(answer) AS answer, any_value(question) AS question, any_value(ae) AS ae, any_value(f) AS f,
 list(substr('ABCDE', CAST(r AS INTEGER), 1) || '. ' || body ORDER BY r) AS lettered, list(body ORDER BY r) AS bodies FROM ranked WHERE r <= 5 GROUP BY qid),
 keyed AS (SELECT *, CASE WHEN ascii(answer) - 64 <= len(ae) THEN substr(ae[ascii(answer) - 64], 4) ELSE answer END AS body FROM mixed),
 done AS (SELECT *, list_concat(lettered, CASE WHEN len(f) > 0 THEN f ELSE ['{text.CANNOT_INFER}'] END) AS new_option,
 CASE WHEN len(f) > 0 AND answer = 'F' THEN f[1] ELSE coalesce(lettered[list_position(bodies, body)], answer) END AS new_answer FROM keyed)"""


def _shuffled(spark, sf):
    return q.shuffle_options(d.option_items(spark, sf).withColumnRenamed("bodies", "option"), "s1")


@query(f"{SHUFFLE_SQL} SELECT qid, array_to_string(new_option, '|') AS options, len(new_option) AS n_options FROM done")
def option_shuffle(spark, sf):
    return _shuffled(spark, sf).select("qid", F.array_join("new_option", "|").alias("options"), F.size("new_option").cast("long").alias("n_options"))


@query(f"{SHUFFLE_SQL} SELECT qid, new_answer, md5(question || chr(10) || array_to_string(new_option, chr(10)) || chr(10) || '{text.INSTRUCTION}') AS rendered_md5 FROM done")
def answer_remap(spark, sf):
    return _shuffled(spark, sf).select("qid", "new_answer", F.md5(F.encode("rendered_question", "utf-8")).alias("rendered_md5"))


BARE_SQL = """list_transform(range(0, len(bodies)), lambda i: CASE WHEN (qid + i) % 2 = 0 THEN bodies[i + 1] ELSE substr(bodies[i + 1], 4) END)"""


def _bare(spark, sf):
    return d.option_items(spark, sf).withColumn("option", F.transform("bodies", lambda o, i: F.when((F.col("qid") + i) % 2 == 0, o).otherwise(F.substr(o, F.lit(4)))))


@query(f"""WITH {d.OPTIONS_SQL}, bare AS (SELECT qid, {BARE_SQL} AS o FROM items) SELECT qid, array_to_string(list_transform(range(0, len(o)), lambda i:
 CASE WHEN o[i + 1][2:3] = '. ' THEN o[i + 1] ELSE chr(CAST(65 + i AS INTEGER)) || '. ' || o[i + 1] END), '|') AS lines FROM bare""")
def option_lines(spark, sf):
    return _bare(spark, sf).select("qid", F.array_join(text.option_lines(F.col("option")), "|").alias("lines"))


@query(f"WITH {d.QA_SQL} SELECT qid, md5({strip_sql('question')}) AS stem_md5 FROM qa")
def question_stem(spark, sf):
    rows = d.option_items(spark, sf)
    full = F.concat(F.col("question"), F.lit("\n"), F.array_join("bodies", "\n"), F.lit("\n" + text.INSTRUCTION))
    full = F.when(F.col("qid") % 2 == 0, full).otherwise(F.concat("question", F.lit("\n\n" + text.STEM_MARKERS[1] + "\nA. x")))
    return rows.select("qid", F.md5(F.encode(text.question_stem(full, F.col("bodies")), "utf-8")).alias("stem_md5"))


# Text functions: edge strings and all turns


EDGES = [
    "(A)", "[b]", "AB", "(A)(B)", "Bad", "The answer is (D)", "answer depends", "x (A) y (C)", "<think>no (B)</think> C", '{"answer": "B"}', '{"final_answer": " (C) "}', '{"response": ""}', "Final Answer: D", "  Because",
    "Error: timeout", "option c", "Option B is", "A. one", "b", "", "[A][B]", "F", "none of them", "```json\n{\"a\": 1}\n```", "junk {\"k\": \"it\\'s\"} tail", "choose: e", "a,b", "G",
    "A\u00a0because", "option\u2003c", "The answer\u00a0is\u00a0D", "[\u00a0b\u00a0]",
]


def _values(rows: list[str]) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({i}, {quote(s)})" for i, s in enumerate(rows))


STRINGS_SQL = f"strings AS (SELECT CAST(-1 - i AS BIGINT) AS id, s FROM (VALUES {_values(EDGES)}) AS e(i, s) UNION ALL SELECT conv_id * 100 + turn, text FROM conversations)"


def _strings(spark, sf):
    edges = spark.createDataFrame([(-1 - i, s) for i, s in enumerate(EDGES)], "id long, s string")
    return edges.unionByName(d.conversations(spark, sf).select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.col("text").alias("s")))


@query(f"WITH {STRINGS_SQL} SELECT id, nullif(regexp_extract(s, '^\\s*([A-F])', 1), '') AS letter FROM strings")
def option_letter(spark, sf):
    return _strings(spark, sf).select("id", text.option_letter(F.col("s")).alias("letter"))


@query(f"""WITH {STRINGS_SQL}, plain AS (SELECT id, regexp_replace(replace(s, chr(92) || chr(39), chr(39)), '```(?:json)?', '', 'g') AS s FROM strings)
 SELECT id, md5({strip_sql("coalesce(nullif(regexp_extract(s, '(?s)[{].*[}]', 0), ''), s)")}) AS md5 FROM plain""")
def clean_json(spark, sf):
    return _strings(spark, sf).select("id", F.md5(F.encode(text.clean_json(F.col("s")), "utf-8")).alias("md5"))


def after_sql(x: str, mark: str) -> str:
    return f"CASE WHEN contains({x}, '{mark}') THEN {strip_sql(f'substr({x}, instr({x}, {chr(39)}{mark}{chr(39)}) + {len(mark)})')} ELSE {x} END"


STRIPPED_SQL = f"""{STRINGS_SQL}, p1 AS (SELECT id, {strip_sql("s")} AS s FROM strings), p2 AS (SELECT id, {after_sql("s", "</think>")} AS s FROM p1), p3 AS (SELECT id, {after_sql("s", "Final Answer:")} AS s FROM p2),
 p AS (SELECT id, CASE WHEN s[1:1] = '{{' AND json_valid(s) THEN coalesce({", ".join(f"nullif({strip_sql(f'json_extract_string(s, {chr(39)}$.{k}{chr(39)})')}, '')" for k in ("answer", "final_answer", "response"))}, s) ELSE s END AS s FROM p3)"""


@query(f"WITH {STRIPPED_SQL} SELECT id, md5(s) AS md5 FROM p")
def strip_prediction(spark, sf):
    return _strings(spark, sf).select("id", F.md5(F.encode(text.strip_prediction(F.col("s")), "utf-8")).alias("md5"))


@query(f"""WITH {STRINGS_SQL} SELECT id, md5(coalesce(list_filter(list_transform(string_split(s, chr(10)), lambda x: {strip_sql("x")}), lambda x: x <> '')[1], 'UNKNOWN_QUESTION')) AS md5 FROM strings""")
def core_question(spark, sf):
    odd = F.when(F.col("id") % 2 == 0, F.concat(F.lit("\n "), F.col("s"), F.lit("\n\nYou need to select one"))).otherwise(F.col("s"))
    marked = F.when(text.strip(F.col("s")) == "", F.col("s")).otherwise(odd)
    return _strings(spark, sf).select("id", F.md5(F.encode(text.core_question(marked), "utf-8")).alias("md5"))


#: White space as Unicode has it, for an engine whose ``\\s`` is ASCII.
WIDE_SPACE = r"\s\p{Z}\x{85}"


def wide(pattern: str, head: str = "") -> str:
    """A pattern of ``mcq`` with wide white space, as a quoted SQL text."""
    spread = re.sub(r"\[\\s|\\s", lambda m: f"[{WIDE_SPACE}" + "]" * (m[0][0] != "["), pattern)
    return f"'{head}{spread}'"


def letters_sql(x: str) -> str:
    full, one = (f"regexp_full_match({x}, {wide(p)})" for p in (mcq.ONLY_LETTERS, mcq.ONE_LETTER))
    bad = " OR ".join(f"regexp_matches({x}, {wide(p)})" for p in (mcq.TWO_ROUND, mcq.TWO_SQUARE))
    lead, phrase, token = (wide(p, "(?i)") for p in (mcq.LEADING, mcq.PHRASE, mcq.TOKEN))
    return f"""CASE WHEN {x} = '' THEN '' WHEN {full} THEN array_to_string(list_sort(list_distinct(string_split(upper({x}), ''))), '') WHEN {one} THEN upper(regexp_extract({x}, '([A-Fa-f])', 1))
 WHEN {bad} THEN '' WHEN regexp_matches({x}, {lead}) THEN upper(regexp_extract({x}, {lead}, 1)) WHEN regexp_matches({x}, {phrase}) THEN upper(regexp_extract({x}, {phrase}, 1))
 ELSE array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all({x}, {token}, 0), lambda m: upper(regexp_extract(m, '([A-Fa-f])\\W*$', 1))))), '') END"""


MALFORMED_SQL = f"(NOT regexp_full_match(s, {wide(mcq.ONLY_LETTERS)}) AND NOT regexp_full_match(s, {wide(mcq.ONE_LETTER)}) AND (regexp_matches(s, {wide(mcq.TWO_ROUND)}) OR regexp_matches(s, {wide(mcq.TWO_SQUARE)})))"


@query(f"WITH {STRIPPED_SQL} SELECT id, {letters_sql('s')} AS letters, {MALFORMED_SQL} AS malformed FROM p")
def mcq_parse(spark, sf):
    return _strings(spark, sf).select("id", F.array_join(mcq.predicted(F.col("s")), "").alias("letters"), mcq.malformed(F.col("s")).alias("malformed"))


SCORED_SQL = f"""{STRIPPED_SQL}, pred AS (SELECT id, {letters_sql("s")} AS l, {MALFORMED_SQL} AS bad FROM p), keyed AS (SELECT *, substr('ABCDEF', CAST((id % 6 + 6) % 6 AS INTEGER) + 1, 1) AS k1, substr('ABCDEF', CAST((id % 5 + 5) % 5 AS INTEGER) + 1, 1) AS k2 FROM pred),
 scored AS (SELECT id, CAST((id % 7 + 7) % 7 AS INTEGER) AS category, CASE WHEN NOT bad AND l IN (k1, k2) THEN 1.0 ELSE 0.0 END::DOUBLE AS mcq_score, l, CASE WHEN NOT bad AND l = k1 THEN k1 || '. first' WHEN NOT bad AND l = k2 THEN k2 END AS matched FROM keyed)"""


def _scored(spark, sf):
    rows = _strings(spark, sf)
    first = d.letter(F.pmod("id", F.lit(6)))
    fixed = F.array(F.concat(first, F.lit(". first")), F.lit(""), d.letter(F.pmod("id", F.lit(5))))
    return rows.select("id", F.pmod("id", F.lit(7)).cast("int").alias("category"), mcq.score(fixed, F.lit(None).cast("string"), F.col("s")).alias("r")).select("id", "category", "r.*")


@query(f"WITH {SCORED_SQL} SELECT id, mcq_score, l AS predicted, matched AS matched_answer FROM scored")
def mcq_score(spark, sf):
    return _scored(spark, sf).select("id", "mcq_score", F.array_join("predicted_options", "").alias("predicted"), "matched_answer")


@query(f"""WITH {SCORED_SQL} SELECT CAST(category AS VARCHAR) AS category, count(*) AS n, round(avg(mcq_score), 9) AS mcq FROM scored GROUP BY category
 UNION ALL SELECT 'ALL', count(*), round(avg(mcq_score), 9) FROM scored""")
def mcq_summary(spark, sf):
    return q.metrics_summary(_scored(spark, sf)).withColumn("mcq", F.round("mcq", 9))


# Blind rounds


BLIND_SQL = f"""WITH {d.RESPONSES_SQL}, stats AS (SELECT qid, count(*) FILTER (answer = response_option) AS correct_count, count(*) AS total_count FROM responses GROUP BY qid)"""


def _blind(spark, sf):
    scored = d.blind_responses(spark, sf).withColumn("score", q.round_score(F.col("answer"), F.col("response_option")))
    return q.blind_accuracy(scored, ["qid"])


@query(f"{BLIND_SQL} SELECT *, correct_count / total_count AS accuracy, CASE WHEN correct_count / total_count > 0.5 THEN 'suspected' ELSE 'good' END AS result FROM stats")
def blind_accuracy(spark, sf):
    return _blind(spark, sf)


@query(f"WITH {d.RESPONSES_SQL} SELECT round, CAST(sum(CASE WHEN answer = response_option THEN 1 ELSE 0 END) AS BIGINT) AS correct, count(*) AS n FROM responses GROUP BY round")
def blind_round_score(spark, sf):
    scored = d.blind_responses(spark, sf).withColumn("score", q.round_score(F.col("answer"), F.col("response_option")))
    return scored.groupBy("round").agg(F.sum("score").cast("long").alias("correct"), F.count("*").alias("n"))


@query(f"{BLIND_SQL} SELECT qa.qid, category, s.correct_count, CASE WHEN s.qid IS NULL THEN NULL WHEN correct_count / total_count > 0.5 THEN 'suspected' ELSE 'good' END AS result FROM qa LEFT JOIN (SELECT * FROM stats WHERE qid % 3 <> 0) s USING (qid)")
def blind_backfill(spark, sf):
    return q.backfill(d.qa_items(spark, sf), _blind(spark, sf).where("qid % 3 <> 0"), ["qid"]).select("qid", "category", "correct_count", "result")


# Losses and perturbations


NLL_SQL = f"""{d.QA_SQL}, nll AS (SELECT qid, list_transform(range(0, CAST(qid % 23 AS INTEGER)), lambda i: CAST((qid * (i + 3)) % 101 AS DOUBLE) / 8) AS l FROM qa)"""


def _nll(spark, sf):
    n = (F.col("qid") % 23).cast("int")
    values = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: ((F.col("qid") * (i + 3)) % 101).cast("double") / 8)
    return d.qa_items(spark, sf).select("qid", F.when(n > 0, values).otherwise(F.array().cast("array<double>")).alias("nll"))


@query(f"""WITH {NLL_SQL} SELECT qid, CAST(len(l) AS BIGINT) AS answer_len, round(CASE WHEN len(l) > 0 THEN list_avg(l) END, 9) AS avg_loss,
 round(CASE WHEN len(l) > 0 THEN list_avg(list_reverse_sort(l)[1:greatest(1, CAST(floor(len(l) * 0.2) AS INTEGER))]) END, 9) AS mink_loss, round(CASE WHEN len(l) > 0 THEN exp(least(list_avg(l), 20)) END, 3) AS ppl FROM nll""")
def min_k_loss(spark, sf):
    rows = q.loss_columns(_nll(spark, sf))
    return rows.select("qid", F.col("answer_len").cast("long").alias("answer_len"), F.round("avg_loss", 9).alias("avg_loss"), F.round("mink_loss", 9).alias("mink_loss"), F.round("ppl", 3).alias("ppl"))


@query(f"WITH {d.LOSSES_SQL} SELECT qid, row_number() OVER (ORDER BY loss, qid) - 1 AS rank_by_loss FROM losses")
def loss_rank(spark, sf):
    return ranking.global_rank(d.losses(spark, sf), "loss", ["qid"], "rank_by_loss").select("qid", "rank_by_loss")


GAPS_SQL = f"""{d.QA_SQL}, conf AS (SELECT qid, (qid % 17) / 4 AS o, (qid % 13) / 4 AS p, (qid % 7) / 4 AS b, CASE WHEN qid % 5 <> 0 THEN (qid % 7) / 4 END AS n FROM qa),
 gaps AS (SELECT qid, o - p AS gap_para, o - b AS gap_bt, o - n AS gap_noise, greatest(o - p, o - b, o - n) AS gap FROM conf)"""


def _gaps(spark, sf):
    part = lambda m: (F.col("qid") % m).cast("double") / 4
    rows = d.qa_items(spark, sf).select("qid", part(17).alias("conf_orig"), part(13).alias("conf_para"), part(7).alias("conf_bt"), F.when(F.col("qid") % 5 != 0, part(7)).alias("conf_noise"))
    return q.gaps(rows)


@query(f"WITH {GAPS_SQL} SELECT qid, gap_para, gap_bt, gap_noise, gap FROM gaps")
def confidence_gap(spark, sf):
    return _gaps(spark, sf).select("qid", "gap_para", "gap_bt", "gap_noise", "gap")


BEST_SQL = "CASE WHEN gap_para >= gap_bt AND gap_para >= coalesce(gap_noise, -1e9) THEN 'para' WHEN gap_bt >= coalesce(gap_noise, -1e9) THEN 'bt' ELSE 'noise' END"


@query(f"WITH {GAPS_SQL} SELECT qid, {BEST_SQL} AS best_type FROM gaps")
def best_variant(spark, sf):
    return _gaps(spark, sf).select("qid", "best_type")


@query(f"WITH {GAPS_SQL} SELECT qid, row_number() OVER (ORDER BY gap DESC NULLS LAST, qid) AS challenge_rank FROM (SELECT qid, CASE WHEN qid % 9 <> 0 THEN gap END AS gap FROM gaps)")
def challenge_order(spark, sf):
    rows = _gaps(spark, sf).withColumn("gap", F.when(F.col("qid") % 9 != 0, F.col("gap")))
    return q.challenge_rank(rows, "qid").select("qid", "challenge_rank")


CURVE_SQL = f"""{d.LOSSES_SQL}, ranked AS (SELECT *, row_number() OVER (ORDER BY loss, qid) AS rk FROM losses), sizes AS (SELECT CAST(x AS INTEGER) AS x, (SELECT count(*) FROM losses WHERE k >= x) AS y FROM range(0, 11) t(x)),
 hits AS (SELECT s.x, s.y, count(*) FILTER (r.k >= s.x AND r.rk <= s.y) AS i FROM sizes s, ranked r GROUP BY s.x, s.y), j AS (SELECT x, y, i, CASE WHEN y = 0 THEN 0 ELSE i / (2 * y - i) END AS jaccard FROM hits),
 curve AS (SELECT x, y, jaccard, CASE WHEN y = 0 THEN 0 ELSE coalesce(jaccard - lag(jaccard) OVER (ORDER BY x), 0) END AS delta_j, CASE WHEN y = 0 THEN 0 ELSE i / y END AS overlap FROM j)"""


def _curve(spark, sf):
    return ranking.overlap_curve(d.losses(spark, sf), "qid", "k", "loss")


@query(f"WITH {CURVE_SQL} SELECT x, y, jaccard, delta_j, overlap FROM curve")
def overlap_curve(spark, sf):
    return _curve(spark, sf)


@query(f"WITH {CURVE_SQL} SELECT x AS best_x FROM curve WHERE x >= 2 ORDER BY delta_j DESC, x LIMIT 1")
def best_threshold(spark, sf):
    return ranking.best_threshold(_curve(spark, sf))


# Refinement


REMOVED_SQL = f"{d.QA_SQL}, gone AS (SELECT DISTINCT question AS q_text FROM qa WHERE category = 1 AND length(question) > 0)"


@query(f"WITH {REMOVED_SQL} SELECT qid FROM qa WHERE NOT EXISTS (SELECT 1 FROM gone WHERE contains(qa.question, q_text))")
def remove_replaced(spark, sf):
    qa = d.qa_items(spark, sf)
    return q.remove_replaced(qa, qa.where("category = 1").select(F.col("question").alias("q_text"))).select("qid")


REFINED_SQL = f"""{d.QA_SQL}, refined AS (SELECT qid AS refined_idx, character, CASE WHEN qid % 4 = 0 THEN 'In which session ' ELSE 'Why ' END || CAST(qid AS VARCHAR) AS question,
 CASE qid % 3 WHEN 0 THEN 'memory_update' WHEN 1 THEN 'integrated_logic' ELSE 'other' END AS label, question AS original FROM qa), new AS (SELECT * FROM refined WHERE NOT contains(question, 'session')),
 kept AS (SELECT 0 AS part, qid AS o, character, question, NULL AS label FROM qa WHERE NOT contains(question, 'session') AND NOT EXISTS (SELECT 1 FROM new WHERE label = 'memory_update' AND contains(qa.question, original))),
 merged AS (SELECT * FROM kept UNION ALL SELECT 1, refined_idx, character, question, CASE label WHEN 'memory_update' THEN '记忆更新' WHEN 'integrated_logic' THEN '事实提取（多对话）' ELSE label END FROM new)"""


def _refined(spark, sf):
    words = F.concat(F.when(F.col("qid") % 4 == 0, "In which session ").otherwise("Why "), F.col("qid").cast("string"))
    label = F.when(F.col("qid") % 3 == 0, "memory_update").when(F.col("qid") % 3 == 1, "integrated_logic").otherwise("other")
    return d.qa_items(spark, sf).select(F.col("qid").alias("refined_idx"), "character", words.alias("question"), label.alias("label"), F.array("question").alias("original_qa"))


@query(f"WITH {REFINED_SQL} SELECT character, md5(question) AS question_md5, label, row_number() OVER (ORDER BY part, o, question) AS new_qid FROM merged")
def refine_merge(spark, sf):
    merged = q.merge_refined(d.qa_items(spark, sf).withColumn("label", F.lit(None).cast("string")), _refined(spark, sf))
    return merged.select("character", F.md5(F.encode("question", "utf-8")).alias("question_md5"), "label", "new_qid")


@query(f"""WITH {d.QA_SQL}, best AS (SELECT question AS t, max_by('best ' || CAST(qid AS VARCHAR), qid) AS b FROM (SELECT {strip_sql("question")} AS question, qid FROM qa WHERE qid % 3 = 0) GROUP BY question)
 SELECT qid, md5(coalesce(b, question)) AS question_md5, b IS NOT NULL AS replaced FROM qa LEFT JOIN best ON t = {strip_sql("question")}""")
def replace_by_text(spark, sf):
    qa = d.qa_items(spark, sf)
    best = qa.where("qid % 3 = 0").select(F.col("question").alias("original_question"), F.concat(F.lit("best "), F.col("qid").cast("string")).alias("best_question"), F.col("qid").alias("pos"))
    return q.replace_by_text(qa, best).select("qid", F.md5(F.encode("question", "utf-8")).alias("question_md5"), "replaced")


@query(f"WITH {d.QA_SQL} SELECT conv_id, turn, CASE WHEN qid % 4 = 0 THEN qid ELSE row_number() OVER (PARTITION BY qid % 4 = 0 ORDER BY conv_id, turn) END AS qid FROM qa")
def qid_reassign(spark, sf):
    qa = d.qa_items(spark, sf).select("conv_id", "turn", F.when(F.col("qid") % 4 == 0, F.col("qid")).alias("qid"))
    return q.assign_missing_qids(qa, ["conv_id", "turn"])


@query(f"WITH {REFINED_SQL} SELECT refined_idx, CASE label WHEN 'memory_update' THEN '记忆更新' WHEN 'integrated_logic' THEN '事实提取（多对话）' ELSE label END AS label FROM refined")
def label_map(spark, sf):
    return _refined(spark, sf).select("refined_idx", text.map_label(F.col("label")).alias("label"))


SIX_SQL = " || ' ' || ".join(f"'{i}:' || CAST(count(*) FILTER (category = {i}) AS VARCHAR)" for i in range(1, 7))


@query(f"WITH {d.QA_SQL} SELECT character, count(*) AS n, {SIX_SQL} AS category_counts FROM qa WHERE coalesce(character, '') <> 'Unknown' GROUP BY character HAVING count(*) >= 2")
def character_groups(spark, sf):
    return q.character_groups(d.qa_items(spark, sf))


@query(f"WITH {d.QA_SQL} SELECT conv_id, {SIX_SQL} AS counts FROM qa GROUP BY conv_id")
def category_counts_1_to_6(spark, sf):
    counts = d.qa_items(spark, sf).groupBy("conv_id").agg(*[F.count_if(F.col("category") == i).alias(f"c{i}") for i in range(1, 7)])
    return counts.select("conv_id", q.category_text([F.col(f"c{i}") for i in range(1, 7)]).alias("counts"))


# Versions


INCLUDED_SQL = "NOT (version <> 'v0' AND coalesce(check_result, '') <> 'right') AND NOT (version IN ('v2', 'v3', 'v4') AND late_right)"


@query(f"WITH {d.VERSIONS_SQL} SELECT version, script, CAST(category AS VARCHAR) AS category, count(*) AS n FROM versions WHERE {INCLUDED_SQL} GROUP BY ALL")
def version_category_counts(spark, sf):
    return q.version_counts(d.versions(spark, sf), "category")


@query(f"WITH {d.VERSIONS_SQL} SELECT version, script, label, count(*) AS n FROM versions WHERE {INCLUDED_SQL} AND label <> '' GROUP BY ALL")
def version_label_counts(spark, sf):
    return q.version_counts(d.versions(spark, sf), "label")


REASON_SQL = "CASE WHEN version <> 'v0' AND coalesce(check_result, '') <> 'right' THEN 'only_evidence_check.result=' || coalesce(check_result, 'N/A') ELSE 'iterative_evidence_ablation round=5 result=right' END"


@query(f"WITH {d.VERSIONS_SQL} SELECT version, qid, {REASON_SQL} AS exclusion_reason FROM versions WHERE NOT ({INCLUDED_SQL})")
def excluded_reasons(spark, sf):
    return q.excluded(d.versions(spark, sf)).select("version", "qid", "exclusion_reason")


@query(f"""WITH {d.VERSIONS_SQL}, gone AS (SELECT *, min(version) OVER (PARTITION BY script, question, character) AS f FROM versions WHERE NOT ({INCLUDED_SQL})) SELECT version, qid FROM gone WHERE version = f""")
def incremental_exclusions(spark, sf):
    return q.incremental(q.excluded(d.versions(spark, sf)), ["script", "question", "character"], "version").select("version", "qid")


PIVOT_CELLS = ", ".join(f"CASE WHEN bool_or(have{i}) THEN CAST(coalesce(sum(n) FILTER (script = 'script{i}'), 0) AS BIGINT) END AS script{i}" for i in range(3))
HAVE_SQL = ", ".join(f"count(*) FILTER (script = 'script{i}') OVER (PARTITION BY version) > 0 AS have{i}" for i in range(3))


@query(f"""WITH {d.VERSIONS_SQL}, counts AS (SELECT version, script, CAST(category AS VARCHAR) AS category, count(*) AS n FROM versions WHERE {INCLUDED_SQL} AND NOT (version = 'v3' AND script = 'script1') GROUP BY ALL),
 marked AS (SELECT *, {HAVE_SQL} FROM counts) SELECT version, category, {PIVOT_CELLS}, CAST(sum(n) AS BIGINT) AS sum FROM marked GROUP BY version, category""")
def stats_pivot(spark, sf):
    counts = q.version_counts(d.versions(spark, sf).where("NOT (version = 'v3' AND script = 'script1')"), "category")
    return q.stats_pivot(counts, [f"script{i}" for i in range(3)])


@query(f"WITH {d.QA_SQL} SELECT category, qid, CAST(pick AS INTEGER) AS pick FROM (SELECT category, qid, row_number() OVER (PARTITION BY category ORDER BY md5('7|' || CAST(qid AS VARCHAR)), qid) AS pick FROM qa) WHERE pick <= 2")
def stratified_sample(spark, sf):
    key = F.md5(F.concat_ws("|", F.lit("7"), F.col("qid").cast("string")).cast("binary"))
    return ranking.stratified_sample(d.qa_items(spark, sf), "category", list(range(1, 7)), 2, key, "qid").select("category", "qid", "pick")


# Nested layouts


@query(f"WITH {d.QA_SQL} SELECT CAST(dense_rank() OVER (ORDER BY conv_id) - 1 AS BIGINT) AS outer_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS inner_id, answer, category FROM qa")
def qa_flatten(spark, sf):
    blocks = d.qa_items(spark, sf).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "question", "answer", "category"))).alias("qa"))
    numbered = ranking.global_rank(blocks, "conv_id", ["conv_id"], "outer_id")
    return nested.flatten_qa(numbered, "outer_id", "qa").select("outer_id", F.col("inner_id").cast("long").alias("inner_id"), "answer", "category")


@query(f"WITH {d.QA_SQL} SELECT CAST(conv_id AS VARCHAR) AS conv_key, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS question_idx, answer FROM qa")
def result_flatten(spark, sf):
    item = F.to_json(F.struct("question", "answer", "category"))
    lists = d.qa_items(spark, sf).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", item.alias("json")))).alias("rows"))
    array = F.concat(F.lit("["), F.array_join(F.transform("rows", lambda r: r["json"]), ","), F.lit("]"))
    body = F.when(F.col("conv_id") % 2 == 0, array).otherwise(F.concat(F.lit('{"qa":'), array, F.lit("}")))
    document = lists.select(F.concat(F.lit('{"'), F.col("conv_id").cast("string"), F.lit('":'), body, F.lit("}")).alias("value"))
    return nested.result_entries(document, "value").select("conv_key", F.col("question_idx").cast("long").alias("question_idx"), F.get_json_object("item", "$.answer").alias("answer"))


@query(f"WITH {d.QA_SQL} SELECT conv_id, count(*) AS n_questions, CAST(sum(qid) AS BIGINT) AS qids FROM qa GROUP BY conv_id")
def json_container_load(spark, sf):
    item = F.to_json(F.struct("qid", "answer"))
    rows = d.qa_items(spark, sf).groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", item.alias("j")))), lambda r: r["j"]), ",").alias("items"))
    record = F.concat(F.lit('{"conversation":{},"filename":"'), F.col("conv_id").cast("string"), F.lit('","qa":['), "items", F.lit("]}"))
    shaped = rows.select(F.when(F.col("conv_id") % 3 == 0, record).when(F.col("conv_id") % 3 == 1, F.concat(F.lit("["), record, F.lit("]"))).otherwise(F.concat(F.lit('{"2":'), record, F.lit("}"))).alias("value"))
    records = nested.records_of(shaped, "value").select(F.get_json_object("record", "$.filename").cast("long").alias("conv_id"), nested.qa_list(F.get_json_object("record", "$.qa")).alias("qa"))
    return records.select("conv_id", F.explode("qa").alias("i")).groupBy("conv_id").agg(F.count("*").alias("n_questions"), F.sum(F.get_json_object("i", "$.qid").cast("long")).alias("qids"))


@query(f"WITH {d.RESPONSES_SQL} SELECT qa.qid, r.response_option AS response, CASE WHEN r.qid IS NULL THEN 'missing' ELSE 'recorded' END AS status FROM qa LEFT JOIN responses r ON r.qid = qa.qid AND r.round = 1 AND qa.qid % 7 <> 0")
def provider_recorded_join(spark, sf):
    requests = d.qa_items(spark, sf).select(F.lit("blind").alias("step"), "qid", F.lit(1).alias("round"))
    table = d.blind_responses(spark, sf).where("qid % 7 <> 0").select(F.lit("blind").alias("step"), "qid", "round", F.col("response_option").alias("response"))
    return recorded(requests, table).select("qid", "response", "status")


@query(f"{BLIND_SQL} SELECT *, correct_count / total_count AS accuracy, CASE WHEN correct_count / total_count > 0.5 THEN 'suspected' ELSE 'good' END AS result FROM stats")
def running_blind_accuracy(spark, sf):
    """The streaming form of blind_accuracy over the conversation files."""
    return stream.run_once(spark, sf)


# Readers over written files, cut-off arrays, speakers


@query(f"WITH {d.QA_SQL} SELECT qid, answer FROM qa")
def jsonl_fallback(spark, sf):
    """Items of even conversations as lines, of odd ones as a line with a list, written and read again."""
    item = F.to_json(F.struct("qid", "answer"))
    qa, path = d.qa_items(spark, sf), sinks.shared_folder(spark)
    qa.where("conv_id % 2 = 0").select(item.alias("value")).write.text(f"{path}/lines")
    lists = qa.where("conv_id % 2 = 1").groupBy("conv_id").agg(F.collect_list(item).alias("items"))
    lists.select(F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("value")).write.text(f"{path}/lists")
    got = nested.read_json_or_lines(spark, f"{path}/*")
    return got.select(F.get_json_object("value", "$.qid").cast("long").alias("qid"), F.get_json_object("value", "$.answer").alias("answer"))


ITEM_SQL = "'{\"qid\":' || CAST(qid AS VARCHAR) || ',\"answer\":\"' || answer || '\"}'"


def _item():
    return F.to_json(F.struct("qid", "answer"))


@query(f"""WITH {d.QA_SQL}, items AS (SELECT conv_id, turn, length({ITEM_SQL}) + 1 AS n FROM qa), ends AS (SELECT conv_id, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) AS e, sum(n) OVER (PARTITION BY conv_id) + 1 AS whole FROM items)
 SELECT conv_id, count(*) FILTER (e <= whole - conv_id % 60) AS n_records FROM ends GROUP BY conv_id""")
def truncated_array(spark, sf):
    """Objects before the cut of arrays that lost up to 59 characters."""
    lists = d.qa_items(spark, sf).groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", _item().alias("j")))), lambda r: r["j"]), ",").alias("items"))
    whole = F.concat(F.lit("["), "items", F.lit("]"))
    cut = lists.select("conv_id", F.substr(whole, F.lit(1), (F.length(whole) - F.col("conv_id") % 60).cast("int")).alias("value"))
    return cut.select("conv_id", F.coalesce(F.size(nested.container(F.col("value"))), F.lit(0)).cast("long").alias("n_records"))


@query(f"WITH {d.QA_SQL} SELECT '0_' || CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS VARCHAR) AS id, question, answer FROM qa")
def loss_questions(spark, sf):
    row = F.struct("turn", F.to_json(F.struct("question", "answer")).alias("j"))
    lists = d.qa_items(spark, sf).groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["j"]), ",").alias("items"))
    return nested.loss_questions(lists.select(F.concat(F.lit('[{"qa":['), "items", F.lit("]}]")).alias("value")))


@query(f"WITH {STRINGS_SQL} SELECT id, md5(nullif(regexp_extract(s, '(?s)\\[.*\\]', 0), '')) AS md5 FROM strings")
def json_array(spark, sf):
    return _strings(spark, sf).select("id", F.md5(F.encode(text.json_array(F.col("s")), "utf-8")).alias("md5"))


@query(f"""WITH {STRINGS_SQL}, bare AS (SELECT id, {strip_sql("regexp_replace(" + strip_sql("CASE WHEN id % 3 = 0 THEN '```json' || chr(10) || s || '```' ELSE s END") + ", '^```(?:json)?\\s*|\\s*```$', '', 'g')")} AS s FROM strings)
 SELECT id, CASE WHEN s[1:1] = '{{' AND s[-1:] = '}}' AND json_valid(s) THEN md5(s) END AS md5 FROM bare""")
def strict_json_object(spark, sf):
    rows = _strings(spark, sf).withColumn("s", F.when(F.col("id") % 3 == 0, F.concat(F.lit("```json\n"), "s", F.lit("```"))).otherwise(F.col("s")))
    return rows.select("id", F.md5(F.encode(text.strict_json_object(F.col("s")), "utf-8")).alias("md5"))


@query(f"""WITH {d.QA_SQL} SELECT qid, CAST(len(list_filter(list_transform(range(0, CAST(qid % 12 AS INTEGER)), lambda i: CASE WHEN (qid + i) % 5 = 0 THEN 'bad' ELSE CAST(((qid + i * 3) % 10) / 10 AS VARCHAR) END), lambda x: coalesce(try_cast(x AS DOUBLE), -1) >= 0.5)) AS INTEGER) AS k FROM qa""")
def blind_correct_count(spark, sf):
    n = (F.col("qid") % 12).cast("int")
    scores = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.when((F.col("qid") + i) % 5 == 0, F.lit("bad")).otherwise((((F.col("qid") + i * 3) % 10) / 10).cast("string")))
    return d.qa_items(spark, sf).select("qid", ranking.blind_correct(F.when(n > 0, scores).otherwise(F.array().cast("array<string>"))).alias("k"))


@query(f"""WITH {NLL_SQL}, own AS (SELECT qid, list_filter(list_transform(range(0, len(l)), lambda i: CASE WHEN i * 4 >= qid % 40 THEN l[i + 1] ELSE -1 END), lambda x: x >= 0) AS l FROM nll)
 SELECT qid, 0.0 + round(CASE WHEN len(l) = 0 THEN -999.0 ELSE -list_avg(list_reverse_sort(l)[1:greatest(1, CAST(floor(len(l) * 0.2) AS INTEGER))]) END, 9)::DOUBLE AS conf FROM own""")
def min_k_confidence(spark, sf):
    rows = _nll(spark, sf).withColumn("offsets", F.transform("nll", lambda x, i: i * 4))
    return rows.select("qid", F.round(ranking.min_k_confidence(F.col("nll"), F.col("offsets"), F.col("qid") % 40), 9).alias("conf"))


SPEAKERS_SQL = """people AS (SELECT DISTINCT conv_id FROM conversations), speakers AS (SELECT conv_id AS record_idx, 1 AS ordinal, 'speaker_1' AS key, 'Ann ' || CAST(conv_id AS VARCHAR) AS name FROM people UNION ALL
 SELECT conv_id, 2, 'speaker_2', 'Bo' FROM people UNION ALL SELECT conv_id, 3, 'speaker_3', 'Cy' FROM people WHERE conv_id % 2 = 0 UNION ALL SELECT conv_id, 1, 'speaker_1', 'Di' FROM people WHERE conv_id % 3 = 0)"""


def _speakers(spark, sf):
    """Records with speakers by key, by inverted name and by list."""
    people = d.conversations(spark, sf).select("conv_id").distinct()
    body = F.concat(
        F.lit('{"speaker_1":" Ann '), F.col("conv_id").cast("string"), F.lit(' ","speaker_2":"Bo","speaker_9":" ","session_1":[]'),
        F.when(F.col("conv_id") % 2 == 0, ',"Cy":"speaker_3"').otherwise(""), F.when(F.col("conv_id") % 3 == 0, ',"speakers":["Di",""]').otherwise(""), F.lit("}"),
    )
    return nested.speakers_of(people.select(F.col("conv_id").alias("record_idx"), body.alias("conversation")))


@query(f"WITH {SPEAKERS_SQL} SELECT * FROM speakers")
def speaker_extract(spark, sf):
    return _speakers(spark, sf)


@query(f"""WITH {SPEAKERS_SQL}, raw AS (SELECT conv_id AS record_idx, turn AS turn_idx, CASE turn % 4 WHEN 0 THEN '2' WHEN 1 THEN 'speaker_2' WHEN 2 THEN role END AS r FROM conversations)
 SELECT raw.record_idx, turn_idx, coalesce(name, r, 'None') AS speaker FROM raw LEFT JOIN (SELECT * FROM speakers WHERE key = 'speaker_2') s ON s.record_idx = raw.record_idx AND r IN ('2', 'speaker_2')""")
def speaker_resolve(spark, sf):
    raw = F.when(F.col("turn") % 4 == 0, "2").when(F.col("turn") % 4 == 1, "speaker_2").when(F.col("turn") % 4 == 2, F.col("role"))
    turns = d.conversations(spark, sf).select(F.col("conv_id").alias("record_idx"), F.col("turn").alias("turn_idx"), raw.alias("speaker_raw"))
    return transcript.speaker_name(turns, _speakers(spark, sf)).select("record_idx", "turn_idx", "speaker")


@query(f"""WITH {d.TURNS_SQL}, parts AS (SELECT record_idx, session_no, chr(10) || '--- Turn started at ' || coalesce(max(session_ts), 'Unknown time') || ' ---' || chr(10)
 || string_agg(CASE WHEN speaker = 'user' THEN 'user' ELSE 'assistant' END || ': ' || text, chr(10) ORDER BY turn_idx) AS part FROM turns GROUP BY record_idx, session_no)
 SELECT record_idx, md5(string_agg(part, chr(10) ORDER BY session_no)) AS md5 FROM parts GROUP BY record_idx""")
def full_context_history(spark, sf):
    """From the nested JSON of a record, whose sessions stand among its speakers and times."""
    turn = F.struct("turn_idx", F.to_json(F.struct("speaker", "text")).alias("j"))
    sessions = d.turns(spark, sf).groupBy("record_idx", "session_no").agg(F.max("session_ts").alias("ts"), F.array_join(F.transform(F.array_sort(F.collect_list(turn)), lambda t: t["j"]), ",").alias("own"))
    key = F.concat(F.lit(',"session_'), F.col("session_no").cast("string"))
    entry = F.concat(key, F.lit('":['), "own", F.lit("]"), F.coalesce(F.concat(key, F.lit('_date_time":"'), "ts", F.lit('"')), F.lit("")))
    bodies = sessions.groupBy("record_idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("session_no", entry.alias("e")))), lambda x: x["e"]), "").alias("b"))
    records = bodies.select("record_idx", F.concat(F.lit('{"speaker_a":"user","speaker_b":"assistant"'), "b", F.lit("}")).alias("conversation"))
    return full_context.histories(records).select("record_idx", F.md5(F.encode("transcript", "utf-8")).alias("md5"))


ABLATED_SQL = """judged AS (SELECT qid, round, CASE WHEN answer = response_option THEN 'right' ELSE 'wrong' END AS result, (qid + round) % 3 AS n_used FROM responses WHERE round <= 5),
 stops AS (SELECT *, min(CASE WHEN result = 'wrong' OR n_used = 0 THEN round END) OVER before AS s, 1 + coalesce(sum(n_used) OVER before, 0) AS n_gone FROM judged WINDOW before AS (PARTITION BY qid ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def _ablated(spark, sf):
    """Questions with a first piece of evidence, and recorded responses that name up to two more each."""
    evidence = F.array(F.struct(F.concat(F.lit("D"), F.col("conv_id").cast("string"), F.lit(":0")).alias("dia_id"), F.lit("x").alias("utterance")))
    qa = d.qa_items(spark, sf).select(F.col("conv_id").alias("record_idx"), "qid", "question", "answer", evidence.alias("evidence_dialogues"))
    used = F.transform(F.when((F.col("qid") + F.col("round")) % 3 > 0, F.sequence(F.lit(1), ((F.col("qid") + F.col("round")) % 3).cast("int"))).otherwise(F.array().cast("array<int>")), lambda i: F.struct(F.concat(F.lit("D:"), i.cast("string")).alias("dia_id"), F.lit("u").alias("utterance")))
    said = F.to_json(F.struct(F.col("response_option").alias("answer"), used.alias("evidence_dialogues")))
    return qa, d.blind_responses(spark, sf).select(F.lit("ablation").alias("step"), "qid", "round", said.alias("response"))


@query(f"WITH {d.RESPONSES_SQL}, {ABLATED_SQL} SELECT qid, round, result, CAST(n_gone AS BIGINT) AS n_gone FROM stops WHERE s IS NULL")
def ablation_plan(spark, sf):
    """Rounds over recorded responses: each takes away the evidence that it named."""
    qa, table = _ablated(spark, sf)
    return ablation.run(qa, d.turns(spark, sf), Responses(table)).select("qid", "round", "result", F.size("all_evidence").cast("long").alias("n_gone"))


@query(f"""WITH {d.RESPONSES_SQL}, {ABLATED_SQL}, n AS (SELECT qid, count(*) AS n, arg_max(result, round) AS r FROM stops WHERE s IS NULL GROUP BY qid)
 SELECT qid, CASE WHEN qid % 3 = 0 THEN n ELSE 1 END AS n_rounds, CASE WHEN qid % 3 = 0 THEN r ELSE 'old' END AS last_result FROM qa LEFT JOIN n USING (qid)""")
def ablation_pending(spark, sf):
    """Only questions whose check is right are asked; the others keep the rounds that they have."""
    qa, table = _ablated(spark, sf)
    check = F.when(F.col("qid") % 3 == 0, "right").when(F.col("qid") % 3 == 1, "maybe_wrong")
    had = F.array(F.struct(F.lit(1).alias("round"), F.lit("A").alias("answer"), F.lit("old").alias("result")))
    asked = qa.withColumns({"only_evidence_check": F.struct(check.alias("result")), "iterative_evidence_ablation": had})
    rows = ablation.with_rounds(asked, d.turns(spark, sf), Responses(table))
    return rows.select("qid", F.size("iterative_evidence_ablation").cast("long").alias("n_rounds"), F.element_at("iterative_evidence_ablation", -1)["result"].alias("last_result"))


@query(f"""WITH {d.TURNS_SQL}, {d.QA_SQL}, named AS (SELECT conv_id AS record_idx, qid, 'D' || CAST(conv_id AS VARCHAR) || ':' || CAST((turn + 1) % 4 AS VARCHAR) AS gone FROM qa),
 modes AS (SELECT 'default' AS mode UNION ALL SELECT 'except'), parts AS (SELECT mode, qid, session_no, chr(10) || '--- Turn started at ' || coalesce(max(session_ts), 'Unknown time') || ' ---' || chr(10) || string_agg(speaker || ': ' || text, chr(10) ORDER BY turn_idx) AS part
 FROM named JOIN turns USING (record_idx), modes WHERE mode = 'default' OR dia_id <> gone GROUP BY mode, qid, session_no), whole AS (SELECT mode, qid, {strip_sql("string_agg(part, chr(10) ORDER BY session_no)")} AS t FROM parts GROUP BY mode, qid)
 SELECT m.mode, n.qid, md5(coalesce(t, '')) AS md5 FROM named n, modes m LEFT JOIN whole w ON w.mode = m.mode AND w.qid = n.qid
 UNION ALL SELECT 'only', qid, md5('[{{"dia_id":"' || gone || '"}}]' || chr(10) || '[]') FROM named""")
def evidence_modes(spark, sf):
    """The context of a question in the three modes."""
    gone = F.concat(F.lit("D"), F.col("conv_id").cast("string"), F.lit(":"), ((F.col("turn") + 1) % 4).cast("string"))
    named = F.array(F.struct(gone.alias("dia_id"), F.lit(None).cast("string").alias("utterance")))
    qa = d.qa_items(spark, sf).select(F.col("conv_id").alias("record_idx"), "qid", named.alias("evidence_dialogues"), F.lit(None).cast("array<string>").alias("reasoning_steps"))
    parts = [pipeline.evidence_context(qa, d.turns(spark, sf), mode).select(F.lit(mode).alias("mode"), "qid", F.md5(F.encode("context", "utf-8")).alias("md5")) for mode in ("only", "except", "default")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Counters, and one record of all conversations


@query(f"WITH {d.QA_SQL}, files AS (SELECT conv_id % 7 AS f, conv_id, count(*) AS n FROM qa GROUP BY ALL) SELECT count(DISTINCT f) AS files, count(*) FILTER (conv_id % 3 > 0) AS reused, count(*) FILTER (conv_id % 3 = 0) AS generated, CAST(sum(n) FILTER (conv_id % 3 > 0) AS BIGINT) AS questions FROM files")
def step_totals(spark, sf):
    """Records of every third conversation bring no questions along."""
    records = d.qa_items(spark, sf).groupBy("conv_id").agg(F.collect_list(_item()).alias("items"))
    return transcript.step_totals(records.select((F.col("conv_id") % 7).alias("file"), F.when(F.col("conv_id") % 3 > 0, F.col("items")).alias("qa")))


@query(f"WITH {d.QA_SQL} SELECT 'blind' AS step, CASE WHEN qid % 7 <> 0 THEN 'recorded' ELSE 'missing' END AS status, count(*) AS n FROM qa GROUP BY ALL")
def provider_totals(spark, sf):
    requests = d.qa_items(spark, sf).select(F.lit("blind").alias("step"), "qid", F.lit(1).alias("round"))
    table = d.blind_responses(spark, sf).where("qid % 7 <> 0").select(F.lit("blind").alias("step"), "qid", "round", F.col("response_option").alias("response"))
    return totals(recorded(requests, table))


@query(f"WITH {d.QA_SQL}, t AS (SELECT {strip_sql('question')} IN (SELECT {strip_sql('question')} FROM qa WHERE qid % 3 = 0) AS hit FROM qa) SELECT count(*) FILTER (hit) AS replaced, count(*) FILTER (NOT hit) AS missing FROM t")
def replaced_totals(spark, sf):
    qa = d.qa_items(spark, sf)
    best = qa.where("qid % 3 = 0").select(F.col("question").alias("original_question"), F.lit("best").alias("best_question"), F.col("qid").alias("challenge_rank"))
    return perturb.replaced_dataset(qa, best)[1]


@query(f"WITH {d.QA_SQL} SELECT conv_id AS conv_idx, count(*) FILTER (qid % 11 <> 0) AS n_results, count(*) AS n_questions, count(*) FILTER (qid % 11 <> 0) >= count(*) AS done FROM qa GROUP BY conv_id")
def conversation_completion(spark, sf):
    questions = d.qa_items(spark, sf).select(F.col("conv_id").alias("conv_idx"), "qid")
    return sinks.complete_conversations(questions.where("qid % 11 <> 0"), questions)


@query(f"""WITH {d.TURNS_SQL}, s AS (SELECT record_idx, session_no, max(session_ts) AS ts, count(*) AS n, row_number() OVER (ORDER BY record_idx, session_no) AS g FROM turns GROUP BY record_idx, session_no)
 SELECT 0::BIGINT AS key_no, 'speakers' AS key, (SELECT count(DISTINCT speaker) FROM turns) AS n_values, NULL AS time UNION ALL SELECT 2 * g - 1, 'session_' || CAST(g AS VARCHAR) || '_date_time', NULL, ts FROM s WHERE ts IS NOT NULL
 UNION ALL SELECT 2 * g, 'session_' || CAST(g AS VARCHAR), n, NULL FROM s""")
def merged_record(spark, sf):
    turns = d.turns(spark, sf)
    rows = transcript.merged_record(turns, turns.select("record_idx", F.col("turn_idx").alias("ordinal"), F.col("speaker").alias("name")))
    return rows.select("key_no", "key", F.json_array_length("value").cast("long").alias("n_values"), F.when(F.endswith("key", F.lit("_date_time")), F.get_json_object(F.concat(F.lit('{"t":'), "value", F.lit("}")), "$.t")).alias("time"))


# Steps over recorded responses, and the smaller functions


@query(f"""WITH {d.QA_SQL} SELECT conv_id * 1000 AS conv_id, count(*) AS n_questions, CAST(min(qid) AS BIGINT) AS first_qid FROM qa GROUP BY conv_id""")
def dataset_stream(spark, sf):
    """Records whose questions are a list or a map by number, their conversations and entries that are no records."""
    item = F.struct("turn", F.concat(F.lit('"'), F.col("turn").cast("string"), F.lit('":')).alias("k"), F.to_json(F.struct("qid")).alias("j"))
    rows = d.qa_items(spark, sf).groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("own"))
    listed = F.concat(F.lit("["), F.array_join(F.transform("own", lambda x: x["j"]), ","), F.lit("]"))
    mapped = F.concat(F.lit("{"), F.array_join(F.transform(F.reverse("own"), lambda x: F.concat(x["k"], x["j"])), ","), F.lit("}"))
    value = F.concat(F.lit('[3, "x", null, {"filename":"'), F.col("conv_id").cast("string"), F.lit('000","conversation":{"session_1":[]},"qa":'), F.when(F.col("conv_id") % 2 == 0, listed).otherwise(mapped), F.lit("}]"))
    records = nested.normalized(nested.records_of(rows.select(value.alias("value"))))
    flat = nested.questions_of(records)
    first = F.min(F.when(F.col("qa_idx") == 0, F.col("qid")))
    return flat.groupBy(F.col("filename").cast("long").alias("conv_id")).agg(F.count("*").alias("n_questions"), first.alias("first_qid"))


@query(f"""WITH {d.QA_SQL} SELECT character, count(*) AS n, md5(string_agg(CAST(conv_id AS VARCHAR) || ':' || CAST(qid AS VARCHAR) || ':' || answer, ',' ORDER BY conv_id, qid)) AS md5 FROM qa GROUP BY character""")
def compact_clusters(spark, sf):
    """Each character's questions by episode, read back from the prompt's JSON."""
    qa = d.qa_items(spark, sf).withColumns({"episode_index": F.col("conv_id"), "option": F.array(F.lit("A. x"))})
    read = q.compact_clusters(qa).select("character", F.from_json("cluster", "array<struct<qid:bigint,episode_index:bigint,answer:string>>").alias("c"))
    line = F.transform("c", lambda x: F.concat_ws(":", x["episode_index"].cast("string"), x["qid"].cast("string"), x["answer"]))
    return read.select("character", F.size("c").cast("long").alias("n"), F.md5(F.encode(F.array_join(line, ","), "utf-8")).alias("md5"))


@query(f"""WITH {d.QA_SQL}, keys AS (SELECT DISTINCT CASE WHEN conv_id % 3 = 0 THEN 'K' || CAST(conv_id AS VARCHAR) WHEN conv_id % 3 = 1 THEN 'k' || CAST(conv_id AS VARCHAR) ELSE CAST(conv_id AS VARCHAR) END AS key FROM qa)
 SELECT key, row_number() OVER (ORDER BY NOT regexp_full_match(key, '[0-9]+'), try_cast(key AS BIGINT), lower(key)) AS position FROM keys""")
def mixed_key_order_lower(spark, sf):
    key = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("K"), F.col("conv_id").cast("string"))).when(F.col("conv_id") % 3 == 1, F.concat(F.lit("k"), F.col("conv_id").cast("string"))).otherwise(F.col("conv_id").cast("string"))
    keys = d.conversations(spark, sf).select(key.alias("key")).distinct()
    _, number, low = text.mixed_order_lower(F.col("key"))
    return ranking.global_rank(keys.withColumns({"_n": number.cast("double"), "_l": low}), "_n", ["_l"], "position", start=1).drop("_n", "_l")


@query(f"""WITH {d.QA_SQL} SELECT qid, CASE WHEN qid % 3 = 0 THEN 'b' || CAST(conv_id AS VARCHAR) || ':' || CASE WHEN qid % 2 = 0 THEN CAST(turn AS VARCHAR) ELSE '' END ELSE 'idx:' || CAST(CASE WHEN turn > 0 THEN turn ELSE qid END AS VARCHAR) END AS item_id FROM qa""")
def loss_item_id(spark, sf):
    outer = F.when(F.col("qid") % 3 == 0, F.concat(F.lit("b"), F.col("conv_id").cast("string"))).when(F.col("qid") % 3 == 1, "")
    inner = F.when(F.col("qid") % 2 == 0, F.col("turn"))
    return d.qa_items(spark, sf).select("qid", nested.loss_item_id(outer, inner, F.col("turn"), F.col("qid")).alias("item_id"))


@query(f"""WITH {d.QA_SQL} SELECT qid, 'v' || CAST(turn AS VARCHAR) AS version, substr(question, 1, 40) AS preview, CAST(length(question) // 2 AS BIGINT) AS tokens,
 length(regexp_replace(question, '\\s+$', '') || chr(10) || 'Answer: ') AS answer_at, CAST(qid // 60 AS VARCHAR) || 'm ' || CAST(qid % 60 AS VARCHAR) || 's' AS took,
 CASE WHEN qid % 3 = 0 THEN question || ' [Image: u' || CAST(turn AS VARCHAR) || '] with caption: c' ELSE question END AS shown FROM qa""")
def text_helpers(spark, sf):
    qa = d.qa_items(spark, sf)
    file = F.concat(F.lit("a_v_b_v"), F.col("turn").cast("string"), F.lit(".json"))
    url, caption = F.when(F.col("qid") % 3 != 1, F.concat(F.lit("u"), F.col("turn").cast("string"))), F.when(F.col("qid") % 3 != 2, F.lit("c"))
    return qa.select(
        "qid", text.version_of(file).alias("version"), text.preview(F.col("question")).alias("preview"), text.token_estimate(F.col("question")).alias("tokens"),
        text.answer_offset(F.col("question"), F.col("answer")).cast("long").alias("answer_at"), text.duration(F.col("qid")).alias("took"), text.image_suffix(F.col("question"), url, caption, True).alias("shown"),
    )


@query(f"""WITH {d.RESPONSES_SQL}, said AS (SELECT qid, answer, response_option AS r FROM responses WHERE round = 1 AND qid % 5 <> 0)
 SELECT qa.qid, CASE WHEN r = qa.answer THEN 'right' ELSE 'maybe_wrong' END AS result FROM qa LEFT JOIN said USING (qid)""")
def evidence_check_step(spark, sf):
    """v1 over recorded responses, some of which are plain letters, some JSON and some missing."""
    said = F.when(F.col("qid") % 2 == 0, F.concat(F.lit('so {"answer": "'), "response_option", F.lit('. x"}'))).otherwise(F.col("response_option"))
    table = d.blind_responses(spark, sf).where("round = 1 AND qid % 5 <> 0").select(F.lit("check").alias("step"), "qid", F.lit(0).alias("round"), said.alias("response"))
    qa = d.qa_items(spark, sf).withColumns({"option": F.array(F.lit("A. x")), "evidence_dialogues": F.array(F.struct(F.lit("D1").alias("dia_id"))), "reasoning_steps": F.lit(None).cast("array<string>")})
    return pipeline.check_evidence(qa, Responses(table)).select("qid", "only_evidence_check.result")


@query(f"WITH {d.VERSIONS_SQL} SELECT qid, CASE WHEN qid % 4 = 0 THEN 'null' ELSE 'L' || CAST(qid % 3 AS VARCHAR) END AS label FROM versions WHERE version = 'v1' AND check_result = 'right' AND NOT late_right")
def label_step(spark, sf):
    """v2 over recorded responses: sufficient questions with the label that was answered."""
    rows = d.versions(spark, sf).where("version = 'v1'")
    rounds = F.transform("ablation", lambda r: F.struct(r["round"].alias("round"), F.lit("").alias("answer"), r["result"].alias("result")))
    qa = rows.select(F.col("conv_id").alias("record_idx"), "qid", "question", "label", F.struct(F.col("check_result").alias("result")).alias("only_evidence_check"), rounds.alias("iterative_evidence_ablation"))
    table = rows.where("qid % 4 <> 0").select(F.lit("label").alias("step"), "qid", F.lit(0).alias("round"), F.concat(F.lit(" L"), (F.col("qid") % 3).cast("string"), F.lit("\n")).alias("response"))
    return pipeline.label(qa, d.turns(spark, sf), Responses(table)).select("qid", "label")


@query(f"{BLIND_SQL} SELECT qa.qid, result, correct_count, total_count, accuracy FROM qa LEFT JOIN (SELECT qid, correct_count, total_count, printf('%.4f', correct_count / total_count) AS accuracy, CASE WHEN correct_count / total_count > 0.5 THEN 'suspected' ELSE 'good' END AS result FROM stats WHERE qid % 6 <> 0) USING (qid)")
def blind_step(spark, sf):
    """v4 over recorded responses; questions that were never answered have no check."""
    said = F.concat(F.lit('```json\n{"option": "'), "response_option", F.lit('"}\n```'))
    table = d.blind_responses(spark, sf).where("qid % 6 <> 0").select(F.lit("blind").alias("step"), "qid", "round", said.alias("response"))
    qa = d.qa_items(spark, sf).withColumn("option", F.array(F.lit("A. x")))
    return pipeline.blind(qa, Responses(table)).select("qid", "pollution_check.result", "pollution_check.correct_count", "pollution_check.total_count", "pollution_check.accuracy")


@query(f"""WITH {d.QA_SQL} SELECT qid, CASE WHEN qid % 8 = 7 THEN NULL ELSE answer END AS response, CAST(qid % 8 > 0 AS INTEGER) AS max_context_exceeded, CASE WHEN qid % 8 = 7 THEN 'overflow' WHEN qid % 8 = 6 THEN 'missing' ELSE 'recorded' END AS status, category
 FROM qa WHERE qid % 8 <> 6 UNION ALL SELECT qid, NULL, 0, 'missing', category FROM qa WHERE qid % 8 = 6""")
def full_context_answers(spark, sf):
    """Answers that come after so many cuts of the history as the id says; some overflow to the end, some aren't recorded."""
    qa = d.qa_items(spark, sf).withColumns({"record_idx": F.col("conv_id"), "option": F.array(F.lit("A. x"), F.lit("y"))})
    trims = qa.where("qid % 8 <> 6").withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(5))))
    said = F.when((F.col("qid") % 8 == 7) | (F.col("round") < F.col("qid") % 8), full_context.OVERFLOW).otherwise(F.col("answer"))
    table = trims.select(F.lit("full_context").alias("step"), "qid", "round", said.alias("response"))
    rows = full_context.answer(qa, transcript.session_transcript(d.turns(spark, sf)), Responses(table))
    return rows.select("qid", "response", "max_context_exceeded", "status", "category")


@query(f"""WITH {d.QA_SQL}, conf AS (SELECT qid, (qid % 17) / 4 AS o, -CAST((qid % 13) AS DOUBLE) / 4 AS p, CASE WHEN qid % 5 = 0 THEN -999.0 ELSE -CAST((qid % 7) AS DOUBLE) / 4 END AS b, -CAST((qid % 11) AS DOUBLE) / 4 AS n FROM qa),
 gaps AS (SELECT qid, -o - p AS gp, -o - b AS gb, -o - n AS gn, greatest(-o - p, -o - b, -o - n) AS gap FROM conf)
 SELECT qid AS id, CASE WHEN gp >= gb AND gp >= gn THEN 'para' WHEN gb >= gn THEN 'bt' ELSE 'noise' END AS best_type, round(gap, 9) AS best_gap,
 CASE WHEN gp >= gb AND gp >= gn THEN 'para ' WHEN gb >= gn THEN 'en ' ELSE 'noise ' END || CAST(qid AS VARCHAR) AS best_question, row_number() OVER (ORDER BY gap DESC, qid) AS challenge_rank FROM gaps""")
def perturbation_run(spark, sf):
    """Three variants of every question from recorded responses, measured by recorded token losses, best ones ranked."""
    qa = d.qa_items(spark, sf).select("qid", "character", "category", "question", "answer")
    own = F.col("qid").cast("string")
    steps = [("perturb_para", 0, "para "), ("perturb_bt", 0, "de "), ("perturb_bt", 1, "fr "), ("perturb_bt", 2, "en "), ("perturb_noise", 0, "noise ")]
    said = F.explode(F.array(*[F.struct(F.lit(s).alias("step"), F.lit(i).alias("round"), F.concat(F.lit(t), own).alias("response")) for s, i, t in steps]))
    table = qa.select("qid", said.alias("r")).select("qid", "r.*")
    loss = lambda v, m: F.struct(F.lit(v).alias("variant"), F.array((F.col("qid") % m).cast("double") / 4).alias("nll"), F.array(F.when((F.col("qid") % 5 == 0) & F.lit(v == "bt"), 0).otherwise(10_000)).alias("offsets"))
    tokens = qa.select("qid", F.explode(F.array(loss("orig", 17), loss("para", 13), loss("bt", 7), loss("noise", 11))).alias("t")).select("qid", "t.*")
    return perturb.run(qa, Responses(table), tokens).select("id", "best_type", F.round("best_gap", 9).alias("best_gap"), "best_question", "challenge_rank")


@query(f"""WITH {d.QA_SQL} SELECT conv_id AS conv_idx, count(*) AS n, md5(string_agg(CAST(qid AS VARCHAR) || answer, ',' ORDER BY qid)) AS md5 FROM qa GROUP BY conv_id""")
def grouped_results(spark, sf):
    """Result rows grouped by conversation in order of question, read back from their JSON."""
    rows = d.qa_items(spark, sf).select(F.col("conv_id").alias("conv_idx"), F.col("qid").alias("question_idx"), "qid", "answer", F.lit(None).cast("string").alias("response"))
    read = sinks.grouped_results(rows).select("conv_idx", F.from_json("results", "array<struct<qid:string,answer:string>>").alias("r"))
    return read.select("conv_idx", F.size("r").cast("long").alias("n"), F.md5(F.encode(F.array_join(F.transform("r", lambda x: F.concat(x["qid"], x["answer"])), ","), "utf-8")).alias("md5"))


@query(f"WITH {d.QA_SQL} SELECT qid % 50 AS id, max(qid) AS qid, arg_max(answer, qid) AS answer FROM qa GROUP BY qid % 50")
def processed_cache(spark, sf):
    rows = d.qa_items(spark, sf).select((F.col("qid") % 50).alias("id"), "qid", "answer")
    return nested.latest_by_id(rows, "id", "qid")


@query(f"WITH {d.VERSIONS_SQL} SELECT version, count(*) AS n, CAST(sum(qid) AS BIGINT) AS qids FROM versions GROUP BY version")
def version_tables(spark, sf):
    """Versions written beside one another, one of them twice, and read again."""
    rows, path = d.versions(spark, sf).select("version", "qid"), sinks.shared_folder(spark)
    sinks.write_version(rows.where("version = 'v0'").drop("version"), path, "v2")
    for version in ("v0", "v1", "v2", "v3", "v4"):
        sinks.write_version(rows.where(F.col("version") == version).drop("version"), path, version)
    return sinks.read_versions(spark, path).groupBy(F.col("version").cast("string").alias("version")).agg(F.count("*").alias("n"), F.sum("qid").alias("qids"))
