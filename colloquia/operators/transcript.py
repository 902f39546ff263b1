"""Conversations: transcripts, evidence removal, speakers, sessions, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import image_suffix, session_time_key, strip

#: Header of a session and the time of one that has none.
HEAD, HEAD_END, UNKNOWN_TIME = "\n--- Turn started at ", " ---", "Unknown time"


def speaker_name(turns: DataFrame, speakers: DataFrame) -> DataFrame:
    """Add ``speaker``: the name that the raw value or ``speaker_<raw>`` stands for, else the raw value; null is ``None``.

    turns has record_idx and speaker_raw, speakers (record_idx, key, name).
    """
    by_key = speakers.select("record_idx", F.col("key").alias("_key"), F.col("name").alias("_name")).dropDuplicates(["record_idx", "_key"])
    number = F.regexp_like(F.col("speaker_raw"), F.lit(r"^-?\d+$"))
    keyed = turns.withColumn("_key", F.when(number, F.concat(F.lit("speaker_"), "speaker_raw")).otherwise(F.col("speaker_raw")))
    named = keyed.join(by_key, ["record_idx", "_key"], "left")
    return named.withColumn("speaker", F.coalesce("_name", "speaker_raw", F.lit("None"))).drop("_key", "_name")


def session_transcript(turns: DataFrame, figure_view: bool = False) -> DataFrame:
    """(record_idx, transcript): sessions by number, a header with the session's time, one line per turn.

    turns: record_idx, session_no, session_ts, turn_idx, speaker, text, img_url, blip_caption. A turn without
    text is left out. Lines are built before they are gathered, once per conversation.
    """
    body = image_suffix(F.col("text"), F.col("img_url"), F.col("blip_caption"), figure_view)
    lines = turns.select("record_idx", "session_no", "session_ts", "turn_idx", F.concat_ws(": ", F.coalesce("speaker", F.lit("None")), body).alias("line"), F.col("text").isNotNull().alias("shown"))
    sessions = lines.groupBy("record_idx", "session_no").agg(
        F.max("session_ts").alias("ts"), F.array_sort(F.collect_list(F.when(F.col("shown"), F.struct("turn_idx", "line")))).alias("own")
    )
    head = F.concat(F.lit(HEAD), F.coalesce("ts", F.lit(UNKNOWN_TIME)), F.lit(HEAD_END))
    parts = sessions.select("record_idx", "session_no", F.array_join(F.concat(F.array(head), F.transform("own", lambda t: t["line"])), "\n").alias("part"))
    whole = parts.groupBy("record_idx").agg(F.array_sort(F.collect_list(F.struct("session_no", "part"))).alias("parts"))
    return whole.select("record_idx", strip(F.array_join(F.transform("parts", lambda p: p["part"]), "\n")).alias("transcript"))


def two_party_transcript(turns: DataFrame, key_order: str = "key_idx") -> DataFrame:
    """As full-context prompts have it: keys in their own order, each with a header, and every speaker but the first shown as the second.

    turns: record_idx, key_idx, session_ts, turn_idx, speaker, text, speaker_a, speaker_b; a key without turns has
    one row with null turn_idx and still makes a header. No white space is stripped.
    """
    name = F.when(F.col("speaker") == F.col("speaker_a"), F.col("speaker_a")).otherwise(F.col("speaker_b"))
    shown = F.col("turn_idx").isNotNull() & F.col("text").isNotNull()
    lines = turns.withColumn("line", F.when(shown, F.concat_ws(": ", name, "text")))
    keys = lines.groupBy("record_idx", key_order).agg(F.max("session_ts").alias("ts"), F.array_sort(F.collect_list(F.when(shown, F.struct("turn_idx", "line")))).alias("own"))
    head = F.concat(F.lit(HEAD), F.coalesce("ts", F.lit(UNKNOWN_TIME)), F.lit(HEAD_END))
    parts = keys.select("record_idx", key_order, F.array_join(F.concat(F.array(head), F.transform("own", lambda t: t["line"])), "\n").alias("part"))
    whole = parts.groupBy("record_idx").agg(F.array_sort(F.collect_list(F.struct(key_order, "part"))).alias("parts"))
    return whole.select("record_idx", F.array_join(F.transform("parts", lambda p: p["part"]), "\n").alias("transcript"))


def head_lines(transcript: Column, n: int | Column) -> Column:
    """The first n lines: trimming takes the latest."""
    return F.array_join(F.slice(F.split(transcript, r"\r\n|\r|\n", -1), F.lit(1), n if isinstance(n, Column) else F.lit(n)), "\n")


def trimmed(transcript: Column, step: Column) -> Column:
    """The transcript after ``step`` cuts of a tenth of its lines."""
    count = F.size(F.split(transcript, r"\r\n|\r|\n", -1))
    return head_lines(transcript, F.greatest(F.lit(1), F.floor(count * F.pow(F.lit(0.9), step))).cast("int"))


def without_evidence(turns: DataFrame, evidence: DataFrame) -> DataFrame:
    """Turns of each question's record that none of its evidence names; times that N/A evidence names are blanked.

    turns: record_idx, session_no, session_ts, dia_id, ...; evidence: record_idx, qid, dia_id, utterance. One row per
    question and turn. Null or empty ids name nothing.
    """
    questions = evidence.select("record_idx", "qid").distinct()
    pairs = questions.join(turns, "record_idx")
    named = evidence.where(F.col("dia_id").isNotNull() & ~F.col("dia_id").isin("", "N/A")).select("record_idx", "qid", "dia_id").distinct()
    left = pairs.join(named, ["record_idx", "qid", "dia_id"], "left_anti")
    times = evidence.where("dia_id = 'N/A'").select("record_idx", "qid", session_time_key(F.col("utterance")).alias("key")).where("key is not null")
    times = times.select("record_idx", "qid", F.regexp_extract("key", r"(\d+)", 1).cast("int").alias("session_no"), F.lit(True).alias("_blank")).distinct()
    marked = left.join(times, ["record_idx", "qid", "session_no"], "left")
    return marked.withColumn("session_ts", F.when(F.col("_blank").isNull(), F.col("session_ts"))).drop("_blank")


def dataset_stats(records: DataFrame, turns: DataFrame, questions: DataFrame) -> DataFrame:
    """One row: conversations, sessions, turns, questions; sessions count every session key that isn't a time."""
    a = records.agg(F.count("*").alias("conversations"))
    b = turns.agg(F.count_distinct("record_idx", "session_no").alias("sessions"), F.count("*").alias("turns"))
    c = questions.agg(F.count("*").alias("questions"))
    return a.join(b).join(c)  # three rows of one, no table


def first_appearance(speakers: DataFrame) -> DataFrame:
    """(name, position): distinct stripped names in the order in which records list them, from 1.

    speakers: record_idx, ordinal, name. Names are reduced to one row each before they are numbered.
    """
    clean = speakers.where(F.col("name").isNotNull()).select(strip(F.col("name")).alias("name"), F.struct("record_idx", "ordinal").alias("at")).where("name != ''")
    first = clean.groupBy("name").agg(F.min("at").alias("at"))
    return first.select("name", F.row_number().over(Window.orderBy("at", "name")).alias("position"))


def renumber_sessions(turns: DataFrame) -> DataFrame:
    """Add ``global_session``: sessions numbered from 1 over all records, by record, then session number.

    Sessions are reduced to one row each; per-record offsets come from counts, so no task sees all turns.
    """
    own = turns.select("record_idx", "session_no").distinct()
    local = own.withColumn("_pos", F.dense_rank().over(Window.partitionBy("record_idx").orderBy("session_no")))
    counts = own.groupBy("record_idx").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("record_idx").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = local.join(before.drop("_n"), "record_idx").select("record_idx", "session_no", (F.col("_pos") + F.col("_before")).cast("long").alias("global_session"))
    return turns.join(numbered, ["record_idx", "session_no"])


def merged_record(turns: DataFrame, speakers: DataFrame) -> DataFrame:
    """One conversation of all records, by rows: (key_no, key, value) in the order of its keys.

    First ``speakers`` with the distinct names in order of appearance, where there is one; then each
    session under its global number, its time (if it has one) before its turns. turns as
    ``renumber_sessions`` takes them; values are JSON. A writer may join the rows; no task gathers
    them but a session's own turns.
    """
    names = first_appearance(speakers).agg(F.array_sort(F.collect_list(F.struct("position", "name"))).alias("own")).where(F.size("own") > 0)
    head = names.select(F.lit(0).cast("long").alias("key_no"), F.lit("speakers").alias("key"), F.to_json(F.transform("own", lambda x: x["name"])).alias("value"))
    said = renumber_sessions(turns)
    turn = F.struct("turn_idx", F.to_json(F.struct("speaker", "dia_id", "text")).alias("json"))
    sessions = said.groupBy("global_session").agg(F.max("session_ts").alias("ts"), F.array_sort(F.collect_list(turn)).alias("own"))
    key = F.concat(F.lit("session_"), F.col("global_session").cast("string"))
    times = sessions.where("ts IS NOT NULL").select((2 * F.col("global_session") - 1).alias("key_no"), F.concat(key, F.lit("_date_time")).alias("key"), F.to_json(F.array("ts")).alias("value"))
    times = times.withColumn("value", F.expr("substring(value, 2, length(value) - 2)"))
    lists = sessions.select((2 * F.col("global_session")).alias("key_no"), key.alias("key"), F.concat(F.lit("["), F.array_join(F.transform("own", lambda t: t["json"]), ","), F.lit("]")).alias("value"))
    return head.unionByName(times).unionByName(lists)


def step_totals(records: DataFrame) -> DataFrame:
    """One row of the first step's counters: files, reused (records that bring questions), generated (those that don't), questions.

    records: file, qa (array).
    """
    own = F.coalesce(F.size("qa"), F.lit(0))
    return records.agg(F.count_distinct("file").alias("files"), F.count_if(own > 0).alias("reused"), F.count_if(own == 0).alias("generated"), F.coalesce(F.sum(own), F.lit(0)).alias("questions"))
