"""Nested JSON inputs: containers, records, turns, question lists, results, JSON Lines.

Keys of conversations are data, so nothing is inferred: texts are read whole, cut by shape, and
taken apart as maps, which keep the order of their keys.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import mixed_order, strip, version_of

MAP = "map<string,string>"


def first_char(c: Column) -> Column:
    return F.substring(F.regexp_replace(c, "^[\\s\\x{FEFF}]+", ""), 1, 1)


def is_record(json: Column) -> Column:
    """An object that has any of the keys of a record."""
    return F.coalesce(F.arrays_overlap(F.json_object_keys(json), F.array(*[F.lit(k) for k in ("qa", "conversation", "speaker_a", "speaker_b")])), F.lit(False))


def by_number(entries: Column) -> Column:
    """Values of map entries: whole-number keys by value first, then the rest by text."""
    keyed = F.transform(entries, lambda e: F.struct(e["key"].try_cast("bigint").isNull().alias("t"), e["key"].try_cast("bigint").alias("n"), e["key"].alias("k"), e["value"].alias("v")))
    return F.transform(F.array_sort(keyed), lambda e: e["v"])


#: A JSON text's tokens: escapes, quotes, braces and brackets, and what stands between.
TOKENS = r'(?s)\\.|["{}\[\]]|[^"\\{}\[\]]++'


def whole_prefix(array: Column) -> Column:
    """A cut-off JSON array up to its last whole object, closed; one pass over its tokens."""
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("end"), F.lit(False).alias("quoted"))

    def step(state: Column, token: Column) -> Column:
        at, bare = state["at"] + F.length(token), ~state["quoted"]
        depth = state["depth"] + F.when(bare & token.isin("{", "["), 1).when(bare & token.isin("}", "]"), -1).otherwise(0)
        end = F.when(bare & (token == "}") & (depth == 1), at).otherwise(state["end"])
        return F.struct(at.alias("at"), depth.alias("depth"), end.alias("end"), (state["quoted"] != (token == '"')).alias("quoted"))

    end = F.aggregate(F.regexp_extract_all(array, F.lit(TOKENS), F.lit(0)), zero, step, lambda s: s["end"])
    return F.when(end > 0, F.concat(F.substr(array, F.lit(1), end), F.lit("]")))


def container(json: Column) -> Column:
    """array<string> of the objects in a container: an array, one record, or a map by number.

    An array that is cut off gives the objects before the cut.
    """
    text = F.regexp_replace(json, "^\\x{FEFF}", "")
    whole = F.from_json(text, "array<string>")
    items = F.when(first_char(text) == "[", F.coalesce(whole, F.from_json(whole_prefix(text), "array<string>"))).when(is_record(text), F.array(text)).otherwise(by_number(F.map_entries(F.from_json(text, MAP))))
    return F.filter(items, lambda x: first_char(x) == "{")


def records_of(files: DataFrame, json: str = "value") -> DataFrame:
    """(input columns, record_idx, record): one row per record of each document; truncated JSON gives those before the cut."""
    rest = [c for c in files.columns if c != json]
    return files.select(*rest, F.posexplode(container(F.col(json))).alias("record_idx", "record"))


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, value): each file whole, by name; for very large inputs stage as JSON Lines and use read_lines."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")


def objects(lines: DataFrame) -> DataFrame:
    """(file, value) with arrays taken apart."""
    return lines.select("file", F.explode(F.when(first_char(F.col("value")) == "[", F.from_json("value", "array<string>")).otherwise(F.array("value"))).alias("value"))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, value): one object per line, arrays flattened; splits like any text."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    return objects(lines.where(F.length(F.trim("value")) > 0))


def read_json_or_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): the objects of each file, which is one JSON document or JSON Lines.

    A file is Lines if its first line is JSON by itself and is not its only one; such files are read
    by line, in parallel, and only documents whole. One pass over the lines tells them apart.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    place = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    heads = lines.select(F.col("_metadata.file_path").alias("path"), place.alias("at"), "value").groupBy("path").agg(F.min_by("value", "at").alias("head"), F.count("*").alias("n"))
    split = (F.col("n") > 1) & F.try_parse_json("head").isNotNull()
    files = {True: [], False: []}
    for row in heads.select("path", split.alias("split")).collect():  # one row per file, which the driver lists anyway
        files[row["split"]].append(unquote(row["path"]))
    out = spark.createDataFrame([], "file string, value string")
    if files[True]:
        out = out.unionByName(read_lines(spark, files[True]))
    if files[False]:
        out = out.unionByName(objects(read_documents(spark, files[False])))
    return out


def qa_list(json: Column) -> Column:
    """array<string> of questions: a list as it is, a map by number, else empty."""
    shape = first_char(json)
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(shape == "[", F.from_json(json, "array<string>")).when(shape == "{", by_number(F.map_entries(F.from_json(json, MAP)))), none)


def normalized(records: DataFrame) -> DataFrame:
    """Add ``filename``, ``conversation`` (JSON) and ``qa`` (array<string>, never null)."""
    get = lambda k: F.get_json_object("record", f"$.{k}")
    return records.select("*", get("filename").alias("filename"), get("conversation").alias("conversation"), qa_list(get("qa")).alias("qa"))


def episode_order(file: Column) -> list[Column]:
    """Files by the number after their last underscore, then by name."""
    return mixed_order(F.regexp_extract(file, r"_(\d+)\.json$", 1)) + [file]


def speakers_of(records: DataFrame) -> DataFrame:
    """(record_idx, ordinal, key, name) from speaker_<n>, speaker_a/b, a speakers list and inverted names."""
    entries = F.explode(F.map_entries(F.from_json("conversation", MAP)))
    flat = records.select("record_idx", entries.alias("e")).select("record_idx", F.col("e.key").alias("k"), F.col("e.value").alias("v"))
    number = F.regexp_extract("k", r"^speaker_(\d+)$", 1).try_cast("int")
    direct = flat.where(F.regexp_like("k", F.lit(r"^speaker_(\d+|a|b)$")) & (F.coalesce(strip("v"), F.lit("")) != "")).select("record_idx", F.coalesce(number, F.lit(2**30)).alias("ordinal"), F.col("k").alias("key"), strip(F.col("v")).alias("name"))
    turned = flat.where(F.regexp_like("v", F.lit(r"^speaker_\d+$")) & (strip(F.col("k")) != "")).select("record_idx", F.regexp_extract("v", r"^speaker_(\d+)$", 1).cast("int").alias("ordinal"), F.col("v").alias("key"), strip(F.col("k")).alias("name"))
    listed = flat.where("k = 'speakers'").select("record_idx", F.posexplode(F.from_json("v", "array<string>")).alias("i", "name"))
    listed = listed.where(F.coalesce(strip(F.col("name")), F.lit("")) != "").select("record_idx", (F.col("i") + 1).alias("ordinal"), F.concat(F.lit("speaker_"), (F.col("i") + 1).cast("string")).alias("key"), strip(F.col("name")).alias("name"))
    return direct.unionByName(turned).unionByName(listed)


TURN = "struct<speaker:string,type:string,dia_id:string,text:string,img_url:string,blip_caption:string>"


def turns_of(records: DataFrame) -> DataFrame:
    """(record_idx, session_no, session_ts, turn_idx, speaker_raw, type, dia_id, text, img_url, blip_caption).

    A turn must be an object with speaker and text keys; a null speaker stays null.
    """
    entries = records.select("record_idx", F.from_json("conversation", MAP).alias("m"))
    sessions = entries.select("record_idx", "m", F.explode(F.map_entries("m")).alias("e")).where(F.regexp_like("e.key", F.lit(r"^session_\d+$")))
    number = F.regexp_extract("e.key", r"(\d+)", 1).cast("int")
    time = F.try_element_at("m", F.concat(F.col("e.key"), F.lit("_date_time")))
    lists = sessions.where(first_char(F.col("e.value")) == "[").select("record_idx", number.alias("session_no"), time.alias("session_ts"), F.posexplode(F.from_json("e.value", "array<string>")).alias("turn_idx", "turn"))
    good = lists.where((first_char(F.col("turn")) == "{") & F.array_contains(F.json_object_keys("turn"), "speaker") & F.array_contains(F.json_object_keys("turn"), "text"))
    parsed = good.withColumn("t", F.from_json("turn", TURN))
    return parsed.select("record_idx", "session_no", "session_ts", "turn_idx", F.col("t.speaker").alias("speaker_raw"), "t.type", "t.dia_id", "t.text", "t.img_url", "t.blip_caption")


QA = (
    "struct<qid:bigint,character:string,category:string,question:string,option:array<string>,answer:string,label:string,evidence_dialogues:array<struct<id:string,speaker:string,utterance:string,dia_id:string>>,"
    "reasoning_steps:array<struct<step:int,inference:string,based_on:array<string>>>,only_evidence_check:struct<result:string,response:string>,iterative_evidence_ablation:array<struct<round:int,answer:string,result:string>>>"
)


def questions_of(records: DataFrame) -> DataFrame:
    """(record_idx, filename, qa_idx, typed question columns, item): the raw item stays beside them."""
    flat = records.select("record_idx", "filename", F.posexplode("qa").alias("qa_idx", "item"))
    return flat.withColumn("q", F.from_json("item", QA)).select("record_idx", "filename", "qa_idx", "q.*", "item")


def flatten_qa(blocks: DataFrame, outer: str, qa: str) -> DataFrame:
    """Rows of an array of question structs with their position, from 0, beside the block's id."""
    flat = blocks.select(outer, F.posexplode(qa).alias("inner_id", "_q"))
    return flat.select(outer, "inner_id", "_q.*")


def loss_questions(documents: DataFrame, json: str = "value") -> DataFrame:
    """(id, question, answer) of a list of blocks, whose questions are ``block_place``, or of a flat list, by place."""
    items = records_of(documents, json).select("record_idx", "record", F.json_object_keys("record").alias("keys"))
    blocks = items.where(F.array_contains("keys", "qa")).select("record_idx", F.posexplode(qa_list(F.get_json_object("record", "$.qa"))).alias("i", "item"))
    flat = items.where(~F.array_contains("keys", "qa")).select(F.col("record_idx").cast("string").alias("id"), F.col("record").alias("item"))
    both = blocks.select(F.concat_ws("_", F.col("record_idx").cast("string"), F.col("i").cast("string")).alias("id"), "item").unionByName(flat)
    return both.select("id", F.get_json_object("item", "$.question").alias("question"), F.get_json_object("item", "$.answer").alias("answer"))


def result_entries(documents: DataFrame, json: str) -> DataFrame:
    """(conv_key, question_idx, item) of a result file: a map to lists, a map to records, a record or a list of records."""
    text = F.col(json)
    records = documents.where((first_char(text) == "[") | F.coalesce(first_char(F.get_json_object(text, "$.qa")) == "[", F.lit(False)))
    maps = documents.where(~((first_char(text) == "[") | F.coalesce(first_char(F.get_json_object(text, "$.qa")) == "[", F.lit(False))))
    a = records_of(records.select(json), json).select(F.col("record_idx").cast("string").alias("conv_key"), qa_list(F.get_json_object("record", "$.qa")).alias("qa"))
    e = maps.select(F.explode(F.map_entries(F.from_json(text, MAP))).alias("e"))
    b = e.select(F.col("e.key").alias("conv_key"), F.when(first_char(F.col("e.value")) == "[", F.from_json("e.value", "array<string>")).otherwise(qa_list(F.get_json_object("e.value", "$.qa"))).alias("qa"))
    both = a.unionByName(b).select("conv_key", F.posexplode("qa").alias("question_idx", "item"))
    return both.where(first_char(F.col("item")) == "{")


def loss_item_id(outer: Column, inner: Column, index: Column, position: Column) -> Column:
    """``outer:inner``, else ``idx:`` and the global index, or the position where that is zero or missing."""
    plain = F.concat(F.lit("idx:"), F.when(F.coalesce(index, F.lit(0)) != 0, index).otherwise(position).cast("string"))
    return F.when(F.coalesce(outer, F.lit("")) != "", F.concat(outer, F.lit(":"), F.coalesce(inner.cast("string"), F.lit("")))).otherwise(plain)


def version_files(spark: SparkSession, directory: str) -> DataFrame:
    """Records of all ``*_v*.json`` files with file and version."""
    files = read_documents(spark, f"{directory}/*_v*.json")
    return normalized(records_of(files)).withColumn("version", version_of(F.col("file")))


def latest_by_id(rows: DataFrame, id_col: str, order: str) -> DataFrame:
    """A cache of processed rows: of equal ids the last wins."""
    return rows.groupBy(id_col).agg(F.max_by(F.struct(*[c for c in rows.columns if c != id_col]), order).alias("_r")).select(id_col, "_r.*")
