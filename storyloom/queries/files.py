"""Queries of readers, writers and streams: what is written to the shared folder and read back is what the tables hold."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions import text as tx
from storyloom.operators import characters as ca
from storyloom.operators import relational as rl
from storyloom.plans import steps
from storyloom.plans.lineage import new_path
from storyloom.plans.progress import Progress
from storyloom.queries.common import table
from storyloom.sources import named, readers, writers
from storyloom.sources.store import Store
from storyloom.streaming import streams

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")


def _mixed_lines(spark: SparkSession, d: str) -> str:
    """A folder with each document as a line, a blank line and a broken line for each of them."""
    path = new_path(spark, "jsonl")
    kinds = F.array(F.to_json(F.struct("doc_id", "text")), F.lit("   "), F.concat(F.lit('{"doc_id": '), F.col("doc_id").cast("string"), F.lit(", ")))
    _docs(spark, d).select(F.explode(kinds).alias("value")).write.text(path)
    return path


@query("SELECT doc_id, text FROM documents")
def jsonl_scan(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_jsonl(spark, _mixed_lines(spark, d), "doc_id long, text string")[0]


@query("SELECT '{\"doc_id\": ' || doc_id || ', ' AS line FROM documents")
def jsonl_rejects(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_jsonl(spark, _mixed_lines(spark, d), "doc_id long, text string")[1].select("line")


@query("SELECT conv_id, turn, role, text AS content FROM conversations")
def chatml_scan(spark: SparkSession, d: str) -> DataFrame:
    """Chats as JSON lines, between lines whose messages are no list; the conversation's id and the turn travel in ``reasoning``."""
    path = new_path(spark, "chatml")
    note = F.concat_ws(" ", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    chats = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("role", F.col("text").alias("content"), note.alias("reasoning"))).alias("messages"))
    rows = chats.select(F.explode(F.array(F.to_json(F.struct("messages")), F.lit('{"messages": "none"}'), F.lit("{}"))).alias("value"))
    rows.write.text(path)
    m = readers.read_chatml(spark, path)[0].select(F.explode("messages").alias("m"))
    at = F.split("m.reasoning", " ")
    return m.select(at[0].cast("long").alias("conv_id"), at[1].cast("long").alias("turn"), "m.role", "m.content")


@query("SELECT count(*) AS n_lines FROM conversations")
def line_count(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "lines")
    writers.write_jsonl(table(spark, d, "conversations"), path)
    return spark.range(1).select(F.lit(readers.count_lines(spark, path)).cast("long").alias("n_lines"))


@query("SELECT doc_id, lang, source FROM documents")
def jsonl_folders(spark: SparkSession, d: str) -> DataFrame:
    """Nested folders of JSON lines, found by suffix; other files beside them are not read."""
    path = new_path(spark, "tree")
    rows = table(spark, d, "documents").select("doc_id", "lang", "source", F.col("lang").alias("a"), F.col("source").alias("b"))
    rows.write.partitionBy("a", "b").json(path)
    writers.put(spark, f"{path}/a=other/readme.txt", "no data\n")
    return readers.read_jsonl(spark, path, "doc_id long, lang string, source string", recursive=True, suffix=".json")[0]


@query("SELECT doc_id AS id FROM documents UNION ALL SELECT item_id FROM benchmark")
def jsonl_many_paths(spark: SparkSession, d: str) -> DataFrame:
    one, two = new_path(spark, "one"), new_path(spark, "two")
    writers.write_jsonl(_docs(spark, d).select(F.col("doc_id").alias("id")), one)
    writers.write_jsonl(table(spark, d, "benchmark").select(F.col("item_id").alias("id")), two)
    return readers.read_jsonl(spark, [one, two], "id long")[0]


@query("SELECT c_custkey, c_name, c_acctbal, c_name || ', \"' || c_mktsegment || '\"' || chr(10) || 'x' AS note FROM customer")
def csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """A header, inferred types, and values with quotes, commas and newlines."""
    path = new_path(spark, "csv")
    note = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\nx'))
    writers.write_csv(table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", note.alias("note")), path)
    return readers.read_csv(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("long"))


def _item_files(spark: SparkSession, d: str) -> str:
    """One text file for each benchmark item, in a folder of its own."""
    path = new_path(spark, "texts")
    item = F.col("item_id").cast("string")
    named.write_named(table(spark, d, "benchmark"), path, F.concat(item, F.lit("/item "), item, F.lit("+1%.txt")), "text")
    return path


@query("SELECT CAST(item_id AS VARCHAR) AS book, coalesce(text, '') || chr(10) AS text, 'item ' || item_id || '+1%' AS stem FROM benchmark")
def whole_text_scan(spark: SparkSession, d: str) -> DataFrame:
    """A row a file, with its folder as the book."""
    return readers.read_whole_text(spark, _item_files(spark, d)).select("book", "text", "stem")


@query("""WITH l AS (SELECT item_id, string_split_regex(text || chr(10), '\\r\\n|\\r|\\n') AS x FROM benchmark)
SELECT CAST(i - 1 AS INTEGER) AS line_no, x[i] AS line, count(*) AS n FROM (SELECT x, unnest(range(1, len(x) + 1)) AS i FROM l) GROUP BY ALL""")
def text_lines_scan(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_text_lines(spark, _item_files(spark, d)).groupBy("line_no", "line").agg(F.count("*").alias("n"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS book, replace(n_name, ' ', '_') AS stem, n_name AS name, [n_name, 'x'] AS alias FROM nation")
def json_document_scan(spark: SparkSession, d: str) -> DataFrame:
    """A JSON document a file, by folder; a broken one has null fields."""
    path = new_path(spark, "documents")
    rows = table(spark, d, "nation").select("n_nationkey", F.replace("n_name", F.lit(" "), F.lit("_")).alias("stem"), F.col("n_name").alias("name"), F.array("n_name", F.lit("x")).alias("alias"))
    named.write_json_files(rows, path, "n_nationkey", "stem", "_characters.json")
    return readers.read_json_documents(spark, path, "name string, alias array<string>", "_characters.json").select("book", "stem", "name", "alias")


@query("SELECT DISTINCT source AS name, [lang, 'z'] AS alias FROM documents")
def alias_map_scan(spark: SparkSession, d: str) -> DataFrame:
    """Names and aliases, trimmed; empty ones go."""
    rows = table(spark, d, "documents").select(F.concat(F.lit(" "), "source", F.lit("\t")).alias("name"), F.array(F.concat("lang", F.lit(" ")), F.lit("  "), F.lit("z")).alias("alias"))
    return readers.alias_map(rows.unionAll(rows.limit(1).withColumn("name", F.lit(" ")))).distinct()


@query("SELECT r_name AS name, '# ' || r_name || chr(10) || 'text' AS text FROM region")
def markdown_scan(spark: SparkSession, d: str) -> DataFrame:
    """Profiles by file name."""
    path = new_path(spark, "profiles")
    rows = table(spark, d, "region").select(F.concat(F.lit("book/"), "r_name", F.lit(".md")).alias("file"), F.concat(F.lit("# "), "r_name", F.lit("\ntext")).alias("text"))
    named.write_texts(rows, path)
    return readers.read_markdown(spark, path).select("name", "text")


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN [source, lang] WHEN 1 THEN [lang] ELSE [] END AS names FROM documents")
def main_character_index(spark: SparkSession, d: str) -> DataFrame:
    """Names from an object's keys, from a list, and from anything else (none)."""
    keys = F.concat(F.lit('{"characters": {"'), "source", F.lit('": {"n": 1}, "'), "lang", F.lit('": 2}}'))
    value = F.when(F.col("doc_id") % 3 == 0, keys).when(F.col("doc_id") % 3 == 1, F.to_json(F.array("lang"))).otherwise("17")
    return table(spark, d, "documents").select("doc_id", value.alias("value")).select("doc_id", readers.main_character_names("value").alias("names"))


@query("SELECT 'nations' AS name, count(*) AS n, 'n_nationkey,n_name' AS features FROM nation")
def dataset_metadata(spark: SparkSession, d: str) -> DataFrame:
    """A dataset's metadata file: name, count and features."""
    path = new_path(spark, "dataset")
    writers.write_dataset(table(spark, d, "nation").select("n_nationkey", "n_name"), path, "nations", files=1)
    meta = spark.read.schema("name string, count long, features array<string>").json(f"{path}/metadata.json")
    return meta.select("name", F.col("count").alias("n"), F.array_join("features", ",").alias("features"))


@query("SELECT doc_id, text, CAST(7 + row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS id, 1 AS n_files FROM documents")
def dataset_shard(spark: SparkSession, d: str) -> DataFrame:
    """Rows with ids as one Parquet file, read back."""
    from storyloom.operators import mapping

    path = new_path(spark, "dataset")
    writers.write_dataset(mapping.with_ids(_docs(spark, d), "doc_id", 7), path, "docs", files=1)
    rows = spark.read.parquet(f"{path}/data")
    files = rows.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    return rows.select("doc_id", "text", F.col("id").cast("long").alias("id"), F.lit(files).alias("n_files"))


@query("SELECT doc_id, text, 1::BIGINT AS n FROM documents")
def stream_resume(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines drained twice with one checkpoint: the second run reads only what came since the first."""
    path, out, mark = new_path(spark, "in"), new_path(spark, "out"), new_path(spark, "mark")
    rows = _docs(spark, d)
    for part in (0, 1):
        rows.where(F.pmod("doc_id", F.lit(2)) == part).write.mode("append").json(path)
        streams.drain(streams.read_jsonl_stream(spark, path, "doc_id long, text string"), out, mark, "parquet").awaitTermination()
    return spark.read.parquet(out).groupBy("doc_id", "text").agg(F.count("*").alias("n"))


@query("SELECT doc_id, text, 1::BIGINT AS n FROM documents")
def bounded_stream(spark: SparkSession, d: str) -> DataFrame:
    """A dataset's files drained by triggers of at most half of its bytes; files of earlier names come behind and are read once."""
    path, out, mark = new_path(spark, "set"), new_path(spark, "out"), new_path(spark, "mark")
    number = F.pmod("doc_id", F.lit(4))
    for part, prefix in enumerate(("m", "a")):
        own = _docs(spark, d).where(F.floor(number / 2) == part)
        named.write_named(own, path, F.concat(F.lit(prefix), number.cast("string"), F.lit(".parquet")), None, ["doc_id"], spread=True)
        size = named.written(spark, path).agg(F.sum("bytes")).first()[0]
        streams.drain_bounded(spark, path, out, mark, "doc_id bigint, text string", max(1, size // 2))
    return spark.read.schema("doc_id long, text string").parquet(out).groupBy("doc_id", "text").agg(F.count("*").alias("n"))


@query("SELECT 'done' AS stage, count(*) AS progress FROM conversations")
def stream_progress(spark: SparkSession, d: str) -> DataFrame:
    """What the events of a drained stream add up to."""
    path, out, mark = new_path(spark, "in"), new_path(spark, "out"), new_path(spark, "mark")
    writers.write_jsonl(table(spark, d, "conversations").select("conv_id"), path)
    run = streams.drain(streams.read_jsonl_stream(spark, path, "conv_id long"), out, mark, "parquet")
    run.awaitTermination()
    n = sum(p["numInputRows"] for p in run.recentProgress)
    return spark.range(1).select(F.lit(streams.progress(run)["stage"]).alias("stage"), F.lit(n).cast("long").alias("progress"))


@query("SELECT 'documents' AS stage, count(*) AS done, count(*) AS total, 'done' AS message FROM documents")
def stream_events(spark: SparkSession, d: str) -> DataFrame:
    """The last event of a stream of three triggers, as a query listener has told it."""
    path, out, mark = new_path(spark, "in"), new_path(spark, "out"), new_path(spark, "mark")
    each = int(spark.conf.get("spark.sql.shuffle.partitions"))  # files of a trigger, so that no task has a third of all
    _docs(spark, d).repartition(3 * each).write.json(path)
    progress = Progress(spark)
    with progress.streams():
        stream = streams.read_jsonl_stream(spark, path, "doc_id long, text string", files_per_trigger=each)
        stream.writeStream.queryName("documents").format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    last = F.max_by(F.struct("stage", "done", "total", "message"), "n").alias("e")
    return progress.rows().where("stage = 'documents'").agg(last).select("e.*")


@query("SELECT 'records' AS name, count(*) AS n, 0::BIGINT AS n_open FROM documents UNION ALL SELECT 'queue_items', count(*) FILTER (WHERE doc_id % 2 = 0), count(*) FILTER (WHERE doc_id % 2 = 0 AND doc_id % 4 <> 0) FROM documents UNION ALL SELECT 'annotations', count(*) FILTER (WHERE doc_id % 4 = 0), 0 FROM documents")
def stored_tables(spark: SparkSession, d: str) -> DataFrame:
    """The annotation tables on disk: documents as records, the even ones queued, every fourth one annotated; each is inserted twice and counts once."""
    store, docs = Store(spark, new_path(spark, "store")), table(spark, d, "documents")
    even = docs.where("doc_id % 2 = 0")
    item = [F.col("doc_id").alias("id"), F.lit(1).cast("long").alias("queue_id"), F.col("doc_id").cast("string").alias("record_id")]
    store.insert("annotation_schemas", spark.range(1, 2).select("id", F.lit("s").alias("name")), "id")
    store.insert("queues", spark.range(1, 2).select("id", F.lit("q").alias("name"), F.col("id").alias("schema_id")), "id")
    for _ in range(2):
        store.insert("records", docs.select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("name"), F.col("text").alias("input")), "name")
    store.insert("queue_items", even.select(*item, F.lit("pending").alias("status")), "id")
    done = docs.where("doc_id % 4 = 0")
    store.insert("annotations", done.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("queue_item_id"), F.lit("{}").alias("values")), "id")
    store.upsert("queue_items", done.select(*item, F.lit("annotated").alias("status")))
    count = lambda name, still: store.table(name).agg(F.count("*").alias("n"), F.count_if(still).alias("n_open")).select(F.lit(name).alias("name"), "n", "n_open")
    return count("records", F.lit(False)).unionByName(count("queue_items", F.col("status") == "pending")).unionByName(count("annotations", F.lit(False)))


@query("SELECT doc_id, lang, list_filter(list_transform(string_split(' a, ' || lang || ' ,,b ', ','), lambda x: trim(x)), lambda x: x <> '') AS options FROM documents")
def options_list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "lang", tx.options_list(F.concat(F.lit(" a, "), "lang", F.lit(" ,,b "))).alias("options"))


@query("SELECT n_regionkey AS schema_id, n_nationkey AS field_id, n_name AS field_name, CASE WHEN n_nationkey % 2 = 0 THEN [n_name, 'other'] END AS options FROM nation")
def schema_options(spark: SparkSession, d: str) -> DataFrame:
    options = F.when(F.col("n_nationkey") % 2 == 0, F.to_json(F.array("n_name", F.lit("other"))))
    fields = table(spark, d, "nation").select(F.col("n_regionkey").alias("schema_id"), F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit("l").alias("label"), F.lit("select").alias("type"), options.alias("options"), F.col("n_nationkey").alias("order_idx"))
    return rl.schema_fields(fields).select("schema_id", "field_id", "field_name", "options")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN ['I', source, lang] ELSE [source, lang] END AS names FROM documents")
def with_pov(spark: SparkSession, d: str) -> DataFrame:
    pov = F.when(F.col("doc_id") % 3 == 0, "I").when(F.col("doc_id") % 3 == 1, F.col("lang")).otherwise("")
    return table(spark, d, "documents").select("doc_id", ca.with_pov(F.array("source", "lang"), pov).alias("names"))


@query("""WITH t AS (SELECT doc_id, list_sort(list_distinct(string_split(coalesce(text, ''), ' '))) AS a, list_sort(list_distinct(string_split(source || ' the ' || lang, ' '))) AS b FROM documents)
SELECT doc_id, len(list_distinct(list_concat(a, b))) AS n_union, len(list_intersect(a, b)) AS n_both, len(a) - len(list_intersect(a, b)) AS n_only FROM t""")
def name_set_algebra(spark: SparkSession, d: str) -> DataFrame:
    """Union, intersection and difference of name sets."""
    words = F.split(F.coalesce("text", F.lit("")), " ")
    t = table(spark, d, "documents").select("doc_id", words.alias("a"), F.split(F.concat_ws(" the ", "source", "lang"), " ").alias("b"))
    return t.select("doc_id", F.size(F.array_union("a", "b")).cast("long").alias("n_union"), F.size(F.array_intersect("a", "b")).cast("long").alias("n_both"), F.size(F.array_except("a", "b")).cast("long").alias("n_only"))


_CARD = """SELECT n_nationkey, '# 角色卡 - ' || n_name || chr(10) || chr(10) || '## 1. 基础信息 (Profile)' || chr(10) || '- **角色名**：' || n_name || chr(10) || '- **核心身份**：a' || chr(10) || 'b' || chr(10) || '- **年龄/视觉印象**：' || chr(10) || chr(10)
 || '## 2. 性格内核 (Core Personality)' || chr(10) || '- **三个关键词**：x, y' || chr(10) || '- **行为逻辑**：l' || chr(10) || '- **道德基准**：e' || chr(10) || chr(10)
 || '## 3. 语言指纹 (Linguistic Fingerprint)' || chr(10) || '- **语调**：t' || chr(10) || '- **口癖/习惯**：h' || chr(10) || '- **称谓**：' || n_nationkey || chr(10) || chr(10)
 || '## 4. 知识边界 (Knowledge & Bias)' || chr(10) || '- **已知**：k' || chr(10) || '- **未知/偏见**：' || chr(10) || chr(10) || '## 5. 经典范例 (Sample Dialogue)' || chr(10) || '- “' || n_name || '！”' || chr(10) AS text FROM nation"""


@query(_CARD)
def card_markdown(spark: SparkSession, d: str) -> DataFrame:
    card = F.struct(
        F.struct(F.col("n_name").alias("name"), F.lit("a\\nb").alias("identity"), F.lit(None).cast("string").alias("impression")).alias("profile"),
        F.struct(F.array(F.lit("x"), F.lit("y")).alias("keywords"), F.lit("l").alias("logic"), F.lit("e").alias("ethics")).alias("personality"),
        F.struct(F.lit("t").alias("tone"), F.lit("h").alias("habit"), F.col("n_nationkey").cast("string").alias("address")).alias("linguistic_fingerprint"),
        F.struct(F.array(F.lit("k")).alias("known"), F.lit(None).cast("string").alias("bias")).alias("knowledge_boundary"),
        F.array(F.concat("n_name", F.lit("！"))).alias("sample_dialogue"),
    )
    return table(spark, d, "nation").select("n_nationkey", tx.character_card_markdown(card).alias("text"))


@query("SELECT * FROM (VALUES ('1_1', 'scene segmentation'), ('1_2', 'character consolidation'), ('1_3', 'scene facts'), ('1_4', 'world and character profiles'), ('1_5', 'dialogue annotation'), ('2_1', 'conversion to chats'), ('2_2', 'reasoning variants')) t(id, title), (SELECT count(*) AS n_texts FROM documents WHERE text IS NOT NULL)")
def list_steps(spark: SparkSession, d: str) -> DataFrame:
    """The registry's steps in order, with the number of texts that the first one takes in."""
    rows = json.dumps([{"id": i, "title": t} for i, t in steps.list_steps()])
    texts = table(spark, d, "documents").where("text is not null").agg(F.count("*").alias("n_texts"))
    return texts.select(F.explode(F.from_json(F.lit(rows), "array<struct<id: string, title: string>>")).alias("x"), "n_texts").select("x.*", "n_texts")


@query("SELECT doc_id, upper(text) AS text FROM documents WHERE coalesce(text, '') <> '' AND doc_id % 5 <> 0")
def row_processor(spark: SparkSession, d: str) -> DataFrame:
    """A processor by name over rows as dictionaries; None skips a row (every fifth here)."""

    def shout(row: dict) -> dict | None:
        return None if not row["text"] or row["doc_id"] % 5 == 0 else row | {"text": row["text"].translate(_UPPER)}

    rows = table(spark, d, "documents").select("doc_id", F.translate("text", _FOLDED, _FOLDED.upper()).alias("text"))
    return steps.process_rows(rows, shout)


_FOLDED = "abcdefghijklmnopqrstuvwxyz"
_UPPER = {ord(c): c.upper() for c in _FOLDED}
SQL["row_processor"] = "SELECT doc_id, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS text FROM documents WHERE coalesce(text, '') <> '' AND doc_id % 5 <> 0"
