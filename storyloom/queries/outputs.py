"""Queries of named output files: what is written is listed by name and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.operators import chunking
from storyloom.plans.lineage import new_path
from storyloom.queries.common import table
from storyloom.sources import named, readers

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT source AS book, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS VARCHAR) || '.txt' AS file, text FROM documents WHERE coalesce(text, '') <> ''")
def numbered_files(spark: SparkSession, d: str) -> DataFrame:
    """``{book}/{n}.txt`` of each source's documents."""
    path = new_path(spark, "numbered")
    named.write_numbered(table(spark, d, "documents"), path, "source", ["doc_id"], "text")
    return readers.read_named_texts(spark, path).select("book", "file", "text")


@query("""WITH s AS (SELECT source, doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
c AS (SELECT source, doc_id, 0 AS i, x[1] AS content FROM s UNION ALL SELECT source, doc_id, 1, array_to_string(x[2:], chr(10)) FROM s)
SELECT source || '/' || doc_id || '_00' || i || '.txt' AS file, CAST(strlen(content) AS BIGINT) AS bytes FROM c WHERE content <> '' AND source <> (SELECT min(source) FROM documents)""")
def scene_files(spark: SparkSession, d: str) -> DataFrame:
    """``{book}/{scene_id}.txt``: a document's first line and the rest as scenes; the first source has its folder already and is left out."""
    path = new_path(spark, "scenes")
    docs = table(spark, d, "documents").select(F.col("source").alias("book"), "doc_id", F.split(F.coalesce("text", F.lit("")), "\n").alias("x"))
    parts = F.array(F.get("x", F.lit(0)), F.array_join(F.slice("x", F.lit(2), F.greatest(F.lit(0), F.size("x") - 1)), "\n"))
    scenes = docs.select("book", "doc_id", F.posexplode(parts).alias("i", "content")).where("content <> ''")
    scenes = scenes.withColumn("scene_id", F.format_string("%s_%03d", F.col("doc_id").cast("string"), "i"))
    named.write_scenes(scenes, path, done=docs.agg(F.min("book").alias("book")))
    return named.written(spark, path, ".txt")


@query("SELECT source AS book, CAST(doc_id AS VARCHAR) AS stem, text FROM documents WHERE coalesce(text, '') <> '' AND lang = 'en' AND n_chars > 500")
def segment_files(spark: SparkSession, d: str) -> DataFrame:
    """Segments with both companion files, from files that this engine has written: characters for English texts, facts for long ones."""
    path = new_path(spark, "segments")
    docs = table(spark, d, "documents").where("coalesce(text, '') <> ''").select(F.col("source").alias("book"), F.col("doc_id").cast("string").alias("stem"), "text", "lang", "n_chars")
    named.write_texts(docs.select(F.concat("book", F.lit("/"), "stem", F.lit(".txt")).alias("file"), "text"), path)
    named.write_json_files(docs.where("lang = 'en'").select("book", "stem", F.array("lang").alias("characters")), path, suffix="_characters.json")
    named.write_json_files(docs.where("n_chars > 500").select("book", "stem", F.lit("s").alias("summary")), path, suffix="_facts.json")
    companions = [readers.read_named_documents(spark, path, "summary string", f) for f in ("_characters.json", "_facts.json")]
    return readers.segments(readers.read_named_texts(spark, path), *companions).select("book", "stem", "text")


@query("""WITH n AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)
SELECT 'docs_part' || (i // 150) || '.jsonl' AS file, doc_id, text FROM n UNION ALL SELECT 'all.jsonl', doc_id, text FROM n""")
def row_part_files(spark: SparkSession, d: str) -> DataFrame:
    """``{stem}_part{i}.jsonl`` of 150 rows each, and ``{stem}.jsonl`` where all rows fit."""
    path = new_path(spark, "parts")
    docs = table(spark, d, "documents").select("doc_id", "text")
    named.write_row_parts(docs, path, "docs", "doc_id", 150)
    named.write_row_parts(docs, path, "all", "doc_id")
    rows = spark.read.schema("doc_id long, text string").json(path)
    return rows.select(F.col("_metadata.file_name").alias("file"), "doc_id", "text")


@query("""WITH RECURSIVE s AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i, strlen(coalesce(text, '')) AS n FROM documents),
f AS (SELECT lang, doc_id, i, 1 AS shard, n AS cur FROM s WHERE i = 1 UNION ALL
  SELECT s.lang, s.doc_id, s.i, CASE WHEN f.cur + s.n > 20000 AND f.cur > 0 THEN f.shard + 1 ELSE f.shard END, CASE WHEN f.cur + s.n > 20000 AND f.cur > 0 THEN s.n ELSE f.cur + s.n END FROM f JOIN s ON s.lang = f.lang AND s.i = f.i + 1)
SELECT lang, 'shard_' || lpad(CAST(shard AS VARCHAR), CAST(greatest(3, length(CAST(shard AS VARCHAR))) AS INTEGER), '0') || '.jsonl' AS file, doc_id FROM f""")
def byte_shard_files(spark: SparkSession, d: str) -> DataFrame:
    """``shard_001.jsonl`` and so on in a folder for each language, of at most 20,000 bytes of text."""
    path = new_path(spark, "shards")
    docs = table(spark, d, "documents").select("lang", "doc_id", "text")
    shards = chunking.byte_shards(docs, F.coalesce(F.octet_length("text"), F.lit(0)), "lang", "doc_id", 20_000)
    named.write_byte_shards(docs.join(shards, ["lang", "doc_id"]), path, ["doc_id"], part="lang")
    rows = spark.read.option("recursiveFileLookup", "true").schema("doc_id long").json(path)
    return rows.select(F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]+$", 1).alias("lang"), F.col("_metadata.file_name").alias("file"), "doc_id")


@query("SELECT 'train-00000-of-00001.parquet' AS file, doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents")
def train_file(spark: SparkSession, d: str) -> DataFrame:
    """``train-00000-of-00001.parquet``, its rows in order."""
    path = new_path(spark, "train")
    named.write_train_files(table(spark, d, "documents").select("doc_id", "text"), path, order=["doc_id"])
    rows = spark.read.parquet(path)
    return rows.select(F.col("_metadata.file_name").alias("file"), "doc_id", "text", F.col("_metadata.row_index").cast("long").alias("place"))


_CARDS = """WITH t AS (SELECT n_nationkey, n_name, n_regionkey, coalesce(r_name, '') AS r FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 4 <> 0)
SELECT n_name || '/世界观.md' AS file, 'World of' || chr(10) || r AS text FROM t
UNION ALL SELECT n_name || '/index.json', '{"world_view":"世界观.md","characters":{"A ' || r || '":"角色卡-A ' || r || '.md","B/' || n_name || '":"角色卡-B' || n_name || '.md"}}' FROM t
UNION ALL SELECT n_name || '/角色卡-A ' || r || '.md', NULL FROM t UNION ALL SELECT n_name || '/角色卡-B' || n_name || '.md', NULL FROM t"""


@query(_CARDS)
def annotation_files(spark: SparkSession, d: str) -> DataFrame:
    """The files of annotated works: world view, index and cards by name (the cards' texts are those of ``card_markdown``); unknown works have none."""
    path = new_path(spark, "cards")
    t = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cards = F.array(*[_card(F.concat(F.lit(p), n)) for p, n in (("A ", F.col("r_name")), ("B/", F.col("n_name")))])
    known = t.select(F.col("n_name").alias("title"), (F.col("n_nationkey") % 4 == 0).alias("unknown"), F.concat(F.lit("World of\\n"), "r_name").alias("worldview"), cards.alias("character_cards"))
    named.write_texts(named.annotation_files(known), path)
    texts = readers.read_whole_text(spark, path, "")
    return texts.select(F.concat_ws("/", "book", "file").alias("file"), F.when(~F.col("file").startswith("角色卡"), F.col("text")).alias("text"))


def _card(name):
    word = F.lit("w")
    return F.struct(
        F.struct(name.alias("name"), word.alias("identity"), word.alias("impression")).alias("profile"),
        F.struct(F.array(word).alias("keywords"), word.alias("logic"), word.alias("ethics")).alias("personality"),
        F.struct(word.alias("tone"), word.alias("habit"), word.alias("address")).alias("linguistic_fingerprint"),
        F.struct(F.array(word).alias("known"), word.alias("bias")).alias("knowledge_boundary"),
        F.array(word).alias("sample_dialogue"),
    )
