"""Queries of the annotation layer. Documents stand for records, labels for annotations, sources for queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.operators import ordering as od
from storyloom.operators import relational as rl
from storyloom.plans import steps
from storyloom.queries.common import table
from storyloom.sources import readers

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_REC = """rec AS (SELECT CAST(event_id AS VARCHAR) AS id, event_type AS type, event_type || ' ' || CAST(user_id AS VARCHAR) AS name, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, props AS input FROM events)"""


def records(spark: SparkSession, d: str) -> DataFrame:
    """Events as trace records."""
    e = table(spark, d, "events")
    return e.select(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("type"), F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("name"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col("props").alias("input"))


_ANN = """q AS (SELECT DISTINCT CAST(substr(source, 4) AS BIGINT) AS id, source AS name, CAST(substr(source, 4) AS BIGINT) % 3 AS schema_id FROM documents),
s AS (SELECT CAST(i AS BIGINT) AS id, 'schema' || i AS name FROM range(0, 2) t(i)),
qi AS (SELECT d.doc_id AS id, CAST(substr(d.source, 4) AS BIGINT) AS queue_id, CAST(d.doc_id AS VARCHAR) AS record_id, CASE WHEN l.doc_id IS NULL THEN 'pending' ELSE 'annotated' END AS status FROM documents d LEFT JOIN labels l USING (doc_id)),
an AS (SELECT doc_id AS queue_item_id, '{"quality":' || quality || ',"toxic":' || toxic || '}' AS vals FROM labels),
r AS (SELECT CAST(doc_id AS VARCHAR) AS id, lang AS name, text AS input, source AS metadata FROM documents),
ds AS (SELECT CAST(i AS BIGINT) AS id, 'set ' || i AS name FROM range(0, 8) t(i)),
di AS (SELECT doc_id AS id, doc_id % 7 AS dataset_id, CAST(doc_id AS VARCHAR) AS record_id, CASE WHEN doc_id % 3 = 0 THEN 'annotated' ELSE 'raw' END AS source, doc_id AS queue_item_id FROM documents)"""


class Tables:
    """The annotation tables as views of the driver's ones."""

    def __init__(self, spark: SparkSession, d: str) -> None:
        docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
        src = F.substring("source", 4, 9).cast("long")
        self.queues = docs.select(src.alias("id"), F.col("source").alias("name"), (src % 3).alias("schema_id")).distinct()
        self.schemas = spark.range(2).select("id", F.concat(F.lit("schema"), F.col("id").cast("string")).alias("name"))
        marked = docs.join(labels.select("doc_id", F.lit(True).alias("has")), "doc_id", "left")
        self.queue_items = marked.select(F.col("doc_id").alias("id"), src.alias("queue_id"), F.col("doc_id").cast("string").alias("record_id"), F.when(F.col("has"), "annotated").otherwise("pending").alias("status"))
        self.annotations = labels.select(F.col("doc_id").alias("queue_item_id"), F.format_string('{"quality":%d,"toxic":%d}', "quality", "toxic").alias("values"))
        self.records = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("name"), F.col("text").alias("input"), F.col("source").alias("metadata"))
        self.datasets = spark.range(8).select("id", F.concat(F.lit("set "), F.col("id").cast("string")).alias("name"))
        kind = F.when(F.col("doc_id") % 3 == 0, "annotated").otherwise("raw")
        self.dataset_items = docs.select(F.col("doc_id").alias("id"), (F.col("doc_id") % 7).alias("dataset_id"), F.col("doc_id").cast("string").alias("record_id"), kind.alias("source"), F.col("doc_id").alias("queue_item_id"))


@query(f"WITH {_REC} SELECT id, name, timestamp FROM rec ORDER BY timestamp DESC, id LIMIT 50 OFFSET 100")
def records_page(spark: SparkSession, d: str) -> DataFrame:
    return od.page(records(spark, d).select("id", "name", "timestamp"), [F.desc("timestamp"), F.col("id")], 50, 100)


@query(f"WITH {_REC} SELECT id, name FROM rec WHERE lower(id) LIKE '%k 1_%' OR lower(name) LIKE '%k 1_%'")
def records_search(spark: SparkSession, d: str) -> DataFrame:
    return rl.matching(records(spark, d), search="K 1_").select("id", "name")


@query(f"WITH {_REC}, b AS (SELECT min(timestamp) AS a, max(timestamp) AS z FROM rec) SELECT id, timestamp FROM rec WHERE timestamp >= '2024-01-10T00:00:00' AND timestamp <= '2024-02-20T12:00:00'")
def time_range(spark: SparkSession, d: str) -> DataFrame:
    return rl.matching(records(spark, d), start="2024-01-10T00:00:00", end="2024-02-20T12:00:00").select("id", "timestamp")


@query(f"WITH {_REC} SELECT count(*) AS total, count(DISTINCT name) AS names FROM rec WHERE name LIKE '%1%'")
def records_total(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).where(rl.like_ascii("name", "1")).agg(F.count("*").alias("total"), F.count_distinct("name").alias("names"))


@query(f"WITH {_ANN} SELECT q.id, q.name, q.schema_id, s.name AS schema_name, count(qi.id) AS total, CAST(sum(CASE WHEN qi.status = 'annotated' THEN 1 ELSE 0 END) AS BIGINT) AS annotated FROM q JOIN s ON q.schema_id = s.id LEFT JOIN qi ON qi.queue_id = q.id GROUP BY ALL")
def queue_summary(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return rl.queue_summary(t.queues, t.schemas, t.queue_items)


@query(f"WITH {_ANN} SELECT ds.id, ds.name, count(di.id) AS items FROM ds LEFT JOIN di ON di.dataset_id = ds.id GROUP BY ds.id, ds.name")
def dataset_summary(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return rl.dataset_summary(t.datasets, t.dataset_items)


@query(f"WITH {_ANN} SELECT qi.id AS item_id, qi.record_id, qi.status, r.name, r.input FROM qi JOIN r ON r.id = qi.record_id WHERE qi.queue_id = 3 AND qi.status = 'annotated' ORDER BY item_id LIMIT 20 OFFSET 2")
def queue_items_page(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    rows = rl.queue_items(t.queue_items, t.records, 3, "annotated").select("item_id", "record_id", "status", "name", "input")
    return od.page(rows, [F.col("item_id")], 20, 2)


@query(f"WITH {_ANN} SELECT id FROM qi WHERE queue_id = 5 ORDER BY id")
def queue_item_ids(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).queue_items.where("queue_id = 5").select("id").orderBy("id")


@query(f"WITH {_ANN} SELECT di.id AS item_id, di.record_id, di.source, r.name, an.vals AS annotation FROM di JOIN r ON r.id = di.record_id LEFT JOIN an ON an.queue_item_id = di.queue_item_id WHERE di.dataset_id = 2 AND di.source = 'annotated' AND an.vals LIKE '%\"toxic\":0%'")
def dataset_items_page(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    rows = rl.dataset_items(t.dataset_items, t.records, t.annotations, 2, "annotated")
    return rl.with_values_like(rows, '"toxic":0').select("item_id", "record_id", "source", "name", F.col("values").alias("annotation"))


@query(f"WITH {_ANN} SELECT di.id AS item_id, di.record_id, 0::INTEGER AS n_messages, CASE WHEN di.source = 'annotated' THEN an.vals END AS annotations, r.metadata FROM di JOIN r ON r.id = di.record_id LEFT JOIN an ON an.queue_item_id = di.queue_item_id WHERE di.dataset_id = 4")
def export_dataset(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return rl.export_dataset(t.dataset_items, t.records, t.annotations, 4).select("item_id", "record_id", F.size("messages").alias("n_messages"), "annotations", "metadata")


@query("SELECT doc_id, any_value(text) AS text, 'old' AS origin FROM documents WHERE doc_id % 3 = 0 GROUP BY doc_id UNION ALL SELECT doc_id, text, 'new' FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 2 = 0")
def insert_or_ignore(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    old = docs.where("doc_id % 3 = 0").withColumn("origin", F.lit("old"))
    new = docs.where("doc_id % 2 = 0").withColumn("origin", F.lit("new"))
    new = new.withColumn("line", F.lit(0)).unionAll(new.withColumn("text", F.lit("later")).withColumn("line", F.lit(1)))
    return rl.insert_or_ignore(old, new, ["doc_id"], "line")


@query("SELECT count(DISTINCT doc_id) FILTER (doc_id % 3 <> 0) AS added, 2 * count(*) - count(DISTINCT doc_id) FILTER (doc_id % 3 <> 0) AS skipped FROM documents WHERE doc_id % 2 = 0")
def insert_counts(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id")
    new = docs.where("doc_id % 2 = 0")
    return rl.insert_counts(docs.where("doc_id % 3 = 0"), new.unionAll(new), ["doc_id"])


@query(f"WITH {_ANN} SELECT coalesce(n.k, an.queue_item_id) AS queue_item_id, coalesce(n.v, an.vals) AS annotation FROM an FULL JOIN (SELECT doc_id AS k, '{{}}' AS v FROM documents WHERE doc_id % 5 = 0) n ON n.k = an.queue_item_id")
def upsert_annotations(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    new = table(spark, d, "documents").where("doc_id % 5 = 0").select(F.col("doc_id").alias("queue_item_id"), F.lit("{}").alias("values"))
    return rl.annotate(t.queue_items, t.annotations, new)[0].select("queue_item_id", F.col("values").alias("annotation"))


@query(f"WITH {_ANN} SELECT id, queue_id, CASE WHEN id % 5 = 0 THEN 'annotated' ELSE status END AS status FROM qi")
def annotated_items(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    new = table(spark, d, "documents").where("doc_id % 5 = 0").select(F.col("doc_id").alias("queue_item_id"), F.lit("{}").alias("values"))
    return rl.annotate(t.queue_items, t.annotations, new)[1].select("id", "queue_id", "status")


@query(f"WITH {_ANN} SELECT CAST(5 AS BIGINT) AS queue_id, r.id AS record_id, 'pending' AS status FROM r WHERE lower(r.name) LIKE '%e%' AND NOT EXISTS (SELECT 1 FROM qi WHERE qi.queue_id = 5 AND qi.record_id = r.id)")
def enqueue_all(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return rl.enqueue_all(t.queue_items, t.records, 5, search="E")


@query(f"""WITH {_ANN}, w AS (SELECT doc_id AS k FROM documents WHERE doc_id % 5 < 2), j AS (SELECT w.k, qi.record_id, coalesce(qi.status = 'annotated', false) AS ok, di.id IS NOT NULL AS have FROM w LEFT JOIN qi ON qi.id = w.k LEFT JOIN di ON di.dataset_id = 3 AND di.record_id = qi.record_id)
SELECT count(*) FILTER (ok AND NOT have) AS added, count(*) FILTER (ok AND have) AS duplicates, count(*) FILTER (NOT ok) AS skipped FROM j""")
def add_annotated(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    wanted = table(spark, d, "documents").where("doc_id % 5 < 2").select(F.col("doc_id").alias("queue_item_id"))
    return rl.add_annotated(t.queue_items, t.dataset_items, wanted, 3)


@query(f"WITH {_ANN} SELECT id, record_id FROM qi WHERE queue_id NOT IN (1, 2)")
def delete_cascade(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return rl.delete_cascade(t.queue_items, t.queues.where("id in (1, 2)"), "id", "queue_id").select("id", "record_id")


@query(f"""WITH {_ANN}, m AS (SELECT id, dataset_id, record_id AS was, CAST(CAST(record_id AS BIGINT) // 28 * 28 AS VARCHAR) AS now FROM di),
k AS (SELECT *, row_number() OVER (PARTITION BY dataset_id, now ORDER BY CASE WHEN was = now THEN 0 ELSE 1 END, id) AS n FROM m) SELECT id, dataset_id, now AS record_id FROM k WHERE n = 1""")
def repoint_items(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    survivors = t.records.select(F.col("id").alias("record_id"), (F.floor(F.col("id").cast("long") / 28) * 28).cast("string").alias("survivor"))
    return rl.repoint(t.dataset_items, survivors, "dataset_id").select("id", "dataset_id", "record_id")


@query(f"WITH {_ANN} SELECT queue_item_id, CAST(json_extract_string(vals, '$.quality') AS DOUBLE) AS quality, CAST(greatest(1, least(10, CAST(json_extract_string(vals, '$.toxic') AS INTEGER))) AS INTEGER) AS toxic, 5::INTEGER AS other FROM an")
def typed_values(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return rl.typed_values(t.annotations, [("quality", "number"), ("toxic", "score"), ("other", "score")]).select("queue_item_id", "quality", "toxic", "other")


@query("SELECT doc_id, source AS \"Title\" FROM documents WHERE source IS NULL OR source NOT IN (SELECT source FROM documents WHERE doc_id < 6)")
def unprocessed_rows(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.col("source").alias("Title"))
    return rl.unprocessed(docs, docs.where("doc_id < 6")).select("doc_id", "Title")


@query("SELECT DISTINCT trim(unnest(string_split(source || ', ' || lang || ',,x', ','))) AS tag FROM documents WHERE true EXCEPT SELECT ''")
def tag_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    tags = table(spark, d, "documents").select(F.concat("source", F.lit(", "), "lang", F.lit(",,x")).alias("tags"))
    return rl.tag_vocabulary(tags, tags.limit(0))


@query("""WITH res AS (SELECT doc_id, 2 AS k, 'g' || quality AS genre, toxic = 1 AS unknown FROM labels)
SELECT d.doc_id AS "Uid", CASE WHEN r.doc_id IS NULL THEN 'Error' WHEN unknown THEN '未知' ELSE r.genre END AS genre, CASE WHEN r.doc_id IS NULL THEN 'Error' WHEN unknown THEN '未知' ELSE 'a,b' END AS tags,
CASE WHEN r.doc_id IS NULL THEN 'Mismatch/Error' WHEN unknown THEN '未知作品' ELSE 's' END AS summary, coalesce(unknown, true) AS unknown FROM documents d LEFT JOIN res r ON r.doc_id = d.doc_id""")
def augment_lookup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("Uid"))
    one = table(spark, d, "labels").select(F.col("doc_id").alias("Uid"), F.lit(2).alias("k"), F.concat(F.lit("g"), F.col("quality").cast("string")).alias("genre"), F.array(F.lit("a"), F.lit("b")).alias("tags"), F.lit("s").alias("summary"), (F.col("toxic") == 1).alias("unknown"))
    old = one.withColumn("k", F.lit(1)).withColumn("genre", F.lit("old"))
    return rl.augment_lookup(rows, old.unionAll(one), "k")


@query()
def augment_catalog(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("Uid"), F.col("source").alias("Title"))
    out = steps.augment_catalog(rows)
    return out.select("Uid", "Title", "genre", "tags", "summary", "unknown")


@query("SELECT conv_id, turn FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM conversations o WHERE o.conv_id = c.conv_id AND o.turn = c.turn AND o.turn < 2)")
def skip_finished(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn")
    return readers.not_done(rows, rows.where("turn < 2"), ["conv_id", "turn"])


@query("""SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, CASE WHEN doc_id % 2 = 0 THEN 't' || doc_id ELSE 's' || doc_id END AS timestamp, CASE WHEN doc_id % 3 = 0 THEN 'null' ELSE lang END AS input, 'null' AS metadata FROM documents""")
def import_records(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("t"), F.col("doc_id").cast("string"))).otherwise("").alias("timestamp"), F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("startTime"), F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("input"), F.col("doc_id").alias("line"))
    return rl.import_records(rows, "line").select("id", "timestamp", "input", "metadata")
