"""Queries of record cleaning and chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions.fuzzy import similarity
from storyloom.operators import chains as cn
from storyloom.operators import cleaning as cl
from storyloom.operators import messages as ms
from storyloom.queries.common import table, turns

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def trace(spark: SparkSession, d: str) -> DataFrame:
    """A record per assistant turn: what was said before as its input, the turn as its output."""
    t = turns(spark, d)
    said = t.where("role = 'assistant'").select("conv_id", F.col("pos").alias("last"), F.col("content").alias("answer"))
    before = said.join(t, "conv_id").where("pos < last").groupBy("conv_id", "last", "answer").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "content"))).alias("m"))
    body = F.to_json(F.struct(F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages")))
    stamp = F.format_string("2024-01-01T%02d:%02d:00Z", (F.col("last") / 60).cast("int"), (F.col("last") % 60).cast("int"))
    return before.select(F.format_string("c%06d-%03d", "conv_id", "last").alias("id"), "conv_id", "last", stamp.alias("timestamp"), body.alias("input"), F.to_json(F.struct(F.col("answer").alias("content"))).alias("output"), F.lit("{}").alias("metadata"))


_TRACE = """rec AS (SELECT conv_id, turn AS last, text AS answer FROM conversations c WHERE role = 'assistant' AND turn > 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY last) AS i FROM rec)"""


@query(f"WITH {_TRACE} SELECT printf('c%06d-%03d', conv_id, last) AS id, (SELECT count(*) FROM conversations c WHERE c.conv_id = n.conv_id AND c.turn < n.last) AS msg_count FROM n")
def parse_records(spark: SparkSession, d: str) -> DataFrame:
    return cl.parse_records(trace(spark, d)).select("id", F.col("msg_count").cast("long").alias("msg_count"))


_LINKS = f"""{_TRACE}, m AS (SELECT a.conv_id, a.i, a.last AS a_last, b.i AS j, b.last AS b_last,
 EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = b.conv_id AND c.turn < b.last AND c.role = 'assistant' AND (CASE WHEN length(a.answer) < 20 THEN contains(c.text, a.answer) ELSE c.text = a.answer END)) AS hit
 FROM n a JOIN n b ON a.conv_id = b.conv_id AND b.i > a.i AND b.i - a.i <= 49 WHERE a.answer <> ''),
f AS (SELECT conv_id, i, a_last, min(j) AS j, arg_min(b_last, j) AS b_last FROM m WHERE hit GROUP BY conv_id, i, a_last),
l AS (SELECT *, row_number() OVER (PARTITION BY conv_id, j ORDER BY i) AS k FROM f),
link AS (SELECT printf('c%06d-%03d', conv_id, a_last) AS a_id, printf('c%06d-%03d', conv_id, b_last) AS b_id FROM l WHERE k = 1)"""


def _links(spark: SparkSession, d: str) -> DataFrame:
    parsed = cl.parse_records(trace(spark, d))
    return cn.links(cn.matches(cn.candidates(parsed, part="conv_id"), exact=True), "conv_id").select("a_id", "b_id")


@query(f"WITH {_LINKS} SELECT a_id, b_id FROM link")
def chain_links_exact(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d)


@query(f"""WITH RECURSIVE {_LINKS}, w AS (SELECT a_id AS root, a_id AS id, 0::BIGINT AS depth FROM link WHERE a_id NOT IN (SELECT b_id FROM link)
UNION ALL SELECT w.root, link.b_id, w.depth + 1 FROM w JOIN link ON link.a_id = w.id) SELECT root, id, depth FROM w""")
def chain_closure(spark: SparkSession, d: str) -> DataFrame:
    return cn.follow(_links(spark, d))


@query(f"""WITH RECURSIVE {_LINKS}, w AS (SELECT a_id AS root, a_id AS id FROM link WHERE a_id NOT IN (SELECT b_id FROM link)
UNION ALL SELECT w.root, link.b_id FROM w JOIN link ON link.a_id = w.id) SELECT root, count(*) AS length, count(*) - 1 AS delete_count FROM w GROUP BY root""")
def chain_stats(spark: SparkSession, d: str) -> DataFrame:
    return cn.chain_stats(cn.follow(_links(spark, d)))


@query()
def chain_links_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    """Links by containment, over the (timestamp, id) order of each conversation's records."""
    parsed = cl.parse_records(trace(spark, d))
    return cn.links(cn.matches(cn.candidates(parsed, part="conv_id")), "conv_id").select("a_id", "b_id")


@query("""WITH rec AS (SELECT conv_id, turn AS last, text AS answer, row_number() OVER (ORDER BY turn, conv_id) AS i FROM conversations WHERE role = 'assistant' AND turn > 0),
m AS (SELECT a.i, b.i AS j, a.conv_id AS ac, a.last AS al, b.conv_id AS bc, b.last AS bl,
 EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = b.conv_id AND c.turn < b.last AND c.role = 'assistant' AND (CASE WHEN length(a.answer) < 20 THEN contains(c.text, a.answer) ELSE c.text = a.answer END)) AS hit
 FROM rec a JOIN rec b ON b.i > a.i AND b.i - a.i <= 49 WHERE a.answer <> ''),
f AS (SELECT i, ac, al, min(j) AS j, arg_min(bc, j) AS bc, arg_min(bl, j) AS bl FROM m WHERE hit GROUP BY i, ac, al),
l AS (SELECT *, row_number() OVER (PARTITION BY j ORDER BY i) AS k FROM f)
SELECT printf('c%06d-%03d', ac, al) AS a_id, printf('c%06d-%03d', bc, bl) AS b_id FROM l WHERE k = 1""")
def chain_links_global(spark: SparkSession, d: str) -> DataFrame:
    """Links over the global (timestamp, id) order of all records."""
    return cn.links(cn.matches(cn.candidates(cl.parse_records(trace(spark, d))), exact=True)).select("a_id", "b_id")


@query()
def chain_merge(spark: SparkSession, d: str) -> DataFrame:
    return cn.merge_chains(trace(spark, d), cn.follow(_links(spark, d)))


@query("""WITH s AS (SELECT conv_id, turn, role, text, CASE turn % 4 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN '{"content":""}' ELSE '{"content":"x"}' END AS o FROM conversations)
SELECT conv_id, turn FROM s WHERE turn % 4 = 3 OR role = 'assistant'""")
def remove_empty_records(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "conversations")
    m = F.col("turn") % 4
    rows = t.withColumn("input", F.to_json(F.struct(F.array(F.struct("role", F.col("text").alias("content"))).alias("messages")))).withColumn("output", F.when(m == 0, "").when(m == 1, " ").when(m == 2, '{"content":""}').otherwise('{"content":"x"}'))
    return cl.remove_empty_records(rows).select("conv_id", "turn")


@query("""SELECT event_id, CASE event_id % 3 WHEN 2 THEN 'plain' ELSE props END AS value, event_id % 3 <> 2 AS changed FROM events""")
def fix_json_strings(spark: SparkSession, d: str) -> DataFrame:
    """Properties encoded twice, or coloured for a terminal, back to JSON."""
    e = table(spark, d, "events")
    twice = F.to_json(F.struct(F.col("props").alias("p")))
    twice = F.regexp_extract(twice, r'^\{"p":(.*)\}$', 1)
    m = F.col("event_id") % 3
    value = F.when(m == 0, twice).when(m == 1, F.concat(F.lit("\x1b[31m"), "props", F.lit("\x1b[0m"))).otherwise("plain")
    fixed = cl.fix_json_strings(e.select("event_id", value.alias("value")), "value")
    compact = F.when(m != 2, F.to_json(F.try_parse_json("value"))).otherwise(F.col("value"))
    return fixed.select("event_id", compact.alias("value"), "changed").withColumn("value", F.when(m != 2, F.regexp_replace("value", ":", ": ")).otherwise(F.col("value")))


@query("""WITH o AS (SELECT o_custkey AS k, CAST(date_diff('day', DATE '1992-01-01', o_orderdate) AS BIGINT) AS s FROM orders), i AS (SELECT k, s, s + 30 + s % 7 AS e FROM o),
m AS (SELECT *, max(e) OVER (PARTITION BY k ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
r AS (SELECT *, sum(CASE WHEN s <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY s, e) AS run FROM m)
SELECT k, min(s) AS s, max(e) AS e FROM r GROUP BY k, run""")
def interval_union(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("long").alias("s"))
    return cl.interval_union(o.withColumn("e", F.col("s") + 30 + F.col("s") % 7), "k", "s", "e")


@query("SELECT doc_id, substr(text, 1, 3) || substr(text, 9, 11) || substr(text, 31) AS text FROM documents")
def interval_subtract(spark: SparkSession, d: str) -> DataFrame:
    spans = F.array(F.struct(F.lit(3).alias("start"), F.lit(8).alias("end")), F.struct(F.lit(19).alias("start"), F.lit(30).alias("end")))
    return table(spark, d, "documents").select("doc_id", cl.subtract_intervals("text", spans).alias("text"))


def _system(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).withColumn("role", F.when(F.col("pos") % 3 == 0, "system").otherwise(F.col("role")))
    first = t.where("pos = 0").select("conv_id", F.col("content").alias("first"))
    rows = t.join(first, "conv_id").withColumn("content", F.when(F.col("pos") % 6 == 3, F.concat("content", F.lit(" "), "first")).otherwise(F.col("content")))
    body = F.to_json(F.struct(F.col("messages")))
    return ms.to_arrays(rows, "conv_id").select(F.col("conv_id").cast("string").alias("id"), body.alias("input"))


@query()
def system_dedup(spark: SparkSession, d: str) -> DataFrame:
    return cl.rewrite_messages(_system(spark, d), cl.dedup_system)


@query()
def system_merge(spark: SparkSession, d: str) -> DataFrame:
    return cl.rewrite_messages(_system(spark, d), cl.merge_system)


@query()
def rewrite_counts(spark: SparkSession, d: str) -> DataFrame:
    return cl.rewrite_counts(cl.rewrite_messages(_system(spark, d), cl.dedup_system))


@query("SELECT item_id, CASE WHEN text = '' THEN 0.0 ELSE 1.0 END::DOUBLE AS sim FROM benchmark")
def containment_self(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select("item_id", similarity("text", "text").alias("sim"))
