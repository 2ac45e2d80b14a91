"""Queries over characters and story state. Capitalised words of documents stand for names, sources for books."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.operators import characters as ca
from storyloom.operators import state as st
from storyloom.plans import steps
from storyloom.plans.lineage import new_path
from storyloom.queries.common import SQL_LINES, doc_lines, table, turns
from storyloom.streaming import folds

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def mentions(spark: SparkSession, d: str) -> DataFrame:
    """(source, doc_id, names)."""
    return table(spark, d, "documents").where("text is not null").select("source", "doc_id", F.regexp_extract_all("text", F.lit(r"([A-Z][a-z]{3,7})"), F.lit(1)).alias("names"))


_N = r"m AS (SELECT source, doc_id, regexp_extract_all(text, '([A-Z][a-z]{3,7})', 1) AS names FROM documents WHERE text IS NOT NULL)"
_COUNTS = f"{_N}, c AS (SELECT source, name, count(*) AS n FROM (SELECT DISTINCT source, doc_id, unnest(names) AS name FROM m) GROUP BY source, name)"


@query(f"WITH {_COUNTS} SELECT source, name, n FROM c")
def appearance_counts(spark: SparkSession, d: str) -> DataFrame:
    return ca.appearances(mentions(spark, d), "source", "names")


@query(f"WITH {_COUNTS} SELECT source, name, n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, name) AS r FROM c) WHERE r = 1")
def most_frequent(spark: SparkSession, d: str) -> DataFrame:
    return ca.most_frequent(appearance_counts(spark, d), "source")


@query(f"WITH {_COUNTS}, t AS (SELECT source, count(*) AS total FROM m GROUP BY source) SELECT c.source, c.name, c.n FROM c JOIN t ON c.source = t.source WHERE c.n >= greatest(1, total * 10 // 100)")
def main_characters(spark: SparkSession, d: str) -> DataFrame:
    m = mentions(spark, d)
    return ca.main_characters(ca.appearances(m, "source", "names"), m.groupBy("source").agg(F.count("*").alias("total")), "source", 10)


_WORDS = "(VALUES (0, '他'), (1, '妈妈'), (2, '的妈妈'), (3, '莉莉的妈妈'), (4, '那个'), (5, '张医生'), (6, ' 桃华 '), (7, '一'), (8, '王先生'), (9, '之父亲')) w(k, name)"


@query(f"SELECT d.doc_id, string_agg(trim(name), ',' ORDER BY k) AS names FROM documents d, {_WORDS} WHERE (d.doc_id + k) % 3 <> 0 AND name IN ('莉莉的妈妈', ' 桃华 ') GROUP BY d.doc_id")
def name_filter(spark: SparkSession, d: str) -> DataFrame:
    words = ["他", "妈妈", "的妈妈", "莉莉的妈妈", "那个", "张医生", " 桃华 ", "一", "王先生", "之父亲"]
    some = F.filter(F.array(*[F.lit(w) for w in words]), lambda x, i: (F.col("doc_id") + i) % 3 != 0)
    out = table(spark, d, "documents").select("doc_id", F.array_join(ca.name_set(some), ",").alias("names"))
    return out.where("names <> ''")


@query(f"""WITH {_N}, a AS (SELECT source, name, count(*) AS freq, min(doc_id) AS pos FROM (SELECT source, doc_id, unnest(names) AS name FROM m) GROUP BY source, name),
p AS (SELECT source, name, freq, row_number() OVER (PARTITION BY source ORDER BY pos, name) AS pos FROM a),
s AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY freq DESC, pos) + row_number() OVER (PARTITION BY source ORDER BY length(name) DESC, pos) AS sc, count(*) OVER (PARTITION BY source) AS n FROM p),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY sc, pos) AS r FROM s) SELECT source, name, freq FROM k WHERE r <= 6 OR n <= 6""")
def alias_prune(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    each = mentions(spark, d).select("source", "doc_id", F.explode("names").alias("name")).groupBy("source", "name").agg(F.count("*").alias("freq"), F.min("doc_id").alias("first"))
    rows = each.withColumn("pos", F.row_number().over(Window.partitionBy("source").orderBy("first", "name")))
    return ca.alias_prune(rows, "source").select("source", "name", "freq")


@query()
def name_group_fold(spark: SparkSession, d: str) -> DataFrame:
    m = mentions(spark, d).select(F.col("source").alias("book"), F.col("doc_id").alias("segment"), F.posexplode("names").alias("pos", "name"))
    rows = m.select("book", "segment", "pos", F.array("name").alias("names"), F.create_map("name", F.lit(1)).alias("freqs"))
    return ca.name_groups(rows)


@query("""WITH t AS (SELECT conv_id, turn, role = 'user' AS fp, CASE WHEN turn % 4 = 2 THEN 'N' || turn ELSE '' END AS nm FROM conversations),
k AS (SELECT *, CASE WHEN fp THEN nullif(nm, '') END AS k FROM t)
SELECT conv_id, turn, CASE WHEN fp THEN coalesce(last_value(k IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn), first_value(k IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) ELSE nullif(nm, '') END AS pov FROM k""")
def pov_fill(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", (F.col("role") == "user").alias("is_first_person"), F.when(F.col("turn") % 4 == 2, F.concat(F.lit("N"), F.col("turn").cast("string"))).otherwise("").alias("first_person_name"))
    return ca.pov_fill(rows, "conv_id", "turn")


@query("""SELECT doc_id, CASE WHEN n = 0 THEN '无明确出场角色' WHEN n = 1 THEN 'src1（别称：one、uno）' ELSE 'src1（别称：one、uno）、' || lang END AS text FROM (SELECT doc_id, lang, doc_id % 3 AS n FROM documents)""")
def alias_decoration(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id") % 3
    rows = table(spark, d, "documents").select("doc_id", F.when(n == 0, F.array().cast("array<string>")).when(n == 1, F.array(F.lit("src1"))).otherwise(F.array(F.lit("src1"), "lang")).alias("names"))
    alias = spark.sql("select 'src1' as name, array('one', 'uno') as alias")
    return ca.decorated(rows, "doc_id", "names", alias)


@query("SELECT doc_id, string_agg(n, ',' ORDER BY k) AS names FROM (SELECT doc_id, 1 AS k, 'First' AS n FROM documents UNION ALL SELECT doc_id, 2, lang FROM documents) GROUP BY doc_id")
def formal_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.array("source", "lang", "source").alias("names"))
    alias = table(spark, d, "documents").select(F.col("source").alias("alias")).distinct().withColumn("formal", F.lit("First"))
    return ca.formal_names("names", alias, rows, "doc_id").select("doc_id", F.array_join("characters", ",").alias("names"))


@query(f"""WITH {_COUNTS}, top AS (SELECT source, name FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, name) AS r FROM c) WHERE r = 1)
SELECT m.doc_id, CASE WHEN m.doc_id % 5 = 0 THEN 'Pov' ELSE coalesce(top.name, m.names[1]) END AS user_role FROM m LEFT JOIN top ON m.source = top.source WHERE m.doc_id % 5 = 0 OR coalesce(top.name, m.names[1]) IS NOT NULL""")
def user_role(spark: SparkSession, d: str) -> DataFrame:
    seg = mentions(spark, d).select(F.col("source").alias("book"), "doc_id", F.col("names").alias("characters"), (F.col("doc_id") % 5 == 0).alias("is_pov"), F.when(F.col("doc_id") % 5 == 0, "Pov").otherwise("").alias("pov_name"))
    top = most_frequent(spark, d).withColumnRenamed("source", "book")
    return ca.resolve_user_role(seg, top).select("doc_id", "user_role")


_SCENES = """WITH f AS (SELECT source AS book, printf('%06d', doc_id) AS stem, text, row_number() OVER (PARTITION BY source ORDER BY printf('%06d', doc_id)) AS n FROM documents WHERE text IS NOT NULL)
SELECT book, 'Anna' AS name, '角色名：Anna，别称：A' || chr(10) || '其他主要角色：无' || chr(10) || string_agg(chr(10) || 'Scene ' || n || ':' || chr(10) || '环境：' || chr(10) || '-' || text || chr(10) || chr(10) || '行为：' || chr(10) || '-' || stem || chr(10) || chr(10) || '典型台词：Hm', chr(10) ORDER BY n) AS text FROM f GROUP BY book"""


@query(_SCENES)
def character_scenes(spark: SparkSession, d: str) -> DataFrame:
    """A book a source, a scene a document, its whole text as the setting."""
    seg = table(spark, d, "documents").where("text is not null").select(F.col("source").alias("book"), F.format_string("%06d", "doc_id").alias("stem"), "text")
    facts = seg.select("book", "stem", F.array("text").alias("environment_facts"), F.array(F.struct(F.lit("Anna").alias("name"), F.array("stem").alias("facts"), F.lit("Hm").alias("representative_quote"))).alias("character_facts"))
    main = seg.select("book").distinct().select("book", F.lit("Anna").alias("name"), F.array(F.lit("A")).alias("aliases"), F.array().cast("array<string>").alias("others"))
    return ca.scene_blocks(facts, main)


# --- state --------------------------------------------------------------------------------------------------------

_E = "e AS (SELECT event_id, user_id, event_type, value, CASE WHEN event_id % 3 = 0 THEN event_type END AS mood, CASE WHEN event_id % 4 = 1 THEN props END AS place FROM events)"


def _events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.withColumn("mood", F.when(F.col("event_id") % 3 == 0, F.col("event_type"))).withColumn("place", F.when(F.col("event_id") % 4 == 1, F.col("props")))


@query(f"WITH {_E} SELECT user_id, arg_max(mood, event_id) FILTER (mood IS NOT NULL) AS mood, arg_max(place, event_id) FILTER (place IS NOT NULL) AS place FROM e GROUP BY user_id")
def status_fold(spark: SparkSession, d: str) -> DataFrame:
    return st.status_fold(_events(spark, d), ["user_id"], "event_id", ["mood", "place"])


@query(f"WITH {_E} SELECT event_id, last_value(mood IGNORE NULLS) OVER w AS mood, last_value(place IGNORE NULLS) OVER w AS place FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def status_history(spark: SparkSession, d: str) -> DataFrame:
    return st.status_history(_events(spark, d), ["user_id"], "event_id", ["mood", "place"]).select("event_id", "mood", "place")


@query(f"WITH {_E} SELECT user_id % 10 AS story, 'u' || user_id AS \"character\", event_type AS target, arg_max(mood, event_id) FILTER (mood IS NOT NULL) AS opinion, coalesce(string_agg(place, '|' ORDER BY event_id) FILTER (place IS NOT NULL), '') AS events FROM e GROUP BY ALL")
def relationship_fold(spark: SparkSession, d: str) -> DataFrame:
    return st.relationship_fold(_relations(spark, d), ["story"], "event_id").withColumn("events", F.array_join("events", "|"))


def _relations(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).select("event_id", (F.col("user_id") % 10).alias("story"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("character"), F.col("event_type").alias("target"), F.col("mood").alias("opinion"), F.col("place").alias("new_event"))


@query("""WITH e AS (SELECT event_id, user_id, 'i' || event_id % 5 AS item, CASE event_id % 7 WHEN 0 THEN 'remove' WHEN 1 THEN 'add' WHEN 2 THEN 'add' ELSE 'modify' END AS act, CASE WHEN event_id % 2 = 0 THEN 's' || event_id ELSE '' END AS ns FROM events),
a AS (SELECT user_id, item, list({'act': act, 'ns': ns} ORDER BY event_id) AS ops FROM e GROUP BY user_id, item),
f AS (SELECT user_id, item, list_reduce(ops, lambda s, x: CASE WHEN x.act = 'remove' THEN {'held': false, 'state': ''} WHEN NOT s.held THEN {'held': true, 'state': x.ns} WHEN x.act = 'modify' AND x.ns <> '' THEN {'held': true, 'state': x.ns} ELSE s END, {'held': false, 'state': ''}) AS s FROM a)
SELECT user_id AS story, 'c' AS "character", item AS item_name, s.state AS state FROM f WHERE s.held""")
def item_fold(spark: SparkSession, d: str) -> DataFrame:
    return st.item_fold(_item_updates(spark, d), ["story"], "event_id")


def _item_updates(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("event_id") % 7
    return table(spark, d, "events").select("event_id", F.col("user_id").alias("story"), F.lit("c").alias("character"), F.concat(F.lit("i"), (F.col("event_id") % 5).cast("string")).alias("item_name"), F.when(m == 0, "remove").when(m <= 2, "add").otherwise("modify").alias("action"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("s"), F.col("event_id").cast("string"))).otherwise("").alias("new_state"))


_B = "b AS (SELECT user_id, event_id, CASE WHEN event_id % 6 = 0 THEN 'scene_change' WHEN event_id % 6 < 4 THEN 'status_update' ELSE 'dialogue' END AS kind, event_id % 4 AS lc FROM events)"


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("event_id") % 6
    kind = F.when(m == 0, "scene_change").when(m < 4, "status_update").otherwise("dialogue")
    return table(spark, d, "events").select("user_id", "event_id", kind.alias("dataType"), (F.col("event_id") % 4).alias("line_count"))


@query(f"WITH {_B} SELECT event_id, CAST(coalesce(sum(lc) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_line FROM b")
def line_offsets(spark: SparkSession, d: str) -> DataFrame:
    return st.line_offsets(_blocks(spark, d), "user_id", "event_id").select("event_id", "first_line")


@query(f"WITH {_B} SELECT event_id, CAST(sum(CASE WHEN kind = 'scene_change' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS scene FROM b")
def scene_seq(spark: SparkSession, d: str) -> DataFrame:
    return st.scene_numbers(_blocks(spark, d), "user_id", "event_id").select("event_id", "scene")


@query(f"""WITH {_B}, n AS (SELECT *, sum(CASE WHEN kind = 'scene_change' THEN 1 ELSE 0 END) OVER w AS scene, coalesce(sum(lc) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fl FROM b WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
a AS (SELECT user_id, scene, min(fl) AS s, max(fl + lc) AS e, count(*) AS n_blocks, max(kind = 'dialogue') AS real FROM n GROUP BY user_id, scene),
k AS (SELECT *, max(scene) OVER (PARTITION BY user_id) AS last FROM a)
SELECT user_id, CAST(scene AS BIGINT) AS scene, CAST(s AS BIGINT) AS start_line, CAST(greatest(e, s + 1) AS BIGINT) AS end_line, n_blocks FROM k WHERE real OR scene = last""")
def scene_flush(spark: SparkSession, d: str) -> DataFrame:
    return st.scene_flush(_blocks(spark, d), "user_id", "event_id")


@query("""WITH p AS (SELECT conv_id, turn, sum(length(text) + 1) OVER w - 1 AS n, string_agg(text, chr(10)) OVER w AS pre FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, first_value(CASE WHEN n > 700 THEN substr(pre, 1, 500) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS frozen FROM p)
SELECT conv_id, turn, coalesce(frozen, pre, '') AS context FROM f""")
def context_accumulate(spark: SparkSession, d: str) -> DataFrame:
    return st.context_accumulate(table(spark, d, "conversations"), "conv_id", "turn", "text")


@query()
def carried_summaries(spark: SparkSession, d: str) -> DataFrame:
    return st.carry_forward(table(spark, d, "conversations"), "conv_id", "turn", "text", lambda before, text: (text[:20] + "/" + before)[:60])


@query("""WITH g AS (SELECT event_id, user_id, ts, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 7200000000 AS far FROM events)
SELECT event_id, CAST(sum(CASE WHEN far THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session FROM g""")
def session_gap(spark: SparkSession, d: str) -> DataFrame:
    return st.session_gaps(table(spark, d, "events"), "user_id", "ts", tie="event_id").select("event_id", "session")


@query(SQL_LINES + """, s AS (SELECT doc_id, pos // 4 AS batch, pos % 4 AS seg, line, sum(CASE WHEN pos % 4 > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) + 1 AS scene, pos FROM lines)
SELECT doc_id, CAST(scene AS BIGINT) AS scene, string_agg(line, chr(10) ORDER BY pos) AS content FROM s GROUP BY doc_id, scene""")
def scene_accumulation(spark: SparkSession, d: str) -> DataFrame:
    rows = doc_lines(spark, d).select("doc_id", F.floor(F.col("pos") / 4).alias("batch"), (F.col("pos") % 4).alias("segment"), F.col("line").alias("text"))
    return st.segment_scenes(rows, "doc_id", ["batch", "segment"])


@query()
def story_structure(spark: SparkSession, d: str) -> DataFrame:
    return steps.structure_story(doc_lines(spark, d), "doc_id", "pos")


@query()
def story_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """All seven steps with the rule model over conversations as books."""
    books = turns(spark, d).groupBy(F.col("conv_id").alias("book")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "content"))), lambda x: x["content"]), "\n").alias("text"))
    out = steps.run_story_pipeline(spark, books, least=200)
    return out.select("book", "stem", "variant", F.size("messages").alias("n"))


def _in_parts(spark: SparkSession, rows: DataFrame, fold, n: int = 3) -> tuple[SparkSession, str]:
    """A stream over files that come in ``n`` parts, drained and restarted after each; the session that reads its state, and its checkpoint."""
    source, mark, own = new_path(spark, "updates"), new_path(spark, "state"), folds.session(spark)
    for part in range(n):
        rows.where(F.pmod(F.xxhash64("event_id"), F.lit(n)) == part).write.mode("append").parquet(source)
        folds.drain(fold(own.readStream.schema(rows.schema).parquet(source)), mark).awaitTermination()
    return own, mark


@query(f"WITH {_E} SELECT user_id % 10 AS story, 'u' || user_id AS \"character\", event_type AS target, arg_max(mood, event_id) FILTER (mood IS NOT NULL) AS opinion, coalesce(string_agg(place, '|' ORDER BY event_id) FILTER (place IS NOT NULL), '') AS events FROM e GROUP BY ALL")
def relationship_stream(spark: SparkSession, d: str) -> DataFrame:
    """Relationships kept by a stream that is restarted twice, taken back from its state store."""
    own, mark = _in_parts(spark, _relations(spark, d), lambda b: folds.relationship_stream(b, ["story"], "event_id"))
    return folds.relationships(folds.relationships_of(own, mark, ["story"])).withColumn("events", F.array_join("events", "|"))


@query("""WITH e AS (SELECT event_id, user_id, 'i' || event_id % 5 AS item, CASE event_id % 7 WHEN 0 THEN 'remove' WHEN 1 THEN 'add' WHEN 2 THEN 'add' ELSE 'modify' END AS act, CASE WHEN event_id % 2 = 0 THEN 's' || event_id ELSE '' END AS ns FROM events),
a AS (SELECT user_id, item, list({'act': act, 'ns': ns} ORDER BY event_id) AS ops FROM e GROUP BY user_id, item),
f AS (SELECT user_id, item, list_reduce(ops, lambda s, x: CASE WHEN x.act = 'remove' THEN {'held': false, 'state': ''} WHEN NOT s.held THEN {'held': true, 'state': x.ns} WHEN x.act = 'modify' AND x.ns <> '' THEN {'held': true, 'state': x.ns} ELSE s END, {'held': false, 'state': ''}) AS s FROM a)
SELECT user_id AS story, 'c' AS "character", item AS item_name, s.state AS state FROM f WHERE s.held""")
def item_stream(spark: SparkSession, d: str) -> DataFrame:
    """Items kept by a stream that is restarted twice, taken back from its state store."""
    own, mark = _in_parts(spark, _item_updates(spark, d), lambda b: folds.item_stream(b, ["story"], "event_id"))
    return folds.items(folds.items_of(own, mark, ["story"]), ["story"])
