"""Queries over text: splitting, packing, scenes, names of files, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions import fuzzy
from storyloom.functions.arrays import explode_once
from storyloom.functions import text as tx
from storyloom.operators import chunking as ch
from storyloom.operators import ordering as od
from storyloom.plans import steps
from storyloom.plans.lineage import small_batches
from storyloom.queries.common import SQL_LINES, doc_lines, table
from storyloom.sources import writers

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_PACK = """WITH a AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
f AS (SELECT doc_id, ls, list_reduce(ls, lambda s, x: {body}, {{'size': 0::BIGINT, 'n': 0::BIGINT, 'chunk': 0::INTEGER, 'ids': []::INTEGER[]}}) AS s FROM a),
e AS (SELECT doc_id, s.ids[i] AS chunk, ls[i] AS line, i FROM (SELECT doc_id, ls, s, unnest(range(1, len(ls) + 1)) AS i FROM f))
SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS content, count(*) AS n_lines FROM e GROUP BY doc_id, chunk"""


def _fold(new: str, reset: str) -> str:
    return f"{{'size': CASE WHEN {new} THEN {reset} ELSE s.size + length(x) + 1 END, 'n': CASE WHEN {new} THEN 1 ELSE s.n + 1 END, 'chunk': CASE WHEN {new} THEN s.chunk + 1 ELSE s.chunk END, 'ids': list_append(s.ids, CASE WHEN {new} THEN s.chunk + 1 ELSE s.chunk END)}}"


@query(_PACK.format(body=_fold("s.size + length(x) + 1 > 500 AND s.size > 0", "length(x) + 1")))
def pack_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    return ch.pack_lines(rows, "doc_id", ch.line_chunks(F.split("text", "\n"), 500))


@query("""WITH a AS (SELECT doc_id, length(text) AS total, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
f AS (SELECT doc_id, ls, list_reduce(ls, lambda s, x: """ + _fold("s.size + length(x) > 500 AND s.n > 0", "length(x)") + """, {'size': 0::BIGINT, 'n': 0::BIGINT, 'chunk': 0::INTEGER, 'ids': []::INTEGER[]}) AS s, total FROM a),
e AS (SELECT doc_id, CASE WHEN total > 500 THEN s.ids[i] ELSE 0 END AS chunk, ls[i] AS line, i FROM (SELECT doc_id, ls, s, total, unnest(range(1, len(ls) + 1)) AS i FROM f))
SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS content, count(*) AS n_lines FROM e GROUP BY doc_id, chunk""")
def pack_lines_variant(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    return ch.pack_lines(rows, "doc_id", ch.line_chunks_loose("text", 500))


@query(r"""WITH a AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, list_filter(list_transform(range(1, len(p) + 1), lambda i: CASE WHEN i < len(p) THEN p[i] || chr(10) ELSE p[i] END), lambda x: x <> '') AS ls FROM a),
f AS (SELECT doc_id, list_reduce(ls, lambda s, x: {
 'buf': CASE WHEN length(s.buf) + length(x) > 600 AND length(s.buf) >= 600 THEN x WHEN length(s.buf) + length(x) >= 600 THEN '' ELSE s.buf || x END,
 'out': CASE WHEN length(s.buf) + length(x) > 600 AND length(s.buf) >= 600 THEN list_append(s.out, s.buf) WHEN length(s.buf) + length(x) >= 600 THEN list_append(s.out, s.buf || x) ELSE s.out END},
 {'buf': '', 'out': []::VARCHAR[]}) AS s FROM l),
o AS (SELECT doc_id, list_filter(list_transform(list_append(s.out, s.buf), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS o FROM f)
SELECT doc_id, CAST(i - 1 AS BIGINT) AS n, o[i] AS segment FROM (SELECT doc_id, o, unnest(range(1, len(o) + 1)) AS i FROM o)""")
def split_segments(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("text is not null")
    return explode_once(rows, ch.split_segments("text", 600, 600), "doc_id", pos="n", value="segment").withColumn("n", F.col("n").cast("long"))


@query()
def split_segments_random(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("text is not null")
    return explode_once(rows, ch.split_segments("text", 2000, 4000, "doc_id", 7), "doc_id", pos="n", value="segment")


_STARTS = r"""WITH a AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
raw AS (SELECT doc_id, ls, list_filter(list_transform(range(1, len(ls) + 1), lambda i: CASE WHEN length(ls[i]) % 4 = 0 THEN i END), lambda x: x IS NOT NULL) AS c FROM a),
b AS (SELECT doc_id, ls, list_sort(list_distinct(list_concat(c, [1, len(ls) + 1]))) AS b FROM raw),
t AS (SELECT doc_id, ls, b, list_reduce(b, lambda s, x: CASE WHEN len(s) = 0 OR x - s[-1] >= 3 THEN list_append(s, x) ELSE s END, []::BIGINT[]) AS t FROM b),
k AS (SELECT doc_id, ls, CASE WHEN len(b) > 1 THEN list_append(list_filter(t, lambda x: x < b[-1] AND (b[-1] - x >= 3 OR x = b[1])), b[-1]) ELSE t END AS k FROM t)
"""


def _bounded(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", "text", F.split("text", "\n").alias("ls"))
    raw = F.transform("ls", lambda x, i: F.when(F.length(x) % 4 == 0, (i + 1).cast("string")).otherwise("x"))
    ends = F.array(F.lit(1), (F.size("ls") + 1).cast("int"))
    b = F.array_sort(F.array_distinct(F.concat(ch.valid_boundaries(raw), ends)))
    return rows.withColumn("all", b).withColumn("bounds", ch.thin_boundaries("all", 3))


@query(_STARTS + "SELECT doc_id, CAST(i - 1 AS BIGINT) AS n, CAST(k[i] AS INTEGER) AS line FROM (SELECT doc_id, k, unnest(range(1, len(k) + 1)) AS i FROM k)")
def scene_boundaries(spark: SparkSession, d: str) -> DataFrame:
    return explode_once(_bounded(spark, d), F.col("bounds"), "doc_id", pos="n", value="line").withColumn("n", F.col("n").cast("long"))


@query(_STARTS + r""", e AS (SELECT doc_id, ls, i - 1 AS n, k[i] AS s, k[i + 1] - 1 AS e FROM (SELECT doc_id, ls, k, unnest(range(1, len(k))) AS i FROM k)),
c AS (SELECT doc_id, n, s, e, regexp_replace(array_to_string(ls[s:e], chr(10)), '^\s+|\s+$', '', 'g') AS content FROM e WHERE s <= e)
SELECT doc_id, CAST(doc_id AS VARCHAR) || '_' || lpad(CAST(n AS VARCHAR), 3, '0') AS scene_id, CAST(s AS INTEGER) AS start_line, CAST(e AS INTEGER) AS end_line, content, CAST(length(content) AS INTEGER) AS char_count FROM c WHERE content <> ''""")
def scenes(spark: SparkSession, d: str) -> DataFrame:
    return ch.scenes(_bounded(spark, d), "doc_id")


@query()
def scenes_merged(spark: SparkSession, d: str) -> DataFrame:
    rows = _bounded(spark, d)
    kept = rows.withColumn("kept", ch.long_scenes("ls", "bounds", 500))
    return ch.scenes(kept.withColumn("bounds", ch.merge_last("ls", "kept", "bounds", 500)), "doc_id")


@query()
def scene_segmentation(spark: SparkSession, d: str) -> DataFrame:
    """The whole step with the rule model."""
    return steps.run_step("1_1", table(spark, d, "documents"), least=300)


_QUOTED = "replace(replace(replace(text, ', ', '。'), '. ', '「'), ' the ', '」')"


_SPLIT = rf"""WITH q AS (SELECT doc_id, {_QUOTED} AS t FROM documents),
p AS (SELECT doc_id, regexp_split_to_array(t, '[“「][^\n]*?[”」]') AS told, regexp_extract_all(t, '[“「][^\n]*?[”」]') AS said FROM q WHERE t <> ''),
l AS (SELECT doc_id, i, list_filter(list_transform(string_split(regexp_replace(told[i], '(\.{{3,}}|。{{3,}})', '\1' || chr(10), 'g'), chr(10)),
   lambda x: regexp_replace(regexp_replace(x, '^\s+|\s+$', '', 'g'), '。{{2,}}', '。', 'g')), lambda x: x <> '') AS x FROM (SELECT doc_id, told, unnest(range(1, len(told) + 1)) AS i FROM p)),
n AS (SELECT doc_id, i, 0 AS o, unnest(x) AS s, generate_subscripts(x, 1) AS k FROM l),
d AS (SELECT doc_id, i, 1 AS o, said[i] AS s, 1 AS k FROM (SELECT doc_id, said, unnest(range(1, len(said) + 1)) AS i FROM p)),
u AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM (SELECT * FROM n UNION ALL SELECT * FROM d)),
f AS (SELECT doc_id, i, o, k, array_to_string(CASE WHEN n >= 3 OR o = 1 THEN [s] ELSE list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(s,
   '([。！!])', '\1' || chr(10), 'g'), '([。！!])\n(["”」])', '\1\2', 'g'), '([。！!])\n$', '\1'), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') END, chr(10)) AS s FROM u),
r AS (SELECT doc_id, string_agg(s, chr(10) ORDER BY i, o, k) AS text FROM f GROUP BY doc_id)
SELECT q.doc_id, coalesce(r.text, '') AS text FROM q LEFT JOIN r USING (doc_id)"""


@query(_SPLIT)
def split_dialogue(spark: SparkSession, d: str) -> DataFrame:
    """All documents, rewritten with quotes."""
    rows = table(spark, d, "documents").select("doc_id", F.expr(_QUOTED).alias("t"))
    return rows.select("doc_id", tx.split_dialogue("t").alias("text"))


@query(_SPLIT.replace("FROM documents", "FROM (SELECT doc_id, '他说。' || text || '！\"完了。\"。。。' AS text FROM documents)"))
def split_dialogue_all(spark: SparkSession, d: str) -> DataFrame:
    """All documents with a sentence before and quotes and an ellipsis behind."""
    text = F.concat(F.lit("他说。"), "text", F.lit("！\"完了。\"。。。"))
    rows = table(spark, d, "documents").select("doc_id", text.alias("text")).select("doc_id", F.expr(_QUOTED).alias("t"))
    return rows.select("doc_id", tx.split_dialogue("t").alias("text"))


@query()
def split_by_quotes(spark: SparkSession, d: str) -> DataFrame:
    small_batches(spark)
    rows = table(spark, d, "documents").select("doc_id", F.expr(_QUOTED).alias("t"))
    return rows.select("doc_id", F.posexplode(fuzzy.split_by_quotes("t")).alias("n", "piece"))


@query("SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 70 AS BIGINT) AS shard FROM documents")
def row_shards(spark: SparkSession, d: str) -> DataFrame:
    return ch.row_shards(table(spark, d, "documents").select("doc_id"), 70, "doc_id")


@query("""WITH a AS (SELECT source, list({'doc_id': doc_id, 'n': strlen(coalesce(text, '')) + 1} ORDER BY doc_id) AS x FROM documents GROUP BY source),
f AS (SELECT source, list_reduce(x, lambda s, r: {
 'cur': CASE WHEN s.cur + r.n > 20000 AND s.cur > 0 THEN r.n ELSE s.cur + r.n END, 'shard': CASE WHEN s.cur + r.n > 20000 AND s.cur > 0 THEN s.shard + 1 ELSE s.shard END,
 'ids': list_append(s.ids, {'doc_id': r.doc_id, 'shard': CASE WHEN s.cur + r.n > 20000 AND s.cur > 0 THEN s.shard + 1 ELSE s.shard END})},
 {'cur': 0::BIGINT, 'shard': 1::BIGINT, 'ids': []::STRUCT(doc_id BIGINT, shard BIGINT)[]}) AS s FROM a)
SELECT source, e.doc_id AS doc_id, e.shard AS shard FROM (SELECT source, unnest(s.ids) AS e FROM f)""")
def byte_shards(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("source", "doc_id", "text")
    return ch.byte_shards(rows, F.octet_length(F.coalesce("text", F.lit(""))) + 1, "source", "doc_id", 20000)


@query("""SELECT doc_id, source, CAST(CASE WHEN contains(source, '1') THEN 0 WHEN contains(source, '2') THEN 1 ELSE 2 END AS INTEGER) AS keyword FROM documents WHERE contains(source, '1') OR contains(source, '2') OR contains(source, '9')""")
def keyword_file_order(spark: SparkSession, d: str) -> DataFrame:
    return od.keyword_order(table(spark, d, "documents").select("doc_id", "source"), ["1", "2", "9"], "source")


@query(r"""SELECT page_id, url, array_to_string(list_transform(regexp_extract_all(lower(url), '[0-9]+|[^0-9]+'), lambda x: CASE WHEN regexp_matches(x, '^[0-9]+$') THEN '0' || lpad(CAST(length(CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END) AS VARCHAR), 9, '0') || CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END ELSE x END), '') AS k FROM pages""")
def natural_sort(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", "url", tx.natural_key("url").alias("k")).orderBy("k", "page_id")


@query("SELECT doc_id, source FROM documents ORDER BY md5('5:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 40")
def sample_n(spark: SparkSession, d: str) -> DataFrame:
    return od.sample(table(spark, d, "documents").select("doc_id", "source"), 40, "doc_id", 5)


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS place FROM documents")
def shuffle_hash(spark: SparkSession, d: str) -> DataFrame:
    keyed = table(spark, d, "documents").select("doc_id", od.hash_order(42, "doc_id").alias("h"))
    return od.global_index(keyed, ["h", "doc_id"], "place").select("doc_id", "place")


@query("SELECT doc_id, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 8 AS BIGINT) AS batch FROM documents")
def fixed_batches(spark: SparkSession, d: str) -> DataFrame:
    return od.batches(table(spark, d, "documents").select("doc_id", "source"), 8, "doc_id", ["source"]).select("doc_id", "batch")


@query(SQL_LINES + "SELECT doc_id, string_agg(CAST(pos + 1 AS VARCHAR) || ': ' || line, chr(10) ORDER BY pos) AS text FROM lines GROUP BY doc_id")
def number_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("trim(coalesce(text, '')) <> ''").select("doc_id", tx.numbered_lines(tx.clean_lines("text")).alias("text"))


@query(SQL_LINES + "SELECT doc_id, pos, line FROM lines")
def clean_lines(spark: SparkSession, d: str) -> DataFrame:
    return doc_lines(spark, d)


@query(r"""SELECT page_id, regexp_replace(url, '[\\/:*?"<>|]', '_', 'g') AS file, trim(regexp_replace(url, '[^\p{L}\p{N} _-]', '', 'g')) AS title, coalesce(nullif(regexp_extract(url, 'example\.com/([^/?#]+/[^/?#]+)', 1), ''), url) AS repo,
replace(url, '/', '_') AS flat, CAST(length(url) AS INTEGER) AS n FROM pages""")
def file_names(spark: SparkSession, d: str) -> DataFrame:
    hub = tx.repo_id(F.replace("url", F.lit("example.com/"), F.lit("huggingface.co/datasets/")))
    return table(spark, d, "pages").select("page_id", tx.safe_file_name("url").alias("file"), tx.safe_title("url").alias("title"), F.replace(hub, F.lit("huggingface.co/datasets/"), F.lit("example.com/")).alias("repo"), tx.repo_file_name("url").alias("flat"), F.length("url").alias("n"))


@query("""SELECT doc_id, CASE WHEN length(t) >= 2 AND t[1] = '"' AND t[-1] = '"' THEN t[2:-2] WHEN length(t) >= 2 AND t[1] = '「' AND t[-1] = '」' THEN t[2:-2] ELSE t END AS text FROM
(SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '"' || source || '"' WHEN 1 THEN '「' || source || '」' WHEN 2 THEN '「' || source ELSE source END AS t FROM documents)""")
def unquote(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("doc_id") % 4
    t = F.when(m == 0, F.concat(F.lit('"'), "source", F.lit('"'))).when(m == 1, F.concat(F.lit("「"), "source", F.lit("」"))).when(m == 2, F.concat(F.lit("「"), "source")).otherwise(F.col("source"))
    return table(spark, d, "documents").select("doc_id", tx.unquote(t).alias("text"))


@query("SELECT doc_id, substr(text, 1, 100) AS preview, CAST(length(substr(text, 1, 300)) AS INTEGER) AS cut FROM documents")
def previews(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", tx.preview("text").alias("preview"), F.length(F.substring("text", 1, 300)).alias("cut"))


@query("SELECT doc_id, strlen(text) + strlen(source) + CAST(0 AS BIGINT) AS n FROM documents")
def row_sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", (F.octet_length("text") + F.octet_length("source")).cast("long").alias("n"))


@query("SELECT doc_id, '##前情提要' || chr(10) || source || chr(10) || '##正文' || chr(10) || text || chr(10) || '##总结' || chr(10) || lang AS text FROM documents")
def summarised_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", writers.summarised_text(F.col("source"), F.col("text"), F.col("lang")).alias("text"))


@query("SELECT doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS n FROM documents WHERE text <> ''")
def scene_counter(spark: SparkSession, d: str) -> DataFrame:
    return writers.scene_texts(table(spark, d, "documents"), ["doc_id"], "text", "source").select("doc_id", "n")


@query("""SELECT doc_id, CASE WHEN trim(text) = '' THEN '' WHEN len(text) - len(replace(text, '"', '')) > 4 THEN 'dialogue' ELSE '' END AS first FROM documents WHERE len(text) - len(replace(text, '"', '')) > 4""")
def classify_dialogue(spark: SparkSession, d: str) -> DataFrame:
    got = steps.classify(table(spark, d, "documents").select("doc_id", "text"))
    return got.where(F.get("categories", F.lit(0)) == "dialogue").select("doc_id", F.get("categories", F.lit(0)).alias("first"))


@query()
def roleplay_conversion(spark: SparkSession, d: str) -> DataFrame:
    from storyloom.queries.common import exploded

    return exploded(steps.roleplay_chats(table(spark, d, "documents").select("doc_id", "text")), "doc_id")


@query()
def style_conversion(spark: SparkSession, d: str) -> DataFrame:
    from storyloom.queries.common import exploded

    return exploded(steps.style_chats(table(spark, d, "documents").select("doc_id", "text")), "doc_id")


@query()
def fetch_and_shard(spark: SparkSession, d: str) -> DataFrame:
    return steps.fetch_dataset(table(spark, d, "documents").select("doc_id", "text"), "text", "doc_id", 100_000)
