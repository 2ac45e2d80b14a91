"""Queries over chat messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.operators import masks
from storyloom.operators import mapping as mp
from storyloom.operators import messages as ms
from storyloom.queries.common import DERIVED_ROLE, SQL_LINES, chats, derived, doc_lines, exploded, table, turns

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_ISLANDS = """
m AS (SELECT *, CASE WHEN role IS NOT DISTINCT FROM lag(role) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS n FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
r AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY pos) AS run FROM m)
"""
_T = "t AS (SELECT conv_id, turn AS pos, role, text AS content FROM conversations)"
_D = f"t AS (SELECT conv_id, pos, {DERIVED_ROLE} AS role, content FROM (SELECT conv_id, turn AS pos, text AS content FROM conversations))"


@query(f"""WITH {_T}, {_ISLANDS}, g AS (SELECT conv_id, run, any_value(role) AS role, string_agg(content, chr(10) ORDER BY pos) AS content FROM r GROUP BY conv_id, run),
f AS (SELECT conv_id, run, CASE WHEN run = min(run) OVER (PARTITION BY conv_id) AND role = 'assistant' THEN 'user' ELSE role END AS role, content FROM g)
SELECT conv_id, string_agg(role || ':' || content, chr(10) ORDER BY run) AS text FROM f GROUP BY conv_id""")
def flatten_conversation(spark: SparkSession, d: str) -> DataFrame:
    """Merge neighbours, flip a leading assistant, flatten: chats to training text."""
    merged = ms.to_arrays(ms.merge_adjacent_roles(turns(spark, d), "conv_id"), "conv_id")
    return merged.select("conv_id", ms.flatten_plain(ms.flip_first_role("messages")).alias("text"))


@query(f"WITH {_D}, {_ISLANDS} SELECT conv_id, CAST(run AS BIGINT) AS pos, any_value(role) AS role, string_agg(content, chr(10) ORDER BY pos) AS content, list_aggregate(list_sort(list_distinct(list('s' || pos % 3))), 'string_agg', ',') AS speakers FROM r GROUP BY conv_id, run")
def merge_adjacent_roles(spark: SparkSession, d: str) -> DataFrame:
    rows = derived(spark, d).withColumn("speaker", F.concat(F.lit("s"), (F.col("pos") % 3).cast("string")))
    return ms.merge_adjacent_roles(rows, "conv_id", speaker="speaker").withColumn("speakers", F.array_join("speakers", ","))


@query(SQL_LINES + """, t AS (SELECT *, CASE WHEN pos % 6 < 2 THEN 'A' WHEN pos % 6 < 4 THEN '' ELSE 'B' END AS speaker FROM lines),
r AS (SELECT *, pos // 2 AS run FROM t)
SELECT doc_id, CAST(run + 1 AS BIGINT) AS pos, any_value(speaker) AS speaker, string_agg(line, chr(10) ORDER BY pos) AS content FROM r GROUP BY doc_id, run""")
def merge_speaker_runs(spark: SparkSession, d: str) -> DataFrame:
    who = F.when(F.col("pos") % 6 < 2, "A").when(F.col("pos") % 6 >= 4, "B")
    return ms.merge_speaker_runs(doc_lines(spark, d).withColumn("speaker", who).withColumnRenamed("line", "content"), "doc_id")


@query(SQL_LINES + """, t AS (SELECT doc_id AS conv_id, pos, line AS content, CASE WHEN pos % 4 = 1 AND length(line) % 2 = 0 THEN 'user' ELSE 'assistant' END AS role FROM lines),""" + _ISLANDS + """
SELECT conv_id AS doc_id, CAST(run AS BIGINT) AS pos, any_value(role) AS role, string_agg(content, chr(10) ORDER BY pos) AS content FROM r GROUP BY conv_id, run""")
def roleplay_blocks(spark: SparkSession, d: str) -> DataFrame:
    rows = doc_lines(spark, d).withColumn("is_dialogue", F.length("line") % 2 == 0).withColumn("speaker", F.when(F.col("pos") % 4 == 1, "P").when(F.col("pos") % 4 == 2, "Q"))
    return ms.roleplay_blocks(rows, "doc_id", "P")


@query(SQL_LINES + """SELECT doc_id, CAST(2 * (pos // 7) + CASE WHEN pos % 7 < 2 THEN 0 ELSE 1 END AS BIGINT) AS pos, CASE WHEN pos % 7 < 2 THEN 'user' ELSE 'assistant' END AS role, string_agg(line, chr(10) ORDER BY pos) AS content
FROM lines GROUP BY doc_id, pos // 7, pos % 7 < 2""")
def fallback_2_5(spark: SparkSession, d: str) -> DataFrame:
    return ms.fallback_blocks(doc_lines(spark, d), "doc_id")


@query(SQL_LINES + """, one AS (SELECT doc_id, pos, line, max(length(line) % 5 = 0) OVER (PARTITION BY doc_id) AS mixed FROM lines),
a AS (SELECT doc_id, pos, line, CASE WHEN length(line) % 5 = 0 THEN 'user' ELSE 'assistant' END AS role FROM one),
m AS (SELECT *, CASE WHEN role = lag(role) OVER (PARTITION BY doc_id ORDER BY pos) THEN 0 ELSE 1 END AS n FROM a),
r AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM m),
b AS (SELECT doc_id, run AS pos, any_value(role) AS role, string_agg(line, chr(10) ORDER BY pos) AS content FROM r GROUP BY doc_id, run),
many AS (SELECT doc_id FROM b GROUP BY doc_id HAVING count(*) > 1)
SELECT doc_id, CAST(pos AS BIGINT) AS pos, role, content FROM b WHERE doc_id IN (SELECT doc_id FROM many)
UNION ALL SELECT doc_id, CAST(2 * (pos // 7) + CASE WHEN pos % 7 < 2 THEN 0 ELSE 1 END AS BIGINT), CASE WHEN pos % 7 < 2 THEN 'user' ELSE 'assistant' END, string_agg(line, chr(10) ORDER BY pos)
FROM lines WHERE doc_id NOT IN (SELECT doc_id FROM many) GROUP BY doc_id, pos // 7, pos % 7 < 2""")
def fallback_trigger(spark: SparkSession, d: str) -> DataFrame:
    """Islands of lines, but 2/5 blocks where they give a single block."""
    rows = doc_lines(spark, d).withColumn("is_dialogue", F.length("line") % 5 == 0).withColumn("speaker", F.lit("P"))
    return ms.roleplay_or_fallback(rows, "doc_id", "P")


@query(f"""WITH {_D}, k AS (SELECT *, CASE WHEN role = 'system' AND lag(role) OVER w = 'system' THEN 0 ELSE 1 END AS n FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
r AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY pos) AS run FROM k)
SELECT conv_id, CAST(run - 1 AS BIGINT) AS pos, any_value(role) AS role, string_agg(content, chr(10) ORDER BY pos) AS content FROM r GROUP BY conv_id, run""")
def merge_consecutive_system(spark: SparkSession, d: str) -> DataFrame:
    rows = ms.to_arrays(derived(spark, d), "conv_id")
    return exploded(rows.select("conv_id", ms.merge_consecutive_system("messages").alias("messages")), "conv_id")


@query(f"WITH {_T} SELECT conv_id, pos, CASE WHEN pos = min(pos) OVER (PARTITION BY conv_id) AND role = 'assistant' THEN 'user' ELSE role END AS role, content FROM t WHERE pos >= 1")
def first_role_flip(spark: SparkSession, d: str) -> DataFrame:
    late = ms.to_arrays(turns(spark, d).where("pos >= 1"), "conv_id")
    out = exploded(late.select("conv_id", ms.flip_first_role("messages").alias("messages")), "conv_id")
    return out.withColumn("pos", F.col("pos") + 1)


@query("SELECT conv_id, turn AS pos, CASE WHEN 's' || turn % 3 = 's1' THEN 'user' ELSE 'assistant' END AS role FROM conversations")
def role_assignment(spark: SparkSession, d: str) -> DataFrame:
    rows = turns(spark, d).withColumn("speaker", F.concat(F.lit("s"), (F.col("pos") % 3).cast("string")))
    return ms.assign_roles(rows, "s1").select("conv_id", "pos", "role")


_PAIR = "SELECT item_id, CASE WHEN item_id % 3 = 0 THEN NULL ELSE substr(text, 1, 20) END AS a, text AS b FROM benchmark"


def _pairs(spark: SparkSession, d: str, a: str, b: str, c: str | None = None) -> DataFrame:
    t = table(spark, d, "benchmark")
    cols = [F.when(F.col("item_id") % 3 != 0, F.substring("text", 1, 20)).alias(a), F.col("text").alias(b)]
    return t.select("item_id", *cols, *([F.concat(F.lit("out "), F.substring("text", 1, 5)).alias(c)] if c else []))


@query(f"""WITH p AS ({_PAIR}) SELECT item_id, CAST(0 AS BIGINT) AS pos, 'user' AS role, trim(coalesce(a, '') || chr(10) || chr(10) || b, chr(10) || ' ') AS content FROM p
UNION ALL SELECT item_id, 1, 'assistant', 'out ' || substr(b, 1, 5) FROM p""")
def map_alpaca(spark: SparkSession, d: str) -> DataFrame:
    return exploded(mp.map_rows(_pairs(spark, d, "instruction", "input", "output"), "alpaca", keep=("item_id",)).select("item_id", "messages"), "item_id")


@query(f"WITH p AS ({_PAIR}) SELECT item_id, CAST(0 AS BIGINT) AS pos, 'user' AS role, coalesce(a, '') AS content FROM p UNION ALL SELECT item_id, 1, 'assistant', b FROM p")
def map_prompt_completion(spark: SparkSession, d: str) -> DataFrame:
    return exploded(mp.map_rows(_pairs(spark, d, "prompt", "completion"), "prompt_completion", keep=("item_id",)).select("item_id", "messages"), "item_id")


@query("SELECT conv_id, turn AS pos, CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role, text AS content FROM conversations")
def map_sharegpt(spark: SparkSession, d: str) -> DataFrame:
    long = turns(spark, d).select("conv_id", "pos", F.when(F.col("role") == "user", "human").otherwise(F.col("role")).alias("from"), F.col("content").alias("value"))
    rows = ms.to_arrays(long, "conv_id", ("from", "value")).withColumnRenamed("messages", "conversations")
    return exploded(mp.map_rows(rows, "sharegpt", keep=("conv_id",)).select("conv_id", "messages"), "conv_id")


@query(f"""WITH p AS ({_PAIR}) SELECT item_id, CAST(0 AS BIGINT) AS pos, 'user' AS role, b AS content FROM p
UNION ALL SELECT item_id, 1, 'assistant', CASE WHEN a IS NULL THEN '' ELSE '<thought>' || chr(10) || a || chr(10) || '</thought>' || chr(10) || chr(10) END || 'out ' || substr(b, 1, 5) FROM p""")
def map_reasoning(spark: SparkSession, d: str) -> DataFrame:
    rows = _pairs(spark, d, "thinking", "problem", "solution")
    own = mp.MAPPINGS | {"thought": ("reasoning", mp.MAPPINGS["reasoning"][1])}
    return exploded(mp.map_rows(rows, "thought", own, keep=("item_id",)).select("item_id", "messages"), "item_id")


@query("SELECT doc_id, text, NULL::VARCHAR AS code FROM documents")
def map_direct(spark: SparkSession, d: str) -> DataFrame:
    own = {"mine": ("direct", {"text": "text", "code": "missing"})}
    return mp.map_rows(table(spark, d, "documents"), "mine", own, keep=("doc_id",))


@query("SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 + 100 AS BIGINT) AS id, coalesce(text, '') AS text FROM documents")
def assign_ids(spark: SparkSession, d: str) -> DataFrame:
    return mp.with_ids(table(spark, d, "documents").select("doc_id", "text"), "doc_id", 100)


@query(r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE coalesce(text, '') <> ''), k AS (SELECT doc_id, CASE WHEN x[-1] = '' THEN x[:-2] ELSE x END AS x FROM l)
SELECT doc_id, array_to_string(x[1:10], chr(10)) AS user_text, coalesce(array_to_string(x[11:], chr(10)), '') AS assistant_text FROM k""")
def chatml_first10(spark: SparkSession, d: str) -> DataFrame:
    m = ms.first_ten_lines("text")
    return table(spark, d, "documents").where("coalesce(text, '') <> ''").select("doc_id", F.get(m, F.lit(0))["content"].alias("user_text"), F.get(m, F.lit(1))["content"].alias("assistant_text"))


_BATCH = f"""WITH {_T}, a AS (SELECT conv_id, list({{'role': role, 'content': content, 'pos': pos}} ORDER BY pos) AS m FROM t GROUP BY conv_id),
f AS (SELECT conv_id, m, list_reduce(m, lambda acc, x: {{
  'chars': CASE WHEN acc.chars + length(x.content) >= 400 AND x.role = 'assistant' THEN 0::BIGINT ELSE acc.chars + length(x.content) END,
  'batch': CASE WHEN acc.chars + length(x.content) >= 400 AND x.role = 'assistant' THEN acc.batch + 1 ELSE acc.batch END,
  'ids': list_append(acc.ids, acc.batch)}}, {{'chars': 0::BIGINT, 'batch': 0::BIGINT, 'ids': []::BIGINT[]}}) AS s FROM a),
b AS (SELECT conv_id, m[i].role AS role, m[i].content AS content, i AS pos, s.ids[i] AS batch FROM (SELECT conv_id, m, s, unnest(range(1, len(m) + 1)) AS i FROM f)),
q AS (SELECT *, CASE WHEN length(content) >= 2 AND content[1] = '"' AND content[-1] = '"' THEN content[2:-2] ELSE content END AS bare, row_number() OVER (PARTITION BY conv_id, batch, role ORDER BY pos) AS k FROM b)
SELECT conv_id, 2 * batch + 1 AS pos, 'assistant' AS role, string_agg(content, chr(10) ORDER BY pos) AS content FROM q GROUP BY conv_id, batch
UNION ALL SELECT conv_id, 2 * batch, 'user', string_agg(bare, chr(10) ORDER BY pos) FROM q WHERE role = 'user' AND k <= %d GROUP BY conv_id, batch"""


@query(_BATCH % 2)
def paraphrase_batches(spark: SparkSession, d: str) -> DataFrame:
    return ms.paraphrase(chats(spark, d), "conv_id", min_chars=400)


@query(_BATCH % 1_000_000)
def strict_paraphrase(spark: SparkSession, d: str) -> DataFrame:
    return ms.paraphrase(chats(spark, d), "conv_id", min_chars=400, users=None)


def _reasoned(spark: SparkSession, d: str) -> DataFrame:
    rows = turns(spark, d).withColumn("reasoning_content", F.when((F.col("role") == "assistant") & (F.col("pos") % 3 != 0), F.substring("content", 1, 10)))
    return ms.to_arrays(rows, "conv_id", ("role", "content", "reasoning_content"))


def _variants(spark: SparkSession, d: str) -> DataFrame:
    v = ms.reasoning_variants(_reasoned(spark, d), "conv_id")
    return v.select("conv_id", F.col("variant").cast("long").alias("variant"), F.posexplode("messages").alias("pos", "m")).select("conv_id", "variant", F.col("pos").cast("long").alias("pos"), "m.role", "m.content", "m.reasoning_content")


_REASON = "CASE WHEN role = 'assistant' AND turn % 3 <> 0 THEN substr(text, 1, 10) END"
_FIT = "fit AS (SELECT conv_id FROM conversations GROUP BY conv_id HAVING max(role = 'user'))"


@query(f"""WITH {_FIT} SELECT conv_id, 0::BIGINT AS variant, turn AS pos, role, CASE WHEN turn = 0 AND role = 'system' THEN '[THINKING:OFF]' || chr(10) ELSE '' END || text AS content,
CASE WHEN role = 'assistant' THEN '' END AS reasoning_content FROM conversations WHERE conv_id IN (SELECT conv_id FROM fit)""")
def reasoning_variants_off(spark: SparkSession, d: str) -> DataFrame:
    return _variants(spark, d).where("variant = 0")


@query(f"""WITH {_FIT}, a AS (SELECT conv_id, turn AS last, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS variant FROM conversations WHERE role = 'assistant' AND conv_id IN (SELECT conv_id FROM fit)),
j AS (SELECT a.conv_id, a.variant, a.last, c.turn AS pos, c.role, CASE WHEN c.turn = 0 AND c.role = 'system' THEN '[THINKING:ON]' || chr(10) ELSE '' END || c.text AS content,
 CASE WHEN c.role = 'assistant' AND c.turn = a.last THEN coalesce({_REASON.replace("role", "c.role").replace("turn", "c.turn").replace("text", "c.text")}, '') END AS reasoning_content,
 max(c.role = 'user' AND c.turn < a.last) OVER (PARTITION BY a.conv_id, a.variant) AS asked
 FROM a JOIN conversations c ON c.conv_id = a.conv_id AND c.turn <= a.last)
SELECT conv_id, variant, CASE WHEN NOT asked AND pos = last THEN pos + 1 ELSE pos END AS pos, role, content, reasoning_content FROM j
UNION ALL SELECT conv_id, variant, last, 'user', '', NULL FROM j WHERE NOT asked AND pos = last""")
def reasoning_variants_on(spark: SparkSession, d: str) -> DataFrame:
    return _variants(spark, d).where("variant > 0")


@query("SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) || '</s>' AS text FROM conversations GROUP BY conv_id")
def chatml_render(spark: SparkSession, d: str) -> DataFrame:
    return chats(spark, d).select("conv_id", ms.render_template("messages", "</s>").alias("text"))


@query(f"""SELECT conv_id, string_agg(role || CASE WHEN coalesce(why, '') <> '' THEN ':' || chr(10) || why || chr(10) ELSE ':' END || text, chr(10) ORDER BY turn) AS text FROM (SELECT *, {_REASON} AS why FROM conversations) GROUP BY conv_id""")
def flatten_reasoning(spark: SparkSession, d: str) -> DataFrame:
    rows = _reasoned(spark, d).withColumn("messages", F.transform("messages", lambda m: m.withField("reasoning", F.lit(None).cast("string"))))
    return rows.select("conv_id", ms.flatten("messages", either=True).alias("text"))


@query("SELECT conv_id, 0::BIGINT AS pos, 'system' AS role, 'Be brief.' AS content FROM (SELECT DISTINCT conv_id FROM conversations) UNION ALL SELECT conv_id, turn + 1, role, text FROM conversations")
def prepend_system(spark: SparkSession, d: str) -> DataFrame:
    return exploded(chats(spark, d).select("conv_id", ms.with_system("messages", "Be brief.").alias("messages")), "conv_id")


@query("""SELECT d.doc_id, '【任务描述】' || chr(10) || d.source || chr(10) || chr(10) || '【世界观设定】' || chr(10) || CASE WHEN d.lang = 'en' THEN '无' ELSE d.lang END
|| CASE WHEN l.quality = 1 THEN chr(10) || chr(10) || '【角色设定】' || chr(10) || '## Q' || chr(10) || 'good' || chr(10) ELSE '' END
|| CASE WHEN l.toxic = 1 THEN chr(10) || chr(10) || '【前情提要】' || chr(10) || 'toxic' ELSE '' END AS prompt FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def system_prompt_assembly(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "source", "lang").join(table(spark, d, "labels"), "doc_id")
    cast = F.when(F.col("quality") == 1, F.array(F.struct(F.lit("Q").alias("name"), F.lit("good").alias("profile")))).otherwise(F.array().cast("array<struct<name:string,profile:string>>"))
    return rows.select("doc_id", ms.system_prompt(F.col("source"), F.when(F.col("lang") != "en", F.col("lang")), cast, F.when(F.col("toxic") == 1, "toxic")).alias("prompt"))


@query()
def reply_masks(spark: SparkSession, d: str) -> DataFrame:
    """Each token of each conversation's rendered text, and whether a model is trained on it."""
    import public_tokenizers

    text = chats(spark, d).select("conv_id", ms.render_template("messages", "</s>").alias("text"))
    return masks.reply_masks(text, "conv_id", public_tokenizers.path("word_bpe_49k.json"))
