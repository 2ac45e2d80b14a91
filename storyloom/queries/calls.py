"""Queries of language-model calls: every task by the rule model, its reply read back as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.plans.modelcalls import CANNED_PROMPT, Retrying, RuleModel, call_rows, summarise_once, system_prompt_or_canned
from storyloom.plans.lineage import small_batches
from storyloom.queries.common import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _ask(spark: SparkSession, d: str, task: str, **inputs: Column) -> DataFrame:
    """(doc_id, v): the reply to each document's inputs as a variant."""
    rows = table(spark, d, "documents").select("doc_id", *[c.alias(k) for k, c in inputs.items()])
    return call_rows(rows, RuleModel(), task, list(inputs)).select("doc_id", F.parse_json("reply").alias("v"), *inputs)


def _get(path: str, kind: str = "string") -> Column:
    return F.variant_get("v", path, kind)



def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _lines() -> Column:
    return F.split(_text(), "\n")


@query("SELECT doc_id, left(coalesce(text, ''), 200) AS worldview, coalesce(text, '') = '' AS unknown FROM documents")
def call_annotate_novel(spark: SparkSession, d: str) -> DataFrame:
    return _ask(spark, d, "annotate_novel", text=_text()).select("doc_id", _get("$.worldview").alias("worldview"), _get("$.unknown", "boolean").alias("unknown"))


@query("SELECT doc_id, array_to_string(list_transform(string_split(coalesce(source, '') || ' ' || chr(10) || ' ' || coalesce(lang, ''), chr(10)), lambda x: trim(x)), chr(10)) AS segment FROM documents")
def call_scene_segments(spark: SparkSession, d: str) -> DataFrame:
    lines = F.array(F.concat(F.coalesce("source", F.lit("")), F.lit(" ")), F.concat(F.lit(" "), F.coalesce("lang", F.lit(""))))
    return _ask(spark, d, "scene_segments", lines=lines).select("doc_id", _get("$.segments[0]").alias("segment"))


@query("SELECT doc_id, 'Continue in this style: ' || left(coalesce(text, ''), 300) AS prompt FROM documents")
def call_style_prompt(spark: SparkSession, d: str) -> DataFrame:
    return _ask(spark, d, "style_prompt", context=_text()).select("doc_id", _get("$").alias("prompt"))


@query("SELECT doc_id, source AS protagonist, CASE WHEN source = lang THEN [source] ELSE [source, lang] END AS speakers FROM documents")
def call_speakers(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat("source", F.lit(": a\n"), "lang", F.lit("：b\n"), "source", F.lit(": c"))
    return _ask(spark, d, "speakers", text=text).select("doc_id", _get("$.protagonist").alias("protagonist"), _get("$.speakers", "array<string>").alias("speakers"))


@query("SELECT doc_id, source AS speaker, [true, false] AS is_dialogue FROM documents")
def call_line_labels(spark: SparkSession, d: str) -> DataFrame:
    lines = F.array(F.concat("source", F.lit(": a")), F.lit("nothing said"))
    got = _ask(spark, d, "line_labels", lines=lines)
    return got.select("doc_id", _get("$[0].speaker").alias("speaker"), F.array(_get("$[0].is_dialogue", "boolean"), _get("$[1].is_dialogue", "boolean")).alias("is_dialogue"))


@query("SELECT doc_id, 'You play everyone but ' || source || '. Others: x, ' || lang AS prompt FROM documents")
def call_roleplay_prompt(spark: SparkSession, d: str) -> DataFrame:
    return _ask(spark, d, "roleplay_prompt", protagonist=F.col("source"), speakers=F.array("source", F.lit("x"), "lang")).select("doc_id", _get("$").alias("prompt"))


@query("SELECT doc_id, [CAST(doc_id AS INTEGER) + 1, CAST(doc_id AS INTEGER) + 3] AS changes FROM documents")
def call_scene_changes(spark: SparkSession, d: str) -> DataFrame:
    lines = F.array(F.lit("# one"), F.lit("# two"), F.lit("x"), F.lit(" "), F.lit("y"))
    return _ask(spark, d, "scene_changes", first_line=F.col("doc_id"), lines=lines).select("doc_id", _get("$.scene_changes", "array<int>").alias("changes"))


@query("SELECT doc_id, source AS name, ['a', lang] AS alias FROM documents")
def call_formal_name(spark: SparkSession, d: str) -> DataFrame:
    """The longest name, the first where several are; the others are its aliases."""
    got = _ask(spark, d, "formal_name", names=F.array(F.lit("a"), F.concat(F.lit("name of "), "source"), "lang"))
    return got.select("doc_id", F.replace(_get("$.name"), F.lit("name of "), F.lit("")).alias("name"), _get("$.alias", "array<string>").alias("alias"))


@query("SELECT doc_id, [[source], [lang, 'x']] AS groups FROM documents")
def call_review_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.to_json(F.array(F.array("source"), F.array("lang", F.lit("x")))).alias("groups"))
    got = call_rows(rows, RuleModel(), "review_groups", ["groups"], parse=["groups"]).select("doc_id", F.parse_json("reply").alias("v"))
    return got.select("doc_id", _get("$.groups", "array<array<string>>").alias("groups"))


@query("SELECT doc_id, true AS consistent, '' AS name FROM documents")
def call_pov_conflict(spark: SparkSession, d: str) -> DataFrame:
    return _ask(spark, d, "pov_conflict", text=_text()).select("doc_id", _get("$.consistent", "boolean").alias("consistent"), _get("$.name").alias("name"))


@query("SELECT doc_id, source || ' in ' || lang AS setting, [source || ' appears', lang || ' appears'] AS facts FROM documents")
def call_scene_facts(spark: SparkSession, d: str) -> DataFrame:
    got = _ask(spark, d, "scene_facts", text=F.concat(F.lit(" "), "source", F.lit(" in "), "lang", F.lit("\nmore")), characters=F.array("source", "lang"))
    return got.select("doc_id", _get("$.environment_facts[0]").alias("setting"), F.array(_get("$.character_facts[0].facts[0]"), _get("$.character_facts[1].facts[0]")).alias("facts"))


@query("SELECT doc_id, left(coalesce(text, ''), 500) AS world, left(coalesce(text, ''), 500) AS profile FROM documents")
def call_world_and_profile(spark: SparkSession, d: str) -> DataFrame:
    world = _ask(spark, d, "world", text=_text()).select("doc_id", _get("$").alias("world"), "text")
    return call_rows(world, RuleModel(), "profile", ["text"]).select("doc_id", "world", F.variant_get(F.parse_json("reply"), "$", "string").alias("profile"))


@query("SELECT doc_id, left(coalesce(text, ''), 500) AS summary FROM documents")
def call_summarise(spark: SparkSession, d: str) -> DataFrame:
    """Short texts are their own summary; replies are cut to size."""

    def one(frames):
        for f in frames:
            yield f.assign(summary=[summarise_once(RuleModel(), t) for t in f["text"]])[["doc_id", "summary"]]

    small_batches(spark)
    return table(spark, d, "documents").select("doc_id", _text().alias("text")).mapInPandas(one, "doc_id long, summary string")


@query("SELECT doc_id, [1, 3] AS line_numbers, source AS speaker FROM documents")
def call_speaker_labels(spark: SparkSession, d: str) -> DataFrame:
    lines = F.array(F.concat(F.lit("says "), "source"), F.lit("-"), F.concat("source", F.lit("!")))
    got = _ask(spark, d, "speaker_labels", lines=lines, characters=F.array("source"))
    return got.select("doc_id", F.array(_get("$.speakers[0].line_number", "int"), _get("$.speakers[1].line_number", "int")).alias("line_numbers"), _get("$.speakers[1].speaker").alias("speaker"))


@query("SELECT doc_id, 'Mode ' || m || ': the user is ' || source || '.' AS task FROM documents, (VALUES ('paraphrase'), ('strict'), ('free')) t(m)")
def call_task_description(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.col("source").alias("user_role"), F.explode(F.array(F.lit("paraphrase"), F.lit("strict"), F.lit("free"))).alias("mode"))
    return call_rows(rows, RuleModel(), "task_description", ["user_role", "mode"]).select("doc_id", F.variant_get(F.parse_json("reply"), "$", "string").alias("task"))


@query("SELECT doc_id, 'Given: ' || right(coalesce(text, ''), 80) AS reasoning FROM documents")
def call_reasoning(spark: SparkSession, d: str) -> DataFrame:
    return _ask(spark, d, "reasoning", history=_text(), content=F.col("source")).select("doc_id", _get("$").alias("reasoning"))


_CANNED = CANNED_PROMPT.replace("'", "''")


@query(f"SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '{_CANNED}' || source WHEN doc_id % 4 = 1 THEN 'fine at 3' ELSE 'fine at 1' END AS prompt FROM documents")
def call_refused(spark: SparkSession, d: str) -> DataFrame:
    """A prompt that is refused always, twice or never: asked again, and the canned prompt and the first line in the end."""

    def one(frames):
        for f in frames:
            out = []
            for doc, source in zip(f["doc_id"], f["source"], strict=True):
                refusals, asked = {0: 99, 1: 2}.get(doc % 4, 0), []

                def model(task, inputs, refusals=refusals, asked=asked):
                    asked.append(task)
                    return "很抱歉，无法为您生成" if len(asked) <= refusals else f"fine at {len(asked)}"

                out.append(system_prompt_or_canned(model, {}, source))
            yield f.assign(prompt=out)[["doc_id", "prompt"]]

    return table(spark, d, "documents").select("doc_id", "source").mapInPandas(one, "doc_id long, prompt string")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN NULL ELSE doc_id % 3 + 1 END AS tries FROM documents")
def call_retries(spark: SparkSession, d: str) -> DataFrame:
    """Replies that come at the first or second try, or never within two: the try that brought one, or null."""

    def one(frames):
        for f in frames:
            out = []
            for doc in f["doc_id"]:
                asked = []

                def model(task, inputs, doc=doc, asked=asked):
                    asked.append(task)
                    if len(asked) <= doc % 3:
                        raise OSError("no answer")
                    return f'```json\n{{"tries": {len(asked)}}}\n```'

                got = Retrying(model, tries=2, delay=0)("any", {}, lambda v: isinstance(v, dict))
                out.append(got["tries"] if got else None)
            yield f.assign(tries=out)[["doc_id", "tries"]].astype({"tries": "Int64"})

    return table(spark, d, "documents").select("doc_id").mapInPandas(one, "doc_id long, tries long")
