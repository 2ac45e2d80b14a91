"""Whole texts travel to Python workers in batches of few rows."""

import pytest
from pyspark.sql import functions as F

from storyloom import registry
from storyloom.plans import steps
from storyloom.plans.lineage import BATCH_ROWS

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
QUERIES = ["row_processor", "style_conversion", "call_pov_conflict", "call_annotate_novel", "roleplay_conversion", "classify_dialogue", "split_by_quotes", "call_world_and_profile", "call_summarise"]


@pytest.fixture
def ten_thousand(spark):
    before = spark.conf.get(KEY)
    spark.conf.set(KEY, "10000")
    yield
    spark.conf.set(KEY, before)


@pytest.mark.parametrize("name", QUERIES)
def test_batches_of_texts_are_small(spark, ten_thousand, name):
    registry.queries()[name](spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get(KEY)) == BATCH_ROWS


def test_a_processor_sees_few_rows_at_once(spark, ten_thousand):
    rows = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a"), 10).alias("text"))
    assert steps.process_rows(rows, lambda r: r).count() == 3000
    seen = steps.process_rows(rows, lambda r: r).mapInPandas(lambda frames: (f[:1].assign(doc_id=len(f)) for f in frames), rows.schema)
    assert max(r.doc_id for r in seen.collect()) <= BATCH_ROWS


def test_blocks_with_their_fallback_read_the_lines_once(spark, tmp_path):
    from __spark_entry__ import queries
    from storyloom.operators import messages as ms

    rows = [(1, p, f"a{p}", p % 3 == 0, "P") for p in range(16)] + [(2, p, f"b{p}", False, None) for p in range(16)] + [(3, 0, "c", True, "P")] + [(4, p, f"d{p}", True, "P" if p else None) for p in range(3)]
    lines = spark.createDataFrame(rows, "doc_id long, pos long, line string, is_dialogue boolean, speaker string")
    apart = ms.with_fallback(ms.roleplay_blocks(lines, "doc_id", "P").select("doc_id", "pos", "role", "content"), ms.fallback_blocks(lines, "doc_id").select("doc_id", "pos", "role", "content"), "doc_id")
    assert sorted(map(tuple, ms.roleplay_or_fallback(lines, "doc_id", "P").select("doc_id", "pos", "role", "content").collect())) == sorted(map(tuple, apart.collect()))
    spark.createDataFrame([(1, "a\nbb\nccccc")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = queries()["fallback_trigger"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_a_model_gets_its_inputs_only_and_is_asked_once(spark, tmp_path):
    from storyloom.plans.modelcalls import call_rows

    def model(task, inputs):
        assert set(inputs) == {"text"}
        with open(f"{tmp_path}/asked", "a") as f:
            f.write(f"{inputs['text']}\n")
        return f'{{"n": {inputs["text"]}}}'

    # a column that no batch of Python can carry stays where it is
    rows = spark.range(0, 20, 1, 2).selectExpr("id", "make_ym_interval(cast(id as int), 1) as age", "cast(id as string) as text")
    got = call_rows(rows, model, "profile", ["text"]).withColumn("n", F.from_json("reply", "n int")["n"]).where("n is not null and n % 2 = 0")
    assert sorted((r.n, r.age) for r in got.select("n", F.expr("cast(age as string)").alias("age")).collect()) == [(i, f"INTERVAL '{i}-1' YEAR TO MONTH") for i in range(0, 20, 2)]
    assert sorted(map(int, (tmp_path / "asked").read_text().split())) == list(range(20))


def test_the_characters_of_stories_are_cleaned_once_and_written_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(steps, "cut", lambda df, real=steps.cut: written.append(df.schema.names) or real(df))
    texts = spark.createDataFrame([("b", "Anna went home.\n“Hello,” said Anna.\n# two\nPeter stayed.\n“Bye,” said Peter.")], "book string, text string")
    assert steps.run_story_pipeline(spark, texts).count() > 0
    assert len([w for w in written if "alias" in w]) == 1
    assert not [w for w in written if "chunk" in w and "text" in w]
    assert [w for w in written if "chunk" in w] == [["book", "stem", "chunk", "r", "clean"]]


def test_groups_of_names_are_rows_of_their_own(spark):
    from storyloom.operators import characters

    rows = [(b, s, p, names, {n: p + 2 for n in names[:1]}) for b in ("a", "b", None) for s in ("s1", "s2") for p, names in enumerate((["Anna", "Ann"], [], ["Peter"], ["Annabel"], ["x"], ["x" * 30, "Pete"]))]
    mentions = spark.createDataFrame(rows, "book string, segment string, pos int, names array<string>, freqs map<string, int>")
    got = [(r.book, r.grp, r.over, dict(zip(r.names, r.freqs, strict=True))) for r in characters.group_lists(mentions).orderBy("book", "grp").collect()]
    groups = [{"Anna": 4, "Ann": 2, "Annabel": 10}, {"Peter": 8, "x" * 30: 14, "Pete": 2}, {"x": 12}]
    assert got == [(b, i, 0, g) for b in "ab" for i, g in enumerate(groups)]
    flat = {(b, i, n, f) for b, i, _, g in got for n, f in g.items()}
    assert {(r.book, r.grp, r.name, r.freq) for r in characters.name_groups(mentions).collect()} == flat
