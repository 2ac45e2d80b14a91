"""The pipeline's stages on their own inputs, held against the operators' plain forms."""

import pytest

import corpus_pipeline as cp
from storyloom.llm import decontam, pii
from tests.llm import brute

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    out, docs = {}, spark.read.parquet(f"{DATA}/documents.parquet")
    out["documents"] = docs
    for name, f in cp.STAGES:
        docs = cp.write_table(f(spark, docs, DATA), name)
        out[name] = docs
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_dedup", "decontamination", "personal_data", "packing"]
    for name, _ in cp.STAGES[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_quality_keeps_what_passes_the_base_rule_or_less(stages):
    kept = {r.doc_id for r in stages["quality_rules"].collect()}
    fine = {r.doc_id for r in stages["documents"].collect() if not brute.quality(r.text)[-1]}
    assert kept <= fine and len(kept) > 0.8 * len(fine)


def test_pairs_at_four_fifths_are_near_duplicates(spark):
    words = [f"w{i}" for i in range(204)]
    near = [*words[:20], "and", *words[21:60], "there", *words[61:100], "also", *words[101:140], "here", *words[141:]]
    far = [*near[:170], "too", *near[171:]]
    share = lambda a, b: len(brute.shingles(a) & brute.shingles(b)) / len(brute.shingles(a) | brute.shingles(b))
    texts = [" ".join(w) for w in (words, near, [f"x{w}" for w in words], [f"x{w}" for w in far])]
    assert 0.8 <= share(texts[0], texts[1]) < 0.85 and share(texts[2], texts[3]) < 0.8
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in cp.near_dedup(spark, docs, DATA).collect()} == {0, 2, 3}


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages["quality_rules"].collect()]
    assert {r.doc_id for r in stages["near_dedup"].collect()} == {d for d, _, _, kept in brute.near_duplicates(rows, percent=80) if kept}


def test_leaks_go(spark, stages):
    items = spark.read.parquet(f"{DATA}/benchmark.parquet").collect()
    left = " ".join(" ".join(r.text.split()) for r in stages["decontamination"].collect())
    assert not any(" ".join(i.text.split()) in left for i in items)
    assert decontam.contaminated(stages["decontamination"], spark.read.parquet(f"{DATA}/benchmark.parquet")).count() == 0


def test_personal_data_goes(stages):
    assert stages["personal_data"].count() == stages["decontamination"].count()
    assert all(sum(brute.personal(r.text)[:4]) == 0 for r in stages["personal_data"].collect())
    assert pii.find(stages["personal_data"]).where("n_added > 0").count() == 0
    assert all(r.n_chars == len(r.text) for r in stages["personal_data"].collect())


def test_everything_left_is_packed(stages):
    pieces = stages["packing"].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r[0] for r in pieces} == {r.doc_id for r in stages["personal_data"].collect()}
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in pieces)


def test_run_is_the_stages(spark, stages):
    assert sorted(map(tuple, cp.run(spark, DATA).collect())) == sorted(map(tuple, stages["packing"].collect()))


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, gone long, again long, digest string, item_id long, start long"


def odd(spark, texts):
    rows = [(i, t, "en", "src1", len(t) if t is not None else None, 1, 1, "d", 1, 1) for i, t in texts]
    return spark.createDataFrame(rows, CLASHING)


def prose(n, salt=""):
    return " ".join(f"{a}{salt}{b}" for a, b in ((("the river runs past old mills and slow barges toward a grey sea where gulls wait").split()[i % 16], i * 7919 % 1009) for i in range(n)))


CASES = [(1, None), (2, ""), (3, " \n\t"), (None, prose(120)), (None, prose(120)), (None, None), (4, prose(130)), (4, prose(130)), (5, prose(140, "x")), (6, "a@b.cd wrote " + prose(150, "y")), (7, prose(60_000, "z")), (8, "9 " * 35_000), (9, "word " * 50_000), (10, prose(80, "q")), (10, prose(90, "r"))]


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stages_take_odd_tables(spark, name):
    """Nulls, empty and very long texts, repeated rows, one id with several texts, other columns of clashing names, and no rows at all."""
    stage = dict(cp.STAGES)[name]
    docs = odd(spark, CASES).repartition(3)
    got = stage(spark, docs, DATA).collect()
    assert stage(spark, docs.limit(0), DATA).count() == 0
    texts = sorted(((r.doc_id, r.text) for r in got), key=repr) if name != "packing" else None
    if name == "quality_rules":
        fine = [(i, t) for i, t in CASES if not brute.quality(t)[-1]]
        assert all(x in fine for x in texts) and {i for i, _ in texts} >= {None, 4, 5, 10} and not {1, 2, 3, 8, 9} & {i for i, _ in texts}
        assert sum(i is None for i, _ in texts) == 2 and sum(i == 4 for i, _ in texts) == 2
    elif name == "near_dedup":
        # the repeated row of 4 once, all rows without an id, both texts of 10
        assert [t for t in texts if t[0] is not None] == sorted({x for x in CASES if x[0] is not None}, key=repr)
        assert sum(i is None for i, _ in texts) == 3
    elif name == "decontamination":
        assert texts == sorted(CASES, key=repr)
    elif name == "personal_data":
        assert sorted((repr(i), t) for i, t in texts if t is not None) == sorted((repr(i), (t or "").replace("a@b.cd", "[EMAIL]")) for i, t in CASES if t is not None)
        assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in got)
    else:
        by = {}
        for r in got:
            by[r.doc_id] = by.get(r.doc_id, 0) + r.length
        assert set(by) == {i for i, _ in CASES} and by[1] == by[2] == by[3] == 1
    if name != "packing":
        assert tuple(got[0].__fields__) == cp.COLUMNS
