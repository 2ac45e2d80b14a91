"""Queries that have no SQL, against plain loops over the rows of sf0.001 or against what must hold of them."""

import json
from collections import Counter, defaultdict
from difflib import SequenceMatcher

import pytest

from storyloom import registry
from storyloom.operators import characters

DATA = "/root/testdata/sf0.001"
TESTED = {
    "split_segments_random", "scenes_merged", "scene_segmentation", "split_by_quotes", "roleplay_conversion", "style_conversion", "fetch_and_shard", "augment_catalog",
    "chain_links_fuzzy", "chain_merge", "system_dedup", "system_merge", "rewrite_counts", "name_group_fold", "carried_summaries", "story_structure", "story_pipeline", "reply_masks",
}


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: registry.queries()[name](spark, DATA)


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def quoted(text):
    return text.replace(", ", "。").replace(". ", "「").replace(" the ", "」")


def test_split_by_quotes(run, docs):
    got = defaultdict(list)
    for r in run("split_by_quotes").orderBy("doc_id", "n").collect():
        got[r.doc_id].append(r.piece)
    for doc, row in docs.items():
        text = quoted(row.text or "")
        assert "".join(got[doc]) == text.replace("\n", "")
        assert all("\n" not in p for p in got[doc])
        for p in got[doc]:
            inner = p[1:-1]
            if p[:1] == "「" and "」" in inner and "「" not in inner:
                raise AssertionError(p)  # a bracketed part and what follows it stay together


def test_split_segments_random(spark, run, docs):
    """Line by line, with the targets that the seed draws."""
    from pyspark.sql import functions as F

    from tests.test_packing import plain_segments

    draw = F.transform(F.sequence(F.lit(0), F.lit(80)), lambda n: F.lit(2000) + F.pmod(F.xxhash64(F.lit(7), F.col("doc_id").cast("string"), n), F.lit(2001)).cast("int"))
    aims = {r.doc_id: r.aims for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", draw.alias("aims")).collect()}
    want = []
    for doc, r in docs.items():
        *heads, last = (r.text or "").split("\n")
        lines = [f"{h}\n" for h in heads] + ([last] if last else [])
        want += [(doc, i, s) for i, s in enumerate(plain_segments(lines, 2000, 4000, aims[doc].__getitem__))]
    assert sorted((r.doc_id, r.n, r.segment) for r in run("split_segments_random").collect()) == sorted(want)


def chains_of(spark):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{DATA}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append(r)
    return turns


def near(a, b):
    small, large = sorted((a, b), key=len)
    if len(small) > 5000:
        small, large = (x[:2000] + x[-2000:] for x in (small, large))
    return not small or sum(m.size for m in SequenceMatcher(None, small, large).get_matching_blocks()) / len(small) >= 0.9


def plain_links(spark):
    out = set()
    for conv, turns in chains_of(spark).items():
        records = [(f"c{conv:06d}-{t.turn:03d}", t.turn, t.text) for t in turns if t.role == "assistant" and t.turn > 0]
        taken = set()
        for i, (rid, last, answer) in enumerate(records):
            text = (answer or "").strip()
            if not answer:
                continue
            for j, (other, at, _) in enumerate(records[i + 1 : i + 50], i + 1):
                said = [(t.text or "").strip() for t in turns if t.turn < at and t.role == "assistant"]
                if text and any(s and ((text in s) if len(text) < 20 else (text == s or near(s, text))) for s in said):
                    if j not in taken:
                        taken.add(j)
                        out.add((rid, other))
                    break
    return out


def test_chain_links_fuzzy(spark, run):
    assert {(r.a_id, r.b_id) for r in run("chain_links_fuzzy").collect()} == plain_links(spark)


def test_chain_merge(spark, run):
    turns = chains_of(spark)
    members = defaultdict(list)
    for r in run("chain_closure").collect():
        members[r.root].append((r.depth, r.id))
    rows = run("chain_merge").collect()
    assert {r.id for r in rows} == {k for k, v in members.items() if len(v) > 1}
    for r in rows:
        last = max(members[r.id])[1]
        conv, at = int(last[1:7]), int(last[8:])
        want = [{"role": t.role, "content": t.text} for t in turns[conv] if t.turn <= at]
        got = json.loads(r.input)["messages"]
        assert r.merged == len(members[r.id]) and [m["role"] for m in got] == [m["role"] for m in want]
        answers = {t.text for t in turns[conv] if t.role == "assistant"}
        assert all(g == w or (w["role"] == "assistant" and g["content"] in answers and near(w["content"].strip(), g["content"].strip())) for g, w in zip(got, want, strict=True))
        assert json.loads(r.output)["content"] == next(t.text for t in turns[conv] if t.turn == at)


def system_records(spark):
    out = {}
    for conv, turns in chains_of(spark).items():
        first = next(t.text for t in turns if t.turn == 0)
        out[str(conv)] = [{"role": "system" if t.turn % 3 == 0 else t.role, "content": f"{t.text} {first}" if t.turn % 6 == 3 else t.text} for t in turns]
    return out


def plain_dedup(messages):
    """Marks the characters that a block of ten or more shares with an earlier system text."""
    at = [i for i, m in enumerate(messages) if m["role"] == "system"]
    new = {}
    for k in range(len(at) - 1, 0, -1):
        text = messages[at[k]]["content"]
        gone = [False] * len(text)
        for i in at[:k]:
            for m in SequenceMatcher(None, text, messages[i]["content"], autojunk=False).get_matching_blocks():
                if m.size >= 10 and len(text) >= 10:
                    gone[m.a : m.a + m.size] = [True] * m.size
        if any(gone):
            new[at[k]] = "".join(c for c, g in zip(text, gone, strict=True) if not g).strip()
    return [m | {"content": new.get(i, m["content"])} for i, m in enumerate(messages) if new.get(i) != ""], bool(new)


def plain_merge(messages):
    out, changed = [], False
    for m in messages:
        if out and out[-1][0]["role"] == m["role"] == "system":
            out[-1].append(m)
            changed = True
        else:
            out.append([m])
    return [run[0] if len(run) == 1 else {"role": "system", "content": "\n".join(m["content"] for m in run if m["content"])} for run in out], changed


@pytest.mark.parametrize(("name", "rule"), [("system_dedup", plain_dedup), ("system_merge", plain_merge)])
def test_system_rules(spark, run, name, rule):
    got = {r.id: (json.loads(r.input)["messages"], r.changed, r.removed) for r in run(name).collect()}
    want = {}
    for rid, messages in system_records(spark).items():
        out, changed = rule(messages)
        want[rid] = (out, changed, len(messages) - len(out))
    assert got == want
    if rule is plain_dedup:
        (counts,) = run("rewrite_counts").collect()
        assert (counts.modified, counts.removed, counts.total) == (sum(c for _, c, _ in want.values()), sum(n for _, _, n in want.values()), len(want))


def test_name_groups_against_all_groups(spark, run):
    """Every mention against every name of every group."""
    rows = spark.read.parquet(f"{DATA}/documents.parquet").where("text is not null").orderBy("source", "doc_id").collect()
    import re

    groups = defaultdict(list)
    over = defaultdict(list)
    for r in rows:
        own, most = groups[r.source], over[r.source]
        fold = False
        for name in re.findall("[A-Z][a-z]{3,7}", r.text):
            fold = True
            scores = [characters.share_score(list(g), [name]) for g in own]
            best = max(range(len(own)), key=lambda i: (scores[i], -i), default=None)
            if best is None or not scores[best]:
                own.append(Counter({name: 1}))
                most.append(0)
            else:
                own[best][name] += 1
        for i, g in enumerate(own) if fold else ():
            most[i] = most[i] + 1 if len(g) > characters.MOST_ALIASES else 0
            if most[i] >= characters.PATIENCE:
                own[i] = Counter({n: g[n] for n in characters.prune(list(g), g)})
                most[i] = 0
    want = {(b, i, n, f) for b, gs in groups.items() for i, g in enumerate(gs) for n, f in g.items()}
    assert {(r.book, r.grp, r.name, r.freq) for r in run("name_group_fold").collect()} == want


def test_scenes_cover_their_documents(run, docs):
    squeeze = lambda s: "".join((s or "").split())
    for name, least in (("scene_segmentation", 300), ("scenes_merged", 500)):
        got = defaultdict(list)
        for r in run(name).collect():
            got[r.doc_id].append(r)
        for doc, parts in got.items():
            parts.sort(key=lambda r: r.start_line)
            lines = docs[doc].text.split("\n")
            assert all(p.content == "\n".join(lines[p.start_line - 1 : p.end_line]).strip() and p.char_count == len(p.content) for p in parts)
            assert all(a.end_line < b.start_line for a, b in zip(parts, parts[1:], strict=False))
            if name == "scene_segmentation":
                assert squeeze("".join(p.content for p in parts)) == squeeze(docs[doc].text)
                assert all(p.char_count >= least for p in parts[1:-1])


def clean(text):
    return [x.strip() for x in (text or "").splitlines() if x.strip()]


def test_style_conversion(run, docs):
    want = set()
    for doc, r in docs.items():
        if r.text:
            lines = r.text.splitlines()
            first, rest = "\n".join(lines[:10]), "\n".join(lines[10:])
            want |= {(doc, 0, "system", f"Continue in this style: {rest[:300]}"), (doc, 1, "user", first), (doc, 2, "assistant", rest)}
    assert {(r.doc_id, r.pos, r.role, r.content) for r in run("style_conversion").collect()} == want


def test_roleplay_conversion(run, docs):
    from storyloom.plans.modelcalls import RuleModel

    rule, want = RuleModel(), []
    for doc, r in docs.items():
        lines = clean(r.text)
        if not lines:
            continue
        who = rule._speakers({"text": "\n".join(lines)[:2000]})
        labels = [x for s in range(0, len(lines), 5) for x in rule._line_labels({"lines": lines[s : s + 5]})]
        mine = [bool(x["is_dialogue"]) and x["speaker"] == who["protagonist"] for x in labels]
        blocks = []
        for line, own in zip(lines, mine, strict=True):
            if blocks and blocks[-1][0] == own:
                blocks[-1][1].append(line)
            else:
                blocks.append((own, [line]))
        talk = [("user" if own else "assistant", "\n".join(x)) for own, x in blocks]
        if len(talk) <= 1:  # two lines to the user, five to the assistant, in turn
            talk, at = [], 0
            while at < len(lines):
                n = (2, 5)[len(talk) % 2]
                talk.append((("user", "assistant")[len(talk) % 2], "\n".join(lines[at : at + n])))
                at += n
        want += [(doc, i, *m) for i, m in enumerate([("system", rule._roleplay_prompt({**who})), *talk])]
    assert sorted((r.doc_id, r.pos, r.role, r.content) for r in run("roleplay_conversion").collect()) == sorted(want)


def test_fetched_rows_in_greedy_shards(spark, run, docs):
    from pyspark.sql import functions as F

    rows = run("fetch_and_shard").collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    known = {r.doc_id: r for r in table.select("doc_id", F.xxhash64(F.lit(3253), "doc_id").alias("at"), F.pmod(F.xxhash64(F.lit(3252), "doc_id"), F.lit(64)).alias("lane"), (F.octet_length(F.to_json(F.struct("text"))) + 1).alias("size")).collect()}
    lanes = defaultdict(list)
    for doc, r in known.items():
        lanes[r.lane].append((r.at, doc, r.size))
    want = {}
    for lane, own in lanes.items():
        cur, shard = 0, 1
        for _, doc, size in sorted(own):
            if cur and cur + size > 100_000:
                cur, shard = 0, shard + 1
            cur += size
            want[doc] = (lane, shard)
    assert {r.doc_id: (r.lane, r.shard) for r in rows} == want


def test_augmented_catalogue(run, docs):
    want = [(str(d), r.source, "novel", ",".join(sorted(set(r.source.lower().split()))[:3]), r.source, False) for d, r in docs.items()]
    assert sorted((r.Uid, r.Title, r.genre, r.tags, r.summary, r.unknown) for r in run("augment_catalog").collect()) == sorted(want)


def test_carried_summaries(spark, run):
    want = []
    for conv, turns in chains_of(spark).items():
        before = ""
        for t in turns:
            summary = ((t.text or "")[:20] + "/" + before)[:60]
            want.append((conv, t.turn, before, summary))
            before = summary
    assert sorted((r.conv_id, r.turn, r.preface, r.summary) for r in run("carried_summaries").collect()) == sorted(want)


def test_story_structure(run, docs):
    from storyloom.plans.modelcalls import RuleModel

    rule, want = RuleModel(), []
    for doc, r in docs.items():
        lines, summary, blocks = clean(r.text), "", []
        for s in range(0, len(lines), 20):
            got = rule._data_blocks({"lines": lines[s : s + 20], "plot_summary": summary})
            summary = got["updated_plot_summary"]
            blocks += got["data_blocks"]
        want += [(doc, i, b["dataType"], b["line_count"], b["content"]) for i, b in enumerate(blocks)]
    assert sorted((r.doc_id, r.pos, r.dataType, r.line_count, r.content) for r in run("story_structure").collect()) == sorted(want)


def test_story_pipeline(run):
    got = defaultdict(list)
    for r in run("story_pipeline").orderBy("book", "stem", "variant").collect():
        got[r.book, r.stem].append((r.variant, r.n))
    assert got
    for variants in got.values():
        # one without reasoning, then one more for each answer, each longer than the last
        assert [v for v, _ in variants] == list(range(len(variants)))
        lengths = [n for v, n in variants if v]
        assert all(a < b for a, b in zip(lengths, lengths[1:], strict=False)) and all(n >= 2 for _, n in variants)


def test_previews_of_texts_that_only_begin_with_json(spark):
    from storyloom.functions.text import preview

    cases = ["123 and more", '{"a": 1} {"b": 2}', "1, 2", "1] x", '"a" b', '{"a": [1, 2]}', " 17 ", "true", '"a b"', "", None, "null", '{"a": 1', "x" * 200]
    want = ["123 and more", '{"a": 1} {"b": 2}', "1, 2", "1] x", '"a" b', '{"a":[1,2]}', "17", "true", '"a b"', "", "", "null", '{"a": 1', "x" * 100]
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    assert [r.p for r in rows.select("i", preview("t").alias("p")).orderBy("i").collect()] == want


def test_shard_names_beyond_999_in_sql_and_files(spark, tmp_path):
    import duckdb

    from storyloom.queries import outputs

    docs = [(i, "en", "x" * 20_000) for i in range(1001)]
    spark.createDataFrame(docs, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in outputs.byte_shard_files(spark, str(tmp_path)).select("lang", "file", "doc_id").collect())
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(con.sql(outputs.SQL["byte_shard_files"]).fetchall())
    assert ("en", "shard_1000.jsonl", 999) in got and ("en", "shard_007.jsonl", 6) in got


def test_no_file_of_the_event_stream_has_a_third_of_the_documents(spark, monkeypatch):
    from pyspark.sql import functions as F

    from storyloom.plans.lineage import new_path
    from storyloom.queries import files

    seen = []
    monkeypatch.setattr(files, "new_path", lambda s, name: seen.append(new_path(s, name)) or seen[-1])
    files.stream_events(spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.json(seen[0]).groupBy(F.input_file_name()).count().collect()
    assert len(rows) > 3 and max(r["count"] for r in rows) < 200 / 3
