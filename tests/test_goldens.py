"""Hand-written cases of the operators' rules."""

import http.server
import json
import random
import threading
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from storyloom import __main__ as main
from storyloom.functions import blocks, fuzzy
from storyloom.functions import text as tx
from storyloom.operators import chains, characters, chunking, cleaning, mapping, messages, ordering, relational, state
from storyloom.plans import client, modelcalls, steps
from storyloom.sources import datasets, readers, writers
from storyloom.streaming import streams


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in zip(values, ["string"] * len(values), strict=True))) if values else spark.range(1)
    return df.select(expr).first()[0]


def test_quote_pieces():
    assert fuzzy.quote_pieces('"你好"，他说道。"再见"，她回答。') == ['"你好"', "，他说道。", '"再见"', "，她回答。"]
    assert fuzzy.quote_pieces("「全部」\n\n无引号") == ["「全部」", "", "无引号"]


@pytest.mark.parametrize(("text", "want"), [("「x」", "x"), ('"', '"'), ("「x』", "「x』"), ('"a"', "a"), (None, None)])
def test_unquote(spark, text, want):
    assert one(spark, tx.unquote("t"), t=text) == want


def test_strip_knows_wide_spaces(spark):
    assert one(spark, tx.strip("t"), t="　 a　b  \n") == "a　b"


def test_split_lines_like_python(spark):
    text = "a\r\nb\n\nc\x1cd e\n"
    assert one(spark, tx.split_lines("t"), t=text) == text.splitlines()


def test_split_dialogue(spark):
    assert one(spark, tx.split_dialogue("t"), t="他说“好。”然后走了。。。天黑了") == "他说\n“好。”\n然后走了。\n天黑了"
    assert one(spark, tx.split_dialogue("t"), t="一。二！三") == "一。\n二！\n三"
    assert one(spark, tx.split_dialogue("t"), t=None) == ""


def test_speaker_runs(spark):
    rows = spark.createDataFrame([(1, i, s, f"c{i}") for i, s in enumerate(["A", "A", "", None, "A"])], "doc int, pos int, speaker string, content string")
    got = [(r.speaker, r.content) for r in messages.merge_speaker_runs(rows, "doc").orderBy("pos").collect()]
    assert got == [("A", "c0\nc1"), ("", "c2\nc3"), ("A", "c4")]


def test_fallback_2_5(spark):
    rows = spark.createDataFrame([(1, i, f"l{i}") for i in range(9)], "doc int, pos int, line string")
    got = [(r.role, len(r.content.split("\n"))) for r in messages.fallback_blocks(rows, "doc").orderBy("pos").collect()]
    assert got == [("user", 2), ("assistant", 5), ("user", 2)]


def chat(spark, roles, reasoning="r"):
    rows = [(1, i, r, f"c{i}", reasoning if r == "assistant" else None) for i, r in enumerate(roles)]
    return messages.to_arrays(spark.createDataFrame(rows, "doc int, pos int, role string, content string, reasoning_content string"), "doc", ("role", "content", "reasoning_content"))


def test_reasoning_variants(spark):
    got = messages.reasoning_variants(chat(spark, ["system", "user", "assistant", "user", "assistant"]), "doc").orderBy("variant").collect()
    assert len(got) == 3
    assert [m.reasoning_content for m in got[0].messages] == [None, None, "", None, ""]
    assert got[0].messages[0].content == "[THINKING:OFF]\nc0"
    assert [m.reasoning_content for m in got[2].messages] == [None, None, None, None, "r"]
    two = messages.reasoning_variants(chat(spark, ["system", "assistant", "user"]), "doc").orderBy("variant").collect()
    assert len(two) == 2
    assert [(m.role, m.content) for m in two[1].messages] == [("system", "[THINKING:ON]\nc0"), ("user", ""), ("assistant", "c1")]
    assert messages.reasoning_variants(chat(spark, ["assistant"]), "doc").count() == 0


def test_variant_count_is_one_and_assistants(spark):
    for k in range(1, 5):
        roles = ["user", "assistant"] * k
        assert messages.reasoning_variants(chat(spark, roles), "doc").count() == 1 + k


def test_no_message_is_lost_in_paraphrase(spark):
    rng = random.Random(5)
    roles = [rng.choice(["user", "assistant"]) for _ in range(40)]
    long = messages.paraphrase(chat(spark, roles), "doc", min_chars=7).where("role = 'assistant'").orderBy("pos").collect()
    assert "\n".join(r.content for r in long) == "\n".join(f"c{i}" for i in range(40))


def test_interval_union_and_subtraction(spark):
    assert fuzzy.union([(0, 5), (5, 9), (11, 12)]) == [(0, 9), (11, 12)]
    rows = spark.createDataFrame([(1, 0, 5), (1, 5, 9), (1, 11, 12)], "k int, s int, e int")
    assert sorted((r.s, r.e) for r in cleaning.interval_union(rows, "k", "s", "e").collect()) == [(0, 9), (11, 12)]
    assert fuzzy.without("abcdefghij", [(1, 3), (5, 6)]) == "adeghij"


@pytest.mark.parametrize(("total", "n", "kept"), [(9, 1, True), (10, 1, False), (10, 2, True)])
def test_main_character_threshold(spark, total, n, kept):
    counts = spark.createDataFrame([("b", "x", n)], "book string, name string, n int")
    totals = spark.createDataFrame([("b", total)], "book string, total int")
    assert bool(characters.main_characters(counts, totals, "book").count()) is kept


def test_thin_boundaries(spark):
    f = lambda b, **k: spark.range(1).select(chunking.thin_boundaries(F.array(*[F.lit(x) for x in b]), **k)).first()[0]
    assert f([1, 3, 7, 8, 20]) == [1, 7, 20]
    assert f([1, 10, 12]) == [1, 12]
    assert f([1, 10, 12], keep_last=False) == [1, 10]
    assert f([1, 3]) == [1, 3]


def test_names(spark):
    names = ["他", "妈妈", "的妈妈", "莉莉的妈妈", "那个", "张医生", " 桃华 "]
    got = spark.range(1).select(characters.valid_names(F.array(*[F.lit(n) for n in names]))).first()[0]
    assert got == ["莉莉的妈妈", "桃华"]


def test_name_groups(spark):
    rows = [("b", 1, 0, ["Anna Lee", "Anna"], {"Anna": 3}), ("b", 1, 1, ["Bob"], {}), ("b", 2, 0, ["Lee"], {"Lee": 2}), ("b", 2, 1, ["Bobby"], {})]
    df = spark.createDataFrame(rows, "book string, segment int, pos int, names array<string>, freqs map<string,int>")
    got = {(r.grp, r.name): r.freq for r in characters.name_groups(df).collect()}
    assert got == {(0, "Anna Lee"): 1, (0, "Anna"): 3, (0, "Lee"): 2, (1, "Bob"): 1, (1, "Bobby"): 1}


def test_prune_matches_its_frame_form(spark):
    rng = random.Random(2)
    names = ["".join(rng.choice("abcd") for _ in range(rng.randint(2, 9))) + str(i) for i in range(12)]
    freq = {n: rng.randint(1, 4) for n in names}
    df = spark.createDataFrame([(1, i, n, freq[n]) for i, n in enumerate(names)], "g int, pos int, name string, freq int")
    assert {r.name for r in characters.alias_prune(df, "g").collect()} == set(characters.prune(names, freq))


def test_packing_is_lossless_and_bounded(spark):
    rng = random.Random(1)
    text = "\n".join("x" * rng.randint(0, 60) for _ in range(200))
    df = spark.createDataFrame([(1, text)], "doc int, text string")
    got = chunking.pack_lines(df, "doc", chunking.line_chunks(F.split("text", "\n"), 100)).orderBy("chunk").collect()
    assert "\n".join(r.content for r in got) == text
    assert all(len(r.content) + 1 <= 100 or r.n_lines == 1 for r in got)


def test_byte_shards(spark):
    df = spark.createDataFrame([("k", i, n) for i, n in enumerate([60, 50, 40, 200, 10])], "key string, pos int, n int")
    got = [r.shard for r in chunking.byte_shards(df, F.col("n"), "key", "pos", 100).orderBy("pos").collect()]
    assert got == [1, 2, 2, 3, 4]
    assert chunking.byte_shards(df, F.col("n"), "key", "pos", 100, total_bytes=110).count() == 2


def test_containment_and_repeats():
    assert fuzzy.shared_share("", "x") == 1.0
    assert fuzzy.shared_share("x", "") == 0.0
    a, b = "the quick fox", "so the quick brown fox ran"
    assert fuzzy.shared_share(a, b) == sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks()) / len(a)
    assert fuzzy.repeated_intervals("say: never open the door now", ["never open the door"]) == [(5, 24)]
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcde ") for _ in range(rng.randint(0, 30))) for _ in range(2))
        assert fuzzy.alike(a, b, 0.7) is (fuzzy.shared_share(a, b) >= 0.7)


def rewritten(spark, messages, rule):
    df = spark.createDataFrame([("r", json.dumps({"model": "m", "messages": messages}))], "id string, input string")
    row = cleaning.rewrite_messages(df, rule).first()
    doc = json.loads(row.input)
    assert doc["model"] == "m"
    return doc["messages"], row.changed, row.removed


def test_dedup_and_merge_system(spark):
    msgs = [{"role": "system", "content": "Always answer in French."}, {"role": "user", "content": "hi"}, {"role": "system", "content": "Always answer in French. Be kind.", "x": 1}]
    assert rewritten(spark, msgs, cleaning.dedup_system) == ([*msgs[:2], {"role": "system", "content": "Be kind.", "x": 1}], True, 0)
    assert rewritten(spark, msgs[:2], cleaning.dedup_system) == (msgs[:2], False, 0)
    assert rewritten(spark, [*msgs[:2], msgs[0]], cleaning.dedup_system) == (msgs[:2], True, 1)
    blocks = {"role": "system", "content": [{"type": "text", "text": "a"}, "b", {"type": "tool_result", "content": "c"}]}
    assert rewritten(spark, [msgs[0], blocks, msgs[1]], cleaning.merge_system) == ([{"role": "system", "content": "Always answer in French.\na\nb\nc"}, msgs[1]], True, 1)
    empty = {"role": "system", "content": ""}
    assert rewritten(spark, [msgs[1], empty, empty, msgs[1]], cleaning.merge_system) == ([msgs[1], empty, msgs[1]], True, 1)
    odd = spark.createDataFrame([("a", None), ("b", "no json"), ("c", "[]"), ("d", '{"messages": []}')], "id string, input string")
    assert sorted((r.id, r.input, r.changed, r.removed) for r in cleaning.rewrite_messages(odd, cleaning.dedup_system).collect()) == [("a", None, False, 0), ("b", "no json", False, 0), ("c", "[]", False, 0), ("d", '{"messages": []}', False, 0)]


def test_content_text(spark):
    for text, want in [(None, ""), ("", ""), ("plain", "plain"), ("[not json", "[not json"), ('"q"', "q"), ('[{"type":"text","text":"a"},"b",{"type":"image"},{"type":"tool_result","content":"c"}]', "a\nb\nc"), ("[]", "")]:
        assert one(spark, blocks.content_text("t"), t=text) == want


def test_assistant_content(spark):
    for messages_, want in [([], False), ([{"role": "user", "content": "x"}], False), ([{"role": "assistant", "content": " "}], False), ([{"role": "assistant", "content": "x"}], True), ([{"role": "assistant", "content": [{"type": "tool_use"}]}], True), ([{"role": "assistant", "content": [{"type": "text", "text": " "}]}], False)]:
        assert one(spark, blocks.has_assistant_content("t"), t=json.dumps({"messages": messages_})) is want
    assert one(spark, blocks.has_assistant_content("t"), t=None) is False


def test_output_as_message(spark):
    get = lambda o: (lambda x: json.loads(x) if x else None)(one(spark, F.to_json(blocks.output_message("t")), t=json.dumps(o)))
    assert get({"content": "hi"}) == {"role": "assistant", "content": "hi"}
    assert get({"content": ""}) is None
    call = {"id": "1", "function": {"name": "f", "arguments": '{"a": 1}'}}
    assert get({"content": "hi", "tool_calls": [call, {"function": {"arguments": "{bad"}}]}) == {"role": "assistant", "content": [{"type": "text", "text": "hi"}, {"type": "tool_use", "id": "1", "name": "f", "input": {"a": 1}}, {"type": "tool_use", "id": "", "name": "", "input": "{bad"}]}


def test_chain_merge_keeps_the_longer_answer(spark):
    user = lambda t: {"role": "user", "content": t}
    bot = lambda t: {"role": "assistant", "content": t}
    full = "The answer to the question is forty-two, as everybody knows by now."
    docs = [("r1", [user("q")], {"content": full + " More of it."}), ("r2", [user("q"), bot(full), user("w")], {"content": "second"}), ("r3", [user("q"), bot(full), user("w"), bot("second"), user("v")], {"content": "third"})]
    records = spark.createDataFrame([(i, f"t{i}", "{}", json.dumps({"messages": m}), json.dumps(o)) for i, m, o in docs], "id string, timestamp string, metadata string, input string, output string")
    chain = spark.createDataFrame([("r1", "r1", 0), ("r1", "r2", 1), ("r1", "r3", 2)], "root string, id string, depth long")
    row = chains.merge_chains(records, chain).first()
    assert (row.id, row.timestamp, row.merged, json.loads(row.output)) == ("r1", "tr1", 3, {"content": "third"})
    assert json.loads(row.input)["messages"] == [user("q"), bot(full + " More of it."), user("w"), bot("second"), user("v"), bot("third")]
    assert chains.places(["", "abcdefghij", "abcdefghijk"], ["abcdefghijkl", "abcdefghijklm"]) == [-1, 1, -1]


@pytest.mark.parametrize(("value", "empty"), [(None, True), ("", True), (" ", True), ("null", True), ('" "', True), ("[]", False), ("{}", True), ('{"content":"x"}', False), ('{"content":[{"text":""}]}', True), ('{"content":[{"text":"a"}]}', False), ('{"tool_calls":[{}]}', False), ('{"tool_calls":[]}', True), ('{"function_call":{"name":"f"}}', False), ('{"content":"a\nb"}', False), ("not json", False)])
def test_output_is_empty(spark, value, empty):
    assert one(spark, blocks.is_output_empty("t"), t=value) is empty


def test_fix_json():
    assert fuzzy.repair_json('"{\\"a\\": 1}"') == ('{"a": 1}', True)
    assert fuzzy.repair_json("\x1b[1m[1]\x1b[0m") == ("[1]", True)
    assert fuzzy.repair_json('{"a":1}') == ('{"a":1}', False)


def test_claimed_match_gives_no_link(spark):
    rows = [("a", 0, 5, True), ("b", 1, 5, True), ("c", 2, 5, False), ("c", 2, 6, True)]
    df = spark.createDataFrame([(i, j, a, f"r{j}", "", "", h) for a, i, j, h in rows], "i int, j int, a_id string, b_id string, a_ts string, b_ts string, hit boolean")
    assert {(r.a_id, r.b_id) for r in chains.links(df).collect()} == {("a", "r5"), ("c", "r6")}


def test_search_ends_behind_the_first_late_candidate(spark):
    at = {1: "2024-01-01T00:00:00Z", 2: "2024-01-01T03:00:00Z", 3: "2024-01-01T03:01:00Z"}
    df = spark.createDataFrame([(0, 1, False), (0, 2, False), (0, 3, True)], "i int, j int, hit boolean")
    df = df.withColumn("a_id", F.lit("a")).withColumn("b_id", F.col("j").cast("string")).withColumn("a_ts", F.lit(at[1])).withColumn("b_ts", F.create_map(*[F.lit(x) for kv in at.items() for x in kv])[F.col("j")])
    assert chains.links(df).count() == 0
    assert chains.links(df.withColumn("hit", F.col("j") == 2)).count() == 1


def test_mappings(spark):
    df = spark.createDataFrame([("Say", None, "ok")], "instruction string, input string, output string")
    row = mapping.map_rows(df, "alpaca").first()
    assert [(m.role, m.content) for m in row.messages] == [("user", "Say"), ("assistant", "ok")]
    assert row.instruction == "Say" and row.output == "ok"
    assert mapping.map_rows(df, "content").first().text is None


def test_global_index(spark):
    df = spark.range(1000).withColumn("k", F.xxhash64("id"))
    got = ordering.global_index(df, "k").orderBy("k").collect()
    assert [r.idx for r in got] == list(range(1000))


def test_insert_or_ignore_first_wins(spark):
    old = spark.createDataFrame([("a", "old")], "id string, v string")
    new = spark.createDataFrame([("a", "x", 1), ("b", "first", 2), ("b", "second", 3), ("", "no id", 4)], "id string, v string, line int")
    got = {r.id: r.v for r in relational.insert_or_ignore(old, new, ["id"], "line").collect()}
    assert got == {"a": "old", "b": "first", "": "no id"}


def test_item_fold_matches_plain_rules(spark):
    rng = random.Random(3)
    rows, held = [], {}
    for i in range(300):
        item, act, new = rng.choice("xyz"), rng.choice(["add", "remove", "modify"]), rng.choice(["", "s1", "s2"])
        rows.append((1, i, "c", item, act, new))
        if act == "add":
            held.setdefault(item, new)
        elif act == "remove":
            held.pop(item, None)
        else:
            held[item] = (new or held[item]) if item in held else new
    df = spark.createDataFrame(rows, "story int, pos int, character string, item_name string, action string, new_state string")
    assert {r.item_name: r.state for r in state.item_fold(df, ["story"], "pos").collect()} == held


def test_pov_fold_keeps_a_known_characters_name(spark):
    rows = [("b", 0, True, "", [["An", "Anna"]]), ("b", 1, True, "Anna", [["An", "Anna"]]), ("b", 2, True, "An", [["An", "Anna"]]), ("b", 3, True, "", [["An", "Anna"]]), ("b", 4, True, "Bo", [["An", "Anna"]])]
    df = spark.createDataFrame(rows, "book string, n int, is_first_person boolean, first_person_name string, aliases array<array<string>>")
    got = [r.pov for r in characters.pov_fill(df, "book", "n", groups=True).orderBy("n").collect()]
    assert got == ["Anna", "Anna", "Anna", "Anna", "Bo"]


def test_refusals_end_in_the_canned_prompt():
    assert modelcalls.system_prompt_or_canned(lambda t, x: "无法生成", {}, "first line").endswith("first line")
    assert modelcalls.parse_reply('```json\n{"a": 1}\n```') == {"a": 1}
    assert modelcalls.Retrying(lambda t, x: "no", tries=2, delay=0)("x", {}, check=lambda v: False) is None


def test_steps_are_listed_and_checked(spark):
    assert [s for s, _ in steps.list_steps()] == ["1_1", "1_2", "1_3", "1_4", "1_5", "2_1", "2_2"]
    with pytest.raises(ValueError, match="no step"):
        steps.run_step("9")


def test_files(spark, tmp_path):
    src = tmp_path / "in.jsonl"
    src.write_text('{"text":"中文"}\n\nnot json\n{"text":"b"}\n', encoding="utf-8")
    good, bad = readers.read_jsonl(spark, str(src))
    assert sorted(r.text for r in good.collect()) == ["b", "中文"]
    assert [r.line for r in bad.collect()] == ["not json"]
    writers.write_jsonl(good, str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ['{"text":"b"}', '{"text":"中文"}']
    writers.write_dataset(good, str(tmp_path / "set"), "n", files=1)
    assert spark.read.parquet(str(tmp_path / "set/data")).count() == 2
    assert '"count": 2' in (tmp_path / "set/metadata.json").read_text()
    book = tmp_path / "books" / "b1"
    book.mkdir(parents=True)
    (book / "s1.txt").write_text("x\ny")
    got = readers.read_whole_text(spark, str(tmp_path / "books")).first()
    assert (got.book, got.stem, got.text) == ("b1", "s1", "x\ny")


def test_dataset_source(spark):
    spark.dataSource.register(datasets.DatasetSource)
    got = spark.read.format("storyloom_dataset").option("path", "/root/testdata/sf0.001/benchmark.parquet").option("columns", "item_id bigint, text string").load()
    assert got.count() == 40


def test_stream_drains_and_resumes(spark, tmp_path):
    from storyloom.schemas import TEXT_ROW
    from storyloom.streaming import streams

    src = tmp_path / "src"
    src.mkdir()
    for k in range(2):
        (src / f"{k}.json").write_text(f'{{"text":"t{k}"}}\n')
        streams.drain(streams.read_jsonl_stream(spark, str(src), TEXT_ROW), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert sorted(r.text for r in spark.read.json(str(tmp_path / "out")).collect()) == ["t0", "t1"]


class _Stub(http.server.BaseHTTPRequestHandler):
    """A model's server: fails the first request of a task, streams on demand, and gives back the inputs."""

    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        _Stub.seen.append((self.path, self.headers.get("Authorization"), body))
        said = body["messages"][1]["content"]
        if "broken" in said or len(_Stub.seen) == 1:
            self.send_error(400 if "broken" in said else 503)
            return
        self.send_response(200)
        self.end_headers()
        if body["stream"]:
            for part in ("a", "b", None):
                self.wfile.write(b"data: " + json.dumps({"choices": [{"delta": {"content": part} if part else {}}]}).encode() + b"\n\n")
            self.wfile.write(b"data: [DONE]\n\n")
        else:
            self.wfile.write(json.dumps({"choices": [{"message": {"content": said}}]}).encode())

    def log_message(self, *args):
        pass


@pytest.fixture
def endpoint():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Stub)
    _Stub.seen = []
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1"
    server.shutdown()


def test_model_client(spark, endpoint, monkeypatch):
    monkeypatch.setenv("MODEL_API_KEY", "k")
    model = client.HttpModel(endpoint, "m", {"world": "Describe the world."}, delay=0)
    assert json.loads(model("world", {"text": "é"})) == {"text": "é"}
    assert len(_Stub.seen) == 2  # the first try met a fault of the server
    path, key, body = _Stub.seen[-1]
    assert path == "/v1/chat/completions" and key == "Bearer k" and body["model"] == "m" and body["messages"][0]["content"] == "Describe the world."
    assert list(model.stream("world", {"text": "x"})) == ["a", "b"]
    with pytest.raises(OSError, match="400"):
        model("world", {"text": "broken"})
    assert modelcalls.Retrying(model, tries=1)("world", {"text": "broken"}) is None
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "id int, text string")
    got = modelcalls.call_rows(rows, model, "profile", ["text"]).collect()
    assert {r.id: json.loads(r.reply) for r in got} == {1: {"text": "x"}, 2: {"text": "y"}}


def test_dataset_source_streams_and_shuffles(spark, tmp_path):
    spark.dataSource.register(datasets.DatasetSource)
    for i in range(3):
        spark.range(i * 100, i * 100 + 100).coalesce(1).write.mode("append").parquet(f"{tmp_path}/data/small/train")
    load = lambda r, **o: r.format("storyloom_dataset").options(path=f"{tmp_path}/data", subset="small", split="train", columns="id bigint", **o).load()
    plain = [r.id for r in load(spark.read).collect()]
    mixed = [r.id for r in load(spark.read, buffer=30, seed=3252).collect()]
    assert sorted(mixed) == sorted(plain) == list(range(300)) and mixed != plain
    assert mixed == [r.id for r in load(spark.read, buffer=30, seed=3252).collect()]
    assert mixed != [r.id for r in load(spark.read, buffer=30, seed=1).collect()]
    for _ in range(2):  # the second query finds all files read
        streams.drain(load(spark.readStream, buffer=30), f"{tmp_path}/out", f"{tmp_path}/mark", "parquet").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(300))


def test_command_line(spark, tmp_path, capsys):
    assert main.main(["list"]) == 0
    assert capsys.readouterr().out.splitlines()[0] == "1_1 scene segmentation"
    spark.createDataFrame([(1, "a\n#b\nc")], "doc_id int, text string").write.parquet(f"{tmp_path}/in")
    assert main.main(["run", "1_1", "--input", f"{tmp_path}/in", "--output", f"{tmp_path}/out", "--set", "least=0", "--set", "gap=1"]) == 0
    assert [r.content for r in spark.read.parquet(f"{tmp_path}/out").orderBy("start_line").collect()] == ["a", "#b\nc"]
    with pytest.raises(SystemExit):
        main.main(["run", "9_9", "--input", "x", "--output", "y"])


def test_tag_vocabulary_golden(spark):
    rows = spark.createDataFrame([("Test1", "Tag1, Tag2"), ("Test2", "Tag2, Tag3"), ("Test3", None), ("Test4", " ,")], "name string, tags string")
    assert {r[0] for r in relational.tag_vocabulary(rows).collect()} == {"Tag1", "Tag2", "Tag3"}


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    from storyloom.plans import lineage

    class Session:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d), "set": staticmethod(lambda k, v: None)})
        sparkContext = type("S", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="checkpoint"):
        lineage.shared_dir(Session())
