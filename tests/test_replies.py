"""Replies asked for once, ordered folds, and what model steps pass on and ask again."""

import http.server
import json
import os
import subprocess
import sys
import textwrap
import threading
from collections import Counter
from pathlib import Path

import pytest

from storyloom.functions.ordered import columns_of, stream_fold
from storyloom.operators import characters, state
from storyloom.plans import client, modelcalls, replies, steps


class Counting(http.server.BaseHTTPRequestHandler):
    seen: Counter = Counter()

    def do_POST(self):
        said = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["messages"][1]["content"]
        Counting.seen[said] += 1
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps({"choices": [{"message": {"content": f"<{said}>"}}]}).encode())

    def log_message(self, *args):
        pass


@pytest.fixture
def url():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Counting)
    Counting.seen = Counter()
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1"
    server.shutdown()


def test_equal_requests_are_asked_once_over_two_runs(spark, tmp_path, url):
    model = replies.Remembered(client.HttpModel(url, "m", delay=0), f"{tmp_path}/kept")
    rows = spark.createDataFrame([(i, f"t{i % 5}" if i % 7 else None, "own") for i in range(60)], "id int, text string, digest string").repartition(4)
    for _ in range(2):
        got = modelcalls.call_rows(rows, model, "profile", ["text"])
        assert got.columns == ["id", "text", "digest", "reply"]
        said = lambda r: f"<{json.dumps({'text': r.text})}>"
        assert [r.reply for r in got.collect()] == [said(r) for r in got.collect()] and got.count() == 60
    assert len(Counting.seen) == 6 and set(Counting.seen.values()) == {1}
    more = spark.createDataFrame([(1, "t1"), (2, "new")], "id int, text string")
    assert modelcalls.call_rows(more, model, "profile", ["text"]).count() == 2
    assert len(Counting.seen) == 7 and set(Counting.seen.values()) == {1}
    # another task or model is another request
    assert modelcalls.call_rows(more, model, "world", ["text"]).count() == 2
    other = replies.Remembered(client.HttpModel(url, "m2", delay=0), f"{tmp_path}/kept")
    assert modelcalls.call_rows(more, other, "world", ["text"]).count() == 2
    assert sorted(Counting.seen.values()) == [1, 1, 1, 1, 1, 3, 3]


_RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from storyloom.plans import client, modelcalls, replies

class Failing(client.HttpModel):
    def __call__(self, task, inputs):
        if TaskContext.get().attemptNumber() == 0 and inputs["n"] % 10 == 7:
            raise RuntimeError("lost")
        return super().__call__(task, inputs)

spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "file://" + sys.argv[2] + "/shared").getOrCreate()
model = replies.Remembered(Failing(sys.argv[1], "m", delay=0), sys.argv[2] + "/kept")
rows = spark.range(80).selectExpr("id", "cast(id % 40 as int) as n")
assert modelcalls.call_rows(rows, model, "profile", ["n"]).count() == 80
"""


def test_a_task_that_is_tried_again_asks_only_for_the_rest(tmp_path, url):
    script = tmp_path / "job.py"
    script.write_text(textwrap.dedent(_RETRIED))
    env = os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    run = subprocess.run([sys.executable, str(script), url, str(tmp_path)], env=env, capture_output=True, text=True, timeout=240)
    assert run.returncode == 0, run.stderr[-3000:]
    assert "lost" in run.stderr and len(Counting.seen) == 40 and set(Counting.seen.values()) == {1}
    assert not (tmp_path / "kept/journal").exists()


def test_direct_calls_and_replies_not_worth_keeping(tmp_path):
    asked = []

    def model(task, inputs):
        asked.append((task, inputs["x"]))
        return "[1]" if len(asked) > 1 else "sorry"

    kept = replies.Remembered(model, str(tmp_path), "m", check=lambda task, value: isinstance(value, list))
    assert [kept("t", {"x": 1}) for _ in range(4)] == ["sorry", "[1]", "[1]", "[1]"] and len(asked) == 2
    assert kept("t", {"x": 2}) == "[1]" and replies.Remembered(model, str(tmp_path), "m")("t", {"x": 2}) == "[1]" and len(asked) == 3


def test_columns_of_a_schema():
    assert columns_of("a long, b array<struct<x: int, y: decimal(3,1)>>, c map<string,int>") == ["a", "b", "c"]


def test_streamed_folds_hold_a_state(spark):
    rows = spark.createDataFrame([(k, i, i) for k in ("a", "b", None) for i in range(300)], "k string, i int, v int").repartition(5)

    def step(total, row):
        total.append(row["v"])
        return [(row["k"], row["i"], sum(total))] if row["i"] % 100 == 0 else []

    got = stream_fold(rows, ["k"], ["i"], "k string, i int, total long", list, step, lambda total, key: [(key[0], -1, len(total))])
    want = [(k, i, t) for k in ("a", "b", None) for i, t in ((0, 0), (100, 5050), (200, 20100), (-1, 300))]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))


def test_carried_summaries_are_a_plain_loop(spark):
    rows = [(b, i, f"{b}{i}") for b in ("x", "y") for i in range(50)]
    got = state.carry_forward(spark.createDataFrame(rows, "book string, n int, text string").repartition(4), "book", "n", "text", lambda preface, text: f"{preface[-6:]}{text}")
    want, preface = [], {"x": "", "y": ""}
    for b, i, t in rows:
        summary = f"{preface[b][-6:]}{t}"
        want.append((b, i, preface[b], summary))
        preface[b] = summary
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_points_of_view_with_groups(spark):
    names = [["Anna", "Annie"], ["Bob"]]
    rows = [("b", 1, True, None), ("b", 2, False, "x"), ("b", 3, True, "Anna"), ("b", 4, True, "Annie"), ("b", 5, True, None), ("b", 6, True, "Bob"), ("b", 7, True, ""), ("c", 1, True, None), ("c", 2, None, None)]
    df = spark.createDataFrame([(*r, names) for r in rows], "book string, n int, is_first_person boolean, first_person_name string, aliases array<array<string>>")
    got = {(r.book, r.n): r.pov for r in characters.pov_fill(df, "book", "n", groups=True).collect()}
    assert got == {("b", 1): "Anna", ("b", 2): "x", ("b", 3): "Anna", ("b", 4): "Anna", ("b", 5): "Anna", ("b", 6): "Bob", ("b", 7): "Bob", ("c", 1): None, ("c", 2): None}


def test_extraction_is_told_what_is_known(spark, tmp_path):
    log = tmp_path / "asked"

    def model(task, inputs):
        if task != "characters":
            return modelcalls.RuleModel()(task, inputs)
        with log.open("a") as out:
            out.write(json.dumps(inputs) + "\n")
        first = "One" in inputs["text"]
        return json.dumps({"characters": [["Ann", "Annie"]] if first else [["Annie", "Nan"], ["Bo"]], "is_first_person": first, "first_person_name": "Ann" if first else ""})

    segments = spark.createDataFrame([("b", "s1", "One"), ("b", "s2", "Two"), ("b", "s3", "Three"), ("c", "s1", "Two")], "book string, stem string, text string")
    steps.ask_characters(segments.selectExpr("book", "stem", "0 as chunk", "text"), model, "book", "stem").collect()
    asked = [json.loads(x) for x in log.read_text().splitlines()]
    known = {(x["text"], bool(x["known_characters"])): (x["known_characters"], x["known_narrator"]) for x in asked}
    assert known["One", False] == ([], "") and known["Two", False] == ([], "")
    assert known["Two", True] == ([["Ann", "Annie"]], "Ann") and known["Three", True] == ([["Ann", "Annie", "Nan"], ["Bo"]], "Ann")


@pytest.mark.parametrize(("bad", "kept"), [(9, True), (10, False)])
def test_labels_are_asked_for_again(spark, tmp_path, bad, kept):
    log = tmp_path / "asked"

    def model(task, inputs):
        with log.open("a") as out:
            out.write("x\n")
        n = len(log.read_text().splitlines())
        return ["no", '{"speakers": [{"line_number": 99, "speaker": "Ann"}]}'][n % 2] if n <= bad else '{"speakers": [{"line_number": 1, "speaker": "Ann"}]}'

    segments = spark.createDataFrame([("b", "s", "“Hello,” she said.")], "book string, stem string, text string").coalesce(1)
    people = spark.createDataFrame([("b", "s", False, "", ["Ann"])], "book string, stem string, is_pov boolean, pov_name string, characters array<string>")
    facts = spark.createDataFrame([("b", "s", "summary")], "book string, stem string, summary string")
    got = steps.annotate_dialogue(segments, people, facts, people, model).collect()
    assert len(log.read_text().splitlines()) == 10 and bool(got) is kept


def test_facts_of_two_books_with_one_name(spark, tmp_path):
    log = tmp_path / "asked"

    def model(task, inputs):
        with log.open("a") as out:
            out.write(json.dumps(inputs["cast_text"]) + "\n")
        return modelcalls.RuleModel()(task, inputs)

    segments = spark.createDataFrame([("A", "s", "Anna sat."), ("B", "s", "Anna ran.")], "book string, stem string, text string")
    people = spark.createDataFrame([("A", "s", False, "", ["Anna"]), ("B", "s", False, "", ["Anna"])], "book string, stem string, is_pov boolean, pov_name string, characters array<string>")
    chars = spark.createDataFrame([("A", "Anna", ["Annie"]), ("B", "Anna", ["Ann", "Nan"]), ("B", "Cy", [])], "book string, name string, alias array<string>")
    assert steps.scene_facts(segments, people, chars, model=model).count() == 2
    steps.scene_facts(segments, people, chars, model=model).collect()
    assert {json.loads(x) for x in log.read_text().splitlines()} == {"Anna（别称：Annie）", "Anna（别称：Ann、Nan）"}


def test_lines_that_are_no_single_object_are_rejected(spark, tmp_path):
    from storyloom.sources import readers

    fine = ['{"text":"ok"}', '\t{"text":"tab"}　', '{"a":1,"a":2,"text":"twice"}', '{"text":"a } b"}']
    bad = ['{"text":"ok"} trailing', '{"text": "1"} {"text": "2"}', '{"text":"1"},{"text":"2"}', '{"text":"1"}],[{"text":"2"}', "[1]", '"s"', '{"text":"x"', "null", '{"text":"1"}}']
    (tmp_path / "a.jsonl").write_text("\n".join([*fine, "\t\t", "  ", "　", *bad]))
    good, rejects = readers.read_jsonl(spark, str(tmp_path), "text string")
    assert [r.text for r in good.collect()] == ["ok", "tab", "twice", "a } b"]
    assert sorted(r.line for r in rejects.collect()) == sorted(bad)
