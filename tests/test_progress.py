"""Events of batch stages and streams, and masks of replies."""

import random
import time

import pytest

from storyloom import registry
from storyloom.operators import masks
from storyloom.plans import steps
from storyloom.plans.progress import Progress
from storyloom.streaming import streams

DATA = "/root/testdata/sf0.001"


def test_events_of_the_story_pipeline(spark):
    told = []
    progress = Progress(spark, told.append)
    texts = spark.createDataFrame([("b", "Anna went home.\n“Hello,” said Anna.\n# two\nPeter stayed.\n“Bye,” said Peter.")], "book string, text string")
    steps.run_story_pipeline(spark, texts, progress=progress)
    order = list(dict.fromkeys(e["stage"] for e in told))
    assert order == ["1_1", "1_2", "1_3", "1_4", "1_5", "2_1", "2_2"]
    for stage in order:
        own = [e for e in told if e["stage"] == stage]
        assert own[0]["message"] == "started" and own[-1]["message"] == "done" and own[-1]["done"] == own[-1]["total"] > 0
        assert all(a["done"] <= a["total"] for a in own)
    rows = progress.rows().orderBy("n").collect()
    assert [(r.stage, r.done, r.total, r.message) for r in rows] == [(e["stage"], e["done"], e["total"], e["message"]) for e in told]


def test_a_stage_that_fails_says_so_and_others_run_while_it_does(spark):
    progress = Progress(spark, pause=0.05)
    with pytest.raises(ZeroDivisionError), progress.stage("bad"):
        raise ZeroDivisionError
    with progress.stage("slow"):
        spark.range(8).repartition(8).rdd.map(lambda r: time.sleep(0.4) or r).count()
    assert [e["message"] for e in progress.events[:2]] == ["started", "failed: ZeroDivisionError"]
    assert any(e["message"] == "running" and e["done"] < e["total"] for e in progress.events)


def test_events_of_a_stream(spark, tmp_path):
    spark.range(100).repartition(4).write.json(f"{tmp_path}/in")
    progress = Progress(spark)
    with progress.streams():
        stream = streams.read_jsonl_stream(spark, f"{tmp_path}/in", "id long", files_per_trigger=1)
        stream.writeStream.queryName("numbers").format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/mark").trigger(availableNow=True).start().awaitTermination()
    own = [e for e in progress.events if e["stage"] == "numbers"]
    assert own[0]["message"] == "started" and own[-1] == {"stage": "numbers", "done": 100, "total": 100, "message": "done"}
    assert len([e for e in own if e["message"].startswith("trigger")]) == 4


def plain_mask(text, offsets):
    """A character is a reply's if the last mark before it opens a reply."""
    inside, state, i = [], 0, 0
    while i < len(text):
        mark = next((m for m in (masks.REQUEST, masks.REPLY) if text.startswith(m, i) and not (state and m == masks.REPLY)), None)
        if mark:
            state = int(mark == masks.REPLY)
            inside += [0] * len(mark)
            i += len(mark)
        else:
            inside.append(state)
            i += 1
    return [int(s < e and all(inside[s:e])) for s, e in offsets]


def test_masks_of_replies(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {}
    for r in registry.queries()["reply_masks"](spark, DATA).collect():
        got.setdefault(r.conv_id, []).append((r.at, r.token, r.mask))
    texts = {r.conv_id: r.text for r in registry.queries()["chatml_render"](spark, DATA).collect()}
    assert set(got) == {c for c, t in texts.items() if t}
    for conv, text in texts.items():
        found = tokenizer.encode(text, add_special_tokens=False)
        assert sorted(got[conv]) == list(zip(range(len(found.ids)), found.ids, plain_mask(text, found.offsets), strict=True))
    assert any(m for rows in got.values() for *_, m in rows)


def test_spans_of_odd_texts():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice([masks.REQUEST, masks.REPLY, "<|im_end|>\n", "word ", "é", "<|im_start|>system\n"]) for _ in range(rng.randint(0, 12)))
        offsets = [(i, i + 1) for i in range(len(text))]
        assert masks.token_mask(offsets, masks.reply_spans(text)) == plain_mask(text, offsets)
