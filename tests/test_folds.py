"""Streamed folds: three parts, restarts, snapshots taken back and begun from."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from storyloom.operators import state
from storyloom.streaming import folds, streams

BLOCKS = "pos long, story long, character string, target string, opinion string, new_event string, item_name string, action string, new_state string, mood string"


@pytest.fixture(scope="module", autouse=True)
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, folds.ROCKSDB)
    yield
    spark.conf.set(key, before) if before else spark.conf.unset(key)


def blocks(n=400, seed=1):
    rng, out = random.Random(seed), []
    for i in range(n):
        pick = lambda *x: rng.choice(x)
        out.append((i, pick(0, 1, 1, 1), pick("Ann", "Bo", "", None), pick("Cy", "Di", "", None), pick("fond", "cold", "", None), pick(f"e{i}", "", None), pick("key", "map", ""), pick("add", "remove", "modify", "modify", "lose", None), pick("new", "old", "", None), pick("calm", "angry", None)))
    return out


def key(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def parts_of(spark, rows, folder, order):
    """Each part as a folder of files that come one after the other."""
    for i in order:
        spark.createDataFrame(rows[i::3], BLOCKS).write.mode("append").json(folder)
        yield


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_relationships_in_three_parts(spark, tmp_path, order):
    rows, mark, source = blocks(), f"{tmp_path}/mark", f"{tmp_path}/in"
    for _ in parts_of(spark, rows, source, order):
        stream = folds.relationship_stream(streams.read_jsonl_stream(spark, source, BLOCKS), ["story"], "pos")
        folds.drain(stream, mark).awaitTermination()
    got = folds.relationships(folds.relationships_of(spark, mark, ["story"]))
    want = state.relationship_fold(spark.createDataFrame(rows, BLOCKS), ["story"], "pos")
    cols = ["story", "character", "target", "opinion", "events"]
    assert key(got.select(*cols)) == key(want.select(*cols))


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_items_in_three_parts(spark, tmp_path, order):
    rows, mark, source = blocks(seed=2), f"{tmp_path}/mark", f"{tmp_path}/in"
    for _ in parts_of(spark, rows, source, order):
        folds.drain(folds.item_stream(streams.read_jsonl_stream(spark, source, BLOCKS), ["story"], "pos"), mark).awaitTermination()
    got = folds.items(folds.items_of(spark, mark, ["story"]), ["story"])
    assert key(got) == key(state.item_fold(spark.createDataFrame(rows, BLOCKS), ["story"], "pos"))


def test_a_stream_begins_from_a_batch_fold_and_from_a_snapshot(spark, tmp_path):
    rows = blocks(seed=3)
    early, late = spark.createDataFrame(rows[:200], BLOCKS), spark.createDataFrame(rows[200:], BLOCKS)
    late.write.json(f"{tmp_path}/in")
    read = lambda: streams.read_jsonl_stream(spark, f"{tmp_path}/in", BLOCKS)
    whole = spark.createDataFrame(rows, BLOCKS)
    cols = ["story", "character", "target", "opinion", "events"]

    begun = folds.from_relationships(state.relationship_fold(early, ["story"], "pos"))
    folds.drain(folds.relationship_stream(read(), ["story"], "pos", begun), f"{tmp_path}/a").awaitTermination()
    got = folds.relationships(folds.relationships_of(spark, f"{tmp_path}/a", ["story"]))
    assert key(got.select(*cols)) == key(state.relationship_fold(whole, ["story"], "pos").select(*cols))

    held = folds.from_items(state.item_fold(early, ["story"], "pos"))
    folds.drain(folds.item_stream(read(), ["story"], "pos", held), f"{tmp_path}/b").awaitTermination()
    assert key(folds.items(folds.items_of(spark, f"{tmp_path}/b", ["story"]), ["story"])) == key(state.item_fold(whole, ["story"], "pos"))

    # a snapshot of one query is where another begins
    early.write.json(f"{tmp_path}/early")
    folds.drain(folds.item_stream(streams.read_jsonl_stream(spark, f"{tmp_path}/early", BLOCKS), ["story"], "pos"), f"{tmp_path}/c").awaitTermination()
    folds.drain(folds.item_stream(read(), ["story"], "pos", folds.items_of(spark, f"{tmp_path}/c", ["story"])), f"{tmp_path}/d").awaitTermination()
    assert key(folds.items(folds.items_of(spark, f"{tmp_path}/d", ["story"]), ["story"])) == key(state.item_fold(whole, ["story"], "pos"))


def test_statuses_in_three_parts(spark, tmp_path):
    rows, mark, source = blocks(seed=4), f"{tmp_path}/mark", f"{tmp_path}/in"
    for _ in parts_of(spark, rows, source, (1, 2, 0)):
        stream = streams.status_stream(streams.read_jsonl_stream(spark, source, BLOCKS), "story", "pos", ["mood", "opinion"])
        stream.writeStream.format("noop").option("checkpointLocation", mark).trigger(availableNow=True).outputMode("update").start().awaitTermination()
    got = spark.read.format("statestore").option("path", mark).option("stateVarName", "status").load()
    want = state.status_fold(spark.createDataFrame(rows, BLOCKS), ["story"], "pos", ["mood", "opinion"])
    assert key(got.select(F.col("key.story"), "value.mood", "value.opinion")) == key(want)


def test_a_pair_of_which_nothing_is_said_is_kept(spark, tmp_path):
    said = [(0, 1, "Ann", "Cy", None, "", None, None, None, None), (1, 1, "Bo", "Cy", "", None, None, None, None, None), (2, 1, "Ann", "Di", "fond", "e", None, None, None, None)]
    later = [(3, 1, "Bo", "Cy", "cold", "f", None, None, None, None), (-5, 2, "Ann", "Cy", None, None, None, None, None, None)]
    mark, source, cols = f"{tmp_path}/mark", f"{tmp_path}/in", ["story", "character", "target", "opinion", "events"]
    for rows in (said, later):
        spark.createDataFrame(rows, BLOCKS).write.mode("append").json(source)
        folds.drain(folds.relationship_stream(streams.read_jsonl_stream(spark, source, BLOCKS), ["story"], "pos"), mark).awaitTermination()
    snapshot = folds.relationships_of(spark, mark, ["story"])
    want = state.relationship_fold(spark.createDataFrame([*said, *later], BLOCKS), ["story"], "pos")
    assert key(folds.relationships(snapshot).select(*cols)) == key(want.select(*cols))
    assert snapshot.where("opinion is null and opinion_at is null").count() == 2

    # and so is one with which a stream begins
    folds.drain(folds.relationship_stream(streams.read_jsonl_stream(spark, source, BLOCKS), ["story"], "pos", folds.from_relationships(spark.createDataFrame([(9, "Ed", "Fay", None, [])], "story long, character string, target string, opinion string, events array<string>"))), f"{tmp_path}/b").awaitTermination()
    begun = folds.relationships(folds.relationships_of(spark, f"{tmp_path}/b", ["story"])).where("story = 9").select(*cols).collect()
    assert [tuple(r) for r in begun] == [(9, "Ed", "Fay", None, [])]


def test_an_item_is_read_and_written_once_a_trigger():
    class Value:
        def __init__(self):
            self.now, self.calls = None, []

        def get(self):
            self.calls.append("get")
            return self.now

        def update(self, v):
            self.calls.append("update")
            self.now = v

    held = Value()
    item = folds.ItemState(["story", "character", "item_name"], "pos")
    item.init(type("Handle", (), {"getValueState": lambda self, *a: held})())
    rows = [Row(pos=i, action=a, new_state=n) for i, a, n in ((5, "add", "x"), (9, "modify", "y"), (7, "remove", None), (9, "modify", "y"), (8, "add", "z"), (None, "add", "w"))]
    assert [tuple(r) for r in item.handleInputRows((1, "c", "key"), iter(rows), None)] == [(1, "c", "key", True, "y")]
    assert held.calls == ["get", "update"] and held.now == (7, [8, 9], ["add", "modify"], ["z", "y"])
    assert [tuple(r) for r in item.handleInputRows((1, "c", "key"), iter([Row(pos=8, action="remove", new_state=None)]), None)] == [(1, "c", "key", True, "y")]
    assert held.calls == ["get", "update"] * 2 and held.now == (8, [9], ["modify"], ["y"])
