"""Named output files: names, order, modes, and what failed tasks and jobs leave."""

import os
import subprocess
import sys
import textwrap
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from storyloom.sources import named


def files(path):
    return {str(p.relative_to(path)): p.read_text() for p in Path(path).rglob("*") if p.is_file() and not p.name.startswith(".")}


def rows(spark, data):
    return spark.createDataFrame(data, "file string, value string, at int")


def test_rows_of_a_file_in_order_whatever_the_partitions(spark, tmp_path):
    data = [(f"b{i % 3}/x {i % 7}.txt", f"line {i}", i) for i in range(500)]
    named.write_named(rows(spark, data).repartition(9), str(tmp_path), "file", order=["at"])
    want = {}
    for f, v, _ in data:
        want[f] = want.get(f, "") + v + "\n"
    assert files(tmp_path) == want


def test_values_and_ends(spark, tmp_path):
    data = [("a", None, 0), ("a", "x\ny", 1), ("b", "", 0), ("c", None, 0), ("é/ü.md", "ß", 0)]
    named.write_named(rows(spark, data), str(tmp_path), "file", order=["at"], between="|", end="")
    assert files(tmp_path) == {"a": "|x\ny", "b": "", "c": "", "é/ü.md": "ß"}


def test_no_rows_give_no_files(spark, tmp_path):
    named.write_named(rows(spark, []), str(tmp_path / "x"), "file")
    assert files(tmp_path) == {}


@pytest.mark.parametrize("name", [None, "", "/etc/x", "a/../b", "a//b", ".", "_attempts/x"])
def test_names_that_leave_the_folder_are_refused(spark, tmp_path, name):
    (tmp_path / "old").write_text("old")
    with pytest.raises(Exception, match="no name for a file"):
        named.write_named(rows(spark, [("fine", "x", 0), (name, "y", 0)]), str(tmp_path), "file", mode="overwrite")
    assert files(tmp_path) == {"old": "old"} and not (tmp_path / "_attempts").exists()


def test_modes(spark, tmp_path):
    write = lambda data, **o: named.write_named(rows(spark, data), str(tmp_path), "file", end="", **o)
    write([("a", "1", 0), ("d/b", "1", 0)])
    write([("a", "2", 0), ("c", "2", 0)], exists="skip")
    assert files(tmp_path) == {"a": "1", "d/b": "1", "c": "2"}
    write([("a", "3", 0)])
    assert files(tmp_path) == {"a": "3", "d/b": "1", "c": "2"}
    write([("z", "4", 0)], mode="overwrite")
    assert files(tmp_path) == {"z": "4"}


def test_a_file_of_two_tasks_is_refused(spark, tmp_path):
    spark.dataSource.register(named.NamedFiles)
    parts = spark.range(4).repartition(4).select(F.lit("one").alias("file"), F.col("id").cast("string").alias("value"))
    assert parts.rdd.getNumPartitions() == 4
    with pytest.raises(Exception, match="several tasks have written"):
        parts.repartition(4, "value").write.format(named.FORMAT).mode("append").option("path", str(tmp_path)).save()
    assert files(tmp_path) == {}


def test_a_file_larger_than_a_batch_is_streamed(spark, tmp_path):
    big = spark.range(60_000).select(F.lit("big").alias("file"), F.col("id").cast("string").alias("value"), F.col("id").alias("at"))
    named.write_named(big.repartition(5), str(tmp_path), "file", order=["at"])
    assert files(tmp_path)["big"].split() == [str(i) for i in range(60_000)]


def test_train_files_are_even(spark, tmp_path):
    named.write_train_files(spark.range(1000).repartition(3), str(tmp_path), files=4)
    sizes = spark.read.parquet(str(tmp_path)).groupBy(F.col("_metadata.file_name").alias("f")).count().collect()
    assert {r.f for r in sizes} == {f"train-{i:05d}-of-00004.parquet" for i in range(4)} and sum(r["count"] for r in sizes) == 1000
    assert all(200 <= r["count"] <= 300 for r in sizes)


def test_listing(spark, tmp_path):
    named.write_texts(spark.createDataFrame([("a/b.txt", "été"), ("c.md", "x")], "file string, text string"), f"file://{tmp_path}")
    assert sorted(map(tuple, named.written(spark, f"file://{tmp_path}").collect())) == [("a/b.txt", 5), ("c.md", 1)]


_FAILS_ONCE = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from storyloom.sources import named
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.execution.arrow.maxRecordsPerBatch", "10").getOrCreate()
write, most = named._Sink.lines, int(sys.argv[2])
def fails(self, values):
    write(self, values)
    if TaskContext.get().attemptNumber() < most and len(self.names) == 3:
        self.out.close()
        raise RuntimeError("lost")
named._Sink.lines = fails
rows = spark.range(400).selectExpr("concat('f', id % 20) as file", "cast(id as string) as value", "id as at")
rows.sparkSession.dataSource.register(named.NamedFiles)
from pyspark import cloudpickle as own
own.register_pickle_by_value(named)
named.write_named(rows, sys.argv[1], "file", order=["at"])
"""


@pytest.mark.parametrize(("failures", "fine"), [(1, True), (9, False)])
def test_tasks_that_fail_leave_no_half_file(tmp_path, failures, fine):
    script = tmp_path / "job.py"
    script.write_text(textwrap.dedent(_FAILS_ONCE))
    out = tmp_path / "out"
    out.mkdir()
    env = os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    run = subprocess.run([sys.executable, str(script), str(out), str(failures)], env=env, capture_output=True, text=True, timeout=240)
    assert (run.returncode == 0) is fine, run.stderr[-3000:]
    want = {f"f{k}": "".join(f"{i}\n" for i in range(k, 400, 20)) for k in range(20)} if fine else {}
    assert files(out) == want and [p.name for p in out.iterdir() if p.is_dir()] == []
    if fine:
        assert "lost" in run.stderr


def test_columns_of_clashing_names(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "own", "x", 5), (2, "b", "own", "y", 4)], "id int, value string, file string, _file string, _order0 int")
    named.write_named(rows, str(tmp_path), F.concat("value", F.lit(".parquet")), None, ["id"])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path)).select("id", "value", "_file").collect())) == [(1, "a", "x"), (2, "b", "y")]


def test_the_driver_lists_no_files_that_are_written_and_read(spark, tmp_path):
    from storyloom.queries import outputs

    for name in ("numbered_files", "scene_files", "segment_files"):
        got = getattr(outputs, name)(spark, "/root/testdata/sf0.001")
        assert not [f for f in got.inputFiles() if f.endswith((".txt", ".json"))]


def test_files_are_read_whole_with_spark_rules_for_names(spark, tmp_path):
    data = [("a/é 1+%.txt", "x\ny\r\n"), ("a/b.json", "{}"), ("_hidden.txt", "no"), (".dot.txt", "no"), ("top.txt", ""), ("_k=1/in.txt", "part")]
    named.write_texts(spark.createDataFrame(data, "file string, text string"), f"file://{tmp_path}")
    got = sorted(map(tuple, named.read_files(spark, f"file://{tmp_path}", ".txt").collect()))
    assert got == [("_k=1/in.txt", "part"), ("a/é 1+%.txt", "x\ny\r\n"), ("top.txt", "")]


@pytest.mark.parametrize("kind", ["text", "parquet"])
def test_one_file_is_many_tasks_work(spark, tmp_path, monkeypatch, kind):
    """A spread file is written in pieces, none of which holds half of it, and reads like one that a task has written; a second, smaller one lies beside it."""
    folders, assemble = [], named._Writer._assemble
    monkeypatch.setattr(named._Writer, "_assemble", lambda self, s, f: folders.extend((p.stat().st_size for x in f for p in Path(x).iterdir() if p.name.isdigit())) or assemble(self, s, f))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(20_000).repartition(7).select(F.when(F.col("id") % 10 == 3, "b/x").otherwise("a").alias("name"), "id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("é "), F.md5(F.col("id").cast("string")))).alias("value"), F.array("id", F.lit(None)).alias("list"))
    try:
        for spread in (False, True):
            named.write_named(rows, f"file://{tmp_path}/{spread}", "name", None if kind == "parquet" else "value", ["id"], spread=spread)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(folders) >= 3 and max(folders) < sum(folders) / 2
    for name in ("a", "b/x"):
        one, many = (tmp_path / str(s) / name for s in (False, True))
        if kind == "text":
            assert one.read_bytes() == many.read_bytes()
        else:
            assert pq.read_table(one).equals(pq.read_table(many)) and pq.ParquetFile(many).num_row_groups > (name == "a")
            got = spark.read.parquet(f"file://{many}").select("id", "value", F.col("_metadata.row_index").alias("n")).orderBy("n").collect()
            assert [r.n for r in got] == list(range(len(got))) and [r.id for r in got] == sorted(r.id for r in got)
    assert sorted(p.name for p in (tmp_path / "True").iterdir()) == ["a", "b"]


def test_a_spread_file_keeps_the_modes(spark, tmp_path):
    path = f"file://{tmp_path}/set"
    for n, options in ((3, {}), (5, {"exists": "skip"}), (4, {"mode": "append"})):
        named.write_named(spark.range(n).select(F.lit("f").alias("name"), F.col("id").cast("string").alias("value")), path, "name", order=["value"], spread=True, **options)
        assert (tmp_path / "set/f").read_text().split() == [str(i) for i in range(4 if n == 4 else 3)]
    named.write_named(spark.range(0).select(F.lit("f").alias("name"), F.col("id").cast("string").alias("value")), path, "name", mode="overwrite", spread=True)
    assert not (tmp_path / "set/f").exists()
