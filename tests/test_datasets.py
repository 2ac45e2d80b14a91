"""The streaming dataset source: late names, byte bounds, restarts and changed files."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from storyloom.sources import datasets
from storyloom.streaming import streams


def put(folder, name, ids, group=50):
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"id": pa.array(ids, pa.int64()), "note": [f"row {i}" * 5 for i in ids]}), folder / f".{name}", row_group_size=group)
    os.rename(folder / f".{name}", folder / name)


def drained(spark, tmp_path, **options):
    spark.dataSource.register(datasets.DatasetSource)
    stream = spark.readStream.format("storyloom_dataset").options(path=str(tmp_path / "in"), columns="id bigint", **options).load()
    run = streams.drain(stream, str(tmp_path / "out"), str(tmp_path / "mark"), "parquet")
    run.awaitTermination()
    return sorted(r.id for r in spark.read.schema("id long").parquet(str(tmp_path / "out")).collect())


@pytest.mark.parametrize("log", [False, True])
def test_files_whose_names_sort_earlier_are_read_once(spark, tmp_path, log):
    options = {"log": str(tmp_path / "log")} if log else {}
    put(tmp_path / "in", "m.parquet", range(100))
    put(tmp_path / "in", "p.parquet", range(100, 200))
    assert drained(spark, tmp_path, **options) == list(range(200))
    put(tmp_path / "in", "a.parquet", range(200, 300))
    put(tmp_path / "in/z", "b.parquet", range(300, 310))
    assert drained(spark, tmp_path, **options) == list(range(310))
    assert drained(spark, tmp_path, **options) == list(range(310))


@pytest.mark.parametrize("log", [False, True])
def test_a_changed_file_is_refused(spark, tmp_path, log):
    options = {"log": str(tmp_path / "log")} if log else {}
    put(tmp_path / "in", "m.parquet", range(100))
    drained(spark, tmp_path, **options)
    put(tmp_path / "in", "m.parquet", range(1000))
    put(tmp_path / "in", "n.parquet", range(5))
    with pytest.raises(Exception, match="has changed"):
        drained(spark, tmp_path, **options)


def test_triggers_take_no_more_bytes_than_asked(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.parquet", range(1000), group=100)
    put(folder, "b.parquet", range(1000, 1030))
    put(folder, "c.parquet", range(1030, 3030), group=2000)  # one row group, over the bound
    put(folder, "d.parquet", [])
    options = {"path": str(folder)}
    bound = 3 * max(datasets._groups(options, str(folder / "a.parquet")))
    assert datasets._groups(options, str(folder / "c.parquet"))[0] > bound
    rows = streams.drain_bounded(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "mark"), "id bigint", bound)
    got = sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == list(range(3030))
    assert 2000 in rows and all(n <= 330 for n in rows if n != 2000) and len(rows) >= 5
    # each number of the log stays within the bound, but for the row group that is alone
    log = datasets.TakenLog(str(tmp_path / "mark-taken"))
    for n in range(1, log.last + 1):
        size = sum(e["size"] if e["groups"] is None else sum(datasets._groups(options, e["file"])[g] for g in e["groups"]) for e in log.between(n - 1, n))
        assert size <= bound or [e["groups"] for e in log.between(n - 1, n)] == [[0]]
    put(folder, "0.parquet", range(3030, 3040))
    assert streams.drain_bounded(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "mark"), "id bigint", bound) == [10]


def test_a_stream_killed_between_log_and_offset_loses_nothing(spark, tmp_path):
    put(tmp_path / "in", "m.parquet", range(100))
    options = {"log": str(tmp_path / "log")}
    drained(spark, tmp_path, **options)
    put(tmp_path / "in", "a.parquet", range(100, 150))
    # the log knows a number that Spark has not been told
    reader = datasets._LogReader(None, {"path": str(tmp_path / "in"), **options})
    assert reader.latestOffset() == {"number": 2}
    put(tmp_path / "in", "b.parquet", range(150, 160))
    assert drained(spark, tmp_path, **options) == list(range(160))


def test_a_folded_log_says_the_same(tmp_path, monkeypatch):
    monkeypatch.setattr(datasets, "COMPACT", 4)
    log = datasets.TakenLog(str(tmp_path / "log"))
    for i in range(11):
        log.add([{"file": f"f{i}", "size": i, "groups": None}, {"file": "big", "size": 99, "groups": [i], "next": i + 1 if i < 10 else None}])
    again = datasets.TakenLog(str(tmp_path / "log"))
    assert (again.last, again.sizes, again.open) == (log.last, log.sizes, log.open) == (11, {"big": 99, **{f"f{i}": i for i in range(11)}}, {})
    assert len(list((tmp_path / "log").iterdir())) < 8
    assert [e["file"] for e in again.between(10, 11)] == ["f10", "big"]


def test_large_files_are_read_by_row_groups(spark, tmp_path, monkeypatch):
    put(tmp_path / "in", "a.parquet", range(1000), group=100)
    monkeypatch.setattr(datasets, "SPLIT", 2000)
    parts = datasets._BatchReader(None, {"path": str(tmp_path / "in")}).partitions()
    assert len(parts) > 1 and sorted(g for p in parts for g in p.groups) == list(range(10))


def test_a_bound_needs_a_log(spark, tmp_path):
    with pytest.raises(Exception, match="needs a log"):
        drained(spark, tmp_path, bytes="10")
