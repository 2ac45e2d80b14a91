"""The annotation tables on disk: keys, parents, cascades, and changes seen at once."""

import pytest

from storyloom.sources.store import TABLES, Store


@pytest.fixture
def store(spark, tmp_path):
    st = Store(spark, f"file://{tmp_path}/store")
    st.insert("records", spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r1", "again"), ("r3", "c")], "id string, name string"), "name")
    st.insert("annotation_schemas", spark.createDataFrame([(1, "s")], "id long, name string"), "id")
    st.insert("schema_fields", spark.createDataFrame([(1, 1, "f", "F", "text"), (2, 9, "g", "G", "text")], "id long, schema_id long, name string, label string, type string"), "id")
    st.insert("queues", spark.createDataFrame([(1, "q", 1), (2, "q", 1)], "id long, name string, schema_id long"), "id")
    st.insert("queue_items", spark.createDataFrame([(1, 1, "r1"), (2, 1, "r2"), (3, 1, "r1"), (4, 1, "r9"), (5, 7, "r1")], "id long, queue_id long, record_id string"), "id")
    st.insert("annotations", spark.createDataFrame([(1, 1, "{}")], "id long, queue_item_id long, `values` string"), "id")
    st.insert("datasets", spark.createDataFrame([(1, "d")], "id long, name string"), "id")
    st.insert("dataset_items", spark.createDataFrame([(1, 1, "r3", "direct", None), (2, 1, "r2", "queue", 2), (3, 1, "r1", "queue", 77)], "id long, dataset_id long, record_id string, source string, queue_item_id long"), "id")
    return st


def ids(store, name):
    return sorted(r.id for r in store.table(name).collect())


def test_rows_outlive_the_session_and_keep_their_keys(spark, store):
    again = Store(spark.newSession(), store.path)
    assert {n: len(ids(again, n)) for n in TABLES} == {"records": 3, "annotation_schemas": 1, "schema_fields": 1, "queues": 1, "queue_items": 2, "annotations": 1, "datasets": 1, "dataset_items": 2}
    assert {r.id: r.name for r in store.table("records").collect()} == {"r1": "a", "r2": "b", "r3": "c"}
    assert store.insert("records", spark.createDataFrame([("r3", "x"), ("r4", "y"), ("r4", "z")], "id string, name string"), "name") == (1, 2)


def test_upsert_and_cascade(spark, store):
    store.upsert("annotations", spark.createDataFrame([(9, 1, '{"x": 1}'), (10, 2, "{}")], "id long, queue_item_id long, `values` string"))
    assert ids(store, "annotations") == [9, 10]
    with pytest.raises(ValueError, match="dataset_items refer"):
        store.delete("queues", spark.createDataFrame([(1,)], "id long"))
    assert ids(store, "queue_items") == [1, 2]
    store.delete("datasets", spark.createDataFrame([(1,)], "id long"))
    store.delete("queues", spark.createDataFrame([(1,)], "id long"))
    assert [ids(store, n) for n in ("queues", "queue_items", "annotations", "dataset_items", "records")] == [[], [], [], [], ["r1", "r2", "r3"]]


def test_a_reader_sees_whole_changes_only(spark, store, tmp_path):
    before = store._states()
    (tmp_path / "store/state" / f"{before[-1] + 1}.part").write_text('{"records": "nowhere"}')  # a writer that died
    assert ids(store, "records") == ["r1", "r2", "r3"]
    store.clean()
    assert len(store._states()) == 1 and ids(store, "dataset_items") == [1, 2]
    assert len(list((tmp_path / "store/records").iterdir())) == 1
