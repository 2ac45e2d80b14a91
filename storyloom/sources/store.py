"""The annotation tables as Parquet that outlives a session: keys, parents and cascades kept by joins, a change of several tables seen at once.

Every change writes new files for the tables it touches and then one small file that names the files of all tables; readers take the newest of
these, so they see all of a change or nothing. One writer at a time. Old files are removed by ``clean``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom import schemas as s
from storyloom.operators.relational import delete_cascade
from storyloom.plans.lineage import _file_system
from storyloom.sources.writers import put

#: columns, what must differ between rows, and parents: (column, table, whether a row goes with its parent)
TABLES: dict[str, tuple[str, list[str], list[tuple[str, str, bool]]]] = {
    "records": (s.RECORD, ["id"], []),
    "annotation_schemas": (s.ANNOTATION_SCHEMA, ["name"], []),
    "schema_fields": (s.SCHEMA_FIELD, ["id"], [("schema_id", "annotation_schemas", True)]),
    "queues": (s.QUEUE, ["name"], [("schema_id", "annotation_schemas", False)]),
    "queue_items": (s.QUEUE_ITEM, ["queue_id", "record_id"], [("queue_id", "queues", True), ("record_id", "records", False)]),
    "annotations": (s.ANNOTATION, ["queue_item_id"], [("queue_item_id", "queue_items", True)]),
    "datasets": (s.DATASET, ["name"], []),
    "dataset_items": (s.DATASET_ITEM, ["dataset_id", "record_id"], [("dataset_id", "datasets", True), ("record_id", "records", False), ("queue_item_id", "queue_items", False)]),
}


class Store:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _states(self) -> list[int]:
        files, p = _file_system(self.spark, f"{self.path}/state")
        return sorted(int(f.getPath().getName()[:-5]) for f in files.listStatus(p) if f.getPath().getName().endswith(".json")) if files.exists(p) else []

    def _state(self) -> dict[str, str]:
        """The folder of each table that has rows."""
        known = self._states()
        if not known:
            return {}
        return json.loads(self.spark.read.text(f"{self.path}/state/{known[-1]}.json", wholetext=True).first()[0])

    def table(self, name: str) -> DataFrame:
        at = self._state().get(name)
        ddl = TABLES[name][0].replace("values string", "`values` string")
        return self.spark.read.schema(ddl).parquet(f"{self.path}/{at}") if at else self.spark.createDataFrame([], ddl)

    def replace(self, **tables: DataFrame) -> None:
        """New contents of some tables, seen together."""
        state, known = self._state(), self._states()
        for name, rows in tables.items():
            want = self.spark.createDataFrame([], TABLES[name][0].replace("values string", "`values` string")).schema
            at = f"{name}/{uuid.uuid4().hex}"
            rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in want]).write.parquet(f"{self.path}/{at}")
            state[name] = at
        number = (known[-1] if known else 0) + 1
        put(self.spark, f"{self.path}/state/{number}.part", json.dumps(state))
        files, part = _file_system(self.spark, f"{self.path}/state/{number}.part")
        if not files.rename(part, _file_system(self.spark, f"{self.path}/state/{number}.json")[1]):
            raise OSError("another writer was faster")

    def insert(self, name: str, rows: DataFrame, order: str) -> tuple[int, int]:
        """(added, skipped): rows whose key is new and whose parents exist; of equal keys the first by ``order``."""
        _, unique, parents = TABLES[name]
        have = self.table(name)
        fit = rows
        for column, parent, _ in parents:
            known = self.table(parent).select(F.col("id").alias(f"_{column}"))
            found = fit.join(known, F.col(column) == F.col(f"_{column}"), "left_semi")
            # a column that may be empty has no parent then
            fit = found.unionByName(fit.where(F.col(column).isNull())) if column == "queue_item_id" and name == "dataset_items" else found
        ranked = fit.groupBy(*unique).agg(F.min_by(F.struct(*fit.columns), F.struct(order, *[c for c in unique if c != order])).alias("r")).select("r.*")
        new = ranked.join(have.select(*unique), unique, "left_anti")
        total, before = rows.count(), have.count()
        self.replace(**{name: have.unionByName(new.select(*[c for c in have.columns if c in new.columns]), allowMissingColumns=True)})
        added = self.table(name).count() - before
        return added, total - added

    def upsert(self, name: str, rows: DataFrame) -> None:
        """Rows take the place of those with their key; other rows stay."""
        unique = TABLES[name][1]
        self.replace(**{name: self.table(name).join(rows.select(*unique), unique, "left_anti").unionByName(rows, allowMissingColumns=True)})

    def delete(self, name: str, ids: DataFrame) -> None:
        """Rows by ``id``, and all rows that go with them. Refused where another row would lose its parent."""
        changed: dict[str, DataFrame] = {name: self.table(name).join(ids.select("id"), "id", "left_anti")}
        todo = [(name, ids.select("id"))]
        while todo:
            parent, gone = todo.pop()
            for child, (_, _, parents) in TABLES.items():
                for column, table, cascade in parents:
                    if table != parent:
                        continue
                    rows = changed.get(child, self.table(child))
                    if not cascade:
                        if child not in changed and not rows.join(gone.select(F.col("id").alias("_id")), F.col(column) == F.col("_id"), "left_semi").isEmpty():
                            raise ValueError(f"rows of {child} refer to what would go")
                        continue
                    todo.append((child, rows.join(gone.select(F.col("id").alias("_id")), F.col(column) == F.col("_id"), "left_semi").select("id")))
                    changed[child] = delete_cascade(rows, gone, "id", column)
        self.replace(**changed)

    def clean(self) -> None:
        """Remove files that the newest state doesn't name."""
        state, known = self._state(), self._states()
        for n in known[:-1]:
            files, p = _file_system(self.spark, f"{self.path}/state/{n}.json")
            files.delete(p, False)
        for name in TABLES:
            files, folder = _file_system(self.spark, f"{self.path}/{name}")
            for f in files.listStatus(folder) if files.exists(folder) else ():
                if f"{name}/{f.getPath().getName()}" != state.get(name):
                    files.delete(f.getPath(), True)
