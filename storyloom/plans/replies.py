"""Replies that are asked for once: requests by digest, a journal while a job runs, and a table that later runs join first.

``Remembered`` wraps a model. In ``modelcalls.call_rows`` equal requests become one; those that the table has are not asked; each of the others is
asked by one task, which writes its reply to the journal before anything else happens, so a task that is tried again, or a job that is started again, finds
what has been paid for. Behind the job the replies are in the table and the journal is emptied. Direct calls, as the folds make them whose
requests depend on earlier answers, have their replies in files of their own under the same path.

Defined results: null inputs are part of a request like any value; a reply that does not pass ``check`` is given back but not remembered; a model's
error ends the job and loses no other reply. One job at a time may write to a path, without speculative tasks: two that ask at the same moment both pay.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.plans.lineage import cut, new_path, remove
from storyloom.plans.modelcalls import LanguageModel, as_inputs, parse_reply

SCHEMA = "digest string, reply string"


class Journal:
    """A file for each reply, named by its request's digest; whole or not there."""

    def __init__(self, path: str) -> None:
        from storyloom.sources.datasets import _store

        self.store, self.root = _store(path)

    def _path(self, digest: str) -> str:
        return f"{self.root}/{digest[:2]}/{digest}"

    def get(self, digest: str) -> str | None:
        from pyarrow import fs

        path = self._path(digest)
        if self.store.get_file_info(path).type != fs.FileType.File:
            return None
        return json.loads(self.store.open_input_stream(path).read())["reply"]

    def put(self, digest: str, reply: str) -> None:
        path = self._path(digest)
        self.store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with self.store.open_output_stream(f"{path}.part") as out:
            out.write(json.dumps({"reply": reply}).encode())
        self.store.move(f"{path}.part", path)


class Remembered:
    """A model whose replies are kept under ``path``. ``name`` tells models and settings apart; ``check(task, value)`` says which replies are worth keeping."""

    def __init__(self, model: LanguageModel, path: str, name: str = "", check: Callable[[str, Any], bool] | None = None) -> None:
        self.model, self.path, self.check = model, path.rstrip("/"), check
        self.name = name or f"{type(model).__name__} {getattr(model, 'model', '')}".strip()

    def _fine(self, task: str, reply: str) -> bool:
        return self.check is None or self.check(task, parse_reply(reply))

    def ask(self, journal: str, digest: str, task: str, inputs: dict[str, Any]) -> tuple[str, bool]:
        """The reply and whether it is kept: from the journal, or asked and written there."""
        kept = Journal(f"{self.path}/{journal}")
        reply = kept.get(digest)
        if reply is not None:
            return reply, True
        reply = self.model(task, inputs)
        fine = self._fine(task, reply)
        if fine:
            kept.put(digest, reply)
        return reply, fine

    def __call__(self, task: str, inputs: dict[str, Any]) -> str:
        request = json.dumps([self.name, task, inputs], sort_keys=True, ensure_ascii=False, default=list)
        return self.ask("single", hashlib.sha256(request.encode()).hexdigest(), task, inputs)[0]

    def table(self, spark: SparkSession) -> DataFrame:
        """(digest, reply): all that earlier jobs have kept."""
        where = f"{self.path}/replies"
        spark.createDataFrame([], SCHEMA).write.mode("append").parquet(where)
        return spark.read.schema(SCHEMA).parquet(where)

    def rows(self, rows: DataFrame, task: str, inputs: list[str], output: str, parse: list[str] | None) -> DataFrame:
        """``rows`` with their replies. What is not in the table is asked for now."""
        spark, me, decoded = rows.sparkSession, self, set(parse or ())
        request = F.to_json(F.struct(F.lit(self.name).alias("model"), F.lit(task).alias("task"), F.struct(*inputs).alias("inputs")), {"ignoreNullFields": "false"})
        keyed = rows.drop(output).withColumn("_digest", F.sha2(request, 256))
        todo = keyed.select("_digest", *inputs).dropDuplicates(["_digest"]).join(self.table(spark).select(F.col("digest").alias("_digest")), "_digest", "left_anti")

        def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                out = []
                for digest, row in zip(f["_digest"], f[inputs].to_dict("records"), strict=True):
                    reply, fine = me.ask("journal", digest, task, as_inputs(row, decoded))
                    out.append((digest, reply, fine))
                yield pd.DataFrame(out, columns=["digest", "reply", "fine"])

        asked = cut(todo.mapInPandas(ask, f"{SCHEMA}, fine boolean"), "replies", new_path(spark, "replies"))
        asked.where("fine").select("digest", "reply").write.mode("append").parquet(f"{self.path}/replies")
        remove(spark, f"{self.path}/journal")
        known = self.table(spark).dropDuplicates(["digest"]).unionByName(asked.where("not fine").select("digest", "reply"))
        known = known.select(F.col("digest").alias("_known"), F.col("reply").alias(output))
        return keyed.join(known, F.col("_digest") == F.col("_known"), "left").drop("_digest", "_known")
