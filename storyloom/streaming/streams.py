"""Structured Streaming forms: JSON-line intake with resume, ordered state, and sessions with watermarks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from storyloom.sources.datasets import DatasetSource


def read_jsonl_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).json(path)


def drain(stream: DataFrame, path: str, checkpoint: str, fmt: str = "json") -> StreamingQuery:
    """Write all there is and stop. The checkpoint is the resume point: finished input is not read again."""
    return stream.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()


def drain_bounded(spark: SparkSession, path: str, out: str, checkpoint: str, columns: str, most_bytes: int, fmt: str = "parquet", **options: str) -> list[int]:
    """A dataset's stream written trigger by trigger until nothing is left; each takes at most ``most_bytes``. Returns the rows of each trigger.

    A trigger of its own run each: a source that bounds itself is asked once a run. What a run has taken is in the log beside the checkpoint, so a drain that was stopped goes on.
    """
    spark.dataSource.register(DatasetSource)
    taken: list[int] = []
    while True:
        stream = spark.readStream.format(DatasetSource.name()).options(path=path, columns=columns, log=f"{checkpoint}-taken", bytes=str(most_bytes), **options).load()
        run = drain(stream, out, checkpoint, fmt)
        run.awaitTermination()
        rows = [p["numInputRows"] for p in run.recentProgress if p["sources"][0]["startOffset"] != p["sources"][0]["endOffset"]]
        if not rows:
            return taken
        taken += rows


def sessions(events: DataFrame, key: str, ts: str, gap: str = "2 hours", late: str = "10 minutes") -> DataFrame:
    """(key, start, end, n): session windows; they close once the watermark passes them."""
    w = F.session_window(ts, gap)
    grouped = events.withWatermark(ts, late).groupBy(key, w.alias("w")).agg(F.count("*").alias("n"))
    return grouped.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


class StatusFold(StatefulProcessor):
    """The last known value of each field per key, kept in the state store; later updates by the order column win."""

    def __init__(self, key: str, order: str, fields: list[str]) -> None:
        self.key, self.order, self.fields = key, order, fields

    def init(self, handle: StatefulProcessorHandle) -> None:
        cols = [T.StructField(f"at_{f}", T.LongType()) for f in self.fields] + [T.StructField(f, T.StringType()) for f in self.fields]
        self.state = handle.getValueState("status", T.StructType(cols))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        n = len(self.fields)
        cur = list(self.state.get()) if self.state.exists() else [None] * (2 * n)
        for pdf in rows:
            for i, f in enumerate(self.fields):
                known = pdf[pdf[f].notna()]
                if len(known):
                    last = known.loc[known[self.order].idxmax()]
                    if cur[i] is None or last[self.order] >= cur[i]:
                        cur[i], cur[n + i] = int(last[self.order]), str(last[f])
        self.state.update(tuple(cur))
        yield pd.DataFrame({self.key: [key[0]], **{f: [cur[n + i]] for i, f in enumerate(self.fields)}})

    def close(self) -> None:
        pass


def status_stream(blocks: DataFrame, key: str, order: str, fields: list[str]) -> DataFrame:
    """The state of each key after every trigger (update mode). Needs the RocksDB state store."""
    kinds = dict(blocks.dtypes)
    schema = f"{key} {kinds[key]}, " + ", ".join(f"{f} string" for f in fields)
    return blocks.groupBy(key).transformWithStateInPandas(statefulProcessor=StatusFold(key, order, fields), outputStructType=schema, outputMode="Update", timeMode="None")


def progress(query: StreamingQuery) -> dict[str, Any]:
    """Stage, rows and message of a query's last trigger."""
    last = query.lastProgress or {}
    return {"stage": "processing" if query.isActive else "done", "progress": last.get("numInputRows", 0), "batch": last.get("batchId", -1), "message": query.status["message"]}
