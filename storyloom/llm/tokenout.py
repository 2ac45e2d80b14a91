"""Operator 7: token ids as ORC, in ascending document order.

Documents are range-partitioned and sorted by id, encoded, and written as ORC: integer run-length encoding for the
ids, row indexes every ``stride`` rows and Bloom filters on ``doc_id``, so that a lookup skips stripes and row groups by metadata and
readers take stripes in parallel. Each file holds one range; ``part`` numbers the ranges in order and
``local_start`` counts ids inside one, so the place of a document in the whole is one sum over the (few) ranges away.

Defined results: null text is empty (the end id alone); null ids come first; repeated rows are all written, ties of
one id in the order of their texts; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm.pretok import encoder
from storyloom.llm.runtime import source
from storyloom.llm.vectext import chunks, record

FILE_DDL = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"
_FILE = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("local_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
_READ = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("local_start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _encode(path: str, end_id: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = encoder(path), TaskContext.get().partitionId(), 0
        for b in chunks(batches):
            ids, count = enc.encode(b.column("text"))
            n = count + 1
            ends = np.cumsum(n)
            out = np.empty(int(ends[-1]), np.int32)
            last = np.zeros(len(out), bool)
            last[ends - 1] = True
            out[last], out[~last] = end_id, ids
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(out))
            yield record(_FILE, doc_id=b.column("doc_id"), part=np.full(len(n), part, np.int32), local_start=at + ends - n, n_tokens=n, ids=lists)
            at += int(ends[-1])

    return emit


#: bytes of input files for one range
RANGE_BYTES = 128 << 20


def ranges(docs: DataFrame) -> int:
    """How many ranges: by the size that the plan states, and no fewer than the session's shuffle partitions."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size if size < 1 << 60 else 0  # rows of an RDD have no size
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(200_000, -(-known // RANGE_BYTES)))


def write_token_ids(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, partitions: int | None = None, stride: int = 2000, stripe_bytes: int = 64 << 20) -> None:
    """Encode and write all rows to ``path``; a range of documents for each ``RANGE_BYTES`` of input, unless ``partitions`` says otherwise."""
    n = partitions or ranges(docs)
    src = source(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    ordered = src.repartitionByRange(n, "doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")
    writer = ordered.mapInArrow(_encode(tokenizer_path, end_id), FILE_DDL).write
    options = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": str(stride), "orc.stripe.size": str(stripe_bytes), "compression": "zstd"}
    writer.options(**options).orc(path)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_DDL).orc(path)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column("ids")
        flat, off = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.asarray(lists.offsets)
        off = off - off[0]
        crc = [zlib.crc32(flat[s:e].tobytes()) for s, e in zip(off[:-1], off[1:], strict=True)]
        yield record(_READ, doc_id=b.column("doc_id"), part=b.column("part"), local_start=b.column("local_start"), n_tokens=np.diff(off).astype(np.int64), ids_crc32=crc)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files."""
    files = read_token_ids(spark, path)
    # one row per range, so as many as the writer had partitions; small enough to broadcast by construction
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    rows = files.mapInArrow(_digest, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long")
    return rows.join(F.broadcast(before), "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
