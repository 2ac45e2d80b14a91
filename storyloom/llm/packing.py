"""Operator 3: sequence packing by Karmarkar-Karp multiway differencing.

Texts are tokenised where they are read. Full windows of ``length`` ids are sequences of their own; the remainder of
each text is cut into pieces of at most ``piece`` ids. A task gathers pieces for up to ``windows`` windows and
differences them: the two partial partitions with the largest imbalance are merged, largest slots with smallest, until
one is left; if a window then exceeds the length, the window count rises by one and the differencing is done again. No shuffle is needed, and a task
holds lengths and checksums of one group only.

``sequence_id`` is the partition number times 2**33 plus a counter, so it is unique and the same when a task is run again.

Defined results: null or empty text is the end id alone; rows with a null id are packed like others; repeated rows
are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.pretok import encoder
from storyloom.llm.runtime import source
from storyloom.llm.vectext import chunks, record

DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_OUT = pa.schema([(x.split()[0], pa.int64()) for x in DDL.split(", ")])


def difference(lengths: list[int], k: int) -> list[list[int]]:
    """Split the items into k slots by multiway differencing; each slot lists item numbers.

    A partial partition is a descending list of (sum, tree of items) without its empty slots.
    """
    heap: list[tuple[int, int, list]] = []
    for i, n in enumerate(lengths):
        heapq.heappush(heap, (-n, i, [(n, i)]))
    if not heap:
        return [[] for _ in range(k)]
    stamp = len(lengths)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        over = len(a) + len(b) - k
        if over <= 0:
            merged = a + b
        else:
            free = len(a) - over
            meet = [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a[free:], reversed(b[len(b) - over :]), strict=True)]
            merged = a[:free] + meet + b[: len(b) - over]
        merged.sort(key=lambda s: -s[0])
        gap = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        stamp += 1
        heapq.heappush(heap, (-gap, stamp, merged))
    slots = []
    for _, tree in heap[0][2]:
        items, todo = [], [tree]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo += x
            else:
                items.append(x)
        slots.append(sorted(items))
    return slots + [[] for _ in range(k - len(slots))]


def windows_for(lengths: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows none of which exceeds the capacity."""
    k = max(1, -(-sum(lengths) // capacity))
    while True:
        slots = difference(lengths, k)
        if all(sum(lengths[i] for i in s) <= capacity for s in slots):
            return [s for s in slots if s]
        k += 1


def _pack(path: str, length: int, piece: int, windows: int, end_id: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        serial = TaskContext.get().partitionId() << 33
        rest: list[tuple] = []
        held = 0

        def flush() -> list[tuple]:
            nonlocal serial, rest, held
            out = []
            for slot in windows_for([r[2] for r in rest], length):
                at = 0
                for i in slot:
                    out.append((*rest[i], serial, at))
                    at += rest[i][2]
                serial += 1
            rest, held = [], 0
            return out

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in _OUT]
            return record(_OUT, **{f.name: list(c) for f, c in zip(_OUT, cols, strict=True)})

        for b in chunks(batches):
            ids, count = enc.encode(b.column("text"))
            edge = np.concatenate([[0], np.cumsum(count)])
            rows: list[tuple] = []
            for i, doc in enumerate(b.column("doc_id").to_pylist()):
                own = np.append(ids[edge[i] : edge[i + 1]], end_id).astype("<u4")
                n = len(own)
                full = n // length * length
                for s in range(0, full, length):
                    rows.append((doc, s, length, zlib.crc32(own[s : s + length].tobytes()), n, serial, 0))
                    serial += 1
                for s in range(full, n, piece):
                    part = own[s : s + piece]
                    rest.append((doc, s, len(part), zlib.crc32(part.tobytes()), n))
                    held += len(part)
                    if held >= windows * length - piece:
                        rows += flush()
            yield batch_of(rows)
        if rest:
            yield batch_of(flush())

    return emit


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 2048, piece: int = 512, windows: int = 96, end_id: int = 1) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    if not 0 < piece <= length:
        raise ValueError("piece must be from 1 to length")
    src = source(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    return src.mapInArrow(_pack(tokenizer_path, length, piece, windows, end_id), DDL)
