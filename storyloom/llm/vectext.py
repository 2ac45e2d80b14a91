"""Vectorised word splitting and hashing over the flat UTF-8 buffer of an Arrow text column.

Words are ``[^\\x20\\x09-\\x0D]+`` throughout. Hashes are 64-bit polynomial sums over a random byte table,
finished by a bijective mixer, so equal words or word sequences have equal hashes in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: text handled at once; a longer text is a chunk of its own
CHUNK_BYTES = 256 << 10
#: entries of the tables of low and high powers; together they reach every place in an Arrow string
BLOCK, HIGH = 1 << 14, 1 << 17
U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser; a bijection on 64-bit words."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, step: int, n: int) -> np.ndarray:
    p = np.full(n, pow(base, step, 1 << 64), U)
    p[0] = 1
    return np.multiply.accumulate(p)


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit words."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


class Poly:
    """Hashes of all slices of a sequence from one prefix sum, modulo 2**64.

    Powers come from two tables of fixed size, for the low and the high bits of a place, so nothing kept grows with a text.
    """

    def __init__(self, seed: int) -> None:
        base = int(stream(seed, 1)[0]) | 1
        inverse = pow(base, -1, 1 << 64)
        self.up, self.down = _powers(base, 1, BLOCK), _powers(inverse, 1, BLOCK)
        self.up_high, self.down_high = _powers(base, BLOCK, HIGH), _powers(inverse, BLOCK, HIGH)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Sums before each place (and the whole) of values times powers."""
        out = np.zeros(len(values) + 1, U)
        for s in range(0, len(values), BLOCK):
            part = values[s : s + BLOCK]
            np.cumsum(part * (self.up[: len(part)] * self.up_high[s // BLOCK]), out=out[s + 1 : s + 1 + len(part)])
            out[s + 1 : s + 1 + len(part)] += out[s]
        return out

    def finish(self, before: np.ndarray, after: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of slices from the sums before their start and their end."""
        return mix((after - before) * (self.down[start & (BLOCK - 1)] * self.down_high[start // BLOCK]) + (end - start).astype(U) * U(0xD6E8FEB86659FD93))

    def slices(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.finish(prefix[start], prefix[end], start, end)

    def slices_of(self, table: np.ndarray, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """``slices`` over ``table[codes]`` for ascending, disjoint slices, one block of codes in memory at a time."""
        before, after, total = np.empty(len(start), U), np.empty(len(end), U), U(0)
        sums = np.zeros(BLOCK + 1, U)
        for s in range(0, len(codes), BLOCK):
            part = table[codes[s : s + BLOCK]]
            n = len(part)
            np.cumsum(part * (self.up[:n] * self.up_high[s // BLOCK]), out=sums[1 : n + 1])
            sums[1 : n + 1] += total
            sums[0] = total
            for at, out in ((start, before), (end, after)):
                lo, hi = np.searchsorted(at, (s, s + n + (s + n == len(codes))))
                out[lo:hi] = sums[at[lo:hi] - s]
            total = sums[n]
        return self.finish(before, after, start, end)


BYTES = stream(11, 256)
WORD = Poly(21)
GRAM = Poly(31)
GRAM2 = Poly(41)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its offsets from 0; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw, off - off[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``most`` bytes of text each (a longer text is alone)."""
    for batch in batches:
        _, off = flat(batch.column(text))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


class Words:
    """Words of a batch: byte ``start`` and ``end``, their ``doc`` row, 64-bit ``hash``, and ``first`` word of each row."""

    def __init__(self, column: pa.Array, lower: bool = False) -> None:
        buf, off = flat(column)
        if lower:
            buf = LOWER[buf]
        n = len(buf)
        solid = np.zeros(n + 2, bool)
        solid[1:-1] = ~SPACE[buf]
        edge = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < n)]
        opens = solid[1:-1] & ~solid[:-2]
        opens[edge] = solid[1:-1][edge]
        closes = solid[1:-1] & ~solid[2:]
        closes[edge - 1] = solid[1:-1][edge - 1]
        self.buf, self.offsets = buf, off
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(off) - 1), self.count)
        self.hash = WORD.slices_of(BYTES, buf, self.start, self.end)

    def grams(self, n: int, poly: Poly = GRAM) -> tuple[np.ndarray, np.ndarray]:
        """Start word and hash of each run of n words inside one row."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        at = np.flatnonzero(self.doc[:m] == self.doc[n - 1 :])
        pre = poly.prefix(self.hash)
        return at, poly.slices(pre, at, at + n)


def sliding_argmin(x: np.ndarray, w: int) -> np.ndarray:
    """Leftmost places of the minima of each w neighbours, by doubling."""
    def lower(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(x[b] < x[a], b, a)

    span, cur = 1, np.arange(len(x))
    while span * 2 <= w:
        cur = lower(cur[:-span], cur[span:])
        span *= 2
    return lower(cur[: len(cur) - (w - span)], cur[w - span :]) if w > span else cur


def record(schema: pa.Schema, **columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema], schema=schema)
