"""Operator 6: benchmark decontamination by the q-gram lemma.

A passage is a window of ``window`` characters (code points) of an item (the whole item if it is shorter), at every start. A document
holds it if some stretch of the document is within ``edits`` single-character edits of it. Texts are compared lower-cased (A-Z) with white
space as one space.

An alignment within the budget keeps at least window + 1 - q * (edits + 1) of the window's q-grams, all on
diagonals that differ by at most ``edits``. So each document's positions are looked up in a table of the benchmark's q-grams;
stretches with too few shared q-grams end there; the rest are counted in overlapping diagonal bands; windows that
reach the bound are verified by banded alignment, many at a time. Documents are scanned where they are read and nothing is shuffled.

Memory is bounded whatever the texts: a long text is scanned in overlapping pieces; shared q-grams are expanded to diagonals a
bounded number at a time; and where a text or item repeats a period of up to ``window`` bytes for longer than eight windows, it is searched with the
repetition shortened to about eight windows, which holds the same windows.

The benchmark goes to the executors in blocks of at most ``block_bytes``, so what is broadcast never grows with it. One block is one scan; a worker keeps
the index of the block that it used last. More blocks are taken in groups of ``group_bytes``: one scan with a bit table of the group's q-grams writes the texts that have a dense
stretch, and only these are read again for each block. A match depends on the text alone, so ``decontaminate`` gathers the digests of
matching texts from all blocks and leaves them out by one join; no task holds two indexes, and no scan reads through an earlier one.

Defined results: null or empty texts and items match nothing, as do items shorter than q; rows and items with null ids are
searched and reported with their null id; repeated rows and items are reported each; an item longer than a block is cut into pieces that share a
window less one character, reported each; a table without rows gives none; other columns are ignored by ``contaminated`` and
kept by ``decontaminate``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.runtime import small_batches, source, write_table
from storyloom.llm.vectext import CHUNK_BYTES, LOWER, SPACE, Poly, U, chunks, flat, record, stream

Q = 10
#: pairs of a text's and an item's place with one q-gram that are expanded at once
PAIRS = 1 << 18
_QGRAM = Poly(71)
#: a value for each code point, and what stands beyond a text
_VALUES, BEYOND = stream(81, 0x110000), 0x110000
_HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("n_windows", pa.int64())])
DDL = "doc_id long, item_id long, edits long, start long, end long, n_windows long"


def normal(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points with runs of white space as one space, and the new offsets."""
    space = SPACE[buf]
    first = np.zeros(len(buf), bool)
    first[off[:-1][off[:-1] < len(buf)]] = True
    drop = space.copy()
    drop[1:] &= space[:-1]
    drop[:1] = False
    drop &= ~first
    out = np.where(space, np.uint8(32), LOWER[buf])[~drop]
    off = np.concatenate([[0], np.cumsum(~drop)])[off]
    if len(out) and out.max() > 127:  # bytes are code points otherwise
        heads = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
        return points(out.tobytes()), heads[off]
    return out, off


def points(text: bytes) -> np.ndarray:
    """The code points of UTF-8."""
    return np.frombuffer(text, np.uint8) if text.isascii() else np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)


def budget(size: int, q: int = Q) -> int:
    """Edits allowed in a window: one for each 16 characters, as long as the lemma's bound stays positive."""
    return max(0, min(size // 16, (size - q) // q))


def align(windows: np.ndarray, texts: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window (rows of equal length) the fewest edits to some stretch of its text row, and that stretch's last cell.

    Cells are the diagonals of the band: cell k at window place i is text place i + k, so a text row is as long as the window and the band.
    """
    n, size = windows.shape
    width = texts.shape[1] - size
    ramp = np.arange(width, dtype=np.int16)
    row = np.zeros((n, width + 1), np.int16)
    row[:, width] = edits + 1  # beyond the band
    for i in range(size):
        step = np.minimum(row[:, :-1] + (windows[:, i, None] != texts[:, i : i + width]), row[:, 1:] + 1)
        row[:, :-1] = np.minimum.accumulate(step - ramp, axis=1) + ramp
    last = row[:, :-1].argmin(axis=1)
    return row[np.arange(n), last], last


def shortened(x: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Characters with periodic stretches of over eight windows cut down to about eight, and where each byte left was. Every stretch of up to four windows remains."""
    keep, where = 8 * window, np.arange(len(x))
    for d in range(1, window + 1):
        if len(x) <= keep + d:
            break
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (x[d:] == x[:-d]).view(np.int8), [0]])))
        start, size = edge[::2], edge[1::2] - edge[::2] + d
        cut = np.maximum(0, (size - keep) // d) * d
        if (start := start[cut > 0]).size:
            cut = cut[cut > 0]
            stay = np.ones(len(x), bool)
            for s, c in zip(start + keep // 2, cut, strict=True):
                stay[s : s + c] = False
            x, where = x[stay], where[stay]
    return x, where


class Index:
    """The q-grams of some items: (ids, normalised text) each."""

    def __init__(self, items: list[tuple[list, bytes]], window: int, q: int = Q) -> None:
        self.window, self.q = window, q
        self.ids = [i for i, _ in items]
        self.items = [shortened(points(t), window)[0] if len(t) > 8 * window else points(t) for _, t in items]
        self.head = np.concatenate([[0], np.cumsum([len(t) for t in self.items])]).astype(np.int64)
        flat_ = np.concatenate(self.items) if items else np.zeros(0, np.uint8)
        keys, at = grams(flat_, self.head, q)
        order = np.argsort(keys, kind="stable")
        self.keys, self.at = keys[order], at[order]
        bits = max(16, int(np.ceil(np.log2(16 * len(keys) + 1))))
        self.shift = U(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[(keys >> self.shift).astype(np.int64)] = True
        size = [min(window, len(t)) for t in self.items]
        self.need = np.array([n + 1 - q * (budget(n, q) + 1) for n in size])
        self.least = int(self.need.min(initial=1 << 30))
        self.most_edits = max((budget(n, q) for n in size), default=0)
        self.span = window + self.most_edits - q + 1

    def search(self, column: pa.Array) -> list[tuple[int, int, int, int, int, int]]:
        """(row, item number, edits, start, end, windows) of each row and item that match."""
        buf, off = normal(*flat(column))
        found: dict[tuple[int, int], dict[int, tuple[int, int, int]]] = {}
        for rows, base, part, edge in pieces(buf, off, 2 * self.span + 4 * self.q):
            self._scan(part, edge, rows, base, found)
        found = {k: v for k, v in found.items() if v}
        return [(r, i, min(x[0] for x in v.values()), min(x[1] for x in v.values()), max(x[2] for x in v.values()), len(v)) for (r, i), v in sorted(found.items())]

    def _scan(self, buf: np.ndarray, off: np.ndarray, first_row: int, base: int, found: dict) -> None:
        """Search some texts, or a piece of one that starts at ``base``."""
        keys, at = grams(buf, off, self.q)
        if not len(keys) or not len(self.keys):
            return
        at, keys = dense(at, keys, self.seen[(keys >> self.shift).astype(np.int64)], self.span, self.least)
        if not len(at):
            return
        lo, hi = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        row = np.searchsorted(off, at, "right") - 1
        many = np.bincount(row, hi - lo, len(off) - 1)
        where = None
        if len(off) == 2 and len(buf) > 8 * self.window and many.sum() > PAIRS:
            # one text with very many pairs: search it without its long repetitions
            short, where = shortened(buf, self.window)
            if len(short) < len(buf):
                shifted: dict = {}
                self._scan(short, np.array([0, len(short)]), first_row, 0, shifted)
                for k, known in shifted.items():
                    mine = found.setdefault(k, {})
                    for s, (e, a, b) in known.items():
                        if e < mine.get(s, (1 << 30,))[0]:
                            mine[s] = (e, base + int(where[a]), base + int(where[b - 1]) + 1)
                return
        elif len(off) > 2 and many.sum() > PAIRS:
            for r in np.flatnonzero(many):
                self._scan(buf[off[r] : off[r + 1]], np.array([0, off[r + 1] - off[r]]), first_row + int(r), 0, found)
            return
        # positions in runs with a bounded number of pairs each; a run also holds what a window that starts in it can reach
        total = np.concatenate([[0], np.cumsum(hi - lo)])
        i = 0
        while i < len(at):
            j = max(i + 1, int(np.searchsorted(total, total[i] + PAIRS, "right")) - 1)
            k = int(np.searchsorted(at, at[j - 1] + self.span)) if j < len(at) else j
            slices = max(1, -(-int(total[k] - total[i]) // (4 * PAIRS)))
            for c in range(slices):
                # of a q-gram with very many places, a part of the items at a time
                cut = [self.head[len(self.items) * x // slices] for x in (c, c + 1)]
                self._pairs(buf, off, first_row, base, at[i:k], row[i:k], self._place(lo[i:k], hi[i:k], cut[0]), self._place(lo[i:k], hi[i:k], cut[1]), found)
            i = j

    def _place(self, lo: np.ndarray, hi: np.ndarray, bound: int) -> np.ndarray:
        """The first of each range whose place is ``bound`` or more."""
        if bound <= 0:
            return lo
        if bound >= self.head[-1]:
            return hi
        lo, hi = lo.copy(), hi.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            less = open_ & (self.at[np.minimum(mid, len(self.at) - 1)] < bound)
            lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        return lo

    def _pairs(self, buf: np.ndarray, off: np.ndarray, first_row: int, base: int, at: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, found: dict) -> None:
        """Count shared q-grams in diagonal bands and verify windows that have enough."""
        many = hi - lo
        each = np.repeat(np.arange(len(at)), many)
        place = self.at[np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(len(each))]
        item = np.searchsorted(self.head, place, "right") - 1
        p, r = at[each], row[each]
        inside = place - self.head[item]
        diagonal = inside - (p - off[r])
        width = 2 * self.most_edits + 1
        todo: dict[int, list[tuple[int, int, int, int]]] = {}
        for shift in (0, self.most_edits):  # overlapping bands: any diagonals that differ by at most the budget share one
            band = (diagonal + shift) // width
            order = np.lexsort((p, band, item, r))
            rr, ii, bb, pp = r[order], item[order], band[order], p[order]
            j = np.arange(len(pp)) + self.need[ii] - 1
            jj = np.minimum(j, len(pp) - 1)
            fits = (j < len(pp)) & (rr[jj] == rr) & (ii[jj] == ii) & (bb[jj] == bb) & (pp[jj] - pp < self.span)
            new = np.ones(len(pp), bool)
            new[1:] = (rr[1:] != rr[:-1]) | (ii[1:] != ii[:-1]) | (bb[1:] != bb[:-1])
            group = np.cumsum(new) - 1
            edge = np.append(np.flatnonzero(new), len(pp))
            places = inside[order]
            for g in np.unique(group[fits]):
                f, t = edge[g], edge[g + 1]
                i = int(ii[f])
                size = min(self.window, len(self.items[i]))
                starts, near = np.arange(len(self.items[i]) - size + 1), np.unique(places[f:t])
                shared = np.searchsorted(near, starts + size - self.q, "right") - np.searchsorted(near, starts, "left")
                todo.setdefault(size, []).extend((int(rr[f]), i, s, int(bb[f]) * width - shift) for s in np.flatnonzero(shared >= self.need[i]).tolist())
        for size, windows in todo.items():
            e = budget(size, self.q)
            cells = 2 * self.most_edits + 2 * e + 1
            for x in range(0, len(windows), 1024):
                part = windows[x : x + 1024]
                texts = np.full((len(part), size + cells), BEYOND, np.uint32)
                heads = []
                for n, (r_, _, s, low) in enumerate(part):
                    a = s - (low + 2 * self.most_edits + e)
                    heads.append(a)
                    f, t = max(0, a), min(int(off[r_ + 1] - off[r_]), a + size + cells)
                    if f < t:
                        texts[n, f - a : t - a] = buf[off[r_] + f : off[r_] + t]
                got, last = align(np.stack([self.items[i][s : s + size] for _, i, s, _ in part]), texts, e)
                for n in np.flatnonzero(got <= e).tolist():
                    r_, i, s, _ = part[n]
                    known = found.setdefault((first_row + r_, i), {})
                    if got[n] < known.get(s, (1 << 30,))[0]:
                        end = min(int(off[r_ + 1] - off[r_]), heads[n] + size + int(last[n]))
                        known[s] = (int(got[n]), base + max(0, end - size - int(got[n])), base + end)


def grams(buf: np.ndarray, off: np.ndarray, q: int = Q) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of each q-gram inside one of the texts that ``off`` bounds."""
    n = len(buf) - q + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    whole = np.ones(n, bool)
    for cut in off[1:-1]:
        whole[max(0, cut - q + 1) : cut] = False
    at = np.flatnonzero(whole)
    return _QGRAM.slices(_QGRAM.prefix(_VALUES[buf]), at, at + q), at


def dense(at: np.ndarray, keys: np.ndarray, hit: np.ndarray, span: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The hits that have ``least`` hits within ``span`` places, themselves included, whatever their diagonal."""
    at, keys = at[hit], keys[hit]
    last = np.searchsorted(at, at + span)
    enough = np.flatnonzero(last - np.arange(len(at)) >= least)
    step = np.zeros(len(at) + 1, np.int64)
    np.add.at(step, enough, 1)
    np.add.at(step, last[enough], -1)
    stay = np.cumsum(step[:-1]) > 0
    return at[stay], keys[stay]


def pieces(buf: np.ndarray, off: np.ndarray, overlap: int, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, its start, bytes, offsets) of rows together, or of a long row's overlapping pieces alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        if off[j] - off[i] <= 2 * most:
            yield i, 0, buf[off[i] : off[j]], off[i : j + 1] - off[i]
        else:
            for s in range(int(off[i]), int(off[j]), most):
                e = min(int(off[j]), s + most + overlap)
                yield i, s - int(off[i]), buf[s:e], np.array([0, e - s])
        i = j


class Table:
    """A bit for each hash of a group's q-grams, for the scan before the blocks."""

    def __init__(self, bits: int) -> None:
        self.bits, self.words, self.least, self.span = bits, np.zeros(1 << (bits - 3), np.uint8), 1 << 30, 0

    def add(self, index: Index) -> None:
        slot = (index.keys >> U(64 - self.bits)).astype(np.int64)
        np.bitwise_or.at(self.words, slot >> 3, np.left_shift(1, slot & 7).astype(np.uint8))
        self.least, self.span = min(self.least, index.least), max(self.span, index.span)

    def matches(self, column: pa.Array) -> np.ndarray:
        """Whether each text has a dense stretch."""
        buf, off = normal(*flat(column))
        out = np.zeros(len(off) - 1, bool)
        for first, _, part, edge in pieces(buf, off, 2 * self.span + 4 * Q):
            keys, at = grams(part, edge)
            slot = (keys >> U(64 - self.bits)).astype(np.int64)
            at, _ = dense(at, keys, (self.words[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool), self.span, self.least)
            out[first + np.unique(np.searchsorted(edge, at, "right") - 1)] = True
        return out


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text is not null and text <> ''")


def _blocks(items: DataFrame, block_bytes: int, window: int) -> Iterator[list[tuple[list, bytes]]]:
    """Items by running size, equal texts once; one partition of the table at a time is with the driver."""
    block: dict[bytes, list] = {}
    size = 0
    for r in items.toLocalIterator():
        x = normal(*flat(pa.array([r["text"]])))[0]
        x = "".join(map(chr, x.tolist())).strip(" ") if x.dtype != np.uint8 else x.tobytes().decode().strip(" ")
        step = max(1, block_bytes // (1 if x.isascii() else 4))
        for s in range(0, max(1, len(x) - window + 1), step):
            if len(cut := x[s : s + step + window - 1]) < Q:
                continue
            part = cut.encode()
            more = 16 + (0 if part in block else len(part))
            if block and size + more > block_bytes:
                yield list(zip(block.values(), block, strict=True))
                block, size, more = {}, 0, 16 + len(part)
            block.setdefault(part, []).append(r["item_id"])
            size += more
    if block:
        yield list(zip(block.values(), block, strict=True))


_kept: dict[str, Index] = {}


def _index(holder) -> Index:
    """The index of a broadcast block, kept by the worker until it gets another block."""
    if holder.id not in _kept:
        _kept.clear()
        _kept[holder.id] = Index(*holder.value)
    return _kept[holder.id]


class _Block:
    """A broadcast block with a number of its own."""

    def __init__(self, spark, items: list, window: int) -> None:
        self.held = spark.sparkContext.broadcast((items, window))
        self.id = uuid.uuid4().hex

    @property
    def value(self) -> tuple[list, int]:
        return self.held.value


def _hits(block: _Block):
    """Matches of each batch."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(block)
        for b in chunks(batches):
            got = [(g, i) for g in index.search(b.column("text")) for i in index.ids[g[1]]]
            ids = b.column("doc_id").take(pa.array([g[0] for g, _ in got], pa.int64()))
            cols = {k: [g[i] for g, _ in got] for i, k in enumerate(("edits", "start", "end", "n_windows"), 2)}
            yield record(_HITS, doc_id=ids, item_id=[i for _, i in got], **cols)

    return emit


def _clean(block: _Block, text_col: str):
    """Rows without a match."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(block)
        for b in chunks(batches, text_col):
            mask = np.ones(b.num_rows, bool)
            mask[[g[0] for g in index.search(b.column(text_col))]] = False
            yield b.filter(pa.array(mask))

    return emit


def _matching(block: _Block):
    """The rows of a table of texts that match."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(block)
        for b in chunks(batches):
            mask = np.zeros(b.num_rows, bool)
            mask[[g[0] for g in index.search(b.column("text"))]] = True
            yield b.filter(pa.array(mask)).select(["digest"])

    return emit


def _dense_rows(holder):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = holder.value
        for b in chunks(batches):
            yield b.filter(pa.array(table.matches(b.column("text"))))

    return emit


def _groups(items: DataFrame, block_bytes: int, group_bytes: int, window: int) -> Iterator[tuple[Table | None, list]]:
    """Blocks in groups, with the bit table of each group that has more than one block."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total <= block_bytes:
        yield None, list(_blocks(items, block_bytes, window))
        return
    table, group, size = None, [], 0
    for block in _blocks(items, block_bytes, window):
        if table is None:
            table = Table(max(16, min(29, int(np.ceil(np.log2(8 * min(group_bytes, total) + 1))))))
        table.add(Index(block, window))
        group.append(block)
        size += sum(len(t) for _, t in block)
        if size + block_bytes > group_bytes:
            yield table, group
            table, group, size = None, [], 0
    if group:
        yield table, group


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 64, block_bytes: int = 8 << 20, group_bytes: int = 64 << 20) -> DataFrame:
    """(doc_id, item_id, edits, start, end, n_windows): each document and item that share a passage; start and end bound it in the normalised text."""
    spark = docs.sparkSession
    src = source(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    out = None
    for table, blocks in _groups(_items(benchmark, item_col, item_text), block_bytes, group_bytes, window):
        rows = src if table is None else write_table(src.mapInArrow(_dense_rows(spark.sparkContext.broadcast(table)), "doc_id long, text string"), "dense")
        for items in blocks:
            part = rows.mapInArrow(_hits(_Block(spark, items, window)), DDL)
            out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], DDL)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 64, block_bytes: int = 8 << 20, group_bytes: int = 64 << 20) -> DataFrame:
    """The rows of ``docs`` that hold no passage, with all their columns."""
    spark = docs.sparkSession
    small_batches(spark)
    digest = F.md5(F.col(text_col).cast("string").cast("binary"))
    texts = docs.where(F.col(text_col).isNotNull()).select(digest.alias("digest"), F.col(text_col).cast("string").alias("text"))
    bad: list[DataFrame] = []
    for table, blocks in _groups(_items(benchmark, item_col, item_text), block_bytes, group_bytes, window):
        if table is None:
            return docs.mapInArrow(_clean(_Block(spark, blocks[0], window), text_col), docs.schema) if blocks else docs
        rows = write_table(texts.mapInArrow(_dense_rows(spark.sparkContext.broadcast(table)), "digest string, text string"), "dense")
        bad += [write_table(rows.mapInArrow(_matching(_Block(spark, items, window)), "digest string").distinct(), "hits") for items in blocks]
    if not bad:
        return docs
    name = f"gone_{uuid.uuid4().hex}"  # no column of the rows' own
    gone = write_table(reduce(DataFrame.unionByName, bad).distinct().withColumnRenamed("digest", name), "hits")
    return docs.join(gone, digest == F.col(name), "left_anti")
