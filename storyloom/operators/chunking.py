"""Size-bounded packing of lines, scene boundaries and scenes, one document at a time: chunks by pointers over running sums of lengths; shards are folded as streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions.arrays import explode_once
from storyloom.functions.text import strip

def _sums(lengths: object) -> np.ndarray:
    """What lies before each place, and all."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(np.asarray(lengths, np.int64), out=out[1:])
    return out


def chunk_numbers(lengths: object, size: int, loose: bool = False) -> np.ndarray:
    """A chunk number for each line from the lines' lengths, newlines not counted.

    Where a chunk that opens at each line would end is one binary search in the running sums; the numbers follow these pointers from the first line.
    ``loose``: the newline counts neither in the test nor where a chunk opens (but for the first one), and a text of at most ``size`` is one chunk.
    """
    n = len(lengths)
    out = np.zeros(n, np.int32)
    before = _sums(np.asarray(lengths, np.int64) + 1)
    if loose and before[-1] - 1 <= size:
        return out
    start = chunk = 0
    while start < n:
        free = size + (1 + (start > 0) if loose else 0)
        end = max(start + 1, int(np.searchsorted(before, before[start] + free, "right")) - 1)
        out[start:end] = chunk
        start, chunk = end, chunk + 1
    return out


def segment_bounds(lengths: object, low: int, high: int, targets: object) -> list[tuple[int, int]]:
    """(first line, line behind the last) of each segment from the lengths of lines, newlines counted; ``targets``: the size that each segment aims at."""
    before, n = _sums(lengths), len(lengths)
    out: list[tuple[int, int]] = []
    start, first = 0, 0  # the first line that is tested: behind ``start`` where that line was kept from the segment before
    while first < n:
        # the line with which the target is reached
        k = max(first, int(np.searchsorted(before, before[start] + int(targets[len(out)]), "left")) - 1)
        if k >= n:
            break
        if before[k + 1] - before[start] > high and before[k] - before[start] >= low:
            out.append((start, k))
            start, first = k, k + 1
        else:
            out.append((start, k + 1))
            start = first = k + 1
    if start < n:
        out.append((start, n))
    return out


def _numbers(lengths: Column, size: int, loose: bool) -> Column:
    @F.pandas_udf("array<int>")
    def numbers(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if v is None else chunk_numbers(v, size, loose))

    return numbers(lengths)


def line_chunks(lines: Column | str, size: int) -> Column:
    """A chunk number for each line: a new chunk where the line and its newline no longer fit. Only lengths leave the JVM."""
    x = F.col(lines) if isinstance(lines, str) else lines
    return _numbers(F.transform(x, lambda v: F.length(v)), size, False)


def line_chunks_loose(text: Column | str, size: int) -> Column:
    """The variant for long texts: one chunk unless the text is longer than ``size``; the newline does not count against the limit when tested or when a chunk opens."""
    t = F.col(text) if isinstance(text, str) else text
    return _numbers(F.transform(F.split(t, "\n"), lambda v: F.length(v)), size, True)


def pack_lines(rows: DataFrame, doc: str, ids: Column, text: str = "text") -> DataFrame:
    """(doc, chunk, content, n_lines) from chunk numbers of the text's lines."""
    z = F.arrays_zip(F.split(F.col(text), "\n").alias("line"), ids.alias("chunk"))
    return (
        explode_once(rows, z, doc, value="z").groupBy(doc, F.col("z.chunk").alias("chunk"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "z.line"))), lambda v: v["line"]), "\n").alias("content"), F.count("*").alias("n_lines"))
    )


def split_segments(text: Column | str, low: int = 2000, high: int = 4000, key: Column | str | None = None, seed: int = 0) -> Column:
    """Segments of whole lines (newlines count) between ``low`` and ``high`` characters with a target drawn per segment.

    Targets come from a hash of seed, key and segment number, so a run can be repeated; with low == high there is one target.
    """
    t = F.col(text) if isinstance(text, str) else text
    k = F.lit("") if key is None else (F.col(key) if isinstance(key, str) else key).cast("string")
    # every segment but the last has at least ``low`` characters; without a bound, a line may close one and be the next
    most = (F.ceil(F.length(t) / low).cast("int") if low else 2 * F.length(t)) + 1
    draw = (lambda n: F.lit(low)) if low == high else (lambda n: F.lit(low) + F.pmod(F.xxhash64(F.lit(seed), k, n), F.lit(high - low + 1)).cast("int"))
    targets = F.transform(F.sequence(F.lit(0), most), draw)

    # a slice of a JVM array reads all of it, so a long text's segments are cut where its lines are
    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series, aims: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(texts, aims, strict=True):
            *heads, last = (x or "").split("\n")
            lines = [f"{h}\n" for h in heads] + ([last] if last else [])
            parts = ["".join(lines[s:e]).strip() for s, e in segment_bounds([len(v) for v in lines], low, high, y if y is not None else ())]
            out.append(None if x is None else [p for p in parts if p])
        return pd.Series(out)

    return cut(t, targets)


def valid_boundaries(raw: Column | str) -> Column:
    """Positive whole numbers of an array of strings, sorted, each once."""
    x = F.col(raw) if isinstance(raw, str) else raw
    return F.array_sort(F.array_distinct(F.filter(F.transform(x, lambda v: F.when(v.rlike("^[0-9]+$"), v.try_cast("int"))), lambda v: v > 0)))


def thin_boundaries(bounds: Column | str, gap: int = 5, keep_last: bool = True) -> Column:
    """Sorted boundaries at least ``gap`` apart, the first kept. The end mark stays; ``keep_last=False`` lets it go like any other."""
    b = F.col(bounds) if isinstance(bounds, str) else bounds
    step = lambda a, x: F.when((F.size(a) == 0) | (x - F.coalesce(F.get(a, F.size(a) - 1), F.lit(0)) >= gap), F.array_append(a, x)).otherwise(a)
    thin = F.aggregate(b, F.array().cast("array<int>"), step)
    if not keep_last:
        return thin
    last = F.array_max(b)
    inner = F.filter(thin, lambda x: (x < last) & ((last - x >= gap) | (x == F.array_min(b))))
    return F.when(F.size(b) > 1, F.array_append(inner, last)).otherwise(thin)


def _scene_size(lines: Column, start: Column, end: Column) -> Column:
    return F.length(strip(F.array_join(F.slice(lines, start, F.greatest(F.lit(0), end - start)), "\n")))


def long_scenes(lines: str, bounds: str, least: int = 2000) -> Column:
    """Inner boundaries whose scenes have at least ``least`` stripped characters, behind the first one."""
    x, b = F.col(lines), F.col(bounds)
    inner = F.slice(b, F.lit(2), F.greatest(F.lit(0), F.size(b) - 2))
    return F.aggregate(inner, F.slice(b, 1, 1), lambda a, v: F.when(_scene_size(x, F.element_at(a, -1), v) >= least, F.array_append(a, v)).otherwise(a))


def merge_last(lines: str, kept: str, bounds: str, least: int = 2000) -> Column:
    """``kept`` and the end mark; a short last scene joins the one before."""
    k, end = F.col(kept), F.element_at(F.col(bounds), -1)
    pop = (F.size(k) > 1) & (_scene_size(F.col(lines), F.element_at(k, -1), end) < least)
    return F.when(F.size(bounds) > 1, F.array_append(F.when(pop, F.slice(k, F.lit(1), F.size(k) - 1)).otherwise(k), end)).otherwise(F.col(bounds))


def scenes(rows: DataFrame, doc: str, bounds: str = "bounds", text: str = "text") -> DataFrame:
    """(doc, scene_id, start_line, end_line, content, char_count) from boundaries (first lines, and the line behind the end)."""
    lines = F.split(F.col(text), "\n")
    cut = rows.select(doc, lines.alias("_lines"), F.col(bounds).alias("_b"))
    each = explode_once(cut, F.slice("_b", F.lit(1), F.greatest(F.lit(0), F.size("_b") - 1)), doc, "_lines", "_b", pos="_i", value="start_line")
    # coalesce: else the filter implies that the boundaries are not null, and that is pushed down with the fold that makes them
    each = each.withColumn("end_line", F.coalesce(F.try_element_at("_b", F.col("_i") + 2), F.lit(0)) - 1).where("start_line <= end_line")
    each = each.withColumn("content", strip(F.array_join(F.slice("_lines", F.col("start_line"), F.col("end_line") - F.col("start_line") + 1), "\n"))).where("content <> ''")
    name = F.format_string("%s_%03d", F.col(doc).cast("string"), F.col("_i"))
    return each.select(doc, name.alias("scene_id"), F.col("start_line").cast("int").alias("start_line"), F.col("end_line").cast("int").alias("end_line"), "content", F.length("content").alias("char_count"))


def row_shards(rows: DataFrame, most: int, order: str, name: str = "shard") -> DataFrame:
    """Rows with a shard number: ``most`` rows a shard if there are more, else one shard."""
    from storyloom.operators.ordering import global_index

    if most <= 0:
        return rows.withColumn(name, F.lit(0).cast("long"))
    return global_index(rows, order, "_i").withColumn(name, F.floor(F.col("_i") / most).cast("long")).drop("_i")


def byte_shards(rows: DataFrame, size: Column, key: str, order: str, shard_bytes: int, total_bytes: int | None = None) -> DataFrame:
    """(key, shard): greedy shards of at most ``shard_bytes`` (a larger row is alone) inside each key, from 1.

    Sizes are folded in order per key: the rows of a key stream by with their sizes only, and no more than a batch is held. ``total_bytes`` ends a key's output once
    reached; the row that reaches it still counts.
    """
    sized = rows.select(key, F.col(order).cast("long").alias(order), size.cast("long").alias("_size"))

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, cur, done, shard = None, 0, 0, 1
        for f in frames:
            numbers = []
            for k, n in zip(f[key], f["_size"], strict=True):
                if k != at:
                    at, cur, done, shard = k, 0, 0, 1
                if total_bytes is not None and done >= total_bytes:
                    numbers.append(0)
                    continue
                if cur + n > shard_bytes and cur > 0:
                    cur, shard = 0, shard + 1
                cur, done = cur + n, done + n
                numbers.append(shard)
            yield f.assign(shard=numbers).drop(columns="_size")[lambda x: x["shard"] > 0]

    kind = dict(rows.dtypes)[key]
    return sized.repartition(key).sortWithinPartitions(key, order).mapInPandas(fold, f"{key} {kind}, {order} bigint, shard bigint")


def sequence_numbers(rows: DataFrame, part: str, order: str, name: str = "n") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(part).orderBy(order)))
