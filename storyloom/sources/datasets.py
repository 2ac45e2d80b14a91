"""A dataset by repository id, read from its local copy of Parquet files: in batch, or as a stream whose triggers are bounded in bytes.

A stream remembers files by name and size, so a file that comes later is read once wherever its name sorts, and one that has changed since it was taken
is refused. Two kinds of offsets:

* without ``log``: the offset holds all names and sizes; a trigger takes all that is new. For folders of some thousand files.
* with ``log`` (a folder of this stream's own): the offset is a number, and what each number took is a file of the log, written before the offset is
  given out; every ``COMPACT`` numbers the log is folded into one file. A trigger takes at most ``bytes`` bytes, in order of names; a larger file is taken by
  its row groups over several triggers, and a single row group over the bound is taken alone. If a driver dies between the log and Spark's own offset, the
  next trigger takes what was logged together with its own share.

Paths are those of any store that Arrow knows by its address; without a scheme a local one.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: numbers of the log that are folded into one file; bytes of a file above which its row groups are read as several partitions
COMPACT, SPLIT = 64, 128 << 20


class _Parts(InputPartition):
    """Some row groups of a file (all, if ``groups`` is None); ``number`` seeds its shuffle."""

    def __init__(self, number: int, file: str, groups: list[int] | None = None) -> None:
        self.number, self.file, self.groups = number, file, groups


def _store(path: str) -> tuple[Any, str]:
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith(("file:", "/")) else (fs.LocalFileSystem(), path)


def _root(options: dict) -> str:
    return "/".join([options["path"].rstrip("/"), *(options[k] for k in ("subset", "split") if options.get(k))])


def _files(options: dict) -> dict[str, int]:
    """Names and sizes of the Parquet files of the chosen subset and split, in order of their names."""
    from pyarrow import fs

    store, root = _store(_root(options))
    if store.get_file_info(root).type == fs.FileType.File:
        return {root: store.get_file_info(root).size}
    hidden = lambda p: any(x.startswith(("_", ".")) for x in p[len(root) :].split("/"))
    found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    return {f.path: f.size for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.File and f.path.endswith(".parquet") and not hidden(f.path)}


def _groups(options: dict, file: str) -> list[int]:
    """Bytes of a file's row groups, from its footer."""
    import pyarrow.parquet as pq

    meta = pq.read_metadata(file, filesystem=_store(_root(options))[0])
    return [max(1, sum(meta.row_group(i).column(c).total_compressed_size for c in range(meta.num_columns))) for i in range(meta.num_row_groups)]


def shuffled(batches: Iterator[pa.RecordBatch], size: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Batches whose rows pass through a buffer of ``size`` rows: each arrival takes the place of a random row, which goes on. No more than the buffer and a batch are held."""
    rng, held = random.Random(seed), []
    for b in batches:
        out = []
        for row in b.to_pylist():
            if len(held) < size:
                held.append(row)
            else:
                i = rng.randrange(size)
                out.append(held[i])
                held[i] = row
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=b.schema)
        schema = b.schema
    rng.shuffle(held)
    for s in range(0, len(held), 1000):
        yield pa.RecordBatch.from_pylist(held[s : s + 1000], schema=schema)


class _FileReader:
    """Reads one partition; with option ``buffer``, in shuffled order by ``seed`` and the partition's number."""

    def __init__(self, schema: T.StructType, options: dict) -> None:
        self.schema, self.options = schema, options

    def read(self, partition: _Parts) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        file = pq.ParquetFile(partition.file, filesystem=_store(_root(self.options))[0])
        rows = file.iter_batches(batch_size=1000, columns=self.schema.fieldNames(), row_groups=partition.groups)
        size = int(self.options.get("buffer", 0))
        yield from shuffled(rows, size, int(self.options.get("seed", 0)) * 1_000_003 + partition.number) if size > 0 else rows


def _split(options: dict, file: str, size: int, groups: list[int] | None = None) -> list[tuple[str, list[int] | None]]:
    """A file, or some row groups of it, as one partition; where they may hold more, one for each ``SPLIT`` bytes of row groups."""
    if size <= SPLIT:
        return [(file, groups)]
    out, held, total, sizes = [], [], 0, _groups(options, file)
    for i in range(len(sizes)) if groups is None else groups:
        if held and total + sizes[i] > SPLIT:
            out.append((file, held))
            held, total = [], 0
        held.append(i)
        total += sizes[i]
    return [*out, (file, held)]


class _BatchReader(_FileReader, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        """A partition a file; a large file has one for each ``SPLIT`` bytes of row groups."""
        out = [x for file, size in _files(self.options).items() for x in _split(self.options, file, size)]
        return [_Parts(i, f, g) for i, (f, g) in enumerate(out)]


class _NamesReader(_FileReader, DataSourceStreamReader):
    """The offset holds what has been taken."""

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        return {"files": _files(self.options)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        _unchanged(start["files"], end["files"])
        new = [x for f, size in end["files"].items() if f not in start["files"] for x in _split(self.options, f, size)]
        return [_Parts(i, f, g) for i, (f, g) in enumerate(new)]

    def commit(self, end: dict) -> None:
        pass


def _unchanged(taken: dict[str, int], now: dict[str, int]) -> None:
    for f in taken.keys() & now.keys():
        if taken[f] != now[f]:
            raise ValueError(f"{f} has changed since it was taken")


class TakenLog:
    """What each number of a stream took: ``n.json`` for a number, and ``upto-n.json`` for all up to one."""

    def __init__(self, path: str) -> None:
        self.store, self.root = _store(path)
        self.store.create_dir(self.root, recursive=True)
        self.sizes: dict[str, int] = {}
        self.open: dict[str, int] = {}
        self.last = self.folded = 0
        for name, taken in self._load():
            self._count(name, taken)

    def _names(self) -> list[str]:
        from pyarrow import fs

        return [f.base_name for f in self.store.get_file_info(fs.FileSelector(self.root)) if f.base_name.endswith(".json")]

    def _read(self, name: str) -> list[dict]:
        return json.loads(self.store.open_input_stream(f"{self.root}/{name}").read())

    def _write(self, name: str, entries: list[dict]) -> None:
        """Under another name first, so that a number's file is whole or not there."""
        with self.store.open_output_stream(f"{self.root}/{name}.part") as out:
            out.write(json.dumps(entries).encode())
        self.store.move(f"{self.root}/{name}.part", f"{self.root}/{name}")

    def _load(self) -> Iterator[tuple[int, list[dict]]]:
        names = self._names()
        self.folded = max([0, *(int(n[5:-5]) for n in names if n.startswith("upto-"))])
        if self.folded:
            yield self.folded, self._read(f"upto-{self.folded}.json")
        for n in sorted(int(n[:-5]) for n in names if n[:-5].isdigit()):
            if n > self.folded:
                yield n, self._read(f"{n}.json")

    def _count(self, number: int, entries: list[dict]) -> None:
        """Add a number's entries: (file, size, next group that is open, or none)."""
        self.last = number
        for e in entries:
            self.sizes[e["file"]] = e["size"]
            if e.get("next") is None:
                self.open.pop(e["file"], None)
            else:
                self.open[e["file"]] = e["next"]

    def add(self, entries: list[dict]) -> None:
        self._write(f"{self.last + 1}.json", entries)
        self._count(self.last + 1, entries)
        if self.last - self.folded >= COMPACT:
            self.fold()

    def fold(self) -> None:
        """One file for all numbers but the last ``COMPACT`` / 2, which a restart may ask for again."""
        self._write(f"upto-{self.last}.json", [{"file": f, "size": n, "next": self.open.get(f)} for f, n in self.sizes.items()])
        old, self.folded = self.folded, self.last
        if old:
            self.store.delete_file(f"{self.root}/upto-{old}.json")
        for n in self._names():
            if n[:-5].isdigit() and int(n[:-5]) <= self.last - COMPACT // 2:
                self.store.delete_file(f"{self.root}/{n}")

    def between(self, start: int, end: int) -> list[dict]:
        return [e for n in range(start + 1, end + 1) for e in self._read(f"{n}.json")]


class _LogReader(_FileReader, DataSourceStreamReader):
    """The offset is a number of the log; each takes at most ``bytes`` bytes."""

    def __init__(self, schema: T.StructType, options: dict) -> None:
        super().__init__(schema, options)
        self.most = int(options.get("bytes", 1 << 62))

    def initialOffset(self) -> dict:
        return {"number": 0}

    def latestOffset(self) -> dict:
        log = TakenLog(self.options["log"])
        now = _files(self.options)
        _unchanged(log.sizes, now)
        entries, left = [], self.most
        for file in [*log.open, *(f for f in now if f not in log.sizes)]:
            first = log.open.get(file, 0)
            if not first and now[file] <= left:
                entries.append({"file": file, "size": now[file], "groups": None})
                left -= now[file]
                continue
            sizes = _groups(self.options, file)
            taken, i = [], first
            while i < len(sizes) and (sizes[i] <= left or not (entries or taken)):
                taken.append(i)
                left -= sizes[i]
                i += 1
            if taken or not sizes:
                entries.append({"file": file, "size": now[file], "groups": taken, "next": i if i < len(sizes) else None})
            if i < len(sizes):
                break
        if entries:
            log.add(entries)
        return {"number": log.last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        taken = [x for e in TakenLog(self.options["log"]).between(start["number"], end["number"]) for x in _split(self.options, e["file"], e["size"], e["groups"])]
        return [_Parts(i, f, g) for i, (f, g) in enumerate(taken)]

    def commit(self, end: dict) -> None:
        pass


class DatasetSource(DataSource):
    """Options: ``path`` of the local copy, ``subset`` and ``split`` below it, ``columns`` (DDL), ``buffer`` (rows) and ``seed`` for rows shuffled in a bounded buffer; streams: ``log`` and ``bytes``."""

    @classmethod
    def name(cls) -> str:
        return "storyloom_dataset"

    def schema(self) -> str:
        return self.options.get("columns", "text string")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _BatchReader(schema, dict(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        options = dict(self.options)
        if options.get("bytes") and not options.get("log"):
            raise ValueError("a bound of bytes needs a log")
        return (_LogReader if options.get("log") else _NamesReader)(schema, options)
