"""Files under names that the rows give: one text, JSON or Parquet file for each name, written in parallel and shown all at once.

``NamedFiles`` is a data source writer. Rows come clustered and ordered by file, so a task has one file open and holds a batch, whatever a
file's size. A task writes under a folder of its attempt and lists what it has finished; once all have, the files of the attempts that count, and only
theirs, are renamed, so a task that failed, ran twice or was lost leaves nothing behind, and a job whose writing fails leaves the folder as it was.
``write_named`` lets tasks rename, each the files of an attempt, so the driver knows attempts and no files; rows written through the format alone are renamed by its commit.
``written`` and ``read_files`` list and read in tasks, too.

With ``spread`` a file may be many tasks': rows are dealt by ranges of name and order, each task writes pieces, and tasks copy the pieces to their places in
the whole file, which gets its name once all of it is there. Of Parquet pieces the row groups are copied as they are; the driver joins their
footers, some bytes a row group, and no rows. Other stores than a shared folder can't be written in the middle: there a file stays one task's.

Defined results: a null value is an empty line; a null name, an empty one, an absolute one or one with ``..`` is refused; a name that two tasks have
written is refused (rows must come clustered, as ``write_named`` makes them); existing files of other names stay unless the mode is overwrite, those of the
same name are replaced, or kept with ``exists="skip"``; no rows give no files.
"""

from __future__ import annotations

import json
import os
import posixpath
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from storyloom.functions.text import character_card_markdown, safe_file_name, safe_title

FORMAT = "storyloom_files"
ATTEMPTS = "_attempts"
#: bytes gathered before they go to the store; renames at a time
BUFFER, RENAMES = 1 << 18, 16
#: bytes of a Parquet row group before compression
GROUP = 32 << 20
#: rows of a listing's batch, files that a task reads, and bytes of a batch of contents
ROWS, FILES, BATCH = 10_000, 4_000, 4 << 20
#: what a Parquet file begins and ends with
MAGIC = b"PAR1"


@dataclass
class _Done(WriterCommitMessage):
    folder: str
    files: int


def checked(name: Any) -> str:
    """A file's name, or an error where it would leave the folder."""
    parts = str(name or "").split("/")
    if name is None or any(p in ("", ".", "..") for p in parts) or parts[0].startswith(ATTEMPTS):
        raise ValueError(f"no name for a file: {name!r}")
    return str(name)


class _Sink:
    """One open file at a time, under numbered names in the folder of an attempt."""

    def __init__(self, store: Any, folder: str, options: dict) -> None:
        self.store, self.folder, self.options = store, folder, options
        self.names: list[str] = []
        self.sizes: list[int] = []  # of pieces: bytes of text, or of row groups
        self.out: Any = None
        self.parquet: Any = None

    def open(self, name: str, schema: pa.Schema) -> None:
        self.close()
        self.names.append(checked(name))
        path = f"{self.folder}/{len(self.names) - 1}"
        if self.options["kind"] == "parquet":
            import pyarrow.parquet as pq

            self.file = self.store.open_output_stream(path)
            self.parquet, self.held = pq.ParquetWriter(self.file, schema, compression="zstd"), []
        else:
            self.out, self.first = self.store.open_output_stream(path, buffer_size=BUFFER), True

    def lines(self, values: list[str | None]) -> None:
        """Values with what separates them, of the file that is open."""
        between = self.options["between"]
        text = between.join(v or "" for v in values)
        self.out.write(((("" if self.first else between) + text)).encode())
        self.first = False

    def rows(self, batch: pa.RecordBatch) -> None:
        """Rows of the Parquet file that is open; a row group is written for each ``GROUP`` bytes."""
        self.held.append(batch)
        if sum(b.nbytes for b in self.held) >= GROUP:
            self.parquet.write_table(pa.Table.from_batches(self.held))
            self.held = []

    def close(self) -> None:
        if self.parquet is not None:
            if self.held:
                self.parquet.write_table(pa.Table.from_batches(self.held))
            self.sizes.append(self.file.tell() - len(MAGIC))
            self.parquet.close()
            self.file.close()
        elif self.out is not None:
            if not self.options.get("pieces"):
                self.out.write(self.options["end"].encode())
            self.sizes.append(self.out.tell())
            self.out.close()
        self.out = self.parquet = None

    def finish(self) -> _Done:
        self.close()
        with self.store.open_output_stream(f"{self.folder}/names") as out:
            out.write(json.dumps(self.names).encode())
        if self.options.get("pieces"):
            with self.store.open_output_stream(f"{self.folder}/sizes") as out:
                out.write(json.dumps(self.sizes).encode())
        return _Done(self.folder, len(self.names))


def _runs(names: list) -> Iterator[tuple[int, int]]:
    start = 0
    for i in range(1, len(names) + 1):
        if i == len(names) or names[i] != names[start]:
            yield start, i
            start = i


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.options = {"kind": "text", "between": "\n", "end": "\n", "exists": "replace", **options}
        self.overwrite, self.job = overwrite, f"{ATTEMPTS}/{options.get('job') or uuid.uuid4().hex}"

    def store(self) -> tuple[Any, str]:
        """The file system of the path: any that Arrow knows by its address (a shared folder, HDFS, an object store)."""
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.options["path"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = self.store()
        task = TaskContext.get()
        folder = f"{root}/{self.job}/{task.partitionId()}-{task.taskAttemptId()}"
        store.create_dir(folder, recursive=True)
        sink, now = _Sink(store, folder, self.options), None
        for b in iterator:
            names = b.column("file").to_pylist()
            for s, e in _runs(names):
                rows = b.slice(s, e - s).drop_columns(["file"])
                if now is None or names[s] != now:
                    now = checked(names[s])
                    sink.open(now, rows.schema)
                if self.options["kind"] == "parquet":
                    sink.rows(rows)
                else:
                    sink.lines(rows.column("value").to_pylist())
        return sink.finish()

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        store, root = self.store()
        if self.options.get("job"):  # tasks rename
            with store.open_output_stream(f"{root}/{self.job}/done") as out:
                out.write(json.dumps([m.folder for m in messages if m is not None and m.files]).encode())
            return
        moves: dict[str, str] = {}
        for m in (m for m in messages if m is not None):
            for i, name in enumerate(json.loads(store.open_input_stream(f"{m.folder}/names").read())):
                if name in moves:
                    self.abort(messages)
                    raise ValueError(f"several tasks have written {name!r}: cluster the rows by file")
                moves[name] = f"{m.folder}/{i}"
        with ThreadPoolExecutor(RENAMES) as pool:
            if self.overwrite:
                self.clear(store, root)
            elif self.options["exists"] == "skip":
                moves = {n: p for n, p in moves.items() if store.get_file_info(f"{root}/{n}").type == fs.FileType.NotFound}
            list(pool.map(lambda d: store.create_dir(d, recursive=True), {posixpath.dirname(f"{root}/{n}") for n in moves}))
            list(pool.map(lambda x: store.move(x[1], f"{root}/{x[0]}"), moves.items()))
        store.delete_dir(f"{root}/{self.job}")
        self._empty(store, root)

    def clear(self, store: Any, root: str) -> None:
        """Remove what was there before."""
        from pyarrow import fs

        old = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        with ThreadPoolExecutor(RENAMES) as pool:
            list(pool.map(lambda f: store.delete_dir(f.path) if f.type == fs.FileType.Directory else store.delete_file(f.path), [f for f in old if f.base_name != ATTEMPTS]))

    def publish(self, spark: SparkSession) -> None:
        """Give the files of the attempts that count their names: a task for each attempt, which may run again."""
        store, root = self.store()
        folders = json.loads(store.open_input_stream(f"{root}/{self.job}/done").read())
        if self.overwrite:
            self.clear(store, root)
        address, skip = self.options["path"], self.options["exists"] == "skip" and not self.overwrite

        def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyarrow import fs

            store, root = fs.FileSystem.from_uri(address)
            exists = lambda p: store.get_file_info(p).type != fs.FileType.NotFound
            for b in batches:
                for folder in b.column("folder").to_pylist():
                    made: set[str] = set()
                    for i, name in enumerate(json.loads(store.open_input_stream(f"{folder}/names").read())):
                        old, new = f"{folder}/{i}", f"{root}/{name}"
                        if skip and exists(new):
                            continue
                        if (parent := posixpath.dirname(new)) not in made:
                            store.create_dir(parent, recursive=True)
                            made.add(parent)
                        try:
                            store.move(old, new)
                        except OSError:
                            if exists(old) or not exists(new):  # else an earlier attempt of this task has renamed it
                                raise
                    yield pa.RecordBatch.from_pydict({"folder": [folder]})

        try:
            if folders and self.options.get("pieces"):
                self._assemble(spark, folders)
            elif folders:
                rows = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(len(folders))
                rows.mapInArrow(rename, "folder string").write.format("noop").mode("overwrite").save()
        finally:
            store.delete_dir(f"{root}/{self.job}")
            self._empty(store, root)

    def _assemble(self, spark: SparkSession, folders: list[str]) -> None:
        """Put pieces together: a task for each piece copies it to its place, then one for each file ends and names it. Both may run again."""
        from storyloom.plans.lineage import cut

        store, root = self.store()
        parquet, between, end = self.options["kind"] == "parquet", self.options["between"].encode(), self.options["end"].encode()
        skip, job, address = self.options["exists"] == "skip" and not self.overwrite, f"{root}/{self.job}", self.options["path"]
        gap, first = (0, len(MAGIC)) if parquet else (len(between), 0)

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyarrow import fs

            store, _ = fs.FileSystem.from_uri(address)
            for b in batches:
                for folder in b.column("folder").to_pylist():
                    part = int(posixpath.basename(folder).split("-")[0])
                    names, sizes = (json.loads(store.open_input_stream(f"{folder}/{x}").read()) for x in ("names", "sizes"))
                    n = len(names)
                    yield pa.RecordBatch.from_pydict({"file": names, "part": [part] * n, "piece": [f"{folder}/{i}" for i in range(n)], "bytes": sizes}, schema=pa.schema([("file", pa.string()), ("part", pa.int64()), ("piece", pa.string()), ("bytes", pa.int64())]))

        def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for p in b.to_pylist():
                    whole = f"{job}/whole-{p['whole']}"
                    with open(p["piece"], "rb") as src, os.fdopen(os.open(whole, os.O_WRONLY | os.O_CREAT, 0o644), "wb") as dst:
                        src.seek(first)
                        dst.seek(first + p["at"] - (gap if p["at"] else 0))
                        dst.write(between if gap and p["at"] else b"")
                        left = p["bytes"]
                        while left:
                            data = src.read(min(left, BATCH))
                            if not data:
                                raise OSError(f"{p['piece']} is shorter than it was")
                            dst.write(data)
                            left -= len(data)
                yield b.select(["whole"])

        own = Window.partitionBy("file").orderBy("part")
        pieces = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(len(folders)).mapInArrow(listed, "file string, part long, piece string, bytes long")
        placed = pieces.withColumn("at", F.sum(F.col("bytes") + gap).over(own) - F.col("bytes") - gap).withColumn("whole", F.sha1("file"))
        table = cut(placed, "pieces")
        table.select("piece", "at", "bytes", "whole").repartition(len(folders), "piece").mapInArrow(copy, "whole string").write.format("noop").mode("overwrite").save()
        ends = {}
        if parquet:
            for f in table.groupBy("file", "whole").agg(F.array_sort(F.collect_list(F.struct("part", "piece", "at", "bytes"))).alias("pieces")).toLocalIterator():
                ends[f["whole"]] = _footer(spark, [(p["piece"], p["at"]) for p in f["pieces"]])
        files = table.groupBy("file", "whole").agg((F.sum(F.col("bytes") + gap) - gap).alias("size"))

        def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for f in b.to_pylist():
                    old, new = f"{job}/whole-{f['whole']}", f"{root}/{f['file']}"
                    if os.path.exists(new) and (skip or not os.path.exists(old)):  # or an earlier attempt of this task has named it
                        continue
                    if os.path.getsize(old) < first + f["size"]:
                        raise OSError(f"{f['file']} is not whole")
                    with open(old, "r+b") as out:
                        if parquet:
                            out.write(MAGIC)
                        out.seek(first + f["size"])
                        out.write(ends.get(f["whole"], end))
                        out.truncate()
                    os.makedirs(posixpath.dirname(new), exist_ok=True)
                    os.replace(old, new)
                yield b.select(["file"])

        files.repartition("file").mapInArrow(name, "file string").write.format("noop").mode("overwrite").save()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        store, root = self.store()
        if store.get_file_info(f"{root}/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.job}")
        self._empty(store, root)

    def _empty(self, store: Any, root: str) -> None:
        """Remove the folder of attempts once no job uses it."""
        from pyarrow import fs

        if not store.get_file_info(fs.FileSelector(f"{root}/{ATTEMPTS}", allow_not_found=True)):
            if store.get_file_info(f"{root}/{ATTEMPTS}").type == fs.FileType.Directory:
                store.delete_dir(f"{root}/{ATTEMPTS}")


def _footer(spark: SparkSession, pieces: list[tuple[str, int]]) -> bytes:
    """The end of a Parquet file whose row groups are those of ``pieces`` (path and by how many bytes it moves), by Parquet's own library."""
    jvm = spark._jvm
    util, whole = jvm.org.apache.parquet.format.Util, None
    for path, at in pieces:
        with open(path, "rb") as f:
            f.seek(-8, os.SEEK_END)
            size = int.from_bytes(f.read(4), "little")
            f.seek(-8 - size, os.SEEK_END)
            meta = util.readFileMetaData(jvm.java.io.ByteArrayInputStream(f.read(size)))
        for g in meta.getRow_groups():
            g.unsetOrdinal()
            if g.isSetFile_offset() and g.getFile_offset():
                g.setFile_offset(g.getFile_offset() + at)
            for c in g.getColumns():
                m = c.getMeta_data()
                m.setData_page_offset(m.getData_page_offset() + at)
                if m.isSetDictionary_page_offset():
                    m.setDictionary_page_offset(m.getDictionary_page_offset() + at)
                if c.getFile_offset():
                    c.setFile_offset(c.getFile_offset() + at)
        if whole is None:
            whole = meta
        else:
            whole.setNum_rows(whole.getNum_rows() + meta.getNum_rows())
            whole.getRow_groups().addAll(meta.getRow_groups())
    out = jvm.java.io.ByteArrayOutputStream()
    util.writeFileMetaData(whole, out)
    body = bytes(out.toByteArray())
    return body + len(body).to_bytes(4, "little") + MAGIC


class NamedFiles(DataSource):
    """Writes the column ``file``'s names under option ``path``: ``value`` as text (options ``between`` rows and ``end``), or the other columns as Parquet (option ``kind``)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), overwrite)


def write_named(rows: DataFrame, path: str, file: Column | str, value: Column | str | None = "value", order: list[str] | None = None, mode: str = "append", spread: bool = False, **options: str) -> None:
    """Write ``rows`` to the files they name, each file's rows in order; without ``value`` as Parquet of the other columns.

    A file is written by one task; its rows stream by. Give no file more than one task should write, or ``spread`` it: then all tasks write all files, by ranges of the order (any, if none is given).
    """
    name = F.col(file) if isinstance(file, str) else file
    keys = {f"__order{i}": F.col(c) for i, c in enumerate(order or [])}
    if value is None:  # a column ``file`` of the rows' own gives way to the name
        content, options = [F.col(c) for c in rows.columns if c != "file"], {"kind": "parquet", **options}
    else:
        content = [(F.col(value) if isinstance(value, str) else value).cast("string").alias("value")]
    named = rows.select(name.alias("file"), *content, *[c.alias(k) for k, c in keys.items()])
    kept = [c for c in named.columns if c not in keys]
    rows.sparkSession.dataSource.register(NamedFiles)
    options = {**options, "path": path, "job": uuid.uuid4().hex}
    if spread and (path.startswith("file:") or "://" not in path):
        options["pieces"] = "yes"
        if not keys:  # any order will do, so rows are dealt by where they come from
            named, keys = named.withColumn("__order0", F.monotonically_increasing_id()), {"__order0": None}
        dealt = named.repartitionByRange("file", *keys)
    else:
        dealt = named.repartition("file")
    dealt.sortWithinPartitions("file", *keys).select(*kept).write.format(FORMAT).mode(mode).options(**options).save()
    _Writer(options, mode == "overwrite").publish(rows.sparkSession)


def written(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(file, bytes): what is under ``path``, names relative to it; no contents are read. Tasks list, a folder each, level by level; names that begin with ``_`` or ``.`` are left out, as Spark does."""
    from storyloom.plans.lineage import cut

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        for b in batches:
            for folder in b.column("folder").to_pylist():
                found = store.get_file_info(fs.FileSelector(f"{root}/{folder}" if folder else root, allow_not_found=True))
                for s in range(0, len(found), ROWS):
                    own = [f for f in found[s : s + ROWS] if not (f.base_name.startswith(".") or f.base_name.startswith("_") and "=" not in f.base_name)]
                    sizes = [None if f.type == fs.FileType.Directory else f.size for f in own]
                    yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{f.base_name}" if folder else f.base_name for f in own], pa.string()), pa.array(sizes, pa.int64())], names=["file", "bytes"])

    level, levels = spark.range(1).select(F.lit("").alias("folder")), []
    while n := level.count():
        levels.append(cut(level.repartition(min(n, 1000)).mapInArrow(listed, "file string, bytes long"), "listing"))
        level = levels[-1].where("bytes is null").select(F.col("file").alias("folder"))
    return reduce(DataFrame.unionByName, levels).where(F.col("bytes").isNotNull() & F.col("file").endswith(suffix))


def read_files(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(file, content): the whole content of each file under ``path`` as text. Tasks read, each some thousand files or some MB; a batch holds ``BATCH`` bytes, or one file."""
    files = written(spark, path, suffix)
    total = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    parts = max(1, -(-total["n"] // FILES), -(-total["bytes"] // GROUP))

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        names: list[str] = []
        held: list[bytes] = []
        size = 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(held, pa.binary())], names=["file", "content"])
        for b in batches:
            for name in b.column("file").to_pylist():
                with store.open_input_stream(f"{root}/{name}") as f:
                    held.append(f.read())
                names.append(name)
                size += len(held[-1])
                if size >= BATCH:
                    yield batch()
                    names, held, size = [], [], 0
        yield batch()

    read = files.select("file").repartition(parts, "file").mapInArrow(contents, "file string, content binary")
    return read.select("file", F.col("content").cast("string").alias("content"))


# what the engine writes


def write_scenes(scenes: DataFrame, path: str, book: str = "book", scene: str = "scene_id", text: str = "content", done: DataFrame | None = None) -> None:
    """``{book}/{scene_id}.txt``, a scene a file. ``done``: (book) of inputs that have their folder already and are left out."""
    todo = scenes.join(done.select(book).distinct(), book, "left_anti") if done is not None else scenes
    write_named(todo, path, F.concat_ws("/", safe_file_name(F.col(book).cast("string")), F.concat(safe_file_name(scene), F.lit(".txt"))), text, end="")


def write_numbered(scenes: DataFrame, path: str, book: str, order: list[str], text: str = "content") -> None:
    """``{book}/{n}.txt`` from 1 in order; scenes without text are not written and take no number."""
    from storyloom.sources.writers import scene_texts

    numbered = scene_texts(scenes, order, text, book)
    write_named(numbered, path, F.concat(safe_file_name(F.col(book).cast("string")), F.lit("/"), F.col("n").cast("string"), F.lit(".txt")), text, end="")


def write_json_files(rows: DataFrame, path: str, book: str = "book", stem: str = "stem", suffix: str = ".json") -> None:
    """``{book}/{stem}{suffix}``: the other columns of a row as one JSON object, null fields left out."""
    fields = F.to_json(F.struct(*[c for c in rows.columns if c not in (book, stem)]))
    write_named(rows, path, F.concat(safe_file_name(F.col(book).cast("string")), F.lit("/"), safe_file_name(F.col(stem).cast("string")), F.lit(suffix)), fields, end="")


def write_row_parts(rows: DataFrame, path: str, stem: str, order: str, most: int = 0) -> None:
    """``{stem}.jsonl``, or ``{stem}_part{i}.jsonl`` of ``most`` rows each if there are more."""
    from storyloom.operators.chunking import row_shards

    single = most <= 0 or rows.limit(most + 1).count() <= most
    sharded = rows.withColumn("_shard", F.lit(0)) if single else row_shards(rows, most, order, "_shard")
    name = F.lit(f"{stem}.jsonl") if single else F.concat(F.lit(f"{stem}_part"), F.col("_shard").cast("string"), F.lit(".jsonl"))
    write_named(sharded, path, name, F.to_json(F.struct(*rows.columns)), [order], spread=single)


def write_byte_shards(sharded: DataFrame, path: str, order: list[str], shard: str = "shard", part: str | None = None) -> None:
    """``shard_001.jsonl`` and so on, in a folder of each ``part`` if there is one, from rows with shard numbers."""
    name = F.concat(F.lit("shard_"), F.lpad(F.col(shard).cast("string"), F.greatest(F.lit(3), F.length(F.col(shard).cast("string"))), F.lit("0")), F.lit(".jsonl"))
    name = name if part is None else F.concat(F.col(part).cast("string"), F.lit("/"), name)
    hidden = {shard, part}
    write_named(sharded, path, name, F.to_json(F.struct(*[c for c in sharded.columns if c not in hidden])), order)


def write_train_files(rows: DataFrame, path: str, files: int = 1, order: list[str] | None = None, mode: str = "append") -> None:
    """``train-00000-of-00001.parquet``: rows dealt evenly to so many files."""
    number = F.pmod(F.monotonically_increasing_id(), F.lit(files)) if files > 1 else F.lit(0)
    name = F.concat(F.lit("train-"), F.lpad(number.cast("string"), 5, "0"), F.lit(f"-of-{files:05d}.parquet"))
    write_named(rows, path, name, None, order, mode, spread=True)


def annotation_files(annotations: DataFrame) -> DataFrame:
    """(file, text) of known works: the world view, a card for each character, and an index of both. Needs title, unknown, worldview and character_cards."""
    # fixed values: file names
    world, card, index = "世界观.md", "角色卡-", "index.json"
    known = annotations.where("not coalesce(unknown, false)").select(safe_file_name("title").alias("folder"), "worldview", F.coalesce("character_cards", F.array().cast(annotations.schema["character_cards"].dataType)).alias("cards"))
    file_of = lambda c: F.concat(F.lit(card), safe_title(c["profile"]["name"]), F.lit(".md"))
    texts = F.transform("cards", lambda c: F.struct(file_of(c).alias("file"), character_card_markdown(c).alias("text")))
    # of two cards with one file name the later one stays
    later = F.filter(texts, lambda x, i: ~F.exists(F.slice(texts, i + 2, F.size(texts)), lambda y: y["file"] == x["file"]))
    listed = F.map_from_entries(F.transform(F.array_distinct(F.transform("cards", lambda c: c["profile"]["name"])), lambda n: F.struct(n.alias("k"), F.concat(F.lit(card), safe_title(n), F.lit(".md")).alias("v"))))
    about = F.to_json(F.struct(F.lit(world).alias("world_view"), listed.alias("characters")))
    whole = F.array(F.struct(F.lit(world).alias("file"), F.replace(F.coalesce("worldview", F.lit("")), F.lit("\\n"), F.lit("\n")).alias("text")), F.struct(F.lit(index).alias("file"), about.alias("text")))
    return known.select("folder", F.explode(F.concat(whole, later)).alias("x")).select(F.concat_ws("/", "folder", "x.file").alias("file"), "x.text")


def profile_files(world: DataFrame, cards: DataFrame) -> DataFrame:
    """(file, text) of books: ``world_settings.md`` from (book, text), and ``{name}.md`` from (book, name, text)."""
    book = safe_file_name(F.col("book").cast("string"))
    own = cards.select(F.concat_ws("/", book, F.concat(safe_file_name("name"), F.lit(".md"))).alias("file"), "text")
    return world.select(F.concat_ws("/", book, F.lit("world_settings.md")).alias("file"), "text").unionByName(own).where("coalesce(text, '') <> ''")


def write_texts(files: DataFrame, path: str, **options: str) -> None:
    """Rows (file, text), one a file. Files that exist stay with ``exists="skip"``."""
    write_named(files, path, "file", "text", end="", **options)
