"""Readers: JSON lines, text, JSON documents, CSV, Markdown and book folders."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions.text import strip
from storyloom.schemas import CHATML_ROW, TEXT_ROW
from storyloom.sources import named

CORRUPT = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str = TEXT_ROW, recursive: bool = False, suffix: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): lines of white space are skipped; those that are not one whole JSON object go to the rejects with their file."""
    # read as text first: rejects then need no cache of a parsed scan
    text = spark.read.option("recursiveFileLookup", str(recursive).lower())
    text = (text.option("pathGlobFilter", f"*{suffix}") if suffix else text).text(path).withColumn("_line", strip("value")).where("_line <> ''")
    parsed = text.withColumn("r", F.from_json("_line", f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT}))
    # the parser stops behind the first value, so a mark behind the line, which no line can hold itself, shows that all of it was read
    mark = F.md5("_line")
    read = F.from_json(F.concat(F.lit('{"x":'), "_line", F.lit(',"mark":"'), mark, F.lit('"}')), "x string, mark string")["mark"]
    whole = F.col("_line").startswith("{") & F.coalesce(read == mark, F.lit(False))
    fine = whole & F.col("r").isNotNull() & F.col(f"r.{CORRUPT}").isNull()
    good = parsed.where(fine).select("r.*").drop(CORRUPT)
    bad = parsed.where(~F.coalesce(fine, F.lit(False))).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))
    return good, bad


def read_chatml(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of JSON lines whose ``messages`` is a list."""
    good, bad = read_jsonl(spark, path, CHATML_ROW)
    return good.where("messages is not null"), bad


def count_lines(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count()


def read_text_lines(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """(file, line_no, line) in file order."""
    return read_whole_text(spark, path, suffix).select("file", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("line_no", "line"))


def read_whole_text(spark: SparkSession, path: str, suffix: str = ".txt", recursive: bool = True) -> DataFrame:
    """(path, book, file, stem, text): one row per file; the book is its folder."""
    files = spark.read.option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", f"*{suffix}").text(path, wholetext=True)
    return _named(files.withColumnRenamed("value", "text"), suffix)


def read_named_texts(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """``read_whole_text`` of very many files, as ``named`` writes them: they are listed by tasks, so the driver holds none of their names. (book, file, stem, text)."""
    at = F.split("file", "/")
    file = F.element_at(at, -1)
    book = F.when(F.size(at) > 1, F.element_at(at, -2)).otherwise(posixpath.basename(path.rstrip("/")))
    return named.read_files(spark, path, suffix).select(book.alias("book"), file.alias("file"), F.left(file, F.length(file) - len(suffix)).alias("stem"), F.col("content").alias("text"))


def read_named_documents(spark: SparkSession, path: str, schema: str, suffix: str) -> DataFrame:
    """``read_json_documents`` of very many files. (book, file, stem) and the fields, null in unreadable ones."""
    return read_named_texts(spark, path, suffix).select("book", "file", "stem", F.from_json("text", schema).alias("d")).select("book", "file", "stem", "d.*")


def _named(files: DataFrame, suffix: str) -> DataFrame:
    # the metadata's address is that of a URI: spaces and percent signs are escaped, plus signs aren't
    at = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    file = F.regexp_extract(at, r"([^/]+)$", 1)
    return files.select(at.alias("path"), F.regexp_extract(at, r"([^/]+)/[^/]+$", 1).alias("book"), file.alias("file"), F.regexp_replace(file, suffix.replace(".", r"\.") + "$", "").alias("stem"), *files.columns)


def read_json_documents(spark: SparkSession, path: str, schema: str, suffix: str) -> DataFrame:
    """One JSON document per file behind path, book, file and stem; unreadable ones have null fields."""
    files = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").json(path)
    return _named(files, suffix)


def read_csv(spark: SparkSession, path: str, schema: str | None = None, limit: int | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    rows = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return rows.limit(limit) if limit else rows


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(book, name, text): profiles by file stem."""
    return read_whole_text(spark, path, ".md").select("book", F.col("stem").alias("name"), "text")


def alias_map(characters: DataFrame) -> DataFrame:
    """(name, alias): trimmed, without empty aliases; for documents read as a list of characters."""
    trimmed = F.filter(F.transform("alias", strip), lambda x: x != "")
    return characters.select(strip("name").alias("name"), F.coalesce(trimmed, F.array().cast("array<string>")).alias("alias")).where("name <> ''")


def main_character_names(value: str = "value"):
    """Names from a JSON index: keys of ``characters``, or a list itself, else none."""
    v = F.col(value)
    keys = F.map_keys(F.from_json(F.get_json_object(v, "$.characters"), "map<string,string>"))
    return F.coalesce(keys, F.from_json(v, "array<string>"), F.array().cast("array<string>"))


def segments(texts: DataFrame, *companions: DataFrame, key: tuple[str, str] = ("book", "stem")) -> DataFrame:
    """Texts that have all companion files, in order."""
    for c in companions:
        texts = texts.join(c.select(*key), list(key), "left_semi")
    return texts.orderBy(*key)


def not_done(rows: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Rows without an output yet."""
    return rows.join(done.select(*key).distinct(), key, "left_anti")
