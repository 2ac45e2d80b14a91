"""Writers of folders: JSON lines, Parquet with metadata and CSV. ``named`` writes files under names of their own."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.sources.named import write_train_files


def write_jsonl(rows: DataFrame, path: str, nulls: bool = False, mode: str = "overwrite") -> None:
    """One object per line, characters as they are. Null fields are left out unless ``nulls``."""
    rows.write.mode(mode).option("ignoreNullFields", not nulls).json(path)


def row_bytes(rows: DataFrame) -> Column:
    """Size of a row's JSON line, newline included."""
    return (F.octet_length(F.to_json(F.struct(*rows.columns))) + 1).cast("long")


def write_dataset(rows: DataFrame, path: str, name: str, files: int | None = None) -> None:
    """``data`` as Parquet, and ``dataset_info`` and ``metadata`` with the row count and features. With ``files``, as ``train-00000-of-0000n.parquet``."""
    if files:
        write_train_files(rows, f"{path}/data", files, mode="overwrite")
    else:
        rows.write.mode("overwrite").parquet(f"{path}/data")
    spark = rows.sparkSession
    n = spark.read.parquet(f"{path}/data").count()
    features = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    put(spark, f"{path}/dataset_info.json", json.dumps({"dataset_name": name, "features": features, "splits": {"train": {"name": "train", "num_examples": n}}}, ensure_ascii=False))
    put(spark, f"{path}/metadata.json", json.dumps({"name": name, "count": n, "features": list(features)}, ensure_ascii=False))


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file through Hadoop's file system, so that any store works."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def scene_texts(rows: DataFrame, order: list[str], text: str = "content", part: str = "book") -> DataFrame:
    """(part, n, content): non-empty scenes numbered from 1 in each part."""
    from pyspark.sql import Window

    return rows.where(F.col(text) != "").withColumn("n", F.row_number().over(Window.partitionBy(part).orderBy(*order)))


def summarised_text(preface: Column, body: Column, summary: Column) -> Column:
    """A scene with what came before and its summary."""
    # fixed values: section headers
    return F.concat(F.lit("##前情提要\n"), preface, F.lit("\n##正文\n"), body, F.lit("\n##总结\n"), summary)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_ndjson(rows: DataFrame, path: str, name: str) -> str:
    """A dataset's export under its name, spaces as underscores; returns the folder."""
    target = f"{path}/{name.replace(' ', '_')}.jsonl"
    write_jsonl(rows, target)
    return target
