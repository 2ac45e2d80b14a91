"""The annotation layer as functions of DataFrames: joins, filters, counts, and mutations as new table versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions.text import preview

STATUSES = ("pending", "annotated")
SOURCES = ("raw", "annotated")


def like_ascii(c: Column | str, needle: str) -> Column:
    """A case-insensitive LIKE for ASCII letters; % and _ in the needle are wildcards."""
    x = F.col(c) if isinstance(c, str) else c
    low = lambda v: F.translate(v, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    pattern = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in needle).replace("\\", "\\\\")
    return low(x).like(f"%{pattern}%")


def matching(records: DataFrame, search: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Records by a text in id or name and an inclusive range of text times; a null time is outside any range."""
    tests = []
    if search:
        tests.append(like_ascii("id", search) | like_ascii("name", search))
    if start:
        tests.append(F.col("timestamp") >= start)
    if end:
        tests.append(F.col("timestamp") <= end)
    return records.where(reduce(lambda a, b: a & b, tests)) if tests else records


def of_known(rows: DataFrame, column: str, value: str | None, known: tuple[str, ...]) -> DataFrame:
    """Rows with a value, if the value is one of the known ones; else all."""
    return rows.where(F.col(column) == value) if value in known else rows


def with_values_like(rows: DataFrame, needle: str | None, column: str = "values") -> DataFrame:
    return rows.where(like_ascii(column, needle)) if needle else rows


def with_previews(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({f"{c}_preview": preview(c) for c in columns}).drop(*columns)


def queue_summary(queues: DataFrame, schemas: DataFrame, items: DataFrame) -> DataFrame:
    """Queues that have a schema, with its name and counts of items and annotated items. Items are counted before the join."""
    counts = items.groupBy("queue_id").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "annotated").alias("annotated"))
    named = queues.join(schemas.select(F.col("id").alias("schema_id"), F.col("name").alias("schema_name")), "schema_id")
    joined = named.join(counts, named["id"] == counts["queue_id"], "left")
    return joined.select("id", "name", "schema_id", "schema_name", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("annotated", F.lit(0)).alias("annotated"))


def queue_detail(queues: DataFrame, schemas: DataFrame, fields: DataFrame, queue_id: int) -> DataFrame:
    """A queue with its schema's name and its fields in order, options decoded."""
    q = queues.where(F.col("id") == queue_id).join(schemas.select(F.col("id").alias("schema_id"), F.col("name").alias("schema_name")), "schema_id")
    return q.select("id", "name", "schema_id", "schema_name").join(schema_fields(fields), "schema_id", "left").orderBy("order_idx", "field_id")


def schema_fields(fields: DataFrame) -> DataFrame:
    return fields.select("schema_id", F.col("id").alias("field_id"), F.col("name").alias("field_name"), "label", "type", F.from_json("options", "array<string>").alias("options"), "order_idx")


def queue_items(items: DataFrame, records: DataFrame, queue_id: int, status: str | None = None) -> DataFrame:
    """A queue's items with their records."""
    own = of_known(items.where(F.col("queue_id") == queue_id), "status", status, STATUSES)
    return own.select(F.col("id").alias("item_id"), "record_id", "status").join(records.withColumnRenamed("id", "record_id"), "record_id")


def dataset_summary(datasets: DataFrame, items: DataFrame) -> DataFrame:
    """Datasets with their number of items; 0 for empty ones."""
    counts = items.groupBy(F.col("dataset_id").alias("id")).agg(F.count("*").alias("n"))
    return datasets.join(counts, "id", "left").withColumn("items", F.coalesce("n", F.lit(0))).drop("n")


def dataset_items(items: DataFrame, records: DataFrame, annotations: DataFrame, dataset_id: int, source: str | None = None) -> DataFrame:
    """A dataset's items with records, and annotation values where their queue item has any."""
    own = of_known(items.where(F.col("dataset_id") == dataset_id), "source", source, SOURCES)
    own = own.select(F.col("id").alias("item_id"), "record_id", "source", "queue_item_id")
    full = own.join(records.withColumnRenamed("id", "record_id"), "record_id")
    return full.join(annotations.select("queue_item_id", "values"), "queue_item_id", "left")


def export_dataset(items: DataFrame, records: DataFrame, annotations: DataFrame, dataset_id: int) -> DataFrame:
    """One row per item: messages (empty if unreadable), annotations for annotated items, metadata if any. One left join, no look-ups."""
    rows = dataset_items(items, records, annotations, dataset_id)
    messages = F.coalesce(F.from_json("input", "messages array<struct<role: string, content: string>>")["messages"], F.array().cast("array<struct<role: string, content: string>>"))
    return rows.select(
        "item_id", "record_id", messages.alias("messages"),
        F.when(F.col("source") == "annotated", F.col("values")).alias("annotations"),
        F.when(~F.coalesce("metadata", F.lit("")).isin("", "null", "{}"), F.col("metadata")).alias("metadata"),
    )


def insert_or_ignore(table: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """``table`` and the new rows whose key is not there yet; the first of equal new keys wins."""
    first = new.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(order))).where("_n = 1").drop("_n", *([] if order in table.columns else [order]))
    return table.unionByName(first.join(table, key, "left_anti"), allowMissingColumns=True)


def insert_counts(table: DataFrame, new: DataFrame, key: list[str], parents: DataFrame | None = None, parent_key: str | None = None) -> DataFrame:
    """(added, skipped): rows that would be inserted; equal keys, known keys and rows without a parent are skipped."""
    fit = new.join(parents, parent_key, "left_semi") if parents is not None else new
    added = fit.select(*key).distinct().join(table, key, "left_anti").agg(F.count("*").alias("added"))
    return added.crossJoin(F.broadcast(new.agg(F.count("*").alias("given")))).select("added", (F.col("given") - F.col("added")).alias("skipped"))


def import_records(rows: DataFrame, order: str) -> DataFrame:
    """Records from uploaded rows: structured columns as JSON text (null as ``null``), a time from either name, a missing id as empty."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null")) if c in rows.columns else F.lit("null")
    when = [F.nullif(F.col(c), F.lit("")) for c in ("timestamp", "startTime") if c in rows.columns]
    return rows.select(F.coalesce("id", F.lit("")).alias("id"), *[F.col(c) for c in ("type", "name") if c in rows.columns], F.coalesce(*when, F.lit(None).cast("string")).alias("timestamp"), text("input").alias("input"), text("output").alias("output"), text("metadata").alias("metadata"), order)


def upsert(table: DataFrame, new: DataFrame, key: str, values: list[str]) -> DataFrame:
    """New values over old ones by key, in one full outer join."""
    a, b = table.select(key, *values), new.select(key, *[F.col(v).alias(f"_{v}") for v in values], F.lit(True).alias("_new"))
    return a.join(b, key, "full_outer").select(key, *[F.when(F.col("_new"), F.col(f"_{v}")).otherwise(F.col(v)).alias(v) for v in values])


def annotate(items: DataFrame, annotations: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Annotations with the new values, and items of which those annotated say so. ``new``: (queue_item_id, values)."""
    marked = items.join(new.select(F.col("queue_item_id").alias("id"), F.lit(True).alias("_done")).distinct(), "id", "left")
    marked = marked.withColumn("status", F.when(F.col("_done"), "annotated").otherwise(F.col("status"))).drop("_done")
    return upsert(annotations, new, "queue_item_id", ["values"]), marked


def enqueue_all(items: DataFrame, records: DataFrame, queue_id: int, search: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """(queue_id, record_id, status): new pending items for all matching records that the queue lacks."""
    found = matching(records, search, start, end).select(F.lit(queue_id).cast("long").alias("queue_id"), F.col("id").alias("record_id"))
    return found.distinct().join(items, ["queue_id", "record_id"], "left_anti").withColumn("status", F.lit("pending"))


def add_annotated(items: DataFrame, dataset: DataFrame, wanted: DataFrame, dataset_id: int) -> DataFrame:
    """(added, duplicates, skipped) for queue items put into a dataset: only annotated ones may enter. ``wanted``: (queue_item_id)."""
    found = wanted.join(items.select(F.col("id").alias("queue_item_id"), "record_id", "status"), "queue_item_id", "left")
    have = dataset.where(F.col("dataset_id") == dataset_id).select("record_id", F.lit(True).alias("_have")).distinct()
    rows = found.join(have, "record_id", "left").withColumn("_ok", F.coalesce(F.col("status") == "annotated", F.lit(False)))
    rows = rows.withColumn("_first", F.row_number().over(Window.partitionBy("record_id", "_ok").orderBy("queue_item_id")) == 1)
    new = F.col("_ok") & F.col("_have").isNull() & F.col("_first")
    return rows.agg(F.count_if(new).alias("added"), F.count_if(F.col("_ok") & ~new).alias("duplicates"), F.count_if(~F.col("_ok")).alias("skipped"))


def delete_cascade(rows: DataFrame, gone: DataFrame, key: str, ref: str) -> DataFrame:
    """Rows that do not refer to a deleted key."""
    return rows.join(gone.select(F.col(key).alias(ref)).distinct(), ref, "left_anti")


def replace_schema(schemas: DataFrame, fields: DataFrame, schema_id: int, name: str, new_fields: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A schema renamed and its fields replaced."""
    renamed = schemas.withColumn("name", F.when(F.col("id") == schema_id, F.lit(name)).otherwise(F.col("name")))
    return renamed, fields.where(F.col("schema_id") != schema_id).unionByName(new_fields, allowMissingColumns=True)


def repoint(items: DataFrame, survivors: DataFrame, container: str) -> DataFrame:
    """Items whose records were merged point to the survivor; an item the container has already is dropped. ``survivors``: (record_id, survivor)."""
    moved = items.join(survivors, "record_id", "left").withColumn("_to", F.coalesce("survivor", "record_id"))
    w = Window.partitionBy(container, "_to").orderBy(F.when(F.col("_to") == F.col("record_id"), 0).otherwise(1), "id")
    return moved.withColumn("_n", F.row_number().over(w)).where("_n = 1").withColumn("record_id", F.col("_to")).drop("_n", "_to", "survivor")


def typed_values(rows: DataFrame, fields: list[tuple[str, str]], values: str = "values") -> DataFrame:
    """Annotation values by field type: boolean, score (1 to 10, 5 by default), number, category or text."""
    v = F.try_parse_json(F.col(values))
    kinds = {"boolean": "boolean", "score": "int", "number": "double"}
    out = {}
    for name, kind in fields:
        got = F.try_variant_get(v, f"$.{name}", kinds.get(kind, "string"))
        out[name] = F.greatest(F.lit(1), F.least(F.lit(10), F.coalesce(got, F.lit(5)))) if kind == "score" else F.coalesce(got, F.lit(False)) if kind == "boolean" else got
    return rows.withColumns(out)


# --- catalogue ----------------------------------------------------------------------------------------------------


def title_column(rows: DataFrame) -> str | None:
    return next((c for c in ("Title", "name", "title") if c in rows.columns), None)


def unprocessed(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Rows whose title is not in ``done``; rows without a title stay."""
    key = title_column(rows)
    if key is None:
        raise ValueError("no Title, name or title column")
    other = title_column(done)
    return rows if other is None else rows.join(done.select(F.col(other).alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def tag_vocabulary(*frames: DataFrame) -> DataFrame:
    """(tag): distinct trimmed tags of all frames."""
    tags = reduce(DataFrame.unionAll, [f.select(F.explode(F.split("tags", ",")).alias("tag")) for f in frames])
    return tags.select(F.trim("tag").alias("tag")).where("tag <> ''").distinct()


def augment_lookup(rows: DataFrame, results: DataFrame, order: str, uid: str = "Uid") -> DataFrame:
    """Rows with genre, tags, summary and unknown by Uid. The last of equal result ids counts; a miss is an error row."""
    w = Window.partitionBy(uid).orderBy(F.col(order).desc())
    last = results.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(F.col(uid), F.col("genre").alias("_genre"), F.array_join("tags", ",").alias("_tags"), F.col("summary").alias("_summary"), F.col("unknown").alias("_unknown"))
    joined = rows.drop("genre", "tags", "summary", "unknown").join(last, uid, "left")
    # fixed values: what stands for a missing or unknown work
    pick = lambda c, none, miss: F.when(F.col("_unknown").isNull(), miss).when(F.col("_unknown"), none).otherwise(F.col(c))
    out = {"genre": pick("_genre", "未知", "Error"), "tags": pick("_tags", "未知", "Error"), "summary": pick("_summary", "未知作品", "Mismatch/Error"), "unknown": F.coalesce("_unknown", F.lit(True))}
    return joined.withColumns(out).drop("_genre", "_tags", "_summary", "_unknown")
