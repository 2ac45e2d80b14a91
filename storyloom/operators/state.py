"""Ordered state folds over story blocks, running numbers and scene flushes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions.ordered import stream_fold
from storyloom.operators.messages import ordered_join

UPDATES = ("scene_change", "status_update", "relationship_update", "item_update")


def _prefix(part: list[str], order: str) -> Window:
    return Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def status_fold(blocks: DataFrame, part: list[str], order: str, fields: list[str]) -> DataFrame:
    """The last known value of each field per key: one aggregate, whatever the number of updates."""
    last = [F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in fields]
    return blocks.groupBy(*part).agg(*last)


def status_history(blocks: DataFrame, part: list[str], order: str, fields: list[str]) -> DataFrame:
    """Every block with the state behind it."""
    w = _prefix(part, order)
    return blocks.withColumns({f: F.last(f, ignorenulls=True).over(w) for f in fields})


def relationship_fold(blocks: DataFrame, story: list[str], order: str) -> DataFrame:
    """(story, character, target, opinion, events): the last opinion that says something, and all events in order."""
    said = F.nullif("opinion", F.lit(""))
    fit = blocks.where("coalesce(character, '') <> '' and coalesce(target, '') <> ''").withColumn("_event", F.nullif("new_event", F.lit("")))
    events = F.array_sort(F.collect_list(F.when(F.col("_event").isNotNull(), F.struct(order, F.col("_event").alias("e")))))
    return fit.groupBy(*story, "character", "target").agg(F.max_by(said, F.when(said.isNotNull(), F.col(order))).alias("opinion"), F.transform(events, lambda x: x["e"]).alias("events"))


def item_fold(blocks: DataFrame, story: list[str], order: str) -> DataFrame:
    """(story, character, item_name, state): items held at the end.

    What an item becomes depends only on its own updates: the last removal clears it; from there the first add or modify makes it
    and later modifies with a state change it. So each item is a small ordered fold of its own.
    """
    fit = blocks.where("coalesce(character, '') <> '' and coalesce(item_name, '') <> '' and action in ('add', 'remove', 'modify')")
    ops = F.array_sort(F.collect_list(F.struct(order, "action", "new_state")))
    zero = F.struct(F.lit(False).alias("held"), F.lit("").alias("state"))

    def step(a: Column, x: Column) -> Column:
        new = F.coalesce(x["new_state"], F.lit(""))
        made = F.struct(F.lit(True).alias("held"), new.alias("state"))
        changed = F.struct(F.lit(True).alias("held"), F.when(new != "", new).otherwise(a["state"]).alias("state"))
        return F.when(x["action"] == "remove", zero).when(~a["held"], made).when(x["action"] == "modify", changed).otherwise(a)

    folded = fit.groupBy(*story, "character", "item_name").agg(F.aggregate(ops, zero, step).alias("s"))
    return folded.where("s.held").select(*story, "character", "item_name", "s.state")


def of_main(rows: DataFrame, main: DataFrame, story: list[str], name: str = "character") -> DataFrame:
    """Rows of main characters. ``main``: (story, name)."""
    return rows.join(main.select(*story, F.col("name").alias(name)).distinct(), [*story, name], "left_semi")


def line_offsets(blocks: DataFrame, part: str, order: str, count: str = "line_count", start: int = 0) -> DataFrame:
    """Blocks with ``first_line``: start and the line counts before."""
    w = Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("first_line", (F.lit(start) + F.coalesce(F.sum(count).over(w), F.lit(0))).cast("long"))


def scene_numbers(blocks: DataFrame, part: str, order: str, kind: str = "dataType") -> DataFrame:
    """Blocks with ``scene``: the scene changes so far."""
    return blocks.withColumn("scene", F.sum(F.when(F.col(kind) == "scene_change", 1).otherwise(0)).over(_prefix([part], order)).cast("long"))


def scene_flush(blocks: DataFrame, part: str, order: str) -> DataFrame:
    """(part, scene, start_line, end_line, n_blocks): scenes that are written. One of updates alone is dropped unless it is the last."""
    numbered = line_offsets(scene_numbers(blocks, part, order), part, order)
    agg = numbered.groupBy(part, "scene").agg(F.min("first_line").alias("start_line"), F.max(F.col("first_line") + F.col("line_count")).alias("_end"), F.count("*").alias("n_blocks"), F.max((~F.col("dataType").isin(*UPDATES)).cast("int")).alias("_real"))
    last = F.max("scene").over(Window.partitionBy(part))
    kept = agg.withColumn("_last", last).where("_real = 1 or scene = _last")
    return kept.select(part, "scene", "start_line", F.greatest("_end", F.col("start_line") + 1).alias("end_line"), "n_blocks")


def known_characters(blocks: DataFrame, part: str, order: str) -> DataFrame:
    """(part, names): speakers, actors and characters in order of first mention; combined names are split."""
    w = F.posexplode(F.filter(F.flatten(F.transform(F.array("speaker", "actor", "character"), lambda x: F.split(F.coalesce(x, F.lit("")), "/"))), lambda x: x != ""))
    first = blocks.select(part, order, w.alias("p", "name")).groupBy(part, "name").agg(F.min(F.struct(order, "p")).alias("at"))
    return first.groupBy(part).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda x: x["name"]).alias("names"))


def segment_scenes(segments: DataFrame, part: str, order: list[str]) -> DataFrame:
    """(part, scene, content): segments of line batches as scenes. A batch's first segment goes on with the scene before, later ones open new ones. Needs batch, segment (from 0) and text."""
    rows = segments.withColumn("content", F.replace("text", F.lit("\\n"), F.lit("\n"))).withColumn("_o", F.struct(*order))
    new = F.when(F.col("segment") > 0, 1).otherwise(0)
    numbered = rows.withColumn("scene", F.sum(new).over(_prefix([part], "_o")) + 1)
    joined = numbered.groupBy(part, F.col("scene").cast("long").alias("scene")).agg(ordered_join("content", "_o").alias("content"))
    return joined.where("content <> ''")


def context_accumulate(rows: DataFrame, part: str, order: str, text: str, limit: int = 700, size: int = 500, summarise=None) -> DataFrame:
    """(part, order, context): texts before each row by line. Once they exceed ``limit`` the summary of that moment stays for good.

    ``summarise``: Column -> Column; by default the first ``size`` characters.
    """
    w = Window.partitionBy(part).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    # only the texts up to the limit matter, so prefixes are cut where the running length passes it
    sized = rows.withColumn("_t", F.coalesce(text, F.lit(""))).withColumn("_len", F.sum(F.when(F.col("_t") != "", F.length("_t") + 1).otherwise(0)).over(before))
    within = F.coalesce(F.col("_len"), F.lit(0)) - 1 <= limit
    told = sized.withColumn("_fit", within).withColumn("_prefix", F.array_join(F.filter(F.collect_list(F.when(within, F.col("_t"))).over(before), lambda x: x != ""), "\n"))
    frozen = F.first(F.when(~F.col("_fit"), F.col("_prefix")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    short = summarise(frozen) if summarise else F.substr(frozen, F.lit(1), F.lit(size))
    return told.select(part, order, F.coalesce(short, "_prefix").alias("context"))


def carry_forward(rows: DataFrame, part: str, order: str, text: str, summarise) -> DataFrame:
    """(part, order, preface, summary): each row's summary is the next one's preface; ``summarise(preface, text)`` is called in order, book by book."""

    def step(state: list[str], row: dict) -> list[tuple]:
        preface = state[0]
        state[0] = summarise(preface, row[text] or "")
        return [(row[part], row[order], preface, state[0])]

    kinds = dict(rows.dtypes)
    return stream_fold(rows.select(part, order, text), [part], [order], f"{part} {kinds[part]}, {order} {kinds[order]}, preface string, summary string", lambda: [""], step)


def session_gaps(events: DataFrame, part: str, ts: str, gap: int = 7200, tie: str | None = None) -> DataFrame:
    """Events with ``session``: a new one behind a gap of over ``gap`` seconds."""
    w = Window.partitionBy(part).orderBy(ts, *([tie] if tie else []))
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    apart = at - F.lag(at).over(w) > gap * 1_000_000
    marked = events.withColumn("_new", F.coalesce(apart, F.lit(False)).cast("int"))
    return marked.withColumn("session", F.sum("_new").over(w).cast("long")).drop("_new")
