"""Conversation chains: which record continues which, and what a chain looks like as one record.

A record's output should reappear among a later record's messages. Candidates lie at most ``look`` records later in
(timestamp, id) order. They come from an equi-join on windows of that order, cheap tests first; similarity runs only where those leave a choice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions.blocks import at, content_text, filled, items, output_message, says
from storyloom.functions.fuzzy import alike, nearly
from storyloom.functions.text import gap_seconds, strip
from storyloom.operators.cleaning import tool_ids, tool_use_ids
from storyloom.operators.ordering import global_index
from storyloom.plans.lineage import cut

LOOK, GAP, LEAST, SHORT = 49, 7200, 0.9, 20


def candidates(parsed: DataFrame, look: int = LOOK, part: str | None = None) -> DataFrame:
    """(i, j, a_*, b_*): each record with the up to ``look`` following ones. ``part``: look only inside one key."""
    rows = parsed.select("id", "timestamp", "messages", "out", *([part] if part else []))
    if part:
        rows = rows.withColumn("i", F.row_number().over(Window.partitionBy(part).orderBy("timestamp", "id")).cast("long") - 1)
    else:
        rows = global_index(rows, ["timestamp", "id"], "i")
    width = look + 1
    a = rows.select(F.col("i"), F.col("id").alias("a_id"), F.col("timestamp").alias("a_ts"), F.col("out").alias("a_out"), *([part] if part else []), F.explode(F.array(F.floor(F.col("i") / width), F.floor(F.col("i") / width) + 1)).alias("w"))
    a = a.where((F.coalesce("a_out.content", F.lit("")) != "") | (F.size(tool_ids(F.col("a_out.tool_calls"))) > 0))
    b = rows.select(F.col("i").alias("j"), F.col("id").alias("b_id"), F.col("timestamp").alias("b_ts"), F.col("messages").alias("b_messages"), *([part] if part else []), F.floor(F.col("i") / width).alias("w"))
    return a.join(b, ["w", *([part] if part else [])]).where((F.col("j") > F.col("i")) & (F.col("j") - F.col("i") <= look)).drop("w")


def matches(cand: DataFrame, exact: bool = False) -> DataFrame:
    """Candidates with ``hit``: shared tool calls, a short text contained, or an assistant text that is nearly the same (``exact``: the same)."""
    ids = tool_ids(F.col("a_out.tool_calls"))
    spoken = F.filter("b_messages", lambda m: m["role"] == "assistant")
    by_tool = F.exists(spoken, lambda m: (F.size(tool_use_ids(m["content"])) > 0) & (F.size(F.filter(ids, lambda x: F.array_contains(tool_use_ids(m["content"]), x))) >= F.size(ids) * 0.5)) & (F.size(ids) > 0)
    if exact:
        text = strip(F.coalesce("a_out.content", F.lit("")))
        said = lambda m: F.when(F.length(text) < SHORT, F.contains(m["content"], text)).otherwise(strip(m["content"]) == text)
        return cand.withColumn("hit", by_tool | ((text != "") & F.exists(spoken, lambda m: F.coalesce(said(m), F.lit(False)))))
    base = cand.withColumn("_text", strip(content_text(F.col("a_out.content")))).withColumn("_tool", F.coalesce(by_tool, F.lit(False)))
    turns = base.where("not _tool and _text <> ''").select("i", "j", "_text", F.explode(spoken).alias("m")).select("i", "j", "_text", strip(content_text(F.col("m.content"))).alias("_said")).where("_said <> ''")
    brief = turns.where(F.length("_text") < SHORT).where(F.contains("_said", F.col("_text"))).select("i", "j")
    same = turns.where((F.length("_text") >= SHORT) & (F.col("_text") == F.col("_said"))).select("i", "j")
    other = turns.where((F.length("_text") >= SHORT) & (F.col("_text") != F.col("_said"))).where(nearly(LEAST)("_text", "_said")).select("i", "j")
    found = brief.unionAll(same).unionAll(other).distinct().withColumn("_hit", F.lit(True))
    return base.join(found, ["i", "j"], "left").withColumn("hit", F.col("_tool") | F.coalesce("_hit", F.lit(False))).drop("_text", "_tool", "_hit")


def links(matched: DataFrame, part: str | None = None) -> DataFrame:
    """(a_id, b_id): each record's first match, if the search gets there and no earlier record has it.

    The search stops behind the first unmatched candidate more than two hours later; that candidate itself is still looked at.
    """
    own = [part] if part else []
    w = Window.partitionBy(*own, "i").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    far = F.coalesce(gap_seconds("a_ts", "b_ts") > GAP, F.lit(False))
    seen = matched.withColumn("_over", F.coalesce(F.max(far.cast("int")).over(w), F.lit(0)))
    first = seen.where("hit and _over = 0").groupBy(*own, "i").agg(F.min_by(F.struct("j", "a_id", "b_id"), "j").alias("x")).select(*own, "i", "x.*")
    claim = Window.partitionBy(*own, "j").orderBy("i")
    return first.withColumn("_n", F.row_number().over(claim)).where("_n = 1").select("a_id", "b_id", *own)


def follow(link: DataFrame, most: int = 64) -> DataFrame:
    """(root, id, depth): chains from their first record. Links lead forward, so doubling the known paths ends in log2 rounds."""
    link = cut(link)
    steps = link.select(F.col("b_id").alias("id"), F.col("a_id").alias("up"), F.lit(1).cast("long").alias("depth"))
    for _ in range(most):
        nxt = steps.alias("s").join(steps.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("depth").alias("_d")), F.col("s.up") == F.col("_id"), "left")
        nxt = nxt.select("id", F.coalesce("_up", "up").alias("up"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"), F.col("_up").isNotNull().alias("moved"))
        nxt = cut(nxt)
        if nxt.where("moved").isEmpty():
            break
        steps = nxt.drop("moved")
    heads = link.select(F.col("a_id").alias("id")).join(link.select(F.col("b_id").alias("id")), "id", "left_anti").distinct()
    return steps.select(F.col("up").alias("root"), "id", "depth").unionByName(heads.select(F.col("id").alias("root"), "id", F.lit(0).cast("long").alias("depth")))


def chain_stats(chains: DataFrame) -> DataFrame:
    """(root, length, delete_count) of chains of more than one record."""
    return chains.groupBy("root").agg(F.count("*").alias("length")).where("length > 1").withColumn("delete_count", F.col("length") - 1)


def places(turns: list[str], answers: list[str], least: float = LEAST) -> list[int]:
    """For each turn the number of the answer that takes its place, or -1. Each answer meets the first turn that is nearly the same, as it reads by then, and takes its place if it is longer."""
    now, taken = list(turns), [-1] * len(turns)
    for n, answer in enumerate(answers):
        j = next((j for j, said in enumerate(now) if answer and said and alike(said, answer, least)), None)
        if j is not None and len(answer) > len(now[j]):
            now[j], taken[j] = answer, n
    return taken


def _placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield f.assign(place=[places(list(t), [x["answer"] for x in e[:-1]]) for t, e in zip(f["said"], f["each"], strict=True)]).drop(columns="said")


def merge_chains(records: DataFrame, chains: DataFrame) -> DataFrame:
    """(id, timestamp, metadata, input, output, merged): one record per chain; the first record's id, time and metadata, the last one's output.

    The messages are the last record's and its answer's. Where an earlier record's answer says more than the turn it became, its content stands there.
    """
    rows = chains.join(chain_stats(chains).select("root"), "root", "left_semi").join(records.select("id", "timestamp", "metadata", "input", "output"), "id")
    output = F.try_parse_json("output")
    # an answer that calls tools is in the later messages as blocks and takes no one's place
    answer = F.when(filled(F.col("_out"), "$.tool_calls"), F.lit("")).otherwise(strip(content_text(at(F.col("_out"), "$.content"))))
    long = rows.withColumn("_out", output).select("root", "depth", "timestamp", "metadata", "input", "output", answer.alias("answer"), at(F.col("_out"), "$.content", "variant").alias("content"))
    first = F.min_by(F.struct("timestamp", "metadata"), "depth").alias("first")
    last = F.max_by(F.struct("input", "output"), "depth").alias("last")
    each = F.array_sort(F.collect_list(F.struct("depth", "answer", F.to_json("content").alias("content")))).alias("each")
    one = long.groupBy("root").agg(first, last, each, F.count("*").alias("merged"))
    # variants stay in the JVM: the texts go to Python, and the turns are read again behind it
    turns = lambda: F.concat(items(F.try_parse_json("input"), "$.messages"), F.filter(F.array(output_message("output")), lambda m: m.isNotNull()))
    one = one.select(F.col("root").alias("id"), "first.timestamp", "first.metadata", "last.input", "last.output", "each", "merged")
    said = F.transform(turns(), lambda m: F.when(at(m, "$.role") == "assistant", strip(content_text(at(m, "$.content")))).otherwise(""))
    kinds = ", ".join(f"{c} {t}" for c, t in one.dtypes)
    one = one.withColumn("said", said).mapInPandas(_placed, f"{kinds}, place array<int>")
    merged = F.transform(turns(), lambda m, j: F.when(F.get("place", j) < 0, m).otherwise(says(F.parse_json(F.get("each", F.get("place", j))["content"]))))
    return one.select("id", "timestamp", "metadata", F.to_json(F.struct(merged.alias("messages"))).alias("input"), "output", "merged")


def apply_merge(records: DataFrame, merged: DataFrame, chains: DataFrame) -> DataFrame:
    """Records after a merge: survivors rewritten, the others of their chains gone."""
    gone = chains.where("depth > 0").select("id")
    new = merged.select("id", F.col("input").alias("_input"), F.col("output").alias("_output"))
    kept = records.join(gone, "id", "left_anti").join(new, "id", "left")
    return kept.withColumn("input", F.coalesce("_input", "input")).withColumn("output", F.coalesce("_output", "output")).drop("_input", "_output")
