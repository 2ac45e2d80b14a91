"""Dataset mappings: rows of other layouts to chat messages."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.functions.text import strip

# fixed values: the mappings that come with the engine, name: (type, {field: source column})
MAPPINGS: dict[str, tuple[str, dict[str, str]]] = {
    "alpaca": ("alpaca", {"instruction": "instruction", "input": "input", "output": "output"}),
    "sharegpt": ("sharegpt", {"conversations": "conversations", "from": "from", "value": "value"}),
    "openai": ("openai", {"messages": "messages"}),
    "prompt_completion": ("prompt_completion", {"prompt": "prompt", "completion": "completion"}),
    "reasoning": ("direct", {"problem": "problem", "thinking": "thinking", "solution": "solution"}),
    "text": ("direct", {"text": "text"}),
    "content": ("direct", {"text": "content"}),
    "code": ("direct", {"text": "code"}),
    "default": ("openai", {"messages": "messages"}),
}


def load_mappings(path: str) -> dict[str, tuple[str, dict[str, str]]]:
    """Mappings from a JSON file of {name: {type, mapping}}."""
    with open(path, encoding="utf-8") as f:
        return {k: (v["type"], v["mapping"]) for k, v in json.load(f).items()}


def _turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _messages(kind: str, m: dict[str, str], get) -> Column | None:
    text = lambda k: F.coalesce(get(m[k]).cast("string"), F.lit(""))
    if kind == "openai":
        return get(m["messages"])
    if kind == "alpaca":
        return F.array(_turn("user", strip(F.concat(text("instruction"), F.lit("\n\n"), text("input")))), _turn("assistant", text("output")))
    if kind == "prompt_completion":
        return F.array(_turn("user", text("prompt")), _turn("assistant", text("completion")))
    if kind == "sharegpt":
        role = lambda x: F.when(x[m["from"]].isin("human", "user"), "user").otherwise("assistant").alias("role")
        return F.transform(get(m["conversations"]), lambda x: F.struct(role(x), F.coalesce(x[m["value"]], F.lit("")).alias("content")))
    if kind == "reasoning":
        thought = F.when(text("thinking") != "", F.concat(F.lit("<thought>\n"), text("thinking"), F.lit("\n</thought>\n\n"), text("solution"))).otherwise(text("solution"))
        return F.array(_turn("user", text("problem")), _turn("assistant", thought))
    return None


def map_rows(rows: DataFrame, name: str, mappings: dict[str, tuple[str, dict[str, str]]] = MAPPINGS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows in a mapping's layout, behind the columns in ``keep``. An unknown name is ``default``; a missing source column is null."""
    kind, m = mappings[name] if name in mappings else mappings["default"]
    get = lambda c: F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string")
    out: dict[str, Column] = {}
    if kind != "direct" and (messages := _messages(kind, m, get)) is not None:
        out["messages"] = messages
    for field, source in m.items():
        out.setdefault(field, get(source))
    mapped = rows.select(*keep, *[c.alias(k) for k, c in out.items()])
    return mapped.where(F.col("messages").isNotNull()) if kind not in ("direct", "openai") else mapped


def with_ids(rows: DataFrame, order: str | Column, start: int = 0, text: str = "text") -> DataFrame:
    """Rows with ``id`` counted from ``start`` in the given order; ``text`` is never null.

    Ids are partition offsets plus places inside sorted ranges, so no task holds all rows.
    """
    from storyloom.operators.ordering import global_index

    base = rows.drop("id") if "id" in rows.columns and order != "id" else rows
    numbered = global_index(base.withColumn("_order", F.col(order) if isinstance(order, str) else order), "_order", "id")
    numbered = numbered.withColumn("id", F.col("id") + start).drop("_order")
    return numbered.withColumn(text, F.coalesce(F.col(text), F.lit(""))) if text in numbered.columns else numbered.withColumn(text, F.lit(""))
