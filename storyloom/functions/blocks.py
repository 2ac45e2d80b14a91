"""Message contents, outputs and whole requests of free shape, as VARIANT expressions inside the JVM.

Contents are kept as text: JSON where they are blocks, anything else as it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storyloom.functions.text import col, let, strip


def parsed(c: Column | str) -> Column:
    """A JSON text as a variant, with raw control characters as spaces; null if it is none."""
    return F.try_parse_json(F.regexp_replace(col(c), r"[\x00-\x1f]", " "))


def at(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def items(v: Column, path: str = "$") -> Column:
    """The elements of an array; none where there is no array."""
    return F.coalesce(at(v, path, "array<variant>"), F.array().cast("array<variant>"))


def filled(v: Column, path: str) -> Column:
    """Whether something is there that is not empty, zero or false."""
    return ~F.coalesce(at(v, path), F.lit("")).isin("", "[]", "{}", "0", "0.0", "false")


def content_text(c: Column | str) -> Column:
    """The words of a content: a string, or its blocks of text and tool results on lines of their own; tool results that are no strings are their JSON."""
    text = col(c)

    def words(b: Column) -> Column:
        kind = at(b, "$.type")
        return F.when(kind == "text", F.coalesce(at(b, "$.text"), F.lit(""))).when(kind == "tool_result", F.coalesce(at(b, "$.content"), F.lit(""))).when(F.schema_of_variant(b) == "STRING", at(b, "$"))

    def whole(v: Column) -> Column:
        lines = F.array_join(F.transform(items(v), words), "\n")
        return F.when(v.isNull(), text).when(F.schema_of_variant(v).startswith("ARRAY"), lines).otherwise(at(v, "$"))

    return F.when(text.rlike(r'^\s*[\[{"]'), let(F.try_parse_json(text), whole)).otherwise(F.coalesce(text, F.lit("")))


def is_output_empty(c: Column | str) -> Column:
    """Whether an output has no text, no tool call and no function call; text that is no JSON is an output if it is not blank."""

    def judge(v: Column) -> Column:
        kind = F.schema_of_variant(v)
        blocks = F.exists(items(v, "$.content"), lambda b: filled(b, "$.text") | filled(b, "$.content"))
        said = F.when(F.schema_of_variant(at(v, "$.content", "variant")).startswith("ARRAY"), blocks).otherwise(F.coalesce(at(v, "$.content"), F.lit("")) != "")
        called = filled(v, "$.tool_calls") | filled(v, "$.function_call.name")
        return F.when(v.isNull(), strip(col(c)) == "").when(kind == "VOID", True).when(kind == "STRING", strip(at(v, "$")) == "").when(kind.startswith("OBJECT"), ~(said | called)).otherwise(False)

    return F.when(F.coalesce(col(c), F.lit("")) == "", True).otherwise(let(parsed(c), judge))


def has_assistant_content(c: Column | str) -> Column:
    """Whether a request's messages hold an assistant's text or tool use."""

    def spoken(m: Column) -> Column:
        blocks = F.exists(items(m, "$.content"), lambda b: (strip(F.coalesce(at(b, "$.text"), F.lit(""))) != "") | F.coalesce(at(b, "$.type") == "tool_use", F.lit(False)))
        text = F.when(F.schema_of_variant(at(m, "$.content", "variant")) == "STRING", strip(at(m, "$.content")) != "")
        return (at(m, "$.role") == "assistant") & F.coalesce(text, blocks)

    return F.coalesce(let(parsed(c), lambda v: F.exists(items(v, "$.messages"), spoken)), F.lit(False))


def output_message(c: Column | str) -> Column:
    """An output (JSON) as the assistant's message, a variant: its text, or blocks where it calls tools; null where it says nothing."""

    def block(call: Column) -> Column:
        args = F.coalesce(at(call, "$.function.arguments"), F.lit("{}"))
        return F.parse_json(F.to_json(F.struct(F.lit("tool_use").alias("type"), F.coalesce(at(call, "$.id"), F.lit("")).alias("id"), F.coalesce(at(call, "$.function.name"), F.lit("")).alias("name"), F.coalesce(F.try_parse_json(args), args.cast("variant")).alias("input"))))

    def message(v: Column) -> Column:
        text = F.nullif(at(v, "$.content"), F.lit(""))
        said = F.when(text.isNotNull(), F.array(F.parse_json(F.to_json(F.struct(F.lit("text").alias("type"), text.alias("text")))))).otherwise(F.array().cast("array<variant>"))
        blocks = F.concat(said, F.transform(items(v, "$.tool_calls"), block))
        content = F.when(filled(v, "$.tool_calls"), F.parse_json(F.to_json(blocks))).when(text.isNotNull(), at(v, "$.content", "variant"))
        return F.when(content.isNotNull(), says(content))

    return let(F.try_parse_json(col(c)), message)


def says(content: Column) -> Column:
    """The assistant's message with a content (a variant)."""
    return F.parse_json(F.to_json(F.struct(content.alias("content"), F.lit("assistant").alias("role"))))
