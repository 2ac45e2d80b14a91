"""Chat-message algebra. The long form is (doc, pos, role, content, ...), arrays only at the edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions.arrays import explode_once
from storyloom.functions.text import clean_lines, split_lines, strip, unquote

MSG = "array<struct<role:string,content:string>>"


def to_long(rows: DataFrame, doc: str, messages: str = "messages") -> DataFrame:
    """(doc, pos, role, content, ...) from message arrays."""
    return rows.select(doc, F.posexplode(messages).alias("pos", "m")).select(doc, "pos", "m.*")


def to_arrays(long: DataFrame, doc: str, fields: tuple[str, ...] = ("role", "content"), pos: str = "pos") -> DataFrame:
    """One row per document with its messages in order."""
    packed = F.array_sort(F.collect_list(F.struct(pos, *fields)))
    return long.groupBy(doc).agg(F.transform(packed, lambda m: F.struct(*[m[f].alias(f) for f in fields])).alias("messages"))


def assign_roles(long: DataFrame, user_role: str | Column, speaker: str = "speaker") -> DataFrame:
    """The user's lines are those of ``user_role``; all others, without a speaker too, are the assistant's."""
    who = F.lit(user_role) if isinstance(user_role, str) else user_role
    return long.withColumn("role", F.when(F.col(speaker) == who, "user").otherwise("assistant"))


def islands(long: DataFrame, doc: str, key: Column, pos: str = "pos", name: str = "run") -> DataFrame:
    """``long`` with a number for each run of neighbours with one key."""
    w = Window.partitionBy(doc).orderBy(pos)
    marked = long.withColumn("_key", key).withColumn("_new", F.when(F.col("_key").eqNullSafe(F.lag("_key").over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1))
    return marked.withColumn(name, F.sum("_new").over(w)).drop("_new", "_key")


def ordered_join(value: str, pos: str = "pos", sep: str = "\n") -> Column:
    """Values of a group in order, joined; nulls are left out."""
    pairs = F.array_sort(F.collect_list(F.struct(pos, F.col(value).alias("v"))))
    return F.array_join(F.transform(pairs, lambda x: x["v"]), sep)


def merge_adjacent_roles(long: DataFrame, doc: str, pos: str = "pos", speaker: str | None = None) -> DataFrame:
    """(doc, pos, role, content[, speakers]): neighbours of one role become one message, contents by line, speakers sorted."""
    runs = islands(long, doc, F.col("role"), pos)
    extra = [F.array_sort(F.collect_set(F.nullif(F.col(speaker), F.lit("")))).alias("speakers")] if speaker else []
    return runs.groupBy(doc, F.col("run").cast("long").alias("pos"), "role").agg(ordered_join("content", pos).alias("content"), *extra)


def merge_speaker_runs(long: DataFrame, doc: str, pos: str = "pos") -> DataFrame:
    """Neighbours of one speaker become one message; no speaker counts as an empty one."""
    named = long.withColumn("speaker", F.coalesce("speaker", F.lit("")))
    return islands(named, doc, F.col("speaker"), pos).groupBy(doc, F.col("run").cast("long").alias("pos"), "speaker").agg(ordered_join("content", pos).alias("content"))


def roleplay_blocks(lines: DataFrame, doc: str, protagonist: str | Column, pos: str = "pos") -> DataFrame:
    """Runs of the protagonist's dialogue are the user's, all else the assistant's. Needs is_dialogue, speaker and line."""
    who = F.lit(protagonist) if isinstance(protagonist, str) else protagonist
    spoken = F.coalesce(F.col("is_dialogue") & (F.col("speaker") == who), F.lit(False))
    roles = lines.withColumn("role", F.when(spoken, "user").otherwise("assistant")).withColumnRenamed("line", "content")
    return merge_adjacent_roles(roles, doc, pos)


def fallback_blocks(lines: DataFrame, doc: str, line: str = "line", pos: str = "pos", user: int = 2, assistant: int = 5) -> DataFrame:
    """Two lines for the user, five for the assistant, and so on; ``pos`` counts from 0."""
    turn = user + assistant
    mine = F.col(pos) % turn < user
    grouped = lines.groupBy(doc, (2 * F.floor(F.col(pos) / turn) + F.when(mine, 0).otherwise(1)).cast("long").alias("block"), F.when(mine, "user").otherwise("assistant").alias("role"))
    return grouped.agg(ordered_join(line, pos).alias("content")).withColumnRenamed("block", "pos")


def with_fallback(blocks: DataFrame, fallback: DataFrame, doc: str) -> DataFrame:
    """``blocks``, but ``fallback`` for documents that have at most one block."""
    few = fallback.select(doc).distinct().join(blocks.groupBy(doc).agg(F.count("*").alias("n")).where("n > 1"), doc, "left_anti")
    return blocks.join(few, doc, "left_anti").unionByName(fallback.join(few, doc, "left_semi"))


def roleplay_or_fallback(lines: DataFrame, doc: str, protagonist: str | Column, pos: str = "pos", user: int = 2, assistant: int = 5) -> DataFrame:
    """``roleplay_blocks``, but ``fallback_blocks`` for documents that have one block only; ``lines`` are read and shuffled once for both. Needs is_dialogue, speaker and line."""
    who = F.lit(protagonist) if isinstance(protagonist, str) else protagonist
    spoken = F.coalesce(F.col("is_dialogue") & (F.col("speaker") == who), F.lit(False))
    runs = islands(lines.select(doc, pos, "line", F.when(spoken, "user").otherwise("assistant").alias("role")), doc, F.col("role"), pos)
    turn = user + assistant
    mine = F.col(pos) % turn < user
    several = F.max("run").over(Window.partitionBy(doc)) > 1
    placed = runs.withColumn("_several", several).select(
        doc,
        pos,
        "line",
        F.when(F.col("_several"), F.col("run")).otherwise(2 * F.floor(F.col(pos) / turn) + F.when(mine, 0).otherwise(1)).cast("long").alias("_block"),
        F.when(F.col("_several"), F.col("role")).otherwise(F.when(mine, "user").otherwise("assistant")).alias("role"),
    )
    return placed.groupBy(doc, "_block", "role").agg(ordered_join("line", pos).alias("content")).withColumnRenamed("_block", "pos")


def first_ten_lines(text: Column | str, system: Column | str | None = None) -> Column:
    """Messages whose user part is the first ten lines and whose assistant part is the rest."""
    lines = split_lines(text)
    msgs = [F.struct(F.lit("user").alias("role"), F.array_join(F.slice(lines, 1, 10), "\n").alias("content")), F.struct(F.lit("assistant").alias("role"), F.array_join(F.filter(lines, lambda x, i: i >= 10), "\n").alias("content"))]
    if system is not None:
        msgs.insert(0, F.struct(F.lit("system").alias("role"), (F.lit(system) if isinstance(system, str) else system).alias("content")))
    return F.array(*msgs)


def with_system(messages: Column | str, prompt: Column | str) -> Column:
    """Messages behind a system message."""
    first = F.struct(F.lit("system").alias("role"), (F.lit(prompt) if isinstance(prompt, str) else prompt).alias("content"))
    return F.concat(F.array(first), F.col(messages) if isinstance(messages, str) else messages)


def flip_first_role(messages: Column | str) -> Column:
    """A leading assistant message becomes the user's."""
    m = F.col(messages) if isinstance(messages, str) else messages
    return F.transform(m, lambda x, i: x.withField("role", F.when((i == 0) & (x["role"] == "assistant"), "user").otherwise(x["role"])))


def flatten(messages: Column | str, reasoning: str = "reasoning", either: bool = False) -> Column:
    """Messages as ``role:content`` lines; with reasoning, on lines of its own. ``either``: take reasoning_content where reasoning is missing."""
    m = F.col(messages) if isinstance(messages, str) else messages

    def one(x: Column) -> Column:
        why = F.coalesce(F.nullif(x[reasoning], F.lit("")), x["reasoning_content"]) if either else x[reasoning]
        role, content = F.coalesce(x["role"], F.lit("unknown")), F.coalesce(x["content"], F.lit(""))
        return F.when(F.coalesce(why, F.lit("")) != "", F.concat(role, F.lit(":\n"), why, F.lit("\n"), content)).otherwise(F.concat(role, F.lit(":"), content))

    return F.array_join(F.transform(m, one), "\n")


def flatten_plain(messages: Column | str) -> Column:
    """``role:content`` lines of messages that have no reasoning."""
    m = F.col(messages) if isinstance(messages, str) else messages
    return F.array_join(F.transform(m, lambda x: F.concat(F.coalesce(x["role"], F.lit("unknown")), F.lit(":"), F.coalesce(x["content"], F.lit("")))), "\n")


def render_template(messages: Column | str, eos: str | None = None) -> Column:
    """The chat template with turn markers."""
    m = F.col(messages) if isinstance(messages, str) else messages
    out = F.array_join(F.transform(m, lambda x: F.concat(F.lit("<|im_start|>"), x["role"], F.lit("\n"), x["content"], F.lit("<|im_end|>\n"))), "")
    return F.concat(out, F.lit(eos)) if eos else out


def merge_consecutive_system(messages: Column | str) -> Column:
    """Runs of system messages become one: the first one's fields, non-empty contents by line."""
    m = F.col(messages) if isinstance(messages, str) else messages

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.array_join(F.filter(F.array(last["content"], x["content"]), lambda c: F.coalesce(c, F.lit("")) != ""), "\n")
        run = (F.size(acc) > 0) & (x["role"] == "system") & (F.get(acc, F.size(acc) - 1)["role"] == "system")
        return F.when(run, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.get(acc, F.size(acc) - 1).withField("content", joined.cast("string"))))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(m, F.slice(m, 1, 0), step)


def batch_ids(messages: Column | str, min_chars: int) -> Column:
    """A batch number for each message: a batch closes behind an assistant message once it has ``min_chars`` characters."""
    m = F.col(messages) if isinstance(messages, str) else messages
    zero = F.struct(F.lit(0).cast("long").alias("chars"), F.lit(0).alias("batch"), F.array().cast("array<int>").alias("ids"))

    def step(acc: Column, x: Column) -> Column:
        chars = acc["chars"] + F.length(F.coalesce(x["content"], F.lit("")))
        closes = (chars >= min_chars) & (x["role"] == "assistant")
        return F.struct(F.when(closes, F.lit(0).cast("long")).otherwise(chars).alias("chars"), F.when(closes, acc["batch"] + 1).otherwise(acc["batch"]).alias("batch"), F.array_append(acc["ids"], acc["batch"]).alias("ids"))

    return F.aggregate(m, zero, step, lambda acc: acc["ids"])


def paraphrase(rows: DataFrame, doc: str, messages: str = "messages", min_chars: int = 500, users: int | None = 2) -> DataFrame:
    """(doc, pos, role, content): each batch as one user message (its first ``users`` user messages, unquoted; all if None)
    and one assistant message with everything in it. A batch without user messages has no user part."""
    zipped = F.arrays_zip(F.col(messages).alias("m"), batch_ids(messages, min_chars).alias("b"))
    batched = explode_once(rows, zipped, doc, value="z").select(doc, F.col("z.b").alias("batch"), "pos", "z.m.role", "z.m.content")
    own = F.array_sort(F.collect_list(F.when(F.col("role") == "user", F.struct("pos", unquote("content").alias("v")))))
    own = own if users is None else F.slice(own, 1, users)
    per = batched.groupBy(doc, "batch").agg(own.alias("u"), ordered_join("content").alias("everything"))
    said = F.array_join(F.transform("u", lambda x: x["v"]), "\n")
    turn = F.when(F.size("u") > 0, F.array(F.struct(F.lit(0).alias("k"), F.lit("user").alias("role"), said.alias("content")))).otherwise(F.array().cast("array<struct<k:int,role:string,content:string>>"))
    turns = F.concat(turn, F.array(F.struct(F.lit(1).alias("k"), F.lit("assistant").alias("role"), F.col("everything").alias("content"))))
    return per.select(doc, "batch", F.explode(turns).alias("t")).select(doc, (2 * F.col("batch") + F.col("t.k")).cast("long").alias("pos"), "t.role", "t.content")


def convert(rows: DataFrame, doc: str, mode: str = "normal", min_chars: int = 500) -> DataFrame:
    """Messages in one of the modes normal, paraphrase and strict-paraphrase, as the long form."""
    if mode == "normal":
        return to_long(rows.withColumn("messages", flip_first_role("messages")), doc)
    return paraphrase(rows, doc, min_chars=min_chars, users=2 if mode == "paraphrase" else None)


# --- reasoning variants -------------------------------------------------------------------------------------------


def _tag(x: Column, i: Column, tag: str) -> Column:
    return x.withField("content", F.when((i == 0) & (x["role"] == "system"), F.concat(F.lit(f"[THINKING:{tag}]\n"), x["content"])).otherwise(x["content"]))


def without_reasoning(messages: Column | str) -> Column:
    """All reasoning blank; a leading system message says so."""
    m = F.col(messages) if isinstance(messages, str) else messages
    return F.transform(m, lambda x, i: _tag(x, i, "OFF").withField("reasoning_content", F.when(x["role"] == "assistant", "").otherwise(x["reasoning_content"])))


def progressive_reasoning(messages: Column | str) -> Column:
    """One variant per assistant message: everything up to it, reasoning on it alone, and a user message somewhere before it."""
    m = F.col(messages) if isinstance(messages, str) else messages
    ends = F.filter(F.transform(m, lambda x, i: F.when(x["role"] == "assistant", i + 1)), lambda i: i.isNotNull())
    blank = F.get(m, F.lit(0)).withField("role", F.lit("user")).withField("content", F.lit("")).withField("reasoning_content", F.lit(None).cast("string"))

    def variant(end: Column) -> Column:
        kept = F.transform(F.slice(m, F.lit(1), end), lambda x, i: _tag(x, i, "ON").withField("reasoning_content", F.when(x["role"] != "assistant", x["reasoning_content"]).when(i == end - 1, F.coalesce(x["reasoning_content"], F.lit("")))))
        before, last = F.slice(kept, F.lit(1), end - 1), F.slice(kept, end, F.lit(1))
        return F.when(F.exists(before, lambda x: x["role"] == "user"), kept).otherwise(F.concat(before, F.array(blank), last))

    return F.transform(ends, variant)


def reasoning_variants(rows: DataFrame, doc: str, messages: str = "messages") -> DataFrame:
    """(doc, variant, messages): variant 0 is without reasoning, then one per assistant message. Documents without messages or a user message are left out."""
    fit = rows.where((F.size(messages) > 0) & F.exists(messages, lambda x: x["role"] == "user"))
    return explode_once(fit, F.concat(F.array(without_reasoning(messages)), progressive_reasoning(messages)), doc, pos="variant", value="messages")


# --- text to messages ---------------------------------------------------------------------------------------------


def text_lines(rows: DataFrame, doc: str, text: str = "text") -> DataFrame:
    """(doc, pos, line): stripped lines that are not blank. Documents without any disappear."""
    return explode_once(rows, clean_lines(text), doc, value="line")


def system_prompt(task: Column, world: Column, profiles: Column, context: Column) -> Column:
    """The sections of a system prompt. ``profiles``: array of (name, profile)."""
    # fixed values: section headers and the word for "none"
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    head = F.array(F.lit("【任务描述】"), task, F.lit(""), F.lit("【世界观设定】"), F.when(some(world), world).otherwise("无"))
    cast = F.flatten(F.transform(profiles, lambda p: F.array(F.concat(F.lit("## "), p["name"]), p["profile"], F.lit(""))))
    cast = F.when(F.size(profiles) > 0, F.concat(F.array(F.lit(""), F.lit("【角色设定】")), cast)).otherwise(F.array().cast("array<string>"))
    told = F.when(some(context), F.array(F.lit(""), F.lit("【前情提要】"), context)).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(head, cast, told), "\n")
