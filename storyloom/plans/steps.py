"""Composite plans by name, and the registry that chains them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.functions.arrays import explode_once
from storyloom.functions.fuzzy import dump, quote_pieces
from storyloom.functions.ordered import stream_fold
from storyloom.functions.text import split_dialogue, strip
from storyloom.operators import characters, chunking, mapping, messages, ordering, relational, state
from storyloom.plans.lineage import cut, small_batches
from storyloom.plans.modelcalls import CATEGORIES, LanguageModel, Retrying, RuleModel, call_rows, parse_reply, system_prompt_or_canned
from storyloom.plans.progress import Progress
from storyloom.sources import readers, writers

RULES = RuleModel()
#: rows of one lane of a fetched dataset
LANE_ROWS = 1_000_000


def segment_scenes(docs: DataFrame, doc: str = "doc_id", text: str = "text", model: LanguageModel = RULES, chunk: int = 2000, least: int = 2000, gap: int = 5, keep_last: bool = True) -> DataFrame:
    """Scenes of each document: chunks of lines, scene changes per chunk, boundaries thinned and merged, then cut."""
    base = docs.select(doc, text).where(F.col(text).isNotNull())
    lines = base.withColumn("_lines", F.split(text, "\n")).withColumn("_ids", chunking.line_chunks("_lines", chunk))
    per = explode_once(lines, F.arrays_zip(F.col("_lines").alias("line"), F.col("_ids").alias("chunk")), doc, value="z").groupBy(doc, F.col("z.chunk").alias("chunk"))
    per = per.agg(F.min("pos").alias("p0"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "z.line"))), lambda x: x["line"]).alias("lines")).withColumn("first_line", F.col("p0") + 1)
    asked = call_rows(per.select(doc, "chunk", "first_line", "lines"), model, "scene_changes", ["first_line", "lines"])
    found = F.from_json("reply", "scene_changes array<string>")["scene_changes"]
    inside = F.filter(chunking.valid_boundaries(found), lambda b: (b > F.col("first_line")) & (b <= F.col("first_line") + F.size("lines")))
    bounds = asked.groupBy(doc).agg(F.flatten(F.collect_list(inside)).alias("b"))
    joined = base.join(bounds, doc)
    ends = F.array(F.lit(1), (F.size(F.split(text, "\n")) + 1).cast("int"))
    # one column per step: expressions that are used more than once are then computed once
    rows = joined.withColumn("_all", F.array_sort(F.array_distinct(F.concat(F.col("b"), ends)))).withColumn("bounds", chunking.thin_boundaries("_all", gap, keep_last))
    if least > 0:
        rows = rows.withColumn("_lines", F.split(F.col(text), "\n")).withColumn("_kept", chunking.long_scenes("_lines", "bounds", least)).withColumn("bounds", chunking.merge_last("_lines", "_kept", "bounds", least))
    return chunking.scenes(rows, doc, "bounds", text)


def ask_characters(chunks: DataFrame, model: LanguageModel, book: str, stem: str) -> DataFrame:
    """(book, stem, chunk, text, reply): the names of each chunk, asked in order with the characters and the narrator that a book's earlier chunks have shown.

    A name that a known character has adds the others to that one. Only a book's known names are held.
    """

    def step(state: dict, row: dict) -> list[tuple]:
        reply = model("characters", {"text": row["text"], "known_characters": [list(g) for g in state["known"]], "known_narrator": state["narrator"]})
        got = parse_reply(reply)
        if isinstance(got, dict):
            for names in got.get("characters") or []:
                at = next((state["where"][n] for n in names if n in state["where"]), len(state["known"]))
                if at == len(state["known"]):
                    state["known"].append([])
                new = [n for n in names if n not in state["where"]]
                state["known"][at] += new
                state["where"] |= dict.fromkeys(new, at)
            state["narrator"] = (got.get("is_first_person") and got.get("first_person_name")) or state["narrator"]
        return [(row[book], row[stem], row["chunk"], row["text"], reply)]

    kinds = dict(chunks.dtypes)
    schema = f"{book} {kinds[book]}, {stem} {kinds[stem]}, chunk {kinds['chunk']}, text string, reply string"
    return stream_fold(chunks.select(book, stem, "chunk", "text"), [book], [stem, "chunk"], schema, lambda: {"known": [], "where": {}, "narrator": ""}, step)


def consolidate_characters(segments: DataFrame, model: LanguageModel = RULES, book: str = "book", stem: str = "stem", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(characters, segment characters) of books: names per chunk, groups, formal names, points of view. The characters are a table already."""
    chunks = segments.select(book, stem, text).withColumn("_ids", chunking.line_chunks_loose(text, 2000))
    parts = explode_once(chunks, F.arrays_zip(F.split(F.col(text), "\n").alias("line"), F.col("_ids").alias("chunk")), book, stem, value="z")
    packed = parts.groupBy(book, stem, F.col("z.chunk").alias("chunk")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "z.line"))), lambda x: x["line"]), "\n").alias("text"))
    reply = F.from_json("reply", "characters array<array<string>>, character_frequencies array<map<string,int>>, is_first_person boolean, first_person_name string")
    asked = cut(ask_characters(packed, model, book, stem).select(book, stem, "chunk", reply.alias("r")).withColumn("clean", F.transform("r.characters", characters.name_set)))  # asked once, used for names and points of view
    # names are cleaned once, for groups and for segments
    said = explode_once(asked.select(book, stem, "chunk", "r.character_frequencies", "clean"), F.col("clean"), book, stem, "chunk", "character_frequencies", value="names")
    mentions = said.select(book, F.col(stem).alias("segment"), F.struct("chunk", "pos").alias("pos"), F.coalesce("names", F.array().cast("array<string>")).alias("names"), F.get("character_frequencies", F.col("pos")).alias("freqs"))
    groups = characters.group_lists(mentions, book).where(F.size("names") > 0)
    counted = F.array_sort(F.arrays_zip(F.col("names").alias("name"), F.col("freqs").alias("freq")))
    listed = groups.select(book, F.array_sort("names").alias("names"), F.map_from_entries(counted).alias("frequencies"), F.col("over").alias("consecutive_over_limit"))
    formal = F.from_json("reply", "name string, alias array<string>")
    named = call_rows(listed, model, "formal_name", ["names"]).withColumn("f", formal)
    name = F.when(F.array_contains("names", F.col("f.name")), F.col("f.name")).otherwise(F.get("names", F.lit(0)))
    chars = cut(named.withColumn("name", name).select(book, "name", F.filter("names", lambda n: n != F.col("name")).alias("alias"), "frequencies", "consecutive_over_limit"))
    pov = asked.groupBy(book, F.col(stem).alias("segment")).agg(F.bool_or("r.is_first_person").alias("is_first_person"), F.max_by(F.nullif("r.first_person_name", F.lit("")), F.when(F.coalesce("r.first_person_name", F.lit("")) != "", F.col("chunk"))).alias("first_person_name"))
    aliases = chars.groupBy(book).agg(F.collect_list(F.array_append("alias", F.col("name"))).alias("aliases"))
    filled = characters.pov_fill(pov.join(aliases, book, "left"), book, "segment", groups=True).withColumnRenamed("pov", "pov_name")
    alias = chars.select(book, F.col("name").alias("formal"), F.explode(F.array_append("alias", F.col("name"))).alias("alias"))
    names = explode_once(mentions, F.col("names"), book, "segment", "pos", pos="k", value="alias").join(alias.dropDuplicates([book, "alias"]), [book, "alias"], "left")
    own = names.groupBy(book, "segment").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("pos", "k", F.coalesce("formal", "alias").alias("n")))), lambda x: x["n"])).alias("characters"))
    seg = filled.join(pov.select(book, "segment", F.col("is_first_person").alias("is_pov")), [book, "segment"]).join(own, [book, "segment"], "left")
    return chars, seg.select(book, F.col("segment").alias(stem), "is_pov", F.coalesce("pov_name", F.lit("")).alias("pov_name"), F.coalesce("characters", F.array().cast("array<string>")).alias("characters"))


def scene_facts(segments: DataFrame, people: DataFrame, chars: DataFrame, done: DataFrame | None = None, model: LanguageModel = RULES) -> DataFrame:
    """(book, stem, environment_facts, character_facts, summary) of segments that are not blank, have characters and no facts yet."""
    todo = segments.where(strip("text") != "").join(people, ["book", "stem"])
    todo = readers.not_done(todo, done, ["book", "stem"]) if done is not None else todo
    listed = todo.withColumn("characters", characters.with_pov("characters", "pov_name"))
    key = F.concat_ws("\x1f", "book", "stem")
    shown = characters.decorated(listed.withColumn("_k", key), "_k", "characters", chars.select("book", "name", "alias").dropDuplicates(["book", "name"]), within=["book"]).withColumnRenamed("text", "cast_text")
    asked = call_rows(listed.withColumn("_k", key).join(shown, "_k").select("book", "stem", "text", "characters", "cast_text"), model, "scene_facts", ["text", "characters", "cast_text"])
    facts = F.from_json("reply", "environment_facts array<string>, character_facts array<struct<name: string, facts: array<string>, representative_quote: string>>, summary string")
    return asked.select("book", "stem", facts.alias("f")).where("f.summary is not null").select("book", "stem", "f.*")


def profiles(facts: DataFrame, people: DataFrame, chars: DataFrame, percent: int = 20, model: LanguageModel = RULES) -> tuple[DataFrame, DataFrame]:
    """(world views by book, profiles by book and main character)."""
    world = facts.where("coalesce(summary, '') <> ''").groupBy("book").agg(messages.ordered_join("summary", "stem").alias("text"))
    world = call_rows(world, model, "world", ["text"]).select("book", F.col("reply").alias("text"))
    counts = characters.appearances(people, "book", "characters")
    totals = people.groupBy("book").agg(F.count("*").alias("total"))
    main = characters.main_characters(counts, totals, "book", percent)
    all_main = main.groupBy("book").agg(F.array_sort(F.collect_set("name")).alias("_all"))
    own = main.join(all_main, "book").join(chars.select("book", "name", "alias"), ["book", "name"], "left")
    own = own.select("book", "name", F.coalesce("alias", F.array().cast("array<string>")).alias("aliases"), F.array_remove("_all", F.col("name")).alias("others"))
    blocks = characters.scene_blocks(facts, own)
    cards = call_rows(blocks, model, "profile", ["name", "text"]).select("book", "name", F.col("reply").alias("text"))
    return world, cards


def labels_fit(value: object, lines: int) -> bool:
    """Whether a reply labels lines of a batch of so many."""
    found = value.get("speakers") if isinstance(value, dict) else None
    return isinstance(found, list) and all(isinstance(x, dict) and isinstance(x.get("line_number"), int) and 1 <= x["line_number"] <= lines and isinstance(x.get("speaker"), str) for x in found)


def annotate_dialogue(segments: DataFrame, people: DataFrame, facts: DataFrame, chars: DataFrame, model: LanguageModel = RULES, batch: int = 50, tries: int = 10) -> DataFrame:
    """(book, stem, context_summary, messages): speakers of quote-split lines, batch by batch, runs of one speaker merged.

    A reply that names no speakers, or lines that the batch does not have, is asked for again, up to ``tries`` times; a segment with a batch that fails is left out whole. Earlier batches are context for later ones, so a segment is one call chain; segments run in parallel.
    """
    rows = segments.join(people, ["book", "stem"]).join(facts.select("book", "stem", "summary"), ["book", "stem"])
    context = state.context_accumulate(rows, "book", "stem", "summary", summarise=lambda c: F.substr(c, F.lit(1), F.lit(500)))
    todo = rows.join(context, ["book", "stem"]).withColumn("characters", characters.with_pov("characters", "pov_name"))
    small_batches(rows.sparkSession)

    def label(frames):
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                lines, known, fine = quote_pieces(r.text), {}, True
                for s in range(0, len(lines), batch):
                    part = lines[s : s + batch]
                    got = Retrying(model, tries, 0)("speaker_labels", {"lines": part, "characters": list(r.characters), "context": r.context, "before": lines[:s]}, lambda v, n=len(part): labels_fit(v, n))
                    fine = got is not None
                    if not fine:
                        break
                    known |= {s + x["line_number"] - 1: x["speaker"] for x in got["speakers"]}
                if fine:
                    out += [(r.book, r.stem, r.context, i, known.get(i, ""), line) for i, line in enumerate(lines)]
            yield pd.DataFrame(out, columns=["book", "stem", "context_summary", "pos", "speaker", "content"])

    long = todo.select("book", "stem", "text", "characters", "context").mapInPandas(label, "book string, stem string, context_summary string, pos bigint, speaker string, content string")
    keyed = long.withColumn("k", F.struct("book", "stem", "context_summary"))
    merged = messages.merge_speaker_runs(keyed.select("k", "pos", "speaker", "content"), "k")
    return messages.to_arrays(merged, "k", ("speaker", "content")).select("k.*", "messages")


def to_chatml(dialogue: DataFrame, people: DataFrame, world: DataFrame, cards: DataFrame, mode: str = "paraphrase", min_chars: int = 200, model: LanguageModel = RULES) -> DataFrame:
    """(book, stem, pos, role, content, reasoning_content): dialogues as chats with a system prompt and reasoning."""
    frequent = characters.most_frequent(characters.appearances(people, "book", "characters"), "book")
    who = characters.resolve_user_role(people, frequent)
    rows = dialogue.join(who, ["book", "stem"]).withColumn("k", F.struct("book", "stem"))
    wanted = rows.select("book", "stem", F.posexplode(F.array_distinct(F.array_append("characters", F.col("user_role")))).alias("p", "name")).join(cards.withColumnRenamed("text", "profile"), ["book", "name"])
    cast = wanted.groupBy("book", "stem").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "name", "profile"))), lambda x: F.struct(x["name"].alias("name"), x["profile"].alias("profile"))).alias("cast"))
    asked = call_rows(rows.select("book", "stem", "user_role", "context_summary", F.lit(mode).alias("mode")), model, "task_description", ["user_role", "mode"])
    none = F.array().cast("array<struct<name: string, profile: string>>")
    task = F.coalesce(F.try_variant_get(F.try_parse_json("reply"), "$", "string"), F.col("reply"))
    prompt = asked.join(cast, ["book", "stem"], "left").join(world.withColumnRenamed("text", "world"), "book", "left")
    prompt = prompt.select("book", "stem", messages.system_prompt(task, F.coalesce("world", F.lit("")), F.coalesce("cast", none), F.col("context_summary")).alias("content"))
    long = rows.select("k", "user_role", F.posexplode("messages").alias("pos", "m")).select("k", "user_role", "pos", "m.speaker", "m.content")
    merged = messages.merge_adjacent_roles(messages.assign_roles(long, F.col("user_role")), "k")
    talk = messages.convert(messages.to_arrays(merged, "k"), "k", mode, min_chars).select("k.*", (F.col("pos") + 1).alias("pos"), "role", "content")
    whole = prompt.select("book", "stem", F.lit(0).cast("long").alias("pos"), F.lit("system").alias("role"), "content").unionByName(talk)

    def reason(told: list[str], row: dict) -> list[tuple]:
        why = None
        if row["role"] == "assistant":
            got = parse_reply(model("reasoning", {"history": "\n".join(told), "content": row["content"]}))
            why = got if isinstance(got, str) else dump(got)
        if row["content"] is not None:
            told.append(row["content"])
        return [(row["book"], row["stem"], row["pos"], row["role"], row["content"], why)]

    # the history is built where it is asked with, so no row carries the rows before it
    kinds = dict(whole.dtypes)
    return stream_fold(whole, ["book", "stem"], ["pos"], f"book {kinds['book']}, stem {kinds['stem']}, pos bigint, role string, content string, reasoning_content string", list, reason)


def split_reasoning(chat: DataFrame) -> DataFrame:
    """(book, stem, variant, messages) of chats in long form."""
    packed = messages.to_arrays(chat.withColumn("k", F.struct("book", "stem")), "k", ("role", "content", "reasoning_content"))
    return messages.reasoning_variants(packed, "k").select("k.*", "variant", "messages")


def roleplay_chats(docs: DataFrame, doc: str = "doc_id", text: str = "text", model: LanguageModel = RULES) -> DataFrame:
    """(doc, messages): documents as role-play chats, with the 2/5 fallback where lines give one block at most."""
    from collections.abc import Iterator

    lines = messages.text_lines(docs, doc, text)
    packed = lines.groupBy(doc).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]).alias("lines"))
    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[doc]

    def label(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for key, rows in zip(f[doc], f["lines"], strict=True):
                rows = list(rows)
                who = parse_reply(model("speakers", {"text": "\n".join(rows)[:2000]}))
                who = who if isinstance(who, dict) else {"speakers": [], "protagonist": "我"}
                prompt = system_prompt_or_canned(model, who | {"text": "\n".join(rows)[:1500]}, rows[0])
                for s in range(0, len(rows), 5):
                    part = rows[s : s + 5]
                    got = parse_reply(model("line_labels", {"lines": part, **who}))
                    got = got if isinstance(got, list) and len(got) == len(part) else [{}] * len(part)
                    out += [(key, s + i, line, bool(g.get("is_dialogue")), g.get("speaker"), who["protagonist"], prompt) for i, (line, g) in enumerate(zip(part, got, strict=True))]
            yield pd.DataFrame(out, columns=[doc, "pos", "line", "is_dialogue", "speaker", "protagonist", "prompt"])

    labelled = packed.mapInPandas(label, f"{doc} {kind}, pos bigint, line string, is_dialogue boolean, speaker string, protagonist string, prompt string")
    full = messages.roleplay_or_fallback(labelled, doc, F.col("protagonist"))
    prompts = labelled.groupBy(doc).agg(F.max("prompt").alias("prompt"))
    return messages.to_arrays(full, doc).join(prompts, doc).select(doc, messages.with_system("messages", F.col("prompt")).alias("messages"))


def style_chats(docs: DataFrame, doc: str = "doc_id", text: str = "text", model: LanguageModel = RULES) -> DataFrame:
    """(doc, messages): first ten lines to the user, the rest to the assistant, with a style prompt."""
    fit = docs.where(F.coalesce(F.col(text), F.lit("")) != "").withColumn("context", F.substr(F.element_at(messages.first_ten_lines(text), -1)["content"], F.lit(1), F.lit(300)))
    asked = call_rows(fit.select(doc, text, "context"), model, "style_prompt", ["context"])
    prompt = F.coalesce(F.try_variant_get(F.try_parse_json("reply"), "$", "string"), F.col("reply"))
    return asked.select(doc, messages.first_ten_lines(text, prompt).alias("messages"))


def augment_catalog(rows: DataFrame, done: DataFrame | None = None, batch: int = 10, model: LanguageModel = RULES) -> DataFrame:
    """Catalogue rows with genre, tags, summary and unknown, behind those done before."""
    todo = relational.unprocessed(rows, done) if done is not None else rows
    title = relational.title_column(todo)
    uid = "Uid" if "Uid" in todo.columns else None
    named = todo.withColumn("Uid", F.col(uid).cast("string") if uid else F.lit("unknown"))
    grouped = ordering.batches(named.select("Uid", F.col(title).alias("Title")), batch, "Uid").groupBy("batch").agg(F.to_json(F.collect_list(F.struct("Uid", F.coalesce("Title", F.lit("")).alias("Title")))).alias("items"))
    asked = call_rows(grouped, model, "augment", ["items"], parse=["items"])
    result = F.from_json("reply", "items array<struct<Uid: string, genre: string, tags: array<string>, summary: string, unknown: boolean>>")["items"]
    results = asked.select(F.posexplode(result).alias("k", "x")).select("k", "x.*")
    new = relational.augment_lookup(named, results, "k")
    return done.unionByName(new, allowMissingColumns=True) if done is not None else new


def classify(docs: DataFrame, text: str = "text", model: LanguageModel = RULES) -> DataFrame:
    """``docs`` with up to two categories each; blank texts have none and are not asked about."""
    blank = strip(F.coalesce(F.col(text), F.lit(""))) == ""
    asked = call_rows(docs.where(~blank), model, "classify", [text])
    known = F.filter(F.coalesce(F.from_json("reply", "array<string>"), F.array().cast("array<string>")), lambda c: c.isin(*CATEGORIES))
    return asked.withColumn("categories", known).drop("reply").unionByName(docs.where(blank).withColumn("categories", F.array().cast("array<string>")))


def structure_story(lines: DataFrame, story: str = "story", order: str = "line_no", line: str = "line", batch: int = 20, model: LanguageModel = RULES) -> DataFrame:
    """(story, pos, dataType, line_count, content, speaker, ...): data blocks of a story's lines, batch by batch in order."""
    kind = dict(lines.dtypes)[story]

    def ask(state: dict, key: object) -> list[tuple]:
        got = parse_reply(model("data_blocks", {"lines": state["lines"], "plot_summary": state["summary"]}))
        state["lines"], state["summary"] = [], got["updated_plot_summary"]
        out = [(key, state["n"] + i, b["dataType"], b.get("line_count", 1), b.get("content"), b.get("speaker"), b.get("actor"), b.get("character")) for i, b in enumerate(got["data_blocks"])]
        state["n"] += len(out)
        return out

    def step(state: dict, row: dict) -> list[tuple]:
        state["lines"].append(row[line])
        return ask(state, row[story]) if len(state["lines"]) == batch else []

    def finish(state: dict, key: tuple) -> list[tuple]:
        return ask(state, key[0]) if state["lines"] else []

    schema = f"{story} {kind}, pos bigint, dataType string, line_count int, content string, speaker string, actor string, character string"
    return stream_fold(lines.select(story, order, line), [story], [order], schema, lambda: {"lines": [], "summary": "", "n": 0}, step, finish)


def convert_dataset(rows: DataFrame, path: str, name: str, order: str, start: int = 0, with_classes: bool = False, model: LanguageModel = RULES) -> None:
    """Rows with ids (and categories) as a Parquet dataset with metadata."""
    out = mapping.with_ids(rows, order, start)
    writers.write_dataset(classify(out, model=model) if with_classes else out, path, name)


def fetch_dataset(rows: DataFrame, name: str, key: str, shard_bytes: int = 10_000_000, seed: int = 3252, lanes: int = 64) -> DataFrame:
    """Mapped rows in shuffled order with byte-bounded shards. Rows are dealt to lanes by hash, each lane filling shards of its own; there are ``lanes`` of them, and more where a lane would have over ``LANE_ROWS`` rows."""
    lanes = max(lanes, -(-rows.count() // LANE_ROWS))
    mapped = mapping.map_rows(rows, name, keep=(key,)).withColumn("lane", F.pmod(F.xxhash64(F.lit(seed), key), F.lit(lanes)))
    sized = mapped.withColumn("_size", writers.row_bytes(mapped.drop(key, "lane")))
    # a row's own number in its lane: keys may repeat
    ranked = cut(sized.withColumn("_rank", F.row_number().over(Window.partitionBy("lane").orderBy(F.xxhash64(F.lit(seed + 1), key), key)).cast("long")))
    shards = chunking.byte_shards(ranked, F.col("_size"), "lane", "_rank", shard_bytes)
    return ranked.join(shards, ["lane", "_rank"]).drop("_size", "_rank")


def process_rows(rows: DataFrame, process: Callable[[dict], dict | None]) -> DataFrame:
    """``rows`` through a function of a row as a dictionary; None leaves the row out."""
    small_batches(rows.sparkSession)
    names = rows.columns

    def apply(frames):
        for f in frames:
            done = [r for r in map(process, f.to_dict("records")) if r is not None]
            yield pd.DataFrame([[r.get(n) for n in names] for r in done], columns=names)

    return rows.mapInPandas(apply, rows.schema)


def split_dialogue_rows(rows: DataFrame, text: str = "text") -> DataFrame:
    return rows.withColumn(text, split_dialogue(text))


@dataclass(frozen=True)
class Step:
    """A pipeline step: its number, what it does, its function and default settings."""

    id: str
    title: str
    run: Callable[..., Any]
    defaults: dict[str, Any] = field(default_factory=dict)


STEPS = {
    s.id: s
    for s in (
        Step("1_1", "scene segmentation", segment_scenes, {"least": 2000}),
        Step("1_2", "character consolidation", consolidate_characters),
        Step("1_3", "scene facts", scene_facts),
        Step("1_4", "world and character profiles", profiles, {"percent": 20}),
        Step("1_5", "dialogue annotation", annotate_dialogue),
        Step("2_1", "conversion to chats", to_chatml, {"mode": "paraphrase", "min_chars": 200}),
        Step("2_2", "reasoning variants", split_reasoning),
    )
}

PROCESSORS: dict[str, Callable[[DataFrame], DataFrame]] = {"chatml": style_chats, "roleplay": roleplay_chats}


def list_steps() -> list[tuple[str, str]]:
    return [(s.id, s.title) for s in sorted(STEPS.values(), key=lambda s: s.id)]


def run_step(step: str, *inputs: DataFrame, **settings: Any) -> Any:
    """Run a step by id; settings override its defaults."""
    if step not in STEPS:
        raise ValueError(f"no step {step}; there are {', '.join(sorted(STEPS))}")
    return STEPS[step].run(*inputs, **(STEPS[step].defaults | settings))


def run_story_pipeline(spark: SparkSession, texts: DataFrame, mode: str = "paraphrase", least: int = 0, progress: Progress | None = None) -> DataFrame:
    """From (book, text) to reasoning variants; each step's result is kept for the next ones. ``progress`` gets the events of each step."""
    progress = progress or Progress(spark)
    with progress.stage("1_1"):
        scenes = run_step("1_1", texts.withColumnRenamed("book", "doc_id"), least=least)
        seg = cut(scenes.select(F.col("doc_id").cast("string").alias("book"), F.col("scene_id").alias("stem"), F.col("content").alias("text")))
    with progress.stage("1_2"):
        chars, people = run_step("1_2", seg)
        people = cut(people)
    with progress.stage("1_3"):
        facts = cut(run_step("1_3", seg, people, chars))
    with progress.stage("1_4"):
        world, cards = (cut(x) for x in run_step("1_4", facts, people, chars))
    with progress.stage("1_5"):
        talk = cut(run_step("1_5", seg, people, facts, chars))
    with progress.stage("2_1"):
        chat = cut(run_step("2_1", talk, people, world, cards, mode=mode))
    with progress.stage("2_2"):
        return cut(run_step("2_2", chat))
