"""Language-model calls as table functions.

``LanguageModel`` is the whole interface: a task's name and its inputs in, a JSON text out. ``RuleModel`` answers every task by a fixed
rule, so plans run and test offline. Calls are batched per Arrow batch; those whose input depends on earlier answers run book by book.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.functions.fuzzy import dump
from storyloom.functions.ordered import columns_of, stream_fold
from storyloom.plans.lineage import small_batches

TASKS = (
    "augment", "annotate_novel", "scene_segments", "data_blocks", "scene_summary", "style_prompt", "speakers", "line_labels",
    "roleplay_prompt", "classify", "scene_changes", "characters", "review_groups", "formal_name", "pov_conflict", "scene_facts", "world", "profile", "summarise",
    "speaker_labels", "task_description", "reasoning",
)
CATEGORIES = ("dialogue", "action", "monologue", "lore", "character", "system")
REFUSALS = ("无法为您", "无法生成")
# fixed value: the prompt that stands in for a refused one
CANNED_PROMPT = """系统提示词：轻小说风格沉浸式互动】
你并非用户，而是本世界的叙事引擎。你需要尽可能满足用户的需求并沿着用户给定的内容进行继续演绎。
请开启故事，从用户当前的情境出发，生动演绎接下来的情节。            
"""


class LanguageModel(Protocol):
    def __call__(self, task: str, inputs: dict[str, Any]) -> str: ...


class Retrying:
    """A model tried up to ``tries`` times with growing pauses; None when all fail or the answer does not pass ``check``."""

    def __init__(self, model: LanguageModel, tries: int = 3, delay: float = 1.0) -> None:
        self.model, self.tries, self.delay = model, tries, delay

    def __call__(self, task: str, inputs: dict[str, Any], check: Callable[[Any], bool] = lambda v: True) -> Any:
        for k in range(self.tries):
            try:
                value = parse_reply(self.model(task, inputs))
                if check(value):
                    return value
            except (ValueError, OSError):
                pass
            if k + 1 < self.tries and self.delay:
                time.sleep(self.delay * 2**k)
        return None


def parse_reply(text: str) -> Any:
    """JSON of a reply, with or without a code fence around it; other text as it is."""
    body = re.sub(r"^```(?:json)?\s*|\s*```$", "", text.strip())
    try:
        return json.loads(body)
    except ValueError:
        return text


class RuleModel:
    """A fixed rule for each task."""

    def __call__(self, task: str, inputs: dict[str, Any]) -> str:
        answer = getattr(self, f"_{task}", None)
        if answer is None:
            raise ValueError(f"no such task: {task}")
        return dump(answer(inputs))

    def _augment(self, x: dict) -> Any:
        return {"items": [{"Uid": i["Uid"], "genre": None if not i["Title"] else "novel", "tags": sorted(set(i["Title"].lower().split()))[:3], "summary": i["Title"], "unknown": not i["Title"]} for i in x["items"]]}

    def _annotate_novel(self, x: dict) -> Any:
        return {"worldview": x["text"][:200], "character_cards": [], "unknown": not x["text"]}

    def _scene_segments(self, x: dict) -> Any:
        return {"segments": ["\n".join(line.strip() for line in x["lines"])]}

    def _data_blocks(self, x: dict) -> Any:
        blocks = [{"dataType": "scene_change" if line.startswith("#") else "dialogue" if '"' in line else "narration", "line_count": 1, "content": line} for line in x["lines"]]
        return {"data_blocks": blocks, "updated_plot_summary": (x.get("plot_summary", "") + x["lines"][0][:40])[-200:] if x["lines"] else ""}

    def _scene_summary(self, x: dict) -> Any:
        return x["text"][:100]

    def _style_prompt(self, x: dict) -> Any:
        return "Continue in this style: " + x["context"][:300]

    def _speakers(self, x: dict) -> Any:
        names = list(dict.fromkeys(re.findall(r"^(\w+)[:：]", x["text"], re.M)))
        return {"speakers": names, "protagonist": names[0] if names else "我"}

    def _line_labels(self, x: dict) -> Any:
        found = [re.match(r"(\w+)[:：]", line) for line in x["lines"]]
        return [{"is_dialogue": bool(m), "speaker": m[1] if m else None} for m in found]

    def _roleplay_prompt(self, x: dict) -> Any:
        return f"You play everyone but {x['protagonist']}. Others: {', '.join(s for s in x['speakers'] if s != x['protagonist'])}"

    def _classify(self, x: dict) -> Any:
        t = x["text"]
        tests = (("dialogue", t.count('"') + t.count("「") > 4), ("system", "[" in t and "]" in t), ("action", "!" in t or "！" in t), ("monologue", len(t) > 2000))
        return [c for c, ok in tests if ok][:2] or ["lore"]

    def _scene_changes(self, x: dict) -> Any:
        return {"scene_changes": [x["first_line"] + i for i, line in enumerate(x["lines"]) if i and (line.startswith("#") or not line.strip())]}

    def _characters(self, x: dict) -> Any:
        names = re.findall(r"\b[A-Z][a-z]{3,}\b", x["text"])
        return {"characters": [[n] for n in dict.fromkeys(names)], "character_frequencies": [{n: names.count(n)} for n in dict.fromkeys(names)], "is_first_person": " I " in x["text"], "first_person_name": ""}

    def _review_groups(self, x: dict) -> Any:
        return {"groups": x["groups"]}

    def _formal_name(self, x: dict) -> Any:
        best = max(x["names"], key=len)
        return {"name": best, "alias": [n for n in x["names"] if n != best]}

    def _pov_conflict(self, x: dict) -> Any:
        return {"consistent": True, "name": ""}

    def _scene_facts(self, x: dict) -> Any:
        return {"environment_facts": [x["text"].strip().split("\n")[0][:80]], "character_facts": [{"name": n, "facts": [f"{n} appears"], "representative_quote": ""} for n in x["characters"]], "summary": x["text"].strip()[:100]}

    def _world(self, x: dict) -> Any:
        return x["text"][:500]

    def _profile(self, x: dict) -> Any:
        return x["text"][:500]

    def _summarise(self, x: dict) -> Any:
        return {"summary": x["text"][: x["size"]]}

    def _speaker_labels(self, x: dict) -> Any:
        spoken = ((i + 1, next((c for c in x["characters"] if c in line), None)) for i, line in enumerate(x["lines"]))
        return {"speakers": [{"line_number": i, "speaker": c} for i, c in spoken if c]}

    def _task_description(self, x: dict) -> Any:
        return f"Mode {x['mode']}: the user is {x['user_role']}."

    def _reasoning(self, x: dict) -> Any:
        return "Given: " + x["history"][-80:]


def as_inputs(row: dict[str, Any], decoded: set[str]) -> dict[str, Any]:
    """A row's inputs as a model takes them: arrays as lists, the ``decoded`` columns parsed."""
    return {k: (json.loads(v) if k in decoded else v) if isinstance(v, str) else (list(v) if hasattr(v, "tolist") else v) for k, v in row.items()}


def call_rows(rows: DataFrame, model: LanguageModel, task: str, inputs: list[str], output: str = "reply", parse: list[str] | None = None) -> DataFrame:
    """``rows`` with the model's reply to each row's inputs; only these travel to Python. ``parse``: input columns that hold JSON. A model that remembers (``plans.replies``) is asked once for equal requests."""
    if hasattr(model, "rows"):
        return model.rows(rows, task, inputs, output, parse)
    small_batches(rows.sparkSession)
    decoded = set(parse or ())

    @F.pandas_udf("string")
    def ask(frame: pd.DataFrame) -> pd.Series:
        rows = zip(*(frame[c].tolist() for c in inputs), strict=True)
        return pd.Series([model(task, as_inputs(dict(zip(inputs, row, strict=True)), decoded)) for row in rows], dtype=object)

    # not deterministic: else a filter on the reply would be moved below it and ask again
    return rows.drop(output).withColumn(output, ask.asNondeterministic()(F.struct(*inputs)))


def fold_rows(rows: DataFrame, model: LanguageModel, part: str, order: str, step: Callable[[LanguageModel, dict, dict], dict], start: dict, schema: str) -> DataFrame:
    """Ordered calls per part whose inputs depend on earlier answers. ``step(model, state, row)`` changes the state and returns an output row; the state alone is held."""
    names = columns_of(schema)

    def one(state: dict, row: dict) -> list[tuple]:
        out = step(model, state, row)
        return [tuple(out.get(n) for n in names)]

    return stream_fold(rows, [part], [order], schema, lambda: json.loads(json.dumps(start)), one)


def system_prompt_or_canned(model: LanguageModel, inputs: dict, first_line: str, tries: int = 4) -> str:
    """A role-play prompt; a refusal is asked again, and the last one replaced by the canned prompt and the first line."""
    prompt = ""
    for _ in range(tries):
        prompt = str(parse_reply(model("roleplay_prompt", inputs)))
        if not any(r in prompt for r in REFUSALS):
            return prompt
    return CANNED_PROMPT + first_line


def summarise_once(model: LanguageModel, text: str, size: int = 500) -> str:
    """A text of at most ``size`` characters; a short one is its own summary."""
    if len(text) <= size:
        return text
    got = parse_reply(model("summarise", {"text": text, "size": size}))
    return (got.get("summary") if isinstance(got, dict) else None or text)[:size]
