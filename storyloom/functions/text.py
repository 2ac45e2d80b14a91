"""Text functions as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_WS = r"[\s\x1c-\x1f]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space of all scripts from both ends."""
    return F.regexp_replace(col(c), rf"(?U)^{_WS}+|{_WS}+$", "")


def split_lines(c: Column | str) -> Column:
    """All line ends separate; a last one does not open an empty line."""
    parts = F.split(col(c), LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def clean_lines(c: Column | str) -> Column:
    """Stripped lines without blank ones."""
    return F.filter(F.transform(split_lines(c), strip), lambda x: x != "")


def _texts(pieces: Column, narration: Column) -> Column:
    return F.transform(F.filter(pieces, lambda x: x != ""), lambda x: F.struct(narration.alias("narration"), x.alias("s")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def split_dialogue(c: Column | str) -> Column:
    """Quoted speech on lines of its own, narration cut after ellipses; with under three lines narration is also cut after sentences."""
    text = col(c)
    quote = r"[“「][^\n]*?[”」]"

    def narration(part: Column) -> Column:
        lines = F.split(F.regexp_replace(part, r"(\.{3,}|。{3,})", "$1\n"), "\n")
        return _texts(F.transform(F.transform(lines, strip), lambda x: F.regexp_replace(x, "。{2,}", "。")), F.lit(True))

    def pieces(x: Column) -> Column:
        return F.flatten(F.transform(x["told"], lambda t, i: F.concat(narration(t), _texts(F.array(strip(F.coalesce(F.get(x["said"], i), F.lit("")))), F.lit(False)))))

    def sentences(x: Column) -> Column:
        cut = F.split(F.regexp_replace(x["s"], r"([。！!])(?![\"”」]|$)", "$1\n"), "\n")
        return F.when(x["narration"], F.filter(F.transform(cut, strip), lambda y: y != "")).otherwise(F.array(x["s"]))

    def lines(x: Column) -> Column:
        return F.array_join(F.when(F.size(x) < 3, F.flatten(F.transform(x, sentences))).otherwise(F.transform(x, lambda y: y["s"])), "\n")

    # told and said, and the pieces made of them, are bound: in a lambda they would be computed again for each element
    parts = F.struct(F.split(text, quote, -1).alias("told"), F.regexp_extract_all(text, F.lit(f"({quote})"), F.lit(0)).alias("said"))
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("")).otherwise(let(let(parts, pieces), lines))


def unquote(c: Column | str, curly: bool = False) -> Column:
    """Without the outermost pair of quotes, the first pair that fits."""
    x = col(c)
    out = x
    pairs = [('"', '"'), *([("“", "”")] if curly else []), ("「", "」"), ("『", "』")]
    for a, b in reversed(pairs):
        out = F.when(x.startswith(a) & x.endswith(b) & (F.length(x) >= 2), F.substr(x, F.lit(2), F.length(x) - 2)).otherwise(out)
    return out


def strip_ansi(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "\\x1b\\[[0-9;]*[a-zA-Z]", "")


def safe_file_name(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r'[\\/:*?"<>|]', "_")


def safe_title(c: Column | str) -> Column:
    """Letters, digits, space, hyphen and underscore."""
    return strip(F.regexp_replace(col(c), r"[^\p{L}\p{N} _-]", ""))


def unescape_newlines(c: Column | str) -> Column:
    return F.replace(col(c), F.lit("\\n"), F.lit("\n"))


def strip_code_fence(c: Column | str) -> Column:
    """Without a leading ```json or ``` line and a trailing ```."""
    return strip(F.regexp_replace(F.regexp_replace(strip(c), r"^```(?:json)?\s*", ""), r"\s*```$", ""))


def first_json_array(c: Column | str) -> Column:
    return F.regexp_extract(col(c), r"(?s)\[.*\]", 0)


def first_json_object(c: Column | str) -> Column:
    return F.regexp_extract(col(c), r"(?s)\{.*\}", 0)


def numbered_lines(lines: Column | str, start: Column | int = 1) -> Column:
    """Lines as ``n: line``, joined."""
    first = F.lit(start) if isinstance(start, int) else start
    return F.array_join(F.transform(col(lines), lambda x, i: F.concat_ws(": ", (i + first).cast("string"), x)), "\n")


def dialogue_stem(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"_dialogue\.json$", "")


def chatml_stem(c: Column | str) -> Column:
    return F.replace(F.regexp_replace(col(c), r"\.json$", ""), F.lit("_chatml"), F.lit(""))


def repo_id(c: Column | str) -> Column:
    """The owner/name part of a dataset hub's address, or the value itself."""
    x = col(c)
    return F.coalesce(F.nullif(F.regexp_extract(x, r"huggingface\.co/datasets/([^/?#]+/[^/?#]+)", 1), F.lit("")), x)


def repo_file_name(c: Column | str) -> Column:
    return F.replace(col(c), F.lit("/"), F.lit("_"))


def export_name(c: Column | str) -> Column:
    return F.replace(col(c), F.lit(" "), F.lit("_"))


def split_names(c: Column | str) -> Column:
    return F.filter(F.split(col(c), "/"), lambda x: x != "")


def options_list(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(col(c), ","), strip), lambda x: x != "")


def natural_key(c: Column | str) -> Column:
    """A sort key: digit runs by value (their length comes first), the rest in lower case."""
    parts = F.regexp_extract_all(F.lower(col(c)), F.lit(r"[0-9]+|[^0-9]+"), F.lit(0))
    digits = lambda x: F.regexp_replace(x, "^0+(?=.)", "")
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike("^[0-9]+$"), F.concat(F.lit("0"), F.lpad(F.length(digits(x)).cast("string"), 9, "0"), digits(x))).otherwise(x)), "")


def display_time(c: Column | str) -> Column:
    return F.replace(F.substr(col(c), F.lit(1), F.lit(19)), F.lit("T"), F.lit(" "))


def gap_seconds(a: Column | str, b: Column | str) -> Column:
    """Seconds from ISO time a to b; null where either cannot be read."""
    at = lambda x: F.unix_micros(F.try_to_timestamp(F.regexp_replace(col(x), "Z$", "+00:00"))) / F.lit(1e6)
    return at(b) - at(a)


def preview(c: Column | str, size: int = 100) -> Column:
    """The start of a value, JSON in compact form; null and empty give an empty text."""
    x = col(c)
    # the parser stops behind the first value; a mark that no text can hold itself shows that the text was one value
    mark = F.md5(x)
    read = F.try_parse_json(F.concat(F.lit("["), x, F.lit(',"'), mark, F.lit('"]')))
    whole = F.when(F.try_variant_get(read, "$[1]", "string") == mark, F.to_json(F.try_variant_get(read, "$[0]", "variant")))
    return F.substr(F.coalesce(whole, x, F.lit("")), F.lit(1), F.lit(size))


def character_card_markdown(card: Column) -> Column:
    """A character card as markdown sections."""
    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"- **{label}**："), F.coalesce(value, F.lit("")))

    p, q, v, k = card["profile"], card["personality"], card["linguistic_fingerprint"], card["knowledge_boundary"]
    # fixed values: the card's headings
    parts = [
        F.concat(F.lit("# 角色卡 - "), p["name"]), F.lit(""),
        F.lit("## 1. 基础信息 (Profile)"), line("角色名", p["name"]), line("核心身份", p["identity"]), line("年龄/视觉印象", p["impression"]), F.lit(""),
        F.lit("## 2. 性格内核 (Core Personality)"), line("三个关键词", F.array_join(q["keywords"], ", ")), line("行为逻辑", q["logic"]), line("道德基准", q["ethics"]), F.lit(""),
        F.lit("## 3. 语言指纹 (Linguistic Fingerprint)"), line("语调", v["tone"]), line("口癖/习惯", v["habit"]), line("称谓", v["address"]), F.lit(""),
        F.lit("## 4. 知识边界 (Knowledge & Bias)"), line("已知", F.array_join(k["known"], ", ")), line("未知/偏见", k["bias"]), F.lit(""),
        F.lit("## 5. 经典范例 (Sample Dialogue)"),
    ]
    quotes = F.transform(card["sample_dialogue"], lambda x: F.concat(F.lit("- “"), x, F.lit("”")))
    return unescape_newlines(F.concat(F.array_join(F.concat(F.array(*parts), quotes), "\n"), F.lit("\n")))
