"""Character names: validity, groups, aliases, appearances and points of view."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions.ordered import stream_fold
from storyloom.functions.text import strip
from storyloom.plans.lineage import BATCH_ROWS

# fixed values: words that are no names
PRONOUNS = (
    "我", "你", "他", "她", "它", "我们", "咱们", "你们", "他们", "她们", "它们", "自己", "自个儿", "人家", "别人", "旁人", "大伙", "大家", "诸位",
    "各位", "列位",
)
KINSHIP = (
    "父亲", "母亲", "爸爸", "妈妈", "爸", "妈", "爹", "娘", "爷爷", "奶奶", "外公", "外婆", "姥爷", "姥姥", "哥哥", "姐姐", "弟弟", "妹妹", "哥", "姐",
    "弟", "妹", "儿子", "女儿", "孩子", "儿女", "叔叔", "阿姨", "伯父", "伯母", "舅舅", "舅妈", "姑姑", "姑父", "姨夫", "姨妈", "婶婶", "姨", "侄子",
    "侄女", "外甥", "外甥女", "表哥", "表弟", "表姐", "表妹", "堂哥", "堂弟", "堂姐", "堂妹", "岳父", "岳母", "公公", "婆婆", "继父", "继母", "养父",
    "养母", "义父", "义母",
)
VAGUE = (
    "那个", "这个", "某个", "某一", "穿", "戴", "拿", "持", "握", "一", "几", "数", "男人", "女人", "老人", "小孩", "孩子", "年轻人", "中年人",
    "老年人", "众人", "大伙", "大家", "人们", "人群", "医生", "老师", "教授", "警察", "学生", "工人", "农民", "司机", "先生", "女士", "小姐", "太太",
    "夫人",
)
MOST_ALIASES, PATIENCE = 6, 5
#: a longer text is none of the words above, with a mark before it or behind
LONGEST_WORD = max(map(len, (*PRONOUNS, *KINSHIP, *VAGUE))) + 3


def is_name(c: Column) -> Column:
    """Whether a trimmed text is a name: no pronoun, no bare kinship term, no vague description."""
    words = lambda w: F.array(*[F.lit(x) for x in w])
    vague = (F.length(c) <= max(map(len, VAGUE)) + 1) & F.exists(words(VAGUE), lambda k: F.contains(c, k) & (F.length(c) <= F.length(k) + 1))
    fit = ~c.isin(*PRONOUNS) & ~c.rlike(f"^[的之]?({'|'.join(KINSHIP)})$") & ~vague
    return (c != "") & ((F.length(c) > LONGEST_WORD) | fit)


def valid_names(names: Column | str) -> Column:
    """Trimmed names of an array that are names, in order."""
    x = F.col(names) if isinstance(names, str) else names
    return F.filter(F.transform(x, strip), is_name)


def name_set(names: Column | str) -> Column:
    """Valid names, each once, in order of first occurrence."""
    return F.array_distinct(valid_names(names))


def share_score(a: list[str], b: list[str]) -> int:
    """Pairs of names that are equal or, from two characters on, contain each other."""
    return sum(x == y or (len(x) > 1 and len(y) > 1 and (x in y or y in x)) for x in a for y in b)


#: names up to this length are found by their parts; longer ones are few and compared one by one
PARTS = 24


def parts(name: str) -> set[str]:
    """The name and its stretches of two characters or more."""
    return {name} | {name[i:j] for i in range(len(name) - 1) for j in range(i + 2, len(name) + 1)}


def prune(names: list[str], freq: dict[str, int], most: int = MOST_ALIASES) -> list[str]:
    """The names that rank best by frequency and length together; earlier ones win ties."""
    by_freq = {n: i for i, n in enumerate(sorted(names, key=lambda n: -freq.get(n, 0)))}
    by_length = {n: i for i, n in enumerate(sorted(names, key=lambda n: -len(n)))}
    return sorted(names, key=lambda n: by_freq[n] + by_length[n])[:most]


class Groups:
    """Groups of names of one character, built group by group in reading order.

    Which groups share something with new names is looked up: ``whole`` has the groups of each name, ``part`` how many names of a group hold
    a stretch of characters. So only such groups are scored, however many there are.
    """

    def __init__(self) -> None:
        self.names: list[dict[str, None]] = []
        self.freq: list[dict[str, int]] = []
        self.over: list[int] = []
        self.large: set[int] = set()
        self.whole: dict[str, set[int]] = defaultdict(set)
        self.part: dict[str, dict[int, int]] = {}
        self.long: dict[str, set[int]] = defaultdict(set)

    def _scores(self, new: list[str], stretches: dict[str, set[str]]) -> dict[int, int]:
        """``share_score`` of the groups that have any. ``stretches``: the parts of each short name."""
        out: dict[int, int] = {}
        for y in new:
            if len(y) == 1:
                for g in self.whole.get(y, ()):
                    out[g] = out.get(g, 0) + 1
                continue
            for g, n in self.part.get(y, {}).items():  # names that hold y, itself too
                out[g] = out.get(g, 0) + n
            for x, groups in self.long.items():
                if y in x or x in y:
                    for g in groups:
                        out[g] = out.get(g, 0) + 1
            own = stretches[y] if len(y) <= PARTS else {y[i : i + n] for n in range(2, PARTS + 1) for i in range(len(y) - n + 1)}
            # the parts that are names: found without a step of Python for each part
            for x in own & self.whole.keys():
                if x != y and len(x) > 1:
                    for g in self.whole[x]:
                        out[g] = out.get(g, 0) + 1
        return out

    def _enter(self, g: int, name: str, stretches: dict[str, set[str]]) -> None:
        self.names[g][name] = None
        if len(name) > PARTS:
            self.long[name].add(g)
            return
        self.whole[name].add(g)
        for x in stretches[name]:
            held = self.part.get(x)
            if held is None:
                self.part[x] = {g: 1}
            else:
                held[g] = held.get(g, 0) + 1

    def _leave(self, g: int, name: str) -> None:
        del self.names[g][name], self.freq[g][name]
        if len(name) > PARTS:
            self.long[name].discard(g)
            return
        self.whole[name].discard(g)
        for x in parts(name):
            held = self.part[x]
            held[g] -= 1
            if not held[g]:
                del held[g]
            if not held:
                del self.part[x]

    def add(self, new: list[str], freq: dict[str, int]) -> None:
        if not new:
            return
        stretches = {n: parts(n) for n in new if len(n) <= PARTS}
        best = max(self._scores(new, stretches).items(), key=lambda x: (x[1], -x[0]), default=None)
        if best is None:
            self.names.append({})
            self.freq.append({})
            self.over.append(0)
        g = len(self.names) - 1 if best is None else best[0]
        for n in new:
            self.freq[g][n] = self.freq[g].get(n, 0) + freq.get(n, 1)
            if n not in self.names[g]:
                self._enter(g, n, stretches)
        if len(self.names[g]) > MOST_ALIASES:
            self.large.add(g)

    def end_segment(self) -> None:
        """Prune groups that have had too many names for several segments on end."""
        for g in list(self.large):
            self.over[g] += 1
            if self.over[g] >= PATIENCE:
                names = list(self.names[g])
                kept = prune(names, self.freq[g])
                for n in set(names) - set(kept):
                    self._leave(g, n)
                self.names[g] = dict.fromkeys(kept)
                self.over[g] = 0
                self.large.discard(g)


def group_lists(mentions: DataFrame, book: str = "book", segment: str = "segment", pos: str = "pos") -> DataFrame:
    """(book, grp, names, freqs, over): character groups of each book from mentions (segment, pos, names, freqs map), a row for each group. Names are valid ones, each once in a mention.

    The best match depends on the groups so far, so each book is one ordered fold. Its mentions stream by in order and only its groups are held.
    """

    def lists(column: pa.ListArray) -> list[list]:
        at, values = column.offsets.to_pylist(), column.values.to_pylist()
        return [values[i:j] for i, j in zip(at, at[1:], strict=False)]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, key, last, kind = Groups(), None, None, None
        out: list[tuple] = []

        def table(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (kind, pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [book, "grp", "names", "freqs", "over"])

        def end_book() -> None:
            out.extend((key, i, list(names), [g.freq[i].get(n, 0) for n in names], g.over[i]) for i, names in enumerate(g.names))

        for x in batches:
            kind = x.schema.field(book).type
            for b, seg, names, freqs in zip(x.column(book).to_pylist(), x.column(segment).to_pylist(), lists(x.column("names")), lists(x.column("freqs")), strict=True):
                if last is not None and (b != key or seg != last):
                    g.end_segment()
                if b != key:
                    if last is not None:
                        end_book()
                    g, key = Groups(), b
                last = seg
                g.add(names, dict(zip(names, freqs, strict=True)))
            while len(out) >= BATCH_ROWS:
                yield table(out[:BATCH_ROWS])
                del out[:BATCH_ROWS]
        if last is not None:
            g.end_segment()
            end_book()
        for i in range(0, len(out), BATCH_ROWS):
            yield table(out[i : i + BATCH_ROWS])

    freqs = F.transform("names", lambda n: F.coalesce(F.try_element_at("freqs", n), F.lit(1)))
    rows = mentions.where(F.col(book).isNotNull() & F.col("names").isNotNull()).select(book, segment, pos, "names", F.when(F.col("freqs").isNull(), F.transform("names", lambda n: F.lit(1))).otherwise(freqs).alias("freqs"))
    ordered = rows.repartition(book).sortWithinPartitions(book, segment, pos).drop(pos)
    return ordered.mapInArrow(fold, f"{book} {dict(mentions.dtypes)[book]}, grp int, names array<string>, freqs array<int>, over int")


def name_groups(mentions: DataFrame, book: str = "book", segment: str = "segment", pos: str = "pos") -> DataFrame:
    """(book, grp, name, freq, over): ``group_lists`` of the valid names, a row for each."""
    clean = mentions.withColumn("names", F.coalesce(name_set("names"), F.array().cast("array<string>")))
    each = group_lists(clean, book, segment, pos).select(book, "grp", F.explode(F.arrays_zip(F.col("names").alias("name"), F.col("freqs").alias("freq"))).alias("z"), "over")
    return each.select(book, "grp", "z.name", "z.freq", "over")


def alias_prune(names: DataFrame, group: str, most: int = MOST_ALIASES) -> DataFrame:
    """Names (group, pos, name, freq) of groups, at most ``most`` a group by rank of frequency plus rank of length."""
    w = lambda *o: Window.partitionBy(group).orderBy(*o)
    ranked = names.withColumn("_score", F.row_number().over(w(F.desc("freq"), "pos")) + F.row_number().over(w(F.desc(F.length("name")), "pos")))
    size = F.count("*").over(Window.partitionBy(group))
    ranked = ranked.withColumn("_rank", F.row_number().over(w("_score", "pos"))).withColumn("_n", size)
    return ranked.where((F.col("_n") <= most) | (F.col("_rank") <= most)).drop("_score", "_rank", "_n")


def merge_frequencies(a: Column, b: Column) -> Column:
    """The sum of two name counts."""
    return F.map_zip_with(a, b, lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def formal_names(names: Column | str, alias_map: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """(key, characters): names by their formal ones, in order, each once. ``alias_map``: (alias, formal)."""
    x = F.col(names) if isinstance(names, str) else names
    long = rows.select(key, F.posexplode(x).alias("pos", "alias")).join(alias_map.dropDuplicates(["alias"]), "alias", "left")
    packed = F.array_sort(F.collect_list(F.struct("pos", F.coalesce("formal", "alias").alias("n"))))
    return long.groupBy(key).agg(F.array_distinct(F.transform(packed, lambda v: v["n"])).alias("characters"))


def decorated(rows: DataFrame, key: str, names: str, aliases: DataFrame, within: list[str] | None = None) -> DataFrame:
    """(key, text): names with their aliases in brackets, joined; a fixed text where there are none. ``aliases``: (name, alias array), by the columns ``within`` where names hold inside one book only."""
    # fixed values: the bracket text and the text for no characters
    own = within or []
    long = rows.select(key, *own, F.posexplode_outer(names).alias("pos", "name")).join(aliases, [*own, "name"], "left")
    shown = F.when(F.size("alias") > 0, F.concat("name", F.lit("（别称："), F.array_join("alias", "、"), F.lit("）"))).otherwise(F.col("name"))
    packed = F.array_sort(F.collect_list(F.when(F.col("name").isNotNull(), F.struct("pos", shown.alias("v")))))
    return long.groupBy(key).agg(F.when(F.size(packed) > 0, F.array_join(F.transform(packed, lambda v: v["v"]), "、")).otherwise("无明确出场角色").alias("text"))


def appearances(rows: DataFrame, part: str, names: str) -> DataFrame:
    """(part, name, n): segments in which each trimmed name occurs."""
    each = rows.select(part, F.explode(F.array_distinct(F.filter(F.transform(names, strip), lambda x: x != ""))).alias("name"))
    return each.groupBy(part, "name").agg(F.count("*").alias("n"))


def most_frequent(counts: DataFrame, part: str) -> DataFrame:
    """(part, name, n): the most frequent name; by name where counts are equal."""
    w = Window.partitionBy(part).orderBy(F.desc("n"), "name")
    return counts.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def main_characters(counts: DataFrame, totals: DataFrame, part: str, percent: int = 20) -> DataFrame:
    """Names in at least ``percent`` of a part's segments, one at least. ``totals``: (part, total)."""
    least = F.greatest(F.lit(1), F.floor(F.col("total") * percent / 100))
    return counts.join(totals, part).where(F.col("n") >= least).drop("total")


def resolve_user_role(segments: DataFrame, frequent: DataFrame, book: str = "book") -> DataFrame:
    """Segments with ``user_role``: the first-person name, else the book's most frequent one, else the segment's first; without any they go."""
    named = segments.join(frequent.select(book, F.col("name").alias("_top")), book, "left")
    first = F.get("characters", F.lit(0))
    return named.withColumn("user_role", F.coalesce(F.when(F.col("is_pov"), F.nullif("pov_name", F.lit(""))), "_top", first)).where("user_role is not null").drop("_top")


def with_pov(names: Column | str, pov: Column | str) -> Column:
    """Names behind the point of view's, if that is missing."""
    x = F.col(names) if isinstance(names, str) else names
    p = F.col(pov) if isinstance(pov, str) else pov
    return F.when((F.coalesce(p, F.lit("")) != "") & ~F.array_contains(x, p), F.array_prepend(x, p)).otherwise(x)


def pov_fill(segments: DataFrame, book: str, order: str, groups: bool = False) -> DataFrame:
    """(book, order, pov): first-person names carried forward, and back over first-person segments before the first known one.

    With ``groups`` (a column ``aliases``: array of arrays), a new name of the same character keeps the name in use.
    """
    if not groups:
        known = F.when(F.col("is_first_person"), F.nullif("first_person_name", F.lit("")))
        w = Window.partitionBy(book).orderBy(order)
        rows = segments.withColumn("_k", known)
        rows = rows.withColumn("_fwd", F.last("_k", ignorenulls=True).over(w)).withColumn("_back", F.first("_k", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
        return rows.select(book, order, F.when(F.col("is_first_person"), F.coalesce("_fwd", "_back")).otherwise(F.nullif("first_person_name", F.lit(""))).alias("pov"))

    def step(state: dict, row: dict) -> list[tuple]:
        key, name = (row[book], row[order]), row["first_person_name"] or None
        if not row["is_first_person"]:
            return [(*key, name)]
        if not name:
            if state["cur"] is None:
                state["waiting"].append(key)
                return []
            return [(*key, state["cur"])]
        told = []
        if state["cur"] is None:
            told = [(*k, name) for k in state["waiting"]]
            state["waiting"] = []
        elif any(state["cur"] in list(g) and name in list(g) for g in (row["aliases"] if row["aliases"] is not None else [])):
            name = state["cur"]
        state["cur"] = name
        return [*told, (*key, name)]

    kinds = dict(segments.dtypes)
    rows = segments.select(book, order, F.coalesce("is_first_person", F.lit(False)).alias("is_first_person"), "first_person_name", "aliases")
    return stream_fold(rows, [book], [order], f"{book} {kinds[book]}, {order} {kinds[order]}, pov string", lambda: {"cur": None, "waiting": []}, step, lambda state, _: [(*k, None) for k in state["waiting"]])


def scene_blocks(facts: DataFrame, main: DataFrame, book: str = "book", stem: str = "stem") -> DataFrame:
    """(book, name, text): for each main character its scenes in order, with setting, behaviour and a line. ``main``: (book, name, aliases, others)."""
    # fixed values: labels of the blocks
    entry = facts.select(book, stem, "environment_facts", F.posexplode("character_facts").alias("pos", "c"))
    entry = entry.select(book, stem, "environment_facts", "pos", strip("c.name").alias("name"), "c.facts", "c.representative_quote")
    # a scene's first entry of a name: one order for that and for the scenes' numbers
    w = Window.partitionBy(book, "name").orderBy(stem, "pos")
    own = entry.join(main.select(book, "name"), [book, "name"])
    first = own.withColumn("_n", F.row_number().over(w)).withColumn("_before", F.lag(stem).over(w)).where((F.col("_n") == 1) | ~F.col("_before").eqNullSafe(F.col(stem)))
    first = first.withColumn("scene", F.row_number().over(Window.partitionBy(book, "name").orderBy(stem)))
    items = lambda c: F.transform(c, lambda x: F.concat(F.lit("-"), x))
    quote = F.when(F.coalesce("representative_quote", F.lit("")) != "", F.array(F.lit(""), F.concat(F.lit("典型台词："), "representative_quote"))).otherwise(F.array().cast("array<string>"))
    block = F.array_join(F.concat(F.array(F.concat(F.lit("\nScene "), F.col("scene").cast("string"), F.lit(":")), F.lit("环境：")), items("environment_facts"), F.array(F.lit(""), F.lit("行为：")), items("facts"), quote), "\n")
    per = first.withColumn("b", block).groupBy(book, "name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("scene", "b"))), lambda x: x["b"]), "\n").alias("blocks"))
    some = lambda c: F.when(F.size(c) > 0, F.array_join(c, "，")).otherwise("无")
    head = F.concat(F.lit("角色名："), "name", F.lit("，别称："), some("aliases"), F.lit("\n其他主要角色："), some("others"), F.lit("\n"))
    return per.join(main, [book, "name"]).select(book, "name", F.concat(head, "blocks").alias("text"))
