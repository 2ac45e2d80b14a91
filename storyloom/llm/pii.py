"""Operator 10: personal data by rules and weak supervision, in SQL expressions only.

Base kinds (email, ip, card, phone) are patterns with checks. Candidates for one more kind, ``secret`` (keys and tokens), are
words of letters, digits, ``_`` and ``-`` with a digit. Labelers of three sorts vote on each: patterns
(known key shapes, long hexadecimal), gazetteers (key prefixes, names of encodings, ciphers and platforms) and context (a naming word
before, the end of a sentence before). Votes are counted by pattern over all documents - a table bounded by the number of vote and
feature combinations - from which expectation-maximisation estimates each labeler's reliability and each pattern's
probability; a naive Bayes span classifier over the span's own features is trained with those probabilities, and
spans it gives at least ``THRESHOLD`` are added. Added spans never replace base spans and never lie inside one.

All work is linear in a text's length. Gaps and matches alternate, so starts are running sums of lengths; running sums and maxima are folded in
blocks, since a fold that appends copies its array each time; text is put together from pieces of bounded blocks. Patterns are
possessive or anchored at the start of their character run, so long runs take linear time and no recursion.

Defined results: null counts as empty; repeated rows are searched each; an empty table gives no rows; other columns, whatever their names, are
ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret")
THRESHOLD = 0.9
# fixed values: the base patterns; \G lets a match start right after another one inside a run
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    # only runs of 12 digits or more can pass; from a shorter run's later digits there are fewer still
    "card": r"(?=[0-9](?:[\x20-]?[0-9]){11})[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{12,}+",
}
_NEEDS = {"email": "contains({t}, '@')", "ip": "contains({t}, '.')", "card": "true", "phone": "contains({t}, '+')", "secret": "true"}
_VALID = {
    "email": "true",
    "ip": "forall(split({m}, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(right(p, 3) as int), 256) <= 255)",
    "card": "case when length(regexp_replace({m}, '[ -]', '')) between 12 and 19 then"
    " aggregate(split(reverse(regexp_replace({m}, '[ -]', '')), ''), named_struct('i', 0, 's', 0),"
    " (a, d) -> named_struct('i', a.i + 1, 's', a.s + case when d = '' then 0 when a.i % 2 = 0 then int(d) when int(d) > 4 then 2 * int(d) - 9 else 2 * int(d) end),"
    " a -> a.s % 10 = 0) else false end",
    "phone": "length(regexp_replace({m}, '[^0-9]', '')) between 9 and 15",
    "secret": "true",
}


def _quoted(s: str) -> str:
    return "r'" + s + "'" if "'" not in s else '"' + s.replace("\\", "\\\\") + '"'


BLOCK, PIECE = 64, 4096


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def running(values: str, combine: str, level: int = 0) -> str:
    """For each element of an int array what ``combine`` of those before it (and 0) gives; {a} and {b} stand for the two operands. Longer arrays go by blocks of ``BLOCK``."""
    x, y, z, n = (f"{v}{level}" for v in "xyzn")
    fold = f"aggregate({{v}}, named_struct('at', {{init}}, 'out', cast(array() as array<int>)), (a, v) -> named_struct('at', {combine.format(a='a.at', b='v')}, 'out', array_append(a.out, a.at)), a -> a.out)"
    if level == 3:
        return fold.format(v=values, init="0")
    parts = f"transform(sequence(0, (size({x}) - 1) div {BLOCK}), {n} -> slice({x}, {n} * {BLOCK} + 1, {BLOCK}))"
    whole = f"transform({y}, b -> aggregate(b, 0, (a, v) -> {combine.format(a='a', b='v')}))"
    blocks = let(parts, y, let(running(whole, combine, level + 1), z, f"flatten(transform({y}, (b, i) -> {fold.format(v='b', init=f'{z}[i]')}))"))
    return let(values, x, f"case when size({x}) <= {BLOCK} then {fold.format(v=x, init='0')} else {blocks} end")


def matches(text: str, kind: str) -> Column:
    """array<struct<s, e, m, b>>: valid matches of a kind in column ``text``, in code points; for secrets b is what stands before, up to 24 characters from the last match on."""
    p, secret = _quoted(PATTERNS[kind]), kind == "secret"
    before = "right(concat(coalesce(get(m, i - 1), ''), g[i]), 24)" if secret else "''"
    size = "length({})" if secret else "{}"
    gaps = f"split({text}, {p}, -1)" if secret else f"transform(split({text}, {p}, -1), g -> length(g))"
    steps = f"zip_with(g, m, (a, b) -> {size.format('a')} + coalesce(length(b), 0))"
    head = f"at[i] + {size.format('g[i]')}"
    spans = f"filter(transform(m, (x, i) -> named_struct('s', {head}, 'e', {head} + length(x), 'm', x, 'b', {before})), x -> {_VALID[kind].format(m='x.m')})"
    none = "cast(array() as array<struct<s:int,e:int,m:string,b:string>>)"
    found = let(f"regexp_extract_all({text}, {p}, 0)", "m", f"case when size(m) = 0 then {none} else {let(gaps, 'g', let(running(steps, '{a} + {b}'), 'at', spans))} end")
    return F.expr(f"case when {_NEEDS[kind].format(t=text)} and {text} rlike '[0-9@]' then {found} else {none} end")


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the arrays _email, _ip, _card and _phone."""
    return docs.withColumns({f"_{k}": matches(text, k) for k in KINDS[:4]})


# gazetteers: how keys of known services begin; encodings, ciphers, digests, protocols and platforms that hold digits; words that name a key
KEY_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "sk-", "sk_live_", "sk_test_", "pk-", "pk_live_", "rk_live_", "xoxb-", "xoxp-", "xoxa-", "AIza", "ya29", "eyJ", "hf_", "npm_", "dop_v1_", "SG_", "shpat_")
KNOWN_WORDS = ("aes-?(128|192|256)", "base(16|32|58|64)", "blake2", "chacha20", "curve25519", "ed25519", "ecdsa", "hmac-sha", "ipv[46]", "iso-?8859", "iso-?[0-9]{4,5}", "md5", "rfc-?[0-9]", "rsa-?(1024|2048|4096)", "secp(192|224|256|384|521)", "sha-?(1|2|3|224|256|384|512)", "utf-?(8|16|32)", "windows-?[0-9]", "x86_64", "amd64", "arm64", "aarch64", "covid-?19")
NAMING_WORDS = ("token", "secret", "key", "password", "passwd", "auth", "bearer", "credential")
# labelers: 1 votes for a secret, 0 against, null abstains
_LABELERS = {
    "shape": "case when m rlike '^[A-Z]{4}[A-Z0-9]{16}$' or m rlike '^[0-9a-f]{32,}$' then 1 when m rlike '^[0-9-]+$' then 0 end",
    "hex": "case when m rlike '^[0-9a-fA-F]{24,}$' then 1 when length(m) < 16 then 0 end",
    "known": f"case when m rlike '^({'|'.join(KEY_PREFIXES)})' then 1 when lower(m) rlike '^({'|'.join(KNOWN_WORDS)})' then 0 end",
    "named": f"case when before rlike '(?i)({'|'.join(NAMING_WORDS)})[a-z_]*[ ]*[=:]?[ ]*[\"]?$' then 1 when before rlike '[.,;:!?][ ]*$' then 0 end",
    "mixed": "case when m rlike '[0-9][A-Za-z]+[0-9]+[A-Za-z]+[0-9]' then 1 when m rlike '^[a-z]+-[a-z0-9-]+$' or m rlike '^[A-Za-z]+[0-9]{1,4}$' or m rlike '^[0-9-]+$' then 0 end",
}
_FEATURES = {
    "len": "case when length(m) < 16 then 0 when length(m) < 20 then 1 when length(m) < 32 then 2 when length(m) < 64 then 3 else 4 end",
    "digits": "cast(floor(4 * length(regexp_replace(m, '[^0-9]', '')) / length(m)) as int)",
    "chars": "case when m rlike '^[0-9-]+$' then 0 when m rlike '^[0-9a-f]+$' then 1 when m rlike '^[0-9A-Z]+$' then 2 when m rlike '^[0-9a-z]+$' then 3 when m rlike '[_-]' then 4 else 5 end",
    "runs": "least(5, size(regexp_extract_all(m, '[0-9]+', 0)))",
}


def candidates(docs: DataFrame, text: str) -> DataFrame:
    """One row per candidate span, with votes v_* and features f_*."""
    spans = docs.select(F.explode(matches(text, "secret")).alias("_c"))
    spans = spans.select(F.col("_c.m").alias("m"), F.col("_c.b").alias("before"))
    return spans.selectExpr(*[f"{e} as v_{k}" for k, e in _LABELERS.items()], *[f"cast({e} as int) as f_{k}" for k, e in _FEATURES.items()])


def estimate(counts: list[tuple[tuple, tuple, int]], rounds: int = 60) -> tuple[dict[tuple, float], list[tuple[float, float]]]:
    """EM over vote patterns: probability of a secret for each pattern, and (true, false positive rate) of each labeler."""
    patterns: dict[tuple, int] = {}
    for votes, _, n in counts:
        patterns[votes] = patterns.get(votes, 0) + n
    if not patterns:
        return {}, []
    k = len(next(iter(patterns)))
    rates, prior = [(0.8, 0.1)] * k, 0.3
    post: dict[tuple, float] = {}
    for _ in range(rounds):
        for votes in patterns:
            odds = math.log(prior / (1 - prior))
            for v, (t, f) in zip(votes, rates, strict=True):
                if v is not None:
                    odds += math.log(t / f) if v else math.log((1 - t) / (1 - f))
            post[votes] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
        total = sum(patterns.values())
        prior = min(0.95, max(0.001, (1 + sum(n * post[v] for v, n in patterns.items())) / (2 + total)))
        new = []
        for j in range(k):
            yes = sum(n * post[v] for v, n in patterns.items() if v[j] is not None)
            no = sum(n * (1 - post[v]) for v, n in patterns.items() if v[j] is not None)
            t = (4 + sum(n * post[v] for v, n in patterns.items() if v[j])) / (5 + yes)
            f = (0.5 + sum(n * (1 - post[v]) for v, n in patterns.items() if v[j])) / (5 + no)
            new.append((min(0.999, max(0.5, t)), min(0.5, max(0.001, f))))
        rates = new
    return post, rates


def train(docs: DataFrame, text: str) -> tuple[float, list[dict[int, float]]]:
    """Bias and log-odds of each feature's values, for ``score``."""
    c = candidates(docs, text)
    v, f = [f"v_{k}" for k in _LABELERS], [f"f_{k}" for k in _FEATURES]
    # at most 3**labelers votes times the feature values: bounded whatever the data
    rows = c.groupBy(*v, *f).agg(F.count("*").alias("n")).collect()
    counts = [(tuple(r[x] for x in v), tuple(r[x] for x in f), r["n"]) for r in rows]
    post, _ = estimate(counts)
    yes = sum(n * post[p] for p, _, n in counts)
    no = sum(n * (1 - post[p]) for p, _, n in counts)
    tables = []
    for j in range(len(f)):
        table = {}
        for value in sorted({x[j] for _, x, _ in counts}):
            a = 0.5 + sum(n * post[p] for p, x, n in counts if x[j] == value)
            b = 0.5 + sum(n * (1 - post[p]) for p, x, n in counts if x[j] == value)
            table[value] = math.log((a / (yes + 3)) / (b / (no + 3)))
        tables.append(table)
    return math.log((yes + 0.5) / (no + 0.5)), tables


def secret_test(model: tuple[float, list[dict[int, float]]], m: str) -> str:
    """A SQL condition on a candidate's characters."""
    bias, tables = model
    terms = [f"{bias!r}D"]
    for (_, e), table in zip(_FEATURES.items(), tables, strict=True):
        e = e.replace("(m", f"({m}").replace("m rlike", f"{m} rlike")
        if table:
            terms.append(f"(case cast({e} as int) " + " ".join(f"when {k} then {v!r}D" for k, v in table.items()) + " else 0D end)")
    return f"({' + '.join(terms)}) >= {math.log(THRESHOLD / (1 - THRESHOLD))!r}D"


def with_spans(docs: DataFrame, text: str, model: tuple[float, list[dict[int, float]]] | None = None) -> DataFrame:
    """``docs`` with ``_spans``: array<struct<s, k, e>> of all spans by start, then kind; k is the kind's number."""
    model = model or train(docs, text)
    base = with_base(docs, text).withColumn("_secret", matches(text, "secret"))
    tagged = [f"transform(_{k}, x -> named_struct('s', x.s, 'k', {i}, 'e', x.e))" for i, k in enumerate(KINDS[:4])]
    base = base.withColumn("_base", F.expr(f"array_sort(concat({', '.join(tagged)}))"))
    added = f"transform(filter(_secret, x -> {secret_test(model, 'x.m')}), x -> named_struct('s', x.s, 'k', 4, 'e', x.e))"
    base = base.withColumn("_all", F.expr(f"array_sort(concat(_base, {added}))"))
    # base spans of one start come first, so an added span lies inside one if the furthest end of those before reaches its own
    reach = running("transform(_all, x -> case when x.k < 4 then x.e else 0 end)", "greatest({a}, {b})")
    clear = let(reach, "r", "filter(transform(_all, (x, i) -> named_struct('x', x, 'r', r[i])), y -> y.x.k < 4 or y.r < y.x.e)")
    return base.withColumn("_spans", F.expr(f"case when size(_secret) = 0 then _base else transform({clear}, y -> y.x) end"))


def _line(spans: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', element_at(array({names}), x.k + 1), x.s, x.e)), ',')")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: tuple[float, list[dict[int, float]]] | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    got = with_spans(src, "_text", model)
    return got.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(_line("_base").cast("binary"), 256).alias("base_sha256"),
        _line("_spans").alias("spans"),
        (F.size("_spans") - F.size("_base")).cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, text_col: str = "text", model: tuple[float, list[dict[int, float]]] | None = None) -> DataFrame:
    """``docs`` with each span of the text replaced by its kind in brackets; null stays null."""
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    got = with_spans(src, "_text", model)
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    reach = running("transform(_spans, x -> x.e)", "greatest({a}, {b})")
    part = lambda f, t: (
        f"case when {f} div {PIECE} = {t} div {PIECE} then substring(p[{f} div {PIECE}], {f} % {PIECE} + 1, {t} - {f})"
        f" else concat(substring(p[{f} div {PIECE}], {f} % {PIECE} + 1), array_join(slice(p, {f} div {PIECE} + 2, {t} div {PIECE} - {f} div {PIECE} - 1), ''), substring(coalesce(get(p, {t} div {PIECE}), ''), 1, {t} % {PIECE})) end"
    )
    # a span that starts inside an earlier one only moves on where the text goes on
    heads = "filter(transform(_spans, (x, i) -> named_struct('f', r[i], 's', x.s, 'k', x.k)), y -> y.f <= y.s)"
    shown = f"array_join(transform({heads}, y -> concat({part('y.f', 'y.s')}, element_at(array({names}), y.k + 1))), '')"
    rest = let("greatest(r[size(r) - 1], _spans[size(r) - 1].e)", "z", f"case when z >= length(_text) then '' else {part('z', 'length(_text)')} end")
    clean = f"case when size(_spans) = 0 then _text else {let(f'regexp_extract_all(_text, {chr(39)}(?s).{{1,{PIECE}}}{chr(39)}, 0)', 'p', let(reach, 'r', f'concat({shown}, {rest})'))} end"
    new = F.when(F.col(f"_row.`{text_col}`").isNull(), F.lit(None).cast("string")).otherwise(F.expr(clean))
    return got.select(*[new.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
