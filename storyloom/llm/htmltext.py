"""Operator 9: main text by the maximum-scoring contiguous region.

A page becomes a line of tokens: words, each scoring +1, and tags, each scoring negative. Weights are learned from labelled
pages: those that mark their content with an ``article`` or ``main`` element, among the ``FIT_PAGES`` or so that the
hashes of their ids choose; they are counted where they are read, and only counts of tags and words reach the driver. What occurs mostly
outside the marked content costs up to ``COST`` words, what occurs inside it little. This holds for tag names and for the words in ``class``,
``id`` and ``role``; fixed lists of words count as a few sightings, which the pages outvote. An element whose words together speak for the outside
is one token without words, and so are, by syntax, scripts, styles, forms, comments, hidden elements and those that the HTML
standard gives a role beside the content (a content element's own header is content); the text of drawings, formulas and media counts. One scan finds the best-scoring region, and its words, blocks in order, are the text.

Pages are read in one pass, whatever their quotes: what the search for a tag's end has seen once is remembered.

Defined results: null or empty html gives an empty text; unclosed or cut-off markup ends at the page's end; an unclosed
element without content ends at the next heading or content element, an unclosed select at the next tag that is not its own, an
unclosed svg or math at the next HTML tag; ties go to the earliest, longest region; repeated rows are
extracted each; pages with a null id are not used for the fit.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.runtime import source
from storyloom.llm.vectext import record

FIT_PAGES = 1000
COST = 20.0
LEAST = 0.05
#: what an element without content costs at most
BARRIER = 1.0
#: odds from which on an element is taken to lie outside the content
ODDS = 4.0
#: what entering a quiet element costs at most
BRIDGE = 10
#: words of a small element; the part of a page's words that a list's word may take away; the share of linked words that makes a list of links
SMALL, PART, LINKS = 40, 0.34, 0.6
#: sightings that an entry of the fixed lists counts for, and what a sighting inside counts against the outside's list: labels mark regions, which hold adverts too
SEEN, WITHIN = 8, 0.25

# fixed values: element names of the HTML standard, by role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style noscript template textarea title iframe".split())
FOREIGN = frozenset("svg math".split())
EMBEDDED = FOREIGN | frozenset("object canvas audio video".split())
IN_SELECT = frozenset("option optgroup hr".split())
FORMS = frozenset("head form select button fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BESIDE = frozenset("nav header footer aside menu dialog".split())
CONTENT = frozenset("article main".split())
# what ends an unclosed svg or math
HTML = FORMS | BESIDE | CONTENT | frozenset("html body section address b big blockquote br center code dd details div dl dt em embed figcaption figure h1 h2 h3 h4 h5 h6 hr i img li meta nobr ol p pre ruby s small span strong strike sub summary sup table tbody td tfoot th thead tr tt u ul var font object canvas audio video".split())
# fixed values: words in class, id and role that speak for the outside (a star: and words that begin so) and for the content
#: these say little inside a content element, where a section's header or a notice that the article is about may have them
VAGUE = "header notice* alert* related recommend* tag tags search social share sharing toolbar* widget* banner* dialog".split()
OUTSIDE = "ad ads advert* sponsor* promo* banner* nav* menu* breadcrumb* sidebar* widget* footer* header masthead cookie* consent* notice* alert* popup* modal* newsletter* subscri* share sharing social related recommend* comment* disqus replies respond login signup search toolbar* pagination pager tag tags skip complementary contentinfo dialog".split()
INSIDE = "article post entry story main content".split()

_START = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
# attributes without < or > in them, so that a failed try ends at the next of these
_PLAIN = re.compile(r"""(?:[^<>"']++|"[^"<>]*"|'[^'<>]*')*+>""")
_SPECIAL = re.compile(r"""[>"']""")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORDS = re.compile("[a-z]{2,24}")
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}


class TagEnds:
    """Where the tags of a page end: at the first ``>`` outside quotes. Each quote is looked at once, whatever the tags' number."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.special: list[int] | None = None
        self.known: dict[int, int] = {}

    def find(self, at: int) -> int:
        """Place of the ``>`` for attributes that start at ``at``; -1 without one."""
        if m := _PLAIN.match(self.page, at):
            return m.end() - 1
        if self.special is None:
            self.special = [m.start() for m in _SPECIAL.finditer(self.page)]
        way: list[int] = []
        end = -1
        i = bisect_left(self.special, at)
        while i < len(self.special):
            p = self.special[i]
            if self.page[p] == ">":
                end = p
                break
            if p in self.known:
                end = self.known[p]
                break
            way.append(p)
            close = self.page.find(self.page[p], p + 1)
            if close < 0:
                break
            i = bisect_left(self.special, close + 1)
        self.known.update(dict.fromkeys(way, end))
        return end


def scan(page: str) -> list[tuple[str, str, str]]:
    """(kind, value, attributes) in page order: "text", "open", "close", and "empty" for what syntax leaves without content."""
    out: list[tuple[str, str, str]] = []
    ends = TagEnds(page)
    at = done = foreign = 0
    while m := _START.search(page, at):
        if m.start() > done:
            out.append(("text", page[done : m.start()], ""))
        if m[0] == "<!--":
            end = page.find("-->", m.end())
            at = done = len(page) if end < 0 else end + 3
            continue
        if m[0] in ("<!", "<?"):
            end = page.find(">", m.end())
            at = done = len(page) if end < 0 else end + 1
            continue
        tag = _NAME.match(page, m.start())
        name = tag[2].lower()
        end = ends.find(tag.end())
        if end < 0:
            # never closed: up to the next tag or the page's end, without content
            after = re.compile("[<>]").search(page, tag.end())
            at = done = len(page) if after is None else after.start() + (after[0] == ">")
            continue
        attrs = page[tag.end() : end]
        at = done = end + 1
        if name in RAW and not tag[1]:
            if not (foreign and attrs.endswith("/")):
                close = _CLOSE[name].search(page, at)
                at = done = len(page) if close is None else close.end()
                out.append(("empty", name, ""))
            continue
        if name in FOREIGN:
            foreign = max(0, foreign - 1) if tag[1] else foreign + (not attrs.endswith("/"))
        elif foreign and name not in HTML:
            out.append(("text", " ", ""))  # parts of a drawing or formula weigh nothing
            continue
        else:
            foreign = 0
        out.append(("close" if tag[1] else "open", name, attrs))
    if done < len(page):
        out.append(("text", page[done:], ""))
    return out


def class_words(attrs: str) -> list[str]:
    """The words in class, id and role."""
    return _WORDS.findall(" ".join(_NAMED.findall(attrs)).lower()) if attrs else []


def _listed(word: str) -> int:
    """1 for words of the outside, -1 for the content's, else 0."""
    return -1 if word in _INSIDE else int(word in _OUTSIDE or word.startswith(_BEGIN))


_INSIDE, _OUTSIDE = frozenset(INSIDE), frozenset(w for w in OUTSIDE if w[-1] != "*")
_BEGIN = tuple(w[:-1] for w in OUTSIDE if w[-1] == "*")
_VAGUE, _VAGUE_BEGIN = frozenset(w for w in VAGUE if w[-1] != "*"), tuple(w[:-1] for w in VAGUE if w[-1] == "*")


def cost(inside: float, outside: float, doubt: float = 1) -> float:
    return -(LEAST + COST * outside / (inside + outside + doubt))


def _odds(key: str, listed: int, weights: dict[str, float]) -> float:
    """Log odds that something is outside: from its learned weight, else from the lists."""
    w = weights.get(key)
    if w is None:
        if not listed:
            return 0.0
        w = cost(SEEN * (listed < 0), SEEN * (listed > 0))
    share = min(0.98, max(0.02, (-w - LEAST) / COST))
    return math.log(share / (1 - share))


class Sizes:
    """Words, words in links and headings of any stretch of a page's tokens."""

    def __init__(self, flat: list[tuple[str, str, str]]) -> None:
        self.words, self.linked, self.headings = [0], [0], [0]
        links = 0
        for kind, value, _ in flat:
            if value == "a" and kind in ("open", "close"):
                links = int(kind == "open")
            n = len(value.split()) if kind == "text" else 0
            self.words.append(self.words[-1] + n)
            self.linked.append(self.linked[-1] + n * links)
            self.headings.append(self.headings[-1] + (kind == "open" and value in HEADINGS))

    def of(self, i: int, end: int) -> tuple[int, int, int]:
        return tuple(x[end] - x[i] for x in (self.words, self.linked, self.headings))


OUT, QUIET, PLAIN = "out", "quiet", ""


def judged(name: str, attrs: str, weights: dict[str, float], inside: bool = False, size: tuple[int, int, int, int] = (0, 0, 0, 0)) -> str:
    """``OUT`` for an element that is one token without words, ``QUIET`` for one whose words score nothing, else ``PLAIN``. A content element's own header is content.

    ``size``: words, words in links and headings of the element, and the words of the page.
    """
    if name in FORMS:
        return OUT
    if name in CONTENT or name in ("html", "body"):
        return PLAIN
    if attrs and _HIDDEN.search(attrs):
        return OUT
    if name in BESIDE and not (inside and name == "header"):
        return OUT
    words = [*dict.fromkeys(class_words(attrs))]
    if sum(_odds(f".{w}", _listed(w), weights) for w in words) < math.log(ODDS):
        return PLAIN
    seen = [w for w in words if f".{w}" in weights]
    if sum(_odds(f".{w}", 0, weights) for w in seen) >= math.log(ODDS):
        return OUT
    n, linked, headings, page = size
    vague = not any(_listed(w) > 0 and not (w in _VAGUE or w.startswith(_VAGUE_BEGIN)) for w in words)
    if linked > LINKS * n or not n:
        return OUT
    if inside and vague:
        return PLAIN
    small = n <= SMALL if headings or vague else n <= page * PART
    return OUT if small and not (vague and headings) else QUIET


def parse(page: str, weights: dict[str, float]) -> list[tuple[str, str, str]]:
    """(kind, value, attributes) in page order: "text" with its characters ("mute" where they score nothing), "tag" with name or /name, "quiet" with what entering costs, "empty" for what holds no content."""
    flat = scan(page)
    ends = _ends(flat)
    sizes = None
    out: list[tuple[str, str, str]] = []
    i = depth = quiet = 0
    while i < len(flat):
        kind, value, attrs = flat[i]
        if value in CONTENT and kind in ("open", "close"):
            depth = max(0, depth + (1 if kind == "open" else -1))
        if kind == "open" and value not in VOID and not attrs.endswith("/"):
            size = (0, 0, 0, 0)
            if attrs and any(_listed(w) > 0 for w in class_words(attrs)):
                sizes = sizes or Sizes(flat)
                size = (*sizes.of(i, ends(i)), sizes.words[-1])
            found = judged(value, attrs, weights, depth > 0, size)
            if found == OUT:
                out.append(("empty", value, attrs))
                i = ends(i)
                continue
            if found == QUIET and i >= quiet:
                quiet = ends(i)
                out.append(("quiet", str(min(BRIDGE, size[0])), ""))
        if kind in ("open", "close") and value in EMBEDDED:
            out.append(("empty", value, attrs) if kind == "open" else ("text", " ", ""))
        elif kind == "text":
            out.append(("mute" if i < quiet else "text", value, attrs))
        else:
            out.append((kind, value, attrs) if kind == "empty" else ("tag", "/" * (kind == "close") + value, attrs))
        i += 1
    return out


def _partners(flat: list[tuple[str, str, str]]) -> dict[int, int]:
    """Closing tag of each opening one that has it."""
    partner: dict[int, int] = {}
    open_at: dict[str, list[int]] = {}
    for i, (kind, name, attrs) in enumerate(flat):
        if kind == "open" and not (name in FOREIGN and attrs.endswith("/")):
            open_at.setdefault(name, []).append(i)
        elif kind == "close" and open_at.get(name):
            partner[open_at[name].pop()] = i
    return partner


def _ends(flat: list[tuple[str, str, str]]):
    """Where the element opened at i ends: after its closing tag, or else before the next heading or content element (a select: before the next tag that is not its own)."""
    partner = _partners(flat)
    stops = [j for j, (kind, name, _) in enumerate(flat) if kind == "open" and (name in CONTENT or name in ("h1", "body"))]

    def end(i: int) -> int:
        if i in partner:
            return partner[i] + 1
        if flat[i][1] == "select":
            return next((j for j in range(i + 1, len(flat)) if flat[j][0] in ("open", "close") and flat[j][1] not in IN_SELECT), len(flat))
        for j in stops[bisect_left(stops, i + 1) :]:
            if flat[j][1] != "body" or flat[i][1] == "head":
                return j
        return len(flat)

    return end


def sightings(page: str) -> Counter:
    """(key, inside?) counts of a labelled page: class words (.) of elements, and the tags and elements without content (!) that the fixed lists
    alone leave in its line of tokens. What encloses the content is not counted as outside."""
    flat = scan(page)
    partner = _partners(flat)
    content = [(i, partner.get(i, len(flat))) for i, (kind, name, _) in enumerate(flat) if kind == "open" and name in CONTENT]
    out: Counter = Counter()
    if not content:
        return out
    last = -1
    for i, (kind, name, attrs) in enumerate(flat):
        if kind != "open":
            continue
        if name in CONTENT:
            last = max(last, partner.get(i, len(flat)))
            continue
        inside = i < last
        if not inside and any(i < a and b <= partner.get(i, len(flat)) for a, b in content):
            continue
        for w in {*class_words(attrs)}:
            out[f".{w}", inside] += 1
    depth = 0
    for kind, value, _ in parse(page, {}):
        if kind in ("text", "mute", "quiet"):
            continue
        if value in CONTENT:
            depth += 1
        key = value if kind == "tag" else f"!{value}"
        out[key, depth > 0 and value.lstrip("/") not in CONTENT] += 1
        if value[:1] == "/" and value[1:] in CONTENT:
            depth = max(0, depth - 1)
    return out


def weights_of(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """A (negative) weight for each tag and word; the fixed lists count as ``SEEN`` sightings."""
    out = {}
    for key in {k for k, _ in counts}:
        listed = _listed(key[1:]) if key[0] == "." else 0
        out[key] = cost((WITHIN if listed > 0 else 1) * counts.get((key, True), 0) + SEEN * (listed < 0), counts.get((key, False), 0) + SEEN * (listed > 0), 1 if key[0] in ".!" else SEEN)
    return out


def fit_weights(pages: list[str]) -> dict[str, float]:
    """``weights_of`` some pages."""
    return weights_of(sum((sightings(p) for p in pages), Counter()))


#: what a tag costs that no labelled page has: little for inline tags, those that text is set in and what a content element holds, more for items and links, most for other blocks
TEXTUAL = INLINE | frozenset("h1 h2 h3 h4 h5 h6 p br hr img blockquote pre figure figcaption table caption thead tbody tr wbr".split())
ITEMS = frozenset("a li td th dt dd ul ol dl".split())


def default(name: str, inside: bool = False) -> float:
    return -0.6 if name == "a" else -0.3 if name in ITEMS else -LEAST if inside or name in TEXTUAL else -1.0


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The best region's text."""
    tokens = parse(page or "", weights)
    best, best_at, run, head, depth = 0.0, (0, 0), 0.0, 0, 0
    for i, (kind, value, attrs) in enumerate(tokens):
        if kind == "tag" and value.lstrip("/") in CONTENT:
            depth = max(0, depth + (-1 if value[0] == "/" else 1))
        if kind == "text":
            score = float(len(entities.unescape(value).split()))
        elif kind == "tag":
            name, w = value.lstrip("/"), weights.get(value)
            score = w if w is not None else default(name)
            if depth and name not in CONTENT:  # the labels' own sign of content outweighs where else the tag stands
                score = max(score, default(name, True))
            if attrs and value not in INLINE:
                score = min([score, *(w for x in class_words(attrs) if (w := weights.get(f".{x}")) is not None and w < -COST / 2)])
        elif kind == "mute":
            score = 0.0
        elif kind == "quiet":
            score = -float(value)
        else:
            score = max(-BARRIER, weights.get(f"!{value}", -BARRIER))
        if run <= 0:
            run, head = 0.0, i
        run += score
        if run > best:
            best, best_at = run, (head, i + 1)
    parts = []
    for kind, value, _ in tokens[best_at[0] : best_at[1]]:
        if kind in ("text", "mute"):
            parts.append(entities.unescape(value))
        elif kind == "quiet":
            continue
        elif kind == "empty" or value.lstrip("/") not in INLINE:
            parts.append(" ")
    return " ".join("".join(parts).split())


def learn(pages: DataFrame, rows: int = FIT_PAGES) -> dict[str, float]:
    """Weights from the labelled ones among about ``rows`` pages by the hashes of their ids; counted by the executors."""
    share = min(1.0, rows / max(1, pages.count()))
    chosen = pages.where(F.col("page_id").isNotNull() & (F.pmod(F.xxhash64("page_id"), F.lit(1 << 31)) < int(share * (1 << 31))))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for x in b.column("html"):
                total.update(sightings(x.as_py()))
        yield pa.RecordBatch.from_pydict({"key": [k for k, _ in total], "inside": [i for _, i in total], "n": list(total.values())}, schema=pa.schema([("key", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())]))

    marked = chosen.where(F.col("html").rlike("(?i)<(article|main)[\\s>]")).select("html")
    counts = marked.mapInArrow(emit, "key string, inside boolean, n long").groupBy("key", "inside").agg(F.sum("n").alias("n")).collect()
    return weights_of({(r["key"], r["inside"]): r["n"] for r in counts})


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: dict[str, float] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for each page."""
    src = source(pages, page_id=(id_col, "long"), url=(url_col, "string"), html=(html_col, "string"))
    w = weights if weights is not None else learn(src)
    out = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(x.as_py(), w) for x in b.column("html")]
            yield record(out, page_id=b.column("page_id"), url=b.column("url"), text=texts, n_chars=[len(t) for t in texts])

    return src.mapInArrow(emit, "page_id long, url string, text string, n_chars long")
