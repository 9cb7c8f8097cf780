"""Main text of web pages by minimum-cut labelling.

A page becomes a sequence of text blocks. A linear classifier gives each block log-odds of being content, which
become capacities from the source (content) or to the sink (boilerplate); neighbours in the page and blocks of
one parent element are joined by capacities that grow with their closeness in the document tree. The maximum
flow leaves the blocks that the source still reaches: the labelling with the least total cost.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from venuemart.llm.common import packed, text_of, with_fields

# Elements of HTML by their role.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to the closing tag of their name, whatever it holds.
RAW = frozenset("script style noscript iframe textarea title".split())
#: Markup that is no text of the page; it ends with its parent like any other.
LEFT_OUT = frozenset("template svg math object select button canvas audio video datalist".split())
#: Those among them that stand inside a line of text, and those that cannot hold parts of a page.
IN_LINE = frozenset("button svg math".split())
SMALL = frozenset("button select svg math datalist".split())
ENDS_SMALL = frozenset("article aside footer form h1 h2 h3 h4 h5 h6 header main nav p section".split())
HOLDS_SMALL = frozenset("table td th object template".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("table ul ol dl article section div main body html td".split())
# Words in class, id or role that name parts of a page.
BOILERPLATE = frozenset(
    """nav navbar navigation menu breadcrumb breadcrumbs footer sidebar widget ad ads advert adverts advertisement advertising banner
    promo promotion sponsor sponsored cookie cookies consent gdpr notice alert popup modal overlay dialog comment comments disqus reply
    replies respond share sharing social related recommended recommendations newsletter subscribe subscription signup login search
    pagination pager toolbar masthead skip copyright complementary contentinfo teaser teasers feedback discussion outbrain taboola""".split()
)
CONTENT = frozenset("article content post entry story maincontent articlebody main body text prose".split())
#: Words that also name the look of an article.
LOOKS = frozenset("banner notice promo promotion sponsored alert teaser social share widget".split())
ALWAYS_OUT = frozenset("nav footer aside dialog menu".split())
QUALIFIERS = frozenset("has with no without is js not".split())

_open = re.compile(r"""<(/?)([a-zA-Z][^\s/>"']*)""")
_special = re.compile("[>\"']")
_other = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?=[^a-zA-Z/!?])|</?[a-zA-Z][^<]*\Z|</[^>]*>|<|[^<]+""", re.S)
# Where no > is left, no such tag is looked for.
_rest = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?=[^a-zA-Z/!?])|</?[a-zA-Z][^<]*\Z|<|[^<]+""", re.S)
_named = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_ends = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
_words = re.compile(r"[A-Za-z]+")
_headings = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Log-odds of the classifier.
IN_ARTICLE, IN_BOILERPLATE, ELSEWHERE = 2.5, -6.0, -0.7
#: Capacity between neighbours; it is doubled for blocks of one parent.
SMOOTH = 0.5


class Element:
    __slots__ = ("article", "depth", "gone", "name", "out", "parent", "plain", "warm")

    def __init__(self, name: str, attributes: str, parent: Element | None):
        self.name, self.parent = name, parent
        self.depth = parent.depth + 1 if parent else 0
        self.article = bool(parent and parent.article)
        # Text in here is no text of the page.
        self.gone = name in LEFT_OUT or bool(parent and parent.gone)
        self.out = self.gone or bool(parent and parent.out)
        self.warm = bool(parent and parent.warm)
        # In a form, but not in an article of it.
        self.plain = bool(parent and parent.plain)
        if not parent:
            return
        bad = good = hidden = whole = looks = False
        if attributes and not attributes.isspace():
            for key, value in _named.findall(attributes):
                key, value = key.lower(), value.strip("\"'").lower()
                if key in ("hidden", "aria-hidden", "style"):
                    hidden = hidden or (value in ("", "hidden", "true", "until-found") if key != "style" else "display:none" in value.replace(" ", ""))
                    continue
                for name_ in value.split():
                    parts = _words.findall(name_)
                    if parts and parts[0] not in QUALIFIERS:
                        found, fine = BOILERPLATE.intersection(parts), not CONTENT.isdisjoint(parts)
                        good, whole = good or fine, whole or (fine and not found)
                        # "banner-story" beside "story" is a look of the story.
                        if found:
                            bad, looks = bad or not (fine and found <= LOOKS), looks or (fine and found <= LOOKS)
        bad = bad or (looks and not whole)
        if name in ("html", "body"):
            return
        if name in ("article", "main"):
            comment = bad and "comment" in attributes.lower()
            self.out = self.out or comment or hidden
            self.article, self.plain = not self.out, False
        elif name in ALWAYS_OUT or hidden or bad:
            self.out = True
        elif name == "header":
            self.out = self.out or not self.article
        elif name == "form":
            self.out, self.plain = self.out or self.article, True
        if good:
            self.warm = True


def _pop(stack: list[Element], names: frozenset | set, stop: frozenset = frozenset()) -> None:
    """Close the innermost open element of these names, and all inside it, unless one of `stop` is nearer."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name in names:
            del stack[k:]
            return
        if stack[k].name in stop:
            return


class Tags:
    """Where the tags of a page end: at the first > outside quotes.

    From a quote or > on, the way to that end is the same for all tags that come there, so it is remembered: a
    page of unclosed quotes is still read in linear time.
    """

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.places = [m.start() for m in _special.finditer(html)]
        self.end_from: dict[int, int] = {}

    def end(self, at: int) -> int:
        """Place of the > that ends a tag whose name ends at `at`; -1 if there is none."""
        way, found = [], -1
        while at <= self.last:
            k = self.places[bisect_left(self.places, at)]
            if k in self.end_from:
                found = self.end_from[k]
                break
            way.append(k)
            if self.html[k] == ">":
                found = k
                break
            at = self.html.find(self.html[k], k + 1) + 1
            if not at:
                break
        for k in way:
            self.end_from[k] = found
        return found


def blocks(html: str) -> list[tuple[str, int, Element]]:
    """(text, characters inside links, element) of each block of the page."""
    stack = [Element("html", "", None)]
    out: list[tuple[str, int, Element]] = []
    parts: list[str] = []
    linked = links = 0
    home = stack[0]

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append((text, linked, home))
            parts.clear()
        linked = 0

    at, end = 0, len(html)
    tags = Tags(html)
    while at < end:
        m = _open.match(html, at)
        close = tags.end(m.end()) if m else -1
        if close < 0:
            other = (_other if at < tags.last else _rest).match(html, at)
            at = other.end()
            text = other[0]
            if (text[0] != "<" or text == "<") and not stack[-1].gone:
                if not parts:
                    home = next(e for e in reversed(stack) if e.name not in INLINE)
                parts.append(text)
                if links:
                    linked += len(text)
            continue
        name, attributes, at = m[2].lower(), html[m.end() : close], close + 1
        if name == "br":
            parts.append(" ")
        elif name in RAW:
            if not m[1] and not attributes.endswith("/"):
                shut = _ends[name].search(html, at)
                at = shut.end() if shut else end
                stack[-1].gone or flush()
            parts and parts.append(" ")
        elif name in LEFT_OUT:
            if m[1]:
                _pop(stack, {name})
                links = int(any(e.name == "a" for e in stack))
            elif not attributes.endswith("/"):
                if name in ("button", "select"):
                    _pop(stack, {"button", "select"} if name == "button" else {"select"}, HOLDS_SMALL)
                stack[-1].gone or name in IN_LINE or flush()
                stack.append(Element(name, attributes, stack[-1]))
            parts and parts.append(" ")
        elif name in INLINE:
            if m[1]:
                if name == "a":
                    links = max(0, links - 1)
                _pop(stack, {name}, HOLDS)
            elif not attributes.endswith("/"):
                if name == "a":
                    links = 1
                stack.append(Element(name, attributes, stack[-1]))
        elif m[1]:
            inside = stack[-1].gone
            _pop(stack, {name})
            if not (inside and stack[-1].gone):
                flush()
                links = 0
        else:
            if name in VOID:
                if name in ("hr",) and not stack[-1].gone:
                    flush()
                continue
            while stack[-1].gone and name in ENDS_SMALL:
                held = len(stack)
                _pop(stack, SMALL, LEFT_OUT - SMALL)
                if len(stack) == held:
                    break
            if not stack[-1].gone:
                flush()
                links = 0
            if name in CLOSES_P:
                _pop(stack, {"p"}, HOLDS | LEFT_OUT)
            if name in _headings:
                _pop(stack, _headings, HOLDS | LEFT_OUT)
            if name in CLOSES_SAME:
                _pop(stack, CLOSES_SAME[name], frozenset({"ul", "ol", "dl", "table"}) | LEFT_OUT)
            if name in ("html", "body", "head"):
                continue
            stack.append(Element(name, attributes, stack[-1]))
    flush()
    return out


def log_odds(text: str, linked: int, home: Element) -> float:
    """How much more likely content than boilerplate a block is."""
    if home.out:
        return IN_BOILERPLATE
    share = min(1.0, linked / max(1, len(text)))
    words = text.count(" ") + 1
    if home.article:
        return IN_ARTICLE + min(words, 40) / 40 - share
    score = ELSEWHERE + min(words, 40) / 20 - 4 * share - (3.0 if home.plain else 0.0) + (1.0 if home.warm else 0.0)
    if home.name in ("p", "blockquote", "pre"):
        score += 1.0
    elif home.name in _headings:
        score += 0.7
    if text[-1] in ".!?":
        score += 0.5
    return score


def edges(homes: list[Element]) -> list[tuple[int, int, float]]:
    """Neighbours in the page, and next blocks of one parent element."""
    out, last = [], {}
    for k, home in enumerate(homes):
        up = home.parent or home
        if k:
            other = homes[k - 1]
            near = other.parent or other
            if near is up:
                out.append((k - 1, k, 2 * SMOOTH))
            elif home is near or other is up or abs(home.depth - other.depth) <= 1:
                out.append((k - 1, k, SMOOTH))
            else:
                out.append((k - 1, k, SMOOTH / 2))
        before = last.get(id(up))
        if before is not None and before != k - 1:
            out.append((before, k, SMOOTH))
        last[id(up)] = k
    return out


def source_side(odds: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Blocks on the source's side of the minimum cut, by Dinic's blocking flows.

    Positive odds are the capacity from the source, negative ones that to the sink. Ties go to the sink.
    """
    n = len(odds)
    near: list[list[int]] = [[] for _ in range(n)]
    to, room = [], []
    for a, b, capacity in links:
        near[a].append(len(to))
        near[b].append(len(to) + 1)
        to += [b, a]
        room += [capacity, capacity]
    supply = [max(x, 0.0) for x in odds]
    drain = [max(-x, 0.0) for x in odds]
    tiny = 1e-9
    while True:
        level = [-1] * n
        queue = deque(k for k in range(n) if supply[k] > tiny)
        for k in queue:
            level[k] = 0
        reached = False
        while queue:
            k = queue.popleft()
            reached = reached or drain[k] > tiny
            for e in near[k]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[k] + 1
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        at = [0] * n
        for start in range(n):
            while supply[start] > tiny:
                path, k = [], start
                while drain[k] <= tiny:
                    while at[k] < len(near[k]):
                        e = near[k][at[k]]
                        if room[e] > tiny and level[to[e]] == level[k] + 1:
                            break
                        at[k] += 1
                    else:
                        if not path:
                            break
                        k = to[path.pop() ^ 1]
                        at[k] += 1
                        continue
                    path.append(e)
                    k = to[e]
                if drain[k] <= tiny:
                    break
                flow = min([supply[start], drain[k], *(room[e] for e in path)])
                supply[start] -= flow
                drain[k] -= flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def main_text(html: str) -> str:
    """The content blocks in page order, one line each; empty if there are none."""
    found = blocks(html)
    odds = [log_odds(*b) for b in found]
    keep = source_side(odds, edges([b[2] for b in found]))
    return "\n".join(b[0] for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Rows of pages as struct `row`, with `text`.

    Null or empty html, and pages without content blocks, give an empty text. Broken markup is read as browsers
    would: unclosed elements end with their parents, a tag cut off by the end of the page is dropped. Every page
    is read whole, and each on its own. Other columns pass through whatever their names.
    """
    base = packed(pages, html=text_of(html_col))

    def run(batches):
        for batch in batches:
            out = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "text"])

    return base.mapInArrow(run, with_fields(T.StructType([base.schema["row"]]), T.StructField("text", T.StringType())))
