"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one for each block of the page; a line's length is its
unlinked text. Elements of menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments give no lines but a gap of WINDOW empty ones, and
none where their container goes on with prose of its own. Lines that are mostly links
and lines that state rights have no length.

Names that mean other things too (MEANINGS) leave a paragraph or heading out, or an element
named for a subject before them, only if what it holds is mostly links or no sentence.

Lengths are summed over sliding windows of WINDOW lines. A region surges where the sums
leave zero and dives where they return to it; it counts if some window of it reaches
SURGE characters or a paragraph of it is a sentence. The text between surge and dive is
kept, paragraphs that are links included, and lists of links with prose of their
container before and after them; other lists of links and lines of rights are not.

Where a page marks its article, and it holds at least half of the page's unlinked text,
lines outside have no length, gaps inside it do not count, and neither does SURGE; all its
lines are kept, those of rights too, as nothing but the mark tells where a text ends.

Defined results: null and empty pages give an empty text; a page on which nothing
surges gives all its lines with a length; unclosed and stray tags are read as browsers
do, as far as block structure goes; repeated rows are read alike; page_id and url are
passed through, nulls too; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 3
#: Unlinked characters that some window of a region must reach; headlines weigh more.
SURGE, HEADLINE = 40, 4
#: Lines of which more than this share is link text have no length.
LINKED = 0.6

#: A quote opens a value only after an equals sign; a tag that never ends takes the rest of the page.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^>\s]*+|))*+)(?:>|\Z)", re.S)
#: A line that states rights, as footers do: a sign, or the word with a year and no sentence after it.
RIGHTS = re.compile(
    r"(?:©|\(c\))\s*(?:copyright)?\s*(?:\d{4}|by\b)|copyright\s*(?:©|\(c\))\s*(?:\d{4}|by\b)|copyright\s+by\s+(?-i:[A-Z])"
    r"|copyright\s+\d{4}(?:\s*[-–,]\s*\d{2,4})*(?:\s*$|\s*[,.|:;-]|\s+(?:by\b|the\b|(?-i:[A-Z])))|all rights reserved\W*$",
    re.I,
)
RIGHTS_LENGTH = 200
#: Elements by how they are read.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br picture source".split())
LEFT_OUT = frozenset("nav footer aside form script style textarea title noscript iframe xmp noembed noframes template head button select option svg math object audio video canvas dialog menu fieldset".split())
ARTICLE = frozenset(("article", "main"))
LISTS = frozenset("ul ol li".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dl dd dt".split())
NAMED = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|subscri\w+|signup|login|paywall"
    r"|sidebar|sidenav|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|toolbar|masthead|topbar|footer|copyright|share|sharing|social|related|recommend\w*|trending|widget|tags?"
    r"|comments?|commentlist|disqus|respond|replies|search|skip",
    re.I,
)
#: Names that say so whatever follows them in a class or id, and what may follow the others.
PLAIN = re.compile(r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|gdpr|newsletter|subscri\w+|paywall|disqus|breadcrumbs?|pagination", re.I)
SUFFIX = re.compile(r"\d+|box|blocks?|wrap|wrapper|container|bars?|list|area|section|panel|inner|outer|items?|links?|buttons?|btn|icons?|form|top|bottom|left|right|header|title|content|primary|secondary|to|posts?|articles?|stories", re.I)
#: Names that say so of most elements but are also subjects, and what may stand before them in the name of a part of the page.
MEANINGS = re.compile(r"share|sharing|social|search|menu|related|tags?|respond|replies|skip|trending|widget", re.I)
SCOPE = re.compile(r"site|page|main|post|article|entry|header|footer|top|bottom|side|left|right|primary|secondary|sub|mobile|desktop|user|account|global|local|drop|dropdown|hamburger|context|language|lang|category|meta|js|wp|mw|td|ui|app|toggle|button|quick|view|vector|portal|the|my|full|mini|mega|off|canvas", re.I)
#: How sentences end, and what may stand after it.
ENDS, AFTER = ".!?…。！？", "\"'”’»)] \t\r\n"
#: Parts that make a class say something about the page's layout or state.
STATE = re.compile(r"no|not|has|have|with|without|is|hide|show|open|opened|closed|enabled?|disabled?|active|inactive|on|off|results?", re.I)
#: What readers wrote may be most of a page and still is no main text.
COMMENTS = re.compile(r"(?<![a-z])(?:comments?|commentlist|disqus|respond|replies)(?![a-z])", re.I)
#: Elements left out by name or kind that may yet turn out to wrap the page.
WRAPS = frozenset(("form", "fieldset"))
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([a-zA-Z-]+)")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())


def _sentence(text: str) -> bool:
    """Whether a text is two words at least and ends as sentences do."""
    text = text.rstrip(AFTER)
    return text[-1:] in ENDS and (text[-1:] in "。！？" or len(text.split(None, 1)) > 1) if text else False


def _named(value: str, inside: bool, prose: bool) -> str:
    """Whether the classes or ids name something that is no main text: "name", "weak" if they may mean other things, or ""."""
    said = ""
    for token in value.split():
        parts = [p for p in re.split(r"[-_]+", token) if p]
        if not parts or any(STATE.fullmatch(p) for p in parts):
            continue
        if PLAIN.fullmatch(parts[0]) or not inside and parts[-1].lower() == "header":
            return "name"
        if any(NAMED.fullmatch(p) and all(SUFFIX.fullmatch(q) or NAMED.fullmatch(q) for q in parts[k + 1 :]) for k, p in enumerate(parts)):
            names = [p for p in parts if NAMED.fullmatch(p)]
            subject = not all(NAMED.fullmatch(p) or SUFFIX.fullmatch(p) or SCOPE.fullmatch(p) for p in parts[:-1])
            if not (prose or subject) or not all(MEANINGS.fullmatch(p) for p in names):
                return "name"
            said = "weak"
    return said


@functools.lru_cache(maxsize=4096)
def _left_out(name: str, attributes: str, inside: bool) -> str:
    """Whether an element is no part of the main text: "" if it is, "name" or "weak" if only its name or kind says so, else "sure"."""
    if name in LEFT_OUT and name not in WRAPS or name == "header" and not inside:
        return "sure"
    said = "name" if name in WRAPS else ""
    if not attributes.strip() or name in ARTICLE or name in ("html", "body"):
        return said
    for m in ATTRIBUTE.finditer(attributes):
        key, value = (m[1] or m[5]).lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id") and said != "name":
            said = _named(value, inside, name in PROSE) or said
        if key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return "sure"
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "sure"
    return said


@dataclass
class Line:
    """A block's text, whether a marked article holds it, its unlinked length, its element and the place of its container."""

    text: str
    inside: bool = False
    length: int = 0
    kind: str = ""
    container: int = -1


@dataclass
class Open:
    """An open element: how it is left out, whether it is an article, where its tag stands; of one left out by name, what it holds; `weak` if its name may mean other things."""

    name: str
    out: str
    article: bool
    at: int
    size: int = 0
    holds_article: bool = False
    comments: bool = False
    weak: bool = False
    linked: int = 0
    inner: int = 0
    sentence: bool = False


@dataclass
class Page:
    """What one reading gives: lines, of each element left out by name its unlinked text and whether it holds an article, and those that hold prose against a weak name."""

    lines: list[Line] = field(default_factory=list)
    held: dict[int, tuple[int, bool]] = field(default_factory=dict)
    prose: set[int] = field(default_factory=set)
    total: int = 0


class Reader:
    """One pass over a page's tags; elements whose tags stand at `spared` places are not left out by name."""

    def __init__(self, html: str, spared: set[int]) -> None:
        self.html, self.spared, self.page = html, spared, Page()
        self.stack: list[Open] = []
        self.named: list[Open] = []  # those left out by name
        self.names: Counter = Counter()  # names on the stack
        self.out = self.by_name = self.articles = self.links = 0
        self.text: list[str] = []
        self.linked = 0

    def read(self) -> Page:
        at = 0
        while True:
            m = TAG.search(self.html, at)
            self.add(self.html[at : m.start() if m else len(self.html)])
            if not m:
                break
            at = m.end()
            if name := (m[2] or "").lower():
                at = self.tag(m, name, at)
        self.flush()
        self.pop(0)
        return self.page

    def add(self, piece: str) -> None:
        if not piece:
            return
        size = len(piece.strip())
        if self.named and self.out == self.by_name:
            self.named[-1].linked += size if self.links else 0
            self.named[-1].sentence |= self.named[-1].weak and not self.links and _sentence(piece)
        if self.out == self.by_name and not self.links:
            self.page.total += size
            if self.by_name and not self.articles:
                self.named[-1].size += size
            elif self.by_name:
                self.named[-1].inner += size
        if not self.out:
            self.text.append(piece)
            self.linked += len(piece) if self.links else 0

    def flush(self) -> None:
        raw = "".join(self.text)
        text = " ".join(unescape(raw).split())
        if text:
            blocks = (x for x in reversed(self.stack) if x.name not in INLINE)
            block = next(blocks, None)
            kind = block.name if block else ""
            home = next(blocks, None) if kind in PROSE else next((x for x in blocks if x.name not in LISTS), None) if kind in LISTS else block
            some = len(raw) * LINKED >= self.linked and not _rights(text)
            self.page.lines.append(Line(text, self.articles > 0, len(text) if some else 0, kind, home.at if home else -1))
        self.text.clear()
        self.linked = 0

    def gap(self) -> None:
        home = next((x.at for x in reversed(self.stack) if x.name not in INLINE), -1)
        self.page.lines.extend([Line("", self.articles > 0, 0, "gap", home)] * WINDOW)

    def pop(self, to: int) -> None:
        while len(self.stack) > to:
            x = self.stack.pop()
            self.names[x.name] -= 1
            self.out -= x.out != ""
            self.articles -= x.article
            self.links -= x.name == "a"
            if x.out == "name":
                self.by_name -= 1
                self.named.pop()
                self.page.held[x.at] = (0 if x.comments else x.size, x.holds_article)
                if x.weak and x.sentence and x.linked <= LINKED * (x.linked + x.size + x.inner):
                    self.page.prose.add(x.at)
                if self.named:
                    outer = self.named[-1]
                    outer.size += x.size
                    outer.holds_article |= x.holds_article
            if (x.out or x.article) and x.name not in INLINE and not self.out:
                self.gap()

    def close(self, name: str) -> None:
        if self.names[name] > 0:
            self.pop(next(k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k].name == name))

    def tag(self, m: re.Match, name: str, at: int) -> int:
        """Read one tag; returns where to go on."""
        block = name not in INLINE
        if block:
            self.flush()
        elif name == "br":
            self.add(" ")
        if m[1]:
            self.close(name)
            return at
        if name in VOID:
            return at
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(self.html, at)
            return end.end() if end else len(self.html)
        if block and self.stack:
            tail = len(self.stack)
            while tail and self.stack[tail - 1].name in INLINE:
                tail -= 1
            if tail and (self.stack[tail - 1].name == "p" or self.stack[tail - 1].name == name and name in ("li", "td", "th", "tr", "dd", "dt", "option")):
                self.pop(tail - 1)
        if m[3].endswith("/"):
            return at
        out = (_left_out if len(m[3]) < 300 else _left_out.__wrapped__)(name, m[3], self.articles > 0)
        weak = out == "weak"
        out = "name" if weak else out
        if out == "name" and m.start() in self.spared:
            out = ""
        if not block and not out and name != "a" and not (self.out and self.names[name]):
            return at  # what only changes how text looks
        if name == "a" and self.links:
            self.close("a")  # links do not nest
        if name in ARTICLE and self.out == self.by_name and self.by_name:
            self.named[-1].holds_article = True
        article = name in ARTICLE and not self.out
        if article and not self.articles:
            self.gap()
        self.stack.append(Open(name, out, article, m.start(), comments=COMMENTS.search(m[3]) is not None, weak=weak))
        if out == "name":
            self.named.append(self.stack[-1])
        self.names[name] += 1
        self.out += out != ""
        self.by_name += out == "name"
        self.articles += article
        self.links += name == "a"
        return at


def lines_of(html: str) -> list[Line]:
    """The page's lines and gaps.

    An element that only its name leaves out is taken after all if it wraps an article, or, unless it is named for
    comments, most of the unlinked text of a page outside articles, if its name is weak and it holds prose, or if nothing is
    left without such elements.
    """
    spared: set[int] = set()
    while True:
        page = Reader(html, spared).read()
        more = {at for at, (size, article) in page.held.items() if article or 2 * size > page.total} | page.prose
        if not more and not any(x.text for x in page.lines):
            more = set(page.held)
        if not more:
            return _bridged(page.lines)
        spared |= more


def _bridged(lines: list[Line]) -> list[Line]:
    """The lines without gaps whose container has prose of its own before and after."""
    first: dict[int, int] = {}
    last: dict[int, int] = {}
    for k, x in enumerate(lines):
        if x.text:
            first.setdefault(x.container, k)
            last[x.container] = k
    return [x for k, x in enumerate(lines) if x.text or not first.get(x.container, k) < k < last.get(x.container, k)]


def regions(lengths: list[int], least: int = 0, window: int = WINDOW) -> list[tuple[int, int]]:
    """[surge, dive) ranges of lines: sums over so many lines leave zero, return to it, and reach `least` in between."""
    out, start, held, top = [], None, 0, 0
    ahead = sum(lengths[:window])
    for k in range(len(lengths) + 1):
        if ahead and start is None:
            start, held, top = k, k, 0
        if start is not None and not ahead:
            if top >= least:
                out.append((next(j for j in range(start, k + window) if lengths[j]), held + 1))
            start = None
        if k < len(lengths):
            held = k if lengths[k] else held
            top = max(top, ahead)
            ahead += (lengths[k + window] if k + window < len(lengths) else 0) - lengths[k]
    return out


def _rights(text: str) -> bool:
    return len(text) <= RIGHTS_LENGTH and RIGHTS.search(text) is not None


def _weight(line: Line) -> int:
    """What a line counts for: headlines more than their length, a paragraph that is a sentence enough for a region."""
    weight = line.length * (HEADLINE if line.kind == "h1" else 1)
    return max(weight, SURGE) if weight and line.kind == "p" and _sentence(line.text) else weight


def _listed(lines: list[Line]) -> set[int]:
    """The places of list items with prose of their container before and after them."""
    first: dict[int, int] = {}
    last: dict[int, int] = {}
    for k, x in enumerate(lines):
        if x.kind in PROSE and x.length:
            first.setdefault(x.container, k)
            last[x.container] = k
    return {k for k, x in enumerate(lines) if x.kind == "li" and first.get(x.container, k) < k < last.get(x.container, k)}


def main_text(html: str | None) -> str:
    """The page's main text, a line for each block."""
    lines = lines_of(html or "")
    inside, every = (sum(x.length for x in lines if x.inside or not only) for only in (True, False))
    if inside and 2 * inside >= every:
        lines = [x for x in lines if x.text or not x.inside]
        lengths = [len(x.text) if x.inside else 0 for x in lines]
        return "\n".join(lines[k].text for a, b in regions(lengths) for k in range(a, b) if lengths[k])
    found = regions([_weight(x) for x in lines], SURGE) or regions([x.length for x in lines])
    listed = _listed(lines)
    keep = lambda k, x: x.length or x.text and (x.kind in PROSE or k in listed) and not _rights(x.text)
    return "\n".join(lines[k].text for a, b in found for k in range(a, b) if keep(k, lines[k]))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of pages (page_id, url, html)."""

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
