"""Main text of HTML pages by tag-path ratios.

A page is cut into blocks, runs of text between block-level tags. Blocks are gathered per
tag path (the tags from the root to the block). A path's ratio is its length of text outside links for each
block, weighed with its punctuation; ratios are laid back over the page's blocks,
smoothed with their neighbours, and fused (geometric mean) with the path's own ratio. Blocks above a share of the page's
spread are text of the article; the deepest element that holds all of them is the article, the whole of an article or main
element around it and never only a list, table or quote in it, and all its blocks are the text. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
comments of readers are known by tag, role and class and never vote or show. A word of a class or id alone is weak: it does not count
in headings, article and main elements or behind a modifier (no-sidebar), and an element that it marks stays if it
holds main, the page's articles, or most of the text above the bar; comments of readers do not vote and stay only where a page has no other text.

Defined cases: null, empty and text-free pages give an empty text; unclosed tags end where
their parent ends; text without any tag is one block; a quote starts a string only right behind the = of an attribute, and one
that is never closed ends with its tag; time and memory grow with a page's length, however deep its elements are nested; a page is
one row and is never joined with another, so repeated rows give repeated results.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from serieskit.llm.common import small_batches

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br".split()
)
FOREIGN = frozenset("svg path g use rect circle line polygon math".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
CLOSED_BY_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"thead", "tbody", "tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
LISTS = frozenset("table ul ol dl select".split())
SCOPES = frozenset("table ul ol dl select body html article section div".split())

# What is no article, by tag, by role, and by a word of a class or id.
OUTSIDE_TAGS = frozenset("head nav footer aside form script style noscript template iframe object svg canvas button select textarea input dialog menu".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu sidebar side footer masthead breadcrumb breadcrumbs "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social related recommended widget "
    "comment comments disqus replies respond pagination pager toolbar skip".split()
)
COMMENT_WORDS = frozenset("comment comments disqus replies respond".split())
# What follows one of these in a class or id is a property of the element, not what it is.
MODIFIERS = frozenset("no not non without has have with hide category tag".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

# A name may hold quotes and begin with =; a value is quoted, or runs to a blank or the end of its tag.
_NAMED = r"[^\s/>][^\s/>=]*+"
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_NAMED}(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++)?+)?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(rf"({_NAMED})(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))?+)?+")
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_POINTS = re.compile(r"[.,;:!?…。，、！？؟،]")
_SIGNS = re.compile(r"[\W_]")

# What an article holds but is not: lists, tables and quotes. A cell may be a column of a page laid out as a table.
PARTS = frozenset("address blockquote caption dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup li ol p pre summary table tbody tfoot thead tr ul".split())

SPREAD = 0.3
# Share of the text above the bar with which an element that only a word marks stays.
HOLDS = 0.6


class _Element:
    """An element, numbered in page order, with what its ancestors say about it, so that nothing climbs the tree for each block."""

    __slots__ = ("tag", "parent", "outside", "mark", "depth", "article", "path", "holder", "outermost", "main", "in_article", "marked", "enter", "leave")

    def __init__(self, tag: str, parent: _Element | None = None, outside: bool = False, mark: str = "", enter: int = 0):
        self.tag, self.parent, self.outside, self.mark, self.enter, self.leave = tag, parent, outside, mark, enter, enter
        self.depth = parent.depth + 1 if parent else 0
        self.article = tag in ("article", "main") or bool(parent and parent.article)
        # Paths are the nodes of a tree of tags.
        self.path: dict = parent.path.setdefault(tag, {}) if parent else {}
        self.holder: _Element = parent.holder if parent and tag in INLINE else self
        self.outermost: _Element | None = (parent.outermost if parent and parent.article else self) if self.article else None
        self.main: _Element | None = self if tag == "main" else parent and parent.main
        self.in_article = tag == "article" or bool(parent and parent.in_article)
        # The nearest element that a word marks, this one included.
        self.marked: _Element | None = self if mark else parent and parent.marked

    def above(self) -> _Element | None:
        """The nearest element around this one that a word marks."""
        return self.parent and self.parent.marked


def _is_outside(tag: str, attributes: str, parent: _Element) -> tuple[bool, str]:
    """Whether an element is no article by tag, role or style, and else the kind of word that marks it, if any."""
    if tag in OUTSIDE_TAGS or tag == "header" and not parent.article:
        return True, ""
    if not attributes or tag in ("html", "body"):
        return False, ""
    mark = ""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "role" and value.strip() in OUTSIDE_ROLES:
            return True, ""
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True, ""
        if name in ("class", "id"):
            mark = max(mark, _mark(tag, name, value, parent))
    return False, mark


def _mark(tag: str, name: str, value: str, parent: _Element) -> str:
    """"a word" or "comments" if a class or id names what is no article."""
    if OUTSIDE_WORDS.isdisjoint(_WORDS.findall(value)) or tag in HEADINGS or tag == "main":
        return ""
    words = set()
    for token in value.split():
        own = _WORDS.findall(token)
        words.update(own[: next((i for i, w in enumerate(own) if w in MODIFIERS), len(own))])
    if tag == "article":
        # Only an article that is a comment, or a part of another article, can be something else.
        if not parent.in_article:
            words = {w for w in value.split() if w in COMMENT_WORDS}
    if not COMMENT_WORDS.isdisjoint(words):
        return "comments"
    # The id of a section of an article is the name of its heading.
    return "" if OUTSIDE_WORDS.isdisjoint(words) or tag == "section" and name == "id" and parent.article else "a word"


def blocks(page: str) -> list[tuple[_Element, str, int]]:
    """(element, text, characters inside links) of every block of a page outside of what is no article by tag, role or style, in page order."""
    top, out, run, links, in_link, at, made = _Element("#"), [], [], 0, 0, 0, 0
    # Depths of the open elements of every tag.
    depths: dict[str, list[int]] = {}

    def flush():
        nonlocal links
        if run:
            text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
            if text:
                out.append((top.holder, text, links))
            run.clear()
        links = 0

    def deepest(tags):
        return max((depths[t][-1] for t in tags if depths.get(t)), default=0)

    def leave(depth):
        nonlocal top
        while top.depth >= depth:
            depths[top.tag].pop()
            top.leave = made
            top = top.parent

    def close(tags, stop):
        """End the deepest open element of ``tags`` unless one of ``stop`` lies deeper; whether there was one."""
        depth = deepest(tags)
        if not depth or deepest(stop) > depth:
            return False
        leave(depth)
        return True

    end = len(page)
    while at < end:
        found = _TAG.search(page, at)
        text = page[at : found.start() if found else end]
        if text and not top.outside:
            run.append(text)
            if in_link:
                links += len(text)
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag not in INLINE:
            flush()
        elif tag == "br":
            run.append(" ")
        if found[1]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            stop = () if tag not in INLINE else SCOPES
            close((tag,), stop)
            continue
        if tag in CLOSES_P:
            close(("p",), SCOPES)
        if tag in CLOSED_BY_SAME:
            while close(CLOSED_BY_SAME[tag], LISTS):
                pass
        if tag in VOID:
            continue
        outside, mark = (True, "") if top.outside else _is_outside(tag, found[3], top)
        if tag in FOREIGN and found[3].endswith("/"):
            continue
        if tag in RAW:
            closing = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = closing.end() if closing else end
            continue
        if tag == "a":
            in_link += 1
        made += 1
        top = _Element(tag, top, outside, mark, made)
        depths.setdefault(tag, []).append(top.depth)
    flush()
    leave(1)
    top.leave = made
    return out


def path_scores(found: list[tuple[_Element, str, int]]) -> list[float]:
    """Smoothed and fused tag-path ratio of every block."""
    paths = [id(e.path) for e, _, _ in found]
    sums: dict[int, list[float]] = {}
    for path, (_, text, links) in zip(paths, found):
        s = sums.setdefault(path, [0.0, 0.0, 0.0])
        s[0] += max(0, len(text) - links)
        s[1] += len(_POINTS.findall(text))
        s[2] += 1
    ratio = {p: s[0] / s[2] * (1 + math.log1p(s[1] / s[2])) for p, s in sums.items()}
    raw = [ratio[p] for p in paths]
    smooth = []
    for i in range(len(raw)):
        weights = [(w, raw[i + o]) for o, w in ((-2, 0.06), (-1, 0.24), (0, 0.4), (1, 0.24), (2, 0.06)) if 0 <= i + o < len(raw)]
        smooth.append(sum(w * r for w, r in weights) / sum(w for w, _ in weights))
    return [math.sqrt(r * s) for r, s in zip(raw, smooth)]


def _above(found: list[tuple[_Element, str, int]]) -> list[bool]:
    """Whether the score of a block is a share of the page's spread at least."""
    scores = path_scores(found)
    mean = sum(scores) / len(scores)
    bar = min(max(scores), SPREAD * math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores)))
    return [score >= bar for score in scores]


def _own(text: str, links: int) -> int:
    """Characters outside links, less blanks and signs, which also part one link from the next."""
    return max(0, len(text) - links - len(_SIGNS.findall(text)))


def _unmarked(found: list[tuple[_Element, str, int]]) -> list[tuple[_Element, str, int]]:
    """``found`` without the blocks in elements that a word marks, unless these hold what the page is about."""
    marked = _chains([e.marked for e, _, _ in found])
    if not marked:
        return found
    weights = [_own(text, links) if high else 0 for (_, text, links), high in zip(found, _above(found))]
    readers = _words_around(marked)[1]
    if any(w for w, (e, _, _) in zip(weights, found) if e.marked not in readers):
        weights = [0 if e.marked in readers else w for w, (e, _, _) in zip(weights, found)]
    total, held = sum(weights), dict.fromkeys(marked, 0)
    for (e, _, _), weight in zip(found, weights):
        if e.marked:
            held[e.marked] += weight
    for m in reversed(marked):
        if m.above():
            held[m.above()] += held[m]
    _clear([e.main.marked for e, _, _ in found if e.main])
    words, readers = _words_around(marked)
    around = [e.outermost.above() if e.outermost else None for e, _, _ in found]
    around = [m if m in words and m not in readers else None for m in around]
    if sum(w for w, m in zip(weights, around) if m) >= HOLDS * total:
        _clear(around)
    for m in marked:
        if held[m] and held[m] >= HOLDS * total:
            m.mark = ""
    words, readers = _words_around(marked)
    left = [b for b in found if b[0].marked not in words]
    if not total or any(_own(text, links) for _, text, links in left):
        return left
    return [b for b in found if b[0].marked not in readers] or found


def _chains(marked: list[_Element | None]) -> list[_Element]:
    """``marked`` and all marked elements around them, each once, outer ones first."""
    seen: set[_Element] = set()
    for m in marked:
        while m and m not in seen:
            seen.add(m)
            m = m.above()
    return sorted(seen, key=lambda m: m.depth)


def _words_around(marked: list[_Element]) -> tuple[set[_Element], set[_Element]]:
    """Those of ``marked`` that are or lie in an element whose mark still stands, and those where one says comments."""
    words: set[_Element] = set()
    readers: set[_Element] = set()
    for m in marked:
        if m.mark or m.above() in words:
            words.add(m)
        if m.mark == "comments" or m.above() in readers:
            readers.add(m)
    return words, readers


def _clear(marked: list[_Element | None]) -> None:
    """Take the marks off ``marked`` and off all elements around them."""
    for m in _chains(marked):
        m.mark = ""


def main_text(page: str | None) -> str:
    """The article of one page: blocks in page order, joined by an empty line."""
    found = _unmarked(blocks(page or ""))
    inside = [b for b in found if b[0].article] or found
    if not inside:
        return ""
    above = [b for b, high in zip(inside, _above(inside)) if high]
    article = _article([e for e, text, links in above if _own(text, links)] or [e for e, _, _ in above])
    return "\n\n".join(text for e, text, _ in inside if _under(e, article))


def _article(held: list[_Element]) -> _Element:
    """The deepest element around all of ``held`` that may be an article; article and main are never cut."""
    # Elements are numbered in page order, so the first and the last one span all.
    top, last = min(held, key=lambda e: e.enter), max(held, key=lambda e: e.enter)
    while not _under(last, top):
        top = top.parent
    if top is held[0]:
        top = top.parent or top
    if top.article:
        return top.outermost
    while top.parent and (top.tag in PARTS or top.tag in INLINE):
        top = top.parent
    return top


def _under(e: _Element, top: _Element) -> bool:
    return top.enter <= e.enter <= top.leave


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = pa.array([main_text(page) for page in batch.column("html").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), text], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; no row moves between tasks."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
