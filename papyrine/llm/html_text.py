"""The main text of web pages: flat text blocks, told apart by a decision tree.

A page is cut at its block tags into a flat list of texts. A block is described by its words and link density, those of the
blocks before and after, and where it stands; a decision tree, grown from the small labelled table below, says which blocks
belong to the article.

Names of elements say where a block stands. They are split into known words, and one that only describes what an element has
or is like does not count. An element that holds more than half of the page's text is no menu, notice or form whatever its name, unless
it is named after reader comments, of which there may be more than of anything else.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from papyrine.llm.arrays import text_slices

# Element names of HTML and words that sites put into class, id and role.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = "script style iframe".split()  # hold no elements; without an end they reach to the end of the page
UNSEEN = "title noscript template svg math object canvas audio video map".split()  # without an end only their tag is left out
CONTAINERS = set("article aside body button dialog div dl fieldset figure footer form header label legend main menu nav ol section select table ul".split())
SIDE_ELEMENTS = set("aside button dialog fieldset footer form label legend menu nav select".split())
SIDE_WORDS = set(
    """ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments complementary
    consent contentinfo cookie cookies copyright dialog discussion disqus footer gdpr legal login masthead menu menubar modal nav
    navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion promoted recommended
    related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription teaser
    toolbar widget""".split()
)
COMMENT_WORDS = set("comment comments discussion disqus replies reply respond".split())
STATE_WORDS = set("has with without no is enabled disabled open closed free".split())  # `has-sidebar` names what an element has, not what it is
MAIN_WORDS = set("article content entry main post story".split())
WRAPPER_WORDS = set("layout wrapper wrap container page site body outer inner grid row columns".split())
OTHER_WORDS = set("list box area section block bar item items holder thread title text top bottom left right nav form group header".split())

_QUOTED = r"""(?:"[^"<]*"|'[^'<]*'|[^>"'<])*+"""
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{'|'.join(RAW)})\b{_QUOTED}>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<rest>{_QUOTED}>|[^>]*(?:>|\Z))|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_UNSEEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(?P<raw>{'|'.join(RAW)})\b{_QUOTED}>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<name>{'|'.join(UNSEEN)})\b{_QUOTED}>", re.S | re.I)
_NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""\shidden(?=[\s=>])|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "side", "zone", "heading")
OUTSIDE, NO_ZONE, INSIDE = 0, 1, 2  # of an article or main element; NO_ZONE: the page has none

# The labelled table: FEATURES of blocks as seen on pages, and 1 for main text.
LABELLED = [
    # paragraphs and headings of articles
    (60, 0, 45, 0, 50, 0, 0, INSIDE, 0, 1), (120, 0.02, 60, 0, 30, 0, 0, INSIDE, 0, 1), (12, 0, 6, 1, 80, 0, 0, INSIDE, 1, 1),
    (1, 0, 50, 0, 60, 0, 0, INSIDE, 0, 1), (4, 0, 12, 0, 3, 0, 0, INSIDE, 0, 1), (9, 0, 1, 1, 2, 0, 0, INSIDE, 1, 1),
    (3, 0, 7, 0, 8, 0, 0, INSIDE, 0, 1), (25, 0.3, 40, 0, 40, 0, 0, INSIDE, 0, 1), (15, 0.5, 60, 0, 70, 0, 0, INSIDE, 0, 1),
    (200, 0.1, 0, 0, 3, 0, 0, INSIDE, 0, 1), (8, 0, 90, 0, 5, 0, 0, INSIDE, 0, 1), (2, 0, 14, 0, 1, 1, 0, INSIDE, 0, 1),
    (6, 1, 70, 0, 60, 0, 0, INSIDE, 0, 1), (30, 0, 1, 1, 1, 1, 0, INSIDE, 0, 1), (5, 0, 0, 0, 0, 0, 0, INSIDE, 0, 1),
    (6, 0, 5, 0, 60, 0, 0, INSIDE, 1, 1), (4, 0, 3, 0, 9, 0, 0, INSIDE, 0, 1), (7, 0, 5, 0, 0, 0, 0, INSIDE, 0, 1),
    (2, 0, 4, 0, 30, 0, 0, INSIDE, 0, 1), (5, 0, 6, 0, 6, 0, 0, INSIDE, 1, 1), (8, 0, 3, 1, 4, 0, 0, INSIDE, 0, 1),
    (3, 0, 4, 0, 0, 0, 0, INSIDE, 0, 1), (1, 0, 5, 0, 2, 0, 0, INSIDE, 0, 1), (7, 0, 2, 0, 5, 0, 0, INSIDE, 1, 1),
    # lists of links within articles
    (5, 1, 6, 1, 7, 1, 0, INSIDE, 0, 0), (8, 1, 5, 1, 4, 1, 0, INSIDE, 0, 0), (4, 1, 9, 1, 8, 1, 0, INSIDE, 0, 0),
    (1, 1, 1, 1, 1, 1, 0, INSIDE, 0, 0), (3, 0.9, 2, 1, 3, 1, 0, INSIDE, 0, 0), (7, 0.95, 6, 1, 5, 1, 0, INSIDE, 0, 0),
    # menus, footers, adverts, notices, forms and comments, by where they stand
    (1, 1, 1, 1, 1, 1, 1, OUTSIDE, 0, 0), (30, 0, 1, 1, 12, 0, 1, OUTSIDE, 0, 0), (60, 0, 40, 0, 50, 0, 1, INSIDE, 0, 0),
    (9, 0, 60, 0, 0, 0, 1, OUTSIDE, 0, 0), (150, 0, 20, 0, 40, 0, 1, INSIDE, 0, 0), (14, 0, 1, 1, 9, 0, 1, OUTSIDE, 0, 0),
    (2, 0, 3, 0, 2, 0, 1, NO_ZONE, 0, 0), (80, 0, 12, 0, 90, 0, 1, NO_ZONE, 0, 0), (40, 0, 120, 0, 35, 0, 1, NO_ZONE, 0, 0),
    (6, 0, 70, 0, 4, 0, 1, INSIDE, 1, 0), (4, 1, 80, 0, 5, 1, 1, INSIDE, 0, 0), (25, 0, 100, 0, 100, 0, 1, INSIDE, 0, 0),
    # what stands beside an article without a name
    (12, 0, 1, 1, 10, 0, 0, OUTSIDE, 0, 0), (5, 0, 40, 0, 0, 0, 0, OUTSIDE, 0, 0), (3, 1, 2, 1, 4, 1, 0, OUTSIDE, 0, 0),
    (45, 0, 3, 1, 9, 0, 0, OUTSIDE, 0, 0), (70, 0, 60, 0, 0, 0, 0, OUTSIDE, 0, 0), (6, 0, 2, 1, 30, 0, 0, OUTSIDE, 1, 0),
    # pages without such elements: long texts with few links, and what stands between them
    (60, 0, 10, 0, 80, 0, 0, NO_ZONE, 0, 1), (35, 0.05, 50, 0, 2, 1, 0, NO_ZONE, 0, 1), (22, 0, 1, 1, 60, 0, 0, NO_ZONE, 0, 1),
    (18, 0.1, 30, 0, 25, 0, 0, NO_ZONE, 0, 1), (100, 0.2, 0, 0, 4, 0, 0, NO_ZONE, 0, 1), (4, 0, 60, 0, 50, 0, 0, NO_ZONE, 0, 1),
    (7, 0, 2, 1, 70, 0, 0, NO_ZONE, 1, 1), (2, 0, 40, 0, 45, 0, 0, NO_ZONE, 0, 1), (9, 0, 3, 0, 40, 0, 0, NO_ZONE, 1, 1),
    (6, 0, 35, 0, 40, 0, 0, NO_ZONE, 1, 1), (14, 0, 20, 0, 30, 0, 0, NO_ZONE, 0, 1), (28, 0.3, 60, 0, 40, 0, 0, NO_ZONE, 0, 1),
    (16, 0, 0, 0, 0, 0, 0, NO_ZONE, 0, 1),
    (2, 1, 2, 1, 3, 1, 0, NO_ZONE, 0, 0), (1, 1, 0, 0, 1, 1, 0, NO_ZONE, 0, 0), (5, 0.8, 60, 0, 4, 1, 0, NO_ZONE, 0, 0),
    (6, 0, 3, 1, 4, 0, 0, NO_ZONE, 0, 0), (8, 0, 5, 0, 0, 0, 0, NO_ZONE, 0, 0), (4, 0, 80, 0, 0, 0, 0, NO_ZONE, 0, 0),
    (20, 0.9, 30, 0, 15, 1, 0, NO_ZONE, 0, 0), (3, 0, 2, 0, 5, 0, 0, NO_ZONE, 0, 0), (12, 0.7, 4, 1, 6, 0.5, 0, NO_ZONE, 0, 0),
    (5, 0, 1, 1, 3, 1, 0, NO_ZONE, 1, 0), (40, 0.8, 20, 1, 30, 1, 0, NO_ZONE, 0, 0),
]


@dataclass
class Block:
    """A text between two block tags."""

    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    path: tuple[_Open, ...] = ()
    side: bool = False
    inside: bool = False
    heading: bool = False

    @cached_property
    def text(self) -> str:  # once its parts are there
        return " ".join(html.unescape("".join(self.parts)).split())


@dataclass
class _Open:
    name: str
    side: bool  # whatever is in it
    named: bool  # by its name; an article in it is none the less one
    main: bool
    frees: bool
    comments: bool  # named after them
    hidden: bool
    text: int = 0  # characters in it


_KNOWN = SIDE_WORDS | MAIN_WORDS | WRAPPER_WORDS | OTHER_WORDS | COMMENT_WORDS
_LENGTHS = sorted({len(word) for word in _KNOWN}, reverse=True)


@lru_cache(maxsize=10_000)
def _split(name: str) -> tuple[str, ...]:
    """The known words that a name without separators is made of, as few as can be; the name itself if it is not."""
    if name in _KNOWN or len(name) > 40:
        return (name,)
    best: list[tuple[str, ...] | None] = [()] + [None] * len(name)
    for end in range(1, len(name) + 1):
        for size in _LENGTHS:
            if size <= end and best[end - size] is not None and name[end - size : end] in _KNOWN:
                made = (*best[end - size], name[end - size : end])
                if best[end] is None or len(made) < len(best[end]):
                    best[end] = made
    return best[-1] or (name,)


def _names(rest: str) -> list[set[str]]:
    """The words of each name in class, id and role; names that say what an element has or is like are left out."""
    tokens = []
    for found in _NAMED.findall(rest):
        for token in "".join(found).split():
            words = {word for part in re.findall("[A-Z]?[a-z]+|[A-Z]+", token) for word in _split(part.lower())}
            if not words & STATE_WORDS:
                tokens.append(words)
    return tokens


def _kind(name: str, rest: str, inside: bool) -> _Open:
    """What an element is: beside the article, by itself or by its name only, or the article, and whether that counts more
    than the names of what it stands in."""
    tokens = _names(rest)
    named = set().union(*tokens)
    main = name in ("article", "main") or any({"article", "body"} <= token for token in tokens)
    first = not inside and not named & MAIN_WORDS
    side = (name in SIDE_ELEMENTS and name != "form") or (name == "header" and first)
    comments = bool(named & COMMENT_WORDS)
    # In `post sidebar` the post is what it is, in `post-sidebar` it is the sidebar's; a layout is no part of itself.
    wraps = not comments and any(token & (MAIN_WORDS | WRAPPER_WORDS) and not token & SIDE_WORDS for token in tokens)
    by_name = bool(named & SIDE_WORDS) and not wraps and name not in ("article", "main", "body")
    by_name = by_name or name == "form" or ("header" in named and first)
    frees = name in ("article", "main") and not inside and not named & SIDE_WORDS
    return _Open(name, side, by_name, main, frees, comments, bool(_HIDDEN.search(rest)))


def _beside(path: tuple[_Open, ...], half: float) -> bool:
    """Whether a block in these elements stands beside the article; more than `half` of the page's text is too much for most."""
    named = False
    for x in path:
        if x.hidden or (x.side and x.text <= half):
            return True
        own = x.named and (x.comments or x.text <= half)
        named = own or (named and not x.frees)
    return named


def _unseen(page: str) -> dict[int, int]:
    """Where elements of UNSEEN begin and end, of those that have an end."""
    opened: dict[str, list[int]] = {}
    found = {}
    for tag in _UNSEEN.finditer(page):
        if tag["name"]:
            places = opened.setdefault(tag["name"].lower(), [])
            if not tag["end"]:
                places.append(tag.start())
            elif places:
                found[places.pop()] = tag.end()
    return found


def blocks(page: str) -> list[Block]:
    """Texts of a page in order, without those of scripts, styles and the head; blocks without words are left out."""
    found, current, stack, place, in_link = [], Block(), [], 0, False

    def finish(heading: bool = False) -> Block:
        size = len(current.text)
        if size:
            found.append(current)
            for x in current.path:
                x.text += size
        return Block(path=tuple(stack), inside=any(x.main for x in stack), heading=heading)

    def add(text: str) -> None:
        if text:
            current.parts.append(text)
            if in_link:
                current.linked.append(text)

    unseen = _unseen(page)
    for tag in _TAG.finditer(page):
        if tag.start() < place:  # within an element that is not seen
            continue
        add(page[place : tag.start()])
        place = unseen.get(tag.start(), tag.end())
        name = (tag["name"] or "").lower()
        if name == "title" and not tag["end"] and tag.start() not in unseen:  # it ends where the next tag begins
            place = page.find("<", place) if "<" in page[place:] else len(page)
        if not name or name in UNSEEN:
            continue
        if name == "a":
            in_link = not tag["end"]
            add(" ")
        elif name not in INLINE:
            if name in CONTAINERS and tag["end"]:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name), None)
                if depth is not None:
                    del stack[depth:]
            elif name in CONTAINERS:
                stack.append(_kind(name, tag["rest"], any(x.main for x in stack)))
            current = finish(bool(re.fullmatch("h[1-6]", name)) and not tag["end"])
    add(page[place:])
    finish()
    half = sum(len(block.text) for block in found) / 2
    for block in found:
        block.side = _beside(block.path, half)
    return found


def features(page_blocks: list[Block]) -> np.ndarray:
    """One row of FEATURES per block."""
    words = [len(block.text.split()) for block in page_blocks]
    links = [len(html.unescape(" ".join(b.linked)).split()) / n for b, n in zip(page_blocks, words, strict=True)]
    zoned = any(block.inside for block in page_blocks)
    rows = []
    for i, block in enumerate(page_blocks):
        before = (words[i - 1], links[i - 1]) if i else (0, 0)
        after = (words[i + 1], links[i + 1]) if i + 1 < len(words) else (0, 0)
        zone = INSIDE if block.inside else OUTSIDE if zoned else NO_ZONE
        rows.append((words[i], links[i], *before, *after, block.side, zone, block.heading))
    return np.array(rows, float).reshape(-1, len(FEATURES))


@dataclass
class Tree:
    """A node asks whether a feature is at most a limit, or answers."""

    answer: bool
    feature: int = -1
    limit: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def decide(self, row: np.ndarray) -> bool:
        node = self
        while node.feature >= 0:
            node = node.low if row[node.feature] <= node.limit else node.high
        return node.answer


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2) -> Tree:
    """Each node takes the question that leaves the least Gini impurity; the first such of FEATURES, lowest limit."""
    leaf = Tree(bool(y.mean() >= 0.5))
    if not depth or y.min() == y.max():
        return leaf
    best = None
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for limit in (values[:-1] + values[1:]) / 2:
            low = x[:, feature] <= limit
            if least <= low.sum() <= len(y) - least:
                impurity = sum(part.sum() * y[part].mean() * (1 - y[part].mean()) for part in (low, ~low))
                if best is None or impurity < best[0] - 1e-12:
                    best = impurity, feature, limit, low
    if best is None:
        return leaf
    _, feature, limit, low = best
    return Tree(leaf.answer, feature, limit, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def train(table: list[tuple] = LABELLED) -> Tree:
    rows = np.array(table, float)
    return grow(rows[:, :-1], rows[:, -1])


def main_text(page: str, tree: Tree) -> str:
    """Texts of the blocks that the tree takes for the article, in page order, joined by one space.

    Where it takes none, those that are neither beside it by where they stand nor mostly links.
    """
    found = blocks(page)
    rows = features(found)
    chosen = [block.text for block, row in zip(found, rows, strict=True) if tree.decide(row)]
    if not chosen:  # a page of a line or two: what stands beside nothing
        chosen = [block.text for block, row in zip(found, rows, strict=True) if not block.side and row[1] < 0.5 and row[7] != OUTSIDE and any(map(str.isalnum, block.text))]
    return " ".join(chosen)


def extract_main_text(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url, the main text of html and its length n_chars in code points.

    Null, empty and broken pages give what can be read of them, an empty text if nothing. Repeated rows are done each by
    itself, other columns are not looked at, an empty table gives no rows. One pass without a shuffle.
    """
    tree = tree or train()
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            texts = [main_text(page or "", tree) for page in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
