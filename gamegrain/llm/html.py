"""Main text of web pages by scoring their element tree."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.llm.common import prepare

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe svg math".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meta link q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# What is not the article: by element, and by the names in its class, id or role. A name counts if all its parts are on
# the two lists, one of them on the first.
FURNITURE = set("nav header footer aside form head button select dialog menu object".split()) | RAW
FURNITURE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner banners cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside footer header masthead comment comments reply replies respond disqus share sharing social related "
    "newsletter subscribe subscription signup login widget toolbar pagination pager search complementary contentinfo".split()
)
FILLERS = set(
    "site page main global top bottom left right primary secondary post posts article articles story entry list box bar "
    "block area wrapper wrap container section inner outer group item items links link buttons button icons slot unit "
    "panel form reader user the and".split()
)
# Never the text, however much they hold.
NEVER = set("nav footer aside menu button select head".split()) | RAW
COMMENTS = set("comment comments reply replies respond disqus".split())
WHOLE = {"html", "body", "main"}
FRAMES = {"article", "main"}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>""", re.S)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none""", re.I)
WORD = re.compile(r"[a-z]+")

LEAST_CHARS = 25  # shorter paragraphs give no points, unless the page has no others
SIBLING_SHARE = 0.2  # beside an article, a sibling with this part of the best score belongs to the text
HOLDS_ALL = 0.9  # an element with this part of the page's points, and with its title or article, is no furniture


class Node:
    __slots__ = ("tag", "parent", "kind", "frame", "titles", "points", "chars", "linked", "raw", "title")

    def __init__(self, tag: str, parent: Node | None, kind: int = 0):
        self.tag, self.parent, self.kind = tag, parent, kind  # kind: 0 text, 1 furniture, 2 furniture in any case
        self.frame = parent is not None and (parent.frame or tag in FRAMES)
        # The header of an article: its headings are part of the text.
        self.titles = parent is not None and (parent.titles or tag == "header" and self.frame) and kind < 2
        self.points = self.raw = 0.0
        self.chars = self.linked = 0
        self.title = False

    def score(self) -> float:
        return self.points * (1 - self.linked / self.chars) if self.chars else 0.0

    def up(self) -> Iterator[Node]:
        node = self
        while node is not None:
            yield node
            node = node.parent

    def dropped(self) -> bool:
        heading = self.tag in HEADINGS and self.titles
        return any(n.kind and not (heading and n.tag == "header" and n.titles) for n in self.up())


def _kind(tag: str, attributes: str) -> int:
    """Whether an element is furniture: 0 no, 1 unless it holds the whole text, 2 in any case."""
    if tag in NEVER:
        return 2
    kind = int(tag in FURNITURE)
    if not attributes or tag in WHOLE:
        return kind
    if HIDDEN.search(attributes):
        kind = 1
    for value in NAMED.findall(attributes):
        for name in value.lower().strip("\"'").split():
            words = set(WORD.findall(name))
            named = words & FURNITURE_WORDS
            if named and words <= FURNITURE_WORDS | FILLERS:
                kind = max(kind, 2 if named & COMMENTS else 1)
    return kind


def blocks_of(html: str) -> list[tuple[Node, str, int]]:
    """Stretches of text between block boundaries in page order: (element, text, characters inside links)."""
    root = Node("", None)
    top, blocks, pieces = root, [], []
    linked, links, at, end = 0, 0, 0, len(html)

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append((top, text, min(linked, len(text))))
        pieces, linked = [], 0

    def take(text: str) -> None:
        nonlocal linked
        if text:
            text = unescape(text)
            pieces.append(text)
            if links:
                linked += len(text.strip())

    while at < end:
        found = TAG.search(html, at)
        if found is None:
            take(html[at:])
            break
        take(html[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            if tag == "a":
                links = 0
            elif tag not in INLINE:
                flush()
                match = next((n for n in top.up() if n.tag == tag), None)
                if match is not None and match.parent is not None:
                    top, links = match.parent, 0
            continue
        if tag == "br":
            pieces.append(" ")
        elif tag in RAW:
            close = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(html, at)
            at = close.end() if close else end
        elif tag == "a":
            links = 1
        elif tag == "hr" or tag not in INLINE and tag not in VOID:
            flush()
            links = 0
            closes = CLOSES.get(tag)
            if closes:
                while top.tag in closes or top.tag == "p":
                    top = top.parent
            elif top.tag == "p" or top.tag in HEADINGS and tag in HEADINGS:
                top = top.parent
            if tag not in VOID and not found[3].endswith("/"):
                top = Node(tag, top, _kind(tag, found[3]))
                if tag in FRAMES or tag == "h1":
                    for owner in top.up():
                        owner.title = True
    flush()
    return blocks


def _points(text: str) -> int:
    return 1 + text.count(",") + min(len(text) // 100, 3)


def without_furniture(blocks: list[tuple[Node, str, int]]) -> list[tuple[Node, str, int]]:
    """The blocks that no furniture holds. An element that holds nearly all points of the page, and its title or its
    article, is no furniture, whatever its name: a form or an odd wrapper around the whole page."""
    total = 0
    for node, text, _ in blocks:
        owners = [*node.up()]
        if len(text) >= LEAST_CHARS and node.tag not in HEADINGS and all(n.kind < 2 for n in owners):
            total += _points(text)
            for owner in owners:
                owner.raw += _points(text)
    for node, _, _ in blocks:
        for owner in node.up():
            if owner.kind == 1 and owner.title and total and owner.raw >= HOLDS_ALL * total:
                owner.kind = 0
    return [block for block in blocks if not block[0].dropped()]


def _award(blocks: list[tuple[Node, str, int]], least: int) -> list[Node]:
    """Points of the paragraphs: the container gets them whole, the element around it half."""
    scored = {}
    for node, text, _ in blocks:
        if len(text) < least or node.tag in HEADINGS:
            continue
        points = _points(text)
        holder = node.parent if node.tag in ("p", "pre", "li", "td", "blockquote", "dd") and node.parent else node
        for owner, part in ((holder, 1.0), (holder.parent, 0.5)):
            if owner is not None:
                owner.points += part * points
                scored[id(owner)] = owner
    return list(scored.values())


def main_text(html: str | None) -> str:
    """The text of the best container and of the siblings that belong to it."""
    blocks = without_furniture(blocks_of(html or ""))
    if not blocks:
        return ""
    for node, text, linked in blocks:
        for owner in node.up():
            owner.chars += len(text)
            owner.linked += linked
    scored = _award(blocks, LEAST_CHARS) or _award(blocks, 0)
    if not scored:
        return " ".join(text for _, text, _ in blocks)
    best = max(scored, key=Node.score)
    best = next((n for n in best.up() if n.tag == "article"), best)
    around, least = best.parent, best.score() * SIBLING_SHARE
    framed = best.tag in FRAMES

    def belongs(node: Node, text: str, linked: int) -> bool:
        branch = None
        for owner in node.up():
            if owner is best:
                return True
            if owner.parent is around and around is not None:
                branch = owner
        if branch is None:
            return False
        if not framed:  # what furniture left of the parts beside the best one is text, unless most of it is links
            return 2 * branch.linked <= branch.chars
        sparse = 4 * linked <= len(text)
        return branch.tag in HEADINGS or branch.score() >= least > 0 or branch.tag == "p" and len(text) > 80 and sparse

    return " ".join(text for node, text, linked in blocks if belongs(node, text, linked))


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row; nothing is shuffled.

    NULL and empty pages, and pages of markup only, have an empty text. Broken markup is read as far as it goes: an
    unclosed element ends with the page, an unclosed script hides the rest. Of containers with equal scores the first
    one counts. Repeated rows each give their row, an empty table gives an empty result, a very long page is one row.
    Extra columns are not read.
    """
    prepare(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [main_text(html) for html in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "text": texts,
                                "n_chars": [len(text) for text in texts]})

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return narrow.mapInPandas(run, "page_id long, url string, text string, n_chars long")
