"""Main text of web pages by line-block distribution.

A page is cut into lines at block-level markup, and each line has a weight.
Over the weights a short window slides: where its sum surges the text begins,
at the first line with a weight, where it dives to nothing the text ends, at the
last one, and all lines between are kept.

Tags and names only weigh. Elements that are navigation, notices, forms and the
like by their tag, role or class count as one line without text. Text in links
has no weight. Markup that points to text is believed unless the windows tell
otherwise, by far denser ones elsewhere. Where paragraphs, headings and the like
are believed, text that lies bare in containers has no weight. Where elements that
say that they are the article are believed, which those around mere teasers are
not, text in them has its whole length and other text none.
Pages are independent rows.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from brindle.llm.tasks import append_columns

WINDOW = 3
# The sum at which text begins, where no element says that it is the article.
SURGE = 60
# Markup is not believed where a window outside of it is over so many times as dense as any inside and as a surge.
DENSER = 4

# Attributes end at the tag's end or where another tag begins, so no token is looked for twice.
ATTRIBUTES = r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|select|xmp)\b{ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attributes>{ATTRIBUTES})>"
    r"|</?[a-z][^<>]*>|<[!?][^<>]*>",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED_TAGS = frozenset("head nav footer aside form button dialog menu object audio video canvas".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr"
    " notice notification alert sidebar widget menu nav navbar navigation breadcrumb breadcrumbs header masthead"
    " topbar footer comment comments reply replies disqus share sharing social related recommended newsletter"
    " subscribe subscription signup login popup modal overlay pagination pager toolbar copyright".split()
)
# Words that say what an element is, not what it holds.
PLAIN_NAMES = frozenset(
    "area bar block body bottom box btn button col column container content css div element en fixed float form grid group holder"
    " id inner item items js left link links list main module outer page panel right row section site slot sticky text title"
    " top unit web wrap wrapper".split()
)
MAIN_TAGS = frozenset(("article", "main"))
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption caption".split())


def _names_dropped(name: str) -> bool:
    """Whether a whole class or id says that an element is dropped: nothing in it may tell of anything else.

    "cookie-banner" and "site-header" do, "related-work" and "share-price" do not.
    """
    words = {part.lower() for part in NAME_PART.findall(name)}
    return bool(words & DROPPED_NAMES) and words <= DROPPED_NAMES | PLAIN_NAMES


def _dropped(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no part of the article."""
    if tag in DROPPED_TAGS or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in DROPPED_ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if name in ("class", "id") and any(map(_names_dropped, value.split())):
            return not (inside and "header" in value.lower() and tag in ("h1", "h2", "header"))
    return False


class Line(NamedTuple):
    text: str
    plain: int  # length outside links
    inside: bool  # in an article by its tag
    block: bool  # in a paragraph, heading or the like


class _Blocks:
    """The open block-level elements, and how many of them hold text."""

    def __init__(self) -> None:
        self.stack: list[str] = []
        self.count: Counter[str] = Counter()
        self.texts = 0

    def open(self, tag: str) -> None:
        # a paragraph ends where any block begins, an item where the next one does
        if self.stack and self.stack[-1] in ("p", tag) and self.stack[-1] in TEXT_TAGS:
            self._pop()
        self.stack.append(tag)
        self.count[tag] += 1
        self.texts += tag in TEXT_TAGS

    def close(self, tag: str) -> None:
        if self.count[tag]:
            while self._pop() != tag:
                pass

    def _pop(self) -> str:
        tag = self.stack.pop()
        self.count[tag] -= 1
        self.texts -= tag in TEXT_TAGS
        return tag


def _lines(page: str) -> list[Line]:
    """The lines of a page; an element that is dropped is one without text."""
    tokens = list(TOKEN.finditer(page))
    ends, open_tags = {}, {}
    for i, token in enumerate(tokens):
        tag = (token["tag"] or "").lower()
        if tag and token["close"]:
            if open_tags.get(tag):
                ends[open_tags[tag].pop()] = i
        elif tag and tag not in VOID and not token["attributes"].endswith("/"):
            open_tags.setdefault(tag, []).append(i)
    lines: list[Line] = []
    parts: list[str] = []
    blocks = _Blocks()
    linked = depth = main = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            lines.append(Line(text, max(0, len(text) - linked), main > 0, blocks.texts > 0))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if depth:
            linked += len(" ".join(unescape(text).split()))

    at, skip_to = 0, -1
    for i, token in enumerate(tokens):
        if i > skip_to and token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if i <= skip_to or not tag:
            if token["raw"] or i == skip_to:
                flush()
            continue
        if not token["close"] and _dropped(tag, token["attributes"], main > 0):
            flush()
            lines.append(Line("", 0, main > 0, False))
            # without an end the element lasts to the next tag
            skip_to = ends.get(i, i)
            depth = 0
            continue
        if tag == "a":
            depth = 0 if token["close"] else 1
        elif tag not in INLINE:
            flush()
            depth = 0
            if token["close"]:
                blocks.close(tag)
            elif tag not in VOID and not token["attributes"].endswith("/"):
                blocks.open(tag)
        if tag in MAIN_TAGS:
            main = max(0, main - 1) if token["close"] else main + 1
    if at < len(page):
        add(page[at:])
    flush()
    return lines


def _sums(weights: list[int]) -> list[int]:
    """The sum of the window that begins at each line."""
    return [sum(weights[i : i + WINDOW]) for i in range(len(weights))]


def _outweighed(marked: list[int], others: list[int]) -> bool:
    """Whether the windows tell that the text lies in lines other than those that markup points to."""
    densest = max(_sums(marked), default=0)
    return not densest or max(_sums(others), default=0) > DENSER * max(densest, SURGE)


def _weights(lines: list[Line]) -> tuple[list[int], bool]:
    """What each line adds to its windows, and whether the page's marks of its article are believed."""
    blocks = [line.plain if line.block else 0 for line in lines]
    bare = [0 if line.block else line.plain for line in lines]
    free = [line.plain for line in lines] if _outweighed(blocks, bare) else blocks
    inside = [len(line.text) if line.inside else 0 for line in lines]
    outside = [0 if line.inside else weight for line, weight in zip(lines, free)]
    return (free, False) if _outweighed(inside, outside) else (inside, True)


def main_text(page: str | None) -> str:
    """The main text of one page; empty for a null, empty or textless page."""
    lines = _lines(page or "")
    weights, marked = _weights(lines)
    sums = _sums(weights)
    # every line of an article that is marked is its text
    surge = min(1 if marked else SURGE, max(sums, default=0))
    kept: list[str] = []
    i = 0
    while i < len(lines) and surge:
        if sums[i] < surge:
            i += 1
            continue
        first = i
        while first and weights[first - 1]:
            first -= 1
        while not weights[first]:
            first += 1
        while i < len(lines) and sums[i]:
            i += 1
        kept.extend(line.text for line in lines[first:i] if line.text and (line.inside or not marked))
    return " ".join(kept)


def extract_slice(part: pa.RecordBatch) -> list[pa.Array]:
    return [pa.array([main_text(page) for page in part.column(0).to_pylist()], pa.string())]


def extract(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``df`` with the main text of ``html`` in ``text`` and its code points in ``n_chars``.

    A null or empty page has an empty text, an empty table gives an empty one, and
    long pages are read whole, in time in proportion to their length. Rows keep their
    number, repeated rows included; columns named like the outputs are replaced.
    """
    found = append_columns(df, extract_slice, [html], [StructField(text, StringType())])
    kept = [c for c in found.columns if c.lower() != "n_chars"]
    return found.select(*(F.col("`" + c.replace("`", "``") + "`") for c in kept), F.length(text).cast(LongType()).alias("n_chars"))
