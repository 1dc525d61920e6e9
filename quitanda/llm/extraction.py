"""Main text of a page by the distribution of text over line blocks."""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from quitanda.llm.common import map_text

WINDOW = 3

# Elements of HTML by the part they play here.
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "canvas")
BOILERPLATE = ("head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "select")
MAIN = ("article", "main")
INLINE = (
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp",
    "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
)
VOID = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
)
# Words of class, id and role that mark an element as boilerplate.
MARKS = (
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer",
    "header", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
    "popup", "promo", "related", "replies", "reply", "respond", "share", "sharing", "sidebar",
    "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
)

# Elements whose start ends open ones without an end tag, and blocks that end a paragraph.
IMPLIED = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"),
    "tr": ("tr", "td", "th"), "option": ("option",),
}
ENDS_PARAGRAPH = (
    "address", "article", "aside", "blockquote", "dd", "details", "div", "dl", "dt", "fieldset",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main",
    "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
)

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")

# Characters outside links in a window of lines that make a body, or this share of the most.
FULL_CHARS = 80
FULL_SHARE = 0.25

# Share of a body's least characters that its first and last line have themselves.
EDGE_SHARE = 0.25

_RAW = "|".join(RAW)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*?"
    rf"(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def is_marked(attributes: str) -> bool:
    """Whether class, id or role has a word that stands for boilerplate."""
    return any(
        word in MARKS
        for value in _MARKED.findall(attributes)
        for word in _WORDS.findall(value.lower())
    )


@dataclass(frozen=True)
class Line:
    """Text of a block, its characters outside links, and what it lies in.

    Headings right above a body belong to it. ``marked`` counts the open elements whose class, id or role marks them.
    """

    text: str
    free: int
    main: bool
    out: bool
    marked: int
    heading: bool


class _Open:
    """The open elements of a page, with how many there are of each name and of each part."""

    def __init__(self):
        self.stack: list[tuple[str, str]] = []
        self.names: Counter = Counter()
        self.parts: Counter = Counter()

    def push(self, name: str, part: str) -> None:
        self.stack.append((name, part))
        self.names[name] += 1
        self.parts[part] += 1

    def cut(self, size: int) -> None:
        while len(self.stack) > size:
            name, part = self.stack.pop()
            self.names[name] -= 1
            self.parts[part] -= 1

    def end(self, name: str) -> None:
        """The nearest element of this name ends, with all that are open in it."""
        if self.names[name]:
            at = len(self.stack) - 1
            while self.stack[at][0] != name:
                at -= 1
            self.cut(at)

    def ends_part(self, name: str) -> bool:
        """Whether the end of ``name`` ends an element that keeps text out."""
        if not self.names[name] or not (self.parts["out"] or self.parts["marked"]):
            return False
        for other, part in reversed(self.stack):
            if part in ("out", "marked"):
                return True
            if other == name:
                return False
        return False

    def imply(self, name: str) -> None:
        """The start of ``name`` ends what HTML lets end without a tag."""
        ended = (*IMPLIED.get(name, ()), *(("p",) if name in ENDS_PARAGRAPH else ()))
        if not any(self.names[other] for other in ended):
            return
        at, found = len(self.stack), None
        while at and (self.stack[at - 1][0] in (*ended, "p") or self.stack[at - 1][0] in INLINE):
            at -= 1
            if self.stack[at][0] in ended:
                found = at
        if found is not None:
            self.cut(found)

    def readmit(self) -> None:
        """Elements that keep text out were never closed: they no longer do."""
        self.stack = [(n, p if p in ("", "main") else "") for n, p in self.stack]
        self.parts["out"] = self.parts["marked"] = 0


def page_lines(page: str) -> list[Line]:
    """The page as lines, one for each block.

    Every tag that is not inline ends a line. Character references are decoded after the
    markup is gone, so an escaped tag stays text. Raw elements leave nothing.
    """
    lines: list[Line] = []
    parts: list[tuple[str, bool]] = []
    opened, at = _Open(), 0

    def end_line() -> None:
        text = _SPACE.sub(" ", references.unescape("".join(t for t, _ in parts))).strip()
        if text:
            free = "".join(t for t, linked in parts if not linked)
            free = len(_SPACE.sub(" ", references.unescape(free)).strip())
            kinds = opened.parts
            heading = any(opened.names[name] for name in HEADINGS)
            lines.append(
                Line(text, free, kinds["main"] > 0, kinds["out"] > 0, kinds["marked"], heading)
            )
        parts.clear()

    for token in _TOKEN.finditer(page):
        parts.append((page[at : token.start()], opened.names["a"] > 0))
        at = token.end()
        if token["name"] is None:
            continue
        name, closing = token["name"].lower(), bool(token["close"])
        if name not in INLINE:
            end_line()
        if name in VOID:
            continue
        if closing:
            if opened.ends_part(name):
                end_line()
            opened.end(name)
            continue
        opened.imply(name)
        part = ""
        if name in MAIN:
            if not opened.parts["main"]:
                opened.readmit()
            part = "main"
        elif name in BOILERPLATE:
            part = "out"
        elif name not in ("html", "body") and is_marked(token["rest"]):
            part = "marked"
        if part:
            end_line()
        opened.push(name, part)
    parts.append((page[at:], opened.names["a"] > 0))
    end_line()
    return lines


def _windows(lengths: Sequence[int], window: int) -> list[int]:
    return [sum(lengths[i : i + window]) for i in range(len(lengths))]


def body_span(
    lengths: Sequence[int], window: int = WINDOW, least: float = 1
) -> tuple[int, int]:
    """First and last line (exclusive) between the surge and the dive of the text lengths.

    A block's length is the sum over ``window`` lines from its first one on. The surge is the
    first block of at least ``least`` characters, the dive the end of the last one. Lines at
    the ends with less than ``EDGE_SHARE`` of that are left off.
    """
    blocks = _windows(lengths, window)
    full = [i for i, size in enumerate(blocks) if size >= least and size]
    if not full:
        return 0, 0
    surge, dive = full[0], min(full[-1] + window, len(lengths))
    edge = least * EDGE_SHARE
    while lengths[surge] < edge or not lengths[surge]:
        surge += 1
    while lengths[dive - 1] < edge or not lengths[dive - 1]:
        dive -= 1
    return surge, dive


def main_text(page: str | None, window: int = WINDOW) -> str:
    """Blocks of the page's main text, one to a line; empty if it has none.

    Text inside ``article`` or ``main`` is the main text where there is any. On other pages
    it lies between surge and dive of the characters outside links, or of all characters if
    every one is in a link. Boilerplate elements count as empty, and so do marked ones, unless
    no body is left without them: then the outermost marks are taken for wrong.
    """
    lines = [line for line in page_lines(page or "") if not line.out]
    inside = [line for line in lines if line.main and not line.marked]
    if inside:
        return "\n".join(line.text for line in inside)
    if any(line.main for line in lines):
        lines = [line for line in lines if line.main]
    linked = not any(line.free for line in lines)
    sizes = [len(line.text) if linked else line.free for line in lines]
    least = min(FULL_CHARS, FULL_SHARE * max(_windows(sizes, window), default=0))
    for depth in sorted({line.marked for line in lines}):
        wanted = [line.marked <= depth for line in lines]
        found = [size * keep for size, keep in zip(sizes, wanted)]
        surge, dive = body_span(found, window, least)
        if surge < dive and (depth or least <= max(_windows(found, window))):
            while surge and lines[surge - 1].heading:
                surge -= 1
            return "\n".join(lines[i].text for i in range(surge, dive) if wanted[i])
    return ""


def extract_text(
    pages: DataFrame, keep: Sequence[str] = ("page_id", "url"), html: str = "html"
) -> DataFrame:
    """The columns in ``keep`` and ``text``, one row per page.

    A null or empty page, and one without main text, has the empty text. Unclosed elements
    end with the page, at the next main element, or where their parent's tag closes them.
    Repeated rows give repeated results; other columns are not read. No shuffle.
    """
    def start():
        return lambda texts: [(main_text(page),) for page in texts]

    return map_text(pages, start, html, keep, [("text", "string")])
