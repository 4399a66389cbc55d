"""Main text of HTML pages by line-block distribution.

The markup is stripped into lines: every block-level tag ends a line, and a
container that is no part of an article (menu, header, footer, sidebar,
notice, advert, form, script, style, comment area; told by its element, role,
class or id) leaves ``GAP`` empty lines in its place. Each line then weighs
its text outside links (a heading or paragraph that is one link weighs in
full), and the sum over a sliding window of ``WINDOW`` lines is the block
distribution. Text surges where the sum rises from nothing and dives where it
falls back to nothing; a surge-to-dive stretch is one region. The region with
most text is kept. With an ``<article>`` or ``<main>`` around it, all that
stands there from its first surge to its last dive is kept, lines of links
too. On a page without one, so is every region of at least ``SHARE`` of its
weight, or in the same container, whose links are the smaller part.

Names mislead, so weights have the last word on the ambiguous ones: a form, or
a container with a layout name, that holds a page's structure and all but a
small share of its text is a wrapper and hides nothing by itself. A class that
says what its element has (``has-sidebar``) or an article's own header
(``entry-header``) is no part of the surroundings.

Defined cases: null or empty html gives the empty string; html cut off in a
tag, comment or reference is read as far as it goes; a page without any
surviving text gives the empty string; an end tag without a start is passed
over, and one of an inline element closes no block. Time is linear in the
page's length, which nothing cuts. An empty table gives an empty one. Rows are
independent, so ties, repeated rows, null keys and extra columns of any name
change nothing.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
GAP = WINDOW + 1
SHARE = 0.3

# Elements by their part in a page.
HIDDEN = frozenset(
    "script style noscript template head title svg math iframe object canvas audio video select option textarea "
    "button datalist map".split()
)
OUTSIDE = frozenset("nav header footer aside form dialog menu fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html "
    "legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
) | OUTSIDE
CLOSED_BY_BLOCK = frozenset("p dt dd li option tr td th".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
OUTSIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu menubar topbar breadcrumb breadcrumbs sidebar side aside rail widget widgets footer header masthead cookie cookies consent "
    "gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login search "
    "share sharing social related recommended recommendations comment comments commentlist disqus respond reply replies "
    "discussion pagination pager toolbar skip copyright legal disclaimer tags".split()
)
# Of these names: said of an article's own parts too; said of whole layouts too; said of readers' words only.
OWN_NAMES = frozenset("header masthead legal disclaimer copyright search tags toolbar side".split())
LAYOUT_NAMES = frozenset("side sidebar aside rail header masthead topbar toolbar widget widgets banner search tags legal disclaimer copyright".split())
READER_NAMES = frozenset("comment comments commentlist reply replies".split())
STATE_WORDS = frozenset("has no with without open closed enabled disabled".split())
ARTICLE_WORDS = frozenset("entry post article story".split())
ARTICLE = frozenset(("article", "main"))
CONTAINERS = frozenset("div section td blockquote".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote figcaption".split())
INLINE = frozenset("abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong sub sup time u var".split())
PART, WRAPPER = 1, 2

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|\Z)?", re.S
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in ("script", "style", "title", "textarea", "noscript", "iframe", "template", "svg")}
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


def _names(value: str, name: str, in_article: bool) -> set[str]:
    """Words of a class or id that tell of the surroundings of an article."""
    found: set[str] = set()
    for token in value.split():
        words = {w.lower() for w in _NAME.findall(token)}
        outside = words & (READER_NAMES if name == "article" else OUTSIDE_NAMES)
        if not outside or words & STATE_WORDS or outside == {"header"} and words & ARTICLE_WORDS:
            continue
        found |= outside - OWN_NAMES if in_article else outside
    return found


def _outside_kind(name: str, attributes: str, in_main: bool, in_article: bool) -> tuple[bool, int]:
    """Whether an element is never shown; else whether it is a part beside the article, or one that may wrap it."""
    kind = 0
    if name in OUTSIDE and not (name == "header" and in_main):
        kind = WRAPPER if name in ("form", "fieldset") else PART
    if not attributes or name in ("html", "body", "main"):
        return False, kind
    for key, *values in _ATTRIBUTE.findall(attributes):
        value, key = "".join(values), key.lower()
        if key in ("class", "id"):
            found = _names(value, name, in_article)
            if found:
                kind = max(kind, WRAPPER) if found <= LAYOUT_NAMES and kind != PART else PART
        elif name == "article":
            continue
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            return True, 0
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, 0
        elif key == "role" and value.lower() in OUTSIDE_ROLES:
            kind = PART
    return False, kind


@dataclass
class _Beside:
    """A container told apart from the article by its element or names, and what it holds."""

    parent: int
    kind: int
    form: bool
    in_main: bool
    structure: bool = False
    paragraphs: int = 0
    shown: bool = False


@dataclass
class _Line:
    text: str
    weight: int
    article: int  # number of the article or main element around it, 0 for none
    container: int
    beside: int  # number of the innermost container beside the article, 0 for none


@dataclass
class _Page:
    lines: list[_Line] = field(default_factory=list)
    beside: list[_Beside] = field(default_factory=lambda: [_Beside(0, 0, False, False, shown=True)])
    text: list[str] = field(default_factory=list)
    linked: int = 0
    links: int = 0
    has_main: bool = False

    def add(self, text: str, linked: bool) -> None:
        self.text.append(text)
        if linked:
            self.linked += len(_SPACE.sub(" ", html.unescape(text)).strip())

    def end(self, article: int, container: int, beside: int, block: str) -> None:
        if self.text:
            text = _SPACE.sub(" ", html.unescape("".join(self.text))).strip()
            if text:
                prose = self.links < 2 and (block in PROSE if article else block in ("h1", "p"))
                self.lines.append(_Line(text, len(text) if prose else max(0, len(text) - self.linked), article, container, beside))
        self.text, self.linked, self.links = [], 0, 0

    def gap(self, beside: int) -> None:
        self.lines += [_Line("", 0, 0, 0, beside)] * GAP

    def shown(self) -> list[_Line]:
        """The lines that stand in no container beside the article, with a gap for each that does."""
        held = [0] * len(self.beside)  # with the wrappers inside
        for line in self.lines:
            held[line.beside] += line.weight
        base = sum(line.weight for line in self.lines if not line.beside and (line.article or not self.has_main))
        for at in range(len(self.beside) - 1, 0, -1):
            if self.beside[at].kind == WRAPPER:
                held[self.beside[at].parent] += held[at]
        for at, part in enumerate(self.beside[1:], 1):
            whole = part.structure or part.form and part.paragraphs > 1
            if part.kind == WRAPPER and self.beside[part.parent].shown and whole and (part.in_main or not self.has_main):
                part.shown = held[at] > 0 and base < SHARE * held[at]
        kept: list[_Line] = []
        hidden = False
        for line in self.lines:
            if self.beside[line.beside].shown:
                kept.append(line)
            elif not hidden:
                kept += [_Line("", 0, 0, 0, 0)] * GAP
            hidden = not self.beside[line.beside].shown
        return kept


def page_lines(page: str) -> list[_Line]:
    out = _Page()
    stack: list[tuple] = []  # (name, never shown, article, container, beside) as they were ahead of the element
    where: dict[str, list[int]] = {}  # places in the stack by name
    blocks: list[int] = []  # places of block elements in the stack
    hidden = linked = article = articles = proper = container = containers = beside = at = 0

    def block() -> str:
        return stack[blocks[-1]][0] if blocks else ""

    def close(depth: int) -> None:
        nonlocal hidden, article, container, beside, proper
        while len(stack) > depth:
            name, was_hidden, article, container, was_beside = stack.pop()
            where[name].pop()
            proper -= name == "article"
            if blocks and blocks[-1] == len(stack):
                blocks.pop()
            hidden -= was_hidden
            beside = was_beside

    def end() -> None:
        out.end(article, container, beside, block())

    while at < len(page):
        m = _TOKEN.search(page, at)
        stop = m.start() if m else len(page)
        if stop > at and not hidden:
            out.add(page[at:stop], linked > 0)
        if not m:
            break
        at = m.end()
        if m.group(2) is None or not m.group(4):
            if m.group(2) is not None and m.end() < len(page) and not m.group(4):  # a quote that never ends
                at = page.find(">", m.start()) + 1 or len(page)
            else:
                continue
        name, closing, attributes = m.group(2).lower(), bool(m.group(1)), m.group(3) or ""
        if not closing and name in _RAW_END and not attributes.endswith("/"):
            raw = _RAW_END[name].search(page, at)
            at = raw.end() if raw else len(page)
            continue
        if name in BLOCKS and not hidden:
            end()
        if name == "br":
            if not hidden:
                out.add(" ", False)
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if name == "a":
            linked = 0 if closing else 1
            out.links += linked
            continue
        if closing:
            places = where.get(name)
            if places and (name in BLOCKS or not blocks or places[-1] > blocks[-1]):
                if not hidden and stack[places[-1]][4] != beside:
                    end()
                close(places[-1])
            continue
        if name in BLOCKS and block() in CLOSED_BY_BLOCK and (name == block() or block() == "p"):
            close(blocks[-1])
        never, kind = _outside_kind(name, attributes, article > 0, proper > 0)
        if name in INLINE and kind or name in HIDDEN:
            never, kind = True, 0
        if (never and name in BLOCKS or kind) and not hidden:
            end()
            linked = 0
            if never:
                out.gap(beside)
        stack.append((name, int(never), article, container, beside))
        where.setdefault(name, []).append(len(stack) - 1)
        proper += name == "article"
        if name in BLOCKS:
            blocks.append(len(stack) - 1)
        hidden += never
        if hidden:
            continue
        if name in ("h1", "nav", "header", "footer", "aside") or name in ARTICLE:
            out.beside[beside].structure = True
        out.beside[beside].paragraphs += name == "p"
        if kind:
            out.beside.append(_Beside(beside, kind, name == "form", article > 0))
            beside = len(out.beside) - 1
            out.gap(beside)
        if name in CONTAINERS:
            containers += 1
            container = containers
        if name in ARTICLE and not article:
            articles += 1
            article = articles
            out.has_main |= not beside
    if not hidden:
        end()
    return out.shown()


def regions(weights: list[int]) -> list[tuple[int, int]]:
    """Surge-to-dive stretches of the windowed sums, as [start, end) of lines."""
    found, start, total = [], None, 0
    for at in range(len(weights) + WINDOW):
        total += weights[at] if at < len(weights) else 0
        total -= weights[at - WINDOW] if at >= WINDOW else 0
        if total > 0 and start is None:
            start = at
        elif total == 0 and start is not None:
            found.append((start, min(at - WINDOW + 1, len(weights))))
            start = None
    if start is not None:
        found.append((start, len(weights)))
    return found


def main_text(page: str | None) -> str:
    lines = page_lines(page or "")
    found = [(s, e, sum(line.weight for line in lines[s:e])) for s, e in regions([line.weight for line in lines])]
    if not found:
        return ""
    inside = [f for f in found if any(line.article for line in lines[f[0] : f[1]])]
    best = max(inside or found, key=lambda f: (f[2], -f[0]))
    if inside:
        homes = {line.article for line in lines[best[0] : best[1]] if line.article}
        spans = [f for f in inside if any(line.article in homes for line in lines[f[0] : f[1]])]
        between = lines[spans[0][0] : spans[-1][1]]
        return "\n\n".join(line.text for line in between if line.article in homes and line.text)
    homes = {line.container for line in lines[best[0] : best[1]] if line.container}
    kept: list[str] = []
    for start, end, weight in found:
        stretch = [line for line in lines[start:end] if line.text]
        solid = 2 * weight > sum(len(line.text) for line in stretch)
        if start == best[0] or solid and (weight >= SHARE * best[2] or any(line.container in homes for line in stretch)):
            kept += [line.text for line in stretch]
    return "\n\n".join(kept)


def extract_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All given columns but the html, plus ``main_text``. Row by row in Arrow batches, no shuffle."""
    others = [c for c in pages.columns if c not in (html_col, "main_text")]
    plain = [f"c{i}" for i in range(len(others))]  # names free of dots inside the Arrow step

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(p) for p in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], texts], [*plain, "main_text"])

    picked = pages.select(F.col(f"`{html_col}`").cast("string").alias("html"), *(F.col(f"`{c}`").alias(n) for c, n in zip(others, plain)))
    schema = ", ".join(f"{n} {pages.schema[c].dataType.simpleString()}" for c, n in zip(others, plain))
    return picked.mapInArrow(run, f"{schema}, main_text string" if plain else "main_text string").toDF(*others, "main_text")
