"""Main text of web pages by tag-path ratios.

The blocks of a page (its leaves of text) are grouped by tag path, the tags from the root down to the block. Paths of
content hold much text and punctuation per block, paths of boilerplate hold little, and much of it in links. For each path

    text ratio = characters per block, those in links for little,    punctuation ratio = punctuation marks per block

are fused by the product of their logarithms, spread over the page in block order and smoothed, so that a path gains from
neighbours that are content. The score is the mean of both values, weighted by what the path says of itself (``article``
speaks for content, ``class="ad"`` against). Blocks above a threshold taken from the page's own scores are content; headings go
with the content they head. An element with the main heading or the main part of the page is around the page, whatever its
class says; how much text it holds is not asked. Only hidden text and text whose nearest sectioning element speaks against it (``nav``) are left out before.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# HTML elements by what they mean for text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table"
    " tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base basefont bgsound br col embed frame hr img input link meta param source track wbr".split())
# Their contents are not markup.
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg math object".split())
BOILERPLATE = frozenset("nav header footer aside form button select option menu dialog fieldset label input search".split())
CONTENT = frozenset("article main".split())
# The nearest of these around a block can rule it out.
SECTIONS = BOILERPLATE | CONTENT | {"section"}
# A form with one of these is around the page, not a part of it.
PAGE_PARTS = frozenset("article aside footer header nav".split())
# The whole page, whatever their classes say.
PAGE = frozenset("html body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# Opening one of the first closes an open one of the second, up to the nearest of the third.
CLOSES = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "option": ("option", "select"),
}
# Words in class, id and role that speak against content, and for it.
AGAINST = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner popup modal overlay cookie cookies consent gdpr"
    " notice notices alert menu nav navbar navigation breadcrumb breadcrumbs sidebar rail widget footer foot header masthead topbar toolbar"
    " comment comments disqus reply replies respond discussion share sharing social related recommended recommendations newsletter"
    " subscribe subscription signup login search pagination pager copyright legal disclaimer skip complementary contentinfo".split()
)
FOR = frozenset("articlebody article-body post-content entry-content article-content story-body main-content".split())

MARKS = re.compile(r"[.,;:!?…。、，！？；：]")
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>")
LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|itemprop|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)

# Weight of a path that speaks for content; one that speaks against it has the inverse.
TRUST = 8.0
# What an element says that is not shown.
HIDDEN = -2
# Share of the page's mean score that content reaches.
THRESHOLD = 0.5
# Share of a character that one in a link lacks.
LINKED = 0.9
KERNEL = np.exp(-np.arange(-2, 3) ** 2 / 2)
KERNEL /= KERNEL.sum()


def _tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) for each tag (``open``, ``close``) and text of a page, in linear time."""
    at, size = 0, len(html)
    loose_from = size  # quotes after this place are not closed
    while at < size:
        start = html.find("<", at)
        if start < 0:
            yield "text", html[at:], ""
            return
        if start > at:
            yield "text", html[at:start], ""
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), start):
            end = html.find(">", start)
            at = size if end < 0 else end + 1
            continue
        found = TAG.match(html, start) if start < loose_from else None
        if found is None:
            found = LOOSE_TAG.match(html, start)
            if found and start < loose_from and ("'" in found[3] or '"' in found[3]):
                loose_from = start
        if found is None:
            if html[start + 1 : start + 2].isalpha() or html.startswith("</", start):
                return  # a tag that the page ends in
            yield "text", "<", ""
            at = start + 1
            continue
        at = found.end()
        name = found[2].lower()
        if found[1]:
            yield "close", name, ""
            continue
        yield "open", name, found[3]
        if name in RAW and not found[3].rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
            if end is None:
                return
            at = end.start()


def _cue(name: str, attributes: str) -> int:
    """What an element says of its text: 1 for content, -1 against, HIDDEN, 0 nothing."""
    cue = -1 if name in BOILERPLATE else 1 if name in CONTENT else 0
    if not attributes:
        return cue
    for key, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        key = key.lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return HIDDEN
        if name in BOILERPLATE or cue < 0:
            continue
        words = set(value.split())
        if key == "role" and "main" in words or words & FOR:
            cue = 1
        elif key in ("class", "id", "role") and any(AGAINST & {w, *re.split(r"[-_]+", w)} for w in words):
            cue = -1
    return cue


class Part:
    """An element that says something of its text, or a sectioning one."""

    __slots__ = ("name", "cue", "around", "wraps", "section", "weight", "out")

    def __init__(self, name: str, cue: int, around: Part | None):
        self.name, self.cue, self.around, self.wraps = name, cue, around, False
        # The nearest sectioning element, this one or around it.
        self.section = name if name in SECTIONS else around.section if around else ""
        if name == "header" and cue == -1 and around and around.section in ("article", "main", "section"):
            self.cue = 0  # it heads that part, not the page
            self.section = around.section

    def weigh(self) -> None:
        """Set ``weight``, and ``out`` if the text is ruled out."""
        cue = self.cue
        if cue == -1 and self.wraps and (self.name == "form" or self.name not in BOILERPLATE):
            cue = 1 if self.name in CONTENT else 0
        if self.name == "article" and cue == 1 and not self.wraps and self.around and self.around.weight < 1:
            cue = -1  # a comment or a teaser
        weight = self.around.weight if self.around else 1.0
        # Against holds also inside of content; content inside of boilerplate has no weight.
        self.weight = 1 / TRUST if cue < 0 else min(TRUST * weight, TRUST) if cue > 0 else weight
        out = self.around.out if self.around else 0
        if out != HIDDEN and self.name in SECTIONS and not (self.name == "header" and cue == 0):
            out = min(cue, 0)
        self.out = HIDDEN if cue == HIDDEN else out


class Block:
    """Text between two block boundaries."""

    __slots__ = ("path", "part", "heading", "text", "linked")

    def __init__(self, path: str, part: Part | None, heading: bool, text: str, linked: int):
        self.path, self.part, self.heading, self.text, self.linked = path, part, heading, text, linked

    @property
    def weight(self) -> float:
        return self.part.weight if self.part else 1.0

    @property
    def out(self) -> bool:
        return self.part is not None and self.part.out < 0


def blocks(html: str) -> list[Block]:
    """The blocks of a page with text, in page order."""
    out: list[Block] = []
    # Open elements, each with the nearest part.
    stack: list[tuple[str, Part | None]] = []
    made: list[Part] = []
    parts: list[str] = []
    linked = 0

    def end() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            names = [n for n, _ in stack if n in BLOCKS]
            part = stack[-1][1] if stack else None
            out.append(Block("/".join(names), part, bool(names) and names[-1] in HEADINGS, text, linked))
        parts.clear()
        linked = 0

    def close(names: set[str], scope: set[str]) -> None:
        for depth in range(len(stack) - 1, -1, -1):
            name = stack[depth][0]
            if name in names:
                end()
                del stack[depth:]
                return
            if name in scope:
                return

    for kind, name, attributes in _tokens(html):
        if kind == "text":
            if stack and stack[-1][0] in RAW:
                continue
            text = entities.unescape(name)
            parts.append(text)
            if any(n == "a" for n, _ in stack):
                linked += len("".join(text.split()))
        elif kind == "open":
            if name in BLOCKS:
                end()
                if name not in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    close({"p"}, {"table", "td", "th", "button"})
                else:
                    names, scope = CLOSES[name]
                    close(set(names.split()), set(scope.split()))
            elif name == "br":
                parts.append(" ")
            if name not in VOID:
                if not (attributes.rstrip().endswith("/") and name in RAW):
                    part = stack[-1][1] if stack else None
                    cue = 0 if name in PAGE else _cue(name, attributes)
                    around = part
                    if name == "h1" or cue == 1 and name != "article":
                        while around and not around.wraps:
                            around.wraps, around = True, around.around
                    elif name in PAGE_PARTS:
                        while around and around.name != "form":
                            around = around.around
                        if around:
                            around.wraps = True
                    if cue or name in SECTIONS:
                        part = Part(name, cue, part)
                        made.append(part)
                    stack.append((name, part))
        else:
            if name in BLOCKS:
                end()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
    end()
    for part in made:
        part.weigh()
    return out


def _smooth(values: np.ndarray) -> np.ndarray:
    """Each value with its neighbours in page order, by a narrow Gaussian."""
    padded = np.pad(values, 2, mode="edge")
    return np.convolve(padded, KERNEL, "valid")


def content(found: list[Block]) -> list[Block]:
    """The blocks of the main text."""
    # What is ruled out has no part in the ratios either.
    rest = [b for b in found if not b.out]
    if not rest:
        return []
    paths: dict[tuple[str, float], list[Block]] = defaultdict(list)
    for block in rest:
        paths[block.path, block.weight].append(block)
    size = {id(b): max(len(b.text) - LINKED * b.linked, 0) for b in rest}
    text = {p: sum(size[id(b)] for b in bs) / len(bs) for p, bs in paths.items()}
    marks = {p: sum(len(MARKS.findall(b.text)) for b in bs) / len(bs) for p, bs in paths.items()}
    weight = np.array([b.weight for b in rest])
    own = np.array([np.log1p(text[b.path, b.weight]) * np.log1p(1 + marks[b.path, b.weight]) for b in rest])
    fused = np.sqrt(own * _smooth(own))
    # Marks for content weigh in the score, not in the threshold, so that a small marked part does not hide a body beside it.
    # What speaks against itself has no say in the mean, so that it does not grow into content by its length.
    say = (weight >= 1) * np.array([size[id(b)] for b in rest])
    if not say.any():
        return []
    chosen = fused * weight >= THRESHOLD * np.average(fused, weights=say)
    # A heading is content if what follows it up to the next heading is, or if it is marked and scores as content itself.
    follows = False
    for i in range(len(rest) - 1, -1, -1):
        if rest[i].heading:
            chosen[i] = follows or chosen[i] and weight[i] > 1
        follows = bool(chosen[i])
    return [b for b, keep in zip(rest, chosen) if keep]


def main_text(html: str | None) -> str:
    """The main text of a page, a line for each block; empty for a null or empty page."""
    return "\n".join(b.text for b in content(blocks(html or "")))


def extracted(html: Column) -> Column:
    """The main text of a column of pages."""

    @F.arrow_udf("string")
    def column(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return column(html.cast("string"))


def main_texts(df: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (its code points) for each row of ``df`` (page_id, url, html and others).

    A page without main text, a null one too, has an empty text. Whole pages are read. Repeated rows stay.
    """
    rows = df.select("page_id", "url", extracted(F.col("html")).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
