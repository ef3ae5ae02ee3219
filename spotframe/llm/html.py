"""Main text of web pages by line-block distribution.

Markup is stripped into lines, the lengths of lines are summed over sliding windows, and the text between the points
where the sum surges and where it dives is kept.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STEP_BYTES, steps, two_columns

# Lines of one window, and the characters a window must reach for the text to surge.
WINDOW = 3
SURGE = 80

# Elements of HTML by what they do to the text around and inside them.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SIDE = frozenset("head nav header footer aside form menu button select option svg canvas object audio video dialog".split())
MAIN = frozenset("article main".split())
# Side elements that may also wrap a whole page.
WRAPS = frozenset("form header".split())
# Elements whose start ends an open paragraph, list item, cell or option.
CLOSES = {
    "p": BLOCKS - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "tr": frozenset(["tr"]),
    "option": frozenset(["option", "optgroup"]),
    "head": frozenset(["body"]),
}
# Words in a class, id or role that mark an element as beside the article.
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies copyright disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup popups promo promos promoted promotion related respond replies reply reviews rss share sharing sidebar "
    "sidebars signup skyscraper social sponsor sponsored sponsors subscribe subscription tagcloud tags toolbar widget widgets "
    "alert complementary contentinfo search".split()
)
# First words of names whose elements hold no article of the page, even where they hold an article element.
SHUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments commentlist disqus promo promos promoted related replies "
    "reply respond reviews sponsor sponsored sponsors".split()
)
# First words of names whose elements hold no article, however much of a page's text they have.
NEVER_WORDS = SHUT_WORDS | frozenset("consent cookie cookies gdpr modal newsletter notice notices popup popups".split())
# Elements of running text. Inside an article only their whole names count, so a paragraph "share-price" stays.
TEXT = frozenset(
    "a abbr b blockquote cite code dd dt em figcaption h1 h2 h3 h4 h5 h6 i li mark p pre q small span strong sub sup td th u".split()
)
MAIN_WORDS = frozenset(
    "article articlebody content entry hentry main maincontent post postbody postcontent story storybody bodytext".split()
)

# Possessive, and no "<" outside quotes, so that unclosed markup costs no second look.
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*+>"""
    r"""|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>""",
    re.DOTALL,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")


class Line:
    """Text of one block."""

    __slots__ = ("parts", "linked", "side", "main", "wrap", "title", "text")

    def __init__(self, side: bool, main: bool, wrap: int, title: bool = False):
        self.parts: list[str] = []
        self.linked, self.side, self.main, self.wrap, self.title, self.text = 0, side, main, wrap, title, ""

    def length(self) -> int:
        """Characters outside links, white space aside; none if most of the text is links."""
        whole = len(self.text.replace(" ", ""))
        return whole - self.linked if 2 * self.linked < whole else 0


def _words_of(attributes: str) -> set[str]:
    found: set[str] = set()
    for match in NAMES.finditer(attributes):
        value = (match[1] or match[2] or match[3] or "").lower()
        found.update(WORD.findall(value))
        found.update(name.replace("-", "").replace("_", "") for name in value.split())
    return found


def _whole_names(attributes: str) -> set[str]:
    names = " ".join(m[1] or m[2] or m[3] or "" for m in NAMES.finditer(attributes)).lower().split()
    return {name.replace("-", "").replace("_", "") for name in names}


def _first_words(attributes: str) -> set[str]:
    names = " ".join(m[1] or m[2] or m[3] or "" for m in NAMES.finditer(attributes)).lower().split()
    return {found[0] for found in map(WORD.match, names) if found}


def _unwrap(lines: list[Line], parents: list[int], never: list[bool]) -> None:
    """Mark lines inside side elements that may wrap the article.

    On a page without article elements, one with most of the page's text stands beside nothing, unless its name says never.
    """
    held = [0] * len(parents)
    lift = not any(one.main and not one.side and not one.wrap for one in lines)
    if lift:
        inside = [False] * len(parents)
        for k in range(1, len(parents)):
            inside[k] = never[k] or inside[parents[k]]
        for one in lines:
            held[one.wrap] += 0 if one.side or inside[one.wrap] else one.length()
        for k in range(len(parents) - 1, 0, -1):
            held[parents[k]] += held[k]
    beside = [False] * len(parents)
    for k in range(1, len(parents)):
        beside[k] = beside[parents[k]] or never[k] or not (lift and 2 * held[k] > held[0])
    for one in lines:
        one.side |= beside[one.wrap]


def lines_of(page: str) -> list[Line]:
    """The page's blocks in order, with what stands around them."""
    out: list[Line] = []
    # Open elements: name, whether text inside is beside the article, whether it is inside the article, and the innermost
    # side element around it that may wrap the article (0 if none).
    stack: list[tuple[str, bool, bool, int]] = []
    opened: Counter[str] = Counter()
    # Of each such element the next one outside, and the innermost from there that no article element lifts.
    # Whether its name says that it never holds the article.
    parents, shut, never = [0], [0], [False]
    line = Line(False, False, 0)
    links = 0
    at, end = 0, len(page)

    def text(piece: str) -> None:
        piece = html.unescape(piece) if "&" in piece else piece
        line.parts.append(piece)
        if links:
            line.linked += len("".join(piece.split()))

    def state() -> tuple[bool, bool, int]:
        return stack[-1][1:] if stack else (False, False, 0)

    def close(depth: int) -> None:
        opened.subtract(one[0] for one in stack[depth:])
        del stack[depth:]

    def cut() -> Line:
        if line.parts:
            out.append(line)
        return Line(*state(), bool(stack) and stack[-1][0] == "h1")

    while at < end:
        match = TOKEN.search(page, at)
        if match is None:
            text(page[at:])
            break
        if match.start() > at:
            text(page[at : match.start()])
        at = match.end()
        if match[2] is None:
            continue
        name = match[2].lower()
        if match[1]:
            if name == "a":
                links = max(0, links - 1)
            if opened[name] > 0:
                before = state()
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
                if name in BLOCKS or state() != before:
                    line = cut()
            elif name in BLOCKS:
                line = cut()
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else end
            continue
        if name == "br":
            line.parts.append(" ")
            continue
        # An inline element left open does not keep a paragraph from ending.
        while name in BLOCKS:
            block = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in BLOCKS), None)
            if block is None or name not in CLOSES.get(stack[block][0], ()):
                break
            close(block)
        if name == "a":
            links += 1
        if name in VOID or match[3].endswith("/") and name not in BLOCKS:
            if name == "hr":
                line = cut()
            continue
        side, main, wrap = before = state()
        words = _words_of(match[3]) if match[3] else set()
        if name in MAIN or words & MAIN_WORDS and not words & SIDE_WORDS and name in BLOCKS:
            main = True
            # An article inside a form or a "has-sidebar" is still the article.
            wrap = shut[wrap] if name in MAIN else wrap
        elif name != "body" and name != "html":
            # An article may have a header of its own, with its title.
            beside = words & SIDE_WORDS
            if main and beside:
                beside = (_whole_names(match[3]) if name in TEXT else words) & SIDE_WORDS - {"header"}
            side = side or name in SIDE - WRAPS
            if beside or name in WRAPS and not (main and name == "header"):
                parents.append(wrap)
                first = _first_words(match[3]) if match[3] else set()
                shut.append(len(shut) if first & SHUT_WORDS else shut[wrap])
                never.append(bool(first & NEVER_WORDS))
                wrap = len(parents) - 1
        if match[3] and HIDDEN.search(match[3]):
            side = True
        stack.append((name, side, main, wrap))
        opened[name] += 1
        if name in BLOCKS or (side, main, wrap) != before:
            line = cut()
            links = 0 if name in BLOCKS and name != "a" else links
    cut()
    for one in out:
        one.text = " ".join("".join(one.parts).split())
    out = [one for one in out if one.text]
    _unwrap(out, parents, never)
    return out


def _weights(lines: list[Line]) -> np.ndarray:
    """Lengths of the lines for the windows; where elements name the article, they raise those inside and lower the others.

    There a line inside counts whole, links too, and reaches the surge by itself; outside, only a page title before the article counts.
    """
    out = np.array([0 if one.side else one.length() for one in lines], dtype=np.int64)
    if not any(one.main and not one.side for one in lines):
        return out
    leads = False
    for k in range(len(lines) - 1, -1, -1):
        one = lines[k]
        if one.side:
            continue
        if one.main:
            out[k], leads = len(one.text) + SURGE, True
        elif not (leads and one.title):
            out[k], leads, one.side = 0, False, True
    return out


def main_text(page: str) -> str:
    """The article's blocks, one per line."""
    lines = lines_of(page)
    lengths = _weights(lines)
    if not lengths.any():
        return ""
    # A page whose text never surges is short: any text is its main text.
    keep = _between(lengths, min(SURGE, int(lengths.max())))
    return "\n".join(one.text for one, kept in zip(lines, keep, strict=True) if kept and not one.side)


def _between(lengths: np.ndarray, surge: int) -> np.ndarray:
    """Lines from each surge (a window that reaches ``surge``) to the dive (a window without text) after it.

    Lines with text that lead up to a surge, such as a short title, belong to it.
    """
    n = len(lengths)
    padded = np.concatenate([lengths, np.zeros(WINDOW - 1, dtype=np.int64)])
    total = np.convolve(padded, np.ones(WINDOW, dtype=np.int64), mode="valid")
    keep = np.zeros(n, dtype=bool)
    at = 0
    while at < n:
        if total[at] < surge or not lengths[at]:
            at += 1
            continue
        stop = at
        while at and lengths[at - 1] and not keep[at - 1]:
            at -= 1
        while stop < n and total[stop] > 0:
            stop += 1
        keep[at:stop] = True
        at = stop
    return keep


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Main text per page: every column but the markup, then ``text`` (empty if none).

    Text starts where WINDOW lines hold SURGE characters outside links (or as many as the longest line has), with the lines
    that lead up to it, and ends before WINDOW lines hold none. Elements that name the article (article, main, or a class
    that says so) raise the lines inside over the surge and lower the others to nothing, but for a page title before them. Lines beside
    the article (navigation, forms, adverts, notices, comments) count nothing; a form, a header or an element with a class
    like "has-sidebar" around the article, or around most of the text of a page without article elements, does not make its lines such. Character
    references are decoded, white space inside a block becomes one space, blocks are joined by newlines.

    Null markup counts as empty; broken, unclosed or deeply nested markup is read as far as it goes; rows are independent
    of each other, so repeated pages and ids need no rule; an empty table gives no rows. A column called ``text`` is
    replaced.
    """
    rest = [c for c in pages.columns if c not in (html_col, "text")]
    rows = pages.select(F.struct(F.lit(0).alias("_"), *rest).alias("_id"), F.col(html_col).alias("_text"))
    rows = two_columns(rows, "_id", "_text")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, limit=STEP_BYTES):
            found = [main_text(page) for page in pc.fill_null(batch.column("_text"), "").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(found, type=pa.string())], ["_id", "text"])

    found = rows.mapInArrow(work, f"_id {rows.schema['_id'].dataType.simpleString()}, text string")
    return found.select(*[F.col("_id")[c].alias(c) for c in rest], "text")
