"""Visible text of HTML pages, laid out as a browser would.

A small tree builder keeps the stack of open elements and inserts the end tags that HTML lets authors leave
out. What opens and closes drives a layout: blocks start lines, paragraphs and the like are set apart by a
blank line, list items get markers and indents, table cells are padded to columns, over as many columns and
rows as they span. Elements that a browser does not show are skipped whole. Classes and rules of style
sheets are not looked at. The work grows with the length of a page, however deep its elements lie; only text
in tables within tables is laid out once per table.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_columns

# a quote counts only where a value starts; any other is part of a name or value, and so is one that never closes
_NAME_VALUE = r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>"'][^\s>]*+)?+)?+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)(?=[^>]*+>)((?:[\s/]++|"
    + re.sub(r"\((?=\[|\")", "(?:", _NAME_VALUE) + ")*+)>", re.S
)
_ATTRIBUTE = re.compile(_NAME_VALUE)
_SPACES = re.compile(r"[ \t\n\r\f]+")
_NO_BOX = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)
_INTEGER = re.compile(r"\s*([+-]?\d{1,9})")
# fixed values: element classes of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset(
    "script style title head template noscript iframe noembed noframes object audio video canvas svg math datalist".split()
)
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure form hr menu".split())
LINE = frozenset(
    "address article aside body caption center dd details dialog dir div dt fieldset figcaption footer header html"
    " legend li main nav option optgroup search section select summary tr".split()
)
ENDS_P = (APART | LINE) - frozenset("tr body html option optgroup select caption".split())
# an element that starts ends these, as far up as the limits
IMPLIED = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"),
    "option": ("option", "select"), "optgroup": ("option optgroup", "select"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tr": ("tr td th caption", "table"),
    "tbody": ("tbody thead tfoot tr td th caption", "table"), "thead": ("tbody thead tfoot tr td th caption", "table"),
    "tfoot": ("tbody thead tfoot tr td th caption", "table"),
}
IMPLIED = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in IMPLIED.items()}
CELLS = frozenset(("td", "th"))
TABLE_PARTS = frozenset("table tr tbody thead tfoot".split())
P_LIMITS = frozenset("td th table button caption".split())
MOST_COLUMNS, MOST_ROWS = 1000, 65534  # widest and longest span of a cell
WIDEST = 60  # cells up to that many characters are padded
DEEPEST = 64  # an indent grows up to that many characters


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), value.strip("\"'"))
    return found


def _integer(text: str | None, default: int) -> int:
    found = _INTEGER.match(text) if text else None
    return int(found.group(1)) if found else default


class _Flow:
    """Lines of one block of text."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.indent = self.marker = ""
        self.wanted = False  # a blank line before what comes next

    def text(self, text: str) -> None:
        self.inline.append(text)

    def end_line(self, keep: bool = False) -> None:
        line = "".join(self.inline)
        self.inline.clear()
        if not keep:
            line = _SPACES.sub(" ", line).strip(" ")
        line = line.replace("\xa0", " ").rstrip()
        if line:
            if self.wanted and self.lines:
                self.lines.append("")
            self.wanted = False
            head = self.marker or self.indent
            self.marker = ""
            for part in line.split("\n"):
                self.lines.append((head + part).rstrip())
                head = self.indent

    def apart(self) -> None:
        self.end_line()
        self.wanted = True


class _Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []  # lines of a cell, columns and rows it spans

    def grid(self) -> list[list[tuple[int, int, list[str]]]]:
        """Per row the cells as (first column, column after the last, lines); a cell takes the first free place."""
        held: list[tuple[int, int, int]] = []  # columns that cells of earlier rows hold, and up to which row
        out = []
        for r, row in enumerate(self.rows):
            held = sorted(h for h in held if h[2] > r)
            column, k, placed, more = 0, 0, [], []
            for lines, wide, high in row:
                while k < len(held) and held[k][0] <= column:
                    column = max(column, held[k][1])
                    k += 1
                placed.append((column, column + wide, lines))
                if high > 1:
                    more.append((column, column + wide, r + high))
                column += wide
            held += more
            out.append(placed)
        return out

    def lines(self) -> list[str]:
        grid = self.grid()
        starts = sorted({c for row in grid for c, _, _ in row})  # columns in which no cell starts take no space
        widths = [0] * len(starts)
        spans = []
        for row in grid:
            for start, stop, cell in row:
                i, j = bisect_left(starts, start), bisect_left(starts, stop)
                width = max((len(x) for x in cell if len(x) <= WIDEST), default=0)
                if j == i + 1:
                    widths[i] = max(widths[i], width)
                elif width:
                    spans.append((i, j, width))
        for i, j, width in spans:
            widths[j - 1] += max(0, width - sum(widths[i:j]) - 2 * (j - i - 1))
        offsets = [0]
        for width in widths:
            offsets.append(offsets[-1] + width + 2)
        out = []
        for row in grid:
            places = [(offsets[bisect_left(starts, a)], offsets[bisect_left(starts, b)] - 2, cell) for a, b, cell in row]
            for k in range(max((len(cell) for _, _, cell in row), default=0)):
                line, pushed = "", 0
                for start, stop, cell in places:
                    if k < len(cell):
                        line = line.ljust(start + pushed) + cell[k]
                        pushed += max(0, len(cell[k]) - (stop - start))
                out.append(line.rstrip())
        return [x for x in out if x]


class _Layout:
    def __init__(self) -> None:
        self.open: list[tuple[str, int, bool]] = []  # elements, what each adds to ``unseen``, visibility around it
        self.places: dict[str, list[int]] = defaultdict(list)  # where the open elements of a name lie
        self.unseen = self.pre = 0
        self.visible = True
        self.flows = [_Flow()]
        self.tables: list[_Table] = []
        self.spans: list[tuple[int, int]] = []  # of the open cells
        self.lists: list[list] = []  # [next number or None, indent around the list]
        self.indents: list[str] = []  # around the open items and quotes

    # elements

    def start(self, tag: str, attributes: str) -> None:
        if tag in ENDS_P:
            at = self.last("p")
            if at > self.last(*P_LIMITS):
                self.pop_to(at)
        if tag in IMPLIED:
            self.imply(*IMPLIED[tag])
        if tag in CELLS and self.tables and self.last("tr") <= self.last("table"):
            self.start("tr", "")
        found = _attributes(attributes) if attributes else {}
        hides = int(self.hidden(tag, found))
        if tag in VOID:
            if not self.unseen and not hides and self.visible:
                self.void(tag)
            return
        if tag == "summary" and self.open and self.open[-1][:2] == ("details", 1):
            hides = -1 if not hides else 0  # what a closed element still shows
        if tag == "details" and hides and not self.unseen:
            self.flows[-1].end_line()
        self.places[tag].append(len(self.open))
        self.open.append((tag, hides, self.visible))
        self.unseen += hides
        style = _VISIBILITY.findall(found["style"]) if "style" in found else None
        if style:
            self.visible = style[-1].lower() == "visible"
        if not self.unseen:
            self.enter(tag, found)

    def last(self, *tags: str) -> int:
        """Where the innermost open element of these names lies; -1 without one."""
        places = self.places
        return max(places[t][-1] if places.get(t) else -1 for t in tags)

    def hidden(self, tag: str, found: dict[str, str]) -> bool:
        closed = tag in ("dialog", "details") and "open" not in found
        return tag in UNSEEN or closed or "hidden" in found or "style" in found and bool(_NO_BOX.search(found["style"]))

    def imply(self, tags, limits) -> None:
        """End the open elements down to the lowest of ``tags`` above any of ``limits``."""
        limit, lowest = self.last(*limits), len(self.open)
        for tag in tags:
            places = self.places.get(tag)
            if places and places[-1] > limit:
                lowest = min(lowest, places[bisect_right(places, limit)])
        self.pop_to(lowest)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
            return
        at = self.last(tag)
        if at >= 0 and at >= (self.last("table") if tag in TABLE_PARTS else self.last("table", "td", "th")):
            self.pop_to(at)

    def pop_to(self, size: int) -> None:
        while len(self.open) > size:
            self.pop()

    def pop(self) -> None:
        tag, hides, visible = self.open.pop()
        self.places[tag].pop()
        if not self.unseen:
            self.leave(tag)
        self.unseen -= hides
        self.visible = visible

    # layout

    def void(self, tag: str) -> None:
        flow = self.flows[-1]
        if tag == "br":
            flow.end_line(bool(self.pre))
        elif tag == "hr":
            flow.apart()

    def enter(self, tag: str, found: dict[str, str]) -> None:
        flow = self.flows[-1]
        if tag == "table":
            flow.apart()
            self.tables.append(_Table())
        elif tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif tag in CELLS and self.tables:
            self.flows.append(_Flow())
            wide, high = _integer(found.get("colspan"), 1), _integer(found.get("rowspan"), 1)
            high = MOST_ROWS if high == 0 else high  # down to the end of the table
            self.spans.append((wide if 0 < wide <= MOST_COLUMNS else 1, min(high, MOST_ROWS) if high > 0 else 1))
        elif tag in ("ul", "ol", "menu"):
            flow.end_line() if self.lists else flow.apart()
            self.lists.append([_integer(found.get("start"), 1) if tag == "ol" else None, flow.indent])
        elif tag == "li":
            flow.end_line()
            number, around = self.lists[-1] if self.lists else (None, flow.indent)
            if number is not None:
                number = _integer(found.get("value"), number)
                self.lists[-1][0] = number + 1
            self.indents.append(flow.indent)
            flow.marker = around + ("- " if number is None else f"{number}. ")
            flow.indent = " " * min(len(flow.marker), DEEPEST)
        elif tag in APART:
            flow.apart()
            if tag == "blockquote":
                self.indents.append(flow.indent)
                flow.indent = (flow.indent + "  ")[:DEEPEST]
        elif tag in LINE:
            flow.end_line()
        self.pre += tag == "pre"

    def leave(self, tag: str) -> None:
        flow = self.flows[-1]
        self.pre -= tag == "pre"
        if tag in CELLS and self.tables and len(self.flows) > 1:
            flow.end_line()
            self.flows.pop()
            rows = self.tables[-1].rows
            (rows or [rows.append([])] and rows)[-1].append((flow.lines, *self.spans.pop()))
        elif tag == "table" and self.tables:
            lines = self.tables.pop().lines()
            flow.apart()
            for line in lines:
                flow.text(line.lstrip(" ") if not flow.lines else line)
                flow.end_line(True)
            flow.apart()
        elif tag in ("ul", "ol", "menu") and self.lists:
            flow.end_line()
            flow.indent = self.lists.pop()[1]
            flow.marker = ""
            if not self.lists:
                flow.apart()
        elif tag == "li":
            flow.end_line()
            flow.marker = ""
            around = self.indents.pop()
            flow.indent = self.lists[-1][1] if self.lists else around
        elif tag in APART:
            flow.end_line(tag == "pre")
            flow.apart()
            if tag == "blockquote":
                flow.indent = self.indents.pop()
        elif tag in LINE:
            flow.end_line()

    def write(self, text: str) -> None:
        if self.unseen or not self.visible:
            return
        text = unescape(text) if "&" in text else text
        self.flows[-1].text(text if self.pre else text.replace("\n", " "))

    def finish(self) -> str:
        self.pop_to(0)
        self.flows[0].end_line()
        return "\n".join(self.flows[0].lines)


def visible_text(html: str | None) -> str | None:
    """The page's visible text, in reading order; NULL for NULL, empty for a page that shows none."""
    if html is None:
        return None
    layout, at = _Layout(), 0
    stop = html.rfind(">") + 1  # no tag ends behind it
    while True:
        token = _TOKEN.search(html, at, stop)
        if token is None:
            rest = re.compile("<[!?]").search(html, max(at, stop))  # a comment that the page does not end
            layout.write(html[at : rest.start() if rest else len(html)])
            return layout.finish()
        if token.start() > at:
            layout.write(html[at : token.start()])
        at = token.end()
        if html.startswith("<!--", token.start()) and not token.group().endswith("-->"):
            at = len(html)
        if token.group(2):
            tag = token.group(2).lower()
            if token.group(1):
                layout.end(tag)
            else:
                layout.start(tag, token.group(3).rstrip("/"))
                if tag in RAW:
                    ends = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                    raw = html[at : ends.start() if ends else len(html)]
                    if tag in ("textarea", "xmp"):
                        layout.write(raw)
                    at += len(raw)


def render(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` with ``visible_text``; an existing column of that name is replaced.

    Every page is rendered alone and whole, so ties and repeated rows need no rule. Broken markup never
    fails: a ``<`` that starts no tag is text, unknown elements are inline, open elements end with the page.
    """

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in parts:
            yield pd.Series([visible_text(x) for x in html], dtype=object)

    return keep_columns(pages, {"visible_text": run(F.col(f"`{html_column}`"))})
