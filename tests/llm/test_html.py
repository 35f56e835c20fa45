"""Pages against brute force: cells against a grid of places, the element stack against a plain scan."""

from __future__ import annotations

import random
import time

import pytest

from orderloom.llm import html_text
from orderloom.llm.html_text import visible_text


def places(rows):
    """Start column of every cell, place by place."""
    taken, out = set(), []
    for r, row in enumerate(rows):
        column, found = 0, []
        for _, wide, high in row:
            while (r, column) in taken:
                column += 1
            found.append(column)
            taken |= {(r + i, column + j) for i in range(high) for j in range(wide)}
            column += wide
        out.append(found)
    return out


def test_cells_stand_in_their_columns():
    rng = random.Random(3)
    for _ in range(300):
        table = html_text._Table()
        # spans to the right never meet a cell from above, where browsers let both overlap
        table.rows = [[([f"c{r}{i}"], rng.choice((1, 1, 2, 3)) if r == 0 else 1, rng.choice((1, 1, 2, 4)))
                       for i in range(rng.randint(0, 5))] for r in range(rng.randint(1, 7))]
        assert [[c for c, _, _ in row] for row in table.grid()] == places(table.rows)
        # a cell's text starts at one position for all cells of a column
        at = {}
        for row, line in zip([g for g in table.grid() if g], table.lines()):
            for column, _, (text,) in row:
                assert at.setdefault(column, line.index(text)) == line.index(text)


@pytest.mark.parametrize("html, text", [
    ("<table><tr><td colspan=2>Head here</td><td>C</td></tr><tr><td rowspan=2>a</td><td>b</td><td>c</td></tr>"
     "<tr><td>d<td>e</table>", "Head here  C\na  b       c\n   d       e"),
    ("<table><tr><td colspan=x>a<td rowspan=-1>b<tr><td colspan=5000>c<td>d</table>", "a  b\nc  d"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"),
    ("<ol start=3><li>x<li>y<li value=9>z<li>u</ol>", "3. x\n4. y\n9. z\n10. u"),
    ("<ol start=-1><li>x<li>y</ol>", "-1. x\n0. y"),
    ("a<details><summary>S</summary>hidden<p>too</details>b<details open>seen</details>", "a\nS\nb\nseen"),
    ("<div hidden><details><summary>S</summary>x</details></div>y", "y"),
    ("<div style='visibility:hidden'>h<b style='visibility: visible'>v</b>h</div>w", "v\nw"),
    ("<div style='display:none'>h<b style='visibility:visible'>h</b></div>w", "w"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("a <!-- b > c", "a"), ("a > b <x", "a > b <x"), ("a <!x", "a"), ("a<!-- > -->b", "ab"),
    ("<blockquote>a<blockquote>b</blockquote>c</blockquote>d", "  a\n\n    b\n\n  c\n\nd"),
])
def test_pages(html, text):
    assert visible_text(html) == text


@pytest.mark.parametrize("part", ["<div>x", "<p>x", "<ul><li>x", "<b>", "<td>x", "<table>", "</p>", "<blockquote>", "<a ", "<!"])
def test_deep_pages_take_linear_time(part):
    start = time.process_time()
    visible_text("a > b " + part * 200_000)
    assert time.process_time() - start < 20


class _Scanning(html_text._Layout):
    """The same builder with the stack searched element by element."""

    def last(self, *tags):
        return max((i for i, e in enumerate(self.open) if e[0] in tags), default=-1)

    def imply(self, tags, limits):
        at = None
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in tags:
                at = i
            elif self.open[i][0] in limits:
                break
        self.pop_to(len(self.open) if at is None else at)

    def end(self, tag):
        if tag == "br":
            return self.start("br", "")
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name == tag:
                return self.pop_to(i)
            if name == "table" or name in html_text.CELLS and tag not in html_text.TABLE_PARTS:
                return None


def test_random_markup_equals_a_plain_scan(monkeypatch):
    rng = random.Random(4)
    tags = "p div ul ol li dl dt dd table tr td th tbody b blockquote pre details summary option select br caption".split()
    pages = ["".join(rng.choice((f"<{t}>", f"</{t}>", f"w{i} ")) for i, t in enumerate(rng.choices(tags, k=60))) for _ in range(1500)]
    got = [visible_text(p) for p in pages]
    monkeypatch.setattr(html_text, "_Layout", _Scanning)
    assert got == [visible_text(p) for p in pages]
