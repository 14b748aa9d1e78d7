"""Extract result tables and form options from HTML pages.

``table_rows`` returns the data rows of the first table on each page with
at least one data row and at least ``min_columns`` columns;
``option_pairs`` returns ``(value, text)`` of ``<option>`` elements,
skipping empty or ``0`` values and "select ..." captions.  Parsing is a
``mapInPandas`` over an ``(page_id, html)`` frame with the standard-library
HTML parser: one page at a time, so work is spread by Spark partitions.
``register_functions`` offers both to SQL as table functions.

A table is read as a browser lays it out: end tags of cells, rows, sections and
options may be missing; a cell that spans columns or rows stands in each of
them (spans that aren't numbers count as 1; rows that only hanging cells reach are
added); rows are filled with empty cells up to the table's width, rows without
cells are dropped.  Header rows are those of ``<thead>``, or else the leading
rows of ``<th>`` alone; ``<tfoot>`` rows come last.  Tables are taken in the
order they begin; a nested table is one of its own, and its text is also text
of the cell around it.  ``<br>`` is a blank; ``<script>``, ``<style>`` and
elements styled ``display:none`` aren't read.  A page that breaks off, or holds
a declaration the parser refuses, gives what was read before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf

TABLE_SCHEMA = "page_id bigint, row_idx int, cells array<string>"
OPTION_SCHEMA = "page_id bigint, option_idx int, value string, text string"

# fixed values: the largest spans that the HTML standard allows, and its elements without content
MOST_COLUMNS, MOST_ROWS = 1000, 65534
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))

_SECTIONS = ("thead", "tbody", "tfoot")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)


def _span(value: str | None, most: int) -> int:
    found = re.match(r"\s*(\d+)", value or "")
    return min(max(int(found[1]), 1), most) if found else 1


@dataclass
class _Cell:
    header: bool
    columns: int
    rows: int
    shown: bool
    parts: list[str] = field(default_factory=list)

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


@dataclass
class _Table:
    """An open table: its finished rows by section, the open row and cell."""
    rows: dict[str, list[list[_Cell]]] = field(default_factory=lambda: {s: [] for s in _SECTIONS})
    section: str = "tbody"
    row: list[_Cell] | None = None
    row_shown: bool = True
    cell: _Cell | None = None

    def start_row(self, shown: bool = True) -> None:
        self.end_row()
        self.row, self.row_shown = [], shown

    def start_cell(self, cell: _Cell) -> None:
        self.end_cell()
        if self.row is None:
            self.start_row()
        self.cell = cell

    def end_cell(self) -> None:
        if self.cell is not None and self.cell.shown:
            self.row.append(self.cell)
        self.cell = None

    def end_row(self) -> None:
        self.end_cell()
        if self.row is not None and self.row_shown:
            self.rows[self.section].append(self.row)
        self.row = None

    def start_section(self, name: str) -> None:
        self.end_row()
        self.section = name

    @property
    def hides(self) -> bool:
        return not self.row_shown and self.row is not None or self.cell is not None and not self.cell.shown

    def data(self) -> tuple[list[list[str]], int]:
        """Data rows as texts, and the width of the whole table."""
        head, body, foot = (self.rows[s] for s in _SECTIONS)
        if not head:
            n = next((i for i, cells in enumerate(body) if not all(c.header for c in cells)), len(body))
            head, body = body[:n], body[n:]
        head, body, foot = _grid(head), _grid(body), _grid(foot)
        width = max(map(len, [*head, *body, *foot]), default=0)
        return [line + [""] * (width - len(line)) for line in [*body, *foot]], width


def _grid(rows: list[list[_Cell]]) -> list[list[str]]:
    """Texts by place: every cell stands in all columns and rows it spans."""
    out = []
    hanging: dict[int, tuple[str, int]] = {}        # column: text and rows still to fill

    def lay(cells: list[_Cell]) -> None:
        line: list[str] = []
        later: dict[int, tuple[str, int]] = {}

        def put(text: str, rows: int) -> None:
            if rows > 1:
                later[len(line)] = (text, rows - 1)
            line.append(text)

        for cell in cells:
            while len(line) in hanging:
                put(*hanging[len(line)])
            text = cell.text
            for _ in range(cell.columns):
                put(text, cell.rows)
        for column in sorted(c for c in hanging if c >= len(line)):
            line.extend([""] * (column - len(line)))
            put(*hanging[column])
        hanging.clear()
        hanging.update(later)
        if line:
            out.append(line)

    for cells in rows:
        lay(cells)
    while hanging:
        lay([])
    return out


class _Collector(HTMLParser):
    """Tables in the order they begin, and options with their values."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[_Table] = []
        self.options: list[tuple[str | None, str]] = []
        self._open: list[_Table] = []
        self._skipped: list[str] = []       # the open element that isn't read, and those of its name within it
        self._opt: list[str] | None = None
        self._opt_value: str | None = None

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_starttag(self, tag, attrs):
        if self._skipped:
            if tag == self._skipped[0]:
                self._skipped.append(tag)
            return
        values = dict(attrs)
        shown = not _HIDDEN.search(values.get("style") or "")
        table = self._open[-1] if self._open else None
        if tag in ("script", "style") or not shown and tag not in VOID and tag not in ("tr", "td", "th"):
            self._skipped = [tag]
        elif tag == "table":
            new = _Table()
            if not any(t.hides for t in self._open):
                self.tables.append(new)
            self._open.append(new)
        elif tag in _SECTIONS and table:
            table.start_section(tag)
        elif tag == "tr" and table:
            table.start_row(shown)
        elif tag in ("td", "th") and table:
            table.start_cell(_Cell(tag == "th", _span(values.get("colspan"), MOST_COLUMNS),
                                   _span(values.get("rowspan"), MOST_ROWS), shown))
        elif tag == "br":
            self.handle_data(" ")
        elif tag == "option":
            self._end_option()
            self._opt, self._opt_value = [], values.get("value")
        elif tag == "optgroup":
            self._end_option()

    def handle_endtag(self, tag):
        if self._skipped:
            if tag == self._skipped[0]:
                self._skipped.pop()
            return
        table = self._open[-1] if self._open else None
        if tag in ("option", "optgroup", "select"):
            self._end_option()
        elif table is None:
            return
        elif tag in ("td", "th"):
            table.end_cell()
        elif tag == "tr":
            table.end_row()
        elif tag in _SECTIONS:
            table.start_section("tbody")
        elif tag == "table":
            table.end_row()
            self._open.pop()

    def handle_data(self, data):
        if self._skipped:
            return
        for table in self._open:
            if table.cell is not None:
                table.cell.parts.append(data)
        if self._opt is not None:
            self._opt.append(data)

    def _end_option(self) -> None:
        if self._opt is not None:
            self.options.append((self._opt_value, "".join(self._opt).strip()))
        self._opt = None

    def finish(self) -> None:
        for table in reversed(self._open):
            table.end_row()
        self._open = []
        self._end_option()


def _collected(html: str | None) -> _Collector:
    p = _Collector()
    try:
        p.feed(html or "")
        p.close()
    except AssertionError:      # of the parser, at a marked section it doesn't know
        pass
    p.finish()
    return p


def first_result_table(html: str | None, min_columns: int = 5) -> list[list[str]]:
    for table in _collected(html).tables:
        body, width = table.data()
        if body and width >= min_columns:
            return body
    return []


def form_options(html: str | None) -> list[tuple[str, str]]:
    out = []
    for value, text in _collected(html).options:
        v = (value or "").strip()
        if v and v != "0" and "SELECC" not in text.upper():
            out.append((value, text))
    return out


def table_rows(pages: DataFrame, min_columns: int = 5, id_col: str = "page_id",
               html_col: str = "html") -> DataFrame:
    def parse(batches):
        for pdf in batches:
            out = [(pid, i, cells) for pid, html in zip(pdf[id_col], pdf[html_col])
                   for i, cells in enumerate(first_result_table(html, min_columns))]
            yield pd.DataFrame(out, columns=["page_id", "row_idx", "cells"])
    return pages.select(id_col, html_col).mapInPandas(parse, TABLE_SCHEMA)


def option_pairs(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    def parse(batches):
        for pdf in batches:
            out = [(pid, i, v, t) for pid, html in zip(pdf[id_col], pdf[html_col])
                   for i, (v, t) in enumerate(form_options(html))]
            yield pd.DataFrame(out, columns=["page_id", "option_idx", "value", "text"])
    return pages.select(id_col, html_col).mapInPandas(parse, OPTION_SCHEMA)


class _TableRows:
    def eval(self, html: str, min_columns: int) -> Iterator[tuple[int, list[str]]]:
        yield from enumerate(first_result_table(html, min_columns))


class _OptionPairs:
    def eval(self, html: str) -> Iterator[tuple[int, str, str]]:
        for i, (value, text) in enumerate(form_options(html)):
            yield i, value, text


def register_functions(spark: SparkSession) -> None:
    """SQL table functions ``html_table(html, min_columns)`` and ``html_options(html)``, for LATERAL joins."""
    spark.udtf.register("html_table", udtf(_TableRows, returnType="row_idx int, cells array<string>"))
    spark.udtf.register("html_options", udtf(_OptionPairs, returnType="option_idx int, value string, text string"))
