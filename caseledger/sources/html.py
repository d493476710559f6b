"""Index pages: rows of tables and lists under year headings, parsed by the standard library in an Arrow stage."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A year that heads rows (fixed pattern).
_YEAR = re.compile(r"20\d{2}").fullmatch


class _Index(HTMLParser):
    """Rows as (year, cells, hrefs); a heading or a lone cell that is a year heads what follows."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.year, self.rows, self.cells, self.hrefs, self.text, self.where = "", [], [], [], [], None

    def handle_starttag(self, tag, attrs):
        if tag == "tr" or tag == "li":
            self._end_row()
        elif tag in ("td", "th", "h1", "h2", "h3"):
            self.text, self.where = [], tag
        elif tag == "a" and (href := dict(attrs).get("href")):
            self.hrefs.append(href)

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self.cells.append(" ".join("".join(self.text).replace("\xa0", " ").split()))
            self.where = None
        elif tag in ("h1", "h2", "h3"):
            self._head("".join(self.text))
            self.where = None
        elif tag in ("tr", "table"):
            self._end_row()

    def handle_data(self, data):
        if self.where:
            self.text.append(data)

    def _head(self, text):
        if text.strip().isdigit() and len(text.strip()) == 4:
            self.year = text.strip()

    def _end_row(self):
        if len(self.cells) == 1 and not self.hrefs:
            self._head(self.cells[0])
        if self.cells:
            self.rows.append((self.year, self.cells, self.hrefs))
        self.cells, self.hrefs = [], []


SCHEMA = "ident long, row int, year string, cells array<string>, hrefs array<string>, linked boolean"


def index_rows(pages: DataFrame, ident: str, html: str) -> DataFrame:
    """One row per table row, with its year, cell texts and links; unlinked rows are flagged, not dropped."""

    def run(batches):
        for b in batches:
            out = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                p = _Index()
                p.feed(text or "")
                p.close()
                p._end_row()
                out += [{"ident": i, "row": n, "year": y, "cells": c, "hrefs": h, "linked": bool(h)} for n, (y, c, h) in enumerate(p.rows)]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("ident", pa.int64()), ("row", pa.int32()), ("year", pa.string()), ("cells", pa.list_(pa.string())), ("hrefs", pa.list_(pa.string())), ("linked", pa.bool_())]))

    return pages.select(ident, html).mapInArrow(run, SCHEMA)


class _Reports(HTMLParser):
    """Rows of the tables inside <main>, as (year, cells, hrefs): a heading that is a year heads the tables after it until the
    next heading, and inside a table a lone cell that is a year heads the rows after it. Tables inside cells are rows of the
    table around them as well as their own."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.heading, self.in_heading = 0, "", None
        self.rows: list[tuple[str, list[str], list[str]]] = []
        self.tables: list[str] = []  # the year of each open table
        self.open: list[list] = []  # open rows: finished cells, links, texts of open cells

    def handle_starttag(self, tag, attrs):
        if tag == "main":
            self.inside += 1
        elif tag in ("h2", "h3"):
            self.in_heading = []
        elif not self.inside:
            return
        elif tag == "table":
            self.tables.append(self.heading)
        elif tag == "tr" and self.tables:
            self._end_row(len(self.tables))
            self.open.append([len(self.tables), [], [], None])
        elif tag in ("td", "th") and self.open and self.open[-1][0] == len(self.tables):
            self._end_cell()
            self.open[-1][3] = []
        elif tag == "a" and (href := dict(attrs).get("href")) is not None:
            for row in self.open:
                row[2].append(href)

    def handle_endtag(self, tag):
        if tag == "main":
            self.inside = max(0, self.inside - 1)
        elif tag in ("h2", "h3") and self.in_heading is not None:
            text = "".join(self.in_heading).strip()
            self.heading, self.in_heading = (text if _YEAR(text) else ""), None
        elif tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row(len(self.tables))
        elif tag == "table" and self.tables:
            self._end_row(len(self.tables))
            self.tables.pop()

    def handle_data(self, data):
        if self.in_heading is not None:
            self.in_heading.append(data)
        for row in self.open:
            if row[3] is not None:
                row[3].append(data.strip())

    def _end_cell(self):
        if self.open and self.open[-1][3] is not None:
            self.open[-1][1].append(" ".join(x for x in self.open[-1][3] if x).replace("\xa0", " "))
            self.open[-1][3] = None

    def _end_row(self, depth):
        while self.open and self.open[-1][0] >= depth:
            self._end_cell()
            _, cells, hrefs, _ = self.open.pop()
            if len(cells) == 1 and _YEAR(cells[0]):
                self.tables[-1] = cells[0]
            elif cells:
                self.rows.append((self.tables[-1], cells, hrefs))


def report_rows(pages: DataFrame, ident: str, html: str, header: str = "date occurred") -> DataFrame:
    """(ident, row, year, cells, reports, details) of every table row but headers (by their first cell): its links to reports
    (``.pdf``) and its other links, in order."""
    kinds = pa.schema([("row", pa.int32()), ("year", pa.string()), ("cells", pa.list_(pa.string())), ("reports", pa.list_(pa.string())), ("details", pa.list_(pa.string()))])

    def run(batches):
        for b in batches:
            at, out = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                p = _Reports()
                p.feed(text or "")
                p.close()
                p._end_row(0)
                kept = [r for r in p.rows if r[1][0].strip().lower() != header]
                at += [i] * len(kept)
                out += [{"row": n, "year": y, "cells": c, "reports": [h for h in hs if ".pdf" in h.lower()], "details": [h for h in hs if ".pdf" not in h.lower()]} for n, (y, c, hs) in enumerate(kept)]
            rows = pa.RecordBatch.from_pylist(out, schema=kinds)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *rows.columns], names=[ident, *kinds.names])

    return pages.select(ident, html).mapInArrow(run, f"{ident} {pages.schema[ident].dataType.simpleString()}, row int, year string, cells array<string>, reports array<string>, details array<string>")


def report_links(rows: DataFrame, ident: str, details: DataFrame, url: str, root: str) -> DataFrame:
    """(ident, row, year, place, href, detail): one row per report link; a row without one takes those of its first other
    link's page. details: url, hrefs array<string>; links are joined to ``root``."""
    first = F.get("details", F.lit(0))
    whole = F.when(first.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), first).when(first.startswith("/"), F.concat(F.lit(root.rstrip("/")), first)).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), first))
    d = rows.withColumn("_detail", F.when(F.size("reports") == 0, whole))
    held = details.select(F.col(url).alias("_detail"), F.filter("hrefs", lambda h: F.lower(h).contains(".pdf")).alias("_found"))
    d = d.join(held, "_detail", "left")
    return d.select(ident, "row", "year", F.coalesce("_detail", F.lit("")).alias("detail"), F.posexplode(F.when(F.size("reports") > 0, F.col("reports")).otherwise(F.coalesce("_found", F.array().cast("array<string>")))).alias("place", "href"))


def unlinked_rows(rows: DataFrame, ident: str) -> DataFrame:
    """(ident, row, cells) of rows that list something but link to nothing: reported, not emitted."""
    return rows.filter((F.size("cells") > 1) & (F.size("reports") == 0) & (F.size("details") == 0)).select(ident, "row", "cells")
