"""Captured web responses: envelopes, page sequences and HTML tables."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.functions import maps
from samplecraft.functions import variants as V
from samplecraft.functions.rows import each

# ---------------------------------------------------------------- responses


def response_payloads(
    df: DataFrame,
    status: str = "status",
    headers: str | None = None,
    body: str = "body",
    payload: str = "payload",
) -> DataFrame:
    """Response -> payloads: an object is one, an array one per object or string (as ``output``).

    Adds ``api.StatusCode`` and, with a ``headers`` map column, ``api.header.<K>``; body keys override.
    """
    rest = [c for c in df.columns if c not in (body, status, headers)]
    v = F.try_parse_json(body)
    envelope = F.create_map(F.lit("api.StatusCode"), F.col(status).cast("int").cast("variant"))
    if headers:
        named = F.transform_keys(headers, lambda k, _: F.concat(F.lit("api.header."), k))
        envelope = F.map_concat(envelope, F.transform_values(named, lambda _, h: h.cast("variant")))
    df = df.select(*rest, v.alias("_v"), envelope.alias("_env"))
    is_text = lambda x: F.schema_of_variant(x) == "STRING"
    element = lambda x: F.coalesce(
        V.as_object(x), F.when(is_text(x), F.create_map(F.lit("output"), x))
    )
    whole = F.col("_v")
    listed = F.filter(F.transform(V.as_array(whole), element), lambda m: m.isNotNull())
    fields = F.coalesce(listed, F.when(V.is_object(whole), F.array(V.as_object(whole))))
    rows = each(df, [*rest, "_env"], fields, "_fields", pos="element_ix")
    return rows.select(*rest, "element_ix", V.rebuild(F.map_concat("_env", "_fields")).alias(payload))


def _by_key(body: Column, key: str, value: str) -> Column:
    """Value behind ``"key":`` anywhere in a body."""
    pattern = '"' + _escape(key) + r'"\s*:\s*' + value
    return F.nullif(F.regexp_extract(body, pattern, 1), F.lit(""))


def _escape(key: str) -> str:
    return "\\Q" + key + "\\E"


def page_number_key(body: Column, key: str) -> Column:
    """A whole number, plain or quoted."""
    return _by_key(body, key, r'"?(\d+)"?').try_cast("bigint")


def page_text_key(body: Column, key: str, host: str = "") -> Column:
    """A quoted text, e.g. a next link, optionally behind a host."""
    found = _by_key(body, key, r'"(.*?)"')
    return F.concat(F.lit(host), found) if host else found


def next_link(link_header: Column) -> Column:
    """Target of ``rel="next"`` in a ``Link`` header."""
    return F.nullif(F.regexp_extract(link_header, r'<([^>]*)>\s*;[^,]*rel="?next"?', 1), F.lit(""))


def select_pages(
    df: DataFrame,
    request: str = "request_id",
    page: str = "page_no",
    status: str = "status",
    payload_key: str | None = None,
    max_pages: int = 0,
    max_pages_key: str | None = None,
    increment: int = 1,
    body: str = "body",
) -> DataFrame:
    """Pages of each request, in order, up to the stop.

    A page outside 2xx ends the sequence without being kept; a page whose ``payload_key`` is an empty list
    or object ends it and is kept, as is the last of ``max_pages`` (or of the number under
    ``max_pages_key``); page numbers grow by ``increment``. The stop is a minimum per request, so no request is ever sorted in one task.
    """
    text, number = F.col(body), F.col(page)
    failed = ~F.coalesce(F.col(status).between(200, 299), F.lit(False))  # no status is no success
    stop_before = F.min(F.when(failed, number))
    aggs = [stop_before.alias("_before"), F.min(number).alias("_first")]
    if payload_key:
        empty = text.rlike('"' + _escape(payload_key) + r'"\s*:\s*(\[\s*\]|\{\s*\})')
        aggs.append(F.min(F.when(empty, number)).alias("_empty"))
    if max_pages_key:
        aggs.append(F.min_by(page_number_key(text, max_pages_key), number).alias("_max"))
    stops = df.groupBy(request).agg(*aggs)
    limit = F.col("_max") if max_pages_key else F.lit(max_pages or None).cast("bigint")
    last = F.least(
        F.col("_before") - 1,
        F.col("_empty") if payload_key else F.lit(None).cast("bigint"),
        F.col("_first") + (limit - 1) * increment,
    )
    stops = stops.select(F.col(request).alias("_request"), last.alias("_last"))
    joined = df.join(stops, F.col(request).eqNullSafe(F.col("_request")))
    return joined.filter(F.col("_last").isNull() | (number <= F.col("_last"))).drop("_request", "_last")


# ---------------------------------------------------------------- HTML tables


# Comments, elements whose content is no markup, tags with their attributes, declarations. Nothing in it backtracks.
_TOKEN = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)|<(script|style)\b[^>]*+>((?s:.*?))(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*+>""",
    re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class _Tables:
    """Collects tables: header cells, rows of data cells, attributes."""

    def __init__(self) -> None:
        self.tables: list[dict] = []
        self.open: list[list] = []  # open cells: [kind, text, holds a table, table, row]

    def feed(self, html: str) -> None:
        at = 0
        for m in _TOKEN.finditer(html):
            if self.open and m.start() > at:
                self.handle_data(unescape(html[at : m.start()]))
            at = m.end()
            raw, shut, name, attributes = m.group(2, 3, 4, 5)
            if name:
                tag = name.lower()
                if tag in ("table", "tr", "td", "th"):
                    self.handle_endtag(tag) if shut else self.handle_starttag(tag, attributes)
            elif raw and self.open:
                self.handle_data(raw)
        if self.open:
            self.handle_data(unescape(html[at:]))
        self._close(0)

    def handle_starttag(self, tag: str, attributes: str) -> None:
        if tag == "table":
            for cell in self.open:
                cell[2] = True
            attrs = {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes else {}
            self.tables.append({"attrs": attrs, "head": [], "rows": [], "depth": len(self.open)})
        if not self.tables:
            return
        here = self.tables[-1]
        if tag in ("tr", "td", "th"):
            self._close(here["depth"])
        if tag == "tr":
            here["rows"].append([])
        if tag in ("td", "th"):
            if tag == "td" and not here["rows"]:
                here["rows"].append([])
            row = here["rows"][-1] if tag == "td" else here["head"]
            row.append("")
            self.open.append([tag, "", False, row, len(row) - 1])

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.open:
            self._close(len(self.open) - 1)
        elif tag in ("tr", "table") and self.tables:
            self._close(self.tables[-1]["depth"])

    def handle_data(self, data: str) -> None:
        for cell in self.open:
            cell[1] += data

    def _close(self, depth: int) -> None:
        while len(self.open) > depth:
            kind, text, nested, row, at = self.open.pop()
            row[at] = "TableElement" if nested and kind == "td" else _clean(text)


class _Blanks(dict):
    """Translation of whitespace and punctuation to blanks, filled as characters occur."""

    def __missing__(self, code: int) -> int:
        c = chr(code)
        self[code] = 0x20 if c.isspace() or unicodedata.category(c)[0] == "P" else code
        return self[code]


_BLANKS = _Blanks()


def _clean(text: str) -> str:
    """Whitespace and punctuation become blanks."""
    return text.translate(_BLANKS).strip()


def _table_rows(html: str) -> Iterator[tuple[int, int, dict[str, str]]]:
    """(table index, row index, attributes) of every data row of a page."""
    parser = _Tables()
    parser.feed(html)
    for table_ix, table in enumerate(parser.tables):
        rows = [r for r in table["rows"] if r]
        width = max([len(table["head"])] + [len(r) for r in rows])
        head = table["head"] + [f"Col {i + 1}" for i in range(len(table["head"]), width)]
        head = [h or f"Col {i}" for i, h in enumerate(head)]
        shared = {**table["attrs"], "Index": str(table_ix)}
        for row_ix, row in enumerate(rows):
            yield table_ix, row_ix, {**dict(zip(head, row + [""] * (width - len(row)), strict=True)), **shared}


_ROWS_OUT = 10_000


def html_table_samples(df: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Every row of every table of a page: ``<page_id>, table_ix, row_ix, event_type, attrs``.

    Headers name the cells (``Col N`` where missing), short rows are padded, a cell that holds a table reads
    ``TableElement``; table attributes and ``Index`` are added. Pages without a table never reach Python.
    """
    pages = df.select(page_id, html).filter(F.col(html).rlike("(?i)<table"))
    id_type = dict(pages.dtypes)[page_id]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for k, text in enumerate(batch.column(1)):
                for row in _table_rows(text.as_py()):
                    at.append(k)
                    found.append(row)
                if len(found) >= _ROWS_OUT or k == batch.num_rows - 1:
                    tables, rows, cells = zip(*found, strict=True) if found else ((), (), ())
                    columns = [pa.array(tables, pa.int32()), pa.array(rows, pa.int32()), pa.array([list(c.items()) for c in cells], pa.map_(pa.string(), pa.string()))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names=[page_id, "table_ix", "row_ix", "cells"])
                    at, found = [], []

    schema = f"`{page_id}` {id_type}, table_ix int, row_ix int, cells map<string,string>"
    rows = pages.mapInArrow(extract, schema)
    return rows.select(
        page_id, "table_ix", "row_ix", F.lit("tableSamples").alias("event_type"), maps.drop_nulls(F.col("cells")).alias("attrs")
    )
