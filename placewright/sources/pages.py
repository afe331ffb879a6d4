"""Columns out of HTML: decoding, tables, links, repeated blocks, key-value pairs, selected rows.

Each is an Arrow-batched function from a page to an array, to be exploded; whatever can follow natively does.
"""

from __future__ import annotations

import functools
import json
import re
from collections import defaultdict
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from placewright.sources.dom import Node, parse

_META = re.compile(rb"""<meta[^>]+charset\s*=\s*["']?\s*([\w-]+)""", re.I)
_TYPE = re.compile(rb"""content-type[^>]+charset\s*=\s*["']?\s*([\w-]+)""", re.I)


def vectorised(schema: str):
    """A function of pandas series as a function of columns; made where it is used, so workers can import it."""

    def wrap(f):
        @functools.wraps(f)
        def call(*columns):
            return F.pandas_udf(f, schema)(*columns)

        return call

    return wrap


def squeeze(value) -> str:
    return " ".join(str("" if value is None else value).split())


def cell(value) -> str:
    return "\n".join(filter(None, map(squeeze, str("" if value is None else value).splitlines())))


def decode_page(data: bytes | None, charset: str | None = "") -> str:
    """Bytes by their byte-order mark, the given charset, the declared one, or UTF-8."""
    data = bytes(data or b"")
    if data[:3] == b"\xef\xbb\xbf":
        return data.decode("utf-8-sig", "replace")
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return data.decode("utf-16", "replace")
    found = _META.search(data[:8192]) or _TYPE.search(data[:8192])
    try:
        return data.decode((charset or "").strip() or (found[1].decode() if found else "utf-8"), "replace")
    except LookupError:
        return data.decode("utf-8", "replace")


@vectorised("string")
def decoded(data: pd.Series, charset: pd.Series) -> pd.Series:
    return pd.Series([decode_page(d, c) for d, c in zip(data, charset, strict=True)])


def table_rows(table: Node) -> list[list[str]]:
    """Rows of a table, spans filled in; rows of heads come first, joined to one."""
    own = [n for n in table.walk() if n.tag == "tr" and next((p for p in n.above() if p.tag == "table"), None) is table]
    cells = lambda r: [c for c in r.children if c.tag in ("td", "th")]
    part = lambda r: next((p.tag for p in r.above() if p.tag in ("thead", "tfoot", "table")), "table")
    head = [r for r in own if part(r) == "thead"]
    body = [r for r in own if part(r) == "table"]
    foot = [r for r in own if part(r) == "tfoot"]
    if not head:
        while body and cells(body[0]) and all(c.tag == "th" for c in cells(body[0])):
            head.append(body.pop(0))
    grid: list[list[str]] = []
    open_: dict[int, tuple[str, int]] = {}
    for r in [*head, *body, *foot]:
        line: list[str] = []
        now: dict[int, tuple[str, int]] = {}

        def carry(line=line, now=now):
            while len(line) in open_:
                text, left = open_[len(line)]
                if left > 1:
                    now[len(line)] = text, left - 1
                line.append(text)

        for c in cells(r):
            carry()
            text = cell(c.whole_text())
            number = lambda k, c=c: int(c.get(k)) if c.get(k).isdigit() and int(c.get(k)) else 1
            for _ in range(number("colspan")):
                if number("rowspan") > 1:
                    now[len(line)] = text, number("rowspan") - 1
                line.append(text)
        carry()
        open_ = now
        if line:
            grid.append(line)
    width = max(map(len, grid), default=0)
    grid = [r + [""] * (width - len(r)) for r in grid]
    n = len([r for r in head if cells(r)])
    if n > 1:
        grid = [[" ".join(column) for column in zip(*grid[:n], strict=True)], *grid[n:]]
    return grid


TABLES = "array<struct<table_index:int,row_no:int,cells:array<string>>>"


@vectorised(TABLES)
def html_tables(html: pd.Series) -> pd.Series:
    """All rows of all tables of a page."""
    found = []
    for h in html:
        tables = [table_rows(t) for t in parse(h).walk() if t.tag == "table"]
        found.append([{"table_index": i, "row_no": k, "cells": r} for i, t in enumerate(filter(None, tables), 1) for k, r in enumerate(t, 1)])
    return pd.Series(found)


@vectorised("array<struct<row_no:int,cells:array<string>>>")
def plain_rows(html: pd.Series) -> pd.Series:
    """Rows of a piece of markup as they stand, without filling spans."""
    rows = lambda h: [[squeeze(c.text()) for c in r.walk() if c.tag in ("td", "th")] for r in parse(h).walk() if r.tag == "tr"]
    return pd.Series([[{"row_no": i, "cells": r} for i, r in enumerate(filter(None, rows(h)), 1)] for h in html])


LINKS = "struct<base:string,title:string,links:array<struct<pos:int,title:string,url:string>>>"


def links_of(html: str | None, final_url: str | None, selector: str = "a", strict_base: bool = False) -> dict:
    """Base, title and absolute links of a page; with ``strict_base`` relative links count only against a base element."""
    root = parse(html)
    base = root.find("base")
    base_url = squeeze(base.get("href")) if base else ""
    title = root.find("title")
    links = []
    for i, n in enumerate(root.select(selector)):
        if "href" in n.attrs:
            try:
                url = urljoin(base_url or ("" if strict_base else final_url or ""), squeeze(n.get("href")))
            except ValueError:
                continue
            links.append({"pos": i, "title": squeeze((n.get("title") if strict_base else "") or n.text()), "url": url})
    return {"base": base_url, "title": squeeze(title.whole_text()) if title else "", "links": links}


def html_links(html: Column, final_url: Column, selector: str = "a", strict_base: bool = False) -> Column:
    @F.pandas_udf(LINKS)
    def work(h: pd.Series, u: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([links_of(a, b, selector, strict_base) for a, b in zip(h, u, strict=True)], columns=["base", "title", "links"])

    return work(html, final_url)


BLOCKS = "array<struct<tag:string,classes:array<string>,texts:array<string>,columns:array<array<string>>,labels:array<array<string>>>>"


@vectorised(BLOCKS)
def repeated_blocks(html: pd.Series) -> pd.Series:
    """Groups of three or more elements of one tag and class list with 4 to 300 characters, outside tables.

    ``columns`` has the texts of the children of the first eight, by place; ``labels`` the texts of their list items.
    """
    found = []
    for h in html:
        root = parse(h)
        groups: dict[tuple, list[Node]] = defaultdict(list)
        for n in (root.find("body") or root).walk():
            if n.classes and n.tag not in ("script", "style", "table", "tr", "td", "th") and not any(p.tag == "table" for p in n.above()) and 4 <= len(squeeze(n.text())) <= 300:
                groups[n.tag, tuple(sorted(n.classes))].append(n)
        out = []
        for (tag, classes), nodes in groups.items():
            if len(nodes) >= 3:
                rows = [[squeeze(c.text()) for c in n.children] for n in nodes[:8]]
                width = min(map(len, rows))
                out.append({"tag": tag, "classes": list(classes), "texts": [squeeze(n.text()) for n in nodes], "columns": [[r[i] for r in rows] for i in range(width)], "labels": [[squeeze(c.whole_text()) for c in n.walk() if c.tag == "li"] for n in nodes[:8]]})
        found.append(out)
    return pd.Series(found)


@vectorised("array<struct<label:string,value:string>>")
def key_values(html: pd.Series) -> pd.Series:
    """First and second cell of every table row with two cells or more, in order."""
    found = []
    for h in html:
        rows = [[c for c in r.children if c.tag in ("td", "th")] for r in parse(h).walk() if r.tag == "tr" and any(p.tag == "table" for p in r.above())]
        found.append([{"label": squeeze(r[0].text()), "value": squeeze(r[1].text())} for r in rows if len(r) >= 2])
    return pd.Series(found)


@vectorised("string")
def page_text(html: pd.Series) -> pd.Series:
    """Text of a page, one line for each piece."""
    return pd.Series([parse(h).text("\n") for h in html])


def selected_rows(html: Column, row: str, name: str, address: str, attributes: dict[str, str]) -> Column:
    """array of struct(row_no, place_name, original_address, attributes) of the elements that a selector picks."""

    @F.pandas_udf("array<struct<row_no:int,place_name:string,original_address:string,attributes:map<string,string>>>")
    def work(pages: pd.Series) -> pd.Series:
        def one(n: Node, selector: str) -> str:
            hit = n.select(selector)[:1] if selector else []
            return squeeze(hit[0].text()) if hit else ""

        return pd.Series([[{"row_no": i, "place_name": one(n, name), "original_address": one(n, address), "attributes": {k: one(n, s) for k, s in attributes.items()}} for i, n in enumerate(parse(h).select(row), 1)] for h in pages])

    return work(html)


def object_literals(text: str | None, keys: list[str]) -> list[str]:
    """Parsable objects in a script, outermost first, that hold one of the keys."""
    text, out, at = text or "", [], 0
    while (at := text.find("{", at)) >= 0:
        depth, end = 1, at + 1
        while end < len(text) and depth:
            depth += (text[end] == "{") - (text[end] == "}")
            end += 1
        if depth:
            break
        part = text[at:end]
        try:
            good = isinstance(json.loads(part), dict)
        except ValueError:
            good = False
        if good and (not keys or any(k in part for k in keys)):
            out.append(part)
            at = end
        else:
            at += 1
    return out


def html_objects(text: Column, keys: list[str]) -> Column:
    @F.pandas_udf("array<string>")
    def work(t: pd.Series) -> pd.Series:
        return pd.Series([object_literals(x, keys) for x in t])

    return work(text)


@vectorised("long")
def item_count(html: pd.Series) -> pd.Series:
    """Number of list items of a page."""
    return html.map(lambda h: sum(n.tag == "li" for n in parse(h).walk()))
