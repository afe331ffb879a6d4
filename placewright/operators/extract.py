"""Extraction rules: inferring them from tables and running the approved ones.

Inputs are long tables: ``cells`` (file, kind, location, row_no, cells) for tables and ``pages`` (file, html) for
markup.  A rule is a dict with a ``kind``; a plan is a list of sources with files and rules.  Raw records have the
columns RAW in every case.
"""

from __future__ import annotations

import fnmatch
import json
import posixpath
import re
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placewright.functions.text import header_key, label_key, squeeze, text
from placewright.functions.urls import located
from placewright.sources.pages import html_objects, key_values, page_text, selected_rows

TABLE_KINDS = {"table", "sheet", "pdf_table", "vision_table"}
RAW = "place_name string, original_address string, attributes map<string,string>, row array<string>, source_reference string, file string, row_no long"


@dataclass(frozen=True)
class Attribute:
    """A further field that a table or page may have."""

    field: str
    headers: tuple[str, ...] = ()
    label_text: str = ""
    fill_down: bool = False


@dataclass(frozen=True)
class Vocabulary:
    """The words that headers and markup are recognised by."""

    place_headers: tuple[str, ...] = ()
    exact_place_headers: tuple[str, ...] = ()
    address_headers: tuple[str, ...] = ()
    attributes: tuple[Attribute, ...] = ()
    place_marker: str = ""
    address_marker: str = ""
    excluded_label: str = "$^"
    by_field: dict = field(default_factory=dict, compare=False)

    def is_place(self, c: Column) -> Column:
        key = header_key(c)
        return key.isin(*self.exact_place_headers or ("\0",)) | self._any(key, self.place_headers)

    def is_address(self, c: Column) -> Column:
        return self._any(header_key(c), self.address_headers)

    def is_attribute(self, attribute: Attribute, c: Column) -> Column:
        return self._any(header_key(c), attribute.headers)

    @staticmethod
    def _any(key: Column, words: tuple[str, ...]) -> Column:
        return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(key, w)) if words else F.lit(False)


def matching(row: Column, test: Callable[[Column], Column]) -> Column:
    """1-based places of the cells that pass a test."""
    return F.filter(F.transform(row, lambda c, i: F.when(test(c), i + 1)), lambda i: i.isNotNull())


# -- inference ------------------------------------------------------------------------------------------


def infer_table_rules(cells: DataFrame, words: Vocabulary, depth: int = 10) -> DataFrame:
    """One suggested rule per table with a place header in its first rows: header row, columns, columns to fill down."""
    table = ["file", "kind", "location"]
    head = cells.filter(F.col("row_no") <= depth).withColumn("places", matching(F.col("cells"), words.is_place)).filter(F.size("places") > 0)
    head = head.groupBy(*table).agg(F.min(F.struct("row_no", "cells", "places")).alias("h"))
    found = head.select(*table, F.col("h.row_no").alias("header_row"), F.col("h.places").alias("place_name_columns"), F.get(matching(F.col("h.cells"), words.is_address), F.lit(0)).alias("original_address_column"),
                        *[F.get(matching(F.col("h.cells"), lambda c, a=a: words.is_attribute(a, c)), F.lit(0)).alias(f"__{a.field}") for a in words.attributes])
    place = F.get("place_name_columns", F.lit(0))
    value = lambda i: F.coalesce(F.get("cells", i - 1), F.lit(""))
    gap = lambda i, other: F.coalesce(F.max((value(i) == "") & (value(other) != "")), F.lit(False))
    below = found.join(cells.select(*table, "row_no", "cells"), table, "left").withColumn("cells", F.when(F.col("row_no") > F.col("header_row"), F.col("cells")).otherwise(F.array().cast("array<string>")))
    keys = [*table, "header_row", "place_name_columns", "original_address_column", *[f"__{a.field}" for a in words.attributes]]
    fills = below.groupBy(*keys).agg(F.when(F.col("original_address_column").isNotNull() & gap(place, F.col("original_address_column")), place).alias("f0"),
                                     *[F.when(F.lit(a.fill_down) & F.col(f"__{a.field}").isNotNull() & gap(F.col(f"__{a.field}"), place), F.col(f"__{a.field}")).alias(f"f_{a.field}") for a in words.attributes])
    entries = F.array(*[F.struct(F.lit(a.field).alias("field"), F.col(f"__{a.field}").alias("column")) for a in words.attributes]) if words.attributes else F.array().cast("array<struct<field:string,column:int>>")
    fill = F.array_distinct(F.array_compact(F.array("f0", *[f"f_{a.field}" for a in words.attributes])))
    return fills.select(*table, "header_row", (F.col("header_row") + 1).alias("data_start_row"), "place_name_columns", "original_address_column", entries.alias("attribute_fields"), fill.alias("fill_down_columns"))


def infer_key_value_rules(cells: DataFrame, words: Vocabulary) -> DataFrame:
    """One rule per table whose first cells name both a place and an address: the labels, in order."""
    label, value = squeeze(F.get("cells", F.lit(0))), squeeze(F.get("cells", F.lit(1)))
    rows = cells.filter((F.size("cells") >= 2) & (label != "") & (value != "")).withColumn("label", label)
    ordered = lambda test: F.array_distinct(F.transform(F.sort_array(F.collect_list(F.when(test, F.struct("row_no", "label")))), lambda x: x["label"]))
    by = rows.groupBy("file", "kind", "location").agg(ordered(words.is_place(F.col("label"))).alias("place_name_labels"), ordered(words.is_address(F.col("label"))).alias("original_address_labels"),
                                                      *[ordered(words.is_attribute(a, F.col("label"))).alias(f"l_{a.field}") for a in words.attributes])
    entries = F.array(*[F.struct(F.lit(a.field).alias("field"), F.col(f"l_{a.field}").alias("labels")) for a in words.attributes]) if words.attributes else F.array().cast("array<struct<field:string,labels:array<string>>>")
    return by.filter((F.size("place_name_labels") > 0) & (F.size("original_address_labels") > 0)).select("file", "place_name_labels", "original_address_labels", entries.alias("attribute_fields"))


def consolidate_rules(rules: DataFrame) -> DataFrame:
    """Rules that differ in the file only become one with a pattern, if all files share a folder and a suffix."""
    others = [c for c in rules.columns if c != "file"]
    folder = F.regexp_extract("file", "^(.*)/[^/]*$", 1)
    suffix = F.lower(F.regexp_extract("file", r"(\.[^./]+)$", 1))
    by = rules.withColumn("signature", F.to_json(F.struct(*others))).groupBy("signature").agg(*[F.first(c).alias(c) for c in others], F.sort_array(F.collect_list("file")).alias("files"), F.collect_set(folder).alias("folders"), F.collect_set(suffix).alias("suffixes"))
    one = (F.size("files") > 1) & (F.size("folders") == 1) & (F.size("suffixes") == 1)
    pattern = F.concat(F.when(F.get("folders", F.lit(0)) != "", F.concat(F.get("folders", F.lit(0)), F.lit("/"))).otherwise(""), F.lit("*"), F.get("suffixes", F.lit(0)))
    return by.select(F.explode(F.when(one, F.array(F.lit(None).cast("string"))).otherwise(F.col("files"))).alias("file"), F.when(one, pattern).alias("file_pattern"), *others)


def block_groups(pages: DataFrame, limit: int = 15) -> DataFrame:
    """The most frequent repeated blocks of each page (file, html): tag, classes, count, preview."""
    from placewright.sources.pages import repeated_blocks

    rows = pages.select("file", F.posexplode(repeated_blocks("html")).alias("pos", "b")).select("file", "pos", "b.*", F.size("b.texts").alias("n"))
    order = Window.partitionBy("file").orderBy(F.desc("n"), "pos")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit).select("file", "tag", "classes", F.col("n").alias("count"), F.slice("texts", 1, 3).alias("preview"), "columns", "labels", "rank")


def infer_css_rules(blocks: DataFrame, words: Vocabulary) -> DataFrame:
    """Rules for repeated blocks whose columns hold places and addresses in half of the rows or more."""
    hits = lambda pattern: lambda column: F.size(F.filter(column, lambda x: F.rlike(x, F.lit(pattern))))
    place = lambda column: F.size(F.filter(column, lambda x: F.rlike(x, F.lit(words.place_marker)) & ~F.rlike(x, F.lit(words.excluded_label))))
    best = lambda score: F.array_max(F.transform("columns", lambda c, i: F.struct(score(c).alias("score"), (-i).alias("at"))))
    df = blocks.filter(F.size("columns") >= 2).withColumn("p", best(place)).withColumn("a", best(hits(words.address_marker)))
    need = F.greatest(F.floor(F.size("labels") / 2), F.lit(2))
    df = df.filter((F.col("p.at") != F.col("a.at")) & (F.col("p.score") >= need) & (F.col("a.score") >= need))
    nth = lambda c: F.concat(F.lit(":scope > :nth-child("), (1 - F.col(f"{c}.at")).cast("string"), F.lit(")"))
    found = lambda a: F.size(F.filter("labels", lambda ls: F.exists(ls, lambda x: F.contains(x, F.lit(a.label_text))))) >= need
    entries = [F.struct(F.lit(a.field).alias("field"), F.when(F.lit(bool(a.label_text)) & found(a), F.lit(f'li:-soup-contains("{a.label_text}")')).otherwise("").alias("selector")) for a in words.attributes]
    attributes = F.array(*entries) if entries else F.array().cast("array<struct<field:string,selector:string>>")
    return df.select("file", F.concat(F.col("tag"), F.array_join(F.transform("classes", lambda c: F.concat(F.lit("."), c)), "")).alias("row_selector"), nth("p").alias("place_name_selector"), nth("a").alias("original_address_selector"), attributes.alias("attribute_fields"))


def inspection(cells: DataFrame, preview: int = 8) -> DataFrame:
    """(file, kind, location, row_count, column_count, preview_rows) of every table."""
    shown = F.transform(F.sort_array(F.collect_list(F.when(F.col("row_no") <= preview, F.struct("row_no", "cells")))), lambda x: x["cells"])
    return cells.filter("row_no is not null").groupBy("file", "kind", "location").agg(F.count("*").alias("row_count"), F.max(F.size("cells")).alias("column_count"), shown.alias("preview_rows"))


def inspect_sources(items: list[dict], cells: DataFrame, pages: DataFrame, words: Vocabulary, stage: str, city_context=None, decorate: Callable[[dict, list, list], None] | None = None) -> tuple[dict, int]:
    """(plan to be reviewed, 1 if a file failed) for sources with ``local_files`` and ``derived_files``.

    ``cells`` comes from ``sources.files.cells``, ``pages`` has file and html.  A plan holds a few rules and previews for
    each declared file, so it is a document of the driver; the tables themselves stay where they are.
    """
    wanted: list[str] = []
    for i, item in enumerate(items, 1):
        if not isinstance(item, dict) or not isinstance(item.get("local_files"), list) or not item["local_files"]:
            raise ValueError(f"来源 {i} 缺少 local_files 非空列表")
        wanted += [" ".join(str(f).split()) for f in [*item["local_files"], *(item.get("derived_files") or [])]]
    cells, pages = cells.filter(F.col("file").isin(*wanted)), pages.filter(F.col("file").isin(*wanted))
    as_dicts = lambda df: [json.loads(x) for x in df.toJSON().collect()]
    by: dict[str, dict[str, list]] = defaultdict(lambda: defaultdict(list))
    for r in as_dicts(cells.groupBy("file").agg(F.first("status", ignorenulls=True).alias("status"), F.first("error", ignorenulls=True).alias("error"))):
        by[r["file"]]["status"].append(r)
    for r in as_dicts(inspection(cells)):
        by[r.pop("file")]["structures"].append({**r, "location": json.loads(r["location"])})
    is_html = F.rlike("file", F.lit(r"(?i)\.html?$"))
    pairs = as_dicts(infer_key_value_rules(cells.filter(is_html), words))
    for r in pairs:
        by[r["file"]]["rules"].append({**r, "kind": "html_key_value", "approved": False})
    labelled = {r["file"] for r in pairs}
    for r in as_dicts(infer_table_rules(cells.filter("row_no is not null"), words)):
        if r["file"] not in labelled:
            by[r["file"]]["rules"].append({**r, "location": json.loads(r["location"]), "data_end_row": None, "place_name_separator": "", "required_cell_values": [], "exclude_rows": [], "approved": False})
    blocks = block_groups(pages).persist()
    for r in as_dicts(blocks.select("file", "tag", "classes", "count", "preview")):
        by[r.pop("file")]["blocks"].append(r)
    for r in as_dicts(infer_css_rules(blocks, words)):
        by[r["file"]]["rules"].append({**r, "kind": "html_css", "exclude_rows": [], "approved": False})
    blocks.unpersist()
    plans, counts, errors = [], defaultdict(int), 0
    for item in items:
        files, rules = [], []
        for name in [" ".join(str(f).split()) for f in [*item["local_files"], *(item.get("derived_files") or [])]]:
            seen = by.get(name)
            state = (seen["status"] or [{"status": None}])[0] if seen else {"status": "error", "error": f"来源文件不存在：{name}"}
            status = state.get("status") or "error"
            if status == "manual_review" and any(r["kind"] == "html_css" for r in seen["rules"]):
                status = "ready"
            entry = {"file": name, "format": posixpath.splitext(name)[1].lstrip(".").lower(), "inspection_status": status}
            if status == "error":
                errors += 1
                entry["error"] = state.get("error") or ""
            else:
                entry |= {"structures": seen["structures"], "repeated_blocks": seen["blocks"]}
                rules += seen["rules"]
            if name in (item.get("local_file_urls") or {}):
                entry["source_url"] = " ".join(str(item["local_file_urls"][name]).split())
            counts[status] += 1
            files.append(entry)
        rules = merged_rules(rules)
        if decorate:
            decorate(item, files, rules)
        plans.append({**item, "files": files, "extraction_rules": rules, "review_status": "pending"})
    summary = {"source_count": len(plans), "file_count": sum(len(p["files"]) for p in plans), "suggested_rule_count": sum(len(p["extraction_rules"]) for p in plans), "status_counts": dict(sorted(counts.items())), "error_count": errors}
    return {"stage": stage, "city_context": city_context, "items": plans, "inspection_summary": summary}, int(errors > 0)


def merged_rules(rules: list[dict]) -> list[dict]:
    """The rules of one source, its key-value rules consolidated; these come last."""
    others = [r for r in rules if r["kind"] != "html_key_value"]
    pairs = [r for r in rules if r["kind"] == "html_key_value"]
    if len(pairs) < 2:
        return others + pairs
    spark = SparkSession.getActiveSession()
    same = lambda r: json.dumps({k: v for k, v in r.items() if k != "file"}, ensure_ascii=False, sort_keys=True)
    merged = consolidate_rules(spark.createDataFrame([(r["file"], same(r)) for r in pairs], "file string, rule string")).collect()
    place = lambda r: {"file": r["file"]} if r["file"] is not None else {"file_pattern": r["file_pattern"]}
    return others + [{**json.loads(r["rule"]), **place(r)} for r in sorted(merged, key=lambda r: r["file"] or r["file_pattern"])]


# -- running --------------------------------------------------------------------------------------------


def _index(value, name: str) -> int:
    if not isinstance(value, int) or isinstance(value, bool) or value < 1:
        raise ValueError(f"{name} 必须是从 1 开始的整数")
    return value


def _entries(rule: dict) -> dict[str, dict]:
    """Attribute entries by field; the last of a field counts."""
    return {e["field"]: e for e in rule.get("attribute_fields") or [] if isinstance(e, dict) and e.get("field")}


def _map(values: dict[str, Column]) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)]) if values else F.create_map().cast("map<string,string>")


def _location(rule: dict) -> str:
    return json.dumps(rule.get("location") or {}, ensure_ascii=False)


def _chosen(df: DataFrame, rule: dict, url: str) -> DataFrame:
    """The rows that a rule is for, with the address of their source.

    A rule names one file, or comes with rows that have been joined with its files (file, source_url) already.
    """
    if "source_url" not in df.columns:
        df = df.withColumn("source_url", F.lit(url))
    return df.filter(F.col("file") == rule["file"]) if rule.get("file") else df


def attribute_value(cell: Column | None, value) -> Column:
    """An attribute from its cell, or the constant where the rule has no column or the row no cell."""
    constant = squeeze(value if isinstance(value, Column) else F.lit(value))
    return constant if cell is None else F.when(cell.isNotNull(), squeeze(cell)).otherwise(constant)


def table_records(cells: DataFrame, rule: dict, words: Vocabulary, url: str = "") -> DataFrame:
    """Rows of tables as raw records, each table for itself.

    Order matters: row range, excluded rows and required values come first, then blank cells take the last value
    above them among the rows that are left, then rows without a name or that repeat the header go.
    """
    start = _index(rule.get("data_start_row"), "data_start_row")
    names = [_index(i, "place_name_columns") for i in rule.get("place_name_columns") or []]
    if not names:
        raise ValueError("place_name_columns 必须是非空数组")
    fills = [_index(i, "fill_down_columns") for i in rule.get("fill_down_columns") or []]
    skip = [_index(i, "exclude_rows") for i in rule.get("exclude_rows") or []]
    at = lambda i: F.coalesce(F.get("cells", F.lit(i - 1)), F.lit(""))
    df = _chosen(cells, rule, url).filter((F.col("kind") == rule["kind"]) & (F.col("location") == _location(rule)) & (F.col("row_no") >= start))
    if rule.get("data_end_row") is not None:
        df = df.filter(F.col("row_no") <= _index(rule["data_end_row"], "data_end_row"))
    if skip:
        df = df.filter(~F.col("row_no").isin(*skip))
    for need in rule.get("required_cell_values") or []:
        df = df.filter(at(_index(need.get("column"), "required_cell_values.column")) == squeeze(F.lit(need.get("value"))))
    above = Window.partitionBy("file", "kind", "location").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    for i in fills:
        df = df.withColumn(f"__f{i}", F.coalesce(F.last(F.nullif(at(i), F.lit("")), ignorenulls=True).over(above), F.lit("")))
    if fills:
        wide = F.greatest(F.size("cells"), *[F.when(F.col(f"__f{i}") != "", F.lit(i)).otherwise(F.lit(0)) for i in fills])
        cell = F.transform(F.sequence(F.lit(1), F.greatest(wide, F.lit(1))), lambda n: F.coalesce(*[F.when(n == i, F.col(f"__f{i}")) for i in fills], F.get("cells", n - 1), F.lit("")))
        df = df.withColumn("cells", F.when(wide > 0, cell).otherwise(F.col("cells")))
    parts = [at(i) for i in names]
    name = F.array_join(F.filter(F.array(*parts), lambda x: x != ""), rule.get("place_name_separator") or "")
    df = df.withColumn("place_name", squeeze(name))
    for p in parts:
        df = df.filter(~words.is_place(p))
    address = rule.get("original_address_column")
    values = {k: attribute_value(at(_index(e["column"], "attribute_fields.column")) if e.get("column") is not None else None, e.get("value")) for k, e in _entries(rule).items()}
    place = [F.lit(f"{k} {v}") for k, v in (rule.get("location") or {}).items()]
    return df.filter("place_name <> ''").select(
        "place_name", (squeeze(at(_index(address, "original_address_column"))) if address is not None else F.lit("")).alias("original_address"), _map(values).alias("attributes"), F.col("cells").alias("row"),
        located(F.col("source_url"), [squeeze("file"), *place, F.concat(F.lit("row "), F.col("row_no").cast("string"))]).alias("source_reference"), "file", F.col("row_no").cast("long").alias("row_no"),
    )


def _record(df: DataFrame, name: Column, address: Column, attributes: Column, reference: Column, number: Column) -> DataFrame:
    return df.select(name.alias("place_name"), address.alias("original_address"), attributes.alias("attributes"), F.lit(None).cast("array<string>").alias("row"), reference.alias("source_reference"), "file", number.cast("long").alias("row_no")).filter("place_name <> ''")


def _base(file: Column) -> Column:
    return F.regexp_extract(file, "([^/]*)$", 1)


def css_records(pages: DataFrame, rule: dict, words: Vocabulary, url: str = "") -> DataFrame:
    row, name = (rule.get("row_selector") or "").strip(), (rule.get("place_name_selector") or "").strip()
    if not row or not name:
        raise ValueError("html_css 规则缺少行或地点选择器")
    entries = _entries(rule)
    picks = {k: e["selector"] for k, e in entries.items() if (e.get("selector") or "").strip()}
    df = _chosen(pages, rule, url).select("file", "source_url", F.explode(selected_rows(F.col("html"), row, name, (rule.get("original_address_selector") or "").strip(), picks)).alias("r"))
    skip = rule.get("exclude_rows") or []
    if skip:
        df = df.filter(~F.col("r.row_no").isin(*skip))
    values = {k: F.coalesce(F.try_element_at("r.attributes", F.lit(k)), F.lit("")) if k in picks else squeeze(F.lit(e.get("value"))) for k, e in entries.items()}
    reference = located(F.col("source_url"), [_base(F.col("file")), F.lit(row), F.concat(F.lit("row "), F.col("r.row_no").cast("string"))])
    return _record(df.filter(~words.is_place(F.col("r.place_name"))), F.col("r.place_name"), F.col("r.original_address"), _map(values), reference, F.col("r.row_no"))


def key_value_records(pages: DataFrame, rule: dict, words: Vocabulary, url: str = "") -> DataFrame:
    """One record for a page of labels and values; the first value of a label counts."""
    pairs = F.filter(F.transform(key_values("html"), lambda p: F.struct(label_key(p["label"]).alias("k"), squeeze(p["value"]).alias("v"))), lambda p: (p["k"] != "") & (p["v"] != ""))
    df = _chosen(pages, rule, url).select("file", "source_url", pairs.alias("pairs"))

    def read(own, default) -> Column:
        labels = own or list(default)
        named = lambda k: lambda p: p["k"] == label_key(F.lit(k))
        first = [F.get(F.filter("pairs", named(k)), F.lit(0))["v"] for k in labels]
        return F.coalesce(*first, F.lit("")) if first else F.lit("")

    by = {a.field: a for a in words.attributes}
    values = {}
    for k, e in _entries(rule).items():
        got = read(e.get("labels"), by[k].headers if k in by else ())
        values[k] = F.when(got != "", got).otherwise(squeeze(F.lit(e.get("value"))))
    name = read(rule.get("place_name_labels"), (*words.place_headers, *words.exact_place_headers))
    reference = located(F.col("source_url"), [_base(F.col("file")), F.lit("key-value table")])
    return _record(df, F.when(words.is_place(name), "").otherwise(name), read(rule.get("original_address_labels"), words.address_headers), _map(values), reference, F.lit(1))


def numbered_groups(pattern: str) -> tuple[str, dict[str, int]]:
    """A pattern with named groups as (Java pattern in multi-line mode with Unicode classes, number of each name)."""
    found = re.compile(pattern, re.M)
    return "(?mdU)" + re.sub(r"\(\?P<\w+>", "(", re.sub(r"\(\?P=(\w+)\)", lambda m: "\\" + str(found.groupindex[m[1]]), pattern)), dict(found.groupindex)


def regex_records(segments: DataFrame, rule: dict, url: str = "") -> DataFrame:
    """Records of a pattern with the group place_name over text segments (file, text, reference)."""
    pattern, groups = numbered_groups(str(rule.get("pattern") or ""))
    if "place_name" not in groups:
        raise ValueError("text_regex 必须包含 place_name 命名组")
    each = F.arrays_zip(*[F.regexp_extract_all("text", F.lit(pattern), F.lit(i)).alias(k) for k, i in groups.items()])
    df = _chosen(segments, rule, url).select("file", "source_url", "reference", F.posexplode(each).alias("at", "m"))
    values = {k: F.when(squeeze(F.col(f"m.{k}")) != "", squeeze(F.col(f"m.{k}"))).otherwise(squeeze(F.lit(e.get("value")))) if k in groups else squeeze(F.lit(e.get("value"))) for k, e in _entries(rule).items()}
    address = squeeze(F.col("m.original_address")) if "original_address" in groups else F.lit("")
    return _record(df, squeeze(F.col("m.place_name")), address, _map(values), located(F.col("source_url"), [F.col("reference")]), F.col("at") + 1)


def page_segments(pages: DataFrame) -> DataFrame:
    """Pages as text segments for ``regex_records``."""
    return pages.select("file", page_text("html").alias("text"), _base(F.col("file")).alias("reference"))


def object_records(texts: DataFrame, rule: dict, url: str = "") -> DataFrame:
    """Records of the objects in JSON, JSONP or scripts (file, text); the first key with a value counts."""
    keys, kind, body = rule.get("place_name_keys") or [], str(rule.get("object_format") or "json").strip(), F.col("text")
    if not keys:
        raise ValueError("object_list 规则缺少 place_name_keys")
    df = _chosen(texts, rule, url)
    if kind in ("json", "jsonp"):
        if kind == "jsonp":
            call = r"(?s)^\s*[\w.]+\s*\((.*)\)\s*;?\s*$"
            body = F.when(F.rlike(body, F.lit(call)), F.regexp_extract(body, call, 1)).otherwise(body)
        path = "$" + "".join(f"[{json.dumps(str(k), ensure_ascii=False)}]" for k in rule.get("container_keys") or [])
        items = F.try_variant_get(F.parse_json(body), path, "array<variant>")
        get = lambda k: squeeze(F.coalesce(F.try_variant_get("item", f"$[{json.dumps(str(k), ensure_ascii=False)}]", "string"), F.lit("")))
        df = df.select("file", "source_url", F.posexplode(F.coalesce(items, F.array().cast("array<variant>"))).alias("at", "item")).filter(F.schema_of_variant("item").startswith("OBJECT"))
    elif kind == "html_object_literal":
        get = lambda k: squeeze(F.coalesce(F.try_variant_get("item", f"$[{json.dumps(str(k), ensure_ascii=False)}]", "string"), F.lit("")))
        df = df.select("file", "source_url", F.posexplode(html_objects(body, list(map(str, rule.get("marker_keys") or [])))).alias("at", "o")).select("file", "source_url", "at", F.parse_json("o").alias("item"))
    elif kind == "html_js_assignment":
        prefix = str(rule.get("assignment_id_prefix") or "").strip()
        if not prefix:
            raise ValueError("html_js_assignment 规则缺少 assignment_id_prefix")
        pattern = "\\Q" + prefix + '\\E(\\p{Nd}+)\\.(\\w+)="([^"]*)"'
        parts = F.arrays_zip(*[F.regexp_extract_all(body, F.lit(pattern), F.lit(i)).alias(n) for i, n in ((1, "card"), (2, "name"), (3, "value"))])
        rows = df.select("file", "source_url", F.posexplode(parts).alias("pos", "p")).groupBy("file", "source_url", F.col("p.card").cast("long").alias("card"), "p.name").agg(F.max_by("p.value", "pos").alias("value"))
        cards = rows.groupBy("file", "source_url", "card").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("item"))
        df = cards.withColumn("at", F.row_number().over(Window.partitionBy("file").orderBy("card")) - 1)
        get = lambda k: squeeze(F.coalesce(F.try_element_at("item", F.lit(str(k))), F.lit("")))
    else:
        raise ValueError(f"不支持的 object_format：{kind}")
    first = lambda ks: F.coalesce(*[F.nullif(get(k), F.lit("")) for k in ks], F.lit("")) if ks else F.lit("")
    values = {k: first(e["keys"]) if isinstance(e.get("keys"), (list, tuple)) else squeeze(F.lit(e.get("value"))) for k, e in _entries(rule).items()}
    reference = located(F.col("source_url"), [_base(F.col("file")), F.concat(F.lit("row "), (F.col("at") + 1).cast("string"))])
    return _record(df, first(keys), first(rule.get("original_address_keys") or []), _map(values), reference, F.col("at") + 1)


def rule_files(files: list[dict], rule: dict) -> list[tuple[str, str]]:
    """(file, source URL) of the declared files that a rule is for."""
    declared = {" ".join(str(f.get("file") or "").split()): " ".join(str(f.get("source_url") or "").split()) for f in files if isinstance(f, dict) and f.get("file")}
    one, pattern = " ".join(str(rule.get("file") or "").split()), " ".join(str(rule.get("file_pattern") or "").split())
    if bool(one) == bool(pattern):
        raise ValueError("提取规则必须且只能包含 file 或 file_pattern")
    names = [one] if one else [n for n in declared if fnmatch.fnmatch(n.replace("\\", "/"), pattern)]
    if not names:
        raise ValueError(f"file_pattern 没有匹配已登记文件：{pattern}")
    for n in names:
        if n not in declared:
            raise ValueError(f"提取规则引用未登记文件：{n}")
        if posixpath.normpath(n).startswith(("../", "/")) or posixpath.normpath(n) == "..":
            raise ValueError(f"来源文件越出来源目录：{n}")
    return [(n, declared[n]) for n in names]


#: For each kind of rule: which input it reads, and what makes records of it.
READERS: dict[str, tuple[str, Callable]] = {
    **{kind: ("cells", table_records) for kind in TABLE_KINDS},
    "html_css": ("pages", css_records),
    "html_key_value": ("pages", key_value_records),
    "text_regex": ("segments", lambda df, rule, words, url="": regex_records(df, rule, url)),
    "object_list": ("texts", lambda df, rule, words, url="": object_records(df, rule, url)),
}


def run_rule(rule: dict, files: list[dict], source: dict, inputs: dict[str, DataFrame], words: Vocabulary) -> DataFrame:
    """Raw records of one rule.  inputs: cells, pages (file, html), segments (file, text, reference), texts (file, text).

    The rule's files are a table that its input is joined with, so the plan is the same for one file and ten thousand.
    """
    if rule.get("kind") not in READERS:
        raise ValueError(f"不支持的规则类型：{rule.get('kind')}")
    name, read = READERS[rule["kind"]]
    fallback = " ".join(str(source.get("content_url") or source.get("landing_page_url") or "").split())
    chosen = [(f, url or fallback) for f, url in rule_files(files, rule)]
    table = inputs[name].sparkSession.createDataFrame(chosen, "file string, source_url string")
    return read(inputs[name].join(table, "file"), {k: v for k, v in rule.items() if k not in ("file", "file_pattern")}, words)


def run_plan(spark: SparkSession, plan: dict, stage: str, inputs: dict[str, DataFrame], words: Vocabulary, build: Callable[[DataFrame], DataFrame] | None = None, skip: Callable[[Column], Column] | None = None) -> tuple[DataFrame, dict[str, int], list[str]]:
    """(records, metrics, errors) of the approved rules of all reviewed sources; a rule's failure stops that rule only."""
    if plan.get("stage") != stage:
        raise ValueError(f"输入必须是 {stage} JSON")
    if not isinstance(plan.get("items"), list):
        raise ValueError("提取计划必须包含 items 数组")
    errors: list[str] = []
    count: dict[str, int] = defaultdict(int)
    parts: list[DataFrame] = []
    for i, source in enumerate(plan["items"], 1):
        title, files = " ".join(str(source.get("source_title") or "").split()) or f"来源 {i}", source.get("files") or []
        if source.get("review_status") == "skipped":
            if source.get("skip_reason") == "no_vision_capability" and files and all(f.get("inspection_status") == "needs_vision" for f in files):
                count["skipped_source_count"] += 1
            else:
                errors.append(f"{title} 的跳过标记无效")
            continue
        if source.get("review_status") != "ready":
            errors.append(f"{title} 尚未完成提取计划复核")
            continue
        count["reviewed_source_count"] += 1
        rules = [r for r in source.get("extraction_rules") or [] if isinstance(r, dict) and r.get("approved") is True]
        if not rules:
            errors.append(f"{title} 没有已批准的提取规则")
        for k, rule in enumerate(rules, 1):
            count["approved_rule_count"] += 1
            try:
                raw = run_rule(rule, files, source, inputs, words).withColumns({"source_no": F.lit(i), "rule_no": F.lit(k), "source_title": F.lit(title)}).cache()
                count["raw_item_count"] += raw.count()
                kept = raw.filter(~skip(F.col("place_name"))) if skip else raw
                made = build(kept) if build else kept
                n = made.count()
                if not n:
                    raise ValueError(f"规则没有从 {rule.get('file') or '来源文件'} 提取到任何记录")
                count["record_count"] += n
                parts.append(made)
            except Exception as e:  # noqa: BLE001  one rule must not stop the others
                errors.append(f"{title} 规则 {k}：{' '.join(str(e).split())}")
    out = parts[0] if parts else spark.createDataFrame([], RAW + ", source_no int, rule_no int, source_title string")
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    names = ("reviewed_source_count", "skipped_source_count", "approved_rule_count", "raw_item_count", "record_count")
    return out, {"source_count": len(plan["items"]), **{n: count[n] for n in names}, "error_count": len(errors)}, errors



