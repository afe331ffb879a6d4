"""Source files as rows of cells: (file, kind, location, row_no, cells), whatever the format.

Files come as ``binaryFile`` rows (path, content), so any store that Spark reads will do.  Locations are JSON objects.
"""

from __future__ import annotations

import csv
import io
import json
import posixpath
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placewright.functions.text import squeeze
from placewright.sources.dom import parse
from placewright.sources.pages import cell, decode_page, table_rows

# Formats by suffix, limits of archives.
FORMATS = {".doc": "word", ".docx": "word", ".htm": "html", ".html": "html", ".jpeg": "image", ".jpg": "image", ".pdf": "pdf", ".png": "image", ".webp": "image", ".xls": "spreadsheet", ".xlsx": "spreadsheet", ".xlsm": "spreadsheet", ".csv": "spreadsheet"}
MOST_ENTRIES, MOST_FILE, MOST_TOTAL = 500, 256 << 20, 1 << 30
CELLS = "file string, kind string, location string, row_no int, cells array<string>, status string, error string"


def format_of(path: Column | str) -> Column:
    """Format by suffix; null for an unknown one."""
    low = F.lower(F.col(path) if isinstance(path, str) else path)
    known = F.create_map(*[F.lit(x) for pair in FORMATS.items() for x in pair])
    return F.when(F.endswith(low, F.lit(".vision.json")), "vision").otherwise(F.try_element_at(known, F.regexp_extract(low, r"(\.[^./\\]*)$", 1)))


def csv_rows(data: bytes) -> list[list[str]]:
    """UTF-8 with or without mark, else GB18030; short rows filled, every value as text."""
    try:
        text = data.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = data.decode("gb18030")
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    width = max(map(len, rows), default=0)
    return [[cell(c) for c in r] + [""] * (width - len(r)) for r in rows]


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def workbook_rows(data: bytes) -> Iterator[tuple[str, list[list[str]]]]:
    """(sheet, rows) of an xlsx file."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(_MAIN + "t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(_MAIN + "si")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(_MAIN + "sheet"):
            target = targets[sheet.get(_LINK)]
            tree = ElementTree.fromstring(z.read(target.lstrip("/") if target.startswith("/") else posixpath.join("xl", target)))
            rows: list[list[str]] = []
            for r in tree.iter(_MAIN + "row"):
                line: dict[int, str] = {}
                for c in r.iter(_MAIN + "c"):
                    at = 0
                    for letter in re.match("[A-Z]+", c.get("r") or "A")[0]:
                        at = at * 26 + ord(letter) - 64
                    value = c.find(_MAIN + "v")
                    text = "".join(t.text or "" for t in c.iter(_MAIN + "t")) if c.get("t") == "inlineStr" else (value.text or "" if value is not None else "")
                    line[at] = shared[int(text)] if c.get("t") == "s" and text else text
                number = int(r.get("r") or len(rows) + 1)
                rows += [[] for _ in range(number - 1 - len(rows))]
                rows.append([cell(line.get(i, "")) for i in range(1, max(line, default=0) + 1)])
            width = max(map(len, rows), default=0)
            yield sheet.get("name"), [r + [""] * (width - len(r)) for r in rows]


def vision_rows(data: bytes) -> Iterator[tuple[object, list[list[str]]]]:
    """(page, rows) of a recognition result."""
    doc = json.loads(data.decode("utf-8-sig"))
    if doc.get("stage") != "vision_source_result":
        raise ValueError("视觉识别文件必须是 vision_source_result JSON")
    if not isinstance(doc.get("pages"), list):
        raise ValueError("视觉识别文件必须包含 pages 数组")
    for page in doc["pages"]:
        rows = [[" ".join(str("" if c is None else c).split()) for c in r] for r in page.get("rows") or [] if isinstance(r, list)]
        if rows:
            yield page.get("page"), rows


def tables_of(path: str, data: bytes) -> tuple[list[tuple[str, dict, list[list[str]]]], str]:
    """([(kind, location, rows)], status) of a file."""
    low = path.lower()
    form = "vision" if low.endswith(".vision.json") else FORMATS.get(posixpath.splitext(low)[1])
    if form == "html":
        found = [table_rows(t) for t in parse(decode_page(data)).walk() if t.tag == "table"]
        tables = [("table", {"table_index": i}, rows) for i, rows in enumerate(filter(None, found), 1)]
        return tables, "ready" if tables else "manual_review"
    if form == "spreadsheet":
        if low.endswith(".csv"):
            stem = posixpath.splitext(posixpath.basename(path))[0]
            return [("sheet", {"sheet": stem}, csv_rows(data))], "ready"
        return [("sheet", {"sheet": name}, rows) for name, rows in workbook_rows(data)], "ready"
    if form == "vision":
        tables = [("vision_table", {"page": page}, rows) for page, rows in vision_rows(data)]
        return tables, "ready" if tables else "vision_result_empty"
    if form == "image":
        return [], "needs_vision"
    raise ValueError(f"不支持的来源格式：{posixpath.basename(path)}")


def cells(files: DataFrame, path: str = "path", content: str = "content", root: str = "") -> DataFrame:
    """All rows of all tables; a file without any has one row with null row_no, its status or its error."""

    def run(batches):
        for batch in batches:
            out = []
            for p, data in zip(batch["file"].to_pylist(), batch["content"].to_pylist(), strict=True):
                try:
                    tables, status = tables_of(p, data or b"")
                    error = None
                except Exception as e:  # noqa: BLE001  one bad file must not stop the others
                    tables, status, error = [], "error", " ".join(str(e).split())
                rows = [(p, kind, json.dumps(place, ensure_ascii=False), i, r, status, None) for kind, place, t in tables for i, r in enumerate(t, 1)]
                out += rows or [(p, None, None, None, None, status, error)]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.string(), pa.string()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["file", "kind", "location", "row_no", "cells", "status", "error"])

    name = F.regexp_replace(F.col(path), "^" + re.escape(root.rstrip("/")) + "/+", "") if root else F.col(path)
    return files.select(name.alias("file"), F.col(content).alias("content")).mapInArrow(run, CELLS)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """``cells`` of every file under a folder."""
    return cells(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path))


def pdf_verdict(pages: DataFrame) -> DataFrame:
    """(file, page_count, characters, status) from (file, page, text): whether a PDF's own text can be used."""
    body = squeeze("text")
    by = pages.groupBy("file").agg(F.count("*").alias("page_count"), F.sum(F.length(body)).alias("characters"), F.sum(F.length(body) - F.length(F.replace(body, F.lit("�"), F.lit("")))).alias("odd"))
    status = F.when(F.col("characters") < F.greatest(F.lit(100), F.col("page_count") * 5), "needs_vision").when(F.col("odd") > F.greatest(F.col("characters"), F.lit(1)) * 0.01, "text_mapping_issue").otherwise("ready")
    return by.select("file", "page_count", "characters", status.alias("status"))


def model_rows(answer: Column) -> Column:
    """The array of rows in a model's answer, fences and prose around it dropped; null if there is none."""
    bare = F.regexp_replace(F.trim(answer), r"(?m)^```[\w-]*[ \t]*$", "")
    begin = F.instr(bare, "[")
    end = F.length(bare) - F.instr(F.reverse(bare), "]") + 1
    rows = F.from_json(F.when(begin > 0, F.substring(bare, begin, end - begin + 1)), "array<array<string>>")
    return F.transform(rows, lambda r: F.transform(r, squeeze))


def merged_rows(segments: DataFrame) -> DataFrame:
    """(file, row_no, cells) from (file, segment, row_no, cells): one header, every other row once, in order."""
    first = segments.groupBy("file").agg(F.min_by("cells", F.struct("segment", "row_no")).alias("header"), F.min(F.struct("segment", "row_no")).alias("at"))
    place = F.struct("segment", "row_no")
    with_head = segments.join(first, "file")
    body = with_head.filter((F.col("row_no") > 1) & (F.col("cells") != F.col("header"))).groupBy("file", "cells").agg(F.min(place).alias("at"))
    rows = first.select("file", F.col("header").alias("cells"), "at").unionByName(body)
    return rows.select("file", F.row_number().over(Window.partitionBy("file").orderBy("at")).alias("row_no"), "cells")


# What a short row of a recognised table may start with.
TOTALS = ["合计", "总计", "小计"]
PLACE_MARK = "学校|小学|中学|幼儿园|学院|大学|校区|分校|分园|园区|教学点"
NOTE = "^(?:对口|招生地段|划片|范围|备注|说明|咨询|序号)"


def aligned(row: Column, width: Column) -> Column:
    """A row at the width of its header; one that lacks its number column gets a blank cell in front."""
    first = squeeze(F.get(row, F.lit(0)))
    named = F.coalesce(first.isin(*TOTALS), F.lit(False)) | F.rlike(first, F.lit(PLACE_MARK))
    shift = (F.size(row) >= 2) & (F.size(row) <= width - 2) & (first != "") & ~F.rlike(first, F.lit(r"^\p{Nd}")) & named & ~F.rlike(first, F.lit(NOTE))
    moved = F.when(shift, F.concat(F.array(F.lit("")), row)).otherwise(row)
    return F.slice(F.concat(moved, F.array_repeat(F.lit(""), width)), F.lit(1), width)


def block_rows(blocks: DataFrame) -> DataFrame:
    """(file, row_no, cells) from recognised blocks (file, pos, type, table_body): tables joined under one header."""
    from placewright.sources.pages import plain_rows

    wide = F.translate(F.col("table_body"), "(),;:", "（），；：")
    rows = blocks.filter("type = 'table'").select("file", "pos", F.explode(plain_rows(wide)).alias("t")).select("file", "pos", F.col("t.row_no").alias("no"), F.transform("t.cells", squeeze).alias("cells"))
    place = F.struct("pos", "no")
    head = rows.groupBy("file").agg(F.min(F.struct(place.alias("at"), F.col("cells"))).alias("h")).select("file", F.col("h.at").alias("head_at"), F.col("h.cells").alias("header"))
    kept = rows.join(head, "file").filter((place == F.col("head_at")) | ~((F.col("no") == 1) & (F.col("cells") == F.col("header"))))
    line = F.when(place == F.col("head_at"), F.col("cells")).otherwise(aligned(F.col("cells"), F.size("header")))
    return kept.select("file", F.row_number().over(Window.partitionBy("file").orderBy("pos", "no")).alias("row_no"), line.alias("cells"))


def page_summary(blocks: DataFrame) -> DataFrame:
    """(file, page, has_table, caption) from blocks (file, pos, type, page_idx, table_caption)."""
    caption = F.array_join(F.filter(F.transform(F.coalesce("table_caption", F.array().cast("array<string>")), squeeze), lambda x: x != ""), "；")
    mark = F.when((F.col("type") == "table") & (caption != ""), F.struct("pos", caption.alias("caption")))
    return blocks.filter("page_idx is not null").groupBy("file", (F.col("page_idx") + 1).alias("page")).agg(F.max(F.col("type") == "table").alias("has_table"), F.min(mark)["caption"].alias("caption"))


# -- archives -------------------------------------------------------------------------------------------


def member_path(name: str) -> str:
    """A safe relative path, or an error."""
    name = name.replace("\\", "/")
    if not name or name.startswith("/") or re.match("[A-Za-z]:", name) or ".." in name.split("/"):
        raise ValueError(f"zip 成员路径非法：{name}")
    return "/".join(p for p in name.split("/") if p not in ("", "."))


def member_name(info: zipfile.ZipInfo) -> str:
    if info.flag_bits & 0x800:
        return info.filename
    try:
        return info.filename.encode("cp437").decode("gbk")
    except UnicodeError:
        return info.filename


def archive_members(data: bytes) -> tuple[list[tuple[str, bytes]], list[str]]:
    """([(path, bytes)] by path, skipped paths) of an archive within the limits; any violation is an error."""
    try:
        z = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile as e:
        raise ValueError("不是合法 zip 压缩包") from e
    with z:
        if len(z.infolist()) > MOST_ENTRIES:
            raise ValueError(f"zip 条目超过上限：{len(z.infolist())}")
        take: dict[str, zipfile.ZipInfo] = {}
        skipped, declared = [], 0
        for info in z.infolist():
            raw = member_name(info)
            if raw.endswith(("/", "\\")):
                continue
            path = member_path(raw)
            if not path or path.split("/")[0] == "__MACOSX" or path.split("/")[-1] == ".DS_Store":
                continue
            if posixpath.splitext(path.lower())[1] not in FORMATS:
                skipped.append(path)
                continue
            declared += info.file_size
            for wrong, why in ((info.flag_bits & 1, f"zip 含加密成员：{path}"), (info.file_size > MOST_FILE, f"zip 成员超过单文件上限：{path}"), (declared > MOST_TOTAL, "zip 解压总大小超过上限"), (path in take, f"zip 内存在重复目标：{path}")):
                if wrong:
                    raise ValueError(why)
            take[path] = info
        if not take:
            raise ValueError("压缩包内没有可读取的来源文件")
        out = []
        for path, info in sorted(take.items()):
            try:
                with z.open(info) as f:
                    content = f.read(MOST_FILE + 1)
            except (zipfile.BadZipFile, zlib.error, struct.error, EOFError, NotImplementedError) as e:
                raise ValueError(f"zip 解压失败：{e}") from e
            if len(content) > MOST_FILE:
                raise ValueError(f"zip 成员超过单文件上限：{path}")
            out.append((path, content))
        return out, skipped


def unpacked(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(archive, path, content, size, skipped, error): members of archives; a bad archive gives one row with its error."""

    def run(batches):
        for batch in batches:
            for p, data in zip(batch["p"].to_pylist(), batch["c"].to_pylist(), strict=True):
                try:
                    members, skipped = archive_members(data or b"")
                    rows = [(p, m, c, len(c), skipped, None) for m, c in members]
                except ValueError as e:
                    rows = [(p, None, None, None, None, str(e))]
                kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.list_(pa.string()), pa.string()]
                for r in rows:
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(r, kinds, strict=True)], ["archive", "path", "content", "size", "skipped", "error"])

    return files.select(F.col(path).alias("p"), F.col(content).alias("c")).mapInArrow(run, "archive string, path string, content binary, size long, skipped array<string>, error string")

