"""Writing results: JSON documents and workbooks, first to the side, then checked, then in place."""

from __future__ import annotations

import json
import os
import tempfile
import zipfile
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame

from placewright.operators.output import SheetSpec, abnormal_violations, main_violations
from placewright.sources.files import workbook_rows


def write_aside(path: str | Path, data: bytes, check: Callable[[bytes], None] | None = None) -> None:
    """Bytes written beside their place and moved there; the old file stays if anything fails."""
    target = Path(path).resolve()
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(prefix=f".{target.name}.", dir=target.parent)
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
        if check:
            check(Path(name).read_bytes())
        os.replace(name, target)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise


def write_json(path: str | Path, payload) -> None:
    write_aside(path, (json.dumps(payload, ensure_ascii=False, indent=2) + "\n").encode())


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A table of any size; Spark's commit protocol makes the write all or nothing."""
    df.write.mode(mode).parquet(path)


def quality_report(stage: str, city: str, units=(), reasons=(), config=None, checks=None) -> dict:
    """A report that passes if there is no reason against it."""
    report = {"stage": stage, "city": city, "generated_at": datetime.now(UTC).isoformat(timespec="seconds"), "config": dict(config or {})}
    if checks is not None:
        report["checks"] = dict(checks)
    return report | {"units": list(units), "reasons": list(reasons), "passed": not list(reasons)}


def summary(report: dict, path: str) -> str:
    return json.dumps({"stage": report["stage"], "city": report["city"], "passed": report["passed"], "reason_count": len(report["reasons"]), "output": str(path)}, ensure_ascii=False)


def run_gate(build: Callable[[str], dict], input_dir: str, output: str | None = None) -> int:
    """Build, write and print a report; 0 if it passes."""
    report = build(input_dir)
    path = output or str(Path(input_dir) / f"{report['stage']}.json")
    write_json(path, report)
    print(summary(report, path))
    return 0 if report["passed"] else 1


def _column(i: int) -> str:
    name = ""
    while i:
        i, rest = divmod(i - 1, 26)
        name = chr(65 + rest) + name
    return name


def workbook_bytes(sheets: list[tuple[str, list[str], list[list], list[int]]]) -> bytes:
    """An xlsx file of (name, headers, rows, widths): bold headers that stay in view, links on web addresses."""
    import io

    out = io.BytesIO()
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml", head + f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", head + f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        names = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, (n, *_) in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", head + f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", head + f'<Relationships xmlns="{package}/relationships">{links}<Relationship Id="rId{len(sheets) + 1}" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", head + f'<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>')
        for i, (_, headers, rows, widths) in enumerate(sheets, 1):
            lines, targets = [], []
            for r, row in enumerate([headers, *rows], 1):
                cells = []
                for k, v in enumerate(row, 1):
                    at, style = f"{_column(k)}{r}", ' s="1"' if r == 1 else ""
                    if isinstance(v, int) and not isinstance(v, bool):
                        cells.append(f'<c r="{at}"{style}><v>{v}</v></c>')
                    else:
                        value = "" if v is None else str(v)
                        cells.append(f'<c r="{at}" t="inlineStr"{style}><is><t xml:space="preserve">{escape(value)}</t></is></c>')
                        if r > 1 and value.lower().startswith(("http://", "https://")):
                            targets.append((at, value.split("|")[0].strip()))
                lines.append(f'<row r="{r}">{"".join(cells)}</row>')
            columns = "".join(f'<col min="{k}" max="{k}" width="{w}" customWidth="1"/>' for k, w in enumerate(widths, 1))
            marks = "".join(f'<hyperlink ref="{at}" r:id="rId{k}"/>' for k, (at, _) in enumerate(targets, 1))
            z.writestr(f"xl/worksheets/sheet{i}.xml", head + f'<worksheet xmlns="{main}" xmlns:r="{rel}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>{f"<cols>{columns}</cols>" if columns else ""}<sheetData>{"".join(lines)}</sheetData>{f"<hyperlinks>{marks}</hyperlinks>" if marks else ""}</worksheet>')
            if targets:
                own = "".join(f'<Relationship Id="rId{k}" Type="{rel}/hyperlink" Target="{escape(t, {chr(34): "&quot;"})}" TargetMode="External"/>' for k, (_, t) in enumerate(targets, 1))
                z.writestr(f"xl/worksheets/_rels/sheet{i}.xml.rels", head + f'<Relationships xmlns="{package}/relationships">{own}</Relationships>')
    return out.getvalue()


def write_workbook(path: str, spec: SheetSpec, main: list[tuple[str, DataFrame]], abnormal: tuple[str, DataFrame]) -> None:
    """Main sheets and one abnormal sheet as a workbook; checked before it takes its place."""
    titles = [n for n, _ in main] + [abnormal[0]]
    if len(set(titles)) < len(titles) or not all(n.strip() for n in titles):
        raise ValueError("工作表名称必须非空且不重复")
    for name, sheet, bad in [*[(n, s, main_violations(s, spec)) for n, s in main], (abnormal[0], abnormal[1], abnormal_violations(abnormal[1]))]:
        wrong = [r.violation for r in bad.filter("n > 0").collect()]
        if wrong:
            raise ValueError(f"{name}：{'、'.join(wrong)}")
    rows = lambda df: [list(r) for r in df.orderBy("序号").toLocalIterator()]
    sheets = [(n, spec.main_headers, rows(s), spec.main_widths) for n, s in main] + [(abnormal[0], spec.abnormal_headers, rows(abnormal[1]), spec.abnormal_widths)]

    def check(data: bytes) -> None:
        found = [(n, r[0] if r else [], len(r) - 1) for n, r in workbook_rows(data)]
        if found != [(n, h, len(r)) for n, h, r, _ in sheets]:
            raise ValueError("工作簿与记录不一致")

    write_aside(path, workbook_bytes(sheets), check)
