"""Files, pages, evidence, extraction rules, sheets, connectors, streaming."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from placewright.functions import text as X
from placewright.functions import urls as U
from placewright.operators import extract, links, output
from placewright.operators.extract import Attribute, Vocabulary
from placewright.sources import connectors, files, pages, sinks
from placewright.sources.dom import parse
from placewright.sources.evidence import evidence_of

WORDS = Vocabulary(("机构名称",), ("名称",), ("地址",), (Attribute("level", ("级别",), "级别", True),), "学校|中学", "路|街", "级别")


def values(spark, items, build, kind="string"):
    return [r.r for r in spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}").select("i", build(F.col("v")).alias("r")).orderBy("i").collect()]


def test_text_columns(spark):
    assert values(spark, [" a\xa0　b\x1c\n", None, " "], X.squeeze) == ["a b", "", ""]
    assert values(spark, ["a\r\n a \n\nb\tc b c"], X.page_lines) == ["a\nb c"]
    assert values(spark, [" x  y \r\n\n z"], X.cell_text) == ["x y\nz"]
    assert values(spark, [" 学校（Name）：A_b/"], X.header_key) == ["学校nameab"]
    assert values(spark, ["abcabc", "zzz"], lambda c: X.last_index(c, "bc")) == [4, -1]


def test_url_columns(spark):
    assert values(spark, ["https://u:p@WWW.E.org.:8/x", "e.org", "ftp://[::1]/", None], U.host_of) == ["www.e.org", "", "::1", ""]
    assert values(spark, [" E.org. ", "https://A.b/c"], U.domain_of) == ["e.org", "a.b"]
    assert values(spark, ["https://a.e.org/", "https://note.org/", "ftp://e.org/", "http://e.org"], lambda c: U.url_in_domains(c, F.array(F.lit("e.org")))) == [True, False, False, True]
    assert values(spark, [" https://e.org/a b | f.xlsx | sheet | Row 3", "| f", None], U.source_reference) == ["https://e.org/a | f.xlsx | Row 3", "", ""]


def test_html_tables(spark):
    html = "<table><thead><tr><th>A<th>B</thead><tr><td rowspan=2>1<td>x<br>y<tr><td> 2 </table><table><tr><td colspan=2>w<td>z</table><table></table>"
    got = spark.createDataFrame([(html,)], "h string").select(F.explode(pages.html_tables("h")).alias("t")).select("t.*").collect()
    assert [(r.table_index, r.row_no, r["cells"]) for r in got] == [(1, 1, ["A", "B"]), (1, 2, ["1", "xy"]), (1, 3, ["1", "2"]), (2, 1, ["w", "w", "z"])]


def test_selectors():
    root = parse('<div class="a b"><p>1<p class=x>2</div><ul><li>级别：一</li><li id=q>y</ul>')
    pick = lambda s: [n.text() for n in root.select(s)]
    assert pick("div.a.b > p") == ["1", "2"] and pick("div .x") == ["2"] and pick("#q") == ["y"] and pick('li:-soup-contains("级别")') == ["级别：一"]
    assert [n.text() for n in root.select("div")[0].select(":scope > :nth-child(2)")] == ["2"] and pick("p, li") == ["1", "2", "级别：一", "y"]
    with pytest.raises(ValueError):
        root.select("p:hover")


def test_decoding():
    assert pages.decode_page("é".encode("utf-16")) == "é" and pages.decode_page("中".encode("gbk"), "gbk") == "中"
    assert pages.decode_page('<meta charset="gb2312">中'.encode("gbk")).endswith("中") and pages.decode_page(b"\xff", "nope") == "�" and pages.decode_page(None) == ""


def test_cells(spark):
    book = sinks.workbook_bytes([("一", ["a", "b"], [[1, "x"], [2, None]], [5, 5])])
    vision = json.dumps({"stage": "vision_source_result", "pages": [{"page": 2, "rows": [["a", " b "], "bad"]}, {"page": 3, "rows": []}]}).encode()
    data = [("d/a.csv", "名,址\n甲,1\n".encode("gb18030")), ("d/b.xlsx", book), ("d/c.vision.json", vision), ("d/e.png", b"x"), ("d/f.zzz", b""), ("d/g.html", b"<p>no"), ("d/h.vision.json", b"{}")]
    df = spark.createDataFrame([(p, bytearray(c)) for p, c in data], "path string, content binary")
    got = files.cells(df).collect()
    rows = [(r.file[2:], r.location, r.row_no, r["cells"]) for r in got if r.row_no]
    assert rows == [("a.csv", '{"sheet": "a"}', 1, ["名", "址"]), ("a.csv", '{"sheet": "a"}', 2, ["甲", "1"]), ("b.xlsx", '{"sheet": "一"}', 1, ["a", "b"]), ("b.xlsx", '{"sheet": "一"}', 2, ["1", "x"]), ("b.xlsx", '{"sheet": "一"}', 3, ["2", ""]), ("c.vision.json", '{"page": 2}', 1, ["a", "b"])]
    assert {r.file[2:]: r.status for r in got if not r.row_no} == {"e.png": "needs_vision", "f.zzz": "error", "g.html": "manual_review", "h.vision.json": "error"}
    assert values(spark, ["x.VISION.json", "a.HTM", "b.xlsm", "c"], files.format_of) == ["vision", "html", "spreadsheet", None]


def archive(members, encrypt=False):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, c in members:
            z.writestr(n, c)
    data = out.getvalue()
    return data.replace(b"PK\x01\x02\x14\x03\x14\x00\x00\x00", b"PK\x01\x02\x14\x03\x14\x00\x01\x00") if encrypt else data


def test_archives(spark):
    good = archive([("b/x.csv", "1"), ("a.html", "2"), ("note.txt", "3"), ("__MACOSX/a.html", "4"), ("d/", "")])
    assert files.archive_members(good) == ([("a.html", b"2"), ("b/x.csv", b"1")], ["note.txt"])
    for bad in (archive([("../x.csv", "1")]), archive([("/x.csv", "1")]), archive([("note.txt", "1")]), b"junk", archive([("x.csv", "1"), ("./x.csv", "2")]), archive([("x.csv", "1")], True)):
        with pytest.raises(ValueError):
            files.archive_members(bad)
    got = files.unpacked(spark.createDataFrame([("g", bytearray(good)), ("b", bytearray(b"junk"))], "path string, content binary")).collect()
    assert [(r.archive, r.path, r.size) for r in got] == [("g", "a.html", 1), ("g", "b/x.csv", 1), ("b", None, None)]


def test_recognised_tables(spark):
    assert values(spark, ['text\n```json\n[["a", " b"]]\n```', "none"], files.model_rows) == [[["a", "b"]], None]
    blocks = [("f", 0, "text", "", 0, None), ("f", 1, "table", "<table><tr><td>序号<td>学校<td>地址<td>电话</table>", 0, [" 表 一 ", ""]), ("f", 2, "table", "<table><tr><td>序号<td>学校<td>地址<td>电话<tr><td>第一小学<td>a(1)</table>", 1, ["x"])]
    df = spark.createDataFrame(blocks, "file string, pos int, type string, table_body string, page_idx int, table_caption array<string>")
    assert [r["cells"] for r in files.block_rows(df).orderBy("row_no").collect()] == [["序号", "学校", "地址", "电话"], ["", "第一小学", "a（1）", ""]]
    assert sorted((r.page, r.has_table, r.caption) for r in files.page_summary(df).collect()) == [(1, True, "表 一"), (2, True, "x")]


def test_evidence():
    find = lambda html, *labels: [(e["address_text"], e["extraction_method"]) for e in evidence_of(html, list(labels))]
    assert find("<p>地址：杭州市西湖区文三路12号 邮编：310000</p>") == [("杭州市西湖区文三路12号", "inline_label")]
    assert find("<table><tr><td>校址</td><td>杭州市西湖区文三路12号</td></tr></table>", "校址") == [("杭州市西湖区文三路12号", "label_relation")]
    assert find("<dl><dt>地址</dt><dd>杭州市西湖区文三路12号</dd></dl>") == [("杭州市西湖区文三路12号", "label_relation")]
    assert find('<script type="application/ld+json">{"@type":"PostalAddress","addressRegion":"浙江省","addressLocality":"杭州市","streetAddress":"西湖区文三路1号"}</script>') == [("浙江省杭州市西湖区文三路1号", "structured_data")]
    assert find("<p>杭州市西湖区文三路12号（东校址）</p>", "校址")[0][1] == "configured_suffix"
    assert find("<footer><p>杭州市西湖区文三路12号</p><p>电话：0571-12345678</p></footer>") == [("杭州市西湖区文三路12号", "footer_contact")]
    assert find("<p style='display:none'>地址：杭州市西湖区文三路12号</p>") == [] and find("<p>举报</p><p>地址：杭州市西湖区文三路12号</p>") == []
    assert find("<p>没有</p>") == [] and find(None) == []


def test_rule_inference(spark):
    rows = [("t.csv", "sheet", "{}", i, c) for i, c in enumerate([["说明"], ["机构 名称", "地址", "级别"], ["甲", "a", "一"], ["", "b", "二"], ["丙", "c", ""]], 1)] + [("u.csv", "sheet", "{}", 1, ["x", "y"])]
    cells = spark.createDataFrame(rows, "file string, kind string, location string, row_no int, cells array<string>")
    (r,) = extract.infer_table_rules(cells, WORDS).collect()
    assert (r.header_row, r.place_name_columns, r.original_address_column, r.fill_down_columns, r.attribute_fields[0].column) == (2, [1], 2, [1, 3], 3)
    kv = spark.createDataFrame([(f, "table", "{}", i, c) for f in ("d/1.html", "d/2.html", "e.html") for i, c in enumerate([["机构名称：", "甲"], ["地址", "a"], ["级别", "一"]], 1)], cells.schema)
    rules = extract.infer_key_value_rules(kv, WORDS)
    assert rules.first().place_name_labels == ["机构名称："] and rules.count() == 3
    assert extract.consolidate_rules(rules.filter("file like 'd/%'")).first().file_pattern == "d/*.html"
    assert {r.file for r in extract.consolidate_rules(rules).collect()} == {"d/1.html", "d/2.html", "e.html"}
    html = "<body>" + "".join(f"<div class='b a'><h3>第{i}中学</h3><p>文三路{i}号</p><ul><li>级别：一</li></ul></div>" for i in range(4)) + "</body>"
    blocks = extract.block_groups(spark.createDataFrame([("p.html", html)], "file string, html string"))
    (c,) = extract.infer_css_rules(blocks, WORDS).collect()
    assert (c.row_selector, c.place_name_selector, c.original_address_selector, c.attribute_fields[0].selector) == ("div.a.b", ":scope > :nth-child(1)", ":scope > :nth-child(2)", 'li:-soup-contains("级别")')
    assert extract.inspection(cells).filter("file = 't.csv'").first().row_count == 5


def test_running_a_plan(spark):
    grid = [["名称", "地址", "级别"], ["甲", "a", "一"], ["", "b", ""], ["名称", "x", ""], ["丁", "d", "二"], ["戊", "e", "三"]]
    cells = spark.createDataFrame([("t.csv", "sheet", '{"sheet": "t"}', i, c) for i, c in enumerate(grid, 1)], "file string, kind string, location string, row_no int, cells array<string>")
    html = "<table><tr><td>机构名称</td><td>己</td><tr><td>地址：</td><td>f路1号</td></table><div class=r><b>庚</b><i>g</i></div>"
    text = "辛 在 h路\n壬 在 i路"
    objects = '{"d":{"l":[{"n":" 癸 ","a":["x"]},{"m":"子","a":"j"},5]}}'
    inputs = {"cells": cells, "pages": spark.createDataFrame([("p/1.html", html)], "file string, html string"), "segments": spark.createDataFrame([("s.html", text, "s.html")], "file string, text string, reference string"), "texts": spark.createDataFrame([("o.json", objects), ("c.js", 'x1.name="丑";x2.name="寅";x1.addr="k";x1.name="卯"'), ("h.html", 'var a={"n":"辰"};b={c:1}')], "file string, text string")}
    rule = {"file": "t.csv", "kind": "sheet", "location": {"sheet": "t"}, "data_start_row": 2, "place_name_columns": [1], "original_address_column": 2, "attribute_fields": [{"field": "level", "column": 3}, {"field": "k", "value": "c"}], "fill_down_columns": [1, 3], "exclude_rows": [5], "approved": True}
    rules = [rule, {**rule, "required_cell_values": [{"column": 2, "value": "e"}]}, {"file": "p/1.html", "kind": "html_key_value", "approved": True}, {"file_pattern": "p/*", "kind": "html_css", "row_selector": ".r", "place_name_selector": "b", "original_address_selector": "i", "approved": True},
             {"file": "s.html", "kind": "text_regex", "pattern": r"^(?P<place_name>\w+) 在 (?P<original_address>\w+)$", "approved": True}, {"file": "o.json", "kind": "object_list", "container_keys": ["d", "l"], "place_name_keys": ["n", "m"], "original_address_keys": ["a"], "approved": True},
             {"file": "c.js", "kind": "object_list", "object_format": "html_js_assignment", "assignment_id_prefix": "x", "place_name_keys": ["name"], "original_address_keys": ["addr"], "approved": True}, {"file": "h.html", "kind": "object_list", "object_format": "html_object_literal", "marker_keys": ["n"], "place_name_keys": ["n"], "approved": True},
             {"file": "t.csv", "kind": "odd", "approved": True}, {"file": "zz", "kind": "sheet", "approved": True}, {"file": "t.csv", "kind": "sheet", "approved": False}]
    names = ["t.csv", "p/1.html", "s.html", "o.json", "c.js", "h.html"]
    plan = {"stage": "plan", "items": [{"source_title": "S", "content_url": "https://e.org/", "review_status": "ready", "files": [{"file": n} for n in names], "extraction_rules": rules}, {"review_status": "pending"}, {"review_status": "skipped", "skip_reason": "no_vision_capability", "files": [{"inspection_status": "needs_vision"}]}, {"review_status": "skipped"}]}
    got, metrics, errors = extract.run_plan(spark, plan, "plan", inputs, WORDS)
    by = {}
    for r in got.collect():
        by.setdefault(r.rule_no, []).append((r.place_name, r.original_address, dict(r.attributes), r.source_reference))
    assert [x[:3] for x in by[1]] == [("甲", "a", {"level": "一", "k": "c"}), ("甲", "b", {"level": "一", "k": "c"}), ("戊", "e", {"level": "三", "k": "c"})]
    assert by[1][1][3] == "https://e.org/ | t.csv | sheet t | row 3" and [x[0] for x in by[2]] == ["戊"]
    assert [x[:2] for x in by[3]] == [("己", "f路1号")] and by[4] == [("庚", "g", {}, "https://e.org/ | 1.html | .r | row 1")]
    assert [x[:2] for x in by[5]] == [("辛", "h路"), ("壬", "i路")] and [x[0] for x in by[6]] == ["癸", "子"] and [x[:2] for x in by[7]] == [("卯", "k"), ("寅", "")] and [x[0] for x in by[8]] == ["辰"]
    assert metrics["error_count"] == len(errors) == 4 and metrics["skipped_source_count"] == 1 and metrics["record_count"] == 13


def test_links_and_probes(spark):
    html = '<base href="https://e.org/d/"><title> T </title><a href="a.html">A</a><a href="a.html">again</a><a href="https://x.e.org/b">B</a><a href="https://f.org/">F</a><a>none</a>'
    df = spark.createDataFrame([("p", "https://q.org/", html)], "page string, final_url string, html string")
    assert [(r.title, r.url) for r in links.directory_links(df, "e.org").orderBy("pos").collect()] == [("A", "https://e.org/d/a.html"), ("B", "https://x.e.org/b")]
    assert [(r.url, r.file) for r in links.linked_pages(df, "a", "e.org").collect()] == [("https://e.org/d/a.html", "a.html")]
    m = links.download_metrics(spark.createDataFrame([("a", "u"), ("b", "v")], "file string, url string"), spark.createDataFrame([("a", "u", 3, ["x", "y"], "")], "file string, final_url string, size_bytes long, extracted array<string>, error string")).first()
    assert tuple(m) == (2, 1, 1, 2, 1)
    items = spark.createDataFrame([("1", "甲（院）", "https://a.org/", ["b.org"]), ("2", "乙", "https://c.org/", [])], "place_id string, place_name string, home_url string, official_domains array<string>")
    visits = spark.createDataFrame([("https://a.org/", "https://z.org/", 200, None, "<title>欢迎 甲</title>"), ("https://c.org/", None, None, "boom", None)], "url string, final_url string, http_status int, error string, html string")
    got = {r.place_id: r for r in links.probe_domains(items, visits).collect()}
    assert got["1"].identity_match and "并入 official_domains" in got["1"].suggestion and not got["2"].reachable and got["2"].error == "boom"


def test_sheets(spark, tmp_path):
    spec = output.SheetSpec(("名称",), query_date="2024-05-01")
    df = spark.createDataFrame([(2, "乙", "b", "official", "skipped", "https://e.org/1 | f | row 2", ""), (1, "甲", "a", "map", "poi_match", "x", " 无 ")], "k int, name string, final_address string, final_address_source string, map_match_status string, source_reference string, reason string")
    main, odd = output.main_sheet(df.withColumn("source_reference", F.lit("https://e.org/1 | f")), spec, ["name"], "k"), output.abnormal_sheet(df.filter("k = 1").withColumn("source_reference", F.lit("https://e.org/2")), spec, ["name"], "reason", "k")
    assert [list(r)[:6] for r in main.orderBy("序号").collect()] == [[1, "甲", "2024-05-01", "a", "地图", "POI匹配"], [2, "乙", "2024-05-01", "b", "官方来源", "未查询"]]
    path = tmp_path / "r.xlsx"
    sinks.write_workbook(str(path), spec, [("主表", main)], ("异常", odd))
    assert [(n, len(r)) for n, r in files.workbook_rows(path.read_bytes())] == [("主表", 3), ("异常", 2)]
    before = path.read_bytes()
    with pytest.raises(ValueError, match="空地址"):
        sinks.write_workbook(str(path), spec, [("主表", main.withColumn("地址", F.lit("")))], ("异常", odd))
    assert path.read_bytes() == before and [p.name for p in tmp_path.iterdir()] == ["r.xlsx"]
    report = sinks.quality_report("s", "c", reasons=["r"])
    assert not report["passed"] and sinks.run_gate(lambda _: sinks.quality_report("s", "c"), str(tmp_path)) == 0


def test_connectors(spark, tmp_path):
    now, slept = [0.0], []

    def sleep(s):
        slept.append(round(s, 3))
        now[0] += s

    w = connectors.Window(2, 1.0, lambda: now[0], sleep)
    for _ in range(3):
        w.wait()
    assert slept == [1.0] and w.total == 3
    p = connectors.Pace(1, 0.5, lambda: now[0], sleep)
    for _ in range(2):
        p.start("h")
        p.end("h")
    assert slept[-1] == 0.5
    bad = lambda url: (_ for _ in ()).throw(OSError("down"))
    good = lambda url: (b"x", url, 200, "")
    row = connectors.fetch("https://e.org", {"a": bad, "b": good}, "a")
    assert row["content"] == b"x" and [a["success"] for a in row["attempts"]] == [False, True]
    assert connectors.fetch_table(spark, ["https://e.org"], {"g": good}, pace=connectors.Pace(1, 0)).first().http_status == 200
    busy = iter([{"status": "0", "infocode": "10021"}, {"status": "1", "pois": [{"name": ["", " n "], "address": []}]}])
    payload, error = connectors.ask_service("https://m", {}, connectors.Window(0), lambda u: (json.dumps(next(busy)).encode(), u, 200, ""), sleep=lambda s: None)
    assert error == "" and connectors.candidates(payload, "pois") == [{"name": "n", "address": ""}]
    assert connectors.ask_service("https://m", {}, connectors.Window(0), bad, sleep=lambda s: None)[1].startswith("高德网络请求失败")
    (tmp_path / ".env").write_text("# c\nKEY = 'v'\n")
    assert connectors.setting("KEY", [str(tmp_path)]) == "v" and connectors.setting("NOPE_X", [str(tmp_path)]) == ""
    assert connectors.signature("k", "n", "HmacSHA256") and connectors.vision_payload("f", {2: [["a"]], 1: []})["pages"] == [{"page": 2, "rows": [["a"]]}]
    done = io.BytesIO()
    with zipfile.ZipFile(done, "w") as z:
        z.writestr("x_content_list.json", "[1]")
    client = connectors.RecognitionClient(lambda path, body: {"batch_id": "b"} if body else {"extract_result": [{"data_id": "p0003", "state": "done", "full_zip_url": "u"}]}, lambda u: done.getvalue())
    assert client.pages([3], url="https://e.org/f.pdf") == {3: [1]}


def test_stream(spark, tmp_path):
    from placewright.plans.samples import CATALOG
    from placewright.streaming.landing import normalized_stream, run_to
    from tests.engine.test_address import context

    folder = tmp_path / "in"
    folder.mkdir()
    row = {"record_id": 1, "city_name": "杭州市", "place_name": "馆", "original_address": "西湖区文三路1号", "source_nature": "web_search", "source_reference": "x", "attributes": {}, "arrived": "2024-01-01T00:00:00"}
    (folder / "a.json").write_text(json.dumps(row, ensure_ascii=False))
    run = lambda: run_to(normalized_stream(spark, str(folder), context(spark), CATALOG), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    run()
    (folder / "b.json").write_text(json.dumps({**row, "record_id": 2, "original_address": ""}, ensure_ascii=False))
    run()
    assert sorted((r.record_id, r.normalization_status) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "complete"), (2, "empty")]


def test_inspecting_sources(spark):
    pairs = [["机构名称", "甲"], ["地址", "a"]]
    rows = [(f"d/{i}.html", "table", '{"table_index": 1}', k, c, "ready", None) for i in (1, 2) for k, c in enumerate(pairs, 1)]
    rows += [("t.csv", "sheet", '{"sheet": "t"}', k, c, "ready", None) for k, c in enumerate([["名称", "地址"], ["乙", "b"]], 1)] + [("p.html", None, None, None, None, "manual_review", None), ("bad.csv", None, None, None, None, "error", "boom")]
    html = "<body>" + "".join(f"<div class='b'><h3>第{i}中学</h3><p>文三路{i}号</p></div>" for i in range(3)) + "</body>"
    items = [{"source_title": "S", "local_files": ["d/1.html", "d/2.html", "t.csv", "p.html"], "derived_files": ["bad.csv", "none.csv"], "local_file_urls": {"t.csv": "https://e.org/t"}}]
    plan, code = extract.inspect_sources(items, spark.createDataFrame(rows, files.CELLS), spark.createDataFrame([("p.html", html)], "file string, html string"), WORDS, "plan")
    (item,) = plan["items"]
    assert code == 1 and plan["inspection_summary"]["status_counts"] == {"error": 2, "ready": 4} and item["review_status"] == "pending"
    assert sorted((r["kind"], r.get("file") or r.get("file_pattern")) for r in item["extraction_rules"]) == [("html_css", "p.html"), ("html_key_value", "d/*.html"), ("sheet", "t.csv")]
    assert item["files"][2]["source_url"] == "https://e.org/t" and item["files"][4]["error"] == "boom" and item["files"][0]["structures"][0]["row_count"] == 2
    with pytest.raises(ValueError, match="local_files"):
        extract.inspect_sources([{}], spark.createDataFrame(rows, files.CELLS), spark.createDataFrame([("p", "")], "file string, html string"), WORDS, "plan")


def test_service_tables_and_tokens(spark):
    reply = lambda u: (json.dumps({"status": "1", "geocodes": [{"formatted_address": "x", "city": []}], "pois": [{"name": "n"}]}).encode(), u, 200, "")
    geo = connectors.answers_table(spark, "geocodes", [("a", "c"), ("a", "c")], "https://m", "k", connectors.Window(0), reply).collect()
    assert len(geo) == 1 and geo[0].candidates[0].formatted_address == "x" and geo[0].candidates[0].city == ""
    assert connectors.answers_table(spark, "pois", [("n", "c")], "https://m", "").first().error == "未配置 AMAP_KEY"
    assert list(connectors.district_payloads(["c"], "https://m", "k", connectors.Window(0), reply))[0][2] == ""
    assert connectors.expiry("2024-01-01 08:00:00") == 1704067200000 and connectors.expiry("x") == 0
    now, calls = [1704067200.0], []

    def post(path, body):
        calls.append(path)
        return {"nonce": "n", "algorithm": "HmacSHA1"} if path == "/getSignature" else {"jwt": f"t{len(calls)}", "expiration": "2024-01-01 08:10:00", "refreshExpiration": "2024-01-01 09:00:00", "refreshJwt": "r"}

    s = connectors.Session("a", "b", post, lambda: now[0])
    assert s.token() == "t2" and s.token() == "t2"
    now[0] += 900
    assert s.token() == "t3" and calls == ["/getSignature", "/getJwt", "/jwt/refresh"]
    with pytest.raises(connectors.RecognitionConfigError):
        connectors.Session("", "", post)


def test_link_metrics(spark):
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    m = links.link_metrics(one([("a",), ("b",), ("c",)], "page string"), one([("a", ""), ("b", "down")], "page string, error string"), one([("a", "u"), ("a", "v")], "page string, url string")).first()
    assert tuple(m) == (3, 2, 2)
