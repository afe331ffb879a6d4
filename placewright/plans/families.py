"""Queries of the operator families over worked cases and made-up sources, each with DuckDB SQL for the same rows."""

from __future__ import annotations

import io
import json
import urllib.parse
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placewright.functions import address as A
from placewright.functions import text as X
from placewright.functions import urls as U
from placewright.operators import city, extract, links, match, metrics, output
from placewright.operators.normalize import normalize_records, split_invalid
from placewright.plans import cases as C
from placewright.plans import samples as S
from placewright.plans.queries import WS, contexts, order_cells, query, read
from placewright.sources import connectors, fetched, files, sinks
from placewright.sources.evidence import page_evidence

# -- resolution -----------------------------------------------------------------------------------------


def resolution_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(normalized records, geocodes, points of interest) of the worked cases, one for each customer."""
    df = C.cases_for(spark, C.RESOLUTIONS, read(spark, d, "customer"), "c_custkey")
    aliases = F.when(F.col("aliases") != "", F.create_map(F.lit("poi_name_aliases"), F.col("aliases"))).otherwise(F.create_map().cast("map<string,string>"))
    records = df.select(F.col("k").alias("record_id"), F.lit(S.CITY).alias("city_name"), F.col("place").alias("place_name"), F.col("address").alias("original_address"), F.col("nature").alias("source_nature"), F.lit("x").alias("source_reference"), aliases.alias("attributes"))
    normalized = normalize_records(records, contexts(spark), S.CATALOG, keep_context=True)
    geo = F.struct(F.col("geo").alias("formatted_address"), F.lit(S.PROVINCE).alias("province"), F.lit(S.CITY).alias("city"), F.col("geo_district").alias("district"), F.lit("").alias("street"), F.lit("").alias("number"))
    geocodes = df.filter("geo <> '' OR geo_error <> ''").select(F.concat(F.lit(S.CITY), F.col("address")).alias("asked_address"), F.lit(S.CITY).alias("asked_city"), F.col("geo_error").alias("error"), F.lit(1).alias("attempts"), F.when(F.col("geo") != "", F.array(geo)).otherwise(F.array().cast(match.GEOCODES)).alias("candidates"))
    part = lambda p, i: F.get(F.split(p, r"\|"), F.lit(i))
    poi = lambda p: F.struct(*[part(p, i).alias(n) for i, n in enumerate(("name", "cityname", "adname", "address", "type"))], F.lit("141200").alias("typecode"))
    pois = df.filter("poi <> ''").select(F.when(F.col("asked") != "", F.col("asked")).otherwise(F.col("place")).alias("asked_name"), F.lit(S.CITY).alias("asked_city"), F.lit("").alias("error"), F.lit(1).alias("attempts"), F.transform(F.split("poi", "#"), poi).alias("candidates"))
    return normalized, geocodes, pois


def resolved_cases(spark: SparkSession, d: str) -> DataFrame:
    normalized, geocodes, pois = resolution_inputs(spark, d)
    twice = lambda df: df.unionByName(df)  # noqa: E731  a table that repeats its answers
    return match.resolve_records(normalized, S.CATALOG, twice(geocodes), twice(pois))


def _resolution_sql() -> str:
    rows = [(i, r.nature, C.MODE[r.nature], r.address, r.status, r.final, r.source, r.requests, r.normal, r.gap) for i, r in enumerate(C.RESOLUTIONS)]
    names = ["case_no", "nature", "mode", "address", "status", "final", "source", "requests", "normal", "gap"]
    return f"""WITH c AS {C.values_sql(rows, names)},
r AS (SELECT c_custkey AS k, c.* REPLACE (replace(final, '{{k}}', CAST(c_custkey AS VARCHAR)) AS final) FROM customer JOIN c ON c_custkey % {len(rows)} = case_no)"""


@query(_resolution_sql() + """
SELECT k AS record_id, mode AS address_mode, normal AS normalization_status, gap AS normalization_reason, status AS map_match_status, final AS final_address, source AS final_address_source, CAST(requests AS INTEGER) AS map_request_count, CAST(requests AS INTEGER) AS actual_http_attempt_count FROM r""")
def resolution_cases(spark, d):
    """Every way through the resolver: routes, geocodes, points of interest, the final choice."""
    keep = ["record_id", "address_mode", "normalization_status", "normalization_reason", "map_match_status", "final_address", "final_address_source", "map_request_count", "actual_http_attempt_count"]
    return resolved_cases(spark, d).select(*keep)


_COUNT = "(SELECT string_agg(v || '=' || n, ',' ORDER BY v) FROM (SELECT {0} AS v, count(*) AS n FROM r GROUP BY 1))"


@query(_resolution_sql() + f"""
, m AS (SELECT *, CASE WHEN normal IN ('complete', 'partial') THEN '{S.CITY}' WHEN gap LIKE '%江苏省' THEN '南京市' WHEN gap LIKE '%宁波市' THEN '宁波市' ELSE '' END AS city FROM r)
SELECT count(*) AS item_count, CAST(sum(requests) AS BIGINT) AS map_request_count, count(*) FILTER (final <> '') AS final_address_count,
  count(*) FILTER (gap = '{C.GAP_UNIT}' AND status <> 'skipped') AS missing_admin_geocode_count, count(*) FILTER (city NOT IN ('', '{S.CITY}')) AS out_of_city_address_count,
  CAST(sum(requests) AS BIGINT) AS actual_http_attempt_count, count(*) FILTER (status = 'not_found' AND address = '') AS not_found_empty_address_count,
  CAST(1.0 AS DOUBLE) AS rate_limit_window_seconds, CAST(2 AS INTEGER) AS rate_limit_max_requests,
  {_COUNT.format('nature')} AS source_counts, {_COUNT.format('mode')} AS address_mode_counts, {_COUNT.format('normal')} AS normalization_status_counts, {_COUNT.format('status')} AS map_match_status_counts,
  {_COUNT.format('city').replace('FROM r', 'FROM m')} AS resolved_city_counts FROM m""")
def resolution_metrics(spark, d):
    """The 14 metrics of the resolved cases."""
    one = metrics.resolution_metrics(resolved_cases(spark, d), S.CITY)
    shown = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return one.withColumns({m: shown(m) for m in metrics.COUNTED})


# -- pages ----------------------------------------------------------------------------------------------

LABELS = ["校址", "学校地址"]


def _evidence_sql() -> str:
    rows = [(i, n, *f.split("|")) for i, e in enumerate(C.EVIDENCE) for n, f in enumerate(e.found.split("#") if e.found else [])]
    listed = C.values_sql(rows, ["case_no", "pos", "address", "method", "region", "label"])
    return f"SELECT page_id, replace(address, '{{k}}', CAST(page_id AS VARCHAR)) AS address_text, method AS extraction_method, region AS source_region, label AS label_text FROM pages JOIN {listed} c ON page_id % {len(C.EVIDENCE)} = case_no"


@query(_evidence_sql())
def page_address_evidence(spark, d):
    """Evidence of worked pages, which the whole of a real page stands around."""
    pages = C.cases_for(spark, C.EVIDENCE, read(spark, d, "pages"), "page_id").select(F.col("k").alias("page_id"), F.col("html").alias("part"))
    whole = pages.join(read(spark, d, "pages").select("page_id", "html"), "page_id")
    whole = whole.select("page_id", F.concat(F.regexp_replace("html", "(?is)</body>.*$", ""), F.col("part"), F.lit("</body></html>")).alias("html"))
    return whole.select("page_id", F.explode(page_evidence(F.col("html"), LABELS)).alias("e")).select("page_id", "e.address_text", "e.extraction_method", "e.source_region", "e.label_text")


# -- extraction -----------------------------------------------------------------------------------------

WORDS = extract.Vocabulary(
    ("机构名称", "学校名称"), ("名称",), ("地址",), (extract.Attribute("level", ("级别",), "级别", True),), "学校|中学", "路|街"
)


def binary(*parts) -> Column:
    return F.concat(*parts).cast("binary")


def text_of(df: DataFrame, *names: str) -> DataFrame:
    """Attributes of raw records as columns."""
    kept = ["file", "row_no", "place_name", "original_address", "source_reference"]
    return df.select(*kept, *[F.col("attributes")[n].alias(n) for n in names])


@query("""
WITH o AS (SELECT o_custkey AS t, o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN '第' || o_orderkey || '中学' END AS name, '文三路' || (o_orderkey % 40) || '号' AS address, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_orderkey % 4 AS VARCHAR) END AS level
  FROM orders WHERE o_orderkey + 1 >= 3 AND o_orderkey + 1 NOT IN (8, 15, 50, 333) AND o_orderkey % 40 <> 17),
f AS (SELECT *, last_value(name IGNORE NULLS) OVER (PARTITION BY t ORDER BY k ROWS UNBOUNDED PRECEDING) AS filled FROM o)
SELECT 'f/' || t || '.csv' AS file, k + 1 AS row_no, filled AS place_name, address AS original_address, 'f/' || t || '.csv | sheet a | row ' || (k + 1) AS source_reference, level, 'constant x' AS note, filled || '|' || address || '|' || level AS cells
FROM f WHERE filled IS NOT NULL""")
def table_fill_down(spark, d):
    """Rows of every table through the rule for tables: range, exclusions, fill-down, constants, references."""
    rule = {
        "kind": "sheet", "location": {"sheet": "a"}, "data_start_row": 3, "place_name_columns": [1], "original_address_column": 2, "fill_down_columns": [1], "exclude_rows": [8, 15, 50, 333],
        "attribute_fields": [{"field": "level", "column": 3}, {"field": "note", "value": " constant  x "}],
    }
    cells = order_cells(spark, d).filter(F.get("cells", F.lit(1)) != "文三路17号")  # such rows are not in the files
    found = extract.table_records(cells, rule, WORDS)
    return text_of(found, "level", "note").join(found.select("file", "row_no", F.array_join("row", "|").alias("cells")), ["file", "row_no"])


@query("""
WITH o AS (SELECT o_custkey AS t, o_orderkey AS k FROM orders WHERE o_orderkey % 4 = 2 AND o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0)
SELECT 'f/' || t || '.csv' AS file, k + 1 AS row_no, '第' || k || '中学文三路' || (k % 40) || '号' AS place_name, '' AS original_address, 'https://e.org/' || t || ' | f/' || t || '.csv | sheet a | row ' || (k + 1) AS source_reference, '2' AS level FROM o""")
def plan_run(spark, d):
    """An approved plan over all files: joined names, required cells, each file's own address in its references."""
    cells = order_cells(spark, d)
    files = [{"file": r.file, "source_url": f"https://e.org/{r.file[2:-4]}"} for r in cells.select("file").distinct().collect()]
    rule = {
        "file_pattern": "f/*.csv", "kind": "sheet", "location": {"sheet": "a"}, "data_start_row": 1, "place_name_columns": [1, 2], "place_name_separator": "", "required_cell_values": [{"column": 3, "value": "2"}],
        "attribute_fields": [{"field": "level", "column": 3}], "approved": True,
    }
    plan = {"stage": "extraction", "items": [{"source_title": "S", "files": files, "extraction_rules": [rule], "review_status": "ready"}]}
    named = cells.filter(F.get("cells", F.lit(0)) != "")
    records, _, errors = extract.run_plan(spark, plan, "extraction", {"cells": named}, WORDS)
    if errors:
        raise ValueError(errors[0])
    return text_of(records, "level")


@query("""
SELECT 'reviewed_source_count' AS metric, CAST(1 AS BIGINT) AS n UNION ALL SELECT 'skipped_source_count', 1 UNION ALL SELECT 'approved_rule_count', 2 UNION ALL SELECT 'error_count', 3 UNION ALL SELECT 'source_count', 4
UNION ALL SELECT 'raw_item_count', count(*) FROM part UNION ALL SELECT 'record_count', count(*) FILTER (p_partkey % 2 = 0) FROM part""")
def plan_metrics(spark, d):
    """Sources that are reviewed, skipped, unfinished and wrongly skipped; a rule that names an unknown file fails alone."""
    k = F.col("p_partkey").cast("string")
    cells = read(spark, d, "part").select(F.lit("p.csv").alias("file"), F.lit("sheet").alias("kind"), F.lit("{}").alias("location"), (F.col("p_partkey") + 1).alias("row_no"), F.array(F.concat(F.lit("第"), k, F.lit("中学"))).alias("cells"))
    rule = {"file": "p.csv", "kind": "sheet", "location": {}, "data_start_row": 1, "place_name_columns": [1], "approved": True}
    items = [
        {"files": [{"file": "p.csv"}], "extraction_rules": [rule, {**rule, "file": "other.csv"}, {**rule, "approved": False}], "review_status": "ready"},
        {"files": [{"file": "s.png", "inspection_status": "needs_vision"}], "review_status": "skipped", "skip_reason": "no_vision_capability"},
        {"files": [{"file": "s.csv", "inspection_status": "ready"}], "review_status": "skipped", "skip_reason": "no_vision_capability"},
        {"files": [], "review_status": "pending"},
    ]
    odd = lambda name: F.regexp_extract(name, r"(\d+)", 1).cast("long") % 2 == 1
    _, counts, _ = extract.run_plan(spark, {"stage": "e", "items": items}, "e", {"cells": cells}, WORDS, skip=odd)
    return spark.createDataFrame(list(counts.items()), "metric string, n long")


@query("""
SELECT 'e' || event_id AS file, CAST(1 AS BIGINT) AS row_no, name AS place_name, '' AS original_address, 'e' || event_id || ' | row 1' AS source_reference
FROM (SELECT event_id, coalesce(nullif(trim(CAST(json_extract_string(props, '$.name') AS VARCHAR)), ''), nullif(trim(CAST(json_extract_string(props, '$.k') AS VARCHAR)), '')) AS name FROM events) WHERE name IS NOT NULL""")
def object_list_json(spark, d):
    texts = read(spark, d, "events").select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("file"), F.concat(F.lit("["), F.col("props"), F.lit("]")).alias("text"))
    return text_of(extract.object_records(texts, {"kind": "object_list", "place_name_keys": ["name", "k"]}))


@query("""
WITH p AS (SELECT p_partkey AS k, p_name AS name, p_brand AS brand FROM part)
SELECT 'jsonp' AS form, 'd/' || k || '.js' AS file, CAST(1 AS BIGINT) AS row_no, name AS place_name, brand AS original_address, k || '.js | row 1' AS source_reference, 'x' AS level FROM p
UNION ALL SELECT 'html_object_literal', 'd/' || k || '.js', 1, name, brand, k || '.js | row 1', 'fixed' FROM p
UNION ALL SELECT 'html_js_assignment', 'd/' || k || '.js', 1, name, brand, k || '.js | row 1', 'x' FROM p
UNION ALL SELECT 'html_js_assignment', 'd/' || k || '.js', 2, brand, '', k || '.js | row 2', '' FROM p""")
def object_list_formats(spark, d):
    """JSONP, objects in scripts and assignments in scripts."""
    k = F.col("p_partkey").cast("string")
    pair = F.concat(F.lit('"name":"'), F.col("p_name"), F.lit('","addr":"'), F.col("p_brand"), F.lit('","lv":" x "'))
    texts = {
        "jsonp": F.concat(F.lit('cb.go({"data":{"list":[{"title":" ",'), pair, F.lit('},5,{"name":""}]}});')),
        "html_object_literal": F.concat(F.lit('<script>var a={"other":{"deep":1}};var b={'), pair, F.lit("};</script>{broken")),
        "html_js_assignment": F.concat(F.lit('<script>c7.name="'), F.col("p_brand"), F.lit('";c3.name="old";c3.addr="'), F.col("p_brand"), F.lit('";c3.lv="x";c3.name="'), F.col("p_name"), F.lit('";</script>')),
    }
    more = {"jsonp": {"container_keys": ["data", "list"]}, "html_object_literal": {"marker_keys": ["name"], "attribute_fields": [{"field": "level", "value": "fixed"}]}, "html_js_assignment": {"assignment_id_prefix": "c"}}
    out = None
    for form, text in texts.items():
        rule = {"kind": "object_list", "object_format": form, "place_name_keys": ["title", "name"], "original_address_keys": ["addr"], "attribute_fields": [{"field": "level", "keys": ["lv"]}], **more[form]}
        rows = read(spark, d, "part").select(F.concat(F.lit("d/"), k, F.lit(".js")).alias("file"), text.alias("text"))
        made = text_of(extract.object_records(rows, rule), "level").withColumn("form", F.lit(form))
        out = made if out is None else out.unionByName(made)
    return out


def label_page() -> Column:
    """A page of labels and values for each part."""
    return F.concat(
        F.lit("<table><tr><th>学校 名称：</th><td> "), F.col("p_name"), F.lit("</td></tr><tr><td>（地址）</td><td>"), F.col("p_brand"), F.lit("</td><td>more</td></tr><tr><td>级别</td><td>"),
        F.when(F.col("p_partkey") % 2 == 0, "一级").otherwise(""), F.lit("</td></tr><tr><td>地址</td><td>second</td></tr><tr><td>alone</td></tr></table>"),
    )


@query("""SELECT 'h/' || p_partkey || '.html' AS file, CAST(1 AS BIGINT) AS row_no, p_name AS place_name, p_brand AS original_address, 'https://e.org | ' || p_partkey || '.html | key-value table' AS source_reference, CASE WHEN p_partkey % 2 = 0 THEN '一级' ELSE '未知' END AS level FROM part""")
def key_value_pages(spark, d):
    """Records of pages of labels and values: given labels, labels of the vocabulary, a constant where a value lacks."""
    pages = read(spark, d, "part").select(F.concat(F.lit("h/"), F.col("p_partkey").cast("string"), F.lit(".html")).alias("file"), label_page().alias("html"))
    rule = {"kind": "html_key_value", "place_name_labels": ["学校名称"], "original_address_labels": [], "attribute_fields": [{"field": "level", "value": "未知"}]}
    return text_of(extract.key_value_records(pages, rule, WORDS, "https://e.org"), "level")


@query("""
SELECT 'h/' || p_partkey || '.html' AS file, '学校 名称：' AS places, '（地址）,地址' AS addresses, CASE WHEN p_partkey % 2 = 0 THEN '级别' ELSE '' END AS levels FROM part""")
def key_value_rules(spark, d):
    """Rules inferred from tables whose first cells name a place and an address."""
    pages = read(spark, d, "part").select(F.concat(F.lit("h/"), F.col("p_partkey").cast("string"), F.lit(".html")).alias("path"), label_page().cast("binary").alias("content"))
    rules = extract.infer_key_value_rules(files.cells(pages), WORDS)
    joined = lambda c: F.array_join(c, ",")
    return rules.select("file", joined("place_name_labels").alias("places"), joined("original_address_labels").alias("addresses"), joined(F.col("attribute_fields")[0]["labels"]).alias("levels"))


def card_page() -> Column:
    """A page of cards for each size of parts, in the order of keys."""
    card = F.concat(F.lit('<div class="'), F.when(F.col("p_partkey") % 3 == 0, "c").otherwise("b a"), F.lit('"><h3>第'), F.col("p_partkey").cast("string"), F.lit("中学</h3><p>文三路"), F.col("p_partkey").cast("string"), F.lit("号</p><ul><li>级别："), F.col("p_brand"), F.lit("</li></ul></div>"))
    return F.concat(F.lit("<body>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", card.alias("c")))), lambda x: x["c"]), ""), F.lit("</body>"))


def card_pages(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").groupBy("p_size").agg(card_page().alias("html")).select(F.concat(F.lit("s"), F.col("p_size").cast("string")).alias("file"), "html")


_GROUPS = "SELECT 's' || p_size AS file, CASE WHEN p_partkey % 3 = 0 THEN 'c' ELSE 'a,b' END AS classes, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY ALL HAVING count(*) >= 3"


@query(f"SELECT file, 'div' AS tag, classes, n, CAST(row_number() OVER (PARTITION BY file ORDER BY n DESC, first) AS INTEGER) AS rank FROM ({_GROUPS})")
def repeated_block_groups(spark, d):
    """Elements that repeat with the same classes, the most frequent first."""
    return extract.block_groups(card_pages(spark, d)).select("file", "tag", F.array_join("classes", ",").alias("classes"), F.col("count").cast("long").alias("n"), "rank")


@query(f"SELECT file, 'div.' || replace(classes, ',', '.') AS row_selector, ':scope > :nth-child(1)' AS name, ':scope > :nth-child(2)' AS address, 'li:-soup-contains(\"级别\")' AS level FROM ({_GROUPS})")
def block_rules(spark, d):
    """Selectors inferred from repeated blocks."""
    rules = extract.infer_css_rules(extract.block_groups(card_pages(spark, d)), WORDS)
    return rules.select("file", "row_selector", F.col("place_name_selector").alias("name"), F.col("original_address_selector").alias("address"), F.col("attribute_fields")[0]["selector"].alias("level"))


@query("""
WITH r AS (SELECT p_size, p_partkey AS k, p_brand, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS n FROM part WHERE p_partkey % 3 <> 0)
SELECT 's' || p_size AS file, n AS row_no, '第' || k || '中学' AS place_name, '文三路' || k || '号' AS original_address, 's' || p_size || ' | div.a.b | row ' || n AS source_reference, '级别：' || p_brand AS level, 'z' AS note FROM r WHERE n <> 2""")
def block_rows_by_selector(spark, d):
    """Rows that a selector picks; numbers count the excluded ones as well."""
    rule = {"kind": "html_css", "row_selector": "div.a.b", "place_name_selector": ":scope > :nth-child(1)", "original_address_selector": "p", "exclude_rows": [2], "attribute_fields": [{"field": "level", "selector": 'li:-soup-contains("级别")'}, {"field": "note", "value": "z"}]}
    return text_of(extract.css_records(card_pages(spark, d), rule, WORDS), "level", "note")


@query("""
SELECT 'f/' || o_custkey || '.csv' AS file, 'sheet' AS kind, count(*) AS row_count, CAST(3 AS INTEGER) AS column_count, count(*) FILTER (o_orderkey + 1 <= 8) AS shown FROM orders GROUP BY 1""")
def table_inspection(spark, d):
    """Size and first rows of every table."""
    return extract.inspection(order_cells(spark, d)).select("file", "kind", "row_count", "column_count", F.size("preview_rows").cast("long").alias("shown"))


@query(f"""
WITH t AS (SELECT 's' || p_size AS file FROM part GROUP BY p_size ORDER BY count(*) DESC, p_size LIMIT 1), g AS (SELECT count(*) AS n FROM ({_GROUPS}) JOIN t USING (file))
SELECT status, CAST(v.n AS BIGINT) AS n, 2 + g.n AS rules FROM (VALUES ('ready', 3), ('manual_review', 1), ('error', 2)) v(status, n), g""")
def inspection_summary(spark, d):
    """A plan to be reviewed for sources of all kinds, made of files whose content comes from the tables."""
    one = read(spark, d, "part").filter("p_partkey = 1")
    table = F.concat(F.lit("学校名称,地址\n"), F.col("p_name"), F.lit(",a\n"), F.col("p_brand"), F.lit(",b\n"))
    made = [("t.csv", table), ("k.html", label_page()), ("empty.html", F.lit("<p>nothing</p>")), ("bad.xyz", F.lit("x"))]
    content = None
    for name, body in made:
        row = one.select(F.lit(name).alias("path"), body.cast("binary").alias("content"))
        content = row if content is None else content.unionByName(row)
    largest = read(spark, d, "part").groupBy("p_size").agg(card_page().alias("html"), F.count("*").alias("n")).orderBy(F.desc("n"), "p_size").limit(1)
    blocks = largest.select(F.lit("b.html").alias("path"), F.col("html").cast("binary").alias("content"))
    content = content.unionByName(blocks)
    pages = content.filter(F.col("path").endswith(".html")).select(F.col("path").alias("file"), F.col("content").cast("string").alias("html"))
    items = [{"source_title": "S", "local_files": ["t.csv", "k.html", "empty.html"], "derived_files": ["b.html", "bad.xyz", "gone.csv"]}]
    plan, _ = extract.inspect_sources(items, files.cells(content), pages, WORDS, "plan")
    summary = plan["inspection_summary"]
    return spark.createDataFrame([(s, n, summary["suggested_rule_count"]) for s, n in summary["status_counts"].items()], "status string, n long, rules long")


@query("""
SELECT p_partkey AS k, CAST(1 AS BIGINT) AS row_no, p_name AS place_name, p_brand AS original_address, 'https://e.org | ' || p_partkey || '.html' AS source_reference FROM part""")
def page_text_regex(spark, d):
    """A pattern over the text of pages, one line for each piece."""
    page = F.concat(F.lit("<h1>list</h1><p>name: <b>"), F.col("p_name"), F.lit("</b></p><p>at "), F.col("p_brand"), F.lit("</p>"))
    pages = read(spark, d, "part").select(F.concat(F.lit("x/"), F.col("p_partkey").cast("string"), F.lit(".html")).alias("file"), page.alias("html"))
    rule = {"kind": "text_regex", "pattern": r"^name:\n(?P<place_name>.+)\nat (?P<original_address>.+)$"}
    found = extract.regex_records(extract.page_segments(pages), rule, "https://e.org")
    return found.select(F.regexp_extract("file", r"(\d+)", 1).cast("long").alias("k"), "row_no", "place_name", "original_address", "source_reference")


# -- files ----------------------------------------------------------------------------------------------

NAMES = ["a/t.csv", "B.XLSX", "c.vision.json", "d.vision.JSON", "e.json", "f.htm", "g.docx", "h.tar.gz", "noext", "i.PDF", "j.jpeg", "k.xls", ".csv"]


@query("SELECT n_nationkey, name AS file, CASE WHEN lower(name) LIKE '%.vision.json' THEN 'vision' ELSE CASE lower(regexp_extract(name, '(\\.[^./]*)$', 1)) WHEN '.csv' THEN 'spreadsheet' WHEN '.xlsx' THEN 'spreadsheet' WHEN '.xls' THEN 'spreadsheet' WHEN '.htm' THEN 'html' WHEN '.docx' THEN 'word' WHEN '.pdf' THEN 'pdf' WHEN '.jpeg' THEN 'image' END END AS format"
       f" FROM (SELECT n_nationkey, {S.pick(NAMES, 'n_nationkey', False)} AS name FROM nation)")  # fmt: skip
def source_formats(spark, d):
    names = spark.sql(f"SELECT n_nationkey, {S.pick(NAMES, 'n_nationkey', True)} AS file FROM {{t}}", t=read(spark, d, "nation"))
    return names.select("n_nationkey", "file", files.format_of("file").alias("format"))


@query("""
WITH p AS (SELECT p_partkey AS k, p_name, p_brand FROM part)
SELECT 'd/' || k || '.csv' AS file, 'sheet' AS kind, '{"sheet": "' || k || '"}' AS location, CAST(1 AS INTEGER) AS row_no, CASE k % 3 WHEN 0 THEN '名称|地址|' ELSE 'name|address|' END AS cells, 'ready' AS status FROM p
UNION ALL SELECT 'd/' || k || '.csv', 'sheet', '{"sheet": "' || k || '"}', 2, p_name || ', x|"' || p_brand || '"|007', 'ready' FROM p
UNION ALL SELECT 'd/' || k || '.csv', 'sheet', '{"sheet": "' || k || '"}', 3, 'one' || chr(10) || 'two||', 'ready' FROM p""")
def csv_cells(spark, d):
    """CSV files: GB18030 and UTF-8 with and without a mark, quotes, lines in cells, short rows, text that looks like numbers."""
    k = F.col("p_partkey")
    head = F.when(k % 3 == 0, F.unhex(F.lit("C3FBB3C62CB5D8D6B70A"))).when(k % 3 == 1, F.unhex(F.lit("EFBBBF6E616D652C616464726573730A"))).otherwise(F.unhex(F.lit("6E616D652C616464726573730A")))
    body = F.concat(F.lit('"'), F.col("p_name"), F.lit(', x","""'), F.col("p_brand"), F.lit('""",007\r\n\r\n"  one \n\n two"\n'))
    rows = read(spark, d, "part").select(F.concat(F.lit("d/"), k.cast("string"), F.lit(".csv")).alias("path"), F.concat(head, body.cast("binary")).alias("content"))
    return files.cells(rows).select("file", "kind", "location", "row_no", F.array_join("cells", "|").alias("cells"), "status")


@query("""
SELECT CAST(p_partkey AS VARCHAR) || '.html' AS file, 'table' AS kind, '{"table_index": 1}' AS location, CAST(1 AS INTEGER) AS row_no, 'A name|A place' AS cells, 'ready' AS status, '' AS error FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT CAST(p_partkey AS VARCHAR) || '.html', 'table', '{"table_index": 1}', 2, p_name || '|' || p_brand, 'ready', '' FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT CAST(p_partkey AS VARCHAR) || '.html', 'table', '{"table_index": 1}', 3, p_name || '|x', 'ready', '' FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT CAST(p_partkey AS VARCHAR) || '.html', 'table', '{"table_index": 2}', 1, 'é中', 'ready', '' FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT CAST(p_partkey AS VARCHAR) || '.html', NULL, NULL, 0, NULL, 'manual_review', '' FROM part WHERE p_partkey % 3 = 1
UNION ALL SELECT CAST(p_partkey AS VARCHAR) || '.txt', NULL, NULL, 0, NULL, 'error', '不支持的来源格式：' || p_partkey || '.txt' FROM part WHERE p_partkey % 3 = 2""")
def html_cells(spark, d):
    """HTML tables with heads of two rows and spans, pages without tables, files of other kinds."""
    k = F.col("p_partkey")
    table = F.concat(
        F.lit("<table><thead><tr><th colspan=2>A</th></tr><tr><th>name</th><th>place</th></tr></thead><tr><td rowspan=2> "), F.col("p_name"), F.lit("</td><td>"), F.col("p_brand"), F.lit("</td></tr><tr><td>x<script>y</script></td></tr></table><table></table><table><tr><td>é中"),
    )
    body = F.when(k % 3 == 0, table).otherwise("<p>none</p>")
    name = F.concat(k.cast("string"), F.when(k % 3 == 2, ".txt").otherwise(".html"))
    return files.cells(read(spark, d, "part").select(name.alias("path"), body.cast("binary").alias("content"))).select("file", "kind", "location", F.coalesce("row_no", F.lit(0)).alias("row_no"), F.array_join("cells", "|").alias("cells"), "status", F.coalesce("error", F.lit("")).alias("error"))


@query("""
WITH p AS (SELECT p_partkey AS k, p_name, p_brand FROM part)
SELECT k || '.vision.json' AS file, '{"page": 2}' AS location, CAST(1 AS INTEGER) AS row_no, p_name || '||5' AS cells, 'ready' AS status, '' AS error FROM p WHERE k % 4 < 2
UNION ALL SELECT k || '.vision.json', '{"page": 2}', 2, 'a b', 'ready', '' FROM p WHERE k % 4 < 2
UNION ALL SELECT k || '.vision.json', NULL, 0, NULL, 'vision_result_empty', '' FROM p WHERE k % 4 = 2
UNION ALL SELECT k || '.vision.json', NULL, 0, NULL, 'error', '视觉识别文件必须是 vision_source_result JSON' FROM p WHERE k % 4 = 3""")
def vision_cells(spark, d):
    """Recognised pages as tables."""
    k = F.col("p_partkey")
    full = F.concat(F.lit('{"stage":"vision_source_result","pages":[{"page":1,"rows":[]},{"page":2,"rows":[["'), F.col("p_name"), F.lit('",null,5],["a  b"],"odd"]}]}'))
    body = F.when(k % 4 < 2, full).when(k % 4 == 2, '{"stage":"vision_source_result","pages":[]}').otherwise('{"stage":"other","pages":[]}')
    rows = read(spark, d, "part").select(F.concat(k.cast("string"), F.lit(".vision.json")).alias("path"), body.cast("binary").alias("content"))
    return files.cells(rows).select("file", "location", F.coalesce("row_no", F.lit(0)).alias("row_no"), F.array_join("cells", "|").alias("cells"), "status", F.coalesce("error", F.lit("")).alias("error"))


@query("""
SELECT 'f' || s_nationkey AS file, CAST(1 AS INTEGER) AS row_no, '编号|名称|链接' AS cells FROM supplier GROUP BY 1
UNION ALL SELECT 'f' || s_nationkey, CAST(1 + row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS INTEGER), s_suppkey || '|' || s_name || ' <&>|https://e.org/' || s_suppkey || ' | x' FROM supplier""")
def workbook_round_trip(spark, d):
    """Workbooks written for each nation's suppliers, and read again as cells."""

    def write(table):
        import pyarrow as pa

        rows = sorted(zip(table["s_suppkey"].to_pylist(), table["s_name"].to_pylist(), strict=True))
        data = sinks.workbook_bytes([("s", ["编号", "名称", "链接"], [[k, f"{n} <&>", f"https://e.org/{k} | x"] for k, n in rows], [8, 20, 30])])
        return pa.table({"path": [f"f{table['s_nationkey'][0].as_py()}.xlsx"], "content": [data]})

    books = read(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name", "s_nationkey").groupBy("s_nationkey").applyInArrow(write, "path string, content binary")
    return files.cells(books).select(F.regexp_replace("file", r"\.xlsx$", "").alias("file"), "row_no", F.array_join("cells", "|").alias("cells"))


@query("""
WITH p AS (SELECT page_id AS k, url, octet_length(encode(html)) AS n FROM pages)
SELECT 'z' || k AS archive, 'a/' || k || '.html' AS path, CAST(n AS BIGINT) AS size, 'note.txt' AS skipped, '' AS error FROM p WHERE k % 5 > 2
UNION ALL SELECT 'z' || k, 'b.csv', CAST(length(url) AS BIGINT), 'note.txt', '' FROM p WHERE k % 5 > 2
UNION ALL SELECT 'z' || k, NULL, 0, NULL, CASE k % 5 WHEN 0 THEN 'zip 成员路径非法：../' || k || '.html' WHEN 1 THEN '不是合法 zip 压缩包' ELSE '压缩包内没有可读取的来源文件' END FROM p WHERE k % 5 <= 2""")
def archive_members(spark, d):
    """Members of archives: kept ones, junk and other kinds left out; paths that lead out, other bytes, nothing to read."""

    @F.pandas_udf("binary")
    def pack(keys: pd.Series, urls: pd.Series, pages: pd.Series) -> pd.Series:
        out = []
        for k, url, page in zip(keys, urls, pages, strict=True):
            data = io.BytesIO()
            with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
                if k % 5 != 2:
                    z.writestr(f"../{k}.html" if k % 5 == 0 else f"./a//{k}.html", page)
                    z.writestr("b.csv", url)
                    z.writestr("folder/", "")
                z.writestr("__MACOSX/._b.csv", "junk")
                z.writestr("note.txt", "other")
            out.append(b"other bytes" if k % 5 == 1 else data.getvalue())
        return pd.Series(out)

    rows = read(spark, d, "pages").select(F.concat(F.lit("z"), F.col("page_id").cast("string")).alias("path"), pack("page_id", "url", "html").alias("content"))
    return files.unpacked(rows).select("archive", "path", F.coalesce("size", F.lit(0)).alias("size"), F.array_join("skipped", ",").alias("skipped"), F.coalesce("error", F.lit("")).alias("error"))


@query("""
SELECT 'f' || p_size AS file, CAST(1 AS INTEGER) AS row_no, '序号|学校|地址|电话' AS cells FROM part GROUP BY 1
UNION ALL SELECT 'f' || p_size, CAST(1 + row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS INTEGER), CASE WHEN p_partkey % 2 = 0 THEN p_partkey || '|' || p_name || '（a）|' || p_brand || '|' ELSE '|第一小学|x|' END FROM part""")
def recognised_blocks(spark, d):
    """Tables of recognised blocks under one header; rows that lack their number get a blank one."""
    k = F.col("p_partkey")
    head = "<table><tr><td>序号</td><td>学校</td><td>地址</td><td>电话</td></tr>"
    row = F.when(k % 2 == 0, F.concat(F.lit("<tr><td>"), k.cast("string"), F.lit("</td><td>"), F.col("p_name"), F.lit("(a)</td><td>"), F.col("p_brand"), F.lit("</td></tr>"))).otherwise("<tr><td>第一小学</td><td> x </td></tr>")
    blocks = read(spark, d, "part").select(F.concat(F.lit("f"), F.col("p_size").cast("string")).alias("file"), k.alias("pos"), F.lit("table").alias("type"), F.concat(F.lit(head), row, F.lit("</table>")).alias("table_body"))
    return files.block_rows(blocks).select("file", "row_no", F.array_join("cells", "|").alias("cells"))


@query("""
SELECT 'f' || p_size AS file, CAST(p_partkey % 4 + 1 AS INTEGER) AS page, max(CAST(p_partkey % 3 = 0 AS INT)) = 1 AS has_table, min_by(p_name || '；b', p_partkey) FILTER (p_partkey % 3 = 0 AND p_partkey % 2 = 0) AS caption FROM part GROUP BY 1, 2""")
def recognised_pages(spark, d):
    """Which pages hold tables, and the first caption of each."""
    k = F.col("p_partkey")
    caption = F.when(k % 2 == 0, F.array(F.concat(F.lit(" "), F.col("p_name")), F.lit(""), F.lit(" b "))).otherwise(F.array(F.lit(" ")))
    blocks = read(spark, d, "part").select(F.concat(F.lit("f"), F.col("p_size").cast("string")).alias("file"), k.alias("pos"), F.when(k % 3 == 0, "table").otherwise("text").alias("type"), (k % 4).cast("int").alias("page_idx"), caption.alias("table_caption"))
    return files.page_summary(blocks)


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || ',x y' WHEN 1 THEN '1' ELSE NULL END AS first, CASE p_partkey % 4 WHEN 0 THEN CAST(2 AS INTEGER) WHEN 1 THEN 1 ELSE 0 END AS n FROM part")
def model_answers(spark, d):
    """Rows in a model's answer: fenced, in prose, broken, absent."""
    k = F.col("p_partkey")
    answer = F.when(k % 4 == 0, F.concat(F.lit('Here it is:\n```json\n[["'), F.col("p_name"), F.lit('", " x  y"], ["z"]]\n```\ndone'))).when(k % 4 == 1, "[[1]]").when(k % 4 == 2, "no rows").otherwise('[["a"')
    rows = files.model_rows(answer)
    return read(spark, d, "part").select("p_partkey", F.array_join(F.get(rows, F.lit(0)), ",").alias("first"), F.size(rows).alias("n")).withColumn("n", F.greatest(F.coalesce("n", F.lit(0)), F.lit(0)))


@query(f"""
WITH t AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '{WS}+', ' ', 'g')) AS v FROM documents),
p AS (SELECT CAST(doc_id % 97 AS VARCHAR) AS file, doc_id AS page, CAST(length(v) AS BIGINT) AS n, CAST(doc_id % 3 AS INTEGER) AS image_count, left(v, 400) AS text_preview FROM t),
f AS (SELECT file, CASE WHEN sum(n) < greatest(100, count(*) * 5) THEN 'needs_vision' ELSE 'ready' END AS inspection_status FROM p GROUP BY 1)
SELECT p.file, page, n AS text_character_count, image_count, text_preview, inspection_status, CASE WHEN inspection_status = 'needs_vision' THEN 'no_native_text' ELSE '' END AS vision_reason FROM p JOIN f USING (file)""")
def pdf_page_report(spark, d):
    """What is said of every page of a PDF."""
    pages = read(spark, d, "documents").select((F.col("doc_id") % 97).cast("string").alias("file"), F.col("doc_id").alias("page"), "text", (F.col("doc_id") % 3).cast("int").alias("image_count"))
    return fetched.pdf_report(pages, files.pdf_verdict(pages))


# -- addresses and records ------------------------------------------------------------------------------


@query("""
SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN '每条地址记录必须包含非空 place_name' WHEN 1 THEN 'source_nature 必须是 web_search、government_information 或 map_search' WHEN 2 THEN 'address_mode 必须是 web_search、government_list 或 map_search' WHEN 3 THEN '每条地址记录必须包含非空 source_reference' ELSE '' END AS error,
  CASE c_custkey % 7 WHEN 4 THEN 'government_list' WHEN 5 THEN 'map_search' WHEN 6 THEN 'web_search' END AS mode FROM customer""")
def record_validation(spark, d):
    """What is wrong with address records, and the mode of good ones."""
    k = F.col("c_custkey") % 7
    rows = read(spark, d, "customer").select(
        "c_custkey", F.when(k == 0, " 　").otherwise("n").alias("place_name"), F.lit(None).cast("string").alias("original_address"), F.when(k == 1, "rumour").when(k == 4, "government_information").otherwise("web_search").alias("source_nature"),
        F.when(k == 2, "none").when(k == 5, "map_search").alias("address_mode"), F.when(k == 3, "").otherwise("x").alias("source_reference"),
    )
    good, bad = split_invalid(rows)
    mode = A.mode_of(F.col("address_mode"), F.col("source_nature"))
    return good.select("c_custkey", F.lit("").alias("error"), mode.alias("mode")).unionByName(bad.select("c_custkey", F.col("validation_error").alias("error"), F.lit(None).cast("string").alias("mode")))


@query("""
SELECT n_nationkey, CASE n_nationkey % 6 WHEN 0 THEN '城市上下文阶段必须是 city_context' WHEN 1 THEN '城市上下文缺少非空 input_city' WHEN 2 THEN '城市上下文缺少非空 city_name' WHEN 3 THEN '城市上下文中的 province_name 不能为空字符串' WHEN 4 THEN '城市上下文中的 subdivisions 必须是数组' ELSE '' END AS error FROM nation""")
def context_validation(spark, d):
    k = F.col("n_nationkey") % 6
    rows = read(spark, d, "nation").select(
        "n_nationkey", F.when(k == 0, "other").otherwise("city_context").alias("stage"), F.when(k == 1, " ").otherwise("杭州").alias("input_city"), F.when(k != 2, "杭州市").alias("city_name"),
        F.when(k == 3, "").when(k == 5, F.lit(None)).otherwise("浙江省").alias("province_name"), F.when(k != 4, F.array().cast(city.SUBDIVISIONS)).alias("subdivisions"),
    )
    return rows.select("n_nationkey", city.context_error().alias("error"))


_TOWNS = ["杭州", "宁波市", "兴安", "阿里", "nowhere", "苏州"]


@query("""
SELECT CASE n WHEN '杭州' THEN '杭州' ELSE n END AS input_city, CASE n WHEN '杭州' THEN '杭州市' WHEN '宁波市' THEN '宁波市' WHEN '兴安' THEN '兴安盟' WHEN '阿里' THEN '阿里地区' WHEN '苏州' THEN '苏州市' END AS city_name,
  CASE n WHEN '杭州' THEN '浙江省' WHEN '宁波市' THEN '浙江省' WHEN '兴安' THEN '内蒙古自治区' WHEN '阿里' THEN '西藏自治区' WHEN '苏州' THEN '江苏省' END AS province_name,
  CASE n WHEN '杭州' THEN '西湖区/1/district,拱墅区/2/district' WHEN '宁波市' THEN '镇海区/7/district' ELSE '' END AS units,
  CASE n WHEN '兴安' THEN '高德服务错误：busy' WHEN '阿里' THEN '高德未唯一匹配目标城市：阿里地区' WHEN 'nowhere' THEN '城市不在固定目录中：nowhere' WHEN '苏州' THEN '高德未返回目标城市的下一级行政区：苏州市' ELSE '' END AS error
FROM (VALUES ('杭州'), ('宁波市'), ('兴安'), ('阿里'), ('nowhere'), ('苏州')) v(n)""")
def city_contexts(spark, d):
    """Contexts with subdivisions: two steps for a city that stands for another, errors of the service and of names."""
    unit = '{"name":"%s","adcode":"%s","level":"%s"}'
    node = lambda name, *kids: '{"districts":[{"name":"%s","districts":[%s]}]}' % (name, ",".join(unit % k for k in kids))  # noqa: E731, UP031
    answers = [
        ("杭州市", node("杭州市", ("西湖区", "1", "district"), ("拱墅区", "2", "district"), ("西湖区", "1", "district")), ""), ("宁波市", node("宁波市", ("甬市", "5", "city")), ""), ("甬市", node("甬市", ("镇海区", "7", "district")), ""),
        ("兴安盟", "{}", "高德服务错误：busy"), ("苏州市", node("苏州市"), ""),
    ]
    names = spark.createDataFrame([(n,) for n in _TOWNS], "n string")
    found = city.city_contexts(names, "n", city.catalog_frame(spark, S.CATALOG), spark.createDataFrame(answers, "asked_city string, payload string, error string"))
    units = F.array_join(F.transform("subdivisions", lambda s: F.concat_ws("/", s["name"], s["adcode"], s["level"])), ",")
    return found.select("input_city", "city_name", "province_name", units.alias("units"), "error")


@query("""
SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN c_custkey || '号' WHEN 1 THEN '杭州' || c_custkey ELSE '' END AS without_city, '页面访问失败：a | b' || c_custkey AS page_error, 'ab' || c_custkey || 'C' AS label FROM customer""")
def text_helpers(spark, d):
    k = F.col("c_custkey").cast("string")
    address = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("杭州市"), k, F.lit("号"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("杭州"), k)).otherwise("杭州市")
    return read(spark, d, "customer").select(
        F.col("c_custkey").alias("k"), X.drop_prefix(address, F.lit("杭州市")).alias("without_city"), X.error_line(F.concat(F.lit(" a \t\n\n b"), k, F.lit("\nb"), k)).alias("page_error"), X.label_key(F.concat(F.lit(" （ab）："), k, F.lit("_C "))).alias("label")
    )


# -- links, fetched pages, downloads --------------------------------------------------------------------


@query("""
WITH s AS (SELECT s_suppkey AS k, 'https://www.e' || (s_suppkey % 3) || '.org' AS site FROM supplier)
SELECT k AS page, 'T ' || k AS page_title, site || '/a/' || k || '.html' AS url, 'one' AS title FROM s WHERE k % 3 = 1
UNION ALL SELECT k, 'T ' || k, 'http://sub.e1.org/a/' || k, '' FROM s""")
def directory_links_of_a_domain(spark, d):
    """Links under one domain that fit a pattern, each address once, relative ones by the page's own address."""
    k = F.col("s_suppkey").cast("string")
    page = F.concat(F.lit("<title>T "), k, F.lit("</title><a href='/a/"), k, F.lit(".html'>one</a><a href='../a/"), k, F.lit(".html'>again</a><a href='mailto:x'>m</a><a href='http://sub.e1.org/a/"), k, F.lit("'></a><a href='/b/1'>other</a><a>none</a><a href='http://note1.org/a/1'>no</a>"))
    pages = read(spark, d, "supplier").select(F.col("s_suppkey").alias("page"), F.concat(F.lit("https://www.e"), (F.col("s_suppkey") % 3).cast("string"), F.lit(".org/list/i.html")).alias("final_url"), page.alias("html"))
    return links.directory_links(pages, "https://e1.org/", "/a/").select("page", "page_title", "url", "title")


@query("""
SELECT count(*) AS page_count, CAST(sum(CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey % 4 ELSE 0 END) AS BIGINT) AS link_count, count(*) FILTER (s_suppkey % 5 = 0 OR s_suppkey % 7 = 0) AS error_count FROM supplier""")
def directory_metrics(spark, d):
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("page"))
    fetched_pages = s.filter("page % 5 <> 0").select("page", F.when(F.col("page") % 7 == 0, "down").alias("error"))
    found = s.filter("page % 5 <> 0").select("page", F.explode(F.sequence(F.lit(0), F.col("page") % 4)).alias("url")).filter("url > 0")
    return links.link_metrics(s, fetched_pages, found)


@query("""
WITH s AS (SELECT s_suppkey AS k FROM supplier)
SELECT k AS page, 'https://e.org/x/' || k || '.HTM' AS url, 'Ti' AS title, k || '.HTM' AS file FROM s
UNION ALL SELECT k, 'https://e.org/d/y?p=' || k, 'b', 'y.html' FROM s
UNION ALL SELECT k, 'https://e.org/?q=' || k, 'c', 'page_3.html' FROM s""")
def linked_pages_saved(spark, d):
    """Pages that a selector's links lead to on exactly one host, and the files that they are saved as."""
    k = F.col("s_suppkey").cast("string")
    page = F.concat(F.lit('<base href="https://e.org/x/"><ul class="l"><li><a title=" Ti " href="'), k, F.lit('.HTM">a</a></li><li><a href="/d/y?p='), k, F.lit('">b</a></li><li><a href="/?q='), k, F.lit('">c</a></li><li><a href="/?q='), k, F.lit('">again</a></li><li><a href="https://www.e.org/z">z</a></li><li><a href="ftp://e.org/">f</a></li></ul><a href="/other">o</a>'))
    pages = read(spark, d, "supplier").select(F.col("s_suppkey").alias("page"), page.alias("html"))
    return links.linked_pages(pages, "ul.l a", "e.org").select("page", "url", "title", "file")


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '输入必须是 source_downloads JSON' WHEN 1 THEN '清单网址无效' WHEN 2 THEN '清单缺少文件名' ELSE '' END AS error FROM part""")
def manifest_validation(spark, d):
    k = F.col("p_partkey") % 4
    rows = read(spark, d, "part").select("p_partkey", F.when(k == 0, "x").otherwise("source_downloads").alias("stage"), F.when(k == 1, "ftp://e.org/").otherwise(" HTTPS://e.org/a ").alias("url"), F.when(k == 2, " ").otherwise("a.csv").alias("file"))
    return rows.select("p_partkey", links.manifest_error("source_downloads", file="file").alias("error"))


@query("""
SELECT count(*) AS item_count, count(*) FILTER (p_partkey % 5 NOT IN (0, 1)) AS downloaded_count, count(*) FILTER (p_partkey % 5 = 2) AS archive_count, CAST(coalesce(sum(CASE WHEN p_partkey % 5 = 2 THEN 2 ELSE 0 END), 0) AS BIGINT) AS extracted_count, count(*) FILTER (p_partkey % 5 IN (0, 1)) AS error_count FROM part""")
def download_report(spark, d):
    k = F.col("p_partkey") % 5
    p = read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("file"), k.alias("k"))
    results = p.filter("k <> 0").select("file", F.when(F.col("k") != 1, "https://e.org/").alias("final_url"), F.lit(1).alias("size_bytes"), F.when(F.col("k") == 2, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("extracted"), F.when(F.col("k") == 1, "HTTP 404").alias("error"))
    return links.download_metrics(p.select("file"), results).withColumn("extracted_count", F.col("extracted_count").cast("long"))


@query("""
WITH c AS (SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN 'HTTPS://u:p@WWW.E1.org.:8443/x?y#z' WHEN 1 THEN 'http://note1.org/' WHEN 2 THEN 'ftp://e1.org/' WHEN 3 THEN 'http://[::1]/e1.org' ELSE NULL END AS url FROM customer)
SELECT k, CASE k % 5 WHEN 0 THEN 'www.e1.org.' WHEN 1 THEN 'note1.org' WHEN 2 THEN 'e1.org' WHEN 3 THEN '::1' ELSE '' END AS host, k % 5 = 0 AS listed, CASE WHEN k % 2 = 0 THEN 'gb2312' ELSE '' END AS charset FROM c""")
def url_domain_checks(spark, d):
    k = F.col("c_custkey") % 5
    url = F.when(k == 0, "HTTPS://u:p@WWW.E1.org.:8443/x?y#z").when(k == 1, "http://note1.org/").when(k == 2, "ftp://e1.org/").when(k == 3, "http://[::1]/e1.org")
    kind = F.when(F.col("c_custkey") % 2 == 0, 'text/html; Charset = "gb2312"').otherwise("text/html")
    domains = F.transform(F.array(F.lit("https://E1.org/start"), F.lit("")), U.domain_of)
    return read(spark, d, "customer").select(F.col("c_custkey").alias("k"), U.raw_host(url).alias("host"), U.url_in_domains(url, domains).alias("listed"), U.charset_of(kind).alias("charset"))


def fetch_rows(spark: SparkSession, d: str) -> DataFrame:
    """A fetch table of pages: arrived, moved, refused, failed, and some without an address."""
    k = F.col("page_id")
    url = F.concat(F.lit("https://www.e.org/p/"), k.cast("string"))
    attempt = lambda method, good, status: F.struct(F.lit(method).alias("method"), url.alias("url"), url.alias("final_url"), F.lit(status).alias("http_status"), F.lit(good).alias("success"), F.lit("").alias("error"), F.lit(5).cast("long").alias("elapsed_ms"))
    part = F.concat(F.lit("<title> T  "), k.cast("string"), F.lit("</title><p>地址：杭州市西湖区文三路"), k.cast("string"), F.lit("号</p><a href='/a'>  one </a>"))
    return read(spark, d, "pages").select(
        k.alias("page_id"), url.alias("url"), F.when(k % 6 == 5, "<title>none</title><p>x</p>").otherwise(part).alias("html"), F.when(k % 6 == 1, "https://other.test/").when(k % 6 != 3, url).alias("final_url"), F.when(k % 6 == 2, 404).when(k % 6 != 3, 200).alias("http_status"),
        F.when(k % 6 == 3, "timed\n out").alias("error"), F.array(attempt("urllib", False, 500), attempt("curl", True, 200)).alias("attempts"), k.alias("fetched_at"),
    )


@query("""
WITH p AS (SELECT page_id AS k, 'https://www.e.org/p/' || page_id AS url FROM pages)
SELECT CASE WHEN k % 6 = 4 THEN 'https://else.test/' || k ELSE url END AS requested_url, CASE WHEN k % 6 IN (0, 2, 5) THEN url ELSE '' END AS final_url, CASE k % 6 WHEN 0 THEN 200 WHEN 5 THEN 200 WHEN 2 THEN 404 ELSE 0 END AS http_status,
  CASE WHEN k % 6 IN (0, 5) THEN 'ok' WHEN k % 6 = 2 THEN 'http_error' ELSE 'error' END AS page_status, CASE WHEN k % 6 = 5 THEN 'none' WHEN k % 6 IN (0, 2) THEN 'T ' || k ELSE '' END AS title, 'e.org' AS domains,
  CASE WHEN k % 6 = 0 THEN '杭州市西湖区文三路' || k || '号' ELSE '' END AS addresses, CASE WHEN k % 6 = 0 THEN 'one=https://www.e.org/a' ELSE '' END AS links,
  CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN '页面访问失败：跳转后的最终 URL 不属于已确认的官方域名：https://other.test/' WHEN 2 THEN '页面返回 HTTP 404' WHEN 3 THEN '页面访问失败：timed | out' WHEN 4 THEN '页面访问失败：请求 URL 或官方域名无效' ELSE '未发现可靠地址证据' END AS warnings,
  CAST(CASE WHEN k % 6 = 4 THEN 0 ELSE 2 END AS INTEGER) AS n_attempts FROM p""")
def fetched_page_results(spark, d):
    """Results of requested pages: domains checked before and after, statuses, evidence, links, warnings."""
    table = fetch_rows(spark, d)
    k = F.col("page_id")
    requests = table.select(F.when(k % 6 == 4, F.concat(F.lit("https://else.test/"), k.cast("string"))).otherwise(F.col("url")).alias("url"), F.array(F.lit("E.org."), F.lit("https://e.org"), F.lit("")).alias("official_domains"))
    found = fetched.official_pages(requests, table, [])
    return found.select(
        "requested_url", "final_url", F.coalesce("http_status", F.lit(0)).alias("http_status"), "page_status", "title", F.array_join("official_domains", ",").alias("domains"), F.array_join("address_evidence.address_text", ",").alias("addresses"),
        F.array_join(F.transform("links", lambda a: F.concat(a["text"], F.lit("="), a["url"])), ",").alias("links"), F.array_join("warnings", ",").alias("warnings"), F.size("access_attempts").alias("n_attempts"),
    )


@query("SELECT 'www.e.org' AS host, 'curl' AS method")
def fetch_methods(spark, d):
    return fetched.host_methods(fetch_rows(spark, d))


@query("""
WITH p AS (SELECT page_id AS k, url, CAST(octet_length(encode(html)) AS BIGINT) AS n FROM pages)
SELECT CASE k % 6 WHEN 0 THEN 'a/../../' || k || '.html' WHEN 1 THEN 'z/' || k || '.ZIP' WHEN 2 THEN 'y' || k || '.zip' ELSE 'a/../' || k || '.html' END AS file, 'https://www.e.org/' || k AS url,
  CASE k % 6 WHEN 0 THEN '输出文件越出目标目录：a/../../' || k || '.html' WHEN 2 THEN '不是合法 zip 压缩包' WHEN 3 THEN 'HTTP 500' WHEN 4 THEN '下载结果域名不在允许范围内：https://other.test/' ELSE '' END AS error,
  CASE k % 6 WHEN 5 THEN n ELSE 0 END AS plain_bytes, CASE k % 6 WHEN 1 THEN 'z/a/' || k || '.html,z/b.csv' ELSE '' END AS extracted, CASE k % 6 WHEN 1 THEN 'note.txt' ELSE '' END AS skipped FROM p""")
def downloaded_files(spark, d):
    """A download manifest against what came: paths that lead out, failures, other domains, archives taken apart."""

    @F.pandas_udf("binary")
    def pack(keys: pd.Series, pages: pd.Series) -> pd.Series:
        out = []
        for k, page in zip(keys, pages, strict=True):
            data = io.BytesIO()
            with zipfile.ZipFile(data, "w") as z:
                z.writestr("b.csv", "x")
                z.writestr(f"a/{k}.html", page)
                z.writestr("note.txt", "other")
            out.append(data.getvalue())
        return pd.Series(out)

    k = F.col("page_id")
    kind, name, url = k % 6, k.cast("string"), F.concat(F.lit("https://www.e.org/"), k.cast("string"))
    file = F.when(kind == 0, F.concat(F.lit(" a/../../"), name, F.lit(".html"))).when(kind == 1, F.concat(F.lit("z/"), name, F.lit(".ZIP"))).when(kind == 2, F.concat(F.lit("y"), name, F.lit(".zip"))).otherwise(F.concat(F.lit("a/../"), name, F.lit(".html")))
    pages = read(spark, d, "pages")
    came = pages.withColumn("zip", pack("page_id", "html")).select(url.alias("url"), F.when(kind == 1, F.col("zip")).otherwise(F.col("html").cast("binary")).alias("content"), F.when(kind == 4, "https://other.test/").otherwise(url).alias("final_url"), F.lit(200).alias("http_status"), F.when(kind == 3, "HTTP 500").alias("error"))
    found = fetched.downloads(pages.select(file.alias("file"), url.alias("url")), came, "https://E.org/")
    plain = F.when(~F.lower("file").endswith(".zip"), F.col("size_bytes"))
    return found.select("file", "url", "error", F.coalesce(plain, F.lit(0)).alias("plain_bytes"), F.array_join("extracted", ",").alias("extracted"), F.array_join("skipped", ",").alias("skipped"))


# -- connectors, with transports that answer from the tables --------------------------------------------


def nations(spark: SparkSession, d: str) -> list[tuple[int, str]]:
    return [(r.n_nationkey, r.n_name) for r in read(spark, d, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey").collect()]


@query("""
SELECT 'https://e.org/' || n_nationkey AS url, CASE WHEN n_nationkey % 3 = 2 THEN '' ELSE n_name END AS content, CASE WHEN n_nationkey % 3 = 2 THEN 'refused; gone' ELSE '' END AS error,
  CASE n_nationkey % 3 WHEN 0 THEN 'urllib:true' WHEN 1 THEN 'urllib:false,curl:true' ELSE 'urllib:false,curl:false' END AS attempts FROM nation""")
def fetch_attempts(spark, d):
    """Pages through transports in turn, every attempt kept, paced per host."""
    names = dict(nations(spark, d))

    def via(rest: set[int], why: str):
        def get(url: str):
            k = int(url.rsplit("/", 1)[1])
            if k % 3 not in rest:
                raise OSError(why)
            return names[k].encode(), url, 200, ""

        return get

    table = connectors.fetch_table(spark, [f"https://e.org/{k}" for k in names], {"urllib": via({0}, "refused"), "curl": via({0, 1}, "gone")}, pace=connectors.Pace(2, 0))
    shown = F.array_join(F.transform("attempts", lambda a: F.concat(a["method"], F.lit(":"), a["success"].cast("string"))), ",")
    return table.select("url", F.coalesce(F.col("content").cast("string"), F.lit("")).alias("content"), "error", shown.alias("attempts"))


@query("""
SELECT 'geocodes' AS kind, n_name AS asked, CASE n_nationkey % 4 WHEN 3 THEN '' ELSE 'at ' || n_name END AS found, CASE n_nationkey % 4 WHEN 3 THEN '高德服务错误：BAD' ELSE '' END AS error, CAST(CASE n_nationkey % 4 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END AS INTEGER) AS attempts FROM nation
UNION ALL SELECT 'pois', n_name, CASE n_nationkey % 4 WHEN 3 THEN '' ELSE 'at ' || n_name END, CASE n_nationkey % 4 WHEN 3 THEN '高德服务错误：BAD' ELSE '' END, CASE n_nationkey % 4 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END FROM nation
UNION ALL SELECT 'nokey', n_name, '', '未配置 AMAP_KEY', 0 FROM nation""")
def service_answers(spark, d):
    """Map answers as tables: values that are lists, busy services and lost connections tried again, other errors not."""
    pairs = nations(spark, d)
    turns: dict[str, int] = {}

    def ask(url: str):
        query_ = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(url).query))
        name = query_.get("address") or query_["keywords"]
        k = next(i for i, n in pairs if n == name)
        turns[url] = turns.get(url, 0) + 1
        if k % 4 == 1 and turns[url] == 1:
            return json.dumps({"status": "0", "infocode": "10021", "info": "busy"}).encode(), url, 200, ""
        if k % 4 == 2 and turns[url] < 3:
            raise OSError("reset")
        if k % 4 == 3:
            return json.dumps({"status": "0", "infocode": "10001", "info": "BAD"}).encode(), url, 200, ""
        row = {"formatted_address": ["", f" at {name} "], "name": f"at {name}", "city": [], "address": None}
        return json.dumps({"status": "1", "geocodes": [row, "odd"], "pois": [row]}).encode(), url, 200, ""

    kinds = {"geocodes": ("asked_address", "formatted_address"), "pois": ("asked_name", "name")}
    out = None
    for kind, key in (("geocodes", "k"), ("pois", "k"), ("nokey", "")):
        column, field = kinds.get(kind, kinds["pois"])
        table = answers_now(spark, "pois" if kind == "nokey" else kind, [(n, "c") for _, n in pairs], key, ask)
        rows = table.select(F.lit(kind).alias("kind"), F.col(column).alias("asked"), F.coalesce(F.get("candidates", F.lit(0))[field], F.lit("")).alias("found"), "error", "attempts")
        out = rows if out is None else out.unionByName(rows)
    return out


def answers_now(spark: SparkSession, kind: str, asked: list[tuple[str, str]], key: str, transport) -> DataFrame:
    """Service answers without limits or pauses."""
    return connectors.answers_table(spark, kind, asked, "https://map.test/v3", key, connectors.Window(0), transport, connectors.Retries((0, 0), 0))


@query("""
SELECT n_nationkey AS k, CASE n_nationkey % 3 WHEN 0 THEN 'url' WHEN 1 THEN 'upload' ELSE 'error' END AS way, CASE n_nationkey % 3 WHEN 2 THEN 'MinerU 解析失败：broken' ELSE '' END AS error, CASE n_nationkey % 3 WHEN 2 THEN '' ELSE '2:' || n_name || ',11:' || n_name END AS pages,
  '3' AS logins FROM nation""")
def recognition_runs(spark, d):
    """Documents through the recognition service: batches by address, uploads where it can't be read, failures, tokens."""
    out = []
    for k, name in nations(spark, d):
        calls: list[str] = []

        def post(path: str, payload: dict, calls=calls) -> dict:
            calls.append(path)
            inner = {"nonce": "n", "algorithm": "HmacSHA256"} if path == "/getSignature" else {"jwt": "t", "expiration": "2024-01-01 08:10:00", "refreshExpiration": "2024-01-01 09:00:00", "refreshJwt": "r"}
            return connectors.unwrapped({"msgCode": "10000", "data": {"msgCode": "10000", "data": inner}})

        now = [1704067200.0]
        session = connectors.Session("a", "b", post, lambda now=now: now[0])
        session.headers()
        session.token()
        now[0] += 700
        session.token()
        sent: list[bytes] = []

        def call(path: str, payload: dict | None, k=k) -> dict:
            if payload is not None:
                return {"batch_id": "up" if "file-urls" in path else "by", "file_urls": ["https://u/1", "https://u/2"]}
            failed = k % 3 == 2 or (k % 3 == 1 and path.endswith("/by"))
            why = "broken" if k % 3 == 2 else "-60008 read failed"
            return {"extract_result": [{"data_id": f"p{p:04d}", "state": "failed" if failed else "done", "err_msg": why, "full_zip_url": f"z{p}"} for p in (11, 2)]}

        def zipped(_: str, name=name) -> bytes:
            data = io.BytesIO()
            with zipfile.ZipFile(data, "w") as z:
                z.writestr("r_content_list.json", json.dumps([{"type": "text", "text": name}]))
            return data.getvalue()

        client = connectors.RecognitionClient(call, zipped, 0, 5, put=lambda _, data, sent=sent: sent.append(data))
        try:
            found = client.pages([11, 2, 2], "https://e.org/f.pdf", lambda entries, client=client: client.upload_pages("f.pdf", b"%PDF", entries))
            out.append((k, "upload" if sent else "url", "", ",".join(f"{p}:{b[0]['text']}" for p, b in found.items()), str(len(calls))))
        except connectors.RecognitionError as e:
            out.append((k, "error", str(e), "", str(len(calls))))
    return spark.createDataFrame(out, "k long, way string, error string, pages string, logins string").withColumn("k", F.col("k").cast("int"))


@query("""
SELECT n_nationkey AS k, CASE n_nationkey % 4 WHEN 0 THEN CAST(1704067200000 + n_nationkey * 1000 AS BIGINT) ELSE 0 END AS expires, CASE n_nationkey % 2 WHEN 0 THEN n_name ELSE '' END AS setting,
  n_nationkey % 5 = 0 AS fetch_failure, CASE n_nationkey % 3 WHEN 0 THEN 'OpenXLab 鉴权失败：no' WHEN 1 THEN 'OpenXLab 返回缺少 data' ELSE 'OpenXLab 返回缺少业务 data' END AS refusal FROM nation""")
def connector_values(spark, d):
    """Expirations, settings of a file, errors of the recognition service."""
    out = []
    for k, name in nations(spark, d):
        lines = f"\ufeff# comment\nOTHER=x\nKEY = '{name}'\n" if k % 2 == 0 else "#KEY=a\nKEYS=b\n"
        answer = ({"msgCode": "1", "msg": " no "}, {"msgCode": "10000"}, {"msgCode": "10000", "data": {"msgCode": "10000"}})[k % 3]
        try:
            refusal = str(connectors.unwrapped(answer))
        except connectors.RecognitionError as e:
            refusal = str(e)
        message = "URL Timeout" if k % 5 == 0 else "broken file"
        out.append((k, connectors.expiry(f"2024-01-01 08:00:{k:02d}" if k % 4 == 0 else "soon"), connectors.setting_in(lines, "KEY"), connectors.RecognitionClient.is_fetch_failure(message), refusal))
    return spark.createDataFrame(out, "k int, expires long, setting string, fetch_failure boolean, refusal string")


# -- results --------------------------------------------------------------------------------------------


@query("""
SELECT v AS violation, CAST(n AS BIGINT) AS n FROM (SELECT CAST(count(*) > 0 AND (min(c_custkey) <> 1 OR max(c_custkey) <> count(*)) AS INT) AS z, count(*) FILTER (c_custkey % 4 = 0) AS a, count(*) FILTER (c_custkey % 6 = 0) AS b, count(*) FILTER (c_custkey % 10 = 0) AS c FROM customer) CROSS JOIN LATERAL (VALUES ('序号不连续', z), ('空异常原因', a), ('空信息来源', b), ('日期格式', c)) t(v, n)""")
def abnormal_violations(spark, d):
    k = F.col("c_custkey")
    sheet = read(spark, d, "customer").select(k.alias("序号"), F.when(k % 4 == 0, " 　").otherwise("未找到").alias("异常原因"), F.when(k % 6 != 0, "https://e.org").alias("信息来源"), F.when(k % 10 == 0, "2024/05/01").otherwise("2024-05-01").alias("查询日期"))
    return output.abnormal_violations(sheet)


@query("""
SELECT r_regionkey AS k, '{"stage": "s", "city": "' || r_name || '", "passed": ' || CASE WHEN r_regionkey % 2 = 0 THEN 'true' ELSE 'false' END || ', "reason_count": ' || (r_regionkey % 2) || ', "output": "o/' || r_regionkey || '.json"}' AS summary, CASE WHEN r_regionkey % 2 = 0 THEN 'n=1' ELSE '' END AS checks,
  '编号,领域' AS headers, '8,12,20,14,42,14,16,50' AS main_widths, '8,12,20,40,50,14' AS abnormal_widths, r_regionkey % 3 = 0 AS linked FROM region""")
def quality_reports(spark, d):
    """Reports, their one-line summaries, and the layout of sheets."""
    rows = []
    for r in read(spark, d, "region").select("r_regionkey", "r_name").collect():
        reasons = ["missing"] if r.r_regionkey % 2 else []
        report = sinks.quality_report("s", r.r_name, [1], reasons, {"a": 1}, None if reasons else {"n": 1})
        spec = output.SheetSpec(("编号", "领域"), (12, 20), query_date=" 2024-05-01 ")
        widths = [",".join(map(str, w)) for w in (spec.main_widths, spec.abnormal_widths)]
        checks = ",".join(f"{a}={b}" for a, b in report.get("checks", {}).items())
        source = f"HTTP://e.org/{r.r_regionkey} | f" if r.r_regionkey % 3 == 0 else "f | HTTP://e.org"
        rows.append((r.r_regionkey, sinks.summary(report, f"o/{r.r_regionkey}.json"), checks, ",".join(spec.main_headers[1:3]), *widths, source))
    made = spark.createDataFrame(rows, "k int, summary string, checks string, headers string, main_widths string, abnormal_widths string, source string")
    return made.withColumn("linked", output.has_link("source")).drop("source")
