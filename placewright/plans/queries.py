"""Queries over the tables, one or more for each operator family, with DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewright.functions import address as A
from placewright.functions import text as X
from placewright.functions import urls as U
from placewright.operators import extract, links, match, output
from placewright.operators.city import catalog_frame, catalog_literals, resolve_city_names, subdivisions_of
from placewright.operators.normalize import foreign_campus, normalize_records, status_counts
from placewright.plans import samples as S
from placewright.sources import files
from placewright.sources.pages import item_count, key_values

WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def sql(spark: SparkSession, d: str, table: str, text: str) -> DataFrame:
    return spark.sql(text.replace(f"FROM {table}", "FROM {t}").replace("VARCHAR(20)", "STRING"), t=read(spark, d, table))


def contexts(spark: SparkSession) -> DataFrame:
    units = [(u, str(i), "district") for i, u in enumerate(S.UNITS)]
    return spark.createDataFrame([("city_context", "杭州", S.CITY, S.PROVINCE, units)], "stage string, input_city string, city_name string, province_name string, subdivisions array<struct<name:string,adcode:string,level:string>>")


def records(spark: SparkSession, d: str) -> DataFrame:
    df = sql(spark, d, "customer", S.records(True))
    return df.withColumn("attributes", F.when(F.col("unit") != "", F.create_map(F.lit("administrative_unit"), F.col("unit"))).otherwise(F.create_map().cast("map<string,string>"))).drop("unit")


def normalized(spark: SparkSession, d: str, keep: bool = False) -> DataFrame:
    return normalize_records(records(spark, d), contexts(spark), S.CATALOG, keep_context=keep)


# -- text and URLs --------------------------------------------------------------------------------------


@query(f"SELECT doc_id, md5(trim(regexp_replace(coalesce(text, ''), '{WS}+', ' ', 'g'))) AS text_md5, CAST(length(trim(regexp_replace(coalesce(text, ''), '{WS}+', ' ', 'g'))) AS BIGINT) AS n FROM documents")
def text_normalize_documents(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(X.squeeze("text")).alias("text_md5"), F.length(X.squeeze("text")).cast("long").alias("n"))


@query(rf"""
WITH l AS (SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(coalesce(text, ''), '[\x{{a0}}\x{{3000}}]', ' ', 'g'), '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]'),
  lambda x: regexp_replace(regexp_replace(x, '[ \t]+', ' ', 'g'), '^{WS}+|{WS}+$', '', 'g')), lambda x: x <> '') AS a FROM documents)
SELECT doc_id, md5(array_to_string(list_filter(a, lambda x, i: i = 1 OR x <> a[i - 1]), chr(10))) AS lines_md5 FROM l""")
def lines_dedupe_consecutive(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(X.page_lines("text")).alias("lines_md5"))


@query(f"SELECT doc_id, md5(array_to_string(list_filter(list_transform(string_split_regex(coalesce(text, ''), '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'), lambda x: trim(regexp_replace(x, '{WS}+', ' ', 'g'))), lambda x: x <> ''), chr(10))) AS cell_md5 FROM documents")
def cell_text_documents(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(X.cell_text("text")).alias("cell_md5"))


HEADERS = ["brand", "name", "type#2", "lemon", "steel"]


@query(rf"""
WITH h AS (SELECT p_partkey, lower(regexp_replace(trim(regexp_replace(concat(' (', p_brand, ') : ', p_name, ' '), '{WS}+', ' ', 'g')), '[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}（）():：、/\\_\-]+', '', 'g')) AS k FROM part)
SELECT p_partkey, k AS header, array_to_string(list_filter({HEADERS!r}, lambda w: contains(k, w)), ',') AS words FROM h""")
def header_normalize_keyword_match(spark, d):
    key = X.header_key(F.concat(F.lit(" ("), F.col("p_brand"), F.lit(") : "), F.col("p_name"), F.lit(" ")))
    words = F.array(*map(F.lit, HEADERS))
    return read(spark, d, "part").select("p_partkey", key.alias("header"), F.array_join(F.filter(words, lambda w: F.contains(key, w)), ",").alias("words"))


DOMAINS = ["example.org", "tionsh.example.net"]
_HOST = r"regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:\[]*)', 1)), '\.+$', '')"


@query(f"WITH p AS (SELECT {_HOST} AS host FROM pages) SELECT host, len(list_filter({DOMAINS!r}, lambda d: host = d OR ends_with(host, '.' || d))) > 0 AS listed, count(*) AS n FROM p GROUP BY host")
def url_host_domain_stats(spark, d):
    host = U.host_of("url")
    return read(spark, d, "pages").groupBy(host.alias("host"), U.in_domains(host, F.array(*map(F.lit, DOMAINS))).alias("listed")).agg(F.count("*").alias("n"))


@query(rf"""
WITH t AS (SELECT page_id, trim(regexp_replace(regexp_extract(coalesce(html, ''), '(?is)<title[^>]*>(.*?)</title>', 1), '{WS}+', ' ', 'g')) AS title,
  concat(substr(trim(regexp_replace(regexp_extract(coalesce(html, ''), '(?is)<title[^>]*>(.*?)</title>', 1), '{WS}+', ' ', 'g')), 3, 6), CASE WHEN page_id % 2 = 0 THEN '（x）' ELSE '' END) AS name FROM pages),
u AS (SELECT *, regexp_replace(title, '{WS}+', '', 'g') AS c, regexp_replace(name, '^{WS}+|{WS}+$', '', 'g') AS w FROM t),
v AS (SELECT *, regexp_replace(regexp_replace(w, '[（(][^（）()]*[）)]', '', 'g'), '^{WS}+|{WS}+$', '', 'g') AS core FROM u)
SELECT page_id, title, (w <> '' AND contains(c, regexp_replace(w, '{WS}+', '', 'g'))) OR (core <> '' AND core <> w AND contains(c, regexp_replace(core, '{WS}+', '', 'g'))) AS known FROM v""")
def page_title_identity(spark, d):
    title = U.title_of("html")
    name = F.concat(F.substring(title, 3, 6), F.when(F.col("page_id") % 2 == 0, "（x）").otherwise(""))
    return read(spark, d, "pages").select("page_id", title.alias("title"), U.title_names(title, name).alias("known"))


@query(r"""
WITH a AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS site, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS pos FROM pages),
b AS (SELECT page_id, pos, CASE WHEN href LIKE '/%' THEN site || href ELSE href END AS url FROM a WHERE href LIKE '/%' OR href LIKE 'http%'),
c AS (SELECT page_id, url, min(pos) AS pos FROM b WHERE regexp_matches(url, '/[a-m][^/]*$') GROUP BY page_id, url)
SELECT page_id, count(*) AS n, min(url) AS first_url FROM c GROUP BY page_id""")
def directory_links_filtered(spark, d):
    pages = read(spark, d, "pages").select(F.col("page_id").alias("page"), F.col("url").alias("final_url"), "html")
    found = links.directory_links(pages, "", "/[a-m][^/]*$").filter(F.col("url").startswith("http"))
    return found.groupBy(F.col("page").alias("page_id")).agg(F.count("*").alias("n"), F.min("url").alias("first_url"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN concat(CASE WHEN o_orderkey % 3 = 0 THEN 'https://e.org/' || o_orderkey || ' | ' ELSE '' END, 'f.csv', CASE WHEN o_orderkey % 3 = 0 THEN ' | row ' || (o_orderkey % 90) ELSE '' END) ELSE 'HTTP://e.org/' || o_orderkey END AS reference, CASE WHEN o_orderkey % 4 = 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'https://e.org/' || o_orderkey ELSE '' END ELSE 'HTTP://e.org/' || o_orderkey END AS url FROM orders")
def source_reference_format(spark, d):
    k = F.col("o_orderkey").cast("string")
    raw = F.when(F.col("o_orderkey") % 4 == 0, F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" https://e.org/"), k, F.lit(" |  f.csv || sheet A | row  x | row "), (F.col("o_orderkey") % 90).cast("string"), F.lit(" |"))).otherwise(F.lit("| a | f.csv "))).otherwise(F.concat(F.lit("HTTP://e.org/"), k))
    return read(spark, d, "orders").select("o_orderkey", U.source_reference(raw).alias("reference"), U.source_url(raw).alias("url"))


_STATUS = "CASE event_type WHEN 'view' THEN 'consistent' WHEN 'signup' THEN ' poi_match ' WHEN 'purchase' THEN 'needs_review' WHEN 'error' THEN '' ELSE event_type END"


@query("SELECT CASE event_type WHEN 'view' THEN '一致' WHEN 'signup' THEN 'POI匹配' WHEN 'purchase' THEN '部分匹配·待复核' WHEN 'error' THEN '未查询' ELSE event_type END AS label, count(*) AS n FROM events GROUP BY 1")
def status_label_map(spark, d):
    return read(spark, d, "events").groupBy(A.status_label(F.expr(_STATUS)).alias("label")).agg(F.count("*").alias("n"))


# -- addresses ------------------------------------------------------------------------------------------

_CLEAN = rf"""
a AS ({S.records(False)}),
c1 AS (SELECT *, replace(original_address, '　', ' ') AS v FROM a),
c2 AS (SELECT * REPLACE (regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(v, '{A.LABEL}', '', 'g'), '{A.CONTACT}', '', 'g'), '{A.POSTCODE}', '', 'g'), '{A.BULLETS}', '', 'g'), '{A.NARRATIVE}', '') AS v) FROM c1),
c3 AS (SELECT *, substr(v, length(regexp_extract(v, '{A.ANY_LABEL}')) + 1) AS rest FROM c2),
c4 AS (SELECT * REPLACE (CASE WHEN regexp_matches(v, '{A.ANY_LABEL}') AND regexp_matches(rest, '{A.ADMIN_START}') THEN rest ELSE v END AS v) FROM c3),
c5 AS (SELECT *, regexp_extract_all(v, '{A.CITY_RUN}', 1) AS runs FROM c4),
c6 AS (SELECT *, CASE WHEN len(runs) >= 2 THEN length(v) - instr(reverse(v), reverse(runs[-1])) + 1 - length(runs[-1]) ELSE 0 END AS spot0 FROM c5),
c7 AS (SELECT * REPLACE (CASE WHEN len(runs) >= 2 AND NOT regexp_matches(substr(v, 1, spot0), '[路街大道巷号栋座]') THEN substr(v, spot0 + 1) ELSE v END AS v) FROM c6),
c8 AS (SELECT * REPLACE (CASE WHEN regexp_matches(regexp_extract(v, '(?s)^(.*?\p{{Nd}}+号[^，,；;、]*)[，,；;、](.*)$', 2), '{A.TAIL_WORDS}') THEN regexp_extract(v, '(?s)^(.*?\p{{Nd}}+号[^，,；;、]*)[，,；;、](.*)$', 1) ELSE v END AS v) FROM c7),
c9 AS (SELECT * REPLACE (regexp_replace(translate(regexp_replace(v, '{WS}+', '', 'g'), '{A.NARROW}', '{A.WIDE}'), '^[，,；;：:|｜ ]+|[，,；;：:|｜ ]+$', '', 'g') AS v) FROM c8),
d1 AS (SELECT * REPLACE (substr(v, 1, CAST(length(v) - greatest(0, least(length(regexp_extract(v, '(）*)$', 1)), length(replace(v, '（', '')) - length(replace(v, '）', '')))) AS BIGINT)) AS v) FROM c9),
clean AS (SELECT * REPLACE (substr(v, CAST(1 + greatest(0, least(length(regexp_extract(v, '^(（*)', 1)), length(replace(v, '）', '')) - length(replace(v, '（', '')))) AS BIGINT)) AS v) FROM d1)"""


@query(f"WITH {_CLEAN} SELECT record_id, v AS cleaned FROM clean")
def address_clean(spark, d):
    return A.cleaned(records(spark, d), "original_address", "cleaned").select("record_id", "cleaned")


_FULL = "[" + ", ".join(f"'{c}'" for c in S.CATALOG) + "]"
_SHORTS = "[" + ", ".join(f"'{x}'" for x in ["北京", "上海", "重庆", "杭州", "宁波", "南京", "苏州", "成都", "武汉", "恩施土家族苗族", "恩施土家", "桂林", "兴安", "阿里"]) + "]"
_UNITS = "[" + ", ".join(f"'{u}'" for u in S.UNITS) + "]"
_CORES = "[{'c': '西湖', 'f': '西湖区'}, {'c': '拱墅', 'f': '拱墅区'}, {'c': '滨江', 'f': '滨江区'}, {'c': '桐庐', 'f': '桐庐县'}]"
_ZONE = "(regexp_matches({0}, '" + A.ZONE + "') OR regexp_matches(left({0}, greatest(length({0}) - 1, 0)), '" + A.ZONE_MARKS + "') OR ({0} LIKE '%旗' AND length({0}) <= 2))"
_NORMAL = rf"""{_CLEAN},
n1 AS (SELECT *, regexp_replace(v, '^(?:中华人民共和国|中国)', '') AS x FROM clean),
n2 AS (SELECT *, x LIKE '浙江省%' AS own, x LIKE '浙江%' AS brief FROM n1),
n3 AS (SELECT *, CASE WHEN NOT brief AND regexp_matches(x, '{A.PROVINCE}') THEN '原始地址中的省级单位与目标城市不一致：' || regexp_extract(x, '{A.PROVINCE}', 1) ELSE '' END AS why0, CASE WHEN own THEN substr(x, 4) WHEN brief THEN substr(x, 3) ELSE x END AS y FROM n2),
n4 AS (SELECT *, list_filter({_CORES}, lambda u: y LIKE '杭州%' AND starts_with(substr(y, 3), u.c) AND NOT regexp_matches(substr(y, 3 + length(u.c)), '^[区县旗]')) AS fits FROM n3),
n5 AS (SELECT *, CASE WHEN len(fits) > 0 THEN fits[1].f || substr(y, 3 + length(fits[1].c)) ELSE y END AS z FROM n4),
n6 AS (SELECT *, z LIKE '杭州市%' AS by_full, regexp_extract(substr(z, 3), '{A.DISTRICT}', 1) AS near, regexp_extract(z, '{A.CITY}', 1) AS named, regexp_extract(z, '{A.SHORT_CITY}', 1) AS short, regexp_extract(z, '{A.SHORT_CITY}', 2) AS short_unit FROM n5),
n7 AS (SELECT *, z LIKE '杭州%' AND near <> '' AND NOT {_ZONE.format('near')} AS by_short FROM n6),
n8 AS (SELECT *, CASE WHEN by_full OR by_short THEN '' WHEN list_contains({_FULL}, named) AND named <> '杭州市' THEN named WHEN short <> '' AND NOT regexp_matches(short_unit, '^[区县旗]') AND list_contains({_SHORTS}, short) AND short <> '杭州' THEN short ELSE '' END AS other FROM n7),
n9 AS (SELECT *, CASE WHEN why0 <> '' THEN why0 WHEN other <> '' THEN '原始地址中的城市与目标城市不一致：' || other ELSE '' END AS why, CASE WHEN by_full THEN substr(z, 4) WHEN by_short THEN substr(z, 3) ELSE z END AS d0 FROM n8),
m1 AS (SELECT *, CASE WHEN unit <> '' AND instr(d0, unit) BETWEEN 1 AND 21 THEN substr(d0, instr(d0, unit)) ELSE d0 END AS d1 FROM n9),
m2 AS (SELECT *, regexp_extract(d1, '{A.UNIT}', 1) AS u0 FROM m1),
m3 AS (SELECT *, regexp_extract(u0, '(街道|苏木|区|县|旗|镇|乡|市)$', 1) AS suffix FROM m2),
m4 AS (SELECT *, suffix IN ('街道', '镇', '乡', '苏木') AS low, (suffix = '市' AND regexp_matches(substr(d1, length(u0) + 1), '^[东南西北中]?(?:路|街|大道|巷)')) OR (suffix NOT IN ('街道', '镇', '乡', '苏木') AND {_ZONE.format('u0')}) AS nothing, len(list_filter({_UNITS}, lambda w: starts_with(w, u0))) = 0 AS strange FROM m3),
m5 AS (SELECT *, CASE WHEN u0 <> '' AND NOT nothing AND strange AND (suffix IN ('区', '县') OR NOT low) THEN u0 ELSE '' END AS bad, CASE WHEN u0 = '' OR nothing OR strange THEN '' ELSE u0 END AS u FROM m4),
m6 AS (SELECT *, substr(d1, length(u) + 1) AS spot, CASE WHEN u = '' AND unit <> '' THEN unit || d1 ELSE d1 END AS d2 FROM m5),
m7 AS (SELECT *, regexp_replace(spot, '{A.LOWER_UNITS}', '') AS bare FROM m6),
m8 AS (SELECT *, CASE WHEN u = '' AND unit = '' THEN '{A.NO_UNIT}' WHEN NOT (regexp_matches(bare, '{A.SPECIFIC}') OR (length(bare) >= 2 AND NOT regexp_matches(bare, '{A.PLACE_ONLY}'))) THEN '{A.NO_PLACE}' ELSE '' END AS gap,
  substr(v, length(regexp_extract(v, '{A.PROVINCE}', 1)) + 1) AS pv FROM m7),
m9 AS (SELECT *, CASE WHEN regexp_matches(pv, '{A.CITY}') THEN regexp_extract(pv, '{A.CITY}', 1) WHEN regexp_extract(pv, '{A.SHORT_CITY}', 1) = '' THEN '' ELSE coalesce(list_filter({_FULL}, lambda w: regexp_extract(pv, '{A.SHORT_CITY}', 1) IN (regexp_replace(w, '(?:市|地区|自治州|盟)$', ''), regexp_replace(w, '族.*$', '')))[1], regexp_extract(pv, '{A.SHORT_CITY}', 1)) END AS prefix FROM m8),
r1 AS (SELECT *, CASE WHEN trim(original_address) = '' THEN 'empty' WHEN v = '' THEN 'invalid' WHEN why <> '' OR bad <> '' OR (u <> '' AND unit <> '' AND u <> unit) THEN 'conflict' WHEN gap = '' THEN 'complete' ELSE 'partial' END AS s0,
  CASE WHEN place_name = '宁波校区' THEN '宁波市' WHEN place_name = '南京校园分部' THEN '南京市' ELSE '' END AS campus FROM m9),
r2 AS (SELECT record_id, CASE WHEN s0 IN ('complete', 'partial') THEN '杭州市' || d2 ELSE '' END AS normalized_address,
  CASE WHEN s0 IN ('empty', 'invalid', 'conflict') AND campus <> '' THEN 'conflict' ELSE s0 END AS normalization_status,
  CASE WHEN s0 IN ('empty', 'invalid', 'conflict') AND campus <> '' THEN '地点名称包含异地城市校区：' || campus WHEN s0 = 'empty' THEN '前置处理没有取得地址文本' WHEN s0 = 'invalid' THEN '清理后没有可用地址' WHEN why <> '' THEN why WHEN bad <> '' THEN '原始地址中的下级行政区不属于目标城市：' || bad WHEN s0 = 'conflict' THEN '原始地址中的下级行政区与检索单元不一致：' || u || ' != ' || unit ELSE gap END AS normalization_reason,
  CASE WHEN s0 IN ('empty', 'invalid', 'conflict') AND campus <> '' THEN campus WHEN s0 IN ('empty', 'invalid') THEN '' WHEN why <> '' THEN prefix ELSE '杭州市' END AS resolved_city FROM r1)"""


@query(f"WITH {_NORMAL} SELECT * FROM r2")
def address_normalize(spark, d):
    return normalized(spark, d).select("record_id", "normalized_address", "normalization_status", "normalization_reason", "resolved_city")


@query(f"WITH {_NORMAL} SELECT normalization_status, count(*) AS n FROM r2 GROUP BY 1")
def address_normalize_status(spark, d):
    return status_counts(normalized(spark, d))


@query(f"WITH {_CLEAN} SELECT record_id, regexp_extract(v, '{A.UNIT}', 1) AS unit_name, substr(v, length(regexp_extract(v, '{A.UNIT}', 1)) + 1) AS place FROM clean")
def admin_unit_extract(spark, d):
    df = A.cleaned(records(spark, d), "original_address", "v")
    return df.select("record_id", A.unit_of(F.col("v")).alias("unit_name"), A.place_of(F.col("v")).alias("place"))


_COMPACT = "regexp_replace(v, '" + X.ADDRESS_MARKS + "', '', 'g')"


@query(f"""WITH {_CLEAN}, k AS (SELECT record_id, {_COMPACT} AS w FROM clean)
SELECT record_id, coalesce(regexp_extract_all(w, '{A.ROAD}', 1)[-1], '') AS road, regexp_extract(w, '{A.NUMBER}', 1) AS number FROM k""")
def road_number_components(spark, d):
    df = A.cleaned(records(spark, d), "original_address", "v")
    return df.select("record_id", A.road_of("v").alias("road"), A.number_of("v").alias("number"))


_FIND = "CASE WHEN instr({0}, '{1}') > 0 THEN length({0}) - instr(reverse({0}), reverse('{1}')) + 1 - length('{1}') ELSE -1 END"
_MARKS = ["省", "市", "区", "县", "街道", "街", "镇", "乡"]


def _key_oracle() -> str:
    steps = ", ".join(f"w{i} AS (SELECT *, CASE WHEN p >= b{i} THEN p + {len(m)} ELSE b{i} END AS b{i + 1} FROM (SELECT * EXCLUDE (p), {_FIND.format('before', m)} AS p FROM {'q' if i == 0 else f'w{i - 1}'}))" for i, m in enumerate(_MARKS))
    roads = "greatest(" + ", ".join(_FIND.format("head", s) for s in ("大道", "大街", "路", "街", "巷", "弄", "道")) + ")"
    return rf"""
WITH a AS ({S.records(False)}),
e AS (SELECT record_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(original_address, '{WS}+', '', 'g'), '^中国', ''), '{A.KEY_PROVINCE}', ''), '{A.KEY_CITY}', ''), '{A.KEY_ZONE}', '\1') AS v FROM a),
f AS (SELECT *, regexp_extract_all(v, '(\p{{Nd}}+(?:[-－]\p{{Nd}}+)?号)', 1) AS ns FROM e),
g AS (SELECT *, coalesce(ns[-1], '') AS num, CASE WHEN len(ns) > 0 THEN length(v) - instr(reverse(v), reverse(ns[-1])) + 1 - length(ns[-1]) ELSE 0 END AS spot FROM f),
h AS (SELECT *, substr(v, 1, spot) AS head FROM g),
i AS (SELECT *, {roads} AS road FROM h),
q AS (SELECT *, substr(head, 1, greatest(road, 0)) AS before, 0 AS b0, 0 AS p FROM i),
{steps},
r AS (SELECT record_id, CASE WHEN len(ns) = 0 OR road < 0 THEN v ELSE substr(v, b8 + 1, spot + length(num) - b8) END AS k FROM w7)
SELECT k AS key, min(record_id) AS first_id, count(*) AS n FROM r GROUP BY k"""


@query(_key_oracle())
def address_equivalence_dedup(spark, d):
    return records(spark, d).groupBy(A.equivalence_key("original_address").alias("key")).agg(F.min("record_id").alias("first_id"), F.count("*").alias("n"))


_NAMES = ["杭州", "宁波市", "兴安", "阿里", "nowhere", "恩施土家族苗族", "", "重庆市"]


@query(f"WITH n AS (SELECT n_nationkey, {S.pick(_NAMES, 'n_nationkey', False)} AS raw FROM nation) SELECT n_nationkey, CASE raw WHEN '杭州' THEN '杭州市' WHEN '宁波市' THEN '宁波市' WHEN '兴安' THEN '兴安盟' WHEN '阿里' THEN '阿里地区' WHEN '恩施土家族苗族' THEN '恩施土家族苗族自治州' WHEN '重庆市' THEN '重庆市' END AS city_name, CASE raw WHEN 'nowhere' THEN '城市不在固定目录中：nowhere' WHEN '' THEN '城市名称不能为空' ELSE '' END AS city_error FROM n")
def city_catalog_resolve(spark, d):
    raw = sql(spark, d, "nation", f"SELECT n_nationkey, {S.pick(_NAMES, 'n_nationkey', True)} AS raw FROM nation")
    return resolve_city_names(raw, "raw", catalog_frame(spark, S.CATALOG)).select("n_nationkey", "city_name", "city_error")


@query(f"SELECT s_suppkey, CASE {S.pick(S.PLACES, 's_suppkey', False)} WHEN '宁波校区' THEN '宁波市' WHEN '南京校园分部' THEN '南京市' ELSE '' END AS foreign_city FROM supplier")
def foreign_campus_theta(spark, d):
    _, shorts = catalog_literals(spark, S.CATALOG)
    df = sql(spark, d, "supplier", f"SELECT s_suppkey, {S.pick(S.PLACES, 's_suppkey', True)} AS place FROM supplier")
    return df.select("s_suppkey", foreign_campus(F.col("place"), F.lit("杭州市"), F.lit("杭州"), shorts).alias("foreign_city"))


# -- matching -------------------------------------------------------------------------------------------


def answers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Map answers made from the records themselves: some right, some with another number, road or district."""
    own = normalized(spark, d).filter("normalized_address <> ''").select(F.col("normalized_address").alias("a"), F.crc32(F.col("normalized_address").cast("binary")).alias("k")).distinct()
    k, a = F.col("k"), F.col("a")
    unit = A.unit_of(X.after(a, 3))
    make = lambda text, district: F.struct(text.alias("formatted_address"), F.lit("浙江省").alias("province"), F.lit("杭州市").alias("city"), district.alias("district"), F.lit("").alias("street"), F.lit("").alias("number"))
    whole = F.concat(F.lit("浙江省"), a)
    options = [make(whole, unit), make(F.concat(whole, F.lit("7号楼")), unit), make(F.regexp_replace(whole, "12号", "15号"), unit), make(F.lit("浙江省杭州市拱墅区文三路12号"), F.lit("拱墅区"))]
    geocodes = own.select(a.alias("asked_address"), F.lit("杭州市").alias("asked_city"), F.when(k % 11 == 0, "高德服务错误：busy").otherwise("").alias("error"), F.when(k % 7 == 0, F.array().cast(match.GEOCODES)).when(k % 3 == 0, F.array(options[3], options[2], options[0])).when(k % 3 == 1, F.array(options[1])).otherwise(F.array(options[2], options[3])).alias("candidates"))
    names = spark.createDataFrame([(n, i) for i, n in enumerate(S.PLACES)], "asked_name string, i int")
    poi = lambda n, s: F.struct(n.alias("name"), F.lit("杭州市").alias("cityname"), F.lit("西湖区").alias("adname"), s.alias("address"), F.lit("科教文化服务").alias("type"), F.lit("141200").alias("typecode"))
    n, i = F.col("asked_name"), F.col("i")
    found = F.when(i % 3 == 0, F.array(poi(F.concat(F.lit("杭州市"), n), F.lit("学院路8号")))).when(i % 3 == 1, F.array(poi(n, F.lit("学院路8号")), poi(n, F.lit("文一路9号")))).otherwise(F.array(poi(F.concat(n, F.lit("北门")), F.lit("学院路8号"))))
    return geocodes, names.select("asked_name", F.lit("杭州市").alias("asked_city"), F.lit("").alias("error"), found.alias("candidates"))


def resolved(spark: SparkSession, d: str) -> DataFrame:
    geocodes, pois = answers(spark, d)
    return match.resolve_records(normalized(spark, d, keep=True), S.CATALOG, geocodes, pois)


@query()
def final_choice_router(spark, d):
    return resolved(spark, d).select("record_id", "route", "map_match_status", "map_reason", "map_address", "final_address", "final_address_source", "final_address_reason", "map_request_count")


@query("""WITH g AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS p FROM orders)
SELECT o_orderkey, CASE p % 4 WHEN 0 THEN '浙江省杭州市西湖区文三路12号' WHEN 1 THEN '浙江省杭州市西湖区文三路' WHEN 2 THEN '浙江省杭州市拱墅区文三路12号' ELSE '浙江省杭州市西湖区文三路' || (20 + p % 7) || '号' END AS map_address,
  CASE p % 4 WHEN 0 THEN 'consistent' WHEN 1 THEN 'partial' ELSE 'conflict' END AS status, CAST(CASE p % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 ELSE 0 END AS INTEGER) AS pos,
  CASE p % 4 WHEN 0 THEN '行政区、道路和门牌号均一致' WHEN 1 THEN '无明确冲突，但以下规范地址组件未获地图支持：地图门牌号' WHEN 2 THEN '下级行政区冲突：规范地址“西湖区”，地图“拱墅区”' ELSE '门牌号冲突：规范地址“12号”，地图“' || (20 + p % 7) || '号”' END AS reason FROM g""")
def geocode_choose_best(spark, d):
    """The best of two geocodes; the first one where both conflict."""
    p = F.floor("o_totalprice").cast("long")
    make = lambda text, unit: F.struct(text.alias("formatted_address"), F.lit("浙江省").alias("province"), F.lit("杭州市").alias("city"), F.lit(unit).alias("district"), F.lit("").alias("street"), F.lit("").alias("number"))
    own = lambda place: make(F.concat(F.lit("浙江省杭州市西湖区"), place), "西湖区")
    elsewhere = make(F.lit("浙江省杭州市拱墅区文三路12号"), "拱墅区")
    number = F.concat(F.lit("文三路"), (20 + p % 7).cast("string"), F.lit("号"))
    options = F.when(p % 4 == 3, F.array(own(number), elsewhere)).otherwise(F.array(elsewhere, own(F.when(p % 4 == 0, "文三路12号").when(p % 4 == 1, "文三路").otherwise("学院路12号"))))
    best = match.best_geocode(F.lit("杭州市西湖区文三路12号"), F.lit("杭州市"), options)
    return read(spark, d, "orders").select("o_orderkey", best.alias("b")).select("o_orderkey", "b.map_address", "b.status", "b.pos", "b.reason")


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 IN (0, 1, 2) THEN true ELSE false END AS same FROM customer")
def poi_unique_match(spark, d):
    k = F.col("c_custkey")
    name = F.concat(F.lit("第"), k.cast("string"), F.lit("中学（新校区）"))
    other = F.when(k % 4 == 0, F.concat(F.lit("第"), k.cast("string"), F.lit("中学校区"))).when(k % 4 == 1, F.concat(F.lit("杭州市西湖区文三街道第"), k.cast("string"), F.lit("中学新校区"))).when(k % 4 == 2, F.concat(F.lit("第"), k.cast("string"), F.lit("中学【新校区】(在建)"))).otherwise(F.concat(F.lit("第"), k.cast("string"), F.lit("中学新校区北门")))
    return read(spark, d, "customer").select("c_custkey", A.names_match(name, other, F.lit("杭州市"), F.lit("西湖区")).alias("same"))


# -- extraction -----------------------------------------------------------------------------------------

WORDS = extract.Vocabulary(("机构名称", "学校名称"), ("名称",), ("地址",), (extract.Attribute("level", ("级别",), "级别", True),), "学校|中学", "路|街")


def order_cells(spark: SparkSession, d: str) -> DataFrame:
    """A table for each clerk-like group of orders: header, then rows with blank names to fill down."""
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("t"), F.col("o_orderkey").alias("k"))
    k = F.col("k")
    row = F.array(F.when(k % 3 == 0, F.concat(F.lit("第"), k.cast("string"), F.lit("中学"))).otherwise(""), F.concat(F.lit("文三路"), (k % 40).cast("string"), F.lit("号")), F.when(k % 5 == 0, "").otherwise((k % 4).cast("string")))
    return o.select(F.concat(F.lit("f/"), F.col("t").cast("string"), F.lit(".csv")).alias("file"), F.lit("sheet").alias("kind"), F.lit('{"sheet": "a"}').alias("location"), (k + 1).cast("long").alias("row_no"), row.alias("cells"))


@query("SELECT file, CAST(1 AS INTEGER) AS header_row, CAST(2 AS INTEGER) AS data_start_row, '1' AS places, CAST(2 AS INTEGER) AS original_address_column, CASE WHEN gap > 0 THEN CASE WHEN lev > 0 THEN '1,3' ELSE '1' END ELSE CASE WHEN lev > 0 THEN '3' ELSE '' END END AS fills FROM (SELECT 'f/' || o_custkey || '.csv' AS file, count(*) FILTER (o_orderkey % 3 <> 0) AS gap, count(*) FILTER (o_orderkey % 5 = 0 AND o_orderkey % 3 = 0) AS lev FROM orders GROUP BY 1)")
def table_rule_inference(spark, d):
    cells = order_cells(spark, d).withColumn("row_no", F.col("row_no").cast("int"))
    heads = cells.select("file", "kind", "location").distinct().select("file", "kind", "location", F.lit(1).alias("row_no"), F.array(F.lit(" 学校 名称："), F.lit("地 址"), F.lit("级别")).alias("cells"))
    rules = extract.infer_table_rules(heads.unionByName(cells.withColumn("row_no", F.col("row_no") + 20)), WORDS)
    return rules.select("file", "header_row", "data_start_row", F.array_join(F.transform("place_name_columns", lambda x: x.cast("string")), ",").alias("places"), "original_address_column", F.array_join(F.transform("fill_down_columns", lambda x: x.cast("string")), ",").alias("fills"))


@query("SELECT CASE s_suppkey % 4 WHEN 0 THEN 'a/*.html' WHEN 1 THEN NULL WHEN 2 THEN '*.htm' ELSE NULL END AS file_pattern, CASE s_suppkey % 4 WHEN 1 THEN (CASE WHEN s_suppkey % 8 < 4 THEN 'b/' ELSE 'c/' END) || s_suppkey || '.html' WHEN 3 THEN 'e/' || s_suppkey || (CASE WHEN s_suppkey % 8 < 4 THEN '.htm' ELSE '.html' END) END AS file, CAST(s_suppkey % 4 AS BIGINT) AS label FROM supplier GROUP BY ALL")
def rule_consolidation(spark, d):
    k = F.col("s_suppkey")
    name = k.cast("string")
    half = (k % 8) < 4
    file = F.when(k % 4 == 0, F.concat(F.lit("a/"), name, F.lit(".html"))).when(k % 4 == 1, F.concat(F.when(half, "b/").otherwise("c/"), name, F.lit(".html"))).when(k % 4 == 2, F.concat(name, F.lit(".HTM"))).otherwise(F.concat(F.lit("e/"), name, F.when(half, ".htm").otherwise(".html")))
    rules = read(spark, d, "supplier").select(file.alias("file"), (k % 4).alias("label"))
    return extract.consolidate_rules(rules).select("file_pattern", "file", "label")


@query(r"""
SELECT doc_id, CAST(unnest(range(1, len(p) + 1)) AS BIGINT) AS row_no, unnest(p) AS place_name, unnest(q) AS original_address
FROM (SELECT doc_id, regexp_extract_all(text, '\+1 \((\d{3})\) (\d{3}-\d{4})', 2) AS p, regexp_extract_all(text, '\+1 \((\d{3})\) (\d{3}-\d{4})', 1) AS q FROM documents)""")
def text_regex_extract(spark, d):
    docs = read(spark, d, "documents").select(F.lit("all").alias("file"), F.col("doc_id").cast("string").alias("reference"), F.coalesce("text", F.lit("")).alias("text"))
    rule = {"file": "all", "kind": "text_regex", "pattern": r"\+1 \((?P<original_address>\d{3})\) (?P<place_name>\d{3}-\d{4})"}
    return extract.regex_records(docs, rule).select(F.col("source_reference").cast("long").alias("doc_id"), "row_no", "place_name", "original_address")


@query("""
WITH s AS (SELECT l_orderkey AS f, l_suppkey % 5 AS a, min(l_linenumber * 100000 + l_suppkey) AS ln FROM lineitem GROUP BY ALL)
SELECT 'f' || f AS file, CAST(1 AS INTEGER) AS row_no, 'h,h' AS cells FROM s GROUP BY f
UNION ALL SELECT 'f' || f, CAST(1 + row_number() OVER (PARTITION BY f ORDER BY ln) AS INTEGER), 'r' || a || ',x' FROM s""")
def vision_merge_rows(spark, d):
    li = read(spark, d, "lineitem")
    file = F.concat(F.lit("f"), F.col("l_orderkey").cast("string"))
    heads = li.select(file.alias("file"), (F.col("l_linenumber") * 100000 + F.col("l_suppkey")).alias("segment"), F.lit(1).alias("row_no"), F.array(F.lit("h"), F.lit("h")).alias("cells"))
    body = li.select(file.alias("file"), (F.col("l_linenumber") * 100000 + F.col("l_suppkey")).alias("segment"), F.lit(2).alias("row_no"), F.array(F.concat(F.lit("r"), (F.col("l_suppkey") % 5).cast("string")), F.lit("x")).alias("cells"))
    return files.merged_rows(heads.unionByName(body)).select("file", "row_no", F.array_join("cells", ",").alias("cells"))


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN ',合计,9,,' WHEN 1 THEN ',第一小学,x,,' WHEN 2 THEN '1,第一小学,x,,' WHEN 3 THEN '备注学校,x,,,' ELSE 'a,b,c,d,e' END AS cells FROM part")
def align_short_rows(spark, d):
    k = F.col("p_partkey")
    lit = lambda *xs: F.array(*map(F.lit, xs))
    row = F.when(k % 5 == 0, lit("合计", "9")).when(k % 5 == 1, lit("第一小学", "x")).when(k % 5 == 2, lit("1", "第一小学", "x")).when(k % 5 == 3, lit("备注学校", "x")).otherwise(lit("a", "b", "c", "d", "e", "f"))
    return read(spark, d, "part").select("p_partkey", F.array_join(files.aligned(row, F.lit(5)), ",").alias("cells"))


@query(f"""
WITH n AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'd' || doc_id ELSE 's' || (doc_id % 50) END AS file, trim(regexp_replace(coalesce(text, '') || CASE WHEN doc_id % 6 = 0 THEN repeat(chr(65533), 40) ELSE '' END, '{WS}+', ' ', 'g')) AS v FROM documents),
c AS (SELECT file, count(*) AS page_count, CAST(sum(length(v)) AS BIGINT) AS characters, sum(length(v) - length(replace(v, chr(65533), ''))) AS odd FROM n GROUP BY 1)
SELECT file, page_count, characters, CASE WHEN characters < greatest(100, page_count * 5) THEN 'needs_vision' WHEN odd > characters * 0.01 THEN 'text_mapping_issue' ELSE 'ready' END AS status FROM c""")
def pdf_page_verdict(spark, d):
    """Whole texts as pages: files of one page and of many, some with characters that couldn't be read."""
    k = F.col("doc_id")
    file = F.when(k % 2 == 0, F.concat(F.lit("d"), k.cast("string"))).otherwise(F.concat(F.lit("s"), (k % 50).cast("string")))
    body = F.concat(X.text("text"), F.when(k % 6 == 0, F.repeat(F.lit("\ufffd"), F.lit(40))).otherwise(""))
    return files.pdf_verdict(read(spark, d, "documents").select(file.alias("file"), k.alias("page"), body.alias("text")))


@query("SELECT page_id, CAST(page_id % 4 AS BIGINT) AS n_pairs, CASE WHEN page_id % 4 > 0 THEN 'k' || page_id || '=v' ELSE '' END AS first_pair, CAST(len(regexp_extract_all(html, '<li[ >]')) AS BIGINT) AS n_items FROM pages")
def page_structures(spark, d):
    """Pairs of labels and values of a page's tables, and its list items; a table of pairs is put before each page."""
    row = F.concat(F.lit("<tr><td>k"), F.col("page_id").cast("string"), F.lit("</td><th> v </th><td>w</td></tr>"))
    table = F.concat(F.lit("<table><tr><td>alone</td></tr>"), F.repeat(row, (F.col("page_id") % 4).cast("int")), F.lit("</table>"))
    pages = read(spark, d, "pages").select("page_id", F.concat(table, "html").alias("html")).select("page_id", key_values("html").alias("pairs"), item_count("html").alias("n_items"))
    first = F.get("pairs", F.lit(0))
    return pages.select("page_id", F.size("pairs").cast("long").alias("n_pairs"), F.coalesce(F.concat(first["label"], F.lit("="), first["value"]), F.lit("")).alias("first_pair"), "n_items")


# -- results --------------------------------------------------------------------------------------------

SPEC = output.SheetSpec(("编号",), query_date="2024-05-01")
_SHEET = "CASE WHEN c_custkey % 3 = 0 THEN 'map' ELSE 'official' END"


def sheet_rows(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(F.concat("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string")).alias("sheet"), k, F.concat(F.lit("杭州市西湖区"), k.cast("string"), F.lit("号")).alias("final_address"), F.when(k % 3 == 0, "map").otherwise("official").alias("final_address_source"), F.when(k % 2 == 0, "consistent").otherwise("skipped").alias("map_match_status"), F.concat(F.lit("https://e.org/"), k.cast("string"), F.lit(" | f.csv | row 2")).alias("source_reference"), F.when(k % 5 == 0, F.lit(" 未找到 ")).alias("reason"))


@query("SELECT c_mktsegment || '-' || c_nationkey AS sheet, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey) AS \"序号\", c_custkey AS \"编号\", '2024-05-01' AS \"查询日期\", '杭州市西湖区' || c_custkey || '号' AS \"地址\", CASE WHEN c_custkey % 3 = 0 THEN '地图' ELSE '官方来源' END AS \"地址获取方式\", CASE WHEN c_custkey % 2 = 0 THEN '一致' ELSE '未查询' END AS \"地图匹配状态\", 'https://e.org/' || c_custkey || ' | f.csv | row 2' AS \"信息来源\" FROM customer WHERE c_custkey % 5 <> 0")
def result_sheet_main(spark, d):
    return output.main_sheet(sheet_rows(spark, d).filter("reason is null"), SPEC, ["c_custkey"], "c_custkey", "sheet")


@query("SELECT c_mktsegment || '-' || c_nationkey AS sheet, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey) AS \"序号\", c_custkey AS \"编号\", '未找到' AS \"异常原因\", 'https://e.org/' || c_custkey || ' | f.csv | row 2' AS \"信息来源\", '2024-05-01' AS \"查询日期\" FROM customer WHERE c_custkey % 5 = 0")
def result_sheet_abnormal(spark, d):
    return output.abnormal_sheet(sheet_rows(spark, d).filter("reason is not null"), SPEC, ["c_custkey"], "reason", "c_custkey", "sheet")


@query("SELECT v AS violation, CAST(n AS BIGINT) AS n FROM (SELECT CAST(min(c_custkey) <> 1 OR max(c_custkey) <> count(*) AS INT) AS z, count(*) FILTER (c_custkey % 4 = 0) AS a, count(*) FILTER (c_custkey % 6 = 0) AS b, count(*) FILTER (c_custkey % 10 = 0) AS c FROM customer) CROSS JOIN LATERAL (VALUES ('序号不连续', z), ('日期格式', a), ('空地址', b), ('地址获取方式', 0), ('地图匹配状态', c), ('空信息来源', 0)) t(v, n)")
def quality_violations(spark, d):
    k = F.col("c_custkey")
    sheet = read(spark, d, "customer").select(k.alias("序号"), F.when(k % 4 == 0, "2024-5-1").otherwise("2024-05-01").alias("查询日期"), F.when(k % 6 == 0, " ").otherwise("杭州市").alias("地址"), F.lit("地图").alias("地址获取方式"), F.when(k % 10 == 0, "?").otherwise("一致").alias("地图匹配状态"), F.lit("x").alias("信息来源"))
    return output.main_violations(sheet, SPEC)


@query(rf"""
WITH p AS (SELECT page_id, url, {_HOST} AS home, html FROM pages),
q AS (SELECT *, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'https://www.example.org/' ELSE 'https://other.test/' END AS last, page_id % 4 = 3 AS bad, CASE WHEN page_id % 4 = 3 THEN '' ELSE '欢迎 机构' || page_id || '（总部）' END AS title, page_id % 4 <> 3 AND page_id % 8 < 4 AS known FROM p),
r AS (SELECT *, CASE page_id % 4 WHEN 0 THEN home WHEN 1 THEN 'www.example.org' ELSE 'other.test' END AS host FROM q)
SELECT page_id, title, known AS identity_match, NOT bad AS reachable, NOT bad AND host <> home AS redirected, NOT bad AND (host = 'example.org' OR host LIKE '%.example.org') AS listed,
  CASE WHEN bad THEN '{U.UNREACHABLE}' WHEN host <> home AND known AND NOT (host = 'example.org' OR host LIKE '%.example.org') THEN '主页跳转至白名单外的 ' || host || ' 且页面身份匹配：建议将 ' || host || ' 并入 official_domains，并把主页改为 ' || last WHEN host <> home AND NOT (host = 'example.org' OR host LIKE '%.example.org') THEN '主页跳转至白名单外的 ' || host || '，但终页标题不含机构名称，需人工复核后决定' WHEN host <> home THEN '主页跳转至白名单内的 ' || host || '，可将主页改为 ' || last || ' 减少跳转' ELSE '' END AS suggestion FROM r""")
def domain_probe_report(spark, d):
    pages = read(spark, d, "pages").filter("page_id is not null")
    k = F.col("page_id")
    key = F.concat(F.col("url"), F.lit("#"), k.cast("string"))
    items = pages.select(k.cast("string").alias("place_id"), F.concat(F.when(k % 8 < 4, "机构").otherwise("别的机构"), k.cast("string"), F.lit("（东区）")).alias("place_name"), key.alias("home_url"), F.array(F.lit("Example.org."), F.lit("")).alias("official_domains"))
    visits = pages.select(key.alias("url"), F.when(k % 4 == 0, key).when(k % 4 == 1, "https://www.example.org/").otherwise("https://other.test/").alias("final_url"), F.lit(200).alias("http_status"), F.when(k % 4 == 3, "timed out").alias("error"), F.concat(F.lit("<title>欢迎  机构"), k.cast("string"), F.lit("（总部）</title>"), F.col("html")).alias("html"))
    found = links.probe_domains(items, visits)
    return found.select(F.col("place_id").cast("long").alias("page_id"), "title", "identity_match", "reachable", "redirected", F.col("final_domain_in_whitelist").alias("listed"), "suggestion")


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'constant' ELSE p_brand END AS value FROM part")
def attribute_fallback(spark, d):
    return read(spark, d, "part").select("p_partkey", extract.attribute_value(F.when(F.col("p_size") % 3 != 0, F.col("p_brand")), F.lit("constant")).alias("value"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 2 ELSE 0 END AS n, CASE n_nationkey % 3 WHEN 1 THEN '高德未唯一匹配目标城市：甲市' WHEN 2 THEN '高德未返回目标城市的下一级行政区：甲市' ELSE '' END AS error FROM nation")
def subdivision_payload(spark, d):
    child = '{"name":"%s","adcode":"%s","level":"district"}'
    full = '{"districts":[{"name":"甲市","districts":[' + ",".join([child % ("东区", 1), child % ("东区", 1), child % ("西区", 2), '{"name":[],"adcode":"3"}']) + "]}]}"
    k = F.col("n_nationkey")
    body = F.when(k % 3 == 0, full).when(k % 3 == 1, '{"districts":[{"name":["乙市"]}]}').otherwise('{"districts":[{"name":"甲市","districts":[]}]}')
    s = subdivisions_of(F.parse_json(body), F.lit("甲市"))
    return read(spark, d, "nation").select("n_nationkey", F.size(s["subdivisions"]).alias("n"), s["error"].alias("error"))
