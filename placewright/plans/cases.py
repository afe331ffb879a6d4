"""Worked cases: inputs whose outcome is known from the rules, numbered through the rows of a table.

A case is a template in which ``{k}`` stands for a row's key; the same table of cases gives the inputs of a query and, in
its SQL, the rows that must come out.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(value) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def values_sql(rows: list[tuple], names: list[str]) -> str:
    """A DuckDB table of constants."""
    listed = ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {listed}) v({', '.join(names)}))"


def filled(column: str, key: Column) -> Column:
    return F.replace(F.col(column), F.lit("{k}"), key.cast("string"))


def cases_for(spark: SparkSession, rows: list, keys: DataFrame, key: str) -> DataFrame:
    """Each key with its case, the one whose number is the key modulo the number of cases."""
    kind = type(rows[0])
    schema = ", ".join(f"{f.name} {'int' if f.type == 'int' else 'string'}" for f in fields(kind))
    table = spark.createDataFrame([(i, *astuple(r)) for i, r in enumerate(rows)], f"case_no int, {schema}")
    met = keys.select(F.col(key).alias("k")).withColumn("case_no", (F.col("k") % len(rows)).cast("int")).join(table, "case_no")
    return met.select("k", "case_no", *[filled(f.name, F.col("k")).alias(f.name) if f.type == "str" else F.col(f.name) for f in fields(kind)])


@dataclass(frozen=True)
class Resolution:
    """A record, the map's answers to it, and what must become of it."""

    nature: str
    address: str
    place: str = "第{k}中学"
    aliases: str = ""
    #: Geocode of the record: address and district, or an error.
    geo: str = ""
    geo_district: str = ""
    geo_error: str = ""
    #: Points of interest: name|city|district|address|type, several apart by #; "asked" is another name asked for.
    poi: str = ""
    asked: str = ""
    status: str = ""
    final: str = ""
    source: str = ""
    requests: int = 0
    normal: str = "complete"
    gap: str = ""


GAP_UNIT, GAP_PLACE = "地址缺少下级行政区", "地址缺少行政区之后的具体位置"
HIT = "第{k}中学|杭州市|西湖区|文一路{k}号|科教文化服务"
RESOLUTIONS = [
    Resolution("web_search", "西湖区文三路{k}号", status="skipped", final="杭州市西湖区文三路{k}号", source="official"),
    Resolution("map_search", "西湖区文三路{k}号", status="skipped"),
    Resolution("government_information", "文三路{k}号", geo="浙江省杭州市西湖区文三路{k}号", geo_district="西湖区", status="partial", final="杭州市西湖区文三路{k}号", source="map", requests=1, normal="partial", gap=GAP_UNIT),
    Resolution("government_information", "文一路{k}号", status="not_found", final="杭州市文一路{k}号", source="official", requests=1, normal="partial", gap=GAP_UNIT),
    Resolution("web_search", "文二路{k}号", geo="浙江省杭州市拱墅区文二路{k}号", geo_district="拱墅区", status="partial", final="杭州市拱墅区文二路{k}号", source="map", requests=1, normal="partial", gap=GAP_UNIT),
    Resolution("web_search", "天目山路{k}号", geo="浙江省杭州市西湖区学院路{k}号", geo_district="西湖区", status="conflict", final="杭州市天目山路{k}号", source="official", requests=1, normal="partial", gap=GAP_UNIT),
    Resolution("web_search", "西湖区", poi=HIT, status="poi_match", final="杭州市西湖区文一路{k}号", source="map", requests=1, normal="partial", gap=GAP_PLACE),
    Resolution("web_search", "西湖区", status="not_found", requests=1, normal="partial", gap=GAP_PLACE),
    Resolution("web_search", "", poi=HIT + "#第{k}中学|杭州市|滨江区|江南大道{k}号|科教文化服务", status="ambiguous", requests=1, normal="empty", gap="前置处理没有取得地址文本"),
    Resolution("web_search", "江苏省南京市鼓楼区{k}号", status="skipped", normal="conflict", gap="原始地址中的省级单位与目标城市不一致：江苏省"),
    Resolution("web_search", "西湖区高楼旁边", status="needs_review", final="杭州市西湖区高楼旁边", source="official", requests=1),
    Resolution("web_search", "学院路{k}号", geo_error="高德服务错误：busy", status="error", final="杭州市学院路{k}号", source="official", requests=1, normal="partial", gap=GAP_UNIT),
    Resolution("government_information", "西湖区文体花园小区", status="skipped", final="杭州市西湖区文体花园小区", source="official"),
    Resolution("government_information", "西湖区", poi=HIT, status="poi_match", final="杭州市西湖区文一路{k}号", source="map", requests=1, normal="partial", gap=GAP_PLACE),
    Resolution("government_information", "西湖区", status="not_found", final="杭州市西湖区", source="official", requests=1, normal="partial", gap=GAP_PLACE),
    Resolution("web_search", "", poi="第{k}中学|宁波市|西湖区|文一路{k}号|学校#第{k}中学|杭州市|西湖区|文一路{k}号|公交车站", status="not_found", requests=1, normal="empty", gap="前置处理没有取得地址文本"),
    Resolution("web_search", "", poi="第{k}中学|杭州市|西湖区|文一路{k}号(地铁2号线文三路站旁)|学校", status="poi_match", final="杭州市西湖区文一路{k}号", source="map", requests=1, normal="empty", gap="前置处理没有取得地址文本"),
    Resolution("web_search", "", aliases='["别名{k}中学", "另名{k}"]', poi="别名{k}中学|杭州市|西湖区|文一路{k}号|学校", asked="别名{k}中学", status="poi_match", final="杭州市西湖区文一路{k}号", source="map", requests=2, normal="empty", gap="前置处理没有取得地址文本"),
    Resolution("web_search", "", poi="杭州市第{k}中学（在建）|杭州市|西湖区|西湖区文一路{k}号|学校", status="poi_match", final="杭州市西湖区文一路{k}号", source="map", requests=1, normal="empty", gap="前置处理没有取得地址文本"),
    Resolution("web_search", "", poi="第{k}中学北校区|杭州市|西湖区|文一路{k}号|学校", status="not_found", requests=1, normal="empty", gap="前置处理没有取得地址文本"),
    Resolution("web_search", "", place="宁波校区", status="skipped", normal="conflict", gap="地点名称包含异地城市校区：宁波市"),
    Resolution("web_search", "保俶路{k}号", geo="浙江省杭州市西湖区公交站", geo_district="西湖区", status="needs_review", final="杭州市保俶路{k}号", source="official", requests=1, normal="partial", gap=GAP_UNIT),
]
#: What the modes of address records are called, by the nature of their source.
MODE = {"web_search": "web_search", "government_information": "government_list", "map_search": "map_search"}


@dataclass(frozen=True)
class Evidence:
    """A page, and the evidence in it: address|method|region|label, several apart by #."""

    html: str
    found: str = ""


_A = "杭州市西湖区文三路{k}号"
EVIDENCE = [
    Evidence(f"<p>学校地址：{_A} 邮编：310000</p>", f"{_A}|inline_label|body|学校地址"),
    Evidence(f"<table><tr><td>校址</td><td>{_A}</td></tr></table>", f"{_A}|label_relation|body|校址"),
    Evidence(f"<dl><dt>地址</dt><dd>{_A}</dd></dl>", f"{_A}|label_relation|body|地址"),
    Evidence('<script type="application/ld+json">{"@graph":[{"@type":"PostalAddress","addressRegion":"浙江省","addressLocality":"杭州市","streetAddress":"西湖区文三路{k}号"}]}</script>', "浙江省杭州市西湖区文三路{k}号|structured_data|structured_data|"),
    Evidence(f"<p>{_A}（东校址）</p>", f"{_A}（东校址）|configured_suffix|body|东校址"),
    Evidence(f"<footer><p>{_A}</p><p>电话：0571-12345678</p></footer>", f"{_A}|footer_contact|semantic_footer|"),
    Evidence(f"<p style='display:none'>地址：{_A}</p>"),
    Evidence(f"<p>举报</p><p>地址：{_A}</p>"),
    Evidence(f"<div class='contact'>地址：{_A}<br>浙江省杭州市滨江区江南大道{{k}}号</div>", f"{_A}|inline_label|contact|地址#浙江省杭州市滨江区江南大道{{k}}号|inline_continuation|contact|"),
    Evidence(f"<section><p>地址：{_A}</p><p>地址：{_A}3幢</p></section>", f"{_A}3幢|inline_label|body|地址"),
    Evidence(f"<div><h3>学校地址</h3><div style='display:none'><p>地址</p><p>{_A}</p></div></div>", f"{_A}|label_relation|body|地址"),
    Evidence(f"<dl><dt>地址</dt><dd><p>{_A}</p><p>杭州市滨江区江南大道{{k}}号</p></dd></dl>"),
    Evidence(f"<div class='foot'><p>校址：{_A}，（310000）</p></div>", f"{_A}|inline_label|footer_like|校址"),
    Evidence(f"<p>学校地址为{_A}</p>", f"{_A}|inline_label|body|学校地址"),
    Evidence("<p>地址：请拨打电话咨询</p><p>网址：https://e.org</p>"),
    Evidence(f"<p>东区地址：{_A}；西区地址：杭州市余杭区文一西路{{k}}号</p>", f"{_A}|inline_label|body|东区地址#杭州市余杭区文一西路{{k}}号|inline_label|body|西区地址"),
    Evidence(f"<div>地址：<b>{_A}</b></div><div>{_A}</div>", f"{_A}|inline_label|body|地址"),
]
