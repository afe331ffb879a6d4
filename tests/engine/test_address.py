"""Golden cases of cleaning, normalization, keys and matching."""

import pytest
from pyspark.sql import functions as F

from placewright.functions import address as A
from placewright.operators import match, metrics
from placewright.operators.city import catalog_frame, read_catalog, resolve_city_names, subdivisions_of
from placewright.operators.normalize import normalize_records, split_invalid
from placewright.plans.samples import CATALOG

UNITS = [("西湖区", "1", "district"), ("滨江区", "2", "district"), ("桐庐县", "3", "district")]
CONTEXT = "stage string, input_city string, city_name string, province_name string, subdivisions array<struct<name:string,adcode:string,level:string>>"
RECORD = "record_id long, city_name string, place_name string, original_address string, source_nature string, source_reference string, attributes map<string,string>, note string"


def context(spark, city="杭州市", province="浙江省", units=UNITS):
    return spark.createDataFrame([("city_context", city, city, province, units)], CONTEXT)


def normalize(spark, cases, city="杭州市", province="浙江省", units=UNITS, keep=False):
    """cases: (address, unit or None, place name)"""
    rows = [(i, city, name or "图书馆", a, "web_search", "https://e.org | f | row 1", {"administrative_unit": u} if u else {}, "kept") for i, (a, u, name) in enumerate(cases)]
    return normalize_records(spark.createDataFrame(rows, RECORD), context(spark, city, province, units), CATALOG, keep_context=keep)


def test_normalization(spark):
    cases = [
        ("浙江省杭州市西湖区文三路12号", None, None, "complete", "杭州市西湖区文三路12号"),
        ("中国浙江省杭州市滨江区，浙江省杭州市滨江区江南大道5号", None, None, "complete", "杭州市滨江区江南大道5号"),
        ("杭州西湖区文三路12号", None, None, "complete", "杭州市西湖区文三路12号"),
        ("杭州 西湖 文三路12号", None, None, "complete", "杭州市西湖区文三路12号"),
        ("●地址：位于浙江杭州市西湖区文三路12号，电话：0571-1 邮编", None, None, "complete", "杭州市西湖区文三路12号"),
        ("总部校区：杭州市西湖区文三路12号", None, None, "complete", "杭州市西湖区文三路12号"),
        ("杭州市西湖区文三路12号，乘公交可到学校门口", None, None, "complete", "杭州市西湖区文三路12号"),
        ("杭州市西湖区文三路12号）", None, None, "complete", "杭州市西湖区文三路12号"),
        ("杭州市西湖区", None, None, "partial", "杭州市西湖区"),
        ("文三路12号", None, None, "partial", "杭州市文三路12号"),
        ("文三路12号", "西湖区", None, "complete", "杭州市西湖区文三路12号"),
        ("高新区文三路12号", "滨江区", None, "complete", "杭州市滨江区高新区文三路12号"),
        ("杭州市西湖区文三路12号", "滨江区", None, "conflict", ""),
        ("杭州市余杭区文一西路1号", None, None, "conflict", ""),
        ("市辖区外西湖区文三路1号", "西湖区", None, "complete", "杭州市西湖区文三路1号"),
        ("江苏省南京市江宁区1号", None, None, "conflict", ""),
        ("南京市鼓楼区1号", None, None, "conflict", ""),
        ("南京鼓楼区1号", None, None, "conflict", ""),
        ("  ", None, None, "empty", ""),
        ("电话：12345", None, None, "invalid", ""),
        ("", None, "浙江大学宁波校区", "conflict", ""),
        ("西湖区文三路1号", None, "浙江大学宁波校区", "complete", "杭州市西湖区文三路1号"),
        ("", None, "浙江大学杭州校区", "empty", ""),
        (None, None, None, "empty", ""),
        ("西湖区求是村校区", None, None, "complete", "杭州市西湖区求是村校区"),
        ("西湖区北校区", None, None, "partial", "杭州市西湖区北校区"),
    ]
    got = normalize(spark, [c[:3] for c in cases]).orderBy("record_id").collect()
    assert [(r.normalization_status, r.normalized_address) for r in got] == [c[3:] for c in cases]
    assert {r.note for r in got} == {"kept"}
    by = [r.resolved_city for r in got]
    assert by[15] == "南京市" and by[16] == "南京市" and by[17] == "南京市" and by[20] == "宁波市" and by[12] == "杭州市"
    # a complete address is a fixed point, however the rows are dealt
    done = [(r.normalized_address, None, None) for r in got if r.normalization_status == "complete"]
    again = normalize(spark, done).repartition(3).collect()
    assert {r.normalized_address for r in again} == {d[0] for d in done} and {r.normalization_status for r in again} == {"complete"}


def test_cities_with_streets_and_municipalities(spark):
    streets = [("南城街道", "1", "street"), ("虎门镇", "2", "town")]
    got = normalize(spark, [("南城街道元美路1号", None, None), ("元美路1号", None, None)], "苏州市", "江苏省", streets).orderBy("record_id").collect()
    assert [r.normalization_status for r in got] == ["complete", "partial"]
    got = normalize(spark, [("北京市朝阳区望京街1号", None, None), ("朝阳区望京街1号", None, None)], "北京市", None, []).orderBy("record_id").collect()
    assert [r.normalized_address for r in got] == ["北京市朝阳区望京街1号"] * 2


def test_validation_and_scope(spark):
    rows = [(1, "杭州市", " ", "a", "web_search", "x", {}, ""), (2, "杭州市", "n", "a", "rumour", "x", {}, ""), (3, "杭州市", "n", None, "map_search", " ", {}, ""), (4, "杭州市", "n", "文三路1号", "web_search", "x", {"administrative_unit": "西湖区", "subdivision_scope": "city"}, "")]
    good, bad = split_invalid(spark.createDataFrame(rows, RECORD))
    assert sorted(r.record_id for r in bad.collect()) == [1, 2, 3]
    assert normalize_records(good, context(spark), CATALOG).first().normalization_status == "partial"
    with pytest.raises(Exception, match="每条地址记录|source_nature"):
        split_invalid(spark.createDataFrame(rows, RECORD), strict=True)[0].collect()


def column(spark, values, build):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", build(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_keys_and_parts(spark):
    assert column(spark, ["中国浙江省杭州市西湖区文三路 12号东", "杭州市大学城文三路12号", "下沙大学城文三路12号", "文三路13号", "没有门牌", "西湖区1号", None], A.equivalence_key) == ["文三路12号", "大学城文三路12号", "大学城文三路12号", "文三路13号", "没有门牌", "西湖区1号", ""]
    assert column(spark, ["解放街与文三路交叉口12号", "西湖区", "南山路东"], A.road_of) == ["与文三路", "", "南山路东"]
    assert column(spark, ["文三路12-3号院", "甲3号与5号", "无"], A.number_of) == ["12-3号院", "甲3号", ""]
    assert column(spark, ["大学城文三路12号东校区", "北校区"], lambda c: F.array_join(A.anchors_of(c), ",")) == ["大学城,东校区", "北校区"]
    assert column(spark, ["文三街道文一路", "西湖区文一路", "无单位"], A.unit_of) == ["文三街道", "西湖区", ""]
    assert column(spark, ["consistent", " x ", None, "needs_review"], A.status_label) == ["一致", "x", "未查询", "部分匹配·待复核"]
    pairs = [("第一中学（新校区）", "第一中学校区"), ("第一中学", "杭州市西湖区文三街道第一中学"), ("第一中学", "第一中学(在建)"), ("第一中学", "第一中学分部"), ("镇", "镇")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    assert [r.m for r in df.select("i", A.names_match(F.col("a"), F.col("b"), F.lit("杭州市"), F.lit("西湖区")).alias("m")).orderBy("i").collect()] == [True, True, True, False, True]


def test_judging(spark):
    source = "杭州市西湖区文三路12号"
    cases = [
        ("浙江省杭州市西湖区文三路12号", "杭州市", "西湖区", "consistent"), ("浙江省杭州市西湖区文三路", "杭州市", "西湖区", "partial"), ("浙江省杭州市西湖区文三路13号", "杭州市", "西湖区", "conflict"), ("浙江省杭州市西湖区学院路12号", "杭州市", "西湖区", "conflict"),
        ("浙江省杭州市滨江区文三路12号", "杭州市", "滨江区", "conflict"), ("浙江省宁波市西湖区文三路12号", "宁波市", "西湖区", "conflict"), ("浙江省杭州市西湖区文三路东12号", "杭州市", "西湖区", "partial"), ("浙江省杭州市西湖区北文三路12号", "杭州市", "西湖区", "partial"),
    ]
    make = lambda a, c, d: F.struct(F.lit(a).alias("formatted_address"), F.lit("浙江省").alias("province"), F.lit(c).alias("city"), F.lit(d).alias("district"), F.lit("").alias("street"), F.lit("").alias("number"))
    for a, c, d, want in cases:
        row = spark.range(1).select(match.best_geocode(F.lit(source), F.lit("杭州市"), F.array(make(a, c, d))).alias("b")).first().b
        assert row.status == want, (a, row)
    both = F.array(*[make(*x[:3]) for x in (cases[2], cases[1], cases[0], cases[0])])
    assert spark.range(1).select(match.best_geocode(F.lit(source), F.lit("杭州市"), both)["pos"].alias("p")).first().p == 2


GEO = f"asked_address string, asked_city string, error string, candidates {match.GEOCODES}"
POI = f"asked_name string, asked_city string, error string, candidates {match.POIS}"


def test_resolution(spark):
    cases = [("文三路12号", None, "甲"), ("西湖区", None, "乙校"), ("西湖区文三路12号", None, "丙"), ("江苏省南京市1区", None, "丁"), ("", None, "戊校"), ("西湖区高楼旁边", None, "己"), ("学院路3号", None, "庚"), ("文一路5号", None, "辛")]
    geo = [("杭州市文三路12号", "杭州市", "", [("浙江省杭州市西湖区文三路12号", "浙江省", "杭州市", "西湖区", "", "")]), ("杭州市学院路3号", "杭州市", "busy", [])]
    poi = [("乙校", "杭州市", "", [("乙校", "杭州市", "西湖区", "文一路1号", "学校", "1"), ("乙校", "杭州市", "西湖区", "文一路1号", "学校", "1"), ("乙校", "杭州市", "西湖区", "文一路2号", "公交车站", "2")]), ("戊校", "杭州市", "", [("戊校", "杭州市", "西湖区", "文一路1号", "学校", "1"), ("戊校", "杭州市", "西湖区", "文一路2号（近地铁口出口）", "学校", "1")])]
    done = match.resolve_records(normalize(spark, cases, keep=True), CATALOG, spark.createDataFrame(geo, GEO), spark.createDataFrame(poi, POI)).cache()
    got = {r.record_id: r for r in done.collect()}
    assert (got[0].map_match_status, got[0].final_address, got[0].final_address_source) == ("partial", "杭州市西湖区文三路12号", "map")
    assert (got[1].map_match_status, got[1].final_address, got[1].map_request_count) == ("poi_match", "杭州市西湖区文一路1号", 1)
    assert (got[2].route, got[2].map_match_status, got[2].final_address_source) == ("valid", "skipped", "official")
    assert (got[3].map_match_status, got[3].final_address, got[3].map_request_count) == ("skipped", "", 0)
    assert (got[4].map_match_status, got[4].final_address) == ("ambiguous", "")
    assert (got[5].map_match_status, got[5].final_address) == ("needs_review", "杭州市西湖区高楼旁边")
    assert (got[6].map_match_status, got[6].map_reason, got[6].final_address) == ("error", "busy", "杭州市学院路3号")
    assert (got[7].map_match_status, got[7].final_address_source) == ("not_found", "official")
    one = metrics.resolution_metrics(done, "杭州市").first()
    assert one.item_count == 8 and one.out_of_city_address_count == 1 and one.normalization_status_counts["partial"] == 4 and one.map_request_count == 6
    keyless = {r.record_id: r.map_match_status for r in match.resolve_without_key(normalize(spark, cases, keep=True)).collect()}
    assert keyless[0] == "error" and keyless[2] == "skipped"


def test_search_names(spark):
    rows = [("甲", {"campus_name": "甲东校区", "poi_name_aliases": '["甲（东）校区", "", "乙", "甲东校区", "乙"]'}), ("甲", {"poi_name_aliases": "乙"}), ("甲", {})]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, place_name string, attributes map<string,string>")
    assert [r.n for r in df.select("i", match.search_names().alias("n")).orderBy("i").collect()] == [["甲", "甲东校区", "乙"], ["甲", "乙"], ["甲"]]


def test_catalog(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"municipalities": ["北京市"], "province_cities": {"浙江省": ["杭州市", "宁波市"], "x": ["甲盟"]}}')
    catalog = read_catalog(spark, str(path))
    assert catalog == {"北京市": None, "杭州市": "浙江省", "宁波市": "浙江省", "甲盟": "x"}
    path.write_text('{"municipalities": ["北京市"], "province_cities": {"浙江省": ["北京市"]}}')
    with pytest.raises(ValueError, match="repeats"):
        read_catalog(spark, str(path))
    df = spark.createDataFrame([("杭州",), ("甲",), (" 北京市 ",), ("乙",), (None,)], "c string")
    got = {r.c: (r.city_name, bool(r.city_error)) for r in resolve_city_names(df, "c", catalog_frame(spark, {**catalog, "乙市": None, "乙盟": None})).collect()}
    assert got == {"杭州": ("杭州市", False), "甲": ("甲盟", False), " 北京市 ": ("北京市", False), "乙": (None, True), None: (None, True)}


def test_subdivisions(spark):
    body = '{"districts": [{"name": "甲市", "districts": [{"name": "乙市", "adcode": "1", "level": "city"}]}, {"name": "丙"}]}'
    row = spark.range(1).select(subdivisions_of(F.parse_json(F.lit(body)), F.lit("甲市")).alias("s")).first().s
    assert row.next_city == "乙市" and row.error == "" and row.subdivisions[0].adcode == "1"
