"""Map verification: judging geocodes, matching points of interest, choosing the final address.

Answers of the map service are tables: ``geocodes`` (asked_address, asked_city, error, candidates) and ``pois``
(asked_name, asked_city, error, candidates), one row per query, candidates in the order of the service.  A route
is worked out first, so only the records that need an answer take part in a join.  Records need a unique
``record_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placewright.functions.address import (
    AUXILIARY_TEXT, AUXILIARY_TYPE, LIST_PLACE, MUNICIPALITIES, NO_UNIT, admin_key, anchors_of, detail_score, has, name_key, names_match, number_key, number_of, place_of, road_of, road_relation, target_unit, unit_of, without_guides,
)
from placewright.functions.text import compact, drop_prefix, let, stage, strip, text
from placewright.operators.city import Catalog, catalog_literals
from placewright.operators.normalize import CONTEXT_COLUMNS, RESULT, is_valid_structure, normalize_values

MAP_COLUMNS = ["map_address", "map_match_status", "map_reason", "map_poi_type", "map_poi_typecode", "final_address", "final_address_source", "final_address_reason"]
GEOCODES = "array<struct<formatted_address:string,province:string,city:string,district:string,street:string,number:string>>"
POIS = "array<struct<name:string,cityname:string,adname:string,address:string,type:string,typecode:string>>"
PRIORITY = {"consistent": 0, "partial": 1, "conflict": 2}


def source_parts(address: Column, city: Column) -> Column:
    """city, admin_unit, detail, road, number and anchors of a normalized address."""
    parts = lambda x: F.struct(city.alias("city"), x["unit"].alias("admin_unit"), x["place"].alias("detail"), road_of(x["place"]).alias("road"), number_of(x["place"]).alias("number"), anchors_of(x["place"]).alias("anchors"))
    split = lambda rest: F.struct(unit_of(rest).alias("unit"), place_of(rest).alias("place"))
    return let(drop_prefix(strip(address), city), lambda rest: let(split(rest), parts))


def map_parts(candidate: Column, source_city: Column) -> Column:
    """city, admin_unit, street, number and address of a geocode candidate."""
    plain = F.struct(*[strip(candidate[k]).alias(k) for k in ("formatted_address", "province", "city", "district", "street", "number")])
    or_else = lambda a, b: F.when(a != "", a).otherwise(b)

    def parts(x: Column) -> Column:
        city = F.when((x["city"] == "") & source_city.isin(*MUNICIPALITIES), x["province"]).otherwise(x["city"])

        def with_city(city: Column) -> Column:
            rest = compact(x["formatted_address"])
            for part in (x["province"], city, x["district"]):
                rest = drop_prefix(rest, compact(part))
            return let(rest, lambda r: F.struct(city.alias("city"), x["district"].alias("admin_unit"), or_else(x["street"], road_of(r)).alias("street"), or_else(x["number"], number_of(r)).alias("number"), x["formatted_address"].alias("address")))

        return let(city, with_city)

    return let(plain, parts)


def judge(address: Column, source: Column, found: Column) -> Column:
    """(status, reason) of a candidate against the parts of a normalized address."""
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    differ = lambda key: (source[key] != "") & (found[key] != "") & (admin_key(source[key]) != admin_key(found[key]))
    near = F.when((source["road"] != "") & (found["street"] != ""), road_relation(source["road"], found["street"])).otherwise("")
    return let(near, lambda relation: let(_gaps(source, found, relation), lambda gaps: _verdict(address, source, found, relation, gaps, say, differ)))


def _gaps(source: Column, found: Column, relation: Column) -> Column:
    """What the candidate lacks of the parts of the address."""
    lacks = lambda key, other, label: F.when((source[key] != "") & (found[other] == ""), F.lit(label))
    return F.array_compact(
        F.array(
            lacks("city", "city", "地图城市"), lacks("admin_unit", "admin_unit", "地图下级行政区"), lacks("road", "street", "地图道路"),
            F.when(relation == "suffix", F.lit("道路简称")).when(relation == "partial", F.lit("道路方位或辅路信息不完整")), lacks("number", "number", "地图门牌号"),
        )
    )


def _verdict(address: Column, source: Column, found: Column, relation: Column, gaps: Column, say, differ) -> Column:
    both_numbers = (source["number"] != "") & (found["number"] != "")
    anchored = F.exists(source["anchors"], lambda a: F.contains(compact(found["address"]), compact(a)))
    result = lambda status, reason: F.struct(F.lit(status).alias("status"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))
    return (
        F.when(differ("city"), result("conflict", say("城市冲突：规范地址“", source["city"], "”，地图“", found["city"], "”")))
        .when(differ("admin_unit"), result("conflict", say("下级行政区冲突：规范地址“", source["admin_unit"], "”，地图“", found["admin_unit"], "”")))
        .when(relation == "conflict", result("conflict", say("道路冲突：规范地址“", source["road"], "”，地图“", found["street"], "”")))
        .when(both_numbers & (number_key(source["number"]) != number_key(found["number"])), result("conflict", say("门牌号冲突：规范地址“", source["number"], "”，地图“", found["number"], "”")))
        .when((F.array_join(gaps, "、") == "道路简称") & both_numbers, result("partial", say("道路简称：规范地址“", source["road"], "”，地图“", found["street"], "”")))
        .when(F.size(gaps) > 0, result("partial", say("无明确冲突，但以下规范地址组件未获地图支持：", F.array_join(gaps, "、"))))
        .when(compact(address) == compact(found["address"]), result("consistent", "规范地址与地图地址文本完全相同"))
        .when((relation != "") & (source["number"] != ""), result("consistent", "行政区、道路和门牌号均一致"))
        .when(relation != "", result("consistent", "行政区和道路一致；地图新增门牌号不改变规范地址"))
        .when(anchored, result("consistent", "行政区和地点锚点一致"))
        .otherwise(result("partial", "无明确冲突，但缺少可确认一致的道路、门牌号或地点锚点"))
    )


def best_geocode(address: Column, city: Column, candidates: Column) -> Column:
    """The candidate with the best status, the first of equal ones: struct rank, pos, map_address, status, reason."""

    def ranked(verdict: Column, found: Column, pos: Column) -> Column:
        rank = F.coalesce(*[F.when(verdict["status"] == s, F.lit(r)) for s, r in PRIORITY.items()])
        return F.struct(rank.alias("rank"), pos.alias("pos"), found["address"].alias("map_address"), verdict["status"].alias("status"), verdict["reason"].alias("reason"))

    def judged(source: Column):
        return lambda candidate, pos: let(map_parts(candidate, city), lambda found: let(judge(address, source, found), lambda verdict: ranked(verdict, found, pos)))

    return let(source_parts(address, city), lambda source: F.array_min(F.transform(candidates, judged(source))))


def _evidence(source: Column, map_address: Column) -> tuple[Column, Column, Column]:
    """(same road, same number, the map names a road)."""
    road, number = road_of(map_address), number_of(map_address)
    same_road = (source["road"] != "") & (road != "") & (compact(source["road"]) == compact(road))
    same_number = (source["number"] != "") & (number != "") & (number_key(source["number"]) == number_key(number))
    return same_road, same_number, road != ""


def final_choice(df: DataFrame) -> DataFrame:
    """The decision between official and map address, from normalized_address, RESULT and the map columns."""
    c, city = F.col, F.col("city_name")
    official, found = strip("normalized_address"), strip("map_address")
    df = stage(df, __s=source_parts(c("normalized_address"), city))
    same_road, same_number, map_road = _evidence(c("__s"), found)
    auxiliary = has(found, AUXILIARY_TEXT)
    df = stage(df, **{
        "__aux": auxiliary,
        "__proved": (found != "") & (same_road | same_number | F.exists(c("__s.anchors"), lambda a: F.contains(compact(found), compact(a)))),
        "__district": (found != "") & ~auxiliary & (same_road | (same_number & map_road)),
        "__more": detail_score(found, city) > detail_score(official, city),
        "__nounit": (strip("normalization_status") == "partial") & (strip("normalization_reason") == NO_UNIT),
    })
    status, reason = strip("map_match_status"), strip("map_reason")
    pick = lambda s, r, source, why: F.struct((F.lit(s) if isinstance(s, str) else s).alias("map_match_status"), (F.lit(r) if isinstance(r, str) else r).alias("map_reason"), (found if source == "map" else official).alias("final_address"), F.lit(source).alias("final_address_source"), F.lit(why).alias("final_address_reason"))
    keep = lambda why: pick(status, reason, "official", why)
    helper = pick("needs_review", "地图结果含辅助 POI 文本，未采用地图地址", "official", "地图地址含辅助 POI 文本，保留官网地址待复核")
    richer = pick(status, reason, "map", "地图地址更详细")
    fine = status.isin("consistent", "partial")
    unit_gap = "官网地址缺少下级行政区，地图无法确证，保留官网地址待复核"
    take = c("__more") & ((status == "consistent") | ((status == "partial") & c("__proved")))
    chosen = (
        F.when(found == "", keep("地图未提供可用地址，保留来源地址"))
        .when(status == "conflict", keep("地址组件冲突，保留来源地址"))
        .when(c("__nounit") & fine & c("__district"), pick("partial", "地图补充下级行政区", "map", "地图补充来源地址缺少的下级行政区"))
        .when(c("__nounit") & fine & c("__aux"), pick("needs_review", "地图结果含辅助 POI 文本，未补充下级行政区", "official", unit_gap))
        .when(c("__nounit") & fine, pick("needs_review", "地图补充下级行政区未经道路确证", "official", unit_gap))
        .when(take & c("__aux"), helper)
        .when(take, richer)
        .when((status == "partial") & ~c("__proved") & c("__more"), pick("needs_review", "地图地址未经道路/门牌/锚点确证", "official", "地图地址未经确证，保留官网地址待复核"))
        .when(fine, keep("来源地址不比地图地址简略"))
        .otherwise(keep("地图状态未支持采用地图地址，保留来源地址"))
    )
    df = stage(df, __f=chosen)
    return df.withColumns({k: c(f"__f.{k}") for k in ("map_match_status", "map_reason", "final_address", "final_address_source", "final_address_reason")}).drop("__s", "__aux", "__proved", "__district", "__more", "__nounit", "__f")


def with_map_columns(df: DataFrame) -> DataFrame:
    """Blank result columns, in place of those that are there."""
    return df.withColumns({k: F.lit("") for k in MAP_COLUMNS})


def _normalized_again(df: DataFrame, column: str, unit: Column, literals: tuple[Column, Column]) -> DataFrame:
    """``column`` as a normalized address, '' if it isn't complete or partial; the record's own RESULT stays."""
    held = df.withColumns({f"__own_{k}": F.col(k) for k in RESULT})
    held = normalize_values(held, column, unit, *literals)
    usable = F.when(F.col("normalization_status").isin("complete", "partial"), F.col("normalized_address")).otherwise("")
    return stage(held, **{column: usable}).withColumns({k: F.col(f"__own_{k}") for k in RESULT}).drop(*[f"__own_{k}" for k in RESULT])


def _answers(table: DataFrame, query: str, kind: str) -> DataFrame:
    """One answer for each query of a service table: __error, __c (candidates) and __tries, the requests that it took.

    A table that repeats a query has one without an error counted, so no record is multiplied.
    """
    tries = F.col("attempts").cast("int") if "attempts" in table.columns else F.lit(1)
    answer = F.struct(F.coalesce("error", F.lit("")).alias("__error"), F.coalesce("candidates", F.array().cast(kind)).alias("__c"), F.coalesce(tries, F.lit(1)).alias("__tries"))
    return table.groupBy(query, "asked_city").agg(F.min(answer).alias("a")).select(query, "asked_city", "a.*")


def verify_by_geocode(df: DataFrame, geocodes: DataFrame, literals: tuple[Column, Column]) -> DataFrame:
    """Map columns from the best geocode of the normalized address; a query without a row found nothing."""
    asked = _answers(geocodes, "asked_address", GEOCODES).withColumnsRenamed({"asked_address": "__qa", "asked_city": "__qc"})
    df = with_map_columns(df).join(asked, (F.col("normalized_address") == F.col("__qa")) & (F.col("city_name") == F.col("__qc")), "left")
    df = stage(df, __best=F.when(F.coalesce("__error", F.lit("")) == "", best_geocode(F.col("normalized_address"), F.col("city_name"), F.col("__c"))))
    failed = F.coalesce("__error", F.lit("")) != ""
    df = df.withColumns({
        "map_address": F.coalesce("__best.map_address", F.lit("")),
        "map_match_status": F.when(failed, "error").otherwise(F.coalesce("__best.status", F.lit("not_found"))),
        "map_reason": F.when(failed, F.col("__error")).otherwise(F.coalesce("__best.reason", F.lit("高德服务正常但未找到结果"))),
        "map_request_count": F.lit(1),
        "actual_http_attempt_count": F.coalesce("__tries", F.lit(1)),
    })
    df = df.drop("__qa", "__qc", "__error", "__c", "__tries", "__best")
    return _normalized_again(df, "map_address", target_unit(F.col("attributes")), literals)


def search_names() -> Column:
    """The names to look a record up by: its own, its campus, its aliases that aren't among them."""
    a = F.col("attributes")
    campus = strip(F.try_element_at(a, F.lit("campus_name")))
    own = F.filter(F.array(F.col("place_name"), F.when(campus != F.col("place_name"), campus).otherwise("")), lambda x: x != "")
    given = F.try_element_at(a, F.lit("poi_name_aliases"))
    aliases = F.coalesce(F.from_json(given, "array<string>"), F.array(given))
    aliases = F.filter(F.transform(aliases, strip), lambda x: x != "")
    fresh = F.filter(aliases, lambda x, i: ~F.exists(own, lambda o: name_key(o) == name_key(x)) & ~F.exists(F.slice(aliases, F.lit(1), i), lambda o: name_key(o) == name_key(x)))
    return F.concat(own, F.coalesce(fresh, F.array().cast("array<string>")))


def find_by_poi(df: DataFrame, pois: DataFrame, literals: tuple[Column, Column]) -> DataFrame:
    """Map columns from points of interest: the first name with exactly one matching address."""
    c = F.col
    asked = _answers(pois, "asked_name", POIS).withColumnsRenamed({"asked_name": "__qn", "asked_city": "__qc"})
    unit = target_unit(c("attributes"))
    whole = F.struct(*[F.col(f"`{k}`") for k in df.columns]).alias("__whole")
    names = df.select("record_id", "city_name", *CONTEXT_COLUMNS, *RESULT, unit.alias("__unit0"), whole, F.posexplode_outer(search_names()).alias("turn", "name"))
    names = names.join(asked, (c("name") == c("__qn")) & (c("city_name") == c("__qc")), "left")
    rows = names.select("record_id", "turn", "name", "city_name", *CONTEXT_COLUMNS, *RESULT, "__unit0", "__whole", F.coalesce("__error", F.lit("")).alias("__error"), F.coalesce("__tries", F.lit(1)).alias("__tries"), F.posexplode_outer("__c").alias("pos", "p"))
    get = lambda k: strip(c(f"p.{k}"))
    fits = (
        c("p").isNotNull() & names_match(c("name"), get("name"), c("city_name"), c("__unit0")) & (name_key(get("cityname")) == name_key(c("city_name")))
        & ((c("__unit0") == "") | (name_key(get("adname")) == name_key(c("__unit0")))) & ~has(get("type"), AUXILIARY_TYPE)
    )
    detail, area = get("address"), get("adname")
    line = F.when(detail == "", "").when(F.startswith(detail, c("city_name")), detail).when((area != "") & F.startswith(detail, area), F.concat("city_name", detail)).otherwise(F.concat(c("city_name"), area, detail))
    rows = stage(rows, __fits=F.coalesce(fits, F.lit(False)))
    rows = stage(rows, found=F.when(F.col("__fits"), line).otherwise(""))
    rows = _normalized_again(rows, "found", c("__unit0"), literals).withColumn("found", without_guides("found"))
    good = c("__fits") & (c("found") != "")
    per_name = rows.groupBy("record_id", "turn").agg(
        F.max("__error").alias("error"),
        F.max("__tries").alias("tries"),
        F.any_value("__whole").alias("whole"),
        F.size(F.collect_set(F.when(good, compact("found")))).alias("n"),
        F.min(F.when(good, F.struct("pos", c("found").alias("address"), get("type").alias("type"), get("typecode").alias("typecode")))).alias("first"),
    )
    # names are asked in turn until one matches or fails; otherwise the last verdict stands
    stops = (c("error") != "") | (c("n") == 1)
    verdict = F.struct((~stops).alias("goes_on"), F.when(stops, c("turn")).otherwise(-c("turn")).alias("order"), c("turn"), c("error"), c("n"), c("first"))
    entries = F.collect_list(F.when(c("turn").isNotNull(), F.struct("turn", "tries")))
    one = per_name.groupBy("record_id").agg(F.min(F.when(c("turn").isNotNull(), verdict)).alias("v"), F.map_from_entries(entries).alias("tries"), F.any_value("whole").alias("whole"))
    df = with_map_columns(one.select("whole.*", "v", "tries"))
    asked_turns = F.filter(F.map_entries("tries"), lambda e: e["key"] <= c("v.turn"))
    v, hit = c("v"), (c("v.error") == "") & (c("v.n") == 1)
    status = F.when(v.isNull(), "").when(c("v.error") != "", "error").when(c("v.n") == 1, "poi_match").when(c("v.n") > 1, "ambiguous").otherwise("not_found")
    reasons = {"error": c("v.error"), "poi_match": F.lit("唯一名称匹配的 POI"), "ambiguous": F.lit("名称完全一致的 POI 对应多个不同地址"), "not_found": F.lit("未找到名称、城市和地址均匹配的 POI")}
    reason = F.coalesce(*[F.when(status == s, r) for s, r in reasons.items()], F.lit(""))
    pick = lambda k: F.when(hit, c(f"v.first.{k}")).otherwise("")
    return df.withColumns({"map_address": F.coalesce(pick("address"), F.lit("")), "map_poi_type": F.coalesce(pick("type"), F.lit("")), "map_poi_typecode": F.coalesce(pick("typecode"), F.lit("")), "map_match_status": status, "map_reason": reason, "map_request_count": F.coalesce(c("v.turn") + 1, F.lit(0)), "actual_http_attempt_count": F.coalesce(F.aggregate(asked_turns, F.lit(0), lambda n, e: n + e["value"]), F.lit(0))}).drop("v", "tries")


def route_of() -> Column:
    """How a normalized record is settled: placeholder, valid, list_official, list_geocode, list_poi, geocode, poi or skip."""
    return let(source_parts(F.col("normalized_address"), F.col("city_name")), _route)


def _route(s: Column) -> Column:
    c, official = F.col, strip("normalized_address")
    checkable = (s["number"] != "") | ((s["road"] != "") & ~F.endswith(s["road"], F.lit("街道")))
    listed = (official != "") & ((s["road"] != "") | (s["number"] != "") | has(s["detail"], LIST_PLACE))
    status = c("normalization_status")
    return (
        F.when(c("address_mode") == "map_search", "placeholder")
        .when(is_valid_structure() & checkable, "valid")
        .when((c("address_mode") == "government_list") & listed & (c("normalization_reason") == NO_UNIT), "list_geocode")
        .when((c("address_mode") == "government_list") & listed, "list_official")
        .when(c("address_mode") == "government_list", "list_poi")
        .when(status.isin("complete", "partial") & checkable, "geocode")
        .when(status.isin("empty", "partial", "complete"), "poi")
        .otherwise("skip")
    )


#: For routes that ask nothing, the reason, whose address counts, and why.
SETTLED = {
    "placeholder": ("map_search 模式为占位，本轮不执行自动高德检索", "", ""),
    "valid": ("地址有效，无需地图验证", "official", "来源地址有效，直接采用"),
    "list_official": ("政府资料地址已含道路门牌或具体地点，直接采用官方地址", "official", "政府资料地址"),
}


def _settled(df: DataFrame) -> DataFrame:
    """The records whose route asks the map nothing."""
    c, official = F.col, strip("normalized_address")
    by_route = lambda i, other: F.coalesce(*[F.when(c("route") == r, F.lit(v[i])) for r, v in SETTLED.items()], other)
    gap = strip("normalization_reason")
    skipped = F.when(gap != "", gap).otherwise(F.concat(F.lit("web_search 的 "), c("normalization_status"), F.lit(" 地址不调用高德")))
    source = by_route(1, F.lit(""))
    return with_map_columns(df).withColumns({
        "map_match_status": F.lit("skipped"),
        "map_reason": by_route(0, skipped),
        "final_address": F.when(source == "official", official).otherwise(""),
        "final_address_source": source,
        "final_address_reason": by_route(2, F.lit("")),
        "map_request_count": F.lit(0),
        "actual_http_attempt_count": F.lit(0),
    })


def resolve_records(normalized: DataFrame, catalog: Catalog, geocodes: DataFrame, pois: DataFrame) -> DataFrame:
    """Final addresses of records from ``normalize_records(..., keep_context=True)``.

    Three branches, by what a record asks: nothing, a geocode, or points of interest.
    """
    literals = catalog_literals(normalized.sparkSession, catalog)
    df = stage(normalized, route=route_of())
    c, official = F.col, strip("normalized_address")
    by_geocode, by_poi = c("route").isin("geocode", "list_geocode"), c("route").isin("poi", "list_poi")
    settled = _settled(df.filter(~by_geocode & ~by_poi))
    located = final_choice(verify_by_geocode(df.filter(by_geocode), geocodes, literals))
    found = find_by_poi(df.filter(by_poi), pois, literals)
    listed, hit = c("route") == "list_poi", c("map_match_status") == "poi_match"
    unsure = ~listed & (c("normalization_status") == "complete") & (official != "") & c("map_match_status").isin("not_found", "ambiguous")
    detailed = unsure & let(source_parts(c("normalized_address"), c("city_name")), lambda s: (s["road"] != "") | (s["number"] != "") | (s["detail"] != ""))
    keeps = (listed & (official != "")) | unsure
    found = stage(found, **{
        "final_address": F.when(hit, c("map_address")).when(keeps, official).otherwise(""),
        "final_address_source": F.when(hit, "map").when(keeps, "official").otherwise(""),
        "final_address_reason": F.when(hit & listed, "政府资料地址不完整，按地点名称补充地图地址").when(hit, "POI 名称匹配地址").when(listed & (official != ""), "政府资料地址")
        .when(detailed, "官网地址缺少可验证道路或门牌，地图未确认，保留官网地址待复核").when(unsure, "官网地址缺少可验证道路或门牌，地图未确认，保留来源地址").otherwise(""),
        "map_reason": F.when(detailed, "官网地址缺少可验证道路或门牌，地图未确认完整地址").otherwise(c("map_reason")),
        "map_match_status": F.when(detailed, "needs_review").otherwise(c("map_match_status")),
    })
    return settled.unionByName(located).unionByName(found).drop(*CONTEXT_COLUMNS)


def resolve_without_key(normalized: DataFrame) -> DataFrame:
    """What a run without access to the map service gives: records that need it get the status ``error``."""
    empty = lambda schema: normalized.sparkSession.createDataFrame([], T._parse_datatype_string(schema))
    done = resolve_records(normalized, {}, empty(f"asked_address string, asked_city string, error string, candidates {GEOCODES}"), empty(f"asked_name string, asked_city string, error string, candidates {POIS}"))
    asks = F.col("route").isin("geocode", "list_geocode", "poi", "list_poi")
    keeps = F.col("route").isin("geocode", "list_geocode")
    official = text("normalized_address")
    return done.withColumns({
        "map_match_status": F.when(asks, "error").otherwise(F.col("map_match_status")),
        "map_reason": F.when(asks, "未配置 AMAP_KEY").otherwise(F.col("map_reason")),
        "map_request_count": F.lit(0),
        "actual_http_attempt_count": F.lit(0),
        "final_address": F.when(asks & ~keeps & (F.col("route") == "poi"), "").otherwise(F.when(keeps, official).otherwise(F.col("final_address"))),
        "final_address_source": F.when(F.col("route") == "poi", "").otherwise(F.col("final_address_source")),
        "final_address_reason": F.when(F.col("route") == "poi", "").when(keeps, "地图未提供可用地址，保留来源地址").otherwise(F.col("final_address_reason")),
    })
