"""Address records: validation and normalization to city, unit and place.

``normalize_records`` works in stages, a projection for each, because later steps see what earlier ones changed.
Records are joined with the context of their city once; the catalog is a constant of the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewright.functions.address import CITY, DISTRICT, LOWER_SUFFIXES, MODES, NO_PLACE, NO_UNIT, PROVINCE, SHORT_CITY, UNIT_SUFFIXES, cleaned, group, has, is_specific, is_zone, mode_of, target_unit, unit_of
from placewright.functions.text import after, stage, strip, text, without_space
from placewright.operators.city import Catalog, catalog_literals, prepared_contexts

RESULT = ["normalized_address", "normalization_status", "normalization_reason", "resolved_city"]


def record_error(df: DataFrame) -> Column:
    """What is wrong with an address record, or ''."""
    mode = F.col("address_mode") if "address_mode" in df.columns else F.lit(None).cast("string")
    return (
        F.when(strip("place_name") == "", "每条地址记录必须包含非空 place_name")
        .when(~F.coalesce(F.col("source_nature"), F.lit("")).isin(*MODES), "source_nature 必须是 web_search、government_information 或 map_search")
        .when(mode.isNotNull() & ~mode.isin(*MODES.values()), "address_mode 必须是 web_search、government_list 或 map_search")
        .when(strip("source_reference") == "", "每条地址记录必须包含非空 source_reference")
        .otherwise("")
    )


def split_invalid(df: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid records, quarantined records with validation_error); ``strict`` raises on the first bad one when run."""
    if "original_address" not in df.columns:
        raise ValueError("每条地址记录必须包含 original_address 字段")
    marked = df.withColumn("validation_error", record_error(df))
    if strict:
        marked = marked.withColumn("validation_error", F.when(F.col("validation_error") == "", "").otherwise(F.raise_error(F.col("validation_error")).cast("string")))
    return marked.filter("validation_error = ''").drop("validation_error"), marked.filter("validation_error <> ''")


def city_prefix(address: Column, shorts: Column) -> Column:
    """The city that an address starts with: a full name, or a short one right before a district."""
    rest = after(address, F.length(group(address, PROVINCE)))
    short = group(rest, SHORT_CITY)
    full = F.try_element_at(shorts, short)
    return F.when(has(rest, CITY), group(rest, CITY)).when(short == "", "").when(F.size(full) == 1, F.get(full, F.lit(0))).otherwise(short)


def foreign_campus(place: Column, city: Column, city_short: Column, shorts: Column) -> Column:
    """Full name of another city whose campus a place name names, '' if none."""
    entries = F.filter(F.map_entries(shorts), lambda e: (e["key"] != "") & (e["key"] != city_short) & ~F.array_contains(e["value"], city) & (F.contains(place, F.concat(e["key"], F.lit("校区"))) | F.contains(place, F.concat(e["key"], F.lit("校园")))))
    return F.when(has(place, "校区|校园"), F.coalesce(F.get(F.get(entries, F.lit(0))["value"], F.lit(0)), F.lit(""))).otherwise("")


def normalize_values(df: DataFrame, column: str, unit: Column, full: Column, shorts: Column) -> DataFrame:
    """Add the RESULT columns for an address column; ``df`` has the columns of ``prepared_contexts``."""
    c = F.col
    df = cleaned(df.withColumn("__raw", text(column)).withColumn("__unit", without_space(unit)), "__raw", "__clean")
    # country and province
    df = df.withColumn("__a", F.regexp_replace("__clean", "^(?:中华人民共和国|中国)", ""))
    own = (c("province_name") != "") & F.startswith("__a", c("province_name"))
    bare = F.regexp_replace("province_name", "省$", "")
    brief = (c("province_name") != bare) & F.startswith(c("__a"), bare)
    other = ~own & ~brief & has(c("__a"), PROVINCE)
    df = df.withColumn("__why", F.when(other, F.concat(F.lit("原始地址中的省级单位与目标城市不一致："), group(c("__a"), PROVINCE))).otherwise(""))
    df = df.withColumn("__a", F.when(own, after(c("__a"), F.length("province_name"))).when(brief, after(c("__a"), F.length(bare))).otherwise(c("__a")))
    # short city and short district side by side
    rest = after(c("__a"), F.length("city_short"))
    fits = F.filter("unit_cores", lambda x: F.startswith(rest, x["core"]) & ~has(after(rest, F.length(x["core"])), "^[区县旗]"))
    pick = F.get(fits, F.lit(0))
    df = df.withColumn("__a", F.when((c("city_name") != "") & F.startswith("__a", c("city_short")) & pick.isNotNull(), F.concat(pick["full"], after(rest, F.length(pick["core"])))).otherwise(c("__a")))
    # the city, or another one
    rest = after(c("__a"), F.length("city_short"))
    district = group(rest, DISTRICT)
    by_full = F.startswith(c("__a"), c("city_name"))
    by_short = F.startswith(c("__a"), c("city_short")) & (district != "") & ~is_zone(district)
    named, brief_name, brief_unit = group(c("__a"), CITY), group(c("__a"), SHORT_CITY), group(c("__a"), SHORT_CITY, 2)
    foreign = (
        F.when(by_full | by_short, "")
        .when(F.array_contains(full, named) & (named != c("city_name")), named)
        .when((brief_name != "") & ~has(brief_unit, "^[区县旗]") & F.map_contains_key(shorts, brief_name) & (brief_name != c("city_short")), brief_name)
        .otherwise("")
    )
    df = df.withColumn("__why", F.when(c("__why") != "", c("__why")).when(foreign != "", F.concat(F.lit("原始地址中的城市与目标城市不一致："), foreign)).otherwise(""))
    df = stage(df, __d=F.when(by_full, after(c("__a"), F.length("city_name"))).when(by_short, rest).otherwise(c("__a")))
    # the unit that was asked for, where it stands near the start
    at = F.instr(c("__d"), c("__unit"))
    df = df.withColumn("__d", F.when((c("__unit") != "") & (at >= 1) & (at <= 21), after(c("__d"), at - 1)).otherwise(c("__d")))
    # the unit that is there
    df = df.withColumn("__u", unit_of(c("__d")))
    suffix = group(c("__u"), "(" + "|".join(UNIT_SUFFIXES) + ")$")
    lower = suffix.isin(*LOWER_SUFFIXES)
    road_next = (suffix == "市") & has(after(c("__d"), F.length("__u")), "^[东南西北中]?(?:路|街|大道|巷)")
    local = F.exists("unit_names", lambda n: F.startswith(n, c("__u")))
    none = road_next | (~lower & is_zone(c("__u")))
    strange = (F.size("unit_names") > 0) & ~local
    outside = ~none & strange & (F.array_contains("unit_suffixes", suffix) | ~lower)
    df = df.withColumn("__bad", F.when((c("__u") != "") & outside, c("__u")).otherwise(""))
    df = df.withColumn("__u", F.when((c("__u") == "") | none | strange | ((F.size("unit_names") == 0) & lower), "").otherwise(c("__u")))
    df = df.withColumn("__place", after(c("__d"), F.length("__u")))
    differs = (c("__u") != "") & (c("__unit") != "") & (c("__u") != c("__unit"))
    gap = (c("__u") == "") & (c("__unit") != "")
    df = df.withColumn("__d", F.when(gap, F.concat("__unit", "__d")).otherwise(c("__d"))).withColumn("__differs", differs)
    df = df.withColumn("__reason", F.when((c("__u") == "") & (c("__unit") == ""), NO_UNIT).when(~is_specific(c("__place")), NO_PLACE).otherwise(""))
    result = lambda address, status, reason, city: F.struct(address.alias("normalized_address"), status.alias("normalization_status"), reason.alias("normalization_reason"), city.alias("resolved_city"))
    no, lit = F.lit(""), F.lit
    df = stage(
        df,
        __r=F.when(strip("__raw") == "", result(no, lit("empty"), lit("前置处理没有取得地址文本"), no))
        .when(c("__clean") == "", result(no, lit("invalid"), lit("清理后没有可用地址"), no))
        .when(c("__why") != "", result(no, lit("conflict"), c("__why"), city_prefix(c("__clean"), shorts)))
        .when(c("__bad") != "", result(no, lit("conflict"), F.concat(lit("原始地址中的下级行政区不属于目标城市："), c("__bad")), c("city_name")))
        .when(c("__differs"), result(no, lit("conflict"), F.concat(lit("原始地址中的下级行政区与检索单元不一致："), c("__u"), lit(" != "), c("__unit")), c("city_name")))
        .otherwise(result(F.concat("city_name", "__d"), F.when(c("__reason") == "", "complete").otherwise("partial"), c("__reason"), c("city_name"))),
    )
    return df.withColumns({k: c(f"__r.{k}") for k in RESULT}).drop("__raw", "__unit", "__clean", "__a", "__why", "__d", "__u", "__bad", "__place", "__differs", "__reason", "__r")


def with_context(df: DataFrame, contexts: DataFrame) -> DataFrame:
    return df.join(prepared_contexts(contexts), "city_name")


CONTEXT_COLUMNS = ["province_name", "city_short", "unit_names", "unit_cores", "unit_suffixes"]


def normalize_records(records: DataFrame, contexts: DataFrame, catalog: Catalog, keep_context: bool = False) -> DataFrame:
    """Valid address records (with city_name) and the RESULT columns; other columns stay as they are."""
    full, shorts = catalog_literals(records.sparkSession, catalog)
    attributes = F.coalesce(F.col("attributes"), F.create_map().cast("map<string,string>"))
    mode = F.col("address_mode") if "address_mode" in records.columns else F.lit(None).cast("string")
    df = with_context(records, contexts).withColumns({"address_mode": mode_of(mode, F.col("source_nature")), "place_name": strip("place_name"), "source_reference": strip("source_reference"), "attributes": attributes})
    df = normalize_values(df, "original_address", target_unit(F.col("attributes")), full, shorts)
    df = df.withColumn("original_address", strip("original_address"))
    other = F.when(F.col("normalized_address") == "", foreign_campus(F.col("place_name"), F.col("city_name"), F.col("city_short"), shorts)).otherwise("")
    df = stage(df, __other=other)
    away = F.col("__other") != ""
    df = df.withColumns({"normalization_status": F.when(away, "conflict").otherwise(F.col("normalization_status")), "normalization_reason": F.when(away, F.concat(F.lit("地点名称包含异地城市校区："), F.col("__other"))).otherwise(F.col("normalization_reason")), "resolved_city": F.when(away, F.col("__other")).otherwise(F.col("resolved_city"))})
    return df.drop("__other", *([] if keep_context else CONTEXT_COLUMNS))


def status_counts(normalized: DataFrame) -> DataFrame:
    return normalized.groupBy("normalization_status").agg(F.count("*").alias("n"))


def is_valid_structure() -> Column:
    """Whether a normalized address can be taken as it is."""
    return (F.col("normalization_status") == "complete") & (strip("normalized_address") != "") & (F.col("resolved_city") == F.col("city_name"))
