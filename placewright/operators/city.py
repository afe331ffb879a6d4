"""City catalog, city names and city contexts.

The catalog (a few hundred names of public administrative divisions) is a parameter: a JSON document with the lists
``municipalities`` and ``province_cities``, or a mapping from city to province (None for a municipality).
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placewright.functions.address import CITY_SUFFIXES, DIVISION_SUFFIXES, UNIT_SUFFIXES, city_core, group, short_city
from placewright.functions.text import strip

Catalog = Mapping[str, str | None]
SUBDIVISIONS = "array<struct<name:string,adcode:string,level:string>>"


def catalog_frame(spark: SparkSession, catalog: Catalog) -> DataFrame:
    """(city, province, pos) in the order of the catalog."""
    return spark.createDataFrame([(c, p, i) for i, (c, p) in enumerate(catalog.items())], "city string, province string, pos int")


def read_catalog(spark: SparkSession, path: str) -> dict[str, str | None]:
    """The catalog of a JSON document; blank and repeated names are errors."""
    doc = spark.read.schema("municipalities array<string>, province_cities map<string,array<string>>").json(path, multiLine=True)
    towns = doc.select(F.posexplode("municipalities").alias("pos", "city")).select(F.lit(0).alias("part"), "pos", "city", F.lit(None).cast("string").alias("province"))
    entries = doc.select(F.posexplode(F.map_entries("province_cities")).alias("part", "e")).select((F.col("part") + 1).alias("part"), F.col("e.key").alias("province"), F.posexplode("e.value").alias("pos", "city"))
    rows = towns.unionByName(entries.select("part", "pos", "city", "province")).orderBy("part", "pos").select(strip("city").alias("city"), F.when(F.col("province").isNotNull(), strip("province")).alias("province")).collect()
    if not rows or any(not r.city or r.province == "" for r in rows):
        raise ValueError("the city catalog holds blank names or has another form")
    if len({r.city for r in rows}) < len(rows):
        raise ValueError("the city catalog repeats a name")
    return {r.city: r.province for r in rows}


def catalog_literals(spark: SparkSession, catalog: Catalog) -> tuple[Column, Column]:
    """(array of all full names, map from short name to the array of its full names) as constants of a plan."""
    names = catalog_frame(spark, catalog)
    core = city_core(F.col("city"))
    shorts = names.select("city", "pos", F.explode(F.array_distinct(F.array(core, short_city(F.col("city"))))).alias("short"))
    found = [(r.short, r.full) for r in shorts.groupBy("short").agg(F.sort_array(F.collect_list(F.struct("pos", "city"))).alias("x")).orderBy(F.element_at("x", 1)["pos"], "short").select("short", F.transform("x", lambda e: e["city"]).alias("full")).collect()]
    full = F.from_json(F.lit(json.dumps(list(catalog), ensure_ascii=False)), "array<string>")
    return full, F.from_json(F.lit(json.dumps(dict(found), ensure_ascii=False)), "map<string,array<string>>")


def resolve_city_names(df: DataFrame, column: str, catalog: DataFrame) -> DataFrame:
    """Add city_name, province_name and city_error: a name as it is, or with the one suffix that completes it."""
    raw = strip(column)
    known = catalog.select(F.col("city").alias("city_name"), F.col("province").alias("province_name"))
    tries = F.concat(F.array(F.struct(F.lit(0).alias("step"), raw.alias("name"))), F.array(*[F.struct(F.lit(1).alias("step"), F.when(~F.endswith(raw, F.lit(s)), F.concat(raw, F.lit(s))).alias("name")) for s in CITY_SUFFIXES]))
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    met = numbered.select("__row", raw.alias("raw"), F.explode(tries).alias("t")).filter("t.name is not null").join(known, F.col("t.name") == F.col("city_name"), "left")
    hit = F.when(F.col("city_name").isNotNull(), F.struct("city_name", "province_name"))
    by = met.groupBy("__row", "raw").agg(F.max(F.when(F.col("t.step") == 0, hit)).alias("own"), F.max(F.when(F.col("t.step") == 1, hit)).alias("more"), F.count(F.when(F.col("t.step") == 1, hit)).alias("n"))
    chosen = F.coalesce("own", F.when(F.col("n") == 1, F.col("more")))
    error = F.when(F.col("raw") == "", "城市名称不能为空").when(chosen.isNotNull(), "").when(F.col("n") > 1, F.concat(F.lit("城市名称存在多个后缀候选："), F.col("raw"))).otherwise(F.concat(F.lit("城市不在固定目录中："), F.col("raw")))
    return numbered.join(by.select("__row", chosen["city_name"].alias("city_name"), chosen["province_name"].alias("province_name"), error.alias("city_error")), "__row").drop("__row")


def context_error() -> Column:
    """What is wrong with a city context row (input_city, city_name, province_name, subdivisions), or ''."""
    return (
        F.when(F.coalesce(F.col("stage"), F.lit("")) != "city_context", "城市上下文阶段必须是 city_context")
        .when(strip("input_city") == "", "城市上下文缺少非空 input_city")
        .when(strip("city_name") == "", "城市上下文缺少非空 city_name")
        .when(F.col("province_name").isNotNull() & (strip("province_name") == ""), "城市上下文中的 province_name 不能为空字符串")
        .when(F.col("subdivisions").isNull(), "城市上下文中的 subdivisions 必须是数组")
        .otherwise("")
    )


def city_contexts(names: DataFrame, column: str, catalog: DataFrame, districts: DataFrame) -> DataFrame:
    """City contexts of names, with their subdivisions: stage, input_city, city_name, province_name, subdivisions, error.

    ``districts`` (asked_city, payload, error) holds the answers of the map service as JSON text.  A city whose only
    child is a city of another name has that one's children.
    """
    answers = districts.groupBy("asked_city").agg(F.min(F.struct(F.coalesce("error", F.lit("")).alias("error"), "payload")).alias("a"))
    found = subdivisions_of(F.try_parse_json("a.payload"), F.col("asked_city"))
    failed = F.col("a.error") != ""
    known = answers.select("asked_city", F.when(failed, F.struct(F.array().cast(SUBDIVISIONS).alias("subdivisions"), F.lit(None).cast("string").alias("next_city"), F.col("a.error").alias("error"))).otherwise(found).alias("s"))
    first = resolve_city_names(names, column, catalog).join(known, F.col("city_name") == F.col("asked_city"), "left").drop("asked_city")
    second = known.select(F.col("asked_city").alias("__next"), F.col("s").alias("__s"))
    met = first.join(second, F.col("s.next_city") == F.col("__next"), "left")
    missing = F.concat(F.lit("高德未唯一匹配目标城市："), F.coalesce("s.next_city", "city_name"))
    own = F.when(F.col("s.next_city").isNull(), F.col("s")).otherwise(F.col("__s"))
    error = F.when(F.col("city_error") != "", F.col("city_error")).when(own.isNull(), missing).otherwise(own["error"])
    subdivisions = F.coalesce(F.when(error == "", own["subdivisions"]), F.array().cast(SUBDIVISIONS))
    return met.select(F.lit("city_context").alias("stage"), strip(column).alias("input_city"), "city_name", "province_name", subdivisions.alias("subdivisions"), error.alias("error"))


def prepared_contexts(contexts: DataFrame) -> DataFrame:
    """Contexts with what the normalizer needs of them, worked out once for each city."""
    names = F.transform("subdivisions", lambda s: strip(s["name"]))
    core = lambda n: F.regexp_replace(n, "(?:" + "|".join(DIVISION_SUFFIXES) + ")$", "")
    cores = F.filter(F.transform(names, lambda n, i: F.struct((-F.length(core(n))).alias("size"), i.alias("pos"), core(n).alias("core"), n.alias("full"))), lambda c: (c["core"] != "") & (c["core"] != c["full"]))
    suffix = lambda n: group(n, "(" + "|".join(UNIT_SUFFIXES) + ")$")
    return contexts.select(
        strip("city_name").alias("city_name"),
        strip("province_name").alias("province_name"),
        short_city(strip("city_name")).alias("city_short"),
        names.alias("unit_names"),
        F.array_sort(cores).alias("unit_cores"),
        F.array_distinct(F.filter(F.transform(names, suffix), lambda s: s != "")).alias("unit_suffixes"),
    )


def subdivisions_of(payload: Column, city: Column) -> Column:
    """(subdivisions, next city, error) of a district answer: unique match by name, children once by name and code.

    ``payload`` is a VARIANT column.  A single child of level city with another name is the city to ask for next.
    """
    text = lambda v, path: variant_text(v, path)
    districts = F.coalesce(F.try_variant_get(payload, "$.districts", "array<variant>"), F.array().cast("array<variant>"))
    own = F.filter(districts, lambda d: text(d, "$.name") == city)
    children = F.coalesce(F.try_variant_get(F.get(own, F.lit(0)), "$.districts", "array<variant>"), F.array().cast("array<variant>"))
    rows = F.transform(children, lambda c: F.struct(text(c, "$.name").alias("name"), text(c, "$.adcode").alias("adcode"), text(c, "$.level").alias("level")))
    rows = F.filter(rows, lambda r: (r["name"] != "") & (r["adcode"] != ""))
    once = F.filter(rows, lambda r, i: ~F.exists(F.slice(rows, F.lit(1), i), lambda o: (o["name"] == r["name"]) & (o["adcode"] == r["adcode"])))
    only = F.get(once, F.lit(0))
    again = (F.size(once) == 1) & (only["level"] == "city") & (only["name"] != city)
    error = F.when(F.size(own) != 1, F.concat(F.lit("高德未唯一匹配目标城市："), city)).when(F.size(once) == 0, F.concat(F.lit("高德未返回目标城市的下一级行政区："), city)).otherwise("")
    return F.struct(F.when(error == "", once).otherwise(F.array().cast(SUBDIVISIONS)).alias("subdivisions"), F.when((error == "") & again, only["name"]).alias("next_city"), error.alias("error"))


def variant_text(value: Column, path: str = "$") -> Column:
    """A value that may be text, a number or an array: its first text that isn't blank, or ''."""
    many = F.try_variant_get(value, path, "array<string>")
    first = F.coalesce(F.get(F.filter(F.transform(many, strip), lambda x: x != ""), F.lit(0)), F.lit(""))
    return F.when(many.isNotNull(), first).otherwise(strip(F.try_variant_get(value, path, "string")))
