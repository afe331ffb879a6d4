"""``python -m placewright.cli city|process``: a city context, or processed address records."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def asked_districts(spark: SparkSession, catalog: dict, name: str, endpoint: str, fail) -> list[tuple[str, str, str]]:
    """The map service's answers for a city and, where it stands for another one, for that."""
    from placewright.operators.city import catalog_frame, resolve_city_names, subdivisions_of
    from placewright.sources.connectors import Window, district_payloads, setting

    key = setting("AMAP_KEY")
    if not key:
        fail("未配置 AMAP_KEY")
    row = resolve_city_names(spark.createDataFrame([(name,)], "c string"), "c", catalog_frame(spark, catalog)).first()
    if row["city_error"]:
        fail(row["city_error"])
    limiter, rows, city = Window(), [], row["city_name"]
    while city and city not in {r[0] for r in rows}:
        rows += district_payloads([city], endpoint, key, limiter)
        _, payload, error = rows[-1]
        one = spark.createDataFrame([(payload,)], "p string").select(subdivisions_of(F.try_parse_json("p"), F.lit(city))["next_city"].alias("n")).first()
        city = None if error else one["n"]
    return rows


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="placewright")
    sub = parser.add_subparsers(dest="command", required=True)
    city = sub.add_parser("city")
    city.add_argument("--city", required=True)
    city.add_argument("--districts", help="JSON lines of (asked_city, payload, error); without them the map service is asked")
    city.add_argument("--endpoint", default="https://restapi.amap.com/v3/config/district")
    process = sub.add_parser("process")
    process.add_argument("--input", required=True)
    process.add_argument("--output", required=True)
    process.add_argument("--geocodes")
    process.add_argument("--pois")
    for p in (city, process):
        p.add_argument("--catalog", required=True)
    args = parser.parse_args(argv)

    from placewright.operators.city import SUBDIVISIONS, catalog_frame, city_contexts, read_catalog
    from placewright.operators.match import GEOCODES, POIS, resolve_records, resolve_without_key
    from placewright.operators.metrics import resolution_metrics
    from placewright.operators.normalize import normalize_records, split_invalid
    from placewright.sources.sinks import write_json

    spark = SparkSession.builder.getOrCreate()
    catalog = read_catalog(spark, args.catalog)
    if args.command == "city":
        names = spark.createDataFrame([(args.city,)], "input_city string")
        schema = "asked_city string, payload string, error string"
        if args.districts:
            districts = spark.read.schema(schema).json(args.districts)
        else:
            districts = spark.createDataFrame(asked_districts(spark, catalog, args.city, args.endpoint, parser.error), schema)
        row = city_contexts(names, "input_city", catalog_frame(spark, catalog), districts).first()
        if row["error"]:
            parser.error(row["error"])
        print(json.dumps({k: v for k, v in row.asDict(recursive=True).items() if k != "error"}, ensure_ascii=False))
        return 0
    context = f"struct<stage:string,input_city:string,city_name:string,province_name:string,subdivisions:{SUBDIVISIONS}>"
    item = "struct<place_name:string,original_address:string,address_mode:string,source_nature:string,source_reference:string,attributes:map<string,string>>"
    doc = spark.read.schema(f"stage string, city_context {context}, items array<{item}>").json(args.input, multiLine=True)
    if doc.filter("stage = 'address_records'").count() != 1:
        parser.error("输入必须是 address_records JSON")
    contexts = doc.select("city_context.*")
    records = doc.select(F.col("city_context.city_name").alias("city_name"), F.posexplode("items").alias("record_id", "r")).select("record_id", "city_name", "r.*")
    good, _ = split_invalid(records, strict=True)
    normalized = normalize_records(good, contexts, catalog, keep_context=True)
    if args.geocodes or args.pois:
        table = lambda path, schema: spark.read.schema(schema).json(path) if path else spark.createDataFrame([], schema)
        done = resolve_records(normalized, catalog, table(args.geocodes, f"asked_address string, asked_city string, error string, candidates {GEOCODES}"), table(args.pois, f"asked_name string, asked_city string, error string, candidates {POIS}"))
    else:
        done = resolve_without_key(normalized)
    done = done.persist()
    name = contexts.first()["city_name"]
    metrics = json.loads(resolution_metrics(done, name).toJSON().first())
    rows = [json.loads(x) for x in done.orderBy("record_id").drop("record_id", "route").toJSON().toLocalIterator()]
    write_json(args.output, {"stage": "processed_address_records", "city_context": contexts.first().asDict(recursive=True), "items": rows, "metrics": metrics})
    done.unpersist()
    print(json.dumps(metrics, ensure_ascii=False))
    return 0


if __name__ == "__main__":
    sys.exit(main())
