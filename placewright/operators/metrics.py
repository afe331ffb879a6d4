"""Metrics of resolved records and quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewright.functions.address import NO_UNIT
from placewright.functions.text import text

COUNTED = {"source_counts": "source_nature", "address_mode_counts": "address_mode", "normalization_status_counts": "normalization_status", "map_match_status_counts": "map_match_status", "resolved_city_counts": "resolved_city"}
#: Limits of the map service, reported with the metrics.
WINDOW_SECONDS, WINDOW_REQUESTS = 1.0, 2


def value_counts(df: DataFrame) -> DataFrame:
    """(metric, value, n) of all counted columns in one pass over the records."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), text(c).alias("value")) for m, c in COUNTED.items()])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.metric", "p.value").agg(F.count("*").alias("n"))


def resolution_metrics(df: DataFrame, city_name: str = "") -> DataFrame:
    """One row with all metrics of resolved records; the counted columns as maps with sorted keys."""
    have = set(df.columns)
    column = lambda c, default: F.col(c) if c in have else default
    city = text("resolved_city")
    single = df.agg(
        F.count("*").alias("item_count"),
        F.coalesce(F.sum(column("map_request_count", F.lit(0))), F.lit(0)).cast("long").alias("map_request_count"),
        F.count_if(text("final_address") != "").alias("final_address_count"),
        F.count_if((F.col("normalization_reason") == NO_UNIT) & (F.col("map_match_status") != "skipped")).alias("missing_admin_geocode_count"),
        F.count_if((city != "") & F.lit(bool(city_name)) & (city != city_name)).alias("out_of_city_address_count"),
        F.coalesce(F.sum(column("actual_http_attempt_count", column("map_request_count", F.lit(0)))), F.lit(0)).cast("long").alias("actual_http_attempt_count"),
        F.count_if((F.col("map_match_status") == "not_found") & (text("original_address") == "")).alias("not_found_empty_address_count"),
        F.lit(WINDOW_SECONDS).alias("rate_limit_window_seconds"),
        F.lit(WINDOW_REQUESTS).alias("rate_limit_max_requests"),
    )
    entry = lambda m: F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("metric") == m, F.struct("value", "n")))))
    maps = value_counts(df).agg(*[entry(m).alias(m) for m in COUNTED])
    return single.withColumn("__one", F.lit(1)).join(maps.withColumn("__one", F.lit(1)), "__one").drop("__one")


def quality_report(reasons: Column) -> Column:
    """Whether a unit passes: it has no reasons not to."""
    return F.size(F.filter(reasons, lambda r: r.isNotNull() & (r != ""))) == 0
