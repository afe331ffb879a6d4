"""The same column expressions over records that land in a folder bit by bit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from placewright.operators.city import Catalog
from placewright.operators.normalize import normalize_records

RECORDS = "record_id long, city_name string, place_name string, original_address string, source_nature string, source_reference string, attributes map<string,string>, arrived timestamp"


def normalized_stream(spark: SparkSession, folder: str, contexts: DataFrame, catalog: Catalog) -> DataFrame:
    """JSON records of a folder, normalized as they arrive; contexts are a static side."""
    return normalize_records(spark.readStream.schema(RECORDS).json(folder), contexts, catalog)


def status_windows(stream: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Statuses counted in windows of arrival; rows later than ``late`` no longer count."""
    return stream.withWatermark("arrived", late).groupBy(F.window("arrived", width), "normalization_status").agg(F.count("*").alias("n"))


def run_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All that is there, exactly once, into a table; call again for what came since."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
