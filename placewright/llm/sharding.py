"""Longest-processing-time sharding (operator 10).

Rows with equal texts form a group that stays in one shard.  Groups are taken by falling size, each goes to the
least-loaded shard (ties: the lower number), kept in a heap.  Only the *histogram* of group sizes visits the
driver: groups of one size are interchangeable, so the schedule needs no more than how many of each size a shard
gets.  With total size S there are at most sqrt(2 S) different sizes.  A size with many groups is dealt out by a
search for the level that the heap would reach, not one by one.  Groups then take their shard by their rank among
the groups of their size; ranks and slots come from counts of salted buckets and a row number inside each bucket,
so no shard, size or group is gathered in one task.

Defined results: a null text has size 1, checksum 0 and forms one group with other null texts, apart from empty
ones; repeated rows each get a slot; null ids are allowed; an empty table gives no rows; other columns are not
read.  The largest group bounds how even the law ``bytes`` can be: it is never split.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placewright.llm.common import materialize, read

SHARDS = 16
#: Rows that one bucket of a rank or slot count should have.
BUCKET_ROWS = 50_000


def schedule(histogram: list[tuple[int, int]], n_shards: int = SHARDS) -> dict[int, list[int]]:
    """For (size, number of groups): how many groups of each size every shard gets, largest sizes first."""
    heap = [(0, i) for i in range(n_shards)]
    dealt = {}
    for size, count in sorted(histogram, reverse=True):
        got = [0] * n_shards
        if count <= 8 * n_shards or size <= 0:
            for _ in range(count):
                load, i = heap[0]
                got[i] += 1
                heapq.heapreplace(heap, (load + size, i))
        else:
            loads = [load for load, _ in heap]

            def below(level: int, size: int = size, loads: list[int] = loads) -> int:
                return sum((level - x) // size + 1 for x in loads if x <= level)

            low, high = min(loads), max(loads) + size * (count // n_shards + 1)
            while low < high:  # the lowest level at or under which ``count`` groups start
                middle = (low + high) // 2
                if below(middle) >= count:
                    high = middle
                else:
                    low = middle + 1
            left, new = count, []
            for load, i in heap:
                got[i] = (low - 1 - load) // size + 1 if load < low else 0
                left -= got[i]
            for load, i in sorted(heap, key=lambda x: x[1]):
                if left and load + got[i] * size == low:
                    got[i] += 1
                    left -= 1
                new.append((load + got[i] * size, i))
            heapq.heapify(new)
            heap = new
        dealt[size] = got
    return dealt


def _ranked(rows: DataFrame, within: str, bucket, order: list) -> DataFrame:
    """``rank`` from 0 without gaps among the rows with equal ``within``, through counts of buckets."""
    rows = rows.withColumn("__bucket", bucket)
    counts = rows.groupBy(within, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(within).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(within, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(within, "__bucket").orderBy(*order)
    numbered = rows.withColumn("rank", F.row_number().over(inside) - 1)
    return numbered.join(offsets, [within, "__bucket"]).withColumn("rank", F.col("rank") + F.col("__before")).drop("__bucket", "__before")


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    spark, text = docs.sparkSession, F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("b"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.lit(b"")).alias("key"),
    ).withColumn("size", F.col("b") + 1).drop("b")
    rows = materialize(rows, "sizes")
    groups = rows.groupBy("key").agg(F.sum("size").alias("group_size"), F.count("*").alias("copies"))
    histogram = groups.groupBy("group_size").agg(F.count("*").alias("n"), F.sum("copies").alias("rows")).toPandas()
    n_groups, n_rows = int(histogram["n"].sum()), int(histogram["rows"].sum())
    dealt = schedule([(int(s), int(n)) for s, n in zip(histogram["group_size"], histogram["n"], strict=True)], n_shards)
    upto = pd.DataFrame({"group_size": list(dealt), "upto": [pd.Series(g).cumsum().tolist() for g in dealt.values()]})
    classes = spark.createDataFrame(upto, "group_size long, upto array<long>")
    salts = max(16, -(-n_groups // BUCKET_ROWS))
    ranked = _ranked(groups.select("key", "group_size"), "group_size", F.pmod(F.xxhash64("key"), F.lit(salts)), ["key"])
    placed = ranked.join(classes, "group_size").select("key", F.size(F.filter("upto", lambda x: x <= F.col("rank"))).alias("shard"))
    placed = materialize(rows.join(placed, "key").drop("key"), "placed")
    buckets = max(16, -(-n_rows // (BUCKET_ROWS * n_shards)))
    slotted = _ranked(placed, "shard", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)), ["doc_id", "text_crc32", "size"])
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("rank").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 by the law ``bytes``."""
    return shard_documents(read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op10_sharding": op10_sharding}
ORACLES: dict[str, str] = {}
