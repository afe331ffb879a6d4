"""Mixing sources to target weights (operator 4).

The words of a source, its documents in a pseudorandom but fixed order, are packed into blocks of ``block_words``
(the last may be shorter).  A source's target is its weighted share of all words, capped at ``limit`` times its
size with the excess reshared; it is met by slots: whole epochs over all blocks, then a part of one more, whose
last slot may take the beginning of a block only, so the words taken are the rounded target exactly.  Every output
shard draws its source counts from a multinomial over the slots not yet dealt, so shards vary as independent draws
do while the totals hold.  The draws halve the range of shards again and again, each half with a seed of its own,
so a task finds the counts of its shards without those of the others.  A slot finds its block through a permutation
of the block numbers, one for each source and epoch (a Feistel network with cycle walking: no table), and blocks meet
documents in a join by block number: ``mixed_slots`` is what the shards hold, and all totals are counted from it.

What visits the driver is one row per source.  Documents are placed by counts of salted buckets, so a hot source is
spread over all tasks.

Defined results: a null or blank text has size 0 and nothing is taken; a very long text spans as many blocks as it
fills; null sources form one source, after all others; sources without words have target 0; repeated rows are rows
of their own, and which of two equal rows has which words is left open; an empty table gives no rows; other columns
pass by unread, whatever their names.  Reruns agree, as everything is seeded.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placewright.llm.common import SPACE_BYTES, free_name, map_arrow, materialize, mix64, n_words, numbered, read

WEIGHTS = (5, 2, 1)
LIMIT = 3
BLOCK_WORDS = 1024
SEED = 20240229
SLOTS_PER_SHARD = 200_000
BUCKET_ROWS = 50_000


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> dict[str | None, float]:
    """Share of all words for each source: by weight, none above ``limit`` times its size."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    cap = {s: limit * n for s, n in sizes}
    left, open_ = Fraction(sum(n for _, n in sizes)), dict(weight)
    out: dict[str | None, Fraction] = {}
    while open_:
        unit = left / sum(open_.values())
        above = [s for s, w in open_.items() if unit * w > cap[s]]
        if not above:
            out |= {s: unit * w for s, w in open_.items()}
            break
        for s in above:
            out[s] = Fraction(cap[s])
            left -= cap[s]
            del open_[s]
    return {s: float(x) for s, x in out.items()}


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n-1, evaluated at ``index``."""
    if n <= 1:
        return np.zeros_like(index)
    half = np.uint64(max(1, -(-int(n - 1).bit_length() // 2)))
    mask = np.uint64((1 << int(half)) - 1)
    keys = mix64(np.arange(6, dtype=np.uint64) + np.uint64(key & 0xFFFFFFFFFFFFFFFF))
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):  # walk the cycle until the value is below n
        x = out[todo]
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mix64(right ^ k) & mask)
        x = left << half | right
        out[todo] = x
        todo = todo[x >= n]
    return out.astype(np.int64)


def deal(slots: np.ndarray, n_shards: int, low: int, high: int, seed: int = SEED) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, first slot and number of slots of each source) for the shards from ``low`` to ``high``."""
    todo = [(0, n_shards, slots, np.zeros_like(slots))]
    while todo:
        a, b, left, first = todo.pop()
        if b <= low or a >= high:
            continue
        if b - a == 1:
            yield a, first, left
            continue
        middle, rest = (a + b) // 2, left.copy()
        need = int(left.sum()) * (middle - a) // (b - a)
        rng = np.random.default_rng([seed, a, b])
        while need:
            got = np.minimum(rng.multinomial(need, rest / rest.sum()), rest)
            rest = rest - got
            need -= int(got.sum())
        taken = left - rest
        todo += [(middle, b, rest, first + taken), (a, middle, taken, first)]


def draws(slots: list[int], n_shards: int, seed: int = SEED) -> np.ndarray:
    """Slots of each source (columns) in each shard (rows): multinomial draws from those not yet dealt."""
    return np.array([n for _, _, n in deal(np.array(slots, dtype=np.int64), n_shards, 0, n_shards, seed)])


class Share(NamedTuple):
    """The slots of one source: ``epochs`` whole passes over its blocks, then some more, the last of ``part`` words."""

    skey: str
    number: int
    full: int
    tail: int
    epochs: int
    part: int
    slots: int


def shares(sizes: list[tuple[str | None, int]], goal: dict, block_words: int) -> list[Share]:
    out = []
    for i, (source, size) in enumerate(sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))):
        if size:
            full, tail = divmod(size, block_words)
            epochs, rest = divmod(round(goal[source]), size)
            whole, part = divmod(rest, block_words)
            out.append(Share(_key(source), i, full, tail, epochs, part, epochs * (full + (tail > 0)) + whole + (part > 0)))
    return out


def _key(source: str | None) -> str:
    return "n" if source is None else f"s{source}"


SLOTS = "shard long, skey string, slot long, epoch long, block long, take long"


def slot_table(spark: SparkSession, plan: list[Share], block_words: int, seed: int = SEED, slots_per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """Every slot of the mix: shard, skey, slot, epoch, block and the words it takes from the block."""
    slots = np.array([r.slots for r in plan], dtype=np.int64)
    n_shards = max(16, -(-int(slots.sum()) // slots_per_shard)) if len(slots) else 0

    def of_source(r: Share, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        epoch, k = np.divmod(j, r.full + (r.tail > 0))
        block = k.copy()
        for e in np.unique(epoch).tolist():
            at = np.flatnonzero((epoch == e) & (k < r.full))
            block[at] = permute(k[at], r.full, seed * 1_000_003 + r.number * 8191 + e)
        take = np.where(k < r.full, block_words, r.tail)
        if r.part:
            take[j == r.slots - 1] = r.part
        return epoch, block, take

    def work(table: pa.Table):
        ids = table["id"].to_pylist()
        for shard, first, n in deal(slots, n_shards, ids[0], ids[-1] + 1, seed):
            for i in np.flatnonzero(n).tolist():
                for begin in range(int(first[i]), int(first[i] + n[i]), 100_000):
                    j = np.arange(begin, min(begin + 100_000, int(first[i] + n[i])))
                    yield pa.table([pa.array(np.full(len(j), shard)), pa.array([plan[i].skey] * len(j), pa.string()), j, *of_source(plan[i], j)], names=["shard", "skey", "slot", "epoch", "block", "take"])

    return map_arrow(spark.range(0, n_shards, 1, max(1, min(n_shards, 512))), work, SLOTS)


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, own: list[str]) -> DataFrame:
    """doc_id, skey, size and a pseudorandom place of every row, written."""
    source = F.col(source_col).cast("string")
    place = F.xxhash64(F.col(id_col), F.col(text_col))  # rows without an id, or that share one, are spread by their texts
    return materialize(docs.select(F.col(id_col).alias("doc_id"), source.alias("source"), _skey(source).alias("skey"), n_words(F.col(text_col)).alias("size"), place.alias("place"), *own), "sizes")


def _skey(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def _starts(base: DataFrame, n_rows: int, seed: int, own: list[str]) -> DataFrame:
    """The rows with words, and the first word of each in the fixed order of its source."""
    buckets = max(64, -(-n_rows // BUCKET_ROWS))
    rows = base.filter("size > 0").withColumn("bucket", F.pmod(F.xxhash64("place", F.lit(seed)), F.lit(buckets)))
    sums = rows.groupBy("skey", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("skey", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("skey", "bucket").orderBy(F.xxhash64("place", F.lit(seed + 1)), "doc_id", "size", *own).rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("start", F.sum("size").over(inside) - F.col("size")).join(offsets.hint("merge"), ["skey", "bucket"])
    return placed.select("doc_id", "skey", "size", (F.col("start") + F.col("offset")).alias("start"), *own)


def _held(placed: DataFrame, slots: DataFrame, block_words: int, own: list[str]) -> DataFrame:
    """Blocks joined by index: which words of which row every slot holds; a row that no slot holds has nulls once."""
    width = F.lit(block_words)
    last = F.floor((F.col("start") + F.col("size") - 1) / width)
    spans = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / width), last)))
    low = F.greatest(F.col("start"), F.col("block") * width)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * width + F.col("take"))
    met = spans.join(slots.hint("merge"), ["skey", "block"], "left")  # both grow with the words: never broadcast
    piece = F.when(F.col("slot").isNotNull() & (high > low), F.struct("epoch", (low - F.col("start")).alias("begin"), (high - F.col("start")).alias("end"), "shard", "slot"))
    return met.select("skey", "block", "doc_id", "size", "start", piece.alias("piece"), *own)


def _mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], limit: int, block_words: int, seed: int, own: list[str]):
    """(sizes table, sizes and targets of the sources, what the slots hold)."""
    base = _sizes(docs, id_col, text_col, source_col, own)
    found = base.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    sizes = [(r["source"], int(r["size"])) for r in found]
    goal = targets(sizes, weights, limit)
    slots = slot_table(docs.sparkSession, shares(sizes, goal, block_words), block_words, seed)
    held = _held(_starts(base, sum(r["n"] for r in found), seed, own), slots, block_words, own)
    return base, [(s, n, goal[s]) for s, n in sizes], held


def mixed_slots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """What the output shards hold: shard, source, slot, epoch, block, doc_id, and the words begin .. end of the document.

    A slot is one block of a source; its rows in the order of ``position`` are its words.
    """
    held = _mixed(docs, id_col, text_col, source_col, weights, limit, block_words, seed, [])[2]
    source = F.when(F.col("skey") != "n", F.substr("skey", F.lit(2)))
    held = held.filter("piece is not null")
    return held.select("piece.shard", source.alias("source"), "piece.slot", "piece.epoch", "block", (F.col("start") + F.col("piece.begin")).alias("position"), "doc_id", "piece.begin", "piece.end")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT, block_words: int = BLOCK_WORDS, seed: int = SEED, row_col: str | None = None) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken, n_slots, n_shards, and pieces (epoch, begin, end) by epoch.

    ``row_col``, a unique number of the rows, is carried to the result.
    """
    own = [row_col] if row_col else []
    base, sources, held = _mixed(docs, id_col, text_col, source_col, weights, limit, block_words, seed, own)
    done = held.groupBy("skey", "start", "doc_id", "size", *own).agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    blank = base.filter("size = 0").select("skey", F.lit(0).cast("long").alias("start"), "doc_id", "size", F.lit(None).cast(done.schema["pieces"].dataType).alias("pieces"), *own)
    every = done.unionByName(blank).withColumn("pieces", F.coalesce("pieces", F.array().cast(done.schema["pieces"].dataType)))
    table = [(_key(s), n, t) for s, n, t in sources]
    named = docs.sparkSession.createDataFrame(table, "skey string, source_size long, target double")
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["begin"])
    counts = [F.size("pieces").cast("long").alias("n_slots"), F.size(F.array_distinct("pieces.shard")).cast("long").alias("n_shards")]
    return every.join(named, "skey").select("doc_id", "size", "source_size", "target", taken.alias("taken"), *counts, "pieces", *own)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as rows of ``docs``: one for each pass that takes words of a document, with the words it takes.

    A pass that takes all words gives the text as it is.  Rows meet what is taken of them by a number of their own, so
    null and repeated ids are whole; the columns can have any names.
    """
    kept, schema = docs.columns, docs.schema
    row, pieces = free_name("row", kept), free_name("pieces", kept)
    docs = numbered(docs, "rows", row)
    taken = mix(docs, row_col=row).filter("taken > 0").select(F.col(row), F.col("size").alias(free_name("size", kept)), F.col("pieces").alias(pieces))

    def work(table: pa.Table):
        at, texts = [], []
        for i, (text, size, found) in enumerate(zip(table["text"].to_pylist(), table[free_name("size", kept)].to_pylist(), table[pieces].to_pylist(), strict=True)):
            passes: dict[int, list[dict]] = {}
            for p in found:
                passes.setdefault(p["epoch"], []).append(p)
            data, edges = text.encode(), None
            for parts in passes.values():
                at.append(i)
                if sum(p["end"] - p["begin"] for p in parts) == size:
                    texts.append(text)
                    continue
                edges = edges or _word_edges(data)
                starts, ends = edges
                texts.append(b" ".join(data[starts[p["begin"]] : ends[p["end"] - 1]] for p in parts).decode("utf-8", "replace"))
        rows = table.take(pa.array(at, pa.int64()))
        yield pa.table([pa.array(texts, pa.string()) if k == "text" else rows[k] for k in kept], names=kept)

    return map_arrow(docs.join(taken, row), work, schema)


def _word_edges(data: bytes) -> tuple[list[int], list[int]]:
    import re

    found = [m.span() for m in re.finditer(rb"[^" + re.escape(SPACE_BYTES) + rb"]+", data)]
    return [a for a, _ in found], [b for _, b in found]


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents by the weights 5, 2, 1; words, slots and shards are counted from what the shards hold."""
    return mix(read(spark, sf_dir, "documents", "doc_id", "text", "source")).drop("pieces")


QUERIES = {"op4_mixing": op4_mixing}
ORACLES: dict[str, str] = {}
