"""Exact top-k search by a Voronoi join (operator 8).

Largest inner product is turned into nearest neighbour: with M the largest norm, data x becomes
(x, sqrt(M**2 - |x|**2)) and a query q becomes (q, 0), so smaller distance means larger product.  Data and queries
join the cell of their nearest pivot.  Summaries of the cells (radii, the k + 1 smallest distances to the pivot)
give every query cell a bound on the distance of its k-th neighbour; a data row is sent to a group of query cells
only if, by the triangle inequality, it can lie within the bound of one of them.  Small cells share a chunk of data,
large cells are cut into several, and queries go only to the chunks of cells that their group's bound reaches; so
groups and chunks are both bounded, and a hot cell is spread over many tasks.  Each task scores its chunk in whole
numbers and keeps what may be among the best; a last step merges by query.  All bounds carry a slack for rounding, so
pruning never loses a row, and scores are exact.

Rows are told apart by a number of their own: rows that repeat a vec_id are all queries and candidates, of each other
too.

Defined results: vectors that are null, or hold null or non-finite components, take no part; shorter vectors count
as filled with zeros, very long ones are scored whole; null ids take no part; ties go to the smaller vec_id; queries
get fewer than k results if there are fewer candidates; an empty table gives none.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placewright.llm.common import ROW, materialize, mix64, numbered, read

K, SCALE = 10, 1024
#: Pivots are a hash sample of sqrt(rows), at most these; the only vectors that go to the driver and all tasks.
MOST_PIVOTS = 1024
QUERIES_PER_GROUP, MOST_GROUPS, ROWS_PER_CHUNK = 2048, 256, 16_384


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): finite vectors as whole numbers."""
    v, inf = F.col(vector_col), F.lit(float("inf"))
    good = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < inf))
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return df.filter(F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("v"))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of a column of lists, filled with zeros to ``dims``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths().fill_null(0))
    out = np.zeros((len(column), dims), np.int64)
    if len(column):
        out[np.arange(dims) < lengths[:, None]] = np.asarray(column.flatten())
    return out


def _lift(x: np.ndarray, most: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.concatenate((x, np.sqrt(np.maximum(most - (x * x).sum(1), 0))[:, None]), axis=1)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T
    return np.sqrt(np.maximum(square, 0))


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products as int64 (in floats where they are exact, else in whole numbers of any size)."""
    bound = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if bound < 1 << 53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return q @ x.T if bound < 1 << 63 else (q.astype(object) @ x.T.astype(object)).clip(-(1 << 63), (1 << 63) - 1).astype(np.int64)


def _best(scores: np.ndarray, rows: np.ndarray, own: np.ndarray, least: np.ndarray, k: int):
    """(query, column) of up to k best candidates of each query, ties to the left; ``rows`` are the candidates' numbers."""
    for i in range(len(scores)):
        row = np.flatnonzero((scores[i] >= least[i]) & (rows != own[i]))
        if len(row) > k:
            s = scores[i][row]
            edge = np.partition(s, len(s) - k)[len(s) - k]
            above = row[s > edge]
            row = np.concatenate((above, row[s == edge][: k - len(above)]))
        yield i, row


def top_k(data: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score; ``data`` and ``queries`` have (ROW, vec_id, v), a number of ROW for each row of both."""
    spark = data.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = data.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims"), F.max(square).alias("most")).first()
    q_facts = queries.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not facts["n"] or not q_facts["n"]:
        return spark.createDataFrame([], schema)
    n, n_queries, dims = facts["n"], q_facts["n"], max(1, facts["dims"] or 0, q_facts["dims"] or 0)
    most = float(facts["most"]) * (1 + 1e-9) + 1
    n_pivots = int(min(MOST_PIVOTS, max(1, np.sqrt(n))))
    sample = data.orderBy(F.xxhash64(ROW), ROW).limit(n_pivots).select("v").toArrow()
    pivots = _lift(np.unique(_matrix(sample["v"], dims), axis=0), most)
    shared = spark.sparkContext.broadcast(pivots)

    def assigned(lift: bool):
        def run(batches):
            for b in batches:
                x = _matrix(b["v"], dims)
                point = _lift(x, most) if lift else np.concatenate((x.astype(np.float64), np.zeros((len(x), 1))), axis=1)
                d = _distances(point, shared.value)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays([b[ROW], b["vec_id"], b["v"], pa.array(cell, pa.int32()), pa.array(d[np.arange(len(x)), cell], pa.float64())], [ROW, "vec_id", "v", "cell", "d"])

        return run

    placed = materialize(data.mapInArrow(assigned(True), f"{ROW} long, vec_id long, v array<long>, cell int, d double"), "cells")
    asked = materialize(queries.mapInArrow(assigned(False), f"{ROW} long, vec_id long, v array<long>, cell int, d double"), "queries")

    def summaries(batches):
        near: dict[int, np.ndarray] = {}
        far: dict[int, float] = {}
        rows: dict[int, int] = {}
        for b in batches:
            cells, d = np.asarray(b["cell"]), np.asarray(b["d"])
            for c in np.unique(cells).tolist():
                own = d[cells == c]
                near[c] = np.sort(np.concatenate((near.get(c, own[:0]), own)))[: k + 1]
                far[c] = max(far.get(c, 0.0), float(own.max()))
                rows[c] = rows.get(c, 0) + len(own)
        yield pa.RecordBatch.from_arrays([pa.array(list(near), pa.int32()), pa.array([x.tolist() for x in near.values()], pa.list_(pa.float64())), pa.array([far[c] for c in near], pa.float64()), pa.array([rows[c] for c in near], pa.int64())], ["cell", "near", "far", "near_n"])

    summary = placed.select("cell", "d").mapInArrow(summaries, "cell int, near array<double>, far double, near_n long").groupBy("cell").agg(F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"), F.max("far").alias("far"), F.sum("near_n").alias("n")).collect()
    q_summary = asked.groupBy("cell").agg(F.max("d").alias("far"), F.count("*").alias("n")).collect()

    # bounds on the driver: pivots x pivots numbers
    between, slack = _distances(pivots, pivots), 1e-6 * np.sqrt(most) + 1e-6
    cells = np.array([r["cell"] for r in summary])
    near = [np.array(r["near"]) for r in summary]
    low, high = np.array([x[0] for x in near]), np.array([r["far"] for r in summary])
    size = max(QUERIES_PER_GROUP, -(-n_queries // MOST_GROUPS))
    group_of: dict[int, tuple[int, int]] = {}  # cell -> first group, parts
    reach: list[tuple[np.ndarray, np.ndarray]] = []  # of each group: distances to each pivot that it needs
    bound = {}
    filled = size
    for r in sorted(q_summary, key=lambda r: r["cell"]):
        to = between[r["cell"]][cells]
        upper = np.sort(np.concatenate([r["far"] + t + x for t, x in zip(to, near, strict=True)]))
        theta = (upper[k] if len(upper) > k else np.inf) + slack
        bound[r["cell"]] = float(theta)
        need = to - r["far"] - theta - slack, to + r["far"] + theta + slack
        parts = -(-r["n"] // size)
        if parts > 1 or filled + r["n"] > size:
            group_of[r["cell"]] = len(reach), parts
            reach += [need] * parts
            filled = r["n"] if parts == 1 else size
        else:
            group_of[r["cell"]] = len(reach) - 1, 1
            reach[-1] = np.minimum(reach[-1][0], need[0]), np.maximum(reach[-1][1], need[1])
            filled += r["n"]
    lows, highs = np.array([x[0] for x in reach]), np.array([x[1] for x in reach])
    # chunks of data: neighbouring small cells share one, a large cell has several
    sizes = np.array([r["n"] for r in summary])
    first_chunk, parts_of, filled, n_chunks = np.zeros(len(cells), np.int64), np.ones(len(cells), np.int64), ROWS_PER_CHUNK, 0
    for i in np.argsort(between[0][cells], kind="stable").tolist():
        parts_of[i] = -(-sizes[i] // ROWS_PER_CHUNK)
        if parts_of[i] > 1 or filled + sizes[i] > ROWS_PER_CHUNK:
            first_chunk[i], n_chunks = n_chunks, n_chunks + parts_of[i]
            filled = sizes[i] if parts_of[i] == 1 else ROWS_PER_CHUNK
        else:
            first_chunk[i], filled = n_chunks - 1, filled + sizes[i]
    meets = (lows <= high) & (highs >= low)  # groups x cells
    reached = [np.unique(np.concatenate([np.zeros(0, np.int64), *[np.arange(first_chunk[i], first_chunk[i] + parts_of[i]) for i in np.flatnonzero(row)]])) for row in meets]
    needs = spark.sparkContext.broadcast((cells, lows, highs, first_chunk, parts_of))
    groups = spark.sparkContext.broadcast((group_of, bound, reached))

    def replicate(batches):
        cells_, lows, highs, firsts, parts = needs.value
        place = {int(c): i for i, c in enumerate(cells_)}
        for b in batches:
            column, d, rows = np.array([place[c] for c in np.asarray(b["cell"]).tolist()]), np.asarray(b["d"]), np.asarray(b[ROW])
            chunk = firsts[column] + (mix64(rows.astype(np.uint64)) % parts[column].astype(np.uint64)).astype(np.int64)
            row, group = np.nonzero((d[:, None] >= lows[:, column].T) & (d[:, None] <= highs[:, column].T))
            for begin in range(0, len(row), 50_000):
                r = pa.array(row[begin : begin + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(group[begin : begin + 50_000], pa.int32()), pa.array(chunk[row[begin : begin + 50_000]], pa.int32()), b[ROW].take(r), b["vec_id"].take(r), b["v"].take(r)], ["grp", "chunk", ROW, "vec_id", "v"])

    def spread(batches):
        of, bounds, chunks_of = groups.value
        for b in batches:
            rows, cell = np.asarray(b[ROW]), np.asarray(b["cell"])
            first, parts = np.array([of[c][0] for c in cell.tolist()]), np.array([of[c][1] for c in cell.tolist()])
            group = first + (mix64(rows.astype(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
            theta = pa.array([bounds[c] for c in cell.tolist()], pa.float64())
            times = np.array([len(chunks_of[g]) for g in group.tolist()], dtype=np.int64)
            for begin in range(0, len(rows), 512):
                part = slice(begin, begin + 512)
                r = pa.array(np.repeat(np.arange(len(rows))[part], times[part]))
                chunk = np.concatenate([np.zeros(0, np.int64), *[chunks_of[g] for g in group[part].tolist()]])
                yield pa.RecordBatch.from_arrays([pa.array(group, pa.int32()).take(r), pa.array(chunk, pa.int32()), b[ROW].take(r), b["vec_id"].take(r), b["v"].take(r), theta.take(r)], ["grp", "chunk", ROW, "vec_id", "v", "theta"])

    sent = placed.mapInArrow(replicate, f"grp int, chunk int, {ROW} long, vec_id long, v array<long>")
    asked = asked.mapInArrow(spread, f"grp int, chunk int, {ROW} long, vec_id long, v array<long>, theta double")

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("vec_id")
        ids, numbers, x = np.asarray(right["vec_id"]), np.asarray(right[ROW]), _matrix(right["v"], dims)
        asking, own, q, theta = np.asarray(left["vec_id"]), np.asarray(left[ROW]), _matrix(left["v"], dims), np.asarray(left["theta"])
        norms = (q.astype(np.float64) ** 2).sum(1)
        least = (norms + most - theta**2) / 2  # the score at distance theta
        least = np.where(np.isfinite(least), least - 1 - 1e-9 * (np.abs(least) + norms + most), -np.inf)
        rows = [[], [], [], []]
        for begin in range(0, len(q) if len(x) else 0, 256):
            part = slice(begin, begin + 256)
            scores = _scores(q[part], x)
            for i, found in _best(scores, numbers, own[part], least[part], k):
                rows[0].append(np.full(len(found), own[begin + i]))
                rows[1].append(np.full(len(found), asking[begin + i]))
                rows[2].append(ids[found])
                rows[3].append(scores[i][found])
        made = [np.concatenate(r) if r else np.zeros(0, np.int64) for r in rows]
        return pa.table([pa.array(m, pa.int64()) for m in made], names=[ROW, "query_id", "vec_id", "score"])

    found = asked.groupBy("grp", "chunk").cogroup(sent.groupBy("grp", "chunk")).applyInArrow(solve, f"{ROW} long, query_id long, vec_id long, score long")
    best = Window.partitionBy(ROW).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest inner products of every hundredth vector against all others."""
    data = numbered(whole_vectors(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding"), "vectors")
    return top_k(data, data.filter(F.pmod("vec_id", F.lit(100)) == 0))


QUERIES = {"op8_topk": op8_topk}
#: Brute force over all pairs: for checking at small sizes.
ORACLES = {
    "op8_topk": """
WITH v AS (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.i, q.vec_id AS query_id, x.vec_id,
         CAST(list_sum(list_transform(range(1, least(len(q.v), len(x.v)) + 1), lambda i: q.v[i] * x.v[i])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.i <> x.i WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""
}
