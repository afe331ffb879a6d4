"""N-gram Jaccard join (operator 1).

Documents are sets of 5-word shingles (64-bit hashes).  Two link if their Jaccard similarity is 0.75 or more; every
document gets the smallest id in its component.

1. A document of n shingles can only have a partner if at most n // 4 of its shingles are found nowhere else.
   How often a shingle occurs is counted in packed form (``exchange``), first for half of the shingles of all
   documents, then for all shingles of those that are left.  Equal sets become one node in between.
2. The global order of shingles is by count, then by hash.  The first n // 4 + 1 of a node's shingles are its
   prefix; nodes that link share a shingle of their prefixes.
3. Each prefix shingle has a leader, the node with the smallest share of shingles of its own; every node is verified
   with its most frequent leader.  Near copies of one text thereby meet its best copy, not each other.
4. What shares a prefix shingle but isn't connected yet is verified pair by pair, with filters by length and by
   position, so no link is lost; pairs that are connected already can't change a component.
5. Verification is the vertical partitioning: the global order is cut into fragments of equal weight, each task counts
   the overlaps of its pairs in its fragment, and the counts are summed for each pair.  What a candidate filter adds
   to this: only pairs that steps 3 and 4 bring together are counted, and no pair that links is missing among them.
   A leader is spread over as many tasks as its members fill.

Defined results: null or blank texts have no shingles and component themselves; a text below five words is one
shingle; very long texts are hashed whole; repeated rows share a component, ties (equal texts, equal overlaps) change
nothing; null ids have a null component unless something with an id is reachable; an empty table gives no rows; other
columns are not read.  Hashes of 64 bits stand for shingles, 56 of them behind the count in the global order.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewright.llm.common import chunks, map_arrow, materialize, mix64, read, text_bytes, word_table
from placewright.llm.components import components
from placewright.llm.exchange import REQUEST, answers, read_answers, requests

SIZE, NEED = 5, 75
BLOCK_BYTES, CHUNK = 4 << 20, 1 << 19
FRAGMENTS = 4
#: Pairs that one group of a verification has.
PAIRS_PER_GROUP = 1000

_ODD = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text."""
    words, first = word_table([t.lower() for t in texts])  # bytes.lower changes A-Z only
    n = max(0, len(words) - size + 1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += words[k : k + n] * _ODD[k]
    total = mix64(total)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(total[a : b - size + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                short = (words[a:b] * _ODD[size : size + b - a]).sum(dtype=np.uint64) + _ODD[40 + b - a]
            out.append(mix64(np.array([short], np.uint64)))
        else:
            out.append(words[:0])
    return out


def _sampled(tokens: np.ndarray) -> np.ndarray:
    """Half of all shingles, the same half everywhere."""
    return tokens[(tokens >> np.uint64(63)) == 0]


def _steps(n_parts: int, size: int):
    def block(table: pa.Table):
        """Rows in an order that doesn't depend on how they came, with their sets."""
        ids, texts = table["doc_id"].to_pylist(), [t or b"" for t in table["text"].to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        ids, texts = [ids[i] for i in order], [texts[i] for i in order]
        return ids, [s for part in chunks(texts, CHUNK) for s in shingle_sets([texts[i] for i in part], size)]

    def ask(table: pa.Table) -> pa.Table:
        _, sets = block(table)
        return requests(table["block"][0].as_py(), np.concatenate([*map(_sampled, sets), np.zeros(0, np.uint64)]), n_parts)

    def keep(docs: pa.Table, got: pa.Table) -> pa.Table:
        ids, sets = block(docs) if docs.num_rows else ([], [])
        sample = [_sampled(s) for s in sets]
        count = read_answers(np.concatenate([*sample, np.zeros(0, np.uint64)]), n_parts, got)
        alone = np.concatenate(([0], np.cumsum(count == 1)))
        edges = np.cumsum([0, *map(len, sample)])
        digest, tokens = [], []
        for s, a, b in zip(sets, edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            data = s.tobytes() if len(s) and alone[b] - alone[a] <= len(s) // 4 else None
            tokens.append(data)
            digest.append(None if data is None else hashlib.blake2b(data, digest_size=16).digest())
        return pa.table([pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(tokens, pa.binary())], names=["doc_id", "n", "node", "tokens"])

    return ask, keep


def _node_steps(n_parts: int):
    def block(table: pa.Table):
        nodes, tokens = table["node"].to_pylist(), table["tokens"].to_pylist()
        order = sorted(range(len(nodes)), key=lambda i: nodes[i])
        return [nodes[i] for i in order], [np.frombuffer(tokens[i], np.uint64) for i in order]

    def ask(table: pa.Table) -> pa.Table:
        return requests(table["block"][0].as_py(), np.concatenate(block(table)[1]), n_parts)

    def keep(table: pa.Table, got: pa.Table) -> pa.Table:
        nodes, sets = block(table) if table.num_rows else ([], [])
        count = read_answers(np.concatenate([*sets, np.zeros(0, np.uint64)]), n_parts, got)
        rows, at = [], 0
        for node, s in zip(nodes, sets, strict=True):
            c = count[at : at + len(s)]
            at += len(s)
            alone = int((c == 1).sum())
            prefix = len(s) // 4 + 1
            if alone < prefix:  # shingles found nowhere else come first in the order, and no overlap has them
                place = np.sort(c.astype(np.uint64) << np.uint64(56) | s >> np.uint64(8))
                rows.append((node, len(s), alone, place[alone:].tobytes(), place[alone:prefix].view(np.int64).tolist()))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["node", "n", "alone", "tokens", "prefix"])

    return ask, keep


def fragment_edges(sets: DataFrame, fragments: int = FRAGMENTS) -> np.ndarray:
    """Where the global order is cut, so that fragments hold about as many shingles; at most 65,536 counts are read."""

    def work(table: pa.Table) -> pa.Table:
        high = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(t, np.uint64) for t in table["tokens"].to_pylist()]]) >> np.uint64(48)
        found, n = np.unique(high, return_counts=True)
        return pa.table([pa.array(found.astype(np.int64)), pa.array(n, pa.int64())], names=["high", "n"])

    found = map_arrow(sets.select("tokens"), work, "high long, n long").groupBy("high").agg(F.sum("n").alias("n")).orderBy("high").toArrow()
    upto = np.cumsum(np.asarray(found["n"], dtype=np.int64))
    if not len(upto):
        return np.zeros(fragments - 1, np.uint64)
    at = np.searchsorted(upto, upto[-1] * np.arange(1, fragments) / fragments)
    last = np.asarray(found["high"])[at].astype(np.uint64)
    return last << np.uint64(48) | np.uint64((1 << 48) - 1)


def verified(pairs: DataFrame, sets: DataFrame, n_pairs: int, edges: np.ndarray, need: int = NEED) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, with the overlap; ``sets`` has node, n, tokens."""
    groups = max(8, -(-n_pairs // PAIRS_PER_GROUP))
    # written, so the join below can be split where a leader has very many members
    members = materialize(pairs.groupBy("b").agg(F.ceil(F.count("*") / PAIRS_PER_GROUP).alias("spread")).filter("spread > 1"), "spread")
    pairs = pairs.join(members, "b", "left").withColumn("part", F.pmod(F.xxhash64("a"), F.coalesce("spread", F.lit(1))))
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("b", "part"), F.lit(groups)).cast("int").alias("grp"))
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t")), "a")
    right = pairs.select("grp", "b").distinct().join(sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t")), "b")

    def cut(keys: list[str]):
        def run(table: pa.Table) -> pa.Table:
            at, fragment, tokens = [], [], []
            for i, data in enumerate(table["t"].to_pylist()):
                s = np.frombuffer(data, np.uint64)
                for f, part in enumerate(np.split(s, np.searchsorted(s, edges, side="right"))):
                    at.append(i)
                    fragment.append(f)
                    tokens.append(part.tobytes())
            rows = table.take(pa.array(at, pa.int64()))
            return pa.table([*[rows[k] for k in keys], pa.array(fragment, pa.int32()), pa.array(tokens, pa.binary())], names=[*keys, "fragment", "t"])

        return run

    left = map_arrow(left.select("grp", "a", "b", "n_a", "t"), cut(["grp", "a", "b", "n_a"]), "grp int, a binary, b binary, n_a long, fragment int, t binary")
    right = map_arrow(right.select("grp", "b", "n_b", "t"), cut(["grp", "b", "n_b"]), "grp int, b binary, n_b long, fragment int, t binary")

    def overlaps(x: pa.Table, y: pa.Table) -> pa.Table:
        b, n_b = y["b"].to_pylist(), y["n_b"].to_pylist()
        own = dict(zip(b, zip(n_b, [np.frombuffer(t, np.uint64) for t in y["t"].to_pylist()], strict=True), strict=True))
        counts, sizes = [], []
        for leader, data in zip(x["b"].to_pylist(), x["t"].to_pylist(), strict=True):
            n, tokens = own[leader]
            mine = np.frombuffer(data, np.uint64)
            if len(tokens) and len(mine):
                at = np.searchsorted(tokens, mine)
                counts.append(int((tokens[np.minimum(at, len(tokens) - 1)] == mine).sum()))
            else:
                counts.append(0)
            sizes.append(n)
        return pa.table([x["a"], x["b"], x["n_a"], pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["a", "b", "n_a", "n_b", "overlap"])

    found = left.groupBy("grp", "fragment").cogroup(right.groupBy("grp", "fragment")).applyInArrow(overlaps, "a binary, b binary, n_a long, n_b long, overlap long")
    total = found.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return total.filter(F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * need).select("a", "b", "overlap")


#: Bytes that ``_sortable`` writes.
ID_BYTES = 9


def _sortable(number):
    """A long or null as nine bytes in the same order, null last: the node with the least bytes has the least id."""
    digits = F.lpad(F.hex(F.coalesce(number, F.lit(0)).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.unhex(F.concat(F.when(number.isNull(), "01").otherwise("00"), digits))


def _number(data):
    """The long or null that ``_sortable`` wrote."""
    value = F.conv(F.hex(F.substring(data, 2, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    return F.when(F.hex(F.substring(data, 1, 1)) == "00", value)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks, n_parts = max(8, -(-total // BLOCK_BYTES)), max(8, total // (12 << 20))
    ask, keep = _steps(n_parts, SIZE)
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int"))
    got = answers(blocks.groupBy("block").applyInArrow(ask, REQUEST))
    sets = materialize(blocks.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(keep, "doc_id long, n long, node binary, tokens binary"), "sets")

    # equal sets are one node
    small = sets.select("doc_id", F.col("n").alias("n_shingles"), "node")
    nodes = sets.filter("node is not null").groupBy("node").agg(F.first("tokens").alias("tokens"), F.min("doc_id").alias("least"))
    nodes = nodes.select(F.concat(_sortable(F.col("least")), "node").alias("node"), "tokens")
    facts = sets.filter("node is not null").agg(F.sum(F.length("tokens"))).first()[0] or 0
    n_blocks, n_parts = max(8, -(-facts // BLOCK_BYTES)), max(8, facts // (8 << 20))
    ask, keep = _node_steps(n_parts)
    nodes = nodes.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(n_blocks)).cast("int"))
    got = answers(nodes.groupBy("block").applyInArrow(ask, REQUEST))
    kept = materialize(nodes.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(keep, "node binary, n long, alone long, tokens binary, prefix array<long>"), "nodes")

    labels = _labels(kept).select(F.substring("node", ID_BYTES + 1, 16).alias("node"), _number(F.substring("label", 1, ID_BYTES)).alias("label"))
    per_node = small.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    of_node = materialize(per_node.join(labels, "node", "left").select("node", F.coalesce("label", "least").alias("component_id")), "named")
    linked = small.filter("node is not null").join(of_node, "node").select("doc_id", "n_shingles", "component_id")
    alone = small.filter("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def _labels(kept: DataFrame) -> DataFrame:
    """(node, label) of the nodes that have a link."""
    # a prefix of p shingles, of which ``alone`` come first; posexplode gives the place of the others
    places = materialize(kept.select("node", "n", "alone", F.posexplode("prefix").alias("at", "token")).withColumn("at", F.col("at") + F.col("alone")), "places")
    shared = places.groupBy("token").agg(F.count("*").alias("m"), F.min(F.struct((F.col("alone") / F.col("n")).alias("share"), F.col("node").alias("b"), F.col("n").alias("n_b"))).alias("lead")).filter("m > 1").select("token", "lead.b", "lead.n_b")
    close = F.least("n", "n_b") * 4 >= F.greatest("n", "n_b") * 3
    led = places.join(shared, "token").filter((F.col("node") != F.col("b")) & close).groupBy("node", "b").count()
    first = materialize(led.groupBy("node").agg(F.max(F.struct("count", "b")).alias("best")).select(F.col("node").alias("a"), F.col("best.b").alias("b")), "pairs")
    edges = fragment_edges(kept)
    links = materialize(verified(first, kept, first.count(), edges), "links")
    labels = materialize(components(links), "labels")

    # what shares a prefix shingle and isn't connected yet
    known = places.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    by = known.groupBy("token", "label").agg(F.count("*").alias("m"))
    mixed = by.groupBy("token").agg(F.count("*").alias("k"), F.max(F.struct("m", "label")).alias("most")).filter("k > 1").select("token", F.col("most.label").alias("main"))
    open_ = materialize(known.join(mixed, "token"), "open")
    x = open_.filter("label <> main").select("token", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"), F.col("label").alias("l_a"))
    y = open_.select("token", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), F.col("label").alias("l_b"), "main")
    fits = F.least("n_a", "n_b") * 4 >= F.greatest("n_a", "n_b") * 3
    # the first shared shingle of a pair that links leaves room for its overlap
    room = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) * 175 >= (F.col("n_a") + F.col("n_b")) * 75
    once = (F.col("l_b") == F.col("main")) | (F.col("a") < F.col("b"))
    rest = materialize(x.join(y, "token").filter((F.col("l_a") != F.col("l_b")) & fits & room & once).select("a", "b").distinct(), "pairs")
    n_rest = rest.count()
    if not n_rest:
        return labels
    more = materialize(verified(rest, kept, n_rest, edges).select("a", "b"), "links")
    if more.isEmpty():
        return labels
    return components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return jaccard_components(read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op1_ngram_join": op1_ngram_join}
#: All pairs that share a shingle: for small tables with an id for each row.
ORACLES = {
    "op1_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
                             WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w
), n AS MATERIALIZED (
  SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1
), c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS MATERIALIZED (
  SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)
), e AS MATERIALIZED (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r AS (
  SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT e.y, r.root FROM r JOIN e ON r.node = e.x
)
SELECT n.doc_id, n.n AS n_shingles, min(r.root) AS component_id FROM n JOIN r ON r.node = n.doc_id GROUP BY ALL"""
}
