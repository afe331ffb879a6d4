"""Removal of repeated byte strings through suffix arrays (operator 2).

A byte goes if a 50-byte string that covers it also starts in a document with a smaller id.  The work is spread so
that no text is compared with all others:

1. Equal texts are settled by their digest; the one with the smallest id stays for the rest.
2. In every 50-byte window the 16 bytes with the least hash are its anchor; equal windows have equal anchors.
   Windows that share an anchor form a segment of 50 to 84 bytes.  How often each anchor occurs is counted in packed
   form (``exchange``); segments whose anchor occurs once are done.
3. The other segments go to buckets by their anchor; equal segments of a block of documents travel once, with the ids
   and places of all their occurrences.  An anchor that occurs very often has its segments cut into single windows
   that go by their own hash, so no bucket is filled by one passage; of these a block sends each once, with its least
   id only, and finds the occurrences again when the answer comes, so a window of every document is one entry a block.
4. A bucket builds the suffix array of its segments by two-stage sorting: suffixes not larger than their successor
   are sorted directly, the others are induced by a scan over the buckets of first bytes.  Adjacent suffixes with a
   common prefix of 50 bytes form classes, whose smallest id says which windows go.
5. The windows that go return to the documents, which are cut.

Defined results: a null text counts as empty; texts below 50 bytes stay whole; rows with equal ids don't remove
each other; null ids count as larger than all others; an empty table gives no rows; very long texts are processed
whole, in pieces of windows; other columns are not read by the query and pass through the filter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placewright.llm.common import BYTE_VALUES, materialize, mix64, powers, read, span_hashes, text_bytes
from placewright.llm.exchange import REQUEST, answers, code_of, expand, read_answers, requests, shrink

LENGTH, ANCHOR = 50, 16
#: Occurrences from which an anchor's windows are dealt out one by one.
OFTEN = 10_000
BLOCK_BYTES, PIECE = 4 << 20, 1 << 19
NO_ID = (1 << 63) - 1
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# -- suffix array ---------------------------------------------------------------------------------------


def sorted_windows(data: np.ndarray, first: np.ndarray, count: np.ndarray, size: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Windows of several segments in the order of their suffixes, and which begin a new class.

    ``first`` and ``size`` are offset and bytes of each segment in ``data``, ``count`` its number of windows.  Returns
    window numbers (segment by segment) and a flag that is set where the common prefix with the window before is
    shorter than ``length``.
    """
    padded = np.concatenate((data, np.zeros(length + 72, np.uint8)))
    # suffixes to sort: all windows, then on to the first that is not larger than its successor
    rising = padded[:-1] <= padded[1:]
    stop = first + size
    falls = np.flatnonzero(rising)
    after = np.minimum(falls[np.minimum(np.searchsorted(falls, first + count - 1), len(falls) - 1)], stop)
    total = np.maximum(after - first + 1, count)
    edge = np.cumsum(total) - total
    place = np.repeat(first - edge, total) + np.arange(int(total.sum()))
    is_first = np.zeros(len(place), bool)
    is_first[edge] = True
    is_last = np.zeros(len(place), bool)
    is_last[edge + total - 1] = True
    direct = rising[place] | is_last
    byte = padded[place]

    words = np.zeros(len(padded) - 8, np.uint64)
    for k in range(8):
        words |= padded[k : len(padded) - 8 + k].astype(np.uint64) << np.uint64(56 - 8 * k)

    def word(at: np.ndarray, k: int) -> np.ndarray:
        return words[np.minimum(at + 8 * k, len(words) - 1)]

    own = np.flatnonzero(direct)
    head = word(place[own], 0)
    by = np.argsort(head, kind="stable")
    own, head = own[by], head[by]
    new = np.ones(len(own), bool)
    new[1:] = head[1:] != head[:-1]
    for k in range(1, -(-length // 8)):  # ties go on to the next eight bytes
        group = np.cumsum(new) - 1
        tied = np.flatnonzero(np.bincount(group, minlength=1)[group] > 1)
        if not len(tied):
            break
        mine, following = group[tied], word(place[own[tied]], k)
        by = np.lexsort((following, mine))
        own[tied], following = own[tied][by], following[by]
        new[tied[1:]] = (mine[1:] != mine[:-1]) | (following[1:] != following[:-1])
    ranked_byte = byte[own]
    cuts = np.searchsorted(ranked_byte, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    for c in range(256):
        bucket = np.concatenate([*induced[c], own[cuts[c] : cuts[c + 1]]])
        induced[c] = []
        if not len(bucket):
            continue
        order.append(bucket)
        before = bucket[~is_first[bucket]] - 1
        before = before[~direct[before]]
        if len(before):
            key = byte[before]
            by = np.argsort(key, kind="stable")
            key, before = key[by], before[by]
            begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))).tolist()
            for a, b in zip(begin, [*begin[1:], len(key)], strict=True):
                induced[key[a]].append(before[a:b])
    order = np.concatenate(order) if order else np.zeros(0, np.int64)
    within = np.arange(len(place)) - np.repeat(edge, total)
    is_window = within < np.repeat(count, total)
    number = np.cumsum(is_window) - 1
    order = order[is_window[order]]
    at = place[order]
    same = np.ones(max(0, len(at) - 1), bool)
    for shift in [*range(0, length - 7, 8), length - 8]:
        w = words[at + shift]
        same &= w[1:] == w[:-1]
    return number[order], np.concatenate((np.ones(min(1, len(at)), bool), ~same))


# -- anchors --------------------------------------------------------------------------------------------


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive entries."""
    step, out = 1, key
    while step * 2 <= width:
        out = np.minimum(out[: len(out) - step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def segments(buffer: np.ndarray, edges: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """For pieces of a block: (first window, number of windows, hash of the anchor, hash of a span of bytes)."""
    stop_of = edges[1:]
    for begin in range(0, len(buffer), PIECE):
        data = buffer[begin : begin + PIECE + length - 1]
        if len(data) < length:
            break
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=total[1:])
        n = len(data) - anchor + 1
        h = mix64((total[anchor:] - total[:n]) * down[:n])
        key = h & np.uint64(0xFFFFFFFF00000000) | np.arange(n, dtype=np.uint64)
        spot = (_least(key, length - anchor + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        window = np.arange(begin, begin + len(spot))
        valid = stop_of[np.minimum(np.searchsorted(stop_of, window, side="right"), len(stop_of) - 1)] - window >= length
        new = valid.copy()
        new[1:] &= (spot[1:] != spot[:-1]) | ~valid[:-1]
        start = np.flatnonzero(new)
        if not len(start):
            continue
        number = np.cumsum(new)[valid] - 1
        count = np.bincount(number, minlength=len(start))

        def span(a: np.ndarray, b: np.ndarray, total: np.ndarray = total, down: np.ndarray = down, begin: int = begin) -> np.ndarray:
            return mix64(((total[b - begin] - total[a - begin]) * down[a - begin]) ^ (b - a).astype(np.uint64))

        yield start + begin, count, h[spot[start]], span


def _block(table: pa.Table) -> tuple[list[int], list[str], list[bytes], list[int]]:
    """Distinct texts of a block with their smallest ids, ordered by digest: ids, digests, texts, rows."""
    rows: dict[str, tuple[int, int]] = {}
    for k, (i, sha) in enumerate(zip(table["doc_id"].to_pylist(), table["sha"].to_pylist(), strict=True)):
        if sha not in rows or i < rows[sha][0]:
            rows[sha] = i, k
    order = sorted(rows)
    at = [rows[s][1] for s in order]
    return [rows[s][0] for s in order], order, [expand(t) for t in table["text"].take(pa.array(at, pa.int64())).to_pylist()], at


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


# -- the distributed steps ------------------------------------------------------------------------------


def _first_copies(docs: DataFrame, n_blocks: int) -> DataFrame:
    """(block, doc_id, sha, packed text): texts long enough; of equal texts one for each task, with its smallest id."""

    def run(batches):
        best: dict[bytes, int] = {}
        for batch in batches:
            sha, ids = batch["sha"].to_pylist(), batch["doc_id"].to_pylist()
            keep = []
            for i, (s, d) in enumerate(zip(sha, ids, strict=True)):
                short = bytes.fromhex(s[:32])
                if best.get(short, NO_ID + 1) > d:
                    best[short] = d
                    keep.append(i)
            if keep:
                found = batch.take(pa.array(keep))
                packed = pa.array([shrink(t) for t in found["text"].to_pylist()], pa.binary())
                yield found.set_column(found.schema.get_field_index("text"), "text", packed)

    long_enough = docs.filter(F.length("text") >= LENGTH)
    return long_enough.mapInArrow(run, long_enough.schema).withColumn("block", F.pmod(F.xxhash64("sha"), F.lit(n_blocks)).cast("int"))


def _steps(n_parts: int, n_buckets: int):
    def ask(table: pa.Table) -> pa.Table:
        texts = _block(table)[2]
        found = [h for _, _, h, _ in segments(*_joined(texts))]
        return requests(table["block"][0].as_py(), np.concatenate([*found, np.zeros(0, np.uint64)]), n_parts)

    def send(docs: pa.Table, got: pa.Table) -> pa.Table:
        names = ["bucket", "block", "windows", "bytes", "times", "ids", "ordinals", "starts"]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
        if not docs.num_rows or not got.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        block = docs["block"][0].as_py()
        ids, _, texts, _ = _block(docs)
        buffer, edges = _joined(texts)
        pieces = list(segments(buffer, edges))
        count = read_answers(np.concatenate([p[2] for p in pieces]), n_parts, got)
        often, at = code_of(OFTEN), 0
        number, found, frequent = np.array(ids, np.int64), [[], [], [], []], [[], []]
        for begin, n, h, span in pieces:
            c = count[at : at + len(n)]
            at += len(n)
            some = np.flatnonzero((c > 1) & (c < often))
            hot = np.flatnonzero(c >= often)
            each = np.repeat(begin[hot] - (np.cumsum(n[hot]) - n[hot]), n[hot]) + np.arange(int(n[hot].sum()))
            for row, part in zip((*found, *frequent), (begin[some], n[some], h[some], span(begin[some], begin[some] + n[some] + LENGTH - 1), each, span(each, each + LENGTH)), strict=True):
                row.append(part)
        (start, windows, route, same), (each, own) = (tuple(map(np.concatenate, x)) for x in (found, frequent))
        by = np.argsort(own, kind="stable")
        each, own = each[by], own[by]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(own)), bool), own[1:] != own[:-1])))
        least = np.minimum.reduceat(number[np.searchsorted(edges, each, side="right") - 1], first) if len(first) else number[:0]
        doc = np.concatenate((number[np.searchsorted(edges, start, side="right") - 1], least))
        hot = np.repeat([0, 1], [len(start), len(first)]).astype(np.uint8)
        start, windows = np.concatenate((start, each[first])), np.concatenate((windows, np.ones(len(first), np.int64)))
        route, same = np.concatenate((route, own[first])), np.concatenate((same, own[first]))
        bucket = ((route >> np.uint64(20)) % np.uint64(n_buckets)).astype(np.int32)
        order = np.lexsort((start, same, hot, bucket))  # equal segments of the block together
        start, windows, bucket, same, doc, hot = (x[order] for x in (start, windows, bucket, same, doc, hot))
        new = np.concatenate((np.ones(min(1, len(same)), bool), (same[1:] != same[:-1]) | (hot[1:] != hot[:-1]) | (bucket[1:] != bucket[:-1])))
        head = np.flatnonzero(new)
        times = np.diff(np.append(head, len(same)))
        ordinal = np.searchsorted(edges, start, side="right") - 1
        local = start - edges[ordinal]
        data = _gather(buffer, start[head], windows[head] + LENGTH - 1)
        data_edge = np.concatenate(([0], np.cumsum(windows[head] + LENGTH - 1)))
        present, begin = np.unique(bucket[head], return_index=True)
        ends = np.append(begin, len(head))[1:]
        kind = windows.astype(np.uint8) | hot << 7
        rows = [[] for _ in range(6)]
        for a, b in zip(begin.tolist(), ends.tolist(), strict=True):
            x, y = head[a], head[b] if b < len(head) else len(same)
            for row, part in zip(rows, (kind[head[a:b]], data[data_edge[a] : data_edge[b]], times[a:b].astype(np.uint32), doc[x:y], ordinal[x:y].astype(np.uint32), local[x:y].astype(np.uint32)), strict=True):
                row.append(shrink(part))
        return pa.table([pa.array(present, kinds[0]), pa.array(np.full(len(present), block), kinds[1]), *[pa.array(r, pa.binary()) for r in rows]], names=names)

    def solve(table: pa.Table) -> pa.Table:
        def column(name: str, kind) -> np.ndarray:
            return np.concatenate([expand(x, kind) for x in table[name].to_pylist()])

        kind, times = column("windows", np.uint8), column("times", np.uint32).astype(np.int64)
        windows, hot = (kind & 127).astype(np.int64), kind >> 7 > 0
        ids, ordinals, starts = column("ids", np.int64), column("ordinals", np.uint32), column("starts", np.uint32).astype(np.int64)
        block = np.repeat(np.array(table["block"].to_pylist()), [int.from_bytes(x[:8], "little") // 8 for x in table["ids"].to_pylist()])
        size = windows + LENGTH - 1
        edge = np.cumsum(times) - times
        least = np.minimum.reduceat(ids, edge)
        order, new = sorted_windows(column("bytes", np.uint8), np.cumsum(size) - size, windows, size)
        segment = np.repeat(np.arange(len(windows)), windows)
        heads = np.flatnonzero(new)
        smallest = np.empty(len(order), np.int64)
        smallest[order] = np.repeat(np.minimum.reduceat(least[segment[order]], heads), np.diff(np.append(heads, len(order))))
        # every occurrence of a segment has its windows; those of very frequent ones are looked for in their blocks
        of = np.repeat(np.arange(len(windows)), times)
        n = np.where(hot[of], 0, windows[of])
        occurrence = np.repeat(np.arange(len(of)), n)
        offset = np.arange(len(occurrence)) - np.repeat(np.cumsum(n) - n, n)
        window_edge = np.cumsum(windows) - windows
        gone = smallest[window_edge[of[occurrence]] + offset] < ids[occurrence]
        occurrence, offset = occurrence[gone], offset[gone]
        run = np.concatenate((np.ones(min(1, len(offset)), bool), (occurrence[1:] != occurrence[:-1]) | (offset[1:] != offset[:-1] + 1)))
        begin = np.flatnonzero(run)
        stop = np.append(begin[1:], len(offset)) - 1 if len(begin) else begin
        who = occurrence[begin]
        first = starts[who] + offset[begin]
        last = starts[who] + offset[stop] + LENGTH
        answers_ = _by_block(block[who], {"ordinals": ordinals[who], "begins": first.astype(np.uint32), "ends": last.astype(np.uint32)})
        at = np.flatnonzero(hot[of])
        frequent = _by_block(block[at], {"hot_ordinals": ordinals[at], "hot_starts": starts[at].astype(np.uint32), "hot_least": smallest[window_edge[of[at]]]})
        return pa.concat_tables([answers_, frequent], promote_options="default").select(SPANS)

    return ask, send, solve


#: What a bucket answers to a block: spans that go, and very frequent windows with their least ids.
SPANS = ["block", "ordinals", "begins", "ends", "hot_ordinals", "hot_starts", "hot_least"]


def _by_block(block: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    """One row for each block with its entries of the columns, packed."""
    by = np.argsort(block, kind="stable")
    present, at = np.unique(block[by], return_index=True)
    cut = np.append(at, len(by)).tolist()
    packed = [pa.array([shrink(x[by[a:b]]) for a, b in zip(cut, cut[1:], strict=False)], pa.binary()) for x in columns.values()]
    return pa.table([pa.array(present, pa.int32()), *packed], names=["block", *columns])


def _found_again(buffer: np.ndarray, edges: np.ndarray, ids: np.ndarray, places: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, start) of the windows that are equal to one of those at ``places`` and have a larger id than its least."""
    sample = _gather(buffer, places, np.full(len(places), LENGTH))
    keys = span_hashes(sample, np.arange(len(places)) * LENGTH, np.arange(1, len(places) + 1) * LENGTH)
    by = np.argsort(keys)
    keys, places, least = keys[by], places[by], least[by]
    maybe = np.zeros(1 << 20, bool)  # by the first bits: most windows are none of these
    maybe[keys >> np.uint64(44)] = True
    out = [], []
    for begin in range(0, len(buffer) - LENGTH + 1, PIECE):
        data = buffer[begin : begin + PIECE + LENGTH - 1]
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=total[1:])
        h = mix64((total[LENGTH:] - total[:-LENGTH]) * down[: len(data) - LENGTH + 1] ^ np.uint64(LENGTH))
        here = np.flatnonzero(maybe[h >> np.uint64(44)])
        h = h[here]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        equal = keys[at] == h
        at, here = at[equal], here[equal] + begin
        text = np.searchsorted(edges, here, side="right") - 1
        good = (edges[text + 1] - here >= LENGTH) & (least[at] < ids[text])
        at, here, text = at[good], here[good], text[good]
        span = np.arange(LENGTH)
        same = np.concatenate([np.zeros(0, bool), *[(buffer[here[a : a + 10_000, None] + span] == buffer[places[at[a : a + 10_000], None] + span]).all(1) for a in range(0, len(here), 10_000)]])
        out[0].append(text[same])
        out[1].append((here - edges[text])[same])
    return np.concatenate([np.zeros(0, np.int64), *out[0]]), np.concatenate([np.zeros(0, np.int64), *out[1]])


def _gather(buffer: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of several spans, one after another."""
    return buffer[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


def cut_spans(text: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which bytes of a text are in one of the spans."""
    change = np.zeros(len(text) + 1, np.int32)
    np.add.at(change, begins, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def _removals(docs: DataFrame, finish, schema) -> DataFrame:
    """``finish(rows, digests, texts, masks or None)`` over the first copies of all texts of at least 50 bytes.

    docs: doc_id (never null), text (binary), sha, and what else ``finish`` wants of a row.
    """
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(8, -(-total // BLOCK_BYTES))
    n_parts = max(8, total // (16 << 20))
    ask, send, solve = _steps(n_parts, n_blocks)
    blocks = _first_copies(docs, n_blocks)
    got = answers(blocks.groupBy("block").applyInArrow(ask, REQUEST))
    sent = blocks.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(send, "bucket int, block int, windows binary, bytes binary, times binary, ids binary, ordinals binary, starts binary")
    spans = sent.groupBy("bucket").applyInArrow(solve, ", ".join(f"{c} {'binary' if i else 'int'}" for i, c in enumerate(SPANS)))

    def close(docs_: pa.Table, spans_: pa.Table) -> pa.Table:
        ids, digests, texts, at = _block(docs_)
        column = lambda c, kind: np.concatenate([np.zeros(0, np.int64), *[expand(x, kind).astype(np.int64) for x in spans_[c].to_pylist() if x is not None]])
        ordinals, begins, ends = (column(c, np.uint32) for c in SPANS[1:4])
        hot, starts, least = column("hot_ordinals", np.uint32), column("hot_starts", np.uint32), column("hot_least", np.int64)
        if len(hot):
            buffer, edges = _joined(texts)
            again, where = _found_again(buffer, edges, np.array(ids, np.int64), edges[hot] + starts, least)
            ordinals, begins, ends = np.concatenate((ordinals, again)), np.concatenate((begins, where)), np.concatenate((ends, where + LENGTH))
        order = np.argsort(ordinals, kind="stable")
        edges = np.searchsorted(ordinals[order], np.arange(len(texts) + 1))
        masks = [cut_spans(t, begins[order[a:b]], ends[order[a:b]]) if b > a else None for t, a, b in zip(texts, edges, edges[1:], strict=False)]
        return finish(docs_.take(pa.array(at, pa.int64())), digests, texts, masks)

    return blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(close, schema)


def _with_digest(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    data = F.coalesce(text_bytes(text_col), F.lit(b""))
    number = F.col(id_col).cast("long")
    return docs.select(F.coalesce(number, F.lit(NO_ID)).alias("doc_id"), number.isNull().alias("no_id"), data.alias("text")).withColumn("sha", F.sha2("text", 256))


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def finish(_, digests, texts, masks) -> pa.Table:
        removed, spans, kept = [], [], []
        for text, sha, mask in zip(texts, digests, masks, strict=True):
            if mask is None:
                removed.append(0)
                spans.append(0)
                kept.append(sha)
            else:
                removed.append(int(mask.sum()))
                spans.append(int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()))
                kept.append(hashlib.sha256(np.frombuffer(text, np.uint8)[~mask].tobytes()).hexdigest())
        return pa.table([pa.array(digests, pa.string()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string())], names=["sha", "n_removed", "n_spans", "kept"])

    rows = _with_digest(docs, id_col, text_col)
    cut = _removals(rows.drop("no_id"), finish, "sha string, n_removed long, n_spans long, kept string")
    small = rows.select("doc_id", "no_id", F.length("text").cast("long").alias("n_bytes"), "sha")
    first = small.groupBy("sha").agg(F.min("doc_id").alias("first"))
    # written, so that both sides of the last join are read anew and a text with very many copies can be split
    known = materialize(first.join(cut, "sha", "left"), "known")
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    return small.join(known, "sha").select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )


def whole_characters(text: bytes, mask: np.ndarray) -> np.ndarray:
    """The mask without characters of which only some bytes are set."""
    lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    number = np.cumsum(lead) - 1
    number = np.maximum(number, 0)
    partly = np.bincount(number, ~mask) > 0
    return mask & ~partly[number]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated strings cut from the text (whole characters only); rows of which nothing is left go.

    Texts below 50 bytes stay as they are; of rows with equal longer texts the one with the smallest id stays.  The
    rows travel with their texts, so nothing is joined afterwards.
    """
    kept = docs.columns
    own = StructType([f for f in docs.schema.fields])

    def finish(rows, digests, texts, masks) -> pa.Table:
        cut = [t if m is None else np.frombuffer(t, np.uint8)[~whole_characters(t, m)].tobytes() for t, m in zip(texts, masks, strict=True)]
        left = pa.array([i for i, t in enumerate(cut) if masks[i] is None or t.strip()], pa.int64())
        columns = [pa.array([t.decode("utf-8", "replace") for t in cut], pa.string()) if k == text_col else pa.array(rows["row"].combine_chunks().field(k)) for k in kept]
        return pa.table(columns, names=kept).take(left)

    data = text_bytes(text_col)
    short = docs.filter(data.isNull() | (F.length(data) < LENGTH))
    rows = docs.filter(F.length(data) >= LENGTH)
    blank = [F.lit(None).cast(f.dataType).alias(f.name) if f.name == text_col else F.col(f"`{f.name}`") for f in docs.schema.fields]
    held = rows.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), data.alias("text"), F.sha2(data, 256).alias("sha"), F.struct(*blank).alias("row"))
    return _removals(held, finish, own).unionByName(short)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 50-byte strings of all documents."""
    return repeated_bytes(read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
#: Every window of every text: for small tables with an id for each row.
ORACLES = {
    "op2_suffix_dedup": """
WITH b AS MATERIALIZED (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), p AS MATERIALIZED (
  SELECT doc_id, h, unnest(range(1, length(h) // 2 + 1)) AS p FROM b
), v AS MATERIALIZED (
  SELECT doc_id, p, substr(h, 2 * p - 1, 100) AS g FROM p WHERE 2 * p + 98 <= length(h)
), f AS (
  SELECT g, min(doc_id) AS first FROM v GROUP BY g
), gone AS (
  SELECT v.doc_id, v.p, v.p AS start FROM v JOIN f USING (g) WHERE f.first < v.doc_id
), m AS (
  SELECT p.doc_id, p.p, substr(h, 2 * p.p - 1, 2) AS byte, coalesce(max(start) OVER (PARTITION BY p.doc_id ORDER BY p.p) + 49 >= p.p, false) AS removed
  FROM p LEFT JOIN gone ON gone.doc_id = p.doc_id AND gone.p = p.p
), k AS (
  SELECT *, removed AND NOT coalesce(lag(removed) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM m
), a AS (
  SELECT doc_id, count(*) FILTER (removed) AS n_removed, count(*) FILTER (opens) AS n_spans, coalesce(string_agg(byte, '' ORDER BY p) FILTER (NOT removed), '') AS kept FROM k GROUP BY 1
)
SELECT b.doc_id, CAST(length(b.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM b LEFT JOIN a USING (doc_id)"""
}
