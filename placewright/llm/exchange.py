"""Counting values over all rows without a row per value.

A block of documents asks, for every 64-bit value it holds, how often that value is held anywhere.  A block counts its
own first: each value travels once, with its count if that isn't one, so a value of every document reaches its part once
for each block.  Values are dealt to parts by their low bits and travel packed, five bytes each; a part adds their counts
up and sends back one byte per value, in the order asked.  Five bytes and the part may confuse two values, which only raises a count: users treat
counts as an upper bound and verify what they keep.  Nothing but these packed columns is shuffled, and no count is
gathered anywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

def shrink(x: np.ndarray | bytes) -> bytes:
    """An array as bytes for a shuffle: its bytes by place, compressed, behind their number."""
    raw = x if isinstance(x, bytes) else np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() if len(x) else b""
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def expand(data: bytes, kind=None) -> np.ndarray | bytes:
    """What ``shrink`` packed: an array of ``kind``, or bytes."""
    n = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=n, codec="zstd", asbytes=True) if n else b""
    if kind is None:
        return raw
    width = np.dtype(kind).itemsize
    return np.frombuffer(np.frombuffer(raw, np.uint8).reshape(width, -1).T.tobytes(), kind)


REQUEST = "part int, block int, packed binary"
ANSWER = "block int, part int, counts binary"


def order_by_part(values: np.ndarray, n_parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order that sorts values by part, the parts present, their edges in that order)."""
    part = (values % np.uint64(n_parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    present, begin = np.unique(part[order], return_index=True)
    return order, present, np.append(begin, len(values))


def requests(block: int, values: np.ndarray, n_parts: int) -> pa.Table:
    values, times = np.unique(values, return_counts=True)
    order, present, edges = order_by_part(values, n_parts)
    values, times = values[order], times[order]
    high, middle = (values >> np.uint64(32)).astype(np.uint32), ((values >> np.uint64(24)) & np.uint64(0xFF)).astype(np.uint8)
    packed = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        again = np.flatnonzero(times[a:b] > 1).astype(np.uint32)
        packed.append(b"".join((high[a:b].tobytes(), middle[a:b].tobytes(), again.tobytes(), times[a:b][again].astype(np.uint32).tobytes(), len(again).to_bytes(4, "little"))))
    return pa.table([pa.array(present, pa.int32()), pa.array(np.full(len(present), block), pa.int32()), pa.array(packed, pa.binary())], names=["part", "block", "packed"])


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(values as far as they travel, how often the block holds each)."""
    n_again = int.from_bytes(packed[-4:], "little")
    n = (len(packed) - 4 - 8 * n_again) // 5
    values = np.frombuffer(packed, np.uint32, n).astype(np.uint64) << np.uint64(8) | np.frombuffer(packed, np.uint8, n, 4 * n)
    times = np.ones(n, np.int64)
    again = np.frombuffer(packed, np.uint8, 8 * n_again, 5 * n).tobytes()
    times[np.frombuffer(again, np.uint32, n_again)] = np.frombuffer(again, np.uint32, n_again, 4 * n_again)
    return values, times


def _answer(table: pa.Table) -> pa.Table:
    found = [_unpacked(p) for p in table["packed"].to_pylist()]
    values, times = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(values)
    ranked = values[order]
    begin = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    out = np.empty(len(values), np.uint8)
    out[order] = np.repeat(_code(np.add.reduceat(times[order], begin)), np.diff(np.append(begin, len(ranked))))
    edges = np.cumsum([0, *[len(v) for v, _ in found]]).tolist()
    return pa.table([table["block"], table["part"], pa.array([out[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary())], names=["block", "part", "counts"])


def _code(count: np.ndarray) -> np.ndarray:
    """Counts up to 127 as they are, larger ones in steps of an eighth of their power of two: rises with the count."""
    big = np.maximum(count, 128)
    power = np.floor(np.log2(big)).astype(np.int64)
    return np.where(count < 128, count, np.minimum(255, 128 + (power - 7) * 8 + ((big >> (power - 3)) & 7))).astype(np.uint8)


def code_of(count: int) -> int:
    """The byte that stands for a count."""
    return int(_code(np.array([count]))[0])


def answers(asked: DataFrame) -> DataFrame:
    """One answer for each request."""
    return asked.groupBy("part").applyInArrow(_answer, ANSWER)


def read_answers(values: np.ndarray, n_parts: int, table: pa.Table) -> np.ndarray:
    """The byte of each value, from the answers to ``requests(block, values, n_parts)``."""
    values, place = np.unique(values, return_inverse=True)
    order, present, _ = order_by_part(values, n_parts)
    got = dict(zip(table["part"].to_pylist(), table["counts"].to_pylist(), strict=True))
    out = np.empty(len(values), np.uint8)
    if len(values):
        out[order] = np.frombuffer(b"".join([got[p] for p in present.tolist()]), np.uint8)
    return out[place]
