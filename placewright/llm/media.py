"""Progressive JPEG columns (operator 3).

Reading: the scans of a progressive file (spectral selection and successive approximation) are accumulated into
arrays of quantised coefficients; numpy transforms them back, chroma is upsampled by replication and a
full-resolution RGB tensor results.  Huffman decoding runs over all restart intervals of all images of a batch at
once: every interval is a lane with its own bit position, and a step decodes one symbol in each lane.  The inverse
transform multiplies whole numbers in floats below 2**53, so it is exact and the same for equal images.

Writing: ``store_bytes`` keeps a payload losslessly in the format's own unit, the quantised coefficient.  64 bytes
are the 64 coefficients of one block in zigzag order, blocks fill the planes Y (2x2), Cb and Cr one after another,
and the scans split each value into its upper bits and a refined last bit.

``media_table`` has the stored file, the payload read back from it and the decoded tensor as columns; the query's
digests are made of these columns, and its feature of the tensor column.

Defined results: a null or empty payload is one block of zeros; payloads of any length work (blocks go through in
batches, one image holds up to 6 GB); equal payloads give equal files; repeated rows are stored each for itself;
null ids stay null; an empty table gives no rows; other columns are not read.  ``coefficients`` raises ValueError for
files that aren't progressive Huffman JPEGs, whose heads are broken, or promise more blocks than their bytes have
bits for; the column operator gives nulls for them and for null files, and the other files of a batch are not hurt.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placewright.llm.common import chunks, map_arrow, read, text_bytes

#: Blocks in a restart interval of a scan of one plane, MCUs in one of a scan of all planes.
BLOCKS, MCUS = 8, 8
#: Payload bytes that go through one batch together.
BATCH_BYTES = 2 << 20
#: Spectral bands of each plane; all are sent without their last bit first, then refined.
BANDS = (((1, 5), (6, 63)), ((1, 63),), ((1, 63),))


def _zigzag() -> np.ndarray:
    """Natural index (row * 8 + column) of each zigzag position."""
    cells = [(r, c) for r in range(8) for c in range(8)]
    return np.array([r * 8 + c for r, c in sorted(cells, key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))])


ZIGZAG = _zigzag()


class Huffman:
    """A table from code lengths: ``code`` and ``length`` by symbol, ``lookup`` by the next 16 bits."""

    def __init__(self, counts: list[int], symbols: list[int]):
        self.counts, self.symbols = counts, symbols
        self.code, self.length = np.zeros(256, np.int64), np.zeros(256, np.int64)
        self.lookup = np.zeros(1 << 16, np.int64)  # length << 8 | symbol, 0: no code
        code = at = 0
        for length, n in enumerate(counts, 1):
            for symbol in symbols[at : at + n]:
                self.code[symbol], self.length[symbol] = code, length
                self.lookup[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
                code += 1
            at += n
            code <<= 1

    @classmethod
    def of(cls, lengths: dict[int, int]) -> Huffman:
        order = sorted(lengths, key=lambda s: (lengths[s], s))
        return cls([sum(lengths[s] == n for s in order) for n in range(1, 17)], order)

    def segment(self, place: int) -> bytes:
        return struct.pack(">HHB16B", 0xFFC4, 19 + len(self.symbols), place, *self.counts) + bytes(self.symbols)


#: Tables of the writer, suited to text: its bytes without the last bit have 5 to 7 bits and are seldom zero.
DC = Huffman.of({s: 4 for s in range(10)})
AC = Huffman.of({r << 4 | s: {(0, 6): 1, (0, 5): 2, (0, 7): 3, (0, 3): 5}.get((r, s), 12 if r else 8) for r in range(16) for s in range(1, 8)} | {0: 5, 0xF0: 8})
REFINE = Huffman.of({0: 1, 0xF0: 6} | {r << 4 | 1: 6 for r in range(16)})


def bit_size(x: np.ndarray) -> np.ndarray:
    """Number of bits of whole numbers below 2**15."""
    return _SIZE[x]


_SIZE = np.array([int(i).bit_length() for i in range(1 << 12)], dtype=np.int64)


# -- writing --------------------------------------------------------------------------------------------


def _grid(n_blocks: int) -> tuple[int, int]:
    """MCUs across and down that hold the blocks, six to an MCU."""
    mcus = -(-n_blocks // 6)
    across = max(min(mcus, 64), -(-mcus // 4095))
    return across, -(-mcus // across)


@lru_cache(64)
def _mcu_order(across: int, down: int) -> np.ndarray:
    """Block number of each place in the order of a scan of all planes."""
    y, x = np.divmod(np.arange(across * down), across)
    first = 4 * across * down
    return np.stack([(2 * y + v) * 2 * across + 2 * x + h for v in (0, 1) for h in (0, 1)] + [first + np.arange(across * down), first + across * down + np.arange(across * down)], axis=1).ravel()


def _pack(value: np.ndarray, bits: np.ndarray, interval: np.ndarray, n: int) -> list[bytes]:
    """Codes of at most 25 bits each as bytes, for each interval; stuffed, filled with ones."""
    size = np.bincount(interval, bits, n).astype(np.int64)
    n_bytes = (size + 7) >> 3
    first = np.cumsum(n_bytes) - n_bytes
    ends = np.cumsum(bits)
    at = ends - bits + (first * 8 - (np.cumsum(size) - size))[interval]
    word = value << (32 - bits - (at & 7))
    byte = at >> 3
    total = int(n_bytes.sum())
    out = np.zeros(total + 4)
    for k in range(4):
        out[k:] += np.bincount(byte, (word >> (24 - 8 * k)) & 255, total + 4 - k)[: total + 4 - k]
    return _cut(out[:total].astype(np.uint8), n_bytes, size)


def _cut(out: np.ndarray, n_bytes: np.ndarray, size: np.ndarray) -> list[bytes]:
    ends = np.cumsum(n_bytes)
    some = n_bytes > 0
    out[ends[some] - 1] |= ((1 << (-size[some] & 7)) - 1).astype(np.uint8)
    full = np.flatnonzero(out == 255)
    ends = ends + np.searchsorted(full, ends)
    data = np.insert(out, full + 1, 0).tobytes() if len(full) else out.tobytes()
    edges = [0, *ends.tolist()]
    return [data[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def _first_ac(x: np.ndarray, interval: np.ndarray, n: int) -> list[bytes]:
    """Intervals of a first scan of a band; x: blocks x coefficients, none negative."""
    width = x.shape[1]
    mask = np.empty((len(x), width + 1), dtype=bool)
    np.greater(x, 0, out=mask[:, :width])
    mask[:, width] = ~mask[:, width - 1]
    at = np.flatnonzero(mask)
    block, k = np.divmod(at, width + 1)
    before = np.concatenate(([-1], k[:-1]))
    before[np.concatenate(([True], block[1:] != block[:-1]))] = -1
    end = k == width
    value = np.where(end, 0, x[block, np.minimum(k, width - 1)]).astype(np.int64)
    run = np.where(end, 0, k - before - 1)
    size = bit_size(value)
    symbol = (run & 15) << 4 | size
    bits = AC.length[symbol] + size
    code = AC.code[symbol] << size | value
    zeros = run >> 4
    if zeros.any():
        start = np.cumsum(zeros + 1) - 1
        longer = np.full(int((zeros + 1).sum()), AC.code[0xF0])
        longer_bits = np.full(len(longer), AC.length[0xF0])
        longer[start], longer_bits[start] = code, bits
        block, code, bits = np.repeat(block, zeros + 1), longer, longer_bits
    return _pack(code, bits, interval[block], n)


def _refine_ac(x: np.ndarray, interval: np.ndarray, n: int) -> list[bytes]:
    """Intervals of the scan that sends the last bit of a band."""
    known = x > 1
    fresh = (x == 1).any(1)
    n_known = known.sum(1)
    size = n_known + REFINE.length[0]
    odd = {int(b): _refine_block(x[b]) for b in np.flatnonzero(fresh)}
    for b, bits in odd.items():
        size[b] = len(bits)
    total = np.bincount(interval, size, n).astype(np.int64)
    n_bytes = (total + 7) >> 3
    first = (np.cumsum(n_bytes) - n_bytes) * 8 - (np.cumsum(total) - total)
    begin = np.cumsum(size) - size + first[interval]
    bits = np.zeros(int(n_bytes.sum()) * 8, dtype=np.uint8)
    plain = np.flatnonzero(~fresh)  # code 0 of one bit for the end of the block, then its corrections
    if len(plain):
        mask = known[plain]
        counts = n_known[plain]
        where = np.repeat(begin[plain] + REFINE.length[0] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        bits[where] = (x[plain] & 1)[mask]
    for b, own in odd.items():
        bits[begin[b] : begin[b] + len(own)] = own
    return _cut(np.packbits(bits), n_bytes, total)


def _refine_block(x: np.ndarray) -> list[int]:
    """Bits of a block in which coefficients first show at their last bit."""
    out, run, held = [], 0, []
    last = int(np.flatnonzero(x == 1)[-1])

    def put(symbol: int) -> None:
        n = int(REFINE.length[symbol])
        out.extend(int(REFINE.code[symbol]) >> (n - 1 - i) & 1 for i in range(n))

    for k, v in enumerate(x.tolist()):
        if v == 0:
            run += 1
            if run == 16 and k < last:
                put(0xF0)
                out.extend(held)
                run, held = 0, []
        elif v == 1:
            put(run << 4 | 1)
            out.append(1)
            out.extend(held)
            run, held = 0, []
        else:
            held.append(v & 1)
    if run or held:
        put(0)
        out.extend(held)
    return out


def _markers(parts: list[bytes]) -> bytes:
    return b"".join(p if i == 0 else b"\xff" + bytes([0xD0 + (i - 1) % 8]) + p for i, p in enumerate(parts))


def store_bytes(payloads: list[bytes]) -> list[bytes]:
    """Progressive files that hold the payloads, each of a positive multiple of 64 bytes."""
    blocks = [np.frombuffer(p, np.uint8).reshape(-1, 64) for p in payloads]
    grids = [_grid(len(b)) for b in blocks]
    sizes = [6 * a * d for a, d in grids]
    first = np.concatenate(([0], np.cumsum(sizes)))
    x = np.zeros((int(first[-1]), 64), np.uint8)
    for b, at in zip(blocks, first.tolist(), strict=False):
        x[at : at + len(b)] = b
    scans: list[list[bytes]] = [[] for _ in payloads]

    def intervals(counts: list[int], each: int) -> tuple[np.ndarray, list[int]]:
        per = [-(-c // each) for c in counts]
        begin = np.concatenate(([0], np.cumsum(per)))
        return np.concatenate([b + np.arange(c) // each for b, c in zip(begin.tolist(), counts, strict=False)]), per

    def add(header: bytes, restart: int, parts: list[bytes], per: list[int]) -> None:
        at = 0
        for scan, n in zip(scans, per, strict=True):
            scan.append(struct.pack(">HHH", 0xFFDD, 4, restart) + header + _markers(parts[at : at + n]))
            at += n

    order = np.concatenate([f + _mcu_order(*g) for f, g in zip(first.tolist(), grids, strict=False)])
    dc_interval, dc_per = intervals(sizes, 6 * MCUS)
    dc = x[order, 0].astype(np.int64)
    planes = []
    for c in range(3):
        counts = [s // 6 * (4 if c == 0 else 1) for s in sizes]
        offsets = [0 if c == 0 else s // 6 * (3 + c) for s in sizes]
        planes.append((np.concatenate([f + o + np.arange(n) for f, o, n in zip(first.tolist(), offsets, counts, strict=False)]), *intervals(counts, BLOCKS)))

    def head(components: list[int], band: tuple[int, int], high: int, low: int, table: int) -> bytes:
        body = b"".join(bytes([c + 1, table if band[0] else 0]) for c in components)
        return struct.pack(">HHB", 0xFFDA, 6 + len(body), len(components)) + body + bytes([*band, high << 4 | low])

    high = dc >> 1
    before = np.zeros_like(high)
    place = np.arange(len(high)) % 6  # the previous block of the plane, in the interval
    before[1:] = high[:-1]
    before[6:] = np.where(np.isin(place[6:], (1, 2, 3)), before[6:], np.where(place[6:] == 0, high[3:-3], high[:-6]))
    within = _within(dc_interval)
    before[(within < 6) & ~np.isin(place, (1, 2, 3))] = 0
    diff = high - before
    size = bit_size(np.abs(diff))
    code = DC.code[size] << size | np.where(diff < 0, diff + (1 << size) - 1, diff)
    add(head([0, 1, 2], (0, 0), 0, 1, 0), MCUS, _pack(code, DC.length[size] + size, dc_interval, sum(dc_per)), dc_per)
    for c, (where, interval, per) in enumerate(planes):
        for band in BANDS[c]:
            add(head([c], band, 0, 1, 0), BLOCKS, _first_ac(x[where, band[0] : band[1] + 1] >> 1, interval, sum(per)), per)
    add(head([0, 1, 2], (0, 0), 1, 0, 0), MCUS, _pack(dc & 1, np.ones_like(dc), dc_interval, sum(dc_per)), dc_per)
    for c, (where, interval, per) in enumerate(planes):
        for band in BANDS[c]:
            add(head([c], band, 1, 0, 1), BLOCKS, _refine_ac(x[where, band[0] : band[1] + 1], interval, sum(per)), per)
    tables = DC.segment(0x00) + AC.segment(0x10) + REFINE.segment(0x11)
    quant = struct.pack(">HHB", 0xFFDB, 67, 0) + bytes([1]) * 64
    out = []
    for blocks_in, (across, down), parts in zip(blocks, grids, scans, strict=True):
        frame = struct.pack(">HHBHHB", 0xFFC2, 17, 8, 16 * down, 16 * across, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
        note = b"blocks=%d" % len(blocks_in)
        out.append(b"\xff\xd8" + struct.pack(">HH", 0xFFFE, 2 + len(note)) + note + quant + frame + tables + b"".join(parts) + b"\xff\xd9")
    return out


def _within(interval: np.ndarray) -> np.ndarray:
    """Place of each entry in its interval."""
    new = np.concatenate(([True], interval[1:] != interval[:-1]))
    start = np.flatnonzero(new)
    return np.arange(len(interval)) - np.repeat(start, np.diff(np.append(start, len(interval))))


# -- reading --------------------------------------------------------------------------------------------


@dataclass
class Plane:
    h: int
    v: int
    table: int
    across: int = 0  # blocks with the padding to whole MCUs
    down: int = 0
    own_across: int = 0  # without
    own_down: int = 0
    first: int = 0  # of its blocks among all blocks of the batch


@dataclass
class Image:
    width: int = 0
    height: int = 0
    planes: dict[int, Plane] = field(default_factory=dict)
    quant: dict[int, np.ndarray] = field(default_factory=dict)
    note: bytes = b""
    scans: list[tuple] = field(default_factory=list)  # (planes, Ss, Se, Ah, Al, tables, restart interval, parts)
    mcus: tuple[int, int] = (0, 0)


def parse(data: bytes) -> Image:
    """Headers of a progressive file and the entropy-coded intervals of its scans."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    image, tables, restart, at = Image(), {}, 0, 2
    raw = np.frombuffer(data, np.uint8)
    marks = np.flatnonzero((raw[:-1] == 255) & (raw[1:] != 0) & (raw[1:] != 255))
    kinds = raw[marks + 1]
    real = marks[(kinds < 0xD0) | (kinds > 0xD7)]
    while at + 4 <= len(data):
        if data[at] != 255:
            raise ValueError("a marker is missing")
        kind = data[at + 1]
        if kind == 0xFF:
            at += 1
            continue
        if kind == 0xD9:
            break
        (size,) = struct.unpack_from(">H", data, at + 2)
        body, end = data[at + 4 : at + 2 + size], at + 2 + size
        if kind == 0xC2:
            depth, image.height, image.width, n = struct.unpack_from(">BHHB", body)
            if depth != 8:
                raise ValueError("samples must have 8 bits")
            for k in range(n):
                c, hv, q = body[6 + 3 * k : 9 + 3 * k]
                image.planes[c] = Plane(hv >> 4, hv & 15, q)
            if not image.planes or not image.width or not image.height or not all(1 <= x <= 4 for p in image.planes.values() for x in (p.h, p.v)):
                raise ValueError("a frame without planes, samples or sampling factors")
            h, v = max(p.h for p in image.planes.values()), max(p.v for p in image.planes.values())
            if any(h % p.h or v % p.v for p in image.planes.values()):
                raise ValueError("sampling factors that don't divide each other")
            image.mcus = -(-image.width // (8 * h)), -(-image.height // (8 * v))
            for p in image.planes.values():
                p.across, p.down = image.mcus[0] * p.h, image.mcus[1] * p.v
                p.own_across, p.own_down = -(-(-(-image.width * p.h // h)) // 8), -(-(-(-image.height * p.v // v)) // 8)
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a progressive Huffman frame")
        elif kind == 0xC4:
            while body:
                counts = list(body[1:17])
                n = sum(counts)
                tables[body[0]] = _table(bytes(body[1 : 17 + n]))
                body = body[17 + n :]
        elif kind == 0xDB:
            while body:
                wide = body[0] >> 4
                n = 128 if wide else 64
                image.quant[body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[1 + n :]
        elif kind == 0xDD:
            (restart,) = struct.unpack(">H", body[:2])
        elif kind == 0xFE:
            image.note = bytes(body)
        elif kind == 0xDA:
            n = body[0]
            chosen = [(body[1 + 2 * k], body[2 + 2 * k]) for k in range(n)]
            low, high, approx = body[1 + 2 * n : 4 + 2 * n]
            following = np.searchsorted(real, end)
            stop = int(real[following]) if following < len(real) else len(data)
            a, b = np.searchsorted(marks, [end, stop])
            edges = marks[a:b].tolist()
            starts, stops = [end, *[e + 2 for e in edges]], [*edges, stop]
            parts = [data[s:e].replace(b"\xff\x00", b"\xff") for s, e in zip(starts, stops, strict=True)]
            needed = [tables.get(t >> 4 if low == 0 else (t & 15) | 16) for _, t in chosen]
            image.scans.append(([c for c, _ in chosen], low, high, approx >> 4, approx & 15, needed, restart, parts))
            end = stop
        at = end
    if not image.planes:
        raise ValueError("no frame")
    if sum(p.across * p.down for p in image.planes.values()) > 8 * len(data):  # the first scan has a bit for each block
        raise ValueError("more blocks than bits")
    return image


_tables: dict[bytes, Huffman] = {}


def _table(spec: bytes) -> Huffman:
    if spec not in _tables:
        if len(_tables) > 64:
            _tables.clear()
        _tables[spec] = Huffman(list(spec[:16]), list(spec[16:]))
    return _tables[spec]


def _scan_order(image: Image, components: list[int]) -> np.ndarray:
    """Block numbers (within the batch) in the order of a scan."""
    planes = [image.planes[c] for c in components]
    if len(planes) == 1:
        p = planes[0]
        return p.first + _plane_order(p.own_across, p.own_down, p.across)
    return np.stack([p.first + x for p in planes for x in _unit_order(*image.mcus, p.h, p.v)], axis=1).ravel()


@lru_cache(64)
def _plane_order(own_across: int, own_down: int, across: int) -> np.ndarray:
    y, x = np.divmod(np.arange(own_across * own_down), own_across)
    return y * across + x


@lru_cache(64)
def _unit_order(mcus_across: int, mcus_down: int, h: int, v: int) -> list[np.ndarray]:
    """For each block of an MCU: its number in the plane, MCU by MCU."""
    y, x = np.divmod(np.arange(mcus_across * mcus_down), mcus_across)
    return [(y * v + j) * mcus_across * h + x * h + i for j in range(v) for i in range(h)]


class Lanes:
    """Bits of many intervals: a lane for each, with its own position."""

    def __init__(self, parts: list[bytes]):
        data = np.frombuffer(b"".join([p + b"\0\0\0" for p in parts]) + bytes(16), np.uint8)
        wide = data.astype(np.uint64)
        n = len(data) - 8
        self.word = np.zeros(n, np.uint64)  # the next 64 bits from each byte
        for k in range(8):
            self.word |= wide[k : k + n] << np.uint64(56 - 8 * k)
        lengths = np.fromiter((len(p) + 3 for p in parts), dtype=np.int64, count=len(parts))
        self.at = (np.cumsum(lengths) - lengths) * 8
        self.end = len(data) * 8 - 130

    def peek(self, at: np.ndarray) -> np.ndarray:
        """64 bits, at least 57 of them valid, from each position."""
        at = np.minimum(at, self.end)
        return self.word[at >> 3] << (at & 7).astype(np.uint64)


def _signed(bits: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(bits < (1 << np.maximum(size - 1, 0)), bits - (1 << size) + 1, bits) * (size > 0)


def _dc(coef: np.ndarray, lanes: Lanes, order: list[np.ndarray], kinds: list[np.ndarray], tables: list[Huffman], high: int, low: int) -> None:
    """A DC scan; order: block numbers of each lane, kinds: which plane of the scan each belongs to."""
    at = lanes.at.copy()
    counts = np.array([len(o) for o in order])
    blocks = np.concatenate(order)
    planes = np.concatenate(kinds)
    first = np.cumsum(counts) - counts
    before = np.zeros((len(order), len(tables)), np.int64)
    lookup = np.stack([t.lookup for t in tables]) if not high else None
    for step in range(int(counts.max(initial=0))):
        live = np.flatnonzero(counts > step)
        b, word = blocks[first[live] + step], lanes.peek(at[live])
        if high:
            coef[b, 0] |= (word >> np.uint64(63)).astype(np.int16) << low
            at[live] += 1
            continue
        plane = planes[first[live] + step]
        found = lookup[plane, (word >> np.uint64(48)).astype(np.int64)]
        length, size = found >> 8, found & 255
        extra = ((word << length.astype(np.uint64)) >> np.uint64(48)).astype(np.int64) >> (16 - size)
        before[live, plane] += _signed(extra, size)
        coef[b, 0] = (before[live, plane] << low).astype(np.int16)
        at[live] += length + size


def _ac_first(coef: np.ndarray, lanes: Lanes, order: list[np.ndarray], table: Huffman, low_k: int, high_k: int, low: int) -> None:
    counts = np.array([len(o) for o in order])
    blocks = np.append(np.concatenate(order), len(coef) - 1)  # the last block is a bin
    lookup, flat = table.lookup, coef.reshape(-1)
    block = np.cumsum(counts) - counts
    stop, at, k = block + counts, lanes.at.copy(), np.full(len(order), low_k)
    rest = block < stop
    block, stop, at, k = block[rest], stop[rest], at[rest], k[rest]
    while len(block):
        word = lanes.peek(at)
        found = lookup[(word >> np.uint64(48)).astype(np.int64)]
        length, symbol = found >> 8, found & 255
        size, run = symbol & 15, symbol >> 4
        bits = ((word << length.astype(np.uint64)) >> np.uint64(48)).astype(np.int64)
        value = bits >> (16 - size)
        value = np.where(value < (1 << size) >> 1, value - (1 << size) + 1, value)
        place = k + run
        none = np.flatnonzero(size == 0)
        at += length + size
        if len(none):
            ends = none[run[none] < 15]
            long_run = (1 << run[ends]) + (bits[ends] >> (16 - run[ends]))
            keep = size > 0
            ok = keep & (place <= high_k)
            flat[blocks[block[ok]] * 64 + place[ok]] = (value[ok] << low).astype(np.int16)
            k = np.where(keep, place + 1, k + 16)
            at[ends] += run[ends]
            block[ends] += long_run
            k[ends] = low_k
            if not (found > 0).all():
                raise ValueError("a code that its table doesn't have")
        else:
            flat[blocks[block] * 64 + np.minimum(place, 63)] = (value << low).astype(np.int16)
            k = place + 1
        over = k > high_k
        if over.any():
            block = block + over
            k[over] = low_k
            live = block < stop
            if not live.all():
                block, stop, at, k = block[live], stop[live], at[live], k[live]
        elif len(none):
            live = block < stop
            if not live.all():
                block, stop, at, k = block[live], stop[live], at[live], k[live]


def _ac_refine(coef: np.ndarray, lanes: Lanes, order: list[np.ndarray], table: Huffman, low_k: int, high_k: int, low: int) -> None:
    counts = np.array([len(o) for o in order])
    blocks = np.concatenate(order)
    block = np.cumsum(counts) - counts
    stop, at = block + counts, lanes.at.copy()
    k, ending = np.full(len(order), low_k), np.zeros(len(order), np.int64)
    one = 1 << low
    while True:
        live = np.flatnonzero(block < stop)
        if not len(live):
            break
        fresh = live[ending[live] == 0]
        if len(fresh):
            word = lanes.peek(at[fresh])
            found = table.lookup[(word >> np.uint64(48)).astype(np.int64)]
            if not found.all():
                raise ValueError("a code that its table doesn't have")
            length, symbol = found >> 8, found & 255
            run, size = symbol >> 4, symbol & 15
            ends = (size == 0) & (run < 15)
            e = fresh[ends]
            bits = ((word[ends] << length[ends].astype(np.uint64)) >> np.uint64(48)).astype(np.int64)
            ending[e] = (1 << run[ends]) + (bits >> (16 - run[ends]))
            at[e] += length[ends] + run[ends]
            for j in np.flatnonzero(~ends).tolist():  # rare: a coefficient shows first here, or sixteen zeros
                _refine_symbol(coef[blocks[block[fresh[j]]]], lanes, at, k, int(fresh[j]), int(length[j]), int(run[j]), int(size[j]), high_k, one)
            done = fresh[k[fresh] > high_k]
            block[done] += 1
            k[done] = low_k
        now = live[(ending[live] > 0)]
        if len(now):
            rows = blocks[block[now]]
            part = coef[rows, low_k : high_k + 1]
            known = part != 0
            if (k[now] != low_k).any():
                known &= np.arange(low_k, high_k + 1) >= k[now][:, None]
            upto = np.cumsum(known, axis=1)
            where = (at[now][:, None] + upto - 1)[known]
            bit = (lanes.word[where >> 3] >> (np.uint64(63) - (where & 7).astype(np.uint64))).astype(np.int64) & 1
            add = np.zeros_like(part)
            add[known] = bit * one
            coef[rows, low_k : high_k + 1] = np.where(part < 0, part - add, part + add)
            at[now] += upto[:, -1]
            block[now] += 1
            ending[now] -= 1
            k[now] = low_k


def _refine_symbol(row: np.ndarray, lanes: Lanes, at: np.ndarray, k: np.ndarray, lane: int, length: int, run: int, size: int, high_k: int, one: int) -> None:
    """One symbol of a refining scan that isn't the end of a band; ``row`` is a copy's view written in place."""

    def bit() -> int:
        p = int(at[lane])
        at[lane] += 1
        return int(lanes.word[p >> 3]) >> (63 - (p & 7)) & 1

    at[lane] += length
    new = 0
    if size:
        new = one if bit() else -one
    j = int(k[lane])
    while j <= high_k:
        if row[j]:
            if bit():
                row[j] += one if row[j] > 0 else -one
        elif run == 0:
            if size:
                row[j] = new
            j += 1
            break
        else:
            run -= 1
        j += 1
    k[lane] = j


def coefficients(files: list[bytes]) -> tuple[list[Image], np.ndarray]:
    """Images, and the coefficients of all their blocks (zigzag order, planes one after another)."""
    images = [parse(f) for f in files]
    n = 0
    for image in images:
        for p in image.planes.values():
            p.first = n
            n += p.across * p.down
    coef = np.zeros((n + 1, 64), np.int16)
    work: dict[tuple, list] = {}
    for image in images:
        for number, (comps, low_k, high_k, high, low, tables, restart, parts) in enumerate(image.scans):
            key = number, len(comps), low_k, high_k, high, low, tuple(map(id, tables))
            work.setdefault(key, []).append((image, comps, restart, parts, tables))
    for (_, n_comps, low_k, high_k, high, low, _), scans in sorted(work.items(), key=lambda x: x[0][0]):
        parts, order, kinds = [], [], []
        for image, comps, restart, own, _ in scans:
            blocks = _scan_order(image, comps)
            per = 1 if n_comps == 1 else sum(image.planes[c].h * image.planes[c].v for c in comps)
            kind = np.zeros(1, np.int64) if n_comps == 1 else np.repeat(np.arange(n_comps), [image.planes[c].h * image.planes[c].v for c in comps])
            each = restart * per or len(blocks)
            for i, part in enumerate(own):
                piece = blocks[i * each : (i + 1) * each]
                if len(piece):
                    parts.append(part)
                    order.append(piece)
                    if not low_k:
                        kinds.append(np.resize(kind, len(piece)))
        lanes = Lanes(parts)
        tables = scans[0][4]
        if low_k == 0:
            _dc(coef, lanes, order, kinds, tables, high, low)
        elif high == 0:
            _ac_first(coef, lanes, order, tables[0], low_k, high_k, low)
        else:
            _ac_refine(coef, lanes, order, tables[0], low_k, high_k, low)
    return images, coef


def _inverse() -> np.ndarray:
    """Zigzag coefficients to samples, as whole numbers scaled by 2**24."""
    u, x = np.meshgrid(np.arange(8), np.arange(8), indexing="ij")
    a = np.round(np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, np.sqrt(0.5), 1) / 2 * (1 << 12))
    return np.einsum("vy,ux->vuyx", a, a).reshape(64, 64)[ZIGZAG]


INVERSE = _inverse()


def rgb(image: Image, coef: np.ndarray) -> np.ndarray:
    """Full-resolution tensor height x width x 3."""
    h, v = max(p.h for p in image.planes.values()), max(p.v for p in image.planes.values())
    planes = []
    for p in image.planes.values():
        blocks = coef[p.first : p.first + p.across * p.down].astype(np.float64) * image.quant.get(p.table, np.ones(64, np.int64))
        samples = np.clip(np.floor(blocks @ INVERSE / (1 << 24) + 0.5) + 128, 0, 255).astype(np.int32)
        flat = samples.reshape(p.down, p.across, 8, 8).swapaxes(1, 2).reshape(p.down * 8, p.across * 8)
        if p.h < h or p.v < v:
            flat = flat.repeat(v // p.v, axis=0).repeat(h // p.h, axis=1)
        planes.append(flat[: image.height, : image.width])
    if len(planes) < 3:
        return np.repeat(planes[0].astype(np.uint8)[:, :, None], 3, axis=2)
    y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
    out = np.stack([y + ((91881 * cr + 32768) >> 16), y - ((22554 * cb + 46802 * cr + 32768) >> 16), y + ((116130 * cb + 32768) >> 16)], axis=2)
    return np.clip(out, 0, 255).astype(np.uint8)


def stored_payload(image: Image, coef: np.ndarray) -> bytes:
    """The payload that ``store_bytes`` wrote."""
    n = int(image.note.removeprefix(b"blocks="))
    first = next(iter(image.planes.values())).first
    return coef[first : first + n].astype(np.uint8).tobytes()


# -- columns --------------------------------------------------------------------------------------------


MEDIA = T.StructType([T.StructField(n, t) for n, t in (("n_bytes", T.LongType()), ("media", T.BinaryType()), ("payload", T.BinaryType()), ("height", T.IntegerType()), ("width", T.IntegerType()), ("rgb", T.BinaryType()))])


def pad(text: bytes) -> bytes:
    return text + bytes(-len(text) % 64 or (0 if text else 64))


def media_column(df: DataFrame, id_col: str, bytes_col: str) -> DataFrame:
    """(id, media): each value of a text or binary column stored as a progressive file."""

    def work(table: pa.Table):
        data = [pad(b or b"") for b in table["b"].to_pylist()]
        for part in chunks(data, BATCH_BYTES):
            yield pa.table([table["id"].slice(part.start, len(part)), pa.array(store_bytes([data[i] for i in part]), pa.binary())], names=["id", "media"])

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), MEDIA["media"]])
    return map_arrow(df.select(F.col(id_col).alias("id"), F.col(bytes_col).cast("binary").alias("b")), work, schema).withColumnRenamed("id", id_col)


def _decoded(files: list[bytes | None]) -> Iterator[tuple[Image, np.ndarray] | None]:
    """Image and coefficients of each file, None for those that can't be read; batches are decoded together."""
    there = [i for i, f in enumerate(files) if f is not None]
    found: dict[int, tuple[Image, np.ndarray]] = {}
    done = 0
    for part in chunks([files[i] for i in there], BATCH_BYTES):
        numbers = [there[k] for k in part]
        for group in [numbers] if len(numbers) == 1 else [numbers, *[[n] for n in numbers]]:
            try:
                images, coef = coefficients([files[i] for i in group])
            except UNREADABLE:  # a bad file among them: one by one
                continue
            found |= {i: (image, coef) for i, image in zip(group, images, strict=True)}
            if group is numbers:
                break
        yield from (found.pop(i, None) for i in range(done, numbers[-1] + 1))
        done = numbers[-1] + 1
    yield from (None for _ in range(done, len(files)))


#: What reading a damaged file can raise.
UNREADABLE = (ValueError, IndexError, struct.error, AttributeError, KeyError, TypeError, ZeroDivisionError, OverflowError, MemoryError)


def tensor_column(df: DataFrame, id_col: str, media_col: str = "media") -> DataFrame:
    """(id, height, width, rgb): files decoded to full-resolution tensors; nulls for null or unreadable files."""

    def work(table: pa.Table):
        ids, files = table["id"], table["m"].to_pylist()
        for begin in range(0, len(files), 64):
            rows = [[], [], []]
            for found in _decoded(files[begin : begin + 64]):
                made = rgb(*found) if found else None
                for row, value in zip(rows, (None, None, None) if made is None else (*made.shape[:2], made.tobytes()), strict=True):
                    row.append(value)
            yield pa.table([ids.slice(begin, 64), pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.binary())], names=["id", "height", "width", "rgb"])

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), *MEDIA.fields[3:]])
    return map_arrow(df.select(F.col(id_col).alias("id"), F.col(media_col).cast("binary").alias("m")), work, schema).withColumnRenamed("id", id_col)


def media_table(df: DataFrame, id_col: str = "doc_id", bytes_col: str = "text") -> DataFrame:
    """(id, n_bytes, media, payload, height, width, rgb): values stored as files, read back, and decoded to tensors."""

    def work(table: pa.Table):
        data = [b or b"" for b in table["b"].to_pylist()]
        for part in chunks(data, BATCH_BYTES):
            files = store_bytes([pad(data[i]) for i in part])
            images, coef = coefficients(files)
            tensors = [rgb(image, coef) for image in images]
            columns = [[len(data[i]) for i in part], files, [stored_payload(image, coef) for image in images], [image.height for image in images], [image.width for image in images], [t.tobytes() for t in tensors]]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]
            made = pa.table([table["id"].slice(part.start, len(part)), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["id", *MEDIA.names])
            del files, images, coef, tensors, columns
            yield made

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), *MEDIA.fields])
    return map_arrow(df.select(F.col(id_col).alias("id"), F.col(bytes_col).cast("binary").alias("b")), work, schema).withColumnRenamed("id", id_col)


def with_features(df: DataFrame) -> DataFrame:
    """Add ``feature``, size and channel means of the tensor columns height, width and rgb, which are dropped."""
    kept = [f for f in df.schema.fields if f.name not in ("height", "width", "rgb")]

    def work(table: pa.Table) -> pa.Table:
        out = []
        for height, width, tensor in zip(table["height"].to_pylist(), table["width"].to_pylist(), table["rgb"], strict=True):
            if not tensor.is_valid:
                out.append(None)
                continue
            means = np.frombuffer(tensor.as_buffer(), np.uint8).reshape(-1, 3).sum(0, dtype=np.int64) / (width * height)
            out.append(f"{width}x{height}:" + ",".join(f"{m:.6f}" for m in means.tolist()))
        return pa.table([*[table[f.name] for f in kept], pa.array(out, pa.string())], names=[*[f.name for f in kept], "feature"])

    return map_arrow(df, work, T.StructType([*kept, T.StructField("feature", T.StringType())]))


def media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: digests of the payload read back and of the stored file, and a feature of the tensor column."""
    pruned = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    stored = media_table(pruned).select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        *MEDIA.names[3:],
    )
    return with_features(stored)


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` as a progressive JPEG."""
    return media_digests(read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op3_media": op3_media}
ORACLES: dict[str, str] = {}
