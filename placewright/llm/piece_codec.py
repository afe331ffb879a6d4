"""SentencePiece encoding and decoding with byte spans (operator 5).

``PieceCodec`` reads the model file itself for its normalizer: the compiled character map is a double-array trie over
UTF-8 bytes.  All characters of a text walk down the trie at once; from left to right the longest prefix found is
replaced, and every byte of the normalised text remembers the source byte it came from.  The model segments the
normalised text, and the edges of its pieces, which tile that text, are projected back to spans of the original UTF-8
bytes.  The default model's map is empty, so only its spaces are rewritten; the way is the same.

Defined results: a null text counts as empty (ids: only the end id; decoded: empty); bytes that aren't UTF-8 count as
U+FFFD; very long texts are encoded whole; repeated rows are encoded each for itself; an empty table gives no rows.
``encode_pieces`` keeps the other columns and replaces those named like its own; the query reads no others.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placewright.llm.common import map_arrow, read, text_bytes

META = "▁"


def default_model() -> str:
    """Path of the public 32k BPE model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes):
    """(number, value) of each field of a serialised protocol buffer message."""

    def varint(i):
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            n, i = varint(i)
            value, i = data[i : i + n], i + n
        else:
            n = 8 if kind == 1 else 4
            value, i = data[i : i + n], i + n
        yield key >> 3, value


class CharMap:
    """A compiled character map: length of the trie, its units, then zero-ended replacements."""

    def __init__(self, blob: bytes):
        self.units, self.strings = np.zeros(0, np.int64), b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
            self.strings = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(source bytes, replacement) of the longest key that starts at ``at``."""
        _, size, value = self.prefixes(np.frombuffer(text, np.uint8), np.array([at]))
        return (int(size[0]), self.replacement(int(value[0]))) if len(size) else None

    def replacement(self, value: int) -> bytes:
        return self.strings[value : self.strings.index(b"\0", value)]

    def prefixes(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, bytes, value) of the longest key at each of ``starts`` that has one; all walk the trie together."""
        if not len(self.units):
            return starts[:0], starts[:0], starts[:0]
        units = self.units
        size, value = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        who, node = np.arange(len(starts)), np.full(len(starts), self._below(units[:1])[0], np.int64)
        depth = 0
        while len(who):
            inside = starts[who] + depth < len(data)
            who, node = who[inside], node[inside]
            byte = data[starts[who] + depth].astype(np.int64)
            node = node ^ byte
            inside = node < len(units)
            who, node, byte = who[inside], node[inside], byte[inside]
            fits = units[node] & 0x800000FF == byte
            who, node = who[fits], node[fits]
            unit = units[node]
            node = node ^ self._below(unit)
            depth += 1
            ends = np.flatnonzero(unit >> 8 & 1)
            size[who[ends]], value[who[ends]] = depth, units[node[ends]] & 0x7FFFFFFF
        found = np.flatnonzero(size)
        return starts[found], size[found], value[found]

    @staticmethod
    def _below(unit: np.ndarray) -> np.ndarray:
        """The offset from a node to its children."""
        return (unit >> 10) << ((unit & 512) >> 6)


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, model_path: str | None = None, end_id: bool = True):
        import sentencepiece

        path = model_path or default_model()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = [self.model.eos_id()] if end_id else []
        blob, self.dummy, self.squeeze, self.escape = b"", True, True, True
        with open(path, "rb") as f:
            for number, value in _fields(f.read()):
                if number == 3:
                    for k, v in _fields(value):
                        if k == 2:
                            blob = v
                        elif k == 3:
                            self.dummy = bool(v)
                        elif k == 4:
                            self.squeeze = bool(v)
                        elif k == 5:
                            self.escape = bool(v)
        self.map = CharMap(blob)
        self.pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.decimal = [str(i) for i in range(len(self.pieces))]
        #: Bytes of the normalised text that a piece covers.
        self.widths = np.array([1 if self.model.is_byte(i) else len(p.encode()) for i, p in enumerate(self.pieces)], dtype=np.int64)

    # -- normalisation ---------------------------------------------------------------------------------

    def normalize(self, text: str) -> tuple[bytes, list[int]]:
        """(normalised bytes, source offset of each of them and of the end), by longest-prefix replacement."""
        made, origin = self._normal(np.frombuffer(text.encode(), np.uint8))
        return made.tobytes(), origin.tolist()

    def _mapped(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes after the map, source offset of each): from left to right the longest prefix is replaced."""
        lead = (data & 0xC0) != 0x80
        origin = np.maximum.accumulate(np.where(lead, np.arange(len(data), dtype=np.int32), 0)) if len(data) else np.zeros(0, np.int32)
        starts, sizes, values = self.map.prefixes(data, np.flatnonzero(lead))
        if not len(starts):
            return data, origin
        parts, origins, at = [], [], 0
        for begin, size, value in zip(starts.tolist(), sizes.tolist(), values.tolist(), strict=True):
            if begin >= at:  # else an earlier replacement has eaten it
                new = np.frombuffer(self.map.replacement(value), np.uint8)
                parts += [data[at:begin], new]
                origins += [origin[at:begin], np.full(len(new), begin, np.int32)]
                at = begin + size
        return np.concatenate([*parts, data[at:]]), np.concatenate([*origins, origin[at:]])

    def _normal(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        made, origin = self._mapped(data)
        end = len(data)
        if self.squeeze:  # runs of spaces become one, at the ends none
            solid = np.flatnonzero(made != 32)
            if not len(solid):
                return made[:0], np.array([end], np.int32)
            first, last = int(solid[0]), int(solid[-1]) + 1
            end = int(origin[last]) if last < len(made) else end
            made, origin = made[first:last], origin[first:last]
            keep = made != 32
            keep[1:] |= made[:-1] != 32
            made, origin = made[keep], origin[keep]
        if self.dummy and len(made):
            made, origin = np.concatenate((np.array([32], np.uint8), made)), np.concatenate((origin[:1], origin))
        if self.escape:
            times = np.where(made == 32, 3, 1)
            made, origin = np.repeat(made, times), np.repeat(origin, times)
            made.reshape(-1)[np.flatnonzero(made == 32)] = np.resize(np.frombuffer(META.encode(), np.uint8), int((made == 32).sum()))
        return made, np.append(origin, np.int32(end))

    # -- segmentation ----------------------------------------------------------------------------------

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin and end of each in the text's UTF-8 bytes)."""
        data = np.frombuffer(text.encode(), np.uint8)
        made, origin = self._normal(data)
        norm = made.tobytes().decode()
        ahead = int(self.dummy and norm[:1] == (META if self.escape else " "))
        ids = np.asarray(self.model.encode(norm[ahead:]), dtype=np.int32)
        edges = np.concatenate(([0], np.cumsum(self.widths[ids])))
        if edges[-1] == len(made):
            where = origin[edges].astype(np.int64)
            begin, end = where[:-1], where[1:]
        else:  # an unknown piece covers more or less than its name
            begin, end = self._aligned(norm, ahead, origin)
        if self.end:
            ids, begin, end = np.append(ids, np.int32(self.end[0])), np.append(begin, len(data)), np.append(end, len(data))
        return ids, begin, end

    def _aligned(self, norm: str, ahead: int, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spans by the library's own character offsets in the normalised text."""
        chars = np.asarray(self.model.encode_as_offset_mapping(norm[ahead:])["offsets"], dtype=np.int64).reshape(-1, 2) + ahead
        if len(chars):
            chars[0, 0] = 0
        width = np.fromiter((len(c.encode()) for c in norm), dtype=np.int64, count=len(norm))
        where = origin[np.concatenate(([0], np.cumsum(width)))].astype(np.int64)
        return where[chars[:, 0]], where[chars[:, 1]]

    def said(self, ids: np.ndarray) -> str:
        """The ids in decimal, one space between them."""
        return " ".join(map(self.decimal.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray | list[int]) -> str:
        return self.model.decode(ids.tolist() if isinstance(ids, np.ndarray) else ids)


_codecs: dict[tuple, PieceCodec] = {}


def codec(model_path: str | None, end_id: bool) -> PieceCodec:
    """The worker's codec, read once."""
    key = model_path, end_id
    if key not in _codecs:
        _codecs[key] = PieceCodec(model_path, end_id)
    return _codecs[key]


def _texts(table: pa.Table, name: str) -> list[str]:
    return [("" if b is None else b.decode("utf-8", "replace")) for b in table[name].to_pylist()]


def encode_pieces(docs: DataFrame, text_col: str = "text", model_path: str | None = None, end_id: bool = True) -> DataFrame:
    """Add ``piece_ids``, ``piece_begin``, ``piece_end`` (spans of the UTF-8 bytes) to every row."""
    schema = T.StructType([f for f in docs.schema.fields if f.name not in ("piece_ids", "piece_begin", "piece_end")])
    kept = [f.name for f in schema.fields]
    out = T.StructType([*schema.fields, T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("piece_begin", T.ArrayType(T.LongType())), T.StructField("piece_end", T.ArrayType(T.LongType()))])

    def work(table: pa.Table) -> pa.Table:
        c = codec(model_path, end_id)
        rows = [c.encode(t) for t in _texts(table.append_column("__b", table[text_col].cast(pa.binary())), "__b")]
        return pa.table([*[table[k] for k in kept], pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=out.names)

    return map_arrow(docs, work, out)


def decode_pieces(df: DataFrame, ids_col: str = "piece_ids", out_col: str = "decoded", model_path: str | None = None) -> DataFrame:
    """Add the decoded text of a column of ids; null ids give a null text."""

    @F.pandas_udf("string")
    def decode(ids):
        c = codec(model_path, True)
        return ids.map(lambda x: None if x is None else c.decode([int(i) for i in x]))

    return df.withColumn(out_col, decode(F.col(ids_col)))


def piece_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """Per row: number of ids, digests of ids and of the decoded text, bytes covered and checksum of the spans."""

    def work(table: pa.Table) -> pa.Table:
        c = codec(model_path, True)
        n, ids_sha, back_sha, spans = [], [], [], []
        for text in _texts(table, "text"):
            ids, begin, end = c.encode(text)
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(c.said(ids).encode()).hexdigest())
            back_sha.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            spans.append(zlib.crc32(end.tobytes(), zlib.crc32(begin.tobytes())))
        return pa.table([table["doc_id"], pa.array(n, pa.int64()), ids_sha, back_sha, pa.array(spans, pa.int64())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"])

    pruned = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    return map_arrow(pruned, work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` through the codec."""
    return piece_digests(read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op5_sentencepiece": op5_sentencepiece}
ORACLES: dict[str, str] = {}
