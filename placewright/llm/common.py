"""Shared pieces of the training-data operators.

* ``documents(spark, sf_dir)`` reads a table; paths go to Spark's readers only.
* ``materialize`` cuts lineage by writing a table into the shared checkpoint folder.
* ``word_table`` is the vectorised tokenizer: words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes.
* ``map_arrow`` wraps ``mapInArrow`` with whole-column access.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of bytes other than these.
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """One table of a data folder, optionally pruned to some columns."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where it is unset and the master is local, a temporary folder stands in (tests);
    on a cluster a missing setting is an error, because a machine-local folder would lose data.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = getattr(spark.sparkContext, "_placewright_dir", None)
    if own is None:
        own = "file://" + tempfile.mkdtemp(prefix="placewright-")
        spark.sparkContext._placewright_dir = own
    return own


class Tables:
    """Helper tables of one piece of work; whoever owns the work drops them once its results are written."""

    def __init__(self):
        self.paths: list[str] = []
        _all.append(self)

    def drop(self, spark: SparkSession) -> None:
        jvm = spark.sparkContext._jvm
        while self.paths:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        if self in _all[1:]:
            _all.remove(self)


_all: list[Tables] = []
#: Tables without another owner live as long as the session.
_owner: ContextVar[Tables] = ContextVar("owner", default=Tables())  # noqa: B039


@contextlib.contextmanager
def owned() -> Iterator[Tables]:
    """Tables written inside belong to the value given, not to the session."""
    tables = Tables()
    token = _owner.set(tables)
    try:
        yield tables
    finally:
        _owner.reset(token)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: a reliable cut of the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _owner.get().paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores ahead until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Column that ``numbered`` adds.
ROW = "__row"


def numbered(df: DataFrame, tag: str, name: str = ROW) -> DataFrame:
    """``df`` written with a number for each row: a key where ids are null or repeated.

    It is written, so every reader sees the same numbers; they depend on the partitions and must not decide a result.
    """
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), tag)


#: Rows that one call of a batch function gets.
BATCH_ROWS = 1000


def trim() -> None:
    """Give memory that a worker no longer needs back to the machine; workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def _release_at_exit() -> None:
    with contextlib.suppress(Exception):  # the session may be gone by then
        spark = SparkSession.getActiveSession()
        for tables in list(_all) if spark is not None else []:
            tables.drop(spark)


atexit.register(_release_at_exit)


def map_arrow(df: DataFrame, work: Callable[[pa.Table], Iterator[pa.RecordBatch | pa.Table] | pa.Table], schema: str) -> DataFrame:
    """``mapInArrow`` over batches; ``work`` gets one table for each batch."""

    def run(batches):
        trim()
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_ROWS):
                made = work(pa.Table.from_batches([batch.slice(begin, BATCH_ROWS)]))
                for part in [made] if isinstance(made, pa.Table) else made:
                    yield from part.to_batches()
        trim()

    return df.mapInArrow(run, schema)


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """The values of a binary or string column as bytes."""
    return column.cast(pa.binary()).to_pylist() if not pa.types.is_binary(column.type) else column.to_pylist()


def text_bytes(name: str = "text"):
    """A text column as bytes; null stays null."""
    return F.col(name).cast("string").cast("binary")


def n_words(column):
    """Number of words of a text column, 0 for null."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_RATIO = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit integers (splitmix64)."""
    x = x + _RATIO
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


#: A fixed pseudorandom 64-bit value for each byte, and an odd base with its inverse modulo 2**64.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_BASE = 0x9DDFEA08EB382D69
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n at least."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        both = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[0] = have = tuple(both)
    return have


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``, the same wherever the bytes stand."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix64(h ^ (ends - starts).astype(np.uint64))


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True


def word_table(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and the end): words of several texts at once."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = _IS_SPACE[data]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
    starts, ends = edge[0::2], edge[1::2]
    ends_of = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    first = np.concatenate(([0], np.searchsorted(starts, ends_of)))
    return span_hashes(data, starts, ends), first


def chunks(texts: list[bytes], limit: int) -> Iterator[range]:
    """Ranges of consecutive texts of about ``limit`` bytes together, one text at least."""
    start = total = 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > limit:
            yield range(start, i)
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield range(start, len(texts))
