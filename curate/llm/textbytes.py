"""Vectorised work on UTF-8 bytes of Arrow string columns: words, hashes, digests.

Texts of an Arrow batch lie end to end in one buffer.  The helpers cut the batch
into chunks of whole documents, so that the arrays built for one chunk stay small
whatever the batch holds (a single text longer than the limit is a chunk of its own).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.session import shared_dir

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing)
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (splitmix64's finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, b in enumerate((_BASE, _BASE_INV)):
            p = np.full(size, b, U64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash; see ``span_hash``."""
    p, _ = powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, U64)
    np.cumsum(_BYTE[buf] * p[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of buf[start:end], equal for equal bytes wherever they stand."""
    _, inv = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(U64))


def buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"") if column.null_count else column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, at - at[0]


def chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``limit`` bytes each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(buf: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word; words never cross documents."""
    if not len(buf):
        return (np.zeros(0, np.int64),) * 3
    inside = kind[buf]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(buf)]
    before[first] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[first[first > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def lists(values, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row."""
    at = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), values if isinstance(values, pa.Array) else pa.array(values, kind))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Queries made and run inside have this setting of the session."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def no_shuffle_left(spark: SparkSession):
    """Queries made and run inside give their shuffle files back when they end, not when the driver next collects garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession, size: int):
    """Queries made and run inside hand their Python workers batches of about ``size`` bytes, however long their rows are."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the cluster's shared folder and read again:
    later steps neither recompute it nor depend on a lost executor's blocks."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    with no_shuffle_left(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc32_mod(column: str, n: int):
    """crc32 of the id's decimal text, modulo n (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def by_chunk(fn: Callable, limit: int) -> Callable:
    """A ``mapInArrow`` function that calls ``fn(batch, buf, offsets)`` on slices of whole
    documents; the batch's ``text`` column gives the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = buffer(batch.column("text"))
            for i, j in chunks(offsets, limit):
                at = offsets[i:j + 1]
                yield from fn(batch.slice(i, j - i), buf[at[0]:at[-1]], at - at[0])

    return run
