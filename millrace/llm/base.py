"""Shared pieces of the corpus operators: scratch tables, Arrow text blocks, token hashing.

Nothing here keeps state on an executor; every kernel is a pure function of an
Arrow batch, so a lost executor only costs the re-run of its tasks.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text a numpy kernel works on at a time; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20

_MUL1, _MUL2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---------------------------------------------------------------- scratch tables

#: The folder of a local session without spark.checkpoint.dir.
_OWN_ROOT: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a temporary one of a local session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _OWN_ROOT:
            _OWN_ROOT.append(tempfile.mkdtemp(prefix="millrace-"))
        root = _OWN_ROOT[0]
    return root.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and the copy outlives any executor."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tables/{uuid.uuid4().hex}-{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_scratch(spark: SparkSession) -> None:
    """Delete all written scratch tables; results that were not yet computed need them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/tables")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def crc_mod(col: str, n: int):
    """crc32 of the value as text, mod n; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def crc_text(value) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode())


# ---------------------------------------------------------------- Arrow text


def utf8_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without copying; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    kind = col.type
    if kind not in (pa.string(), pa.binary(), pa.large_string(), pa.large_binary()):
        col, kind = col.cast(pa.large_binary()), pa.large_binary()
    if col.null_count:
        col = pc.fill_null(col, "" if kind in (pa.string(), pa.large_string()) else b"")
    width = np.int64 if kind in (pa.large_string(), pa.large_binary()) else np.int32
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    offsets = np.frombuffer(bufs[1], width, n + 1, col.offset * np.dtype(width).itemsize).astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most that many bytes, or of one row."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


# ---------------------------------------------------------------- hashing


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= _MUL1
    x ^= x >> np.uint64(33)
    x *= _MUL2
    x ^= x >> np.uint64(33)
    return x


#: Bytes up to which a string is hashed by 8-byte lanes; a longer one is digested on its own.
LANE_BYTES = 512
_LANE = np.uint64(_BASE)
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings data[start:end].

    Lanes of eight bytes are folded in one after the other, with a non-linear mix
    between them, so no pattern of a text makes different strings meet, as it does
    under a polynomial modulo 2^64.  Strings above LANE_BYTES are digested.
    """
    size = (end - start).astype(np.int64)
    out = mix64(size.astype(np.uint64) * _LANE)
    if not len(size):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    long = np.flatnonzero(size > LANE_BYTES)
    for k in long.tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[start[k] : end[k]], digest_size=8).digest(), "little")
    live, at, left = np.arange(len(size)), start, size
    if len(long):
        keep = size <= LANE_BYTES
        live, at, left = live[keep], at[keep], left[keep]
    going = left > 0
    while going.any():
        if not going.all():
            live, at, left = live[going], at[going], left[going]
        out[live] = mix64((out[live] + (lanes[at] & _TAIL[np.minimum(left, 8)])) * _LANE)
        at, left = at + 8, left - 8
        going = left > 0
    return out


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a block of documents: place, document and 64-bit hash of each."""

    __slots__ = ("start", "end", "doc", "first", "hash")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True, hashed: bool = True):
        inside = ~_SPACE[data]
        n = len(data)
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        begin[cuts] = inside[cuts]
        self.start = np.flatnonzero(begin)
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[cuts - 1] = inside[cuts - 1]
        self.end = np.flatnonzero(last) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        #: index of each document's first word
        self.first = np.searchsorted(self.start, offsets)
        self.hash = span_hashes(_LOWER[data] if lower else data, self.start, self.end) if hashed else None


def ngram_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document index of each run of n words inside a document; first: index of each document's first word, and the end."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    total = int(counts.sum())
    doc = np.repeat(np.arange(len(counts)), counts)
    if not total:
        return np.zeros(0, np.uint64), doc
    heads = np.cumsum(counts) - counts
    at = np.arange(total) - np.repeat(heads, counts) + np.repeat(first[:-1], counts)
    out = np.zeros(total, np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[at + k]
    return mix64(out + np.uint64(n)), doc
