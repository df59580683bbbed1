"""Corpus-wide counts of hashed items without a row for each item.

Documents travel in chunks, one row each.  A chunk's distinct keys, sorted, fall
into ranges; for each range it holds keys of, it sends one packed row of keys and
own counts, and gets one packed row of corpus counts back.  A key that is
everywhere costs one entry for each chunk, so no range is hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import blocks, utf8_column

CHUNK_BYTES, RANGE_BYTES = 8 << 20, 16 << 20


def pack(x: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed."""
    return zstandard.compress(np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes(), 1)


def _planes(raw: bytes, width: int) -> np.ndarray:
    data = np.frombuffer(zstandard.decompress(raw), np.uint8)
    return data.reshape(width, len(data) // width)


def unpack(raw: bytes, dtype) -> np.ndarray:
    return np.frombuffer(np.ascontiguousarray(_planes(raw, np.dtype(dtype).itemsize).T).tobytes(), dtype)


def digests_of(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A 128-bit digest of each document, as two numbers."""
    raw = b"".join(hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True))
    return np.frombuffer(raw, "<u8").reshape(-1, 2)


def text_chunks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, digests: bool = False) -> DataFrame:
    """One row for each chunk: chunk, n_bytes, ids, offsets and the compressed texts (and a digest of each text); null texts are empty."""
    picked = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()

    def run(batches):
        k = TaskContext.get().partitionId() << 32
        for b in batches:
            data, off = utf8_column(b.column("text"))
            for lo, hi in blocks(off, chunk_bytes):
                cols = {
                    "chunk": pa.array([k], pa.int64()),
                    "n_bytes": pa.array([int(off[hi] - off[lo])], pa.int64()),
                    "ids": pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), b.column("doc_id").slice(lo, hi - lo)),
                    "offsets": pa.array([(off[lo : hi + 1] - off[lo]).tobytes()], pa.binary()),
                    "texts": pa.array([zstandard.compress(data[off[lo] : off[hi]].tobytes(), 3)], pa.binary()),
                }
                if digests:
                    cols["digests"] = pa.array([digests_of(data, off[lo : hi + 1]).tobytes()], pa.binary())
                yield pa.RecordBatch.from_pydict(cols)
                k += 1

    return picked.mapInArrow(run, f"chunk long, n_bytes long, ids array<{kind}>, offsets binary, texts binary" + ", digests binary" * digests)


def open_chunk(offsets: bytes, texts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(zstandard.decompress(texts), np.uint8), np.frombuffer(offsets, np.int64)


def cell_bounds(keys: np.ndarray, n_ranges: int) -> np.ndarray:
    """Where each range of keys begins among sorted keys, and the end."""
    return np.searchsorted(((keys >> np.uint64(32)) * np.uint64(n_ranges) >> np.uint64(32)).astype(np.int64), np.arange(n_ranges + 1))


def exchange_counts(chunks: DataFrame, keys_of: Callable[..., tuple[np.ndarray, ...]], n_ranges: int, firsts: bool = False, hot: int = 0, given: tuple[str, ...] = ("offsets", "texts")) -> DataFrame:
    """(chunk, cell, counts, hot): for each range that a chunk has keys of, their corpus counts in key order.

    keys_of gets the `given` columns of a chunk and gives its sorted distinct keys
    and its own count of each; a third array, of equal length, is a second half of
    the keys, by which equal first halves are told apart and sorted.  With `firsts`
    a count is doubled, and odd for the one chunk that holds the key first.  One row
    of each range also names its keys counted more than `hot` times, if that is not 0.
    """

    def ask(batches):
        for b in batches:
            for row in b.to_pylist():
                keys, own, *more = keys_of(*(row[c] for c in given))
                at = cell_bounds(keys, n_ranges)
                cells = np.flatnonzero(at[1:] > at[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["chunk"]] * len(cells), pa.int64()),
                        pa.array(cells, pa.int32()),
                        pa.array([pack(np.diff(keys[at[r] : at[r + 1]], prepend=np.uint64(0))) for r in cells], pa.binary()),
                        pa.array([pack(own[at[r] : at[r + 1]].astype(np.uint32)) for r in cells], pa.binary()),
                        pa.array([more[0][at[r] : at[r + 1]].tobytes() if more else None for r in cells], pa.binary()),
                    ],
                    names=["chunk", "cell", "keys", "own", "more"],
                )

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("chunk")
        keys = [np.cumsum(unpack(x, np.uint64), dtype=np.uint64) for x in part["keys"]]
        own = np.concatenate([unpack(x, np.uint32) for x in part["own"]]).astype(float)
        if part["more"].iat[0] is not None:
            both = np.stack([np.concatenate(keys), np.frombuffer(b"".join(part["more"]), np.uint64)], 1)
            every, index, inverse = np.unique(both, axis=0, return_index=True, return_inverse=True)
            every, inverse = every[:, 0], inverse.ravel()
        else:
            every, index, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        sums = np.bincount(inverse, own)
        frequent = every[sums > hot].view(np.int64) if hot else every[:0].view(np.int64)
        total, at, out = sums[inverse].astype(np.uint64), 0, []
        if firsts:
            total *= np.uint64(2)
            total[index] += np.uint64(1)
        for k in keys:
            out.append(pack(total[at : at + len(k)]))
            at += len(k)
        return pd.DataFrame({"chunk": part["chunk"], "cell": part["cell"], "counts": out, "hot": [frequent] + [frequent[:0]] * (len(part) - 1)})

    asked = chunks.select("chunk", *given).mapInArrow(ask, "chunk long, cell int, keys binary, own binary, more binary")
    return asked.groupBy("cell").applyInPandas(answer, "chunk long, cell int, counts binary, hot array<long>")


def answers(keys: np.ndarray, cells, counts, n_ranges: int) -> np.ndarray:
    """The corpus count of each key of a chunk, from its answer rows."""
    out, at = np.zeros(len(keys), np.uint64), cell_bounds(keys, n_ranges)
    for r, raw in zip(cells, counts, strict=True):
        out[at[r] : at[r + 1]] = unpack(raw, np.uint64)
    return out
