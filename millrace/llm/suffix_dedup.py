"""Exact removal of repeated byte strings with suffix arrays.

A byte goes if a string of `window` bytes that covers it also starts anywhere
else in the corpus.  Equal strings must be compared in one place, wherever they
occur, so texts are cut by content: among the k-byte grams of a window the one
with the smallest hash is its anchor, and equal windows have equal anchors.  Runs
of windows with one anchor form a segment.  Anchors are counted over the corpus,
and only segments whose anchor occurs again are dealt, by anchor, to shards; of
whole texts that are copies, told by 128-bit digests, one stands for all, and a
chunk sends segments of equal bytes once.  The rolling hashes only choose what is
compared, so texts made to collide under them cost time and change no result.  Of an anchor that is very frequent, windows are counted too, and only the
parts of its segments that occur again are dealt: what many documents have around
a common passage stays where it is.  Which anchors are, is told by a sieve of fixed
size; one that it takes for frequent is split as well, with the same result.  A shard sorts the suffixes of
its different segments by external induction (see induced.py); a window is
repeated if the common prefix with a neighbour in that order covers it.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import _BASE, blocks, materialize, mix64, table, utf8_column
from .counting import RANGE_BYTES, answers, exchange_counts, open_chunk, text_chunks
from .induced import MEMORY, Store, sort_into

#: Bytes of a string that must not occur twice, and of a gram that anchors it.
WINDOW, GRAM = 200, 40
#: Occurrences from which an anchor is frequent, however large the corpus is, and bits of the sieve of frequent anchors.
HOT_ROWS, SIEVE_BITS = 20_000, 22
#: Bytes of text in a chunk, of the corpus for each shard of segments, and of text that is hashed at a time.
CHUNK_BYTES, SHARD_BYTES, STRIP = 4 << 20, 4 << 20, 1 << 20
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(maxsize=2)
def _ladder(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def ladder(base: int, n: int) -> np.ndarray:
    return _ladder(base, max(STRIP + 1, 1 << (n - 1).bit_length() if n > STRIP + 1 else 0))[:n]


def among(known: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of x are in the sorted array."""
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x if len(known) else np.zeros(len(x), bool)


def sieve_of(keys: DataFrame, bits: int) -> np.ndarray | None:
    """Packed bits, set at the lowest `bits` bits of each key (a column of longs); None if there is no key."""
    low = keys.select(F.col(keys.columns[0]).bitwiseAND(F.lit((1 << bits) - 1)).alias("low"))
    parts = low.groupBy(F.shiftright("low", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("low") % 32768).alias("bitmap")).collect()
    if not parts:
        return None
    out = np.zeros((max(1, 1 << bits >> 15), 4096), np.uint8)
    for part, bitmap in parts:
        out[part] = np.frombuffer(bitmap, np.uint8)
    return out.ravel()


def sifted(sieve: np.ndarray, bits: int, x: np.ndarray) -> np.ndarray:
    """Which of x have their bit in the sieve: all of its keys, and by chance others."""
    low = (x & np.uint64((1 << bits) - 1)).astype(np.int64)
    return sieve[low >> 3] >> (low & 7).astype(np.uint8) & 1 == 1


def anchors(data: np.ndarray, off: np.ndarray, window: int, gram: int, hot=None, again=None) -> tuple[np.ndarray, ...]:
    """(document, first window, last window, hash of the anchor) of each segment.

    Windows are given by their first byte.  Among grams with equal hashes the
    leftmost is the anchor.  `again` tells for hashes of windows whether they
    occur again; it is asked for the segments of the anchors that `hot` says are
    frequent, of which only the parts where it says so are returned.
    """
    w = window - gram + 1
    assert 1 <= w <= 256
    doc, lo_, hi_, key = [], [], [], []
    for lo, hi in blocks(off, STRIP):
        d, o = data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        n = len(d)
        fits = np.maximum(np.diff(o) - window + 1, 0)
        if not fits.sum():
            continue
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[d] * ladder(_BASE, n), out=total[1:])
        back = ladder(_INVERSE, n + 1)
        h = mix64((total[gram:] - total[:-gram]) * back[: n - gram + 1])
        m = -(-len(h) // w) * w
        cell = np.full(m, ~np.uint64(0))
        cell[: len(h)] = h
        cell = (cell.reshape(-1, w) & ~np.uint64(255)) | np.arange(w, dtype=np.uint64)
        ahead = np.minimum.accumulate(cell, axis=1).ravel()
        behind = np.minimum.accumulate(cell[:, ::-1], axis=1)[:, ::-1].ravel()
        which = np.repeat(np.arange(hi - lo), fits)
        s = np.arange(len(which)) - np.repeat(np.cumsum(fits) - fits, fits) + np.repeat(o[:-1], fits)
        a, b = behind[s], ahead[s + w - 1]
        left = a >> np.uint64(8) <= b >> np.uint64(8)
        at = np.where(left, s // w * w + (a & np.uint64(255)).astype(np.int64), (s + w - 1) // w * w + (b & np.uint64(255)).astype(np.int64))
        first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (which[1:] != which[:-1])))
        last = np.append(first[1:], len(at)) - 1
        if hot is not None:
            warm = hot(h[at[first]])
            n_own = (last - first + 1)[warm]
            own = np.repeat(first[warm] - (np.cumsum(n_own) - n_own), n_own) + np.arange(n_own.sum())
            stay = np.flatnonzero(again(mix64((total[s[own] + window] - total[s[own]]) * back[s[own]] + np.uint64(window))))
            run = np.repeat(np.flatnonzero(warm), n_own)[stay]
            heads = np.flatnonzero(np.append(True, (np.diff(own[stay]) != 1) | (np.diff(run) != 0))) if len(stay) else stay
            tails = np.append(heads[1:], len(stay)) - 1 if len(stay) else stay
            first, last = np.concatenate([first[~warm], own[stay[heads]]]), np.concatenate([last[~warm], own[stay[tails]]])
            by = np.argsort(first, kind="stable")
            first, last = first[by], last[by]
        doc.append(which[first] + lo)
        lo_.append(s[first] + off[lo])
        hi_.append(s[last] + off[lo])
        key.append(h[at[first]])
    if not doc:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in (doc, lo_, hi_, key))


def copy_keys(offsets: bytes, digests: bytes, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents of a window or more, the sorted distinct digests among them, which of those each has)."""
    long = np.flatnonzero(np.diff(np.frombuffer(offsets, np.int64)) >= window)
    every, inverse = np.unique(np.frombuffer(digests, "<u8").reshape(-1, 2)[long], axis=0, return_inverse=True)
    return long, every, inverse.ravel()


def slices(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte strings data[start:end] as an Arrow column."""
    size = end - start
    heads = np.concatenate([[0], np.cumsum(size)])
    raw = data[np.arange(heads[-1]) + np.repeat(start - heads[:-1], size)]
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(heads.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]).cast(pa.binary())


def repeated(segments: pa.Array, window: int, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, from, to): the bytes of different segments covered by windows that start at two places or more."""
    data, off = utf8_column(segments)
    store, n = Store(memory), len(off) - 1
    heads = off + np.arange(n + 1)  # a separator follows each segment
    size = int(heads[-1]) + 1
    if size >= 1 << 32:
        raise ValueError("a shard of 4 GB or more; choose smaller shards")
    t, hit = store.array(size, np.uint16), store.array(size, np.uint8)
    t[:-1] = 1  # parts the segments; the last place holds the only 0
    for a in range(0, n, store.block):
        b = min(n, a + store.block)
        inside = np.arange(off[a], off[b]) + np.repeat(np.arange(a, b), np.diff(off[a : b + 1]))
        t[inside] = data[off[a] : off[b]].astype(np.uint16) + 2
    before = -1  # the suffix that came last

    def mark(pos: np.ndarray, lcp: np.ndarray) -> None:
        nonlocal before
        again = np.flatnonzero(lcp >= window)
        hit[pos[again]] = 1
        hit[np.append(before, pos[:-1])[again]] = 1
        before = int(pos[-1]) if len(pos) else before

    sort_into(t, 258, window, store, mark)
    owners, los, his = [], [], []
    for a in range(0, n, store.block):
        b = min(n, a + store.block)
        at = np.flatnonzero(hit[heads[a] : heads[b]]) + heads[a]
        owner = np.searchsorted(heads[a : b + 1], at, "right") - 1 + a
        fits = at + window < heads[owner + 1]
        at, owner = at[fits], owner[fits]
        if len(at):
            first = np.flatnonzero(np.append(True, (at[1:] - at[:-1] > window) | (owner[1:] != owner[:-1])))
            last = np.append(first[1:], len(at)) - 1
            owners.append(owner[first])
            los.append(at[first] - heads[owner[first]])
            his.append(at[last] + window - heads[owner[first]])
    if not owners:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in (owners, los, his))


_SPANS = pa.schema([("chunk", pa.int64()), ("row", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])


def flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all values of a list column, how many each row has)."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return pc.list_flatten(lists).to_numpy(zero_copy_only=False), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def merged(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each row, sorted, with those that touch or overlap made one."""
    if not len(row):
        return row, lo, hi
    order = np.lexsort((lo, row))
    row, lo, hi = row[order], lo[order], hi[order]
    # rows apart by more than any interval, so that one running maximum serves all
    gap = (np.cumsum(np.append(0, row[1:] != row[:-1])) * (int(hi.max()) + 2)).astype(np.int64)
    hi = np.maximum.accumulate(hi + gap)
    lo = lo + gap
    first = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
    last = np.append(first[1:], len(row)) - 1
    return row[first], lo[first] - gap[first], hi[last] - gap[first]


def spans_of(t: pa.Table, window: int, memory: int = MEMORY) -> pa.Table:
    """(chunk, row, lo, hi) of repeated bytes among one shard's segments; one without text stands for documents that go whole."""
    gone = t.filter(pc.is_null(t["text"]))
    rows, per = flat(gone["rows"])
    out = [pa.table([pa.array(np.repeat(gone["chunk"].to_numpy(), per)), pa.array(rows, pa.int64()), pa.array(np.zeros(len(rows), np.int64)), pa.array(flat(gone["starts"])[0], pa.int64())], schema=_SPANS)]
    t = t.filter(pc.is_valid(t["text"]))
    if t.num_rows:
        coded = t["text"].combine_chunks().dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        code, kinds = coded.indices.to_numpy(), coded.dictionary
        rows, per = flat(t["rows"])
        starts, _ = flat(t["starts"])
        n = np.bincount(code, per)
        anchor = np.zeros(len(kinds), np.int64)
        anchor[code] = t["anchor"].to_numpy()
        _, inverse, mates = np.unique(anchor, return_inverse=True, return_counts=True)
        lone = mates[inverse] == 1  # all segments of the anchor are equal
        twice = np.flatnonzero(n > 1)
        size = pc.binary_length(kinds).to_numpy().astype(np.int64)
        sort = np.flatnonzero(~lone)
        owner, lo, hi = twice, np.zeros(len(twice), np.int64), size[twice]
        if len(sort):
            o, a, b = repeated(kinds.take(pa.array(sort)), window, memory)
            o = sort[o]
            single = n[o] == 1
            owner, lo, hi = np.concatenate([owner, o[single]]), np.concatenate([lo, a[single]]), np.concatenate([hi, b[single]])
        by = np.argsort(owner, kind="stable")
        owner, lo, hi = owner[by], lo[by], hi[by]
        code, chunk = np.repeat(code, per), np.repeat(t["chunk"].to_numpy(), per)
        at, per = np.searchsorted(owner, code, "left"), np.searchsorted(owner, code, "right")
        per = per - at
        place = np.repeat(at - (np.cumsum(per) - per), per) + np.arange(per.sum())
        each = np.repeat(np.arange(len(code)), per)
        names, doc = np.unique(np.stack([chunk[each], rows[each]], 1), axis=0, return_inverse=True)
        doc, lo, hi = merged(doc.ravel(), starts[each] + lo[place], starts[each] + hi[place])
        out.append(pa.table([pa.array(names[doc, 0]), pa.array(names[doc, 1]), pa.array(lo), pa.array(hi)], schema=_SPANS))
    return pa.concat_tables(out)


def cut(data: np.ndarray, off: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, characters: bool = False) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(removed bytes, removed runs, kept bytes) of each document of a chunk; with `characters`, one that a cut edge parts goes whole."""
    row, lo, hi = merged(row, lo, hi)
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, lo + off[row], 1)
    np.add.at(edge, hi + off[row], -1)
    keep = np.cumsum(edge[:-1]) == 0
    if characters and len(row):
        lead = data & 0xC0 != 0x80
        lead[off[:-1][np.diff(off) > 0]] = True
        first = np.flatnonzero(lead)
        keep = np.repeat(np.logical_and.reduceat(keep, first), np.diff(np.append(first, len(data))))
    ends = np.concatenate([[0], np.cumsum(keep)])[off]
    rest = data[keep].tobytes()
    return np.diff(off) - np.diff(ends), np.bincount(row, minlength=len(off) - 1), [rest[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES, shard_bytes: int = SHARD_BYTES, memory: int = MEMORY, hot_rows: int = 0, keep_bytes: bool = True, characters: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the remaining bytes) for each row.

    Texts are judged as given, as UTF-8; null is empty.  Texts below the window
    length stay.  With `characters`, the bytes that a cut leaves of a character go
    too, and count as removed.  Repeated rows are copies of each other, so those of a window or
    more go whole.  An empty table gives no rows.
    """
    held = materialize(text_chunks(df, id_col, text_col, chunk_bytes, digests=True), "chunks")
    total = held.agg(F.sum("n_bytes")).first()[0] or 0
    n_ranges, n_shards = max(1, -(-total // range_bytes)), max(1, -(-total // shard_bytes))

    def keys_of(offsets: bytes, texts: bytes):
        return np.unique(anchors(*open_chunk(offsets, texts), window, gram)[3], return_counts=True)

    def copies_of(offsets: bytes, digests: bytes):
        _, every, inverse = copy_keys(offsets, digests, window)
        return every[:, 0], np.bincount(inverse, minlength=len(every)), every[:, 1]

    told = materialize(exchange_counts(held, keys_of, n_ranges, hot=hot_rows or HOT_ROWS), "anchors")
    bits = SIEVE_BITS
    sieve = sieve_of(told.select(F.explode("hot")), bits)
    hot = None if sieve is None else lambda keys: sifted(sieve, bits, keys)

    def windows_of(offsets: bytes, texts: bytes):
        data, off = open_chunk(offsets, texts)
        found: list[tuple[np.ndarray, np.ndarray]] = []  # distinct ones by strip, since periodic texts repeat few
        anchors(data, off, window, gram, hot, lambda w: found.append(np.unique(w, return_counts=True)) or np.zeros(len(w), bool))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        windows, inverse = np.unique(np.concatenate([w for w, _ in found]), return_inverse=True)
        return windows, np.bincount(inverse, np.concatenate([n for _, n in found]), len(windows)).astype(np.int64)

    told = told.select("chunk", "cell", "counts", F.lit(0).alias("level"))
    copy_ranges = max(1, -(-n_ranges // 16))  # a document has one key, and most have more anchors than that
    copies = exchange_counts(held, copies_of, copy_ranges, firsts=True, given=("offsets", "digests"))
    told = told.unionByName(copies.select("chunk", "cell", "counts", F.lit(2).alias("level")))
    if hot is not None:
        told = told.unionByName(exchange_counts(held, windows_of, n_ranges).select("chunk", "cell", "counts", F.lit(1).alias("level")))

    def segments(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk, offsets, texts, digests = (left[k][0].as_py() for k in ("chunk", "offsets", "texts", "digests"))
        data, off = open_chunk(offsets, texts)

        def told_of(level: int, keys: np.ndarray, ranges: int) -> np.ndarray:
            mine = right.filter(pc.equal(right["level"], level))
            return answers(keys, mine["cell"].to_numpy(), mine["counts"].to_pylist(), ranges)

        found: list[np.ndarray] = []
        cut_up = anchors(data, off, window, gram, hot, lambda w: found.append(np.unique(w)) or np.ones(len(w), bool))
        asked = np.unique(cut_up[3])
        counts = told_of(0, asked, n_ranges)
        if any(map(len, found)):
            windows = np.unique(np.concatenate(found))
            twice = windows[told_of(1, windows, n_ranges) > 1]
            cut_up = anchors(data, off, window, gram, hot, lambda w: among(twice, w))
        doc, lo, hi, key = cut_up
        long, every, inverse = copy_keys(offsets, digests, window)
        told = told_of(2, every[:, 0], copy_ranges)
        here = np.zeros(len(inverse), bool)
        here[np.unique(inverse, return_index=True)[1]] = True  # where a text stands first in the chunk
        copied = (told >> np.uint64(1) > 1)[inverse]
        silent = np.zeros(len(off) - 1, bool)
        silent[long[copied & ~(here & ((told & np.uint64(1)) == 1)[inverse])]] = True
        live = (counts[np.searchsorted(asked, key)] > 1) & ~silent[doc]
        doc, lo, hi, key = doc[live], lo[live], hi[live] + window, key[live]
        gone = long[copied]
        # segments of the chunk with equal bytes are one row with all their places, and copied documents one row for each shard
        coded = slices(data, lo, hi).dictionary_encode()
        by = np.argsort(coded.indices.to_numpy(), kind="stable")
        heads = np.searchsorted(coded.indices.to_numpy()[by], np.arange(len(coded.dictionary) + 1))
        anchor, kinds = key[by[heads[:-1]]], coded.dictionary
        shards, copies_at = np.unique(gone % n_shards, return_inverse=True)
        order = np.argsort(copies_at, kind="stable")
        cuts = np.searchsorted(copies_at[order], np.arange(len(shards) + 1))
        lists = lambda a, b: pa.ListArray.from_arrays(pa.array(np.concatenate([cuts, cuts[-1] + heads[1:]]), pa.int32()), pa.array(np.concatenate([a, b]), pa.int64()))
        return pa.table({
            "shard": pa.array(np.concatenate([shards, (mix64(anchor) % np.uint64(n_shards)).astype(np.int64)]), pa.int64()),
            "anchor": pa.array(np.concatenate([np.zeros(len(shards), np.int64), anchor.view(np.int64)])),
            "chunk": pa.array(np.full(len(shards) + len(kinds), chunk, np.int64)),
            "rows": lists(gone[order], doc[by]),
            "starts": lists(np.diff(off)[gone[order]], (lo - off[doc])[by]),
            "text": pa.chunked_array([pa.nulls(len(shards), pa.binary()), kinds]),
        })

    dealt = held.select("chunk", "offsets", "texts", "digests").groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(segments, "shard long, anchor long, chunk long, rows array<long>, starts array<long>, text binary")
    spans = dealt.groupBy("shard").applyInArrow(lambda t: spans_of(t, window, memory), "chunk long, row long, lo long, hi long")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        data, off = open_chunk(left["offsets"][0].as_py(), left["texts"][0].as_py())
        removed, n_spans, kept = cut(data, off, *(right[k].to_numpy() for k in ("row", "lo", "hi")), characters)
        cols = {"doc_id": left["ids"].combine_chunks().flatten(), "n_bytes": pa.array(np.diff(off)), "n_removed": pa.array(removed), "n_spans": pa.array(n_spans.astype(np.int64)), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept])}
        return pa.table(cols | ({"kept": pa.array(kept, pa.binary())} if keep_bytes else {}))

    kind = df.schema[id_col].dataType.simpleString()
    return held.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(finish, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes)


def op1_suffix(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False)
