"""TIFF media columns: write payloads losslessly, walk image directories, one row for each page.

The reader takes classic and big files of either byte order: strips and tiles,
stored plain or with PackBits, LZW or deflate, chunky or planar, 8 or 16 bits,
with the horizontal predictor undone.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Samples in a row, rows in a strip and rows in a page of what is written.
ROW, STRIP_ROWS, PAGE_ROWS = 576, 64, 256
PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773

# Fixed values of the format: tag numbers.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS = 317, 322, 323, 324, 325
#: Format of a field's values, by field type: bytes, text, 16, 32 bits and so on.
FIELD = {1: "B", 2: "B", 3: "H", 4: "I", 6: "b", 7: "B", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}


class Page(NamedTuple):
    index: int
    width: int
    height: int
    samples: int
    bits: int
    compression: int
    pixels: np.ndarray  # (height, width, samples)


# ---------------------------------------------------------------- decoding


def unpack_bits(raw: bytes) -> bytes:
    out, k, n = bytearray(), 0, len(raw)
    while k < n:
        c = raw[k]
        if c < 128:
            out += raw[k + 1 : k + 2 + c]
            k += 2 + c
        else:
            if c > 128 and k + 1 < n:
                out += raw[k + 1 : k + 2] * (257 - c)
            k += 1 if c == 128 else 2
    return bytes(out)


def unpack_lzw(raw: bytes) -> bytes:
    """Most significant bit first; codes widen one code early; 256 clears, 257 ends."""
    base = [bytes([k]) for k in range(256)] + [b"", b""]
    words, width, held, have, prev, out = list(base), 9, 0, 0, b"", []
    for byte in raw:
        held, have = held << 8 | byte, have + 8
        if have < width:
            continue
        have -= width
        code, held = held >> have, held & (1 << have) - 1
        if code == 256:
            words, width, prev = list(base), 9, b""
            continue
        if code == 257:
            break
        if code < len(words):
            word = words[code]
        elif prev and code == len(words):
            word = prev + prev[:1]
        else:
            raise ValueError("LZW code out of range")
        if prev:
            words.append(prev + word[:1])
        out.append(word)
        prev = word
        width = 12 if len(words) >= 2047 else 11 if len(words) >= 1023 else 10 if len(words) >= 511 else 9
    return b"".join(out)


def decode(raw: bytes, compression: int, size: int) -> bytes:
    """The bytes of a strip or tile, of which `size` are needed."""
    if compression == PLAIN:
        return raw
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompressobj().decompress(raw, size)
    if compression == PACKBITS:
        return unpack_bits(raw)
    if compression == LZW:
        return unpack_lzw(raw)
    raise ValueError(f"compression {compression} is not supported")


def directories(raw: bytes) -> Iterator[tuple[str, dict[int, tuple]]]:
    """(byte order, tag -> values) of each image directory in the order of the chain; a loop in the chain ends it."""
    order = {b"II": "<", b"MM": ">"}.get(raw[:2])
    kind = struct.unpack_from(order + "H", raw, 2)[0] if order and len(raw) >= 8 else 0
    if kind not in (42, 43):
        raise ValueError("not a TIFF file")
    big = kind == 43
    n_fmt, ptr, entry, room = ("Q", "Q", 20, 8) if big else ("H", "I", 12, 4)
    at, seen = struct.unpack_from(order + ptr, raw, 8 if big else 4)[0], set()
    while at and at not in seen:
        seen.add(at)
        (n,) = struct.unpack_from(order + n_fmt, raw, at)
        at += struct.calcsize(n_fmt)
        tags = {}
        for k in range(n):
            tag, field, count = struct.unpack_from(order + "HH" + ptr, raw, at + k * entry)
            if field in FIELD:
                fmt = f"{order}{count}{FIELD[field]}"
                place = at + k * entry + entry - room
                if struct.calcsize(fmt) > room:
                    (place,) = struct.unpack_from(order + ptr, raw, place)
                tags[tag] = struct.unpack_from(fmt, raw, place)
        yield order, tags
        (at,) = struct.unpack_from(order + ptr, raw, at + n * entry)


#: Bytes that one stored byte can stand for at most.
EXPANSION = {PLAIN: 1, PACKBITS: 64, DEFLATE: 1032, OLD_DEFLATE: 1032, LZW: 2731}


def read_pages(raw: bytes) -> Iterator[Page]:
    """The pages of a file; a header that its bytes cannot bear out raises ValueError before anything is allocated."""
    for index, (order, t) in enumerate(directories(raw)):
        one = lambda tag, default=0: (t.get(tag) or (default,))[0]
        width, height, samples, bits = one(WIDTH), one(LENGTH), one(SAMPLES, 1), one(BITS, 1)
        compression, planes = one(COMPRESSION, PLAIN), samples if one(PLANAR, 1) == 2 else 1
        if bits not in (8, 16) or any(x != bits for x in t.get(BITS, ())):
            raise ValueError(f"{bits} bits for a sample are not supported")
        if compression not in EXPANSION:
            raise ValueError(f"compression {compression} is not supported")
        tiled = TILE_OFFSETS in t
        if tiled:
            w, h, offsets, counts = one(TILE_WIDTH), one(TILE_LENGTH), t[TILE_OFFSETS], t.get(TILE_COUNTS, ())
        else:
            w, h, offsets, counts = width, min(one(ROWS_PER_STRIP, height), height), t.get(STRIP_OFFSETS, ()), t.get(STRIP_COUNTS, ())
        if min(width, height, samples, w, h) < 1:
            raise ValueError("a width, height or number of samples of 0")
        deep, across, down = samples // planes, -(-width // w), -(-height // h)
        if not len(offsets) == len(counts) == across * down * planes:
            raise ValueError("strips or tiles do not cover the page")
        if any(n < 0 or at < 0 or at + n > len(raw) for at, n in zip(offsets, counts, strict=True)):
            raise ValueError("a strip or tile lies outside the file")
        dtype = np.dtype(np.uint8 if bits == 8 else order + "u2")
        if max(width * height * samples, w * h * deep * len(offsets) if tiled else 0) * dtype.itemsize > EXPANSION[compression] * sum(counts):
            raise ValueError("more pixels than the stored bytes can hold")
        pixels = np.zeros((height, width, samples), dtype.newbyteorder("="))
        for k, (at, n) in enumerate(zip(offsets, counts, strict=True)):
            plane, cell = divmod(k, across * down)
            y, x = cell // across * h, cell % across * w
            rows = h if tiled else min(h, height - y)
            got = np.frombuffer(decode(raw[at : at + n], compression, rows * w * deep * dtype.itemsize), dtype, rows * w * deep).reshape(rows, w, deep)
            if one(PREDICTOR, 1) == 2:
                got = np.add.accumulate(got.astype(pixels.dtype), axis=1, dtype=pixels.dtype)
            pixels[y : y + h, x : x + w, plane if planes > 1 else slice(None)] = (got[: height - y, : width - x, 0] if planes > 1 else got[: height - y, : width - x])
        yield Page(index, width, height, samples, bits, compression, pixels)


# ---------------------------------------------------------------- writing


def pad(raw: bytes, unit: int = ROW) -> bytes:
    """The payload of a text: 255s up to a positive multiple of unit."""
    return raw + b"\xff" * (max(unit, -(-len(raw) // unit) * unit) - len(raw))


def write_tiff(payload: bytes, row: int = ROW, strip_rows: int = STRIP_ROWS, page_rows: int = PAGE_ROWS) -> bytes:
    """A little-endian file of grey pages, row samples wide, deflated in strips after horizontal differencing."""
    grid = np.frombuffer(payload, np.uint8).reshape(-1, row)
    body, at, tables = [], 8, []
    for top in range(0, len(grid), page_rows):
        page = grid[top : top + page_rows]
        diff = page.copy()
        diff[:, 1:] -= page[:, :-1]
        strips = [zlib.compress(diff[k : k + strip_rows].tobytes(), 6) for k in range(0, len(page), strip_rows)]
        offsets = []
        for s in strips:
            offsets.append(at)
            body.append(s)
            at += len(s)
        tables.append((len(page), offsets, [len(s) for s in strips]))
    if at & 1:
        body.append(b"\0")
        at += 1
    first, tail = at, []
    for k, (height, offsets, counts) in enumerate(tables):
        fields = [(WIDTH, 4, [row]), (LENGTH, 4, [height]), (BITS, 3, [8]), (COMPRESSION, 3, [DEFLATE]), (PHOTOMETRIC, 3, [1]), (STRIP_OFFSETS, 4, offsets), (SAMPLES, 3, [1]), (ROWS_PER_STRIP, 4, [strip_rows]), (STRIP_COUNTS, 4, counts), (PREDICTOR, 3, [2])]
        head, extra, free = [struct.pack("<H", len(fields))], [], at + 2 + 12 * len(fields) + 4
        for tag, kind, values in fields:
            raw = struct.pack(f"<{len(values)}{FIELD[kind]}", *values)
            if len(raw) > 4:
                extra.append(raw)
                raw, free = struct.pack("<I", free), free + len(raw)
            head.append(struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0"))
        head.append(struct.pack("<I", free if k + 1 < len(tables) else 0))
        tail.append(b"".join(head + extra))
        at = free
    return b"II" + struct.pack("<HI", 42, first) + b"".join(body) + b"".join(tail)


# ---------------------------------------------------------------- operators


def store(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each text as a TIFF file; null and empty texts are one row of 255s."""
    picked = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("raw"))

    def run(batches):
        for b in batches:
            ids, raw = b.column("doc_id"), b.column("raw")
            for lo in range(0, b.num_rows, 500):
                texts = [x or b"" for x in raw.slice(lo, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, 500), pa.array(map(len, texts), pa.int64()), pa.array([write_tiff(pad(x)) for x in texts], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


class Digest:
    """Running digests of a medium's pages, in their order."""

    def __init__(self):
        self.sha, self.tail, self.size, self.pages, self.total, self.square, self.wide, self.high = hashlib.sha256(), b"", 0, 0, 0, 0, 0, 0

    def add(self, data: bytes, width: int, height: int, bits: int) -> None:
        self.sha.update(data)
        self.tail = (self.tail + data)[-32:]
        v = np.frombuffer(data, np.uint8 if bits == 8 else np.uint16).astype(np.int64)
        self.size, self.pages, self.total, self.square = self.size + len(data), self.pages + 1, self.total + int(v.sum()), self.square + int(v @ v)
        self.wide, self.high, self.bits = max(self.wide, width), self.high + height, bits

    def row(self) -> tuple:
        n = self.size * 8 // self.bits
        mean = self.total / n
        return self.size, self.sha.hexdigest(), zlib.crc32(self.tail), f"pages={self.pages};width={self.wide};height={self.high};mean={mean:.3f};var={self.square / n - mean * mean:.3f}"


def explode_pages(df: DataFrame, id_col: str = "doc_id", media_col: str = "media", keep: tuple[str, ...] = (), pixels: bool = True) -> DataFrame:
    """One row for each page: id, page, width, height, samples, bits, compression, pixels, error, last, digests, and the columns in keep.

    A null medium has no pages; one that cannot be read, whatever its header says,
    gives a row with a null page and the reason, after the pages read before it.
    `last` marks the last row of a medium, which holds the digests of all its pages,
    taken as they are decoded: payload_bytes, payload_sha256, tail_crc32 and feature;
    of a medium that could not be read they are null, and the feature is the reason.
    Without `pixels` these are null, and never leave the decoder.  Repeated rows give
    repeated pages.
    """
    picked = df.select(F.col(id_col).alias("id"), F.col(media_col).cast("binary").alias("media"), *[F.col(k).alias(f"__{k}") for k in keep])
    kinds = {"page": pa.int32(), "width": pa.int32(), "height": pa.int32(), "samples": pa.int32(), "bits": pa.int32(), "compression": pa.int32(), "pixels": pa.binary(), "error": pa.string(), "last": pa.bool_(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "feature": pa.string()}
    most = 16 << 20  # bytes of pixels in a batch, or one page

    def run(batches):
        def out(b, rows):
            at = pa.array([k for k, *_ in rows], pa.int64())
            cols = [pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True))[1:], kinds.values(), strict=True)]
            return pa.RecordBatch.from_arrays([b.column("id").take(at), *cols, *[b.column(f"__{k}").take(at) for k in keep]], names=["id", *kinds, *[f"__{k}" for k in keep]])

        for b in batches:
            rows, held = [], 0
            for k in range(b.num_rows):
                raw, wait, sums = b.column("media")[k].as_py(), None, Digest()
                if raw is None:
                    continue
                none = (False, None, None, None, None)
                try:
                    for p in read_pages(raw):
                        if wait is not None:
                            rows.append((*wait, *none))
                        data = p.pixels.tobytes()
                        sums.add(data, p.width, p.height, p.bits)
                        wait = (k, p.index, p.width, p.height, p.samples, p.bits, p.compression, data if pixels else None, None)
                        held += len(data) if pixels else 0
                        if held > most and rows:
                            yield out(b, rows)
                            rows, held = [], len(data)
                    ends = sums.row() if wait is not None else (None,) * 4
                except (ValueError, struct.error, zlib.error, KeyError, IndexError, TypeError, ArithmeticError, MemoryError) as e:
                    if wait is not None:
                        rows.append((*wait, *none))
                    reason = str(e)[:200] or type(e).__name__
                    wait, ends = (k, *(None,) * 7, reason), (None, None, None, reason)
                if wait is not None:
                    rows.append((*wait, True, *ends))
            if rows:
                yield out(b, rows)

    given = {f.name: f.dataType.simpleString() for f in picked.schema.fields}
    ddl = "page int, width int, height int, samples int, bits int, compression int, pixels binary, error string, last boolean, payload_bytes long, payload_sha256 string, tail_crc32 long, feature string"
    made = picked.mapInArrow(run, f"id {given['id']}, {ddl}" + "".join(f", `__{k}` {given[f'__{k}']}" for k in keep))
    return made.select("id", *kinds, *[F.col(f"__{k}").alias(k) for k in keep])


def page_digests(df: DataFrame, id_col: str = "doc_id", media_col: str = "media", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in keep, payload_bytes, payload_sha256, tail_crc32 and feature of each medium: the last of its page rows."""
    return explode_pages(df, id_col, media_col, keep, pixels=False).filter("last").select(F.col("id").alias("doc_id"), *keep, "payload_bytes", "payload_sha256", "tail_crc32", "feature")


def op9_tiff(spark, sf_dir: str) -> DataFrame:
    from .base import table

    keep = ("n_bytes", "media_bytes", "media_sha256")
    media = store(table(spark, sf_dir, "documents")).withColumns({"media_bytes": F.octet_length("media").cast("long"), "media_sha256": F.sha2("media", 256)})
    return page_digests(media, keep=keep)
