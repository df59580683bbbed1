from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pytest

from millrace.llm import tiff_media as T


def lzw(raw: bytes) -> bytes:
    """A plain encoder: clear first, codes widen one early."""
    table, width, bits, out = {bytes([k]): k for k in range(256)}, 9, 0, 0
    codes, n, w = [(256, 9)], 258, b""
    for k in range(len(raw)):
        x = w + raw[k : k + 1]
        if x in table:
            w = x
            continue
        codes.append((table[w], width))
        table[x], n = n, n + 1
        width = 12 if n >= 2048 else 11 if n >= 1024 else 10 if n >= 512 else 9
        if n >= 4094:
            codes.append((256, width))
            table, n, width = {bytes([k]): k for k in range(256)}, 258, 9
        w = raw[k : k + 1]
    if w:
        codes.append((table[w], width))
    codes.append((257, 12 if n + 1 >= 2048 else 11 if n + 1 >= 1024 else 10 if n + 1 >= 512 else 9))
    for c, wd in codes:
        out, bits = out << wd | c, bits + wd
    return (out << -bits % 8).to_bytes((bits + 7) // 8, "big")


def packbits(raw: bytes) -> bytes:
    out, k = bytearray(), 0
    while k < len(raw):
        run = 1
        while k + run < len(raw) and raw[k + run] == raw[k] and run < 128:
            run += 1
        if run > 1:
            out += bytes([257 - run, raw[k]])
            k += run
        else:
            out += bytes([0, raw[k]])
            k += 1
    return bytes(out)


CODECS = {1: bytes, 5: lzw, 8: zlib.compress, 32946: zlib.compress, 32773: packbits}


def tiff(pages: list[np.ndarray], compression: int, order: str = "<", tile: int = 0, predictor: int = 1, planar: int = 1, loop: bool = False) -> bytes:
    body, tables = bytearray(b"II*\0" if order == "<" else b"MM\0*") + b"\0\0\0\0", []
    for a in pages:
        h, w, s = a.shape
        cells = []
        planes = [a[:, :, k : k + 1] for k in range(s)] if planar == 2 else [a]
        for p in planes:
            size = (tile, tile) if tile else (3, w)
            for y in range(0, h, size[0]):
                for x in range(0, w, size[1]):
                    c = p[y : y + size[0], x : x + size[1]]
                    if tile:
                        c = np.pad(c, ((0, tile - c.shape[0]), (0, tile - c.shape[1]), (0, 0)))
                    if predictor == 2:
                        c = np.concatenate([c[:, :1], c[:, 1:] - c[:, :-1]], 1)
                    cells.append(CODECS[compression](c.astype(c.dtype.newbyteorder(order)).tobytes()))
        places = []
        for c in cells:
            places.append(len(body))
            body += c
        body += b"\0" * (len(body) % 2)
        f = [(256, 3, [w]), (257, 3, [h]), (258, 3, [a.dtype.itemsize * 8] * s), (259, 3, [compression]), (262, 3, [1]), (277, 3, [s]), (284, 3, [planar]), (317, 3, [predictor])]
        f += [(322, 3, [tile]), (323, 3, [tile]), (324, 4, places), (325, 4, [len(c) for c in cells])] if tile else [(273, 4, places), (278, 3, [3]), (279, 4, [len(c) for c in cells])]
        entries = []
        for tag, kind, v in sorted(f):
            raw = struct.pack(f"{order}{len(v)}{'H' if kind == 3 else 'I'}", *v)
            if len(raw) > 4:
                at = len(body)
                body += raw
                raw = struct.pack(order + "I", at)
            entries.append(struct.pack(order + "HHI", tag, kind, len(v)) + raw.ljust(4, b"\0"))
        tables.append(len(body))
        body += struct.pack(order + "H", len(entries)) + b"".join(entries) + b"\0\0\0\0"
        n = len(entries)
        if len(tables) > 1:
            prev, m = tables[-2], count
            body[prev + 2 + 12 * m : prev + 6 + 12 * m] = struct.pack(order + "I", tables[-1])
        count = n
    body[4:8] = struct.pack(order + "I", tables[0])
    if loop:
        body[tables[-1] + 2 + 12 * count : tables[-1] + 6 + 12 * count] = struct.pack(order + "I", tables[0])
    return bytes(body)


@pytest.mark.parametrize("compression", CODECS)
@pytest.mark.parametrize("kw", [{}, {"order": ">"}, {"tile": 16}, {"predictor": 2}, {"planar": 2}, {"tile": 16, "planar": 2, "predictor": 2, "order": ">"}])
@pytest.mark.parametrize("dtype", [np.uint8, np.uint16])
def test_reader(compression, kw, dtype):
    rng = np.random.default_rng(5)
    pages = [rng.integers(0, 40, (17, 21, 3)).astype(dtype), np.tile(rng.integers(0, 9, (7, 5, 1)), (1, 4, 3)).astype(dtype)]
    got = list(T.read_pages(tiff(pages, compression, **kw)))
    assert [p.index for p in got] == [0, 1]
    for p, a in zip(got, pages, strict=True):
        assert p.pixels.dtype == a.dtype and (p.pixels == a).all() and (p.height, p.width, p.samples) == a.shape


def test_long_lzw_and_loops():
    raw = bytes(np.random.default_rng(0).integers(0, 256, 30_000).astype(np.uint8)) + b"ab" * 5000
    assert T.unpack_lzw(lzw(raw)) == raw
    assert len(list(T.read_pages(tiff([np.zeros((2, 2, 1), np.uint8)], 1, loop=True)))) == 1


@pytest.mark.parametrize("n", [0, 1, 575, 576, 577, 576 * 256, 576 * 256 + 1, 576 * 700])
def test_write_and_read(n):
    payload = T.pad(bytes(k % 251 for k in range(n)))
    assert len(payload) % 576 == 0 and len(payload) > 0
    pages = list(T.read_pages(T.write_tiff(payload)))
    assert b"".join(p.pixels.tobytes() for p in pages) == payload and len(pages) == -(-len(payload) // (576 * 256))


def test_digests_and_pages(spark, docs, odd, empty):
    for df in (docs, odd):
        media = T.store(df)
        want = sorted((str(r["doc_id"]), hashlib.sha256(T.pad((r["text"] or "").encode())).hexdigest(), zlib.crc32(T.pad((r["text"] or "").encode())[-32:])) for r in df.collect())
        rows = T.page_digests(media).collect()
        assert sorted((str(r["doc_id"]), r["payload_sha256"], r["tail_crc32"]) for r in rows) == want
        pages = T.explode_pages(media)
        assert pages.filter("error is not null").count() == 0 and pages.count() >= df.count()
    assert T.page_digests(T.store(empty)).count() == 0 and T.explode_pages(T.store(empty)).count() == 0
    bad = spark.createDataFrame([(1, None), (2, bytearray(b"junk")), (3, bytearray(T.write_tiff(T.pad(b"x"))[:-9]))], "doc_id long, media binary")
    got = {r["id"]: r for r in T.explode_pages(bad).collect()}
    assert set(got) == {2, 3} and all(r["error"] for r in got.values())


def patched(raw: bytes, tag: int, value: int, count: int | None = None) -> bytes:
    """The file with the value (and count) of a tag of its first page overwritten."""
    out = bytearray(raw)
    (at,) = struct.unpack_from("<I", raw, 4)
    (n,) = struct.unpack_from("<H", raw, at)
    for k in range(n):
        place = at + 2 + 12 * k
        if struct.unpack_from("<H", raw, place)[0] == tag:
            struct.pack_into("<I", out, place + 8, value)
            if count is not None:
                struct.pack_into("<I", out, place + 4, count)
    return bytes(out)


def test_malformed_files_give_a_row_with_the_reason(spark):
    good = T.write_tiff(T.pad(bytes(range(200)) * 10))
    tiles = tiff([np.zeros((17, 21, 1), np.uint8)], 8, tile=16)
    two = T.write_tiff(T.pad(b"z" * 576 * 300))
    (first,) = struct.unpack_from("<I", two, 4)
    (n,) = struct.unpack_from("<H", two, first)
    (second,) = struct.unpack_from("<I", two, first + 2 + 12 * n)
    bad = {
        "width 0": patched(good, T.WIDTH, 0),
        "height 0": patched(good, T.LENGTH, 0),
        "samples 0": patched(good, T.SAMPLES, 0),
        "wide": patched(good, T.WIDTH, 4_000_000_000),
        "high": patched(good, T.LENGTH, 4_000_000_000),
        "rows of 0": patched(good, T.ROWS_PER_STRIP, 0),
        "tile 0": patched(tiles, T.TILE_WIDTH, 0),
        "tile huge": patched(patched(tiles, T.TILE_WIDTH, 65_000), T.TILE_LENGTH, 65_000),
        "offset": patched(good, T.STRIP_OFFSETS, 4_000_000_000),
        "count": patched(good, T.STRIP_COUNTS, 4_000_000_000),
        "many values": patched(good, T.STRIP_OFFSETS, 8, 4_000_000_000),
        "bits": patched(good, T.BITS, 7),
        "compression": patched(good, T.COMPRESSION, 99),
        "cut": good[: len(good) // 2],
        "cut chain": two[: second + 30],
        "junk strips": good[:8] + b"\xff" * 40 + good[48:],
        "header alone": good[:8],
        "nothing": b"",
    }
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in bad.items()] + [("good", bytearray(good)), ("none", None)], "doc_id string, media binary")
    rows = T.explode_pages(df).collect()
    assert {r["id"] for r in rows if r["error"]} == set(bad) and {r["id"] for r in rows} == set(bad) | {"good"}
    assert sum(r["last"] for r in rows) == len(bad) + 1
    done = {r["doc_id"]: r for r in T.page_digests(df).collect()}
    assert done["good"]["payload_sha256"] == hashlib.sha256(T.pad(bytes(range(200)) * 10)).hexdigest()
    assert all(done[k]["payload_sha256"] is None and done[k]["feature"] for k in bad)


@pytest.mark.parametrize("seed", range(5))
def test_flipped_bytes_never_escape(seed):
    """Whatever the bytes, a reader gives pages or one of the errors that become a row."""
    rng = np.random.default_rng(seed)
    files = [T.write_tiff(T.pad(b"abc" * 500)), tiff([np.zeros((9, 9, 1), np.uint8)], 5, tile=16), tiff([np.ones((9, 9, 3), np.uint16)], 32773, planar=2)]
    for raw in files:
        for _ in range(150):
            out = bytearray(raw)
            for k in rng.integers(0, len(out), 4):
                out[k] = rng.integers(0, 256)
            try:
                sum(p.pixels.size for p in T.read_pages(bytes(out)))
            except (ValueError, struct.error, zlib.error, KeyError, IndexError, TypeError, ArithmeticError):
                pass
