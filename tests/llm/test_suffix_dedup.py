from __future__ import annotations

import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import induced, suffix_dedup
from millrace.llm.counting import exchange_counts
from millrace.llm.suffix_dedup import anchors, remove_repeats, sieve_of, sifted


def brute(texts: list[bytes], window: int) -> list[tuple]:
    seen = Counter(t[k : k + window] for t in texts for k in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - window + 1):
            if seen[t[k : k + window]] > 1:
                gone[k : k + window] = True
        gone = gone[: len(t)]
        spans = int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum()) if len(gone) else 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=50), st.integers(1, 3), st.integers(1, 60), st.sampled_from([64, 2000, 1 << 20]), st.sampled_from([0, 1, 2, 5]), st.booleans())
def test_suffix_order_and_prefixes(symbols, repeats, depth, memory, block, small):
    """Any budget, block and kind of range gives the order and the prefixes."""
    t = np.array(symbols * repeats + [0])
    store, alone = induced.Store(memory), induced.SMALL
    store.block = block or store.block
    induced.SMALL = alone if small else 0
    try:
        order, lcp = induced.collect(t, 5, depth, store)
    finally:
        induced.SMALL = alone
    keys = [tuple(t[k:])[:depth] for k in order]
    assert sorted(order) == list(range(len(t))) and keys == sorted(keys)
    for k in range(1, len(order)):
        a, b = tuple(t[order[k - 1] :]), tuple(t[order[k] :])
        n = next((j for j, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert lcp[k] == min(n, depth)


def test_queue_spills_and_keeps_order():
    dtype = np.dtype([("symbol", "<u4"), ("pos", "<u4")])
    q = induced.Queue(dtype, 100, np.array([0, 4, 9]))
    rng = np.random.default_rng(0)
    rows = []
    for k in range(60):
        x = np.zeros(5, dtype)
        x["symbol"], x["pos"] = np.sort(rng.integers(0, 10, 5)), np.arange(5 * k, 5 * k + 5)
        rows += x.tolist()
        q.push(x, x["symbol"].copy())
    assert q.spilled > 0
    got = [[tuple(v) for part in q.pull(r, 7) for v in part.tolist()] for r in range(3)]
    assert got == [[v for v in rows if lo <= v[0] <= hi] for lo, hi in ((0, 0), (1, 4), (5, 9))]
    q.close()


def test_recursion_and_bounded_memory():
    """Names are sorted by the same induction, prefixes come back, and memory follows the budget, not the string."""
    rng = np.random.default_rng(4)
    peaks = []
    for n in (60_000, 240_000):
        words = [bytes(rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8)) for _ in range(800)]
        raw = b" ".join(words[k] for k in rng.integers(0, 800, n // 6))[:n]
        t = np.append(np.frombuffer(raw, np.uint8).astype(np.uint16) + 2, 0).astype(np.uint16)
        depths, level = [], induced.Level.__init__

        def spy(self, t, k, depth, store, depths=depths, level=level):
            depths.append((len(t), depth))
            level(self, t, k, depth, store)

        induced.Level.__init__ = spy
        try:
            tracemalloc.start()
            hits = []
            induced.sort_into(t, 258, 200, induced.Store(400_000), lambda p, x, hits=hits: hits.append(int((x >= 20).sum())))
            peaks.append(tracemalloc.get_traced_memory()[1])
        finally:
            tracemalloc.stop()
            induced.Level.__init__ = level
        assert [d for _, d in depths[:3]] == [200, 100, 50] and depths[1][0] * 2 < depths[0][0]
        assert sum(hits) == n - len({raw[k : k + 20] for k in range(n - 19)}) - 19
    assert peaks[1] < 1.7 * peaks[0] and peaks[1] < 4 * 400_000


def test_texts_that_collide_under_a_polynomial_stay(spark):
    """Thue-Morse patterns are equal under any polynomial hash modulo 2^64 with an odd base."""
    bits, filler = [bin(k).count("1") & 1 for k in range(4096)], np.random.default_rng(0).integers(97, 123, 4096)
    rows = [(i, "".join(pair[x] + chr(f) for x, f in zip(bits, filler, strict=True))) for i, pair in ((1, "ab"), (2, "ba"))] + [(3, "copy " * 50), (4, "copy " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:5] for r in remove_repeats(df).collect()}
    want = brute([t.encode() for _, t in rows], 200)
    assert [got[i] for i, _ in rows] == want and want[0][1] == want[1][1] == 0 and want[2][1] == 250


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    common = rng.integers(97, 123, 300)
    data = np.concatenate([rng.integers(97, 123, 500), common, rng.integers(97, 123, 70), common]).astype(np.uint8)
    doc, lo, hi, key = anchors(data, np.array([0, 870, len(data)]), 200, 40)
    assert {int(d) for d in doc} == {0, 1}
    of = lambda s: key[np.flatnonzero((lo <= s) & (s <= hi))[0]]
    assert all(of(500 + k) == of(870 + k) for k in range(100))


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 20_000, "range_bytes": 30_000, "shard_bytes": 20_000, "memory": 20_000}])
def test_matches_brute_force(spark, docs, sizes):
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:5] for r in remove_repeats(docs, **sizes).collect()}
    assert [got[r["doc_id"]] for r in rows] == brute([(r["text"] or "").encode() for r in rows], 200)


def test_odd_rows(spark, odd, empty):
    rows = odd.select("doc_id", "text").collect()
    got = Counter(tuple(r)[:5] for r in remove_repeats(odd, shard_bytes=50_000).collect())
    want = Counter((r["doc_id"], *x) for r, x in zip(rows, brute([(r["text"] or "").encode() for r in rows], 200), strict=True))
    assert got == want
    assert remove_repeats(empty).count() == 0


def test_periodic_and_self_repeats(spark):
    rows = [(1, "ab" * 400), (2, "x" * 199), (3, "y" * 200), (4, "z" * 201), (5, "q" * 150 + "".join(map(str, range(200))) + "q" * 150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:5] for r in remove_repeats(df).collect()}
    assert [got[i] for i, _ in rows] == brute([t.encode() for _, t in rows], 200)


def test_frequent_anchors(spark, docs):
    """The same result when most anchors count as frequent, and around a passage that all documents share."""
    passage = " ".join(f"shared{k}" for k in range(60))
    rows = [(k, f"{' '.join(f'own{k}x{j}' for j in range(30))} {passage} {' '.join(f'end{k}x{j}' for j in range(30))}") for k in range(40)]
    for df in (docs, spark.createDataFrame([*rows, (99, "la " * 700), (98, "x" + "la " * 500)], "doc_id long, text string")):
        have = df.select("doc_id", "text").collect()
        got = {r["doc_id"]: tuple(r)[1:5] for r in remove_repeats(df, hot_rows=2, chunk_bytes=20_000, shard_bytes=30_000).collect()}
        assert [got[r["doc_id"]] for r in have] == brute([(r["text"] or "").encode() for r in have], 200)


def test_frequent_limit_does_not_grow_with_the_corpus(spark, monkeypatch):
    """An anchor is split from HOT_ROWS occurrences on, in a corpus of any size."""
    seen = []

    def spy(*args, **kwargs):
        seen.append(kwargs.get("hot", 0))
        return exchange_counts(*args, **kwargs)

    monkeypatch.setattr(suffix_dedup, "exchange_counts", spy)
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 3)
    passage = " ".join(f"shared{k}" for k in range(60))
    rows = [(k, f"{k} {passage} " + "".join(chr(97 + (k * j * j + j) % 26) for j in range(30_000))) for k in range(40)]
    remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=200_000).count()
    assert seen == [3, 0, 0]


@pytest.mark.parametrize("bits", [3, 22])
def test_sieve_holds_every_key_and_changes_no_result(spark, docs, monkeypatch, bits):
    keys = np.random.default_rng(2).integers(-(1 << 63), 1 << 63, 500)
    assert sieve_of(spark.createDataFrame([], "k long"), bits) is None
    sieve = sieve_of(spark.createDataFrame([(int(k),) for k in keys], "k long"), bits)
    assert sifted(sieve, bits, keys.view(np.uint64)).all()
    low = {int(k) & ((1 << bits) - 1) for k in keys}
    assert int(np.unpackbits(sieve).sum()) == len(low)
    monkeypatch.setattr(suffix_dedup, "SIEVE_BITS", bits)
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:5] for r in remove_repeats(docs, hot_rows=6, chunk_bytes=50_000, shard_bytes=30_000).collect()}
    assert [got[r["doc_id"]] for r in rows] == brute([(r["text"] or "").encode() for r in rows], 200)
