from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
import zstandard
from brute import crc, words

from millrace.llm.lm_score import STRENGTH, Automaton, Chunk, score_texts


def brute(rows, order: int, strength: tuple[float, ...]):
    stream = [(i, ["<", *words(t), None]) for i, t in rows]
    count, docs = [Counter() for _ in range(order + 1)], 0
    for i, w in stream:
        if crc("" if i is None else i) % 7 != 2:
            docs += 1
            for k in range(1, order + 1):
                count[k].update(tuple(w[j : j + k]) for j in range(len(w) - k + 1) if k > 1 or j)
    n, v = sum(count[1].values()), len(count[1])

    def p(w, j, k):
        """Probability of token j after the k - 1 tokens before it."""
        if k == 1:
            return (count[1][(w[j],)] + 1) / (n + v + 1)
        below = p(w, j, k - 1)
        if j - k + 1 < 0:
            return below
        context = tuple(w[j - k + 1 : j])
        c = docs if context == ("<",) else count[k - 1][context]
        s = strength[min(k - 1, len(strength)) - 1]
        return (count[k][tuple(w[j - k + 1 : j + 1])] + s * below) / (c + s)

    out = []
    for _, w in stream:
        at = range(1, len(w))
        out.append((len(at), sum(count[1][(w[j],)] > 0 for j in at), n, sum(math.log10(p(w, j, 1)) for j in at), sum(math.log10(p(w, j, order)) for j in at)))
    return out


@pytest.mark.parametrize(("order", "strength", "sizes"), [(4, STRENGTH, {}), (2, (100.0,), {}), (3, (5.0, 1.0), {"chunk_bytes": 9_000, "range_bytes": 20_000}), (5, (7.0, 3.0, 0.5), {})])
def test_matches_brute_force(docs, order, strength, sizes):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r for r in score_texts(docs, order=order, strength=strength, spare_bits=40, **sizes).collect()}
    for (i, _), want in zip(rows, brute(rows, order, strength), strict=True):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3] and r["held_out"] == (crc(i) % 7 == 2)
        assert r["base_score"] == pytest.approx(want[3], abs=1e-6) and r["score"] == pytest.approx(want[4], abs=1e-6)


def test_traversal_carries_the_state():
    """Every lane length gives the same, and each state is the longest seen context of what was read."""
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 12, n)) for n in (0, 1, 2, 90, 300)]
    raw = "".join(texts).encode()
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    chunk = Chunk(bytes([0, 0, 0, 0, 1]), off.tobytes(), zstandard.compress(raw), 4)
    counts = [c.astype(np.uint64) for _, c in chunk.grams]
    n, v = int(counts[0].sum()), int((counts[0] > 0).sum())
    auto = Automaton(chunk, counts, 4, n, v, (3.0, 2.0, 1.0))
    whole = auto.read(chunk)
    assert all(np.allclose(auto.read(chunk, lane), whole) for lane in (1, 2, 3, 7, 64))
    assert (auto.level[auto.fail[2:]] < auto.level[2:]).all() and auto.level.max() == 3
    got = [float(x) for x in np.bincount(chunk.doc, whole, chunk.n_docs)]
    ids = [k for k in range(200) if crc(k) % 7 != 2][:4] + [next(k for k in range(200) if crc(k) % 7 == 2)]
    assert got == pytest.approx([x[4] for x in brute(list(zip(ids, texts, strict=True)), 4, (3.0, 2.0, 1.0))])


def test_beats_the_base_on_held_out(spark):
    got = [r for r in score_texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_probabilities_of_a_state_sum_to_one(spark):
    """All one-word texts, with an unseen word standing for all unseen ones, after the begin mark."""
    ids = [k for k in range(50) if crc(k) % 7 != 2][:3]
    rows = list(zip(ids, ("a b a", "a c", "b a"), strict=True))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    uni = Counter(x for _, t in rows for x in [*words(t), None])
    n, v = sum(uni.values()), len(uni)
    bi = Counter((h, x) for _, t in rows for h, x in zip(["<", *words(t)], [*words(t), None], strict=True))
    mass = sum((bi["a", x] + 100 * (uni[x] + 1) / (n + v + 1)) / (uni["a"] + 100) for x in uni) + 100 / (n + v + 1) / (uni["a"] + 100)
    assert mass == pytest.approx(1.0)
    assert score_texts(df).count() == 3


def test_higher_order_and_odd_rows(odd, empty):
    got = score_texts(odd, order=3, chunk_bytes=50_000).collect()
    assert len(got) == odd.count() and all(math.isfinite(r["score"]) for r in got)
    assert [r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 3)] == [1, 1, 1]
    assert score_texts(empty).count() == 0
