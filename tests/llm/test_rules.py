from __future__ import annotations

import itertools
import time
from collections import Counter

import numpy as np
import pytest
from brute import words

from millrace.llm.line_crf import LINE_FEATURES, neighbours, newton, rate_lines, viterbi


def base(text: str | None) -> tuple:
    w = words(text, lower=False)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    cover = {j for k in range(len(w) - 7) if grams[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, dup, len(cover), len(w) < 20 or 100 * len(cover) > 30 * len(w)


@pytest.mark.parametrize("piece", [1, 2, 3, 256])
def test_chain_against_all_paths(piece):
    rng = np.random.default_rng(3)
    first = np.array([0, 4, 4, 5, 13, 20])
    unary, trans = rng.normal(size=(20, 2)), rng.normal(size=(2, 2))
    best = viterbi(unary, trans, first, piece)
    for a, b in itertools.pairwise(first):
        paths = list(itertools.product((0, 1), repeat=b - a))
        score = [sum(unary[a + k, s] for k, s in enumerate(q)) + sum(trans[x, y] for x, y in itertools.pairwise(q)) for q in paths]
        if b > a:
            assert tuple(best[a:b]) == paths[int(np.argmax(score))]


def test_very_many_lines():
    """A document of 400,000 lines takes no step of its own for each line."""
    rng = np.random.default_rng(5)
    unary, trans = rng.normal(size=(400_000, 2)), np.array([[0.5, -0.5], [-0.5, 0.5]])
    began = time.time()
    got = viterbi(unary, trans, np.array([0, 400_000]))
    assert time.time() - began < 20
    score = unary[0].copy()
    for k in range(1, 3000):
        score = (score[:, None] + trans).max(0) + unary[k]
    assert (viterbi(unary[:3000], trans, np.array([0, 3000]), 7) == viterbi(unary[:3000], trans, np.array([0, 3000]), 4000)).all()
    path = viterbi(unary[:3000], trans, np.array([0, 3000]), 7)
    assert np.isclose(unary[np.arange(3000), path].sum() + trans[path[:-1], path[1:]].sum(), score.max()) and len(got) == 400_000


def test_newton_finds_the_most_likely_weights(spark):
    """Sums by partition give the same as one dense solution, where the gradient is null; and neighbours() is the chain's log-odds."""
    rng = np.random.default_rng(2)
    docs = [(float(rng.integers(2)), rng.normal(size=(int(rng.integers(1, 9)), LINE_FEATURES)).astype(np.float32)) for _ in range(60)]
    rows = spark.createDataFrame([(y, bytearray(x.tobytes())) for y, x in docs], "y double, x binary").repartition(5)
    alone = lambda good, x: (x, np.full(len(x), float(good)), np.ones(len(x)))
    theta = newton(rows, alone, LINE_FEATURES, penalty=0.01)
    x, y = np.concatenate([x for _, x in docs]).astype(float), np.concatenate([np.full(len(x), y) for y, x in docs])
    p = 1 / (1 + np.exp(-x @ theta))
    assert np.abs(x.T @ (y - p) / len(y) - 0.01 * theta).max() < 1e-5
    trans, marks = rng.normal(size=4), rng.integers(0, 2, 12)
    chain = lambda m: sum(trans[2 * a + b] for a, b in itertools.pairwise(m))
    for k in range(12):
        one, zero = marks.copy(), marks.copy()
        one[k], zero[k] = 1, 0
        assert np.isclose(neighbours(marks)[k] @ trans, chain(one) - chain(zero))


def test_base_columns(docs, labels, odd, empty):
    for df in (docs, odd):
        want = Counter((r["doc_id"], *base(r["text"])) for r in df.collect())
        got = rate_lines(df, labels).collect()
        assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
        assert not any(r["base_failed"] and r["kept"] for r in got)
        assert all(len(r["line_marks"]) >= 1 for r in got)
    assert rate_lines(empty, labels).count() == 0
    assert all(r["kept"] != r["base_failed"] for r in rate_lines(docs, labels.limit(0)).collect())


def test_verdict_on_held_out(spark):
    from brute import crc

    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = rate_lines(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").filter("not base_failed").collect()
    held = [r for r in rows if crc(r["doc_id"]) % 4 == 2]
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in held]) > 0.9
