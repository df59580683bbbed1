from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm.mixing import mix_sources, pivotal, source_targets


def fill(sizes: list[int], weights, share=1.5, most=2.0) -> list[float]:
    """Resharing by weight, source after source, until none is above its bound."""
    left, target, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        w = sum(weights[k] for k in open_)
        over = [k for k in open_ if left * weights[k] / w > most * sizes[k]]
        if not over:
            for k in open_:
                target[k] = left * weights[k] / w
            break
        for k in over:
            target[k] = most * sizes[k]
            left -= target[k]
            open_.discard(k)
    return target


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), st.floats(0, 1)), max_size=40), st.integers(0, 99))
def test_pivotal_keeps_mass(rows, seed):
    size, p = np.array([float(a) for a, _ in rows]), np.array([b for _, b in rows])
    want, u = float(size @ p) if rows else 0.0, np.random.default_rng(seed).random(len(rows))
    held = pivotal(size, p, u)
    assert sum(0 < x < 1 for x in p) <= 1 and (held >= 0) == any(0 < x < 1 for x in p)
    assert (float(size @ p) if rows else 0.0) == pytest.approx(want, abs=1e-6)


def test_pivotal_keeps_expectation():
    start, total = np.array([0.2, 0.7, 0.5, 0.9]), np.zeros(4)
    for seed in range(4000):
        p = start.copy()
        u = np.random.default_rng(seed).random(5)
        held = pivotal(np.array([3.0, 1.0, 5.0, 2.0]), p, u)
        if held >= 0:
            p[held] = float(u[-1] < p[held])
        total += p
    assert np.allclose(total / 4000, start, atol=0.03)


@pytest.mark.parametrize("sizes", [[10, 20, 30], [1, 1000, 1000, 1000], [0, 5, 5], [7], [100, 1, 1, 1, 1, 1, 90]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{k:02d}", n, 1) for k, n in enumerate(sizes)], "source string, source_size long, n long")
    got = [r["target"] for r in source_targets(df).orderBy("source").collect()]
    assert got == pytest.approx(fill(sizes, [(5, 2, 1)[k % 3] for k in range(len(sizes))]))


@pytest.mark.parametrize("tree", [{}, {"leaf_rows": 3, "fan_in": 2}])
def test_mix(docs, tree):
    rows = mix_sources(docs, **tree).collect()
    text = {r["doc_id"]: (r["source"], len(words(r["text"]))) for r in docs.collect()}
    names = sorted({s for s, _ in text.values()})
    sizes = [sum(n for s, n in text.values() if s == name) for name in names]
    want = dict(zip(names, fill(sizes, [(5, 2, 1)[k % 3] for k in range(len(names))]), strict=True))
    taken, most = defaultdict(int), defaultdict(int)
    for r in rows:
        source, n = text[r["doc_id"]]
        assert r["size"] == n and r["taken"] == r["copies"] * n <= 2 * n and r["target"] == pytest.approx(want[source])
        taken[source] += r["taken"]
        most[source] = max(most[source], n)
    assert all(abs(taken[s] - want[s]) <= most[s] for s in names)
    again = mix_sources(docs.repartition(7), **tree)
    assert Counter(tuple(r) for r in again.collect()) == Counter(tuple(r) for r in rows)


def test_odd_rows(odd, empty):
    rows = mix_sources(odd, leaf_rows=2, fan_in=2).collect()
    assert len(rows) == odd.count() and all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert mix_sources(empty).count() == 0
    only_empty = mix_sources(odd.withColumn("text", F.lit("")))
    assert {(r["target"], r["taken"]) for r in only_empty.collect()} == {(0.0, 0)}
