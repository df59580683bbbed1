from __future__ import annotations

import numpy as np
from brute import crc

from millrace.llm.quality_rff import CLIP, N_FEATURES, RIDGE, WIDTH, features_of, isotonic, score_quality


def test_isotonic_is_monotone_and_least_squares():
    x, y = np.array([1, 2, 3, 4, 5.0]), np.array([0, 1, 0, 1, 1.0])
    knots, levels = isotonic(x, y)
    assert np.allclose(np.interp(x, knots, levels), [0, 0.5, 0.5, 1, 1])
    assert len(isotonic(np.zeros(0), np.zeros(0))[0]) == 0


def test_against_a_dense_solution(spark, docs, labels):
    """Features, ridge by normal equations and calibration equal one dense numpy solution over the same rows."""
    import pyarrow as pa

    want = {r["doc_id"]: r["quality"] for r in labels.collect() if crc(r["doc_id"]) % 4 != 2}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    x = features_of(pa.array([t for _, t in rows]))
    learn = np.array([i in want for i, _ in rows])
    y = np.array([want.get(i, 0) for i, _ in rows], float)[learn]
    mean, scale = x[learn].mean(0), x[learn].std(0)
    z = np.clip((x - mean) / np.where(scale > 1e-9, scale, 1.0), -CLIP, CLIP)
    rng = np.random.default_rng(11)
    weights, phase = rng.normal(0, 1 / WIDTH, (x.shape[1], N_FEATURES)), rng.uniform(0, 2 * np.pi, N_FEATURES)
    phi = np.concatenate([np.cos(z @ weights + phase) * np.sqrt(2 / N_FEATURES), np.ones((len(z), 1))], 1)
    ridge = np.full(N_FEATURES + 1, RIDGE)
    ridge[-1] = 1e-9
    beta = np.linalg.lstsq(np.concatenate([phi[learn], np.diag(np.sqrt(ridge))]), np.concatenate([y, np.zeros(N_FEATURES + 1)]), rcond=None)[0]
    raw = phi @ beta
    order = np.argsort(raw[learn], kind="stable")
    fit = y[order].copy()
    blocks = [[v, 1, k, k] for k, v in enumerate(fit)]
    k = 0
    while k < len(blocks) - 1:
        if blocks[k][0] >= blocks[k + 1][0]:
            (a, n, lo, _), (b, m, _, hi) = blocks[k], blocks[k + 1]
            blocks[k : k + 2] = [[(a * n + b * m) / (n + m), n + m, lo, hi]]
            k = max(0, k - 1)
        else:
            k += 1
    knots = np.array([raw[learn][order][j] for b in blocks for j in b[2:]])
    score = np.interp(raw, knots, np.repeat([b[0] for b in blocks], 2))
    got = {r["doc_id"]: r["score"] for r in score_quality(docs, labels).collect()}
    assert np.allclose([got[i] for i, _ in rows], score, atol=1e-4)


def test_repeated_rows_stay_within_the_bound(spark):
    from millrace.llm.quality_rff import labelled_sample, one_each

    docs = spark.createDataFrame([(k % 5, f"text {k} of a document") for k in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(9)], "doc_id long, quality int")
    sample = labelled_sample(docs, labels, "quality", 3, 4, 2)
    described = sample.selectExpr("label_id", "y", "length(text) as x")
    assert described.count() > 3 and one_each(described, 4).count() <= 3


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = score_quality(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert held and all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_score_depends_on_text_alone(spark, docs, labels):
    from pyspark.sql import functions as F

    moved = docs.select((F.col("doc_id") + 10**6).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit("zz").alias("source"))
    both = docs.select("doc_id", "text", "lang", "source").unionByName(moved)
    got = {r["doc_id"]: r["score"] for r in score_quality(both, labels).collect()}
    assert all(got[k] == got[k + 10**6] for k in got if k < 10**6)


def test_odd_rows_and_missing_labels(spark, odd, empty, labels):
    got = score_quality(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in score_quality(odd, labels.limit(0)).collect()} == {0.5}
    assert score_quality(empty, labels).count() == 0
    doubled = labels.select("doc_id", "quality").union(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int"))
    assert score_quality(odd, doubled, keep=("doc_id", "text", "score")).columns[:3] == ["doc_id", "text", "score"]


def test_features_are_finite():
    import pyarrow as pa

    x = features_of(pa.array([None, "", "\n\n", "a", "A" * 10_000, "é" * 50, "| " * 99]))
    assert x.shape[0] == 7 and np.isfinite(x).all()
