"""Quality scores: random Fourier features of document statistics, ridge by normal equations, isotonic calibration.

The features cos(W x + b) with Gaussian W approximate a Gaussian kernel, so a
linear model over them is a kernel ridge regression whose size does not depend on
the number of rows.  Each partition of the labelled sample adds up its share of
the normal equations, and the sums are solved once.  Pool-adjacent-violators on
the fitted scores gives a monotone map to the share of label 1.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import blocks, crc_mod, crc_text, materialize, utf8_column
from .textstats import DOC_FEATURES, TextStats, doc_features

#: Random features, kernel width in standard deviations, ridge penalty.
N_FEATURES, WIDTH, RIDGE = 256, 3.0, 1.0
#: Labelled rows that are learnt from at most, and partitions that hold them.
SAMPLE_ROWS, SAMPLE_PARTS = 20_000, 16
#: Statistics are clipped to so many standard deviations.
CLIP = 6.0


def features_of(col: pa.Array) -> np.ndarray:
    data, off = utf8_column(col)
    out = [doc_features(TextStats(data[off[a] : off[b]], off[a : b + 1] - off[a])) for a, b in blocks(off)]
    return np.concatenate(out) if out else np.zeros((0, len(DOC_FEATURES)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, bound: int, held_mod: int, held_rest: int, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id") -> DataFrame:
    """(label_id, y, text) of at most `bound` labelled ids outside the held-out fold, chosen by hash.

    A label that occurs more than once for an id counts once, as its mean; null labels
    do not count.  Rows that share an id all come out; one_each() bounds the rows.
    """
    ids = labels.select(F.col(label_id_col).alias("label_id"), F.col(label_col).cast("double").alias("y")).filter(F.col("y").isNotNull() & F.col("label_id").isNotNull())
    ids = ids.filter(crc_mod("label_id", held_mod) != held_rest).groupBy("label_id").agg(F.avg("y").alias("y"))
    ids = ids.orderBy(F.xxhash64("label_id"), "label_id").limit(bound)
    # the limit bounds what is broadcast: two numbers for each row
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.join(F.broadcast(ids), rows["doc_id"] == ids["label_id"]).select("label_id", "y", "text")


def one_each(described: DataFrame, parts: int) -> DataFrame:
    """(y, x) from (label_id, y, x): of rows that share an id the one with the smallest x, so there are no more rows than ids."""
    return described.groupBy("label_id").agg(F.max("y").alias("y"), F.min("x").alias("x")).select("y", "x").coalesce(parts)


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        phi = np.cos(z @ self.weights + self.phase) * np.sqrt(2.0 / len(self.phase))
        return np.concatenate([phi, np.ones((len(x), 1))], 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.levels) if len(self.knots) else np.full(len(x), 0.5)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: ascending knots and the level at each."""
    order = np.argsort(x, kind="stable")
    xs, first = np.unique(x[order], return_index=True)
    size = np.diff(np.append(first, len(x))).astype(float)
    mean = np.add.reduceat(y[order], first) / size if len(x) else size
    stack: list[list[float]] = []  # mean, weight, first knot, last knot
    for k in range(len(xs)):
        stack.append([mean[k], size[k], xs[k], xs[k]])
        while len(stack) > 1 and stack[-2][0] >= stack[-1][0]:
            m, w, _, hi = stack.pop()
            top = stack[-1]
            top[0], top[1], top[3] = (top[0] * top[1] + m * w) / (top[1] + w), top[1] + w, hi
    return np.array([v for s in stack for v in (s[2], s[3])]), np.array([s[0] for s in stack for _ in "ab"])


def fit(sample: DataFrame, n_features: int = N_FEATURES, width: float = WIDTH, ridge: float = RIDGE, seed: int = 11, parts: int = SAMPLE_PARTS) -> Model:
    """Learn from (label_id, y, text) rows; the ids are bounded by the caller, and so is all that reaches the driver."""

    def describe(batches):
        for b in batches:
            x = features_of(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("label_id"), b.column("y"), pa.array(list(x), pa.list_(pa.float64()))], names=["label_id", "y", "x"])

    kind = sample.schema["label_id"].dataType.simpleString()
    rows = materialize(one_each(sample.mapInArrow(describe, f"label_id {kind}, y double, x array<double>"), parts), "features")
    n = len(DOC_FEATURES)
    cols = [F.element_at("x", k + 1) for k in range(n)]
    got = rows.agg(F.count("y"), *[F.avg(c) for c in cols], *[F.stddev_pop(c) for c in cols]).first()
    mean = np.array([v or 0.0 for v in got[1 : 1 + n]], float)
    scale = np.array([v or 0.0 for v in got[1 + n :]], float)
    rng = np.random.default_rng(seed)
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), rng.normal(0, 1 / width, (n, n_features)), rng.uniform(0, 2 * np.pi, n_features), np.zeros(n_features + 1), np.zeros(0), np.zeros(0))
    if not got[0]:
        return model
    d = n_features + 1

    def matrix(b) -> np.ndarray:
        return np.array(b.column("x").to_pylist(), float).reshape(-1, n)

    def sums(batches):
        a, c = np.zeros((d, d)), np.zeros(d)
        for b in batches:
            phi = model.lift(matrix(b))
            a += phi.T @ phi
            c += phi.T @ np.asarray(b.column("y"), float)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()), pa.array([c.tobytes()], pa.binary())], names=["a", "c"])

    a, c = np.zeros((d, d)), np.zeros(d)
    for r in rows.mapInArrow(sums, "a binary, c binary").collect():  # one row for each of at most `parts` partitions
        a += np.frombuffer(r["a"]).reshape(d, d)
        c += np.frombuffer(r["c"])
    penalty = np.full(d, ridge)
    penalty[-1] = 1e-9  # the intercept is free
    model = model._replace(beta=np.linalg.solve(a + np.diag(penalty), c))

    def fitted(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(model.raw(matrix(b)))], names=["y", "s"])

    pairs = np.array([tuple(r) for r in rows.mapInArrow(fitted, "y double, s double").collect()])
    knots, levels = isotonic(pairs[:, 1], pairs[:, 0])
    return model._replace(knots=knots, levels=levels)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held_mod: int = 4, held_rest: int = 2, threshold: float = 0.7, bound: int = SAMPLE_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted for each row, and the columns named in keep.

    Rows whose crc32(id as text) mod held_mod is held_rest are not learnt from.
    Null and empty texts are described by zeros and get the score of that point.
    Repeated rows are scored alike.  An empty table gives no rows; without labels
    every score is 0.5.
    """
    model = fit(labelled_sample(docs, labels, label_col, bound, held_mod, held_rest, id_col, text_col))
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("__text"), F.struct(*keep).alias("__kept") if keep else F.lit(None).cast("int").alias("__kept"))
    given = {f.name: f.dataType.simpleString() for f in picked.schema.fields}

    def run(batches):
        for b in batches:
            score = np.clip(model.score(features_of(b.column("__text"))), 0.0, 1.0)
            held = [crc_text(x) % held_mod == held_rest for x in b.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("__kept"), pa.array(held, pa.bool_()), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "__kept", "held_out", "score", "predicted"])

    out = picked.mapInArrow(run, f"doc_id {given['doc_id']}, __kept {given['__kept']}, held_out boolean, score double, predicted int")
    return out.select(*([F.col("__kept")[k].alias(k) for k in keep] if keep else ["doc_id"]), "held_out", "score", "predicted")


def op3_quality(spark, sf_dir: str) -> DataFrame:
    from .base import table

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
