"""Quality rules: a linear-chain conditional random field marks lines as content or boilerplate.

The field is learnt from a bounded sample of labelled documents.  Lines of good
documents are content; of the lines of bad documents, a first field without
transitions tells which look like boilerplate, and the chain is learnt from those
marks, by its pseudo-likelihood: each line's mark given its features and the marks of
its neighbours.  That is concave, so a few Newton steps find it; each step adds up
gradient and curvature by partition, and only those sums reach the driver.  Viterbi
decoding marks the lines of every document, and the share of code points in content
lines decides whether a document is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import blocks, materialize, table, utf8_column
from .quality_rff import labelled_sample, one_each
from .textstats import TextStats

#: Labelled documents that are learnt from at most; content share from which a document stays.
SAMPLE_ROWS, CONTENT_SHARE = 3000, 0.5
#: A document fails with fewer words, or with more than this percentage of repeated words.
LEAST_WORDS, MOST_REPEAT = 20, 30
LINE_FEATURES = 11
#: Partitions of the sample, and lines of a piece that is decoded on its own.
PARTS, PIECE = 16, 256


def line_features(s: TextStats) -> np.ndarray:
    c = {k: v.astype(float) for k, v in s.line_counts.items()}
    one = lambda x: np.maximum(x, 1.0)
    solid, words = one(c["points"] - c["space"]), one(s.line_words.astype(float))
    letters = one(c["upper"] + c["lower"] + c["wide"])
    return np.stack(
        [np.ones(len(words)), np.minimum(c["upper"] / letters, 1.0), np.sqrt(c["symbol"] / solid), np.sqrt(c["shout"] / solid), c["digit"] / solid, c["stop"] / solid, np.minimum(solid / words / 10, 2.0), np.minimum(np.log1p(s.line_words) / 5, 2.0), s.line_dup.astype(float), s.line_echo / words, (s.line_words == 0).astype(float)], 1
    )


def grid(first: np.ndarray) -> list[np.ndarray]:
    """For each place in a document, the lines there: step t holds line t of every document that has one, longest first."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    alive = np.searchsorted(-size[order], -np.arange(size.max(initial=0)), "left")
    return [first[:-1][order[:k]] + t for t, k in enumerate(alive)]


def neighbours(y: np.ndarray) -> np.ndarray:
    """What the marks around each line add to its own mark's log-odds, by transition: columns for 0-0, 0-1, 1-0 and 1-1."""
    out = np.zeros((len(y), 4))
    after, before = np.arange(1, len(y)), np.arange(len(y) - 1)
    out[after, 2 * y[:-1] + 1] += 1.0
    out[after, 2 * y[:-1]] -= 1.0
    out[before, 2 + y[1:]] += 1.0
    out[before, y[1:]] -= 1.0
    return out


def newton(rows: DataFrame, design, d: int, penalty: float = 1e-4, most: int = 25) -> np.ndarray:
    """Weights of a logistic regression over (y, x) rows; design(good, x) gives a document's (features, marks, weights)."""
    theta = np.zeros(d)
    for _ in range(most):
        now = theta.copy()

        def sums(batches, now=now):
            total, grad, curve = 0.0, np.zeros(d), np.zeros((d, d))
            for b in batches:
                for y, raw in zip(b.column("y").to_pylist(), b.column("x").to_pylist(), strict=True):
                    z, mark, weight = design(y >= 0.5, np.frombuffer(raw, np.float32).reshape(-1, LINE_FEATURES).astype(float))
                    p = 1.0 / (1.0 + np.exp(-np.clip(z @ now, -30.0, 30.0)))
                    grad += z.T @ (weight * (mark - p))
                    curve += (z * (weight * p * (1.0 - p))[:, None]).T @ z
                    total += weight.sum()
            yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([grad.tobytes()], pa.binary()), pa.array([curve.tobytes()], pa.binary())], names=["n", "g", "h"])

        total, grad, curve = 0.0, np.zeros(d), np.zeros((d, d))
        for r in sorted(rows.mapInArrow(sums, "n double, g binary, h binary").collect(), key=lambda r: r["g"]):  # one row for each of at most PARTS partitions
            total, grad, curve = total + r["n"], grad + np.frombuffer(r["g"]), curve + np.frombuffer(r["h"]).reshape(d, d)
        if not total:
            break
        step = np.linalg.solve(curve / total + penalty * np.eye(d), grad / total - penalty * theta)
        theta = theta + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-3:
            break
    return theta


def viterbi(unary: np.ndarray, trans: np.ndarray, first: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """The best state of each line, for all documents of a block at once.

    Documents are cut into pieces of at most `piece` lines, which are solved side by
    side for either state before them; then the pieces of each document are joined.
    So the steps do not grow with the lines of a document, but with its pieces.
    """
    size = np.diff(first)
    n_pieces = -(-size // piece)
    of = np.cumsum(n_pieces) - n_pieces  # first piece of each document
    head = np.zeros(int(n_pieces.sum()), bool)
    head[of[n_pieces > 0]] = True
    starts = np.repeat(first[:-1], n_pieces) + (np.arange(len(head)) - np.repeat(of, n_pieces)) * piece
    bounds = np.append(starts, first[-1])
    best = np.repeat(unary[:, None, :], 2, 1)  # line, state before the piece, state
    best[starts[~head]] += trans[None]
    came = np.zeros(best.shape, np.int8)
    steps = grid(bounds)
    for a, b in zip(steps, steps[1:], strict=False):
        paths = best[a[: len(b)]][:, :, :, None] + trans[None, None]
        came[b] = paths.argmax(2)
        best[b] += paths.max(2)
    ends = bounds[1:] - 1
    whole, by = best[ends], np.zeros((len(head), 2), np.int8)
    score = whole[:, 0, :].copy()
    chain = grid(np.append(of, len(head)))
    for a, b in zip(chain, chain[1:], strict=False):
        paths = score[a[: len(b)]][:, :, None] + whole[b]
        by[b] = paths.argmax(1)
        score[b] = paths.max(1)
    last = score.argmax(1)  # right for each document's last piece; the others follow from it
    before = np.zeros(len(head), np.int64)
    for a, b in reversed(list(zip(chain, chain[1:], strict=False))):
        a = a[: len(b)]
        before[b] = by[b, last[b]]
        last[a] = before[b]
    state = np.zeros(len(unary), np.int64)
    state[ends] = last
    entry = np.repeat(before, np.diff(bounds))
    for a, b in reversed(list(zip(steps, steps[1:], strict=False))):
        a = a[: len(b)]
        state[a] = came[b, entry[b], state[b]]
    return state


def stats_of(data: np.ndarray, off: np.ndarray, a: int, b: int) -> TextStats:
    return TextStats(data[off[a] : off[b]], off[a : b + 1] - off[a])


def fit(sample: DataFrame, parts: int = PARTS) -> tuple[np.ndarray, np.ndarray]:
    """Learn a field from (label_id, y, text) rows, whose ids the caller bounds; without rows of both kinds every line is content."""

    def describe(batches):
        for b in batches:
            data, off = utf8_column(b.column("text"))
            for lo, hi in blocks(off):
                s = stats_of(data, off, lo, hi)
                x = line_features(s).astype(np.float32)
                yield pa.RecordBatch.from_arrays([b.column("label_id").slice(lo, hi - lo), b.column("y").slice(lo, hi - lo), pa.array([x[p:q].tobytes() for p, q in zip(s.line_first, s.line_first[1:], strict=False)], pa.binary())], names=["label_id", "y", "x"])

    kind = sample.schema["label_id"].dataType.simpleString()
    rows = materialize(one_each(sample.mapInArrow(describe, f"label_id {kind}, y double, x binary"), parts), "lines")
    lines = {r["good"]: r["n"] for r in rows.groupBy((F.col("y") >= 0.5).alias("good")).agg((F.sum(F.length("x")) / (4 * LINE_FEATURES)).alias("n")).collect()}
    w = np.zeros((LINE_FEATURES, 2))
    if len(lines) < 2:
        w[0, 1] = 1.0
        return w, np.zeros((2, 2))

    def alone(good: bool, x: np.ndarray):  # both marks weigh alike, however many lines have them
        return x, np.full(len(x), float(good)), np.full(len(x), 1.0 / lines[good])

    single = newton(rows, alone, LINE_FEATURES)

    def chained(good: bool, x: np.ndarray):
        y = np.ones(len(x), np.int64) if good else (x @ single > 0).astype(np.int64)
        return np.concatenate([x, neighbours(y)], 1), y.astype(float), np.ones(len(x))

    theta = newton(rows, chained, LINE_FEATURES + 4)
    w[:, 1] = theta[:LINE_FEATURES]
    return w, theta[LINE_FEATURES:].reshape(2, 2)


def rate_lines(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held_mod: int = 4, held_rest: int = 2, bound: int = SAMPLE_ROWS, share: float = CONTENT_SHARE, spans: bool = True) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept (and line_marks).

    line_marks is 1 for each content line and 0 for each boilerplate line.  Null
    and empty texts have no words and fail the base rule.  Repeated rows are
    rated alike; an empty table gives no rows.
    """
    w, trans = fit(labelled_sample(docs, labels, label_col, bound, held_mod, held_rest, id_col, text_col))
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"] + ["line_marks"] * spans

    def run(batches):
        for b in batches:
            data, off = utf8_column(b.column("text"))
            for lo, hi in blocks(off):
                s = stats_of(data, off, lo, hi)
                state = viterbi(line_features(s) @ w, trans, s.line_first)
                solid = s.line_counts["points"] - s.line_counts["space"]
                chars = s.per_doc(solid)
                content = s.per_doc(solid * state) / np.maximum(chars, 1)
                failed = (s.doc_words < LEAST_WORDS) | (100 * s.repeat > MOST_REPEAT * s.doc_words)
                cols = [b.column("doc_id").slice(lo, hi - lo)] + [pa.array(v) for v in (s.doc_words.astype(np.int64), chars, s.per_doc(s.line_counts["symbol"]), s.per_doc(s.line_dup.astype(np.int64)), s.repeat, failed, content, ~failed & (content >= share))]
                if spans:
                    cols.append(pa.ListArray.from_arrays(pa.array(s.line_first, pa.int32()), pa.array(state, pa.int8())))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean" + ", line_marks array<tinyint>" * spans)


def op6_rules(spark, sf_dir: str) -> DataFrame:
    return rate_lines(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), spans=False)
