"""Language-model scoring with a weighted backoff automaton.

Counts of all n-grams of the training documents are gathered in ranges of their
64-bit hashes.  Documents travel in chunks: a chunk asks each range once for the
n-grams that it holds, with its own training counts, and gets the counts of the
whole corpus back, so no table of n-grams is broadcast or collected and a
frequent n-gram costs one entry for each chunk, however often it occurs.

From the answers a chunk builds the part of the automaton that its texts can
reach.  A state is a context that was seen in training; an arc from a state reads a
word that was seen after it, carries the log-probability of the smoothed n-gram and
leads to the longest context of the next word; where there is no arc, a failure arc
leads to the state of the shorter context and carries the backoff weight.  With the
Dirichlet prior `strength` k of the order,

    p(w | h) = (c(h w) + k p(w | h')) / (c(h) + k),

so an arc weighs log p(w | h) and the failure arc of h weighs log k / (c(h) + k).
The root reads every word with the base probability (c + 1) / (N + V + 1), and the
probabilities of a state sum to one.  Texts are read once from left to right, all of
a chunk side by side; a long text is cut into lanes, and as a state knows no more
than the last `order` - 1 words, a lane that begins that much earlier is in the right
state where it begins to count.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Words, blocks, crc_text, materialize, mix64, ngram_hashes, utf8_column
from .counting import RANGE_BYTES, cell_bounds, pack, unpack

#: Longest n-gram, and the strength of the prior for n-grams of two words, of three and so on (the last for all longer ones).
ORDER, STRENGTH = 4, (300.0, 100.0, 10.0)
#: Words of a lane, and bits of the hashes of n-grams of two words and more beyond those that number the bytes of the corpus:
#: with 10, one such n-gram in some thousands is counted with another one.  Single words keep all 64.
LANE, SPARE_BITS = 512, 10
#: Bytes of text in a chunk, whose n-grams of all orders are held at once.
CHUNK_BYTES = 6 << 20
_BEGIN, _END = mix64(np.array([1 << 40, 1 << 41], np.uint64))


def chunks(df: DataFrame, id_col: str, text_col: str, held_mod: int, held_rest: int, chunk_bytes: int) -> DataFrame:
    """One row for each chunk of documents: chunk, n_bytes, ids, held, offsets and the compressed texts."""
    picked = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()

    def run(batches):
        k = TaskContext.get().partitionId() << 32
        for b in batches:
            data, off = utf8_column(b.column("text"))
            for lo, hi in blocks(off, chunk_bytes):
                ids = b.column("doc_id").slice(lo, hi - lo)
                held = np.array([crc_text(x) % held_mod == held_rest for x in ids.to_pylist()], np.uint8)
                raw = zstandard.compress(data[off[lo] : off[hi]].tobytes(), 3)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int64()), pa.array([int(off[hi] - off[lo])], pa.int64()), pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), ids), pa.array([held.tobytes()], pa.binary()), pa.array([(off[lo : hi + 1] - off[lo]).tobytes()], pa.binary()), pa.array([raw], pa.binary())],
                    names=["chunk", "n_bytes", "ids", "held", "offsets", "texts"],
                )
                k += 1

    return picked.mapInArrow(run, f"chunk long, n_bytes long, ids array<{kind}>, held binary, offsets binary, texts binary")


class Chunk:
    """The token streams of a chunk: every document's words between a begin and an end mark, and its distinct n-grams of each order."""

    def __init__(self, held: bytes, offsets: bytes, texts: bytes, order: int, drop: int = 0):
        self.held = np.frombuffer(held, np.uint8).astype(bool)
        off = np.frombuffer(offsets, np.int64)
        words = Words(np.frombuffer(zstandard.decompress(texts), np.uint8), off)
        self.n_docs = len(off) - 1
        n = np.diff(words.first) + 2
        self.first = np.concatenate([[0], np.cumsum(n)])
        stream = np.zeros(self.first[-1], np.uint64)
        inner = np.ones(len(stream), bool)
        stream[self.first[:-1]], stream[self.first[1:] - 1] = _BEGIN, _END
        inner[self.first[:-1]] = inner[self.first[1:] - 1] = False
        stream[inner] = words.hash
        read = np.ones(len(stream), bool)
        read[self.first[:-1]] = False  # all tokens but the begin marks
        self.doc = np.repeat(np.arange(self.n_docs), n - 1)
        self.lead = self.first[:-1] - np.arange(self.n_docs)  # where each document's tokens begin among those read
        at = np.flatnonzero(read)
        self.grams = []  # by order: sorted distinct hashes, training counts
        self.place = []  # by order: for each token read, index of the n-gram that ends there, -1 if it would begin before the text
        self.context = []  # by order: the same for the n-gram without its last token
        train = ~self.held
        for k in range(1, order + 1):
            if k == 1:
                value, doc, ends = stream[at], self.doc, at
            else:
                value, doc = ngram_hashes(stream, self.first, k)
                value = value >> np.uint64(drop) << np.uint64(drop)
                counts = np.maximum(n - k + 1, 0)
                ends = np.arange(len(value)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(self.first[:-1], counts) + k - 1
            distinct, inverse = np.unique(value, return_inverse=True)
            self.grams.append((distinct, np.bincount(inverse[train[doc]], minlength=len(distinct)).astype(np.uint32)))
            full = np.full(len(stream), -1, np.int32)
            full[ends] = inverse
            self.place.append(full[at])
            self.context.append(full[at - 1])

    def cells(self, k: int, n_ranges: int) -> np.ndarray:
        """Where each range of hashes begins among the sorted distinct n-grams of order k + 1."""
        return cell_bounds(self.grams[k][0], n_ranges)


class Automaton:
    """States, arcs and failure arcs of the n-grams of a chunk, by their corpus counts.

    State 0 is the root; the others are the seen n-grams of up to order - 1 tokens and,
    for the begin mark, one before which nothing is known.  An arc has the number of
    its n-gram, counted through all orders, as the state before it and the token it
    reads are the n-gram.
    """

    def __init__(self, chunk: Chunk, counts: list[np.ndarray], train_docs: int, n: int, v: int, strength: tuple[float, ...]):
        order = len(counts)
        base = np.concatenate([[0], np.cumsum([len(c) for c in counts])])
        strengths = [strength[min(k, len(strength)) - 1] for k in range(1, order + 1)]
        self.weight = [np.log10((counts[0] + 1.0) / (n + v + 1.0))]
        self.seen = [np.ones(len(counts[0]), bool)]  # the root reads every token
        number = np.full(base[-1] + 1, -1, np.int32)  # n-gram -> state
        self.fail, self.cost, self.level = [np.array([-1, 0])], [np.array([0.0, np.log10(strengths[0] / (train_docs + strengths[0]))])], [np.array([0, 1])]
        states = 2  # the root and the begin mark
        for k in range(order):
            c = counts[k].astype(float)
            grams = chunk.grams[k][0]
            if k:
                # the n-gram without its first and without its last token
                tail, head = np.full(len(grams), -1), np.full(len(grams), -1)
                here = chunk.place[k] >= 0
                tail[chunk.place[k][here]] = chunk.place[k - 1][here]
                head[chunk.place[k][here]] = chunk.context[k - 1][here]
                context = np.where(head >= 0, np.append(counts[k - 1], 0)[head], train_docs if k == 1 else 0).astype(float)
                s = strengths[k - 1]
                self.seen.append(c > 0)
                with np.errstate(divide="ignore"):
                    self.weight.append(np.log10((c + s * 10.0 ** self.weight[k - 1][tail]) / (context + s)))
            if k < order - 1:
                live = np.flatnonzero(c > 0)
                number[base[k] + live] = np.arange(states, states + len(live))
                states += len(live)
                s = strengths[k]
                self.fail.append(np.zeros(len(live), np.int64) if k == 0 else number[base[k - 1] + tail[live]])
                self.cost.append(np.log10(s / (c[live] + s)))
                self.level.append(np.full(len(live), k + 1))
        self.fail, self.cost, self.level = (np.concatenate(x) for x in (self.fail, self.cost, self.level))
        self.base, self.order = base, order
        # by arc: where it leads, the longest seen context that ends with its token
        self.target = np.zeros(base[-1], np.int32)
        for k in range(order):
            own = number[base[k] : base[k + 1]] if k < order - 1 else np.full(len(counts[k]), -1)
            if k:
                short = np.zeros(len(counts[k]), np.int32)
                here = chunk.place[k] >= 0
                short[chunk.place[k][here]] = self.target[base[k - 1] + chunk.place[k - 1][here]]
                own = np.where(own >= 0, own, short)
            self.target[base[k] : base[k + 1]] = np.maximum(own, 0)
        self.weight, self.seen = np.concatenate(self.weight), np.concatenate(self.seen)

    def read(self, chunk: Chunk, lane: int = LANE) -> np.ndarray:
        """Log-probability of each token, by one traversal that carries the state."""
        arcs = np.stack([np.where(p >= 0, np.int32(b) + p, np.int32(-1)) for p, b in zip(chunk.place, self.base, strict=False)])
        size = np.diff(chunk.first) - 1
        lanes = -(-size // lane)
        doc = np.repeat(np.arange(chunk.n_docs), lanes)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        begin, end = chunk.lead[doc] + nth * lane, chunk.lead[doc] + np.minimum((nth + 1) * lane, size[doc])
        warm = np.minimum(nth * lane, self.order - 1)  # tokens read ahead to be in the right state
        at = begin - warm
        state = np.where(at == chunk.lead[doc], 1, 0)  # the begin mark, or inside a text the root
        out = np.zeros(arcs.shape[1])
        by = np.argsort(-(end - at), kind="stable")
        at, end, begin, state = at[by], end[by], begin[by], state[by]
        length = end - at
        while len(at):
            spent, now = np.zeros(len(at)), state.copy()
            arc = arcs[self.level[now], at]
            stuck = np.flatnonzero((arc < 0) | ~self.seen[arc])
            while len(stuck):
                spent[stuck] += self.cost[now[stuck]]
                now[stuck] = self.fail[now[stuck]]
                arc[stuck] = arcs[self.level[now[stuck]], at[stuck]]
                stuck = stuck[(arc[stuck] < 0) | ~self.seen[arc[stuck]]]
            counted = at >= begin
            out[at[counted]] = (spent + self.weight[arc])[counted]
            state, at, length = self.target[arc], at + 1, length - 1
            alive = int(np.searchsorted(-length, 0, "left"))
            at, begin, state, length = at[:alive], begin[:alive], state[:alive], length[:alive]
        return out


def automaton_scores(chunk: Chunk, counts: list[np.ndarray], train_docs: int, n: int, v: int, strength: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base score, score, known tokens) of each document of the chunk.

    counts: for each order, the corpus count of each distinct n-gram of the chunk.
    """
    auto = Automaton(chunk, counts, train_docs, n, v, strength)
    base = np.bincount(chunk.doc, auto.weight[: len(counts[0])][chunk.place[0]], chunk.n_docs)
    known = np.bincount(chunk.doc, counts[0][chunk.place[0]] > 0, chunk.n_docs).astype(np.int64)
    return base, np.bincount(chunk.doc, auto.read(chunk), chunk.n_docs), known


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_mod: int = 7, held_rest: int = 2, order: int = ORDER, strength: tuple[float, ...] = STRENGTH, spare_bits: int = SPARE_BITS, chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row.

    Documents whose crc32(id as text) mod held_mod is held_rest are scored, but
    not learnt from.  Null and empty texts are one end token.  Repeated rows are
    learnt and scored as often as they occur.  An empty table gives no rows; with
    no training document every token has probability 1 / (0 + 0 + 1).
    """
    kind = df.schema[id_col].dataType.simpleString()
    held = materialize(chunks(df, id_col, text_col, held_mod, held_rest, chunk_bytes), "chunks")
    total = held.agg(F.sum("n_bytes")).first()[0] or 0
    n_ranges = max(1, -(-total // range_bytes))
    # hashes of n-grams are cut to what tells those of the corpus apart; words keep all bits, as the base columns are exact
    drop = max(0, 64 - total.bit_length() - spare_bits)

    def ask(batches):
        for b in batches:
            for row in b.select(["chunk", "held", "offsets", "texts"]).to_pylist():
                c = Chunk(row["held"], row["offsets"], row["texts"], order, drop)
                cells = [c.cells(k, n_ranges) for k in range(order)]
                take = [r for r in range(n_ranges) if any(x[r] < x[r + 1] for x in cells)]
                part = [[(h[x[r] : x[r + 1]], n[x[r] : x[r + 1]]) for (h, n), x in zip(c.grams, cells, strict=True)] for r in take]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]] * len(take), pa.int64()), pa.array(take, pa.int32()), pa.array([[pack(np.diff(h, prepend=np.uint64(0))) for h, _ in p] for p in part], pa.list_(pa.binary())), pa.array([[pack(n) for _, n in p] for p in part], pa.list_(pa.binary()))],
                    names=["chunk", "cell", "grams", "counts"],
                )

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        out: list[list[bytes]] = [[] for _ in range(len(part))]
        n = v = 0
        for k in range(order):
            hashes = [np.cumsum(unpack(x[k], np.uint64), dtype=np.uint64) for x in part["grams"]]
            mine = np.concatenate([unpack(x[k], np.uint32) for x in part["counts"]]).astype(float)
            _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
            count = np.bincount(inverse, mine)
            if k == 0:
                n, v = int(count.sum()), int((count > 0).sum())
            every, at = count[inverse].astype(np.uint32 if count.max(initial=0) < 1 << 32 else np.uint64).astype(np.uint64), 0
            for x, h in zip(out, hashes, strict=True):
                x.append(pack(every[at : at + len(h)]))
                at += len(h)
        return pd.DataFrame({"chunk": part["chunk"], "cell": part["cell"], "counts": out, "n": [n] + [0] * (len(part) - 1), "v": [v] + [0] * (len(part) - 1)})

    asked = held.select("chunk", "held", "offsets", "texts").mapInArrow(ask, "chunk long, cell int, grams array<binary>, counts array<binary>")
    told = materialize(asked.groupBy("cell").applyInPandas(answer, "chunk long, cell int, counts array<binary>, n long, v long"), "counts")
    sums = told.agg(F.sum("n"), F.sum("v")).first()
    n, v = (int(x or 0) for x in sums)
    train_docs = int(held.select(F.expr("aggregate(ids, 0L, (a, x) -> a + if(pmod(crc32(cast(coalesce(cast(x as string), '') as binary)), %d) <> %d, 1, 0))" % (held_mod, held_rest)).alias("t")).agg(F.sum("t")).first()[0] or 0)

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        c = Chunk(row["held"], row["offsets"], row["texts"], order, drop)
        counts = [np.zeros(len(h), np.uint64) for h, _ in c.grams]
        cells = [c.cells(k, n_ranges) for k in range(order)]
        for r, got in zip(right["cell"], right["counts"], strict=True):
            for k in range(order):
                counts[k][cells[k][r] : cells[k][r + 1]] = unpack(got[k], np.uint64)
        base, full, known = automaton_scores(c, counts, train_docs, n, v, strength)
        return pd.DataFrame({"doc_id": list(row["ids"]), "held_out": c.held, "n_tokens": np.diff(c.first) - 1, "n_known": known, "train_tokens": n, "base_score": base, "score": full})

    return held.groupBy("chunk").cogroup(told.select("chunk", "cell", "counts").groupBy("chunk")).applyInPandas(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op5_lm(spark, sf_dir: str) -> DataFrame:
    from .base import table

    return score_texts(table(spark, sf_dir, "documents"))
