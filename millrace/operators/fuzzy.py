"""The nearest reference row by name: an exact similarity join that scores only pairs which can be accepted.

A scorer comes with rules, one of which holds for every pair that it can accept: a
ratio of at least so much, one text inside the other, or an equal text.  Equal texts
are looked up.  For the others each text has its length, a bit for each character and
occurrence, and a bit for each pair of neighbouring characters.  Matching blocks
stand in one order in both texts, so a ratio of t leaves few characters unmatched:

    matched  m >= t (|a| + |b|) / 2
    characters of a that b lacks          <= |a| - m
    neighbour pairs of a that b lacks     <= 2 (|a| - m) + (|b| - m)

and the same for b.  Bits that fall together only hide a difference, so no pair is
lost; what is left is scored in full.

Equal names are matched once.  Names are dealt to slices and references to blocks,
both of bounded rows, and one task holds a slice against a block; each gives at most
one row for a name, so nothing but the best leaves a task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct names in a slice, references in a block.
SLICE_ROWS, BLOCK_ROWS = 5_000, 20_000


class Rule(NamedTuple):
    """What a pair must fulfil: texts of the name and of the reference are equal, one is part of the other, or their ratio is at least `least`."""

    kind: str  # equal, part, ratio
    left: Callable[[tuple], Iterable[str]]
    right: Callable[[tuple], Iterable[str]]
    least: float = 0.0


class Scorer(NamedTuple):
    """score(name, reference) of two tuples of texts (null as ''); pairs for which no rule holds are below `accept`."""

    score: Callable[[tuple, tuple], float]
    rules: tuple[Rule, ...]
    accept: float


# ---------------------------------------------------------------- bounds


def bits_of(text: str) -> bytes:
    """128 bits of characters (up to four occurrences each) and 256 of neighbour pairs."""
    seen, chars, pairs = defaultdict(int), 0, 0
    for c in text:
        n = seen[c]
        seen[c] = n + 1
        if n < 4:
            chars |= 1 << ((ord(c) & 31) * 4 + n)
    for a, b in zip(text, text[1:]):  # noqa: B905
        pairs |= 1 << ((ord(a) * 37 + ord(b)) & 255)
    return chars.to_bytes(16, "little") + pairs.to_bytes(32, "little")


class Texts:
    """Texts of the references in order of length, with the row of each and its bits."""

    def __init__(self, texts: list[tuple[int, str]]):
        texts = sorted(texts, key=lambda x: len(x[1]))
        self.row = np.array([k for k, _ in texts], np.int64)
        self.size = np.array([len(t) for _, t in texts], np.int64)
        words = np.frombuffer(b"".join(bits_of(t) for _, t in texts), np.uint64).reshape(-1, 6)
        self.chars, self.pairs = [words[:, k].copy() for k in range(2)], words[:, 2:]

    def lacking(self, bits: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters of the name that each text lacks, and of each text that the name lacks; at least so many."""
        here = [c[lo:hi] for c in self.chars]
        return sum(np.bitwise_count(~c & b) for c, b in zip(here, bits, strict=False)), sum(np.bitwise_count(c & ~b) for c, b in zip(here, bits, strict=False))

    def lacking_pairs(self, bits: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pairs = self.pairs[at]
        return np.bitwise_count(~pairs & bits[2:]).sum(1, dtype=np.int64), np.bitwise_count(pairs & ~bits[2:]).sum(1, dtype=np.int64)

    def reach(self, text: str, least: float) -> np.ndarray:
        """Rows whose ratio with the text may be `least` or more."""
        n, bits = len(text), np.frombuffer(bits_of(text), np.uint64)
        lo = np.searchsorted(self.size, np.ceil(n * least / (2 - least) - 1e-9))
        hi = np.searchsorted(self.size, np.floor(n * (2 - least) / least + 1e-9), "right")
        size = self.size[lo:hi]
        need = np.ceil(least * (n + size) / 2 - 1e-9).astype(np.int64)
        a, b = self.lacking(bits, lo, hi)
        at = np.flatnonzero((a <= n - need) & (b <= size - need))
        mine, other = n - need[at], size[at] - need[at]
        a, b = self.lacking_pairs(bits, at + lo)
        return self.row[at[(a <= 2 * mine + other) & (b <= 2 * other + mine)] + lo]

    def parts(self, text: str) -> np.ndarray:
        """Rows whose text may lie in the text, or the text in theirs."""
        bits = np.frombuffer(bits_of(text), np.uint64)
        a, b = self.lacking(bits, 0, len(self.size))
        at = np.flatnonzero(((a == 0) & (self.size >= len(text))) | ((b == 0) & (self.size <= len(text))))
        a, b = self.lacking_pairs(bits, at)
        return self.row[at[((a == 0) & (self.size[at] >= len(text))) | ((b == 0) & (self.size[at] <= len(text)))]]


class Candidates:
    """The references that a name may be matched with, by the rules."""

    def __init__(self, refs: list[tuple], rules: tuple[Rule, ...]):
        self.rules, self.held = rules, []
        for rule in rules:
            texts = [(k, t) for k, ref in enumerate(refs) for t in rule.right(ref)]
            if rule.kind == "equal":
                rows = defaultdict(list)
                for k, t in texts:
                    rows[t].append(k)
                self.held.append(rows)
            else:
                self.held.append(Texts(texts))

    def of(self, name: tuple) -> list[int]:
        out = []
        for rule, held in zip(self.rules, self.held, strict=True):
            for text in rule.left(name):
                out.append(held.get(text, []) if rule.kind == "equal" else held.parts(text) if rule.kind == "part" else held.reach(text, rule.least))
        return np.unique(np.concatenate([*out, np.zeros(0, np.int64)])).astype(np.int64).tolist()


def best_of(names: list[tuple], refs: list[tuple], scorer: Scorer, accept: float) -> tuple[list[tuple[int, int, float]], int]:
    """((name, reference, score) of each accepted name, first reference among equals; how many pairs were scored)."""
    near, out, scored = Candidates(refs, scorer.rules), [], 0
    for k, name in enumerate(names):
        best, at = 0.0, -1
        for r in near.of(name):
            scored += 1
            score = scorer.score(name, refs[r])
            if score > best:
                best, at = score, r
        if at >= 0 and best >= accept:
            out.append((k, at, best))
    return out, scored


# ---------------------------------------------------------------- join


def _tuples(t: pa.Table) -> list[tuple]:
    empty = [() if pa.types.is_list(f.type) or pa.types.is_large_list(f.type) else "" for f in t.schema]
    return [tuple(e if v is None else v for v, e in zip(row, empty, strict=True)) for row in zip(*(c.to_pylist() for c in t.columns), strict=True)] if t.num_columns else []


def nearest(left: DataFrame, ref: DataFrame, scorer: Scorer, names: list[str], ref_names: list[str], order: str, accept: float | None = None, slice_rows: int = SLICE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each left row that is accepted, with the columns of its best reference and the score.

    names and ref_names are the columns whose texts (or arrays of texts) the scorer
    gets; null is '' or an empty array.  Among equal scores the first reference in
    `order` wins, of any type, null last.  Left rows may repeat and have null names;
    the two frames must not share column names.  An empty side gives no rows.
    """
    accept = scorer.accept if accept is None else accept
    n_refs, refs = len(ref.columns), ref.columns
    keys = left.select(*[F.col(c).alias(f"__n{k}") for k, c in enumerate(names)]).distinct()
    own = keys.columns
    slices, blocks = max(1, -(-keys.count() // slice_rows)), max(1, -(-ref.count() // block_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = keys.withColumn("__slice", F.pmod(F.xxhash64(*own), F.lit(slices)).cast("int")).withColumn("__block", every(blocks))
    held = ref.select(*[F.col(c).alias(f"__r{k}") for k, c in enumerate(refs)])
    place, given = f"__r{refs.index(order)}", [f"__r{refs.index(c)}" for c in ref_names]
    held = held.withColumn("__block", F.pmod(F.xxhash64(place, *given), F.lit(blocks)).cast("int")).withColumn("__slice", every(slices))

    def match(a: pa.Table, b: pa.Table) -> pa.Table:
        b = b.take(pc.sort_indices(b, [(place, "ascending")], null_placement="at_end"))
        found, _ = best_of(_tuples(a.select(own)), _tuples(b.select(given)), scorer, accept)
        left_at, right_at, score = zip(*found, strict=True) if found else ((), (), ())
        mine, other = a.select(own).take(pa.array(left_at, pa.int64())), b.select([f"__r{k}" for k in range(n_refs)]).take(pa.array(right_at, pa.int64()))
        return pa.Table.from_arrays([*mine.columns, *other.columns, pa.array(score, pa.float64())], names=[*mine.column_names, *other.column_names, "__score"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*keys.schema.fields, *held.schema.fields[:n_refs]]) + ", `__score` double"
    found = dealt.groupBy("__slice", "__block").cogroup(held.groupBy("__slice", "__block")).applyInArrow(match, ddl)
    best = F.min_by(F.struct(*[F.col(f"__r{k}") for k in range(n_refs)], "__score"), F.struct(-F.col("__score"), F.col(place).isNull(), F.col(place)))
    best = found.groupBy(*own).agg(best.alias("__best"))
    same = [left[c].eqNullSafe(best[k]) for c, k in zip(names, own, strict=True)]
    got = F.col("__best")
    return left.join(best, same).select(*left.columns, *[got[f"__r{k}"].alias(c) for k, c in enumerate(refs)], got["__score"].alias("score"))
