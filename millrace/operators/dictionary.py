"""Which entries of a dictionary a text holds, by an automaton instead of a join of all pairs.

The dictionary is dealt into blocks of bounded bytes.  A task builds the automaton of
its block once (each state a prefix, with its failure link to the longest suffix that
is a prefix) and reads each text once, whatever the number of entries.  Texts go to
every block, so a dictionary of one block costs one pass.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of entries in a block.
BLOCK_CHARS = 1 << 20


class Automaton:
    """States by number: transitions, failure links, and the next state on the way of failures that ends an entry."""

    def __init__(self, entries: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        for entry in entries:
            at = 0
            for c in entry:
                to = self.next[at].get(c)
                if to is None:
                    to = self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.word.append(None)
                at = to
            if at:  # the empty entry is nowhere looked for
                self.word[at] = entry
        self.fail, self.out = [0] * len(self.next), [0] * len(self.next)
        queue = deque(self.next[0].values())
        while queue:
            at = queue.popleft()
            for c, to in self.next[at].items():
                queue.append(to)
                f = self.fail[at]
                while f and c not in self.next[f]:
                    f = self.fail[f]
                self.fail[to] = self.next[f].get(c, 0)
            f = self.fail[at]
            self.out[at] = f if self.word[f] is not None else self.out[f]

    def held(self, text: str) -> set[str]:
        """The distinct entries that the text holds anywhere."""
        found, at, step, fail, word, out = set(), 0, self.next, self.fail, self.word, self.out
        seen: set[int] = set()
        for c in text:
            while at and c not in step[at]:
                at = fail[at]
            at = step[at].get(c, 0)
            if at in seen:
                continue
            seen.add(at)
            k = at if word[at] is not None else out[at]
            while k:
                found.add(word[k])
                k = out[k]
        return found


def occurrences(df: DataFrame, text: str, entries: DataFrame, entry: str, keep: tuple[str, ...] = (), block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The columns in keep and `entry`, one row for each distinct entry that a row's text holds.

    Null texts and entries hold, and are, nothing; so is the empty entry.  Entries may
    repeat.  Case and characters are compared as they are.
    """
    words = entries.select(F.col(entry).cast("string").alias("__entry")).filter("__entry <> ''").distinct()
    total = words.agg(F.sum(F.length("__entry"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    rows = df.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "__text") + f"{', ' * bool(keep)}`{entry}` string"
    # One list for each block, of bounded size: the product with the texts is one pass for each block.
    lists = words.groupBy(F.pmod(F.xxhash64("__entry"), F.lit(blocks)).alias("__block")).agg(F.collect_list("__entry").alias("__words"))
    held = [r["__words"] for r in lists.filter(F.col("__block") == 0).collect()] if blocks == 1 else None

    def found(batch: pa.RecordBatch, automaton: Automaton) -> pa.RecordBatch:
        hits = [sorted(automaton.held(t)) if t else [] for t in batch.column("__text").to_pylist()]
        at = pa.array([k for k, h in enumerate(hits) for _ in h], pa.int64())
        names = pa.array([w for h in hits for w in h], pa.string())
        cols = [batch.column(c).take(at) for c in keep]
        return pa.RecordBatch.from_arrays([*cols, names], names=[*keep, entry])

    if held is not None:
        words_ = held[0] if held else []

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = Automaton(words_)
            for batch in batches:
                yield found(batch, automaton)

        return rows.mapInArrow(run, schema)

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).withColumn("__slice", F.pmod(F.xxhash64("__text"), F.lit(parts)))
    dealt = lists.withColumn("__slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def match(a: pa.Table, b: pa.Table) -> pa.Table:
        automaton = Automaton(w for words in b.column("__words").to_pylist() for w in words)
        return pa.Table.from_batches([found(x, automaton) for x in a.combine_chunks().to_batches()] or [found(pa.RecordBatch.from_pylist([], schema=a.schema), automaton)])

    return spread.groupBy("__slice", "__block").cogroup(dealt.groupBy("__slice", "__block")).applyInArrow(match, schema)
