"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a share of the words; the share divided by the source's size is
the expected number of copies of each of its documents.  The whole part is taken
outright.  The fractional parts are rounded by the pivotal method: two documents
meet, mass (probability times words) moves at random from one to the other until
one of them is at 0 or 1, and the other meets the next document.  Expected copies
are kept for each document, the mass of a group is kept exactly, and each group
hands on at most one open document.  The open documents of the groups meet in the
next level of a reduction tree, so a source misses its target by less than one
document however many rows it has.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import Words, blocks, materialize, utf8_column

#: Documents that meet in one leaf of the tree, and leaves that meet in one inner node.
LEAF_ROWS, FAN_IN = 2000, 1000


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, text_crc): number of words of each text, 0 for null and empty texts, and a checksum that tells texts of one id apart."""
    picked = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, source string, size long, text_crc long"

    def run(batches):
        for b in batches:
            data, off = utf8_column(b.column("text"))
            size = np.zeros(b.num_rows, np.int64)
            for lo, hi in blocks(off):
                o = off[lo : hi + 1]
                size[lo:hi] = np.diff(Words(data[o[0] : o[-1]], o - o[0], hashed=False).first)
            crc = [zlib.crc32(data[x:y]) for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), pa.array(size), pa.array(crc, pa.int64())], names=["doc_id", "source", "size", "text_crc"])

    return picked.mapInArrow(run, schema)


def source_targets(stats: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, n, target) from (source, source_size, n): the total is shared by weight, no source above `most` times its size.

    The repeated resharing of the excess ends at a water level: with sources by
    size over weight, those below the level are full and the rest share what is
    left by weight.  The table has one row for each source, so its windows are small.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = stats.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    t = t.withColumn("level", F.col("cap") / F.col("weight"))
    up = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(up), F.lit(0.0))
    heavy = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(up), F.lit(0.0))
    t = t.withColumn("water", left / heavy)
    # the first source, from below, that the water does not fill sets the level for it and all above
    t = t.withColumn("open", F.col("water") <= F.col("level"))
    t = t.withColumn("at", F.min(F.when(F.col("open"), F.struct("level", "water"))).over(every).getField("water"))
    target = F.least(F.col("cap"), F.coalesce(F.col("at") * F.col("weight"), F.col("cap")))
    return t.select("source", "source_size", "n", target.alias("target"))


def pivotal(size: np.ndarray, p: np.ndarray, u: np.ndarray) -> int:
    """Round p in place, all but at most one; the size-weighted sum stays. Returns the open row's index, or -1."""
    held = -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if held < 0:
            held = j
            continue
        a, b = size[held], size[j]
        up, down = min((1 - p[held]) * a, p[j] * b), min(p[held] * a, (1 - p[j]) * b)
        if u[j] * (up + down) < down:  # mass moves to the held row
            if up == p[j] * b:
                p[held], p[j] = min(1.0, p[held] + up / a), 0.0
            else:
                p[held], p[j] = 1.0, max(0.0, p[j] - up / b)
        elif down == p[held] * a:
            p[held], p[j] = 0.0, min(1.0, p[j] + down / b)
        else:
            p[held], p[j] = max(0.0, p[held] - down / a), 1.0
        if not 0.0 < p[held] < 1.0:
            held = j if 0.0 < p[j] < 1.0 else -1
    return held


def mix_sources(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    leaf_rows: int = LEAF_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row for each input row: doc_id, source, size, source_size, target, copies, taken, text_crc.

    Null and empty texts have size 0: they take nothing and get no copy.  A null
    source is a source of its own, the last.  Repeated rows each count.  An empty
    table gives an empty result.  Groups and draws depend on doc_id, source and
    text alone, not on the layout, so reruns agree.
    """
    sized = word_counts(df, id_col, text_col, source_col)
    # rows that agree in all are numbered among themselves, so that no leaf holds more of them than others
    same = sized.groupBy(*sized.columns).agg(F.count(F.lit(1)).alias("n_same"))
    sized = materialize(same.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "n_same"))).drop("n_same"), "sizes")
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = materialize(source_targets(stats, weights, share, most).withColumn("leaves", F.greatest(F.lit(1), F.ceil(F.col("n") / leaf_rows))), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (
        sized.join(targets, sized["source"].eqNullSafe(targets["source"]))
        .select("doc_id", sized["source"], "size", "source_size", "target", F.least(ratio, F.lit(float(most))).alias("ratio"), "text_crc", "nth", F.pmod(F.xxhash64("doc_id", "text_crc", "nth"), "leaves").alias("node"))
        .withColumn("base", F.floor("ratio").cast("long"))
        .withColumn("p", F.when(F.col("size") > 0, F.col("ratio") - F.col("base")).otherwise(F.lit(0.0)))
        .withColumn("open", F.lit(False))
        .drop("ratio")
    )
    schema = rows.schema

    def meet(level: int, last: bool):
        def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values(["doc_id", "size", "text_crc", "nth"], kind="stable").reset_index(drop=True)
            rng = np.random.default_rng([seed, level, int(key[1]), zlib.crc32(repr(key[0]).encode())])
            u, p = rng.random(len(part) + 1), part["p"].to_numpy(float, copy=True)
            held = pivotal(part["size"].to_numpy(float), p, u)
            opened = np.zeros(len(part), bool)
            if held >= 0 and last:
                p[held] = float(u[-1] < p[held])
            elif held >= 0:
                opened[held] = True
            return part.assign(p=p, open=opened)

        return run

    most_leaves = targets.agg(F.max("leaves")).first()[0] or 1
    done, level, now = None, 0, rows
    while True:
        last = most_leaves <= 1
        out = now.groupBy("source", "node").applyInPandas(meet(level, last), schema)
        if level == 0 or not last:
            out = materialize(out, f"pivotal{level}")
        settled = out.filter(~F.col("open"))
        done = settled if done is None else done.unionByName(settled)
        if last:
            break
        now = out.filter("open").withColumn("node", F.floor(F.col("node") / fan_in).cast("long"))
        most_leaves, level = -(-most_leaves // fan_in) if most_leaves > fan_in else 1, level + 1
    copies = F.when(F.col("size") > 0, F.col("base") + F.round("p").cast("long")).otherwise(F.lit(0).cast("long"))
    return done.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "text_crc")


def op10_mix(spark, sf_dir: str) -> DataFrame:
    from .base import table

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
