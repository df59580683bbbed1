"""Exact duplicates by a content sort, in DataFrame functions only.

Rows are range-partitioned by their normalised bytes: Spark samples splitters over
the first 64 bytes, a hash of the whole text and, for a text with very many copies,
a share number.  Each partition is sorted (an external sort), so equal texts stand
next to each other, and a window whose key is the whole text compares neighbours in
full.  Splitters are of bounded size however long the texts are.

A text that more than a thousandth of all rows have is split into shares of about
one partition each; there are fewer than a thousand such texts.  Each share is
settled where it lies, and one row of each, with the text, is compared in full with
those of the other shares.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import materialize, table

#: Bytes of a text in a splitter, and the part of all rows from which a text's copies are split into shares.
HEAD_BYTES, HOT_PART = 64, 1000


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] | None = None, keep: str = "smallest") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row.

    Rows are equal when their normalised texts are; a null text is empty.  Of equal
    rows the one with the smallest id stays (keep="largest": the largest); a null id
    stays only where no row has one (keep_id is then null).  Of rows that share text
    and id, one is kept.  An empty table gives no rows; other columns are ignored,
    whatever their names.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    spark = df.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col).alias("doc_id"), (normalise(text) if normalise else text).alias("text"))
    docs = docs.withColumn("hash", F.xxhash64("text"))

    # Hashes of more than a thousandth of the rows: fewer than a thousand, so they can be broadcast.
    counts = docs.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    total = docs.agg(F.count(F.lit(1)).alias("total"))
    share = F.floor(F.col("n") * n_parts / F.col("total")).cast("int") + 2
    hot = counts.join(F.broadcast(total), F.col("n") * HOT_PART > F.col("total")).select("hash", share.alias("shares"))
    dealt = docs.join(F.broadcast(hot), "hash", "left")
    # The number of the map task parts rows that share even their id.
    dealt = dealt.withColumn("share", F.when(F.col("shares").isNotNull(), F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), "shares").cast("int")))
    dealt = dealt.withColumn("head", F.substring(F.col("text").cast("binary"), 1, HEAD_BYTES))

    ranged = dealt.select("doc_id", "text", "hash", "share", "head").repartitionByRange("head", "hash", "share")
    same = ["head", "hash", "share", "text"]
    first = F.col("doc_id").asc_nulls_last() if keep == "smallest" else F.col("doc_id").desc_nulls_last()
    best = F.min if keep == "smallest" else F.max
    run, place = Window.partitionBy(*same), Window.partitionBy(*same).orderBy(first)
    # Different texts of one hash are told apart by their order inside a share.
    order = Window.partitionBy("head", "hash", "share").orderBy("text")
    runs = ranged.withColumn("place", F.row_number().over(place))  # first, as its sort serves the other windows
    runs = runs.withColumn("n", F.count(F.lit(1)).over(run)).withColumn("best", best("doc_id").over(run)).withColumn("run", F.dense_rank().over(order))
    runs = runs.select(
        "doc_id", "hash", "share", "run", "n", "best", "place", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
        F.when(F.col("share").isNotNull() & (F.col("place") == 1), F.col("text")).alias("text"),
    )
    runs = materialize(runs, "runs")

    # One row of each share of a frequent text, compared in full.
    heads = runs.filter("share IS NOT NULL AND place = 1").select("hash", "share", "run", "n", "best", "text")
    across = Window.partitionBy("hash", "text")
    chosen = F.col("best").asc_nulls_last() if keep == "smallest" else F.col("best").desc_nulls_last()
    heads = heads.withColumn("sum", F.sum("n").over(across)).withColumn("least", best("best").over(across)).withColumn("turn", F.row_number().over(across.orderBy(chosen, "share")))
    heads = heads.select("hash", "share", "run", "sum", "least", "turn")
    cold = runs.filter("share IS NULL").select("doc_id", F.col("best").alias("keep_id"), F.col("n").alias("group_size"), (F.col("place") == 1).alias("kept"), "text_sha256")
    split = runs.filter("share IS NOT NULL").drop("text").join(heads, ["hash", "share", "run"])
    split = split.select("doc_id", F.col("least").alias("keep_id"), F.col("sum").alias("group_size"), ((F.col("place") == 1) & (F.col("turn") == 1)).alias("kept"), "text_sha256")
    return cold.unionByName(split)


def op12_exact(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


OP12_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
