"""Micro-batch flows on Structured Streaming.

Each flow takes a streaming frame and a folder for its state and result, runs over
what is there (`availableNow`) and returns the result as a table, so the batch and
the stream form of an operator can be held against each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sinks

#: How often a queue is drained and how many files make a batch.
TRIGGERS = {"bulk": ("5 seconds", 10), "orphans": ("3 seconds", 50), "single": ("0 seconds", 1), "filings": ("0 seconds", 10)}


def read_stream(spark: SparkSession, path: str, name: str, max_files: int | None = None) -> DataFrame:
    """A file stream over the files of that name under a folder."""
    schema = spark.read.parquet(f"{path}/{name}").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", name.rsplit("/", 1)[-1])
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).parquet(path)


def run_now(writer, where: str) -> None:
    q = writer.option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start()
    q.awaitTermination()


def to_table(stream: DataFrame, where: str, mode: str = "append") -> DataFrame:
    """Append a stream to a table until its source is drained."""
    run_now(stream.writeStream.format("parquet").outputMode(mode).option("path", f"{where}/out"), where)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{where}/out")


def each_batch(stream: DataFrame, where: str, f: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    run_now(stream.writeStream.foreachBatch(f).outputMode(mode), where)


def dedup(stream: DataFrame, keys: list[str], time: str, late: str, where: str) -> DataFrame:
    """The first of each key while the watermark holds it."""
    return to_table(stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys), where)


def running_sets(stream: DataFrame, kind: str, value: str, where: str) -> DataFrame:
    """The distinct (kind, value) of a stream, each written by the batch that first sees it.

    The state is one entry for each pair, spread over all tasks, so a kind of many
    values is not held by one; a set is grouped when it is read.
    """
    return to_table(stream.select(kind, value).dropDuplicates([kind, value]), where)


#: Batches after which the tables that they left are merged into one.
COMPACT = 20


def latest_state(stream: DataFrame, aggregate: Callable[[DataFrame], DataFrame], where: str, keys: list[str] | None = None, compact: int = COMPACT) -> DataFrame:
    """A running aggregate by its keys (default: its first column): each batch leaves the rows that it changed, and the newest row of a key counts.

    A batch that was written is not written again; every `compact` batches the
    tables are merged into that of the batch, and the older ones go.
    """
    out = aggregate(stream)
    keys, spark = keys or out.columns[:1], out.sparkSession
    schema = out.schema

    def newest(df: DataFrame) -> DataFrame:
        rest = [c for c in schema.names if c not in keys]
        picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("s")) if rest else df.select(*keys).distinct()
        return picked.select(*keys, *[F.col("s")[c].alias(c) for c in rest]).select(*schema.names)

    def written() -> list[int]:
        dirs = [f.getPath() for f in listed(spark, f"{where}/at")]
        return sorted(int(d.getName().split("=")[1]) for d in dirs if listed(spark, f"{d.toString()}/_SUCCESS"))

    def read(batches: list[int]) -> DataFrame:
        parts = [spark.read.schema(schema).parquet(f"{where}/at/batch={n}").withColumn("batch", F.lit(n)) for n in batches]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def save(batch: DataFrame, n: int) -> None:
        done = written()
        if n in done:
            return
        old = [k for k in done if k < n]
        if len(old) < compact:
            batch.write.mode("overwrite").parquet(f"{where}/at/batch={n}")
            return
        newest(read(old).unionByName(batch.withColumn("batch", F.lit(n)))).write.mode("overwrite").parquet(f"{where}/at/batch={n}")
        for k in old:  # the merged table stands by now
            removed(spark, f"{where}/at/batch={k}")

    each_batch(out, where, save, "update")
    done = written()
    return newest(read(done)) if done else spark.createDataFrame([], schema)


def removed(spark, where: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def listed(spark, where: str) -> list:
    """What lies under a path; nothing if it is not there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(fs.listStatus(path)) if fs.exists(path) else []


def read_batches(spark, schema, where: str) -> DataFrame:
    """The tables that batches have left under a folder as one; empty if there was no batch."""
    return spark.read.schema(schema).parquet(f"{where}/*") if listed(spark, where) else spark.createDataFrame([], schema)


def windowed(stream: DataFrame, keys: list[str], time: str, size: str, slide: str | None, late: str, where: str, **aggs) -> DataFrame:
    """Tumbling or sliding event-time windows; a window is written when the watermark has passed it."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    g = stream.withWatermark(time, late).groupBy(*keys, w.alias("w")).agg(*[c.alias(k) for k, c in aggs.items()])
    return to_table(g.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *aggs), where)


def sessions(stream: DataFrame, keys: list[str], time: str, gap: str, late: str, where: str, **aggs) -> DataFrame:
    """Session windows, closed by a gap."""
    g = stream.withWatermark(time, late).groupBy(*keys, F.session_window(time, gap).alias("w")).agg(*[c.alias(k) for k, c in aggs.items()])
    return to_table(g.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *aggs), where)


def split_bad(stream: DataFrame, checks: dict, where: str) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows of a stream, each a table of its own."""

    def save(batch: DataFrame, n: int) -> None:
        good, bad = sinks.quarantine(batch, checks)
        good.write.mode("overwrite").parquet(f"{where}/good/batch={n}")
        bad.write.mode("overwrite").parquet(f"{where}/bad/batch={n}")

    each_batch(stream, where, save)
    spark = stream.sparkSession
    good, bad = sinks.quarantine(spark.createDataFrame([], stream.schema), checks)
    return read_batches(spark, good.schema, f"{where}/good"), read_batches(spark, bad.schema, f"{where}/bad")


def redrive(bad: DataFrame, tries: str, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """(rows to try again, rows that have failed too often)."""
    again = bad.withColumn(tries, F.col(tries) + 1)
    return again.filter(F.col(tries) <= most), again.filter(F.col(tries) > most)


def incremental(df: DataFrame, cursor: str, after) -> DataFrame:
    """What came after the cursor; the filter reaches the scan."""
    return df if after is None else df.filter(F.col(cursor) > F.lit(after))
