"""Micro-batch queries: each gives what the batch form gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch, table
from ..streaming import flows
from .registry import query


def events(spark, sf_dir):
    s = flows.read_stream(spark, sf_dir, "events.parquet")
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stm_dedup(spark, sf_dir):
    """Keys once, as long as the watermark holds them; here it holds all."""
    return flows.dedup(events(spark, sf_dir).select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "400 days", scratch(spark, "dedup")).select("user_id", "event_type")


@query("SELECT event_type, string_agg(DISTINCT CAST(user_id % 40 AS VARCHAR), ',' ORDER BY CAST(user_id % 40 AS VARCHAR)) AS members FROM events GROUP BY event_type")
def stm_setstate(spark, sf_dir):
    """A running set of distinct values for each kind."""
    where = scratch(spark, "sets")
    table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 40).cast("string").alias("member")).repartition(6, "member").write.parquet(f"{where}/queue")
    first = flows.running_sets(flows.read_stream(spark, f"{where}/queue", "*.parquet", 2), "event_type", "member", where)
    return first.groupBy("event_type").agg(F.array_join(F.array_sort(F.collect_list("member")), ",").alias("members"))


@query("SELECT user_id % 100 AS k, count(*) AS n, CAST(sum(CAST(trunc(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1")
def stm_running(spark, sf_dir):
    """A running aggregate: batches write the keys they change, and are merged now and then."""
    where = scratch(spark, "running")
    table(spark, sf_dir, "events").select((F.col("user_id") % 100).alias("k"), (F.col("value") * 100).cast("bigint").alias("v")).repartition(8).write.parquet(f"{where}/queue")
    total = lambda s: s.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("cents"))
    return flows.latest_state(flows.read_stream(spark, f"{where}/queue", "*.parquet", 1), total, where, ["k"], compact=3)


@query("SELECT user_id AS symbol, count(*) AS points, max(ts) AS last_ts FROM events WHERE value > 0 GROUP BY user_id")
def stm_append(spark, sf_dir):
    """Points appended to a history, and its header refreshed from it."""
    h = flows.to_table(events(spark, sf_dir).filter("value > 0").select(F.col("user_id").alias("symbol"), "ts", "value"), scratch(spark, "append"))
    return h.groupBy("symbol").agg(F.count(F.lit(1)).alias("points"), F.max("ts").cast("timestamp_ntz").alias("last_ts"))


@query("SELECT user_id AS symbol, count(*) AS points FROM events GROUP BY user_id")
def ups_history(spark, sf_dir):
    """The same twice: points have no key, so a second drain of the same state appends nothing."""
    where = scratch(spark, "history")
    pick = lambda: events(spark, sf_dir).select(F.col("user_id").alias("symbol"), "ts", "value")
    flows.to_table(pick(), where)
    return flows.to_table(pick(), where).groupBy("symbol").agg(F.count(F.lit(1)).alias("points"))


@query("SELECT event_type, count(*) AS n FROM events WHERE value > 100 GROUP BY event_type")
def stm_queue(spark, sf_dir):
    """A queue drained in batches of some files, each handled by a function."""
    where = scratch(spark, "queue")
    save = lambda b, n: b.filter("value > 100").write.mode("overwrite").parquet(f"{where}/done/batch={n}")
    table(spark, sf_dir, "events").repartition(12, "event_id").write.parquet(f"{where}/queue")  # many files, several batches
    stream = flows.read_stream(spark, f"{where}/queue", "*.parquet", 5)
    flows.each_batch(stream, where, save)
    return flows.read_batches(spark, stream.schema, f"{where}/done").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT user_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20'")
def stm_incr(spark, sf_dir):
    """What came after a cursor."""
    return flows.incremental(table(spark, sf_dir, "events"), "ts", F.expr("timestamp_ntz'2024-01-20'")).select("user_id", "ts")


@query("SELECT CASE WHEN value > 5 THEN 'good' WHEN user_id % 4 < 3 THEN 'again' ELSE 'dead' END AS side, count(*) AS n FROM events GROUP BY 1")
def stm_dlq(spark, sf_dir):
    """Good rows, failed ones to try again, and those that failed too often."""
    good, bad = flows.split_bad(events(spark, sf_dir).select("user_id", "value"), {"value": F.col("value") > 5}, scratch(spark, "dlq"))
    again, dead = flows.redrive(bad.withColumn("tries", (F.col("user_id") % 4).cast("int")), "tries")
    out = None
    for name, df in (("good", good), ("again", again), ("dead", dead)):
        df = df.groupBy(F.lit(name).alias("side")).agg(F.count(F.lit(1)).alias("n"))
        out = df if out is None else out.unionByName(df)
    return out


@query("SELECT event_type, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start, count(*) AS n FROM events WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) FROM events) GROUP BY 1, 2")
def ext_stream_tumbling(spark, sf_dir):
    """Extension: day windows; the last, which no later event closes, is not written."""
    w = flows.windowed(events(spark, sf_dir), ["event_type"], "ts", "1 day", None, "0 seconds", scratch(spark, "tumbling"), n=F.count(F.lit(1)))
    return w.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


@query()
def ext_stream_sessions(spark, sf_dir):
    """Extension: sessions of a user, closed by a gap of a day."""
    w = flows.sessions(events(spark, sf_dir), ["user_id"], "ts", "1 day", "0 seconds", scratch(spark, "sessions"), n=F.count(F.lit(1)))
    return w.select("user_id", "window_start", "window_end", "n")


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def stm_fill(spark, sf_dir):
    """Admission by count: a batch takes up to fifty files, whatever has arrived."""
    where = scratch(spark, "fill")
    table(spark, sf_dir, "events").repartition(120, "event_id").write.option("maxRecordsPerFile", 10_000).parquet(f"{where}/queue")
    s = flows.read_stream(spark, f"{where}/queue", "*.parquet", flows.TRIGGERS["orphans"][1])
    return flows.to_table(s.select("event_type", "user_id"), where).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))
