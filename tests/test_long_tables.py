"""Work on long documents grows with their length: each took minutes when parts of a table were read again for each of its cells."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from millrace.functions import markup

N = 1500


def test_by_header_reads_a_table_once(spark):
    body = "".join(f"<tr><td>{k}</td><td>A &amp; {k}</td></tr>" for k in range(N))
    df = spark.createDataFrame([(f"<table><tr><th>#</th><th>Asset Name</th></tr>{body}</table>",)], "h string")
    began = time.monotonic()
    got = df.select(F.inline(markup.by_header(markup.table_with("h", "asset name"), {"k": "^#$", "asset": "asset name", "x": "none"}))).collect()
    assert [tuple(r) for r in got] == [(str(k), f"A & {k}", None) for k in range(N)]
    assert time.monotonic() - began < 40


def test_documents_grown_from_small_tables_are_read_by_many_tasks(spark, sf_dir):
    """A few MB of orders make GB of documents, which one task read."""
    from millrace.plans import reports

    for df in (reports._forms(spark, sf_dir), reports._bill_xml(spark, sf_dir)):
        assert df.withColumn("task", F.spark_partition_id()).select("task").distinct().count() >= 8


def test_range_totals_are_those_of_the_pairs(spark):
    """As brute force, with ends that meet values, ranges of no length, open and falling ones, nulls and halves; and far more pairs than rows."""
    from millrace.operators import joins

    values = [None, -3.0, 0.0, 0.5, 1.0, 1.0, 2.5, 7.0, 7.5, 99.0]
    ranges = [(0, 1), (1, 1), (1, 7), (2, None), (7, 7), (9, 3), (None, 4), (-5, 0), (8, None), (1, 7)]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    rdf = spark.createDataFrame(ranges, "lo bigint, hi bigint")
    got = {r["k"]: (r["n"], r["total"]) for r in joins.range_totals(df, rdf, F.col("v"), "lo", "hi", "n", total="lo").collect()}
    for k, v in enumerate(values):
        held = [lo for lo, hi in ranges if v is not None and lo is not None and lo <= v and (hi is None or v <= hi)]
        assert got[k] == (len(held), sum(held)), v
    n = 60_000
    r = joins.range_totals(spark.range(n), spark.range(n).selectExpr("id AS lo", "cast(null AS bigint) AS hi"), F.col("id"), "lo", "hi", "n", total="lo").agg(F.sum("n"), F.max("total")).first()
    assert tuple(r) == (n * (n + 1) // 2, n * (n - 1) // 2)
