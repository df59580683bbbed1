"""Range joins, vote entries, running state: hand-made rows and brute force."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import joins, merges
from millrace.streaming import flows


@pytest.mark.parametrize("gap_first", [False, True])
@pytest.mark.parametrize("levels", [40, 6])
def test_ranges_against_brute_force(spark, gap_first, levels):
    rnd = random.Random(levels)
    ranges = [(rnd.randrange(-200, 300), rnd.choice([None, 0, 3, 50, 1000])) for _ in range(60)]
    ranges = [(lo, None if n is None else lo + n) for lo, n in ranges] + [(5, 1), (-(1 << 45), -(1 << 44)), (1 << 44, 1 << 45)]
    values = [rnd.randrange(-250, 400) + rnd.choice([0.0, 0.5, 0.999]) for _ in range(80)] + [None, 0.0, 5.0, 5.0, float(1 << 44), -float(1 << 45)]
    df = spark.createDataFrame([(k, v, "x") for k, v in enumerate(values)], "k int, v double, level string")
    rdf = spark.createDataFrame([(lo, hi, k) for k, (lo, hi) in enumerate(ranges)], "lo long, hi long, name int")
    got = sorted(((r["k"], r["name"]) for r in joins.in_range(df, rdf, F.col("v"), "lo", "hi", gap_first, levels).collect()), key=repr)
    least = min(range(len(ranges)), key=lambda j: ranges[j][0])
    want = []
    for k, v in enumerate(values):
        held = [j for j, (lo, hi) in enumerate(ranges) if v is not None and lo <= v and (hi is None or v <= hi)]
        if gap_first and v is not None:
            held = held if held and v > 0 else [least] * (max(1, len(held)))
        want += [(k, j) for j in held] or [(k, None)]
    assert got == sorted(want, key=repr)


def test_ranges_meet_without_a_product(spark):
    df, rdf = spark.range(10).withColumnRenamed("id", "v"), spark.range(100_000).select(F.col("id").alias("lo"), (F.col("id") + 5).alias("hi"))
    out = joins.in_range(df, rdf, F.col("v"), "lo", "hi")
    assert out.count() == sum(min(v, 5) + 1 for v in range(10))
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(x for n, b in joins.RangeBlocks().eval(3, 8) for x in range(b << n, (b + 1) << n)) == [3, 4, 5, 6, 7, 8]


def test_entries_of_older_lists(spark):
    cols = "who int, bill_yea array<string>, roll_yea array<string>, bill_nea array<string>, roll_nea array<string>, bill_present array<string>, roll_present array<string>, bill_not_voting array<string>, roll_not_voting array<string>"
    rows = [(1, ["a"], ["r1", "r2"], ["b", "c", "lost"], ["r3", "r1"], None, ["r4"], [], []), (2, None, None, None, None, None, None, None, None)]
    got = merges.entries_of_lists(spark.createDataFrame(rows, cols), "who").orderBy("place").collect()
    assert [(r["roll_id"], r["bill_id"], r["vote_type"]) for r in got] == [("r1", "a", "Yea"), ("r2", "", "Yea"), ("r3", "b", "Nay"), ("r1", "c", "Nay"), ("r4", "", "Present")]


def test_entries_merge_one_for_each_roll(spark):
    ddl = "who int, bill_id string, roll_id string, vote_type string, place long"
    store = spark.createDataFrame([(1, "", "r1", "Yea", 0), (1, "b", "r2", "Yea", 1), (1, "c", "r2", "Nay", 2), (1, "x", " ", "Yea", 3), (1, None, "r3", "Yea", 4)], ddl)
    batch = spark.createDataFrame([(1, "n", "r1", "Nay", 0), (1, "n", "r2", "Nay", 1), (1, "", "r3", "Nay", 2), (2, "", "r1", "Nay", 0)], ddl)
    got = {(r["who"], r["roll_id"]): (r["bill_id"], r["vote_type"]) for r in merges.merge_entries(store, batch, "who").collect()}
    assert got == {(1, "r1"): ("n", "Nay"), (1, "r2"): ("b", "Yea"), (1, "r3"): ("", "Yea"), (2, "r1"): ("", "Nay")}
    assert merges.merge_entries(store.limit(0), batch, "who").count() == 4 and merges.merge_entries(store, batch.limit(0), "who").count() == 3


def test_state_survives_restarts_and_is_merged(spark, tmp_path):
    """Each drain is a new run over the same checkpoint; batches hold only the keys that they changed, and few folders stay."""
    where, n = str(tmp_path), 0
    total = lambda s: s.groupBy("k").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
    want: dict = {}
    for run in range(4):
        for _ in range(3):
            rows = [(k, n + k) for k in range(n % 3, 6, 2)]
            spark.createDataFrame(rows, "k long, v long").coalesce(1).write.mode("append").parquet(f"{where}/in")
            for k, v in rows:
                a, b = want.get(k, (0, 0))
                want[k] = (a + v, b + 1)
            n += 1
        got = flows.latest_state(flows.read_stream(spark, f"{where}/in", "*.parquet", 1), total, f"{where}/state", compact=4)
        assert {r["k"]: (r["s"], r["n"]) for r in got.collect()} == want, run
    assert len([f for f in os.listdir(f"{where}/state/at") if f.startswith("batch=")]) <= 5
    last = spark.read.parquet(f"{where}/state/at/batch={n - 1}")
    assert last.count() <= 6


def test_sets_are_written_once(spark, tmp_path):
    where = str(tmp_path)
    for values in (["a", "b"], ["b", "c"], ["a"]):
        spark.createDataFrame([("t", v) for v in values], "kind string, v string").coalesce(1).write.mode("append").parquet(f"{where}/in")
        out = flows.running_sets(flows.read_stream(spark, f"{where}/in", "*.parquet"), "kind", "v", f"{where}/sets")
    assert sorted(r["v"] for r in out.collect()) == ["a", "b", "c"]
