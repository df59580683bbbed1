"""Queries that no other engine here can say, by hand-made rows and plain Python."""

from __future__ import annotations

import hashlib
import os
import random
import unicodedata
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace import plans
from millrace.functions import text
from millrace.operators import ordered, sinks

QUERIES, _ = plans.load()


@pytest.mark.parametrize("raw", ["ﬁne ① Ａ–b—c", "“x” ‘y’", "É é ｶﾞ", "", "plain"])
def test_normal_form(spark, raw):
    want = unicodedata.normalize("NFKC", raw).lower().translate(str.maketrans("–—“”‘’", "--\"\"''"))
    assert spark.range(1).select(text.normal(text.nfkc(F.lit(raw)))).first()[0] == want


def test_words_of_every_script(spark):
    got = spark.range(1).select(text.tokens(F.lit("été là-bas 日本 x_1 a.b -z"), unicode=True)).first()[0]
    assert got == ["été", "là", "bas", "là-bas", "日本", "x_1", "a.b", "z"]


def test_normal_queries_on_whole_texts(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fold = str.maketrans("–—“”‘’", "--\"\"''")
    for r in QUERIES["txt_norm_nfkc"](spark, sf_dir).collect():
        t = docs[r["doc_id"]]
        want = None if t is None else hashlib.md5(unicodedata.normalize("NFKC", t).lower().translate(fold).encode()).hexdigest()
        assert r["digest"] == want


def test_sketches_are_near(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", "l_partkey", "l_extendedprice").collect()
    parts, prices = defaultdict(set), defaultdict(list)
    for r in li:
        parts[r["l_returnflag"]].add(r["l_partkey"])
        prices[r["l_returnflag"]].append(r["l_extendedprice"])
    for r in QUERIES["ext_approx"](spark, sf_dir).collect():
        k = r["l_returnflag"]
        assert abs(r["parts"] - len(parts[k])) <= 0.1 * len(parts[k])
        below = sum(p <= r["median"] for p in prices[k]) / len(prices[k])
        assert 0.48 <= below <= 0.52


def test_sessions_of_users(spark, sf_dir):
    """A session ends where a day passes without an event; those that the watermark has not passed are not written."""
    day, users = 86_400_000_000, defaultdict(list)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts")).collect()
    for r in events:
        users[r["user_id"]].append(r["ts"])
    last, want = max(r["ts"] for r in events), set()
    for u, times in users.items():
        times.sort()
        begin, n = times[0], 0
        for a, b in zip(times, [*times[1:], None], strict=True):
            n += 1
            if b is None or b >= a + day:
                if a + day <= last:
                    want.add((u, begin, a + day, n))
                begin, n = b, 0
    out = QUERIES["ext_stream_sessions"](spark, sf_dir).select("user_id", F.unix_micros("window_start"), F.unix_micros("window_end"), "n")
    assert {tuple(r) for r in out.collect()} == want


@pytest.mark.parametrize("parts", [1, 7])
def test_numbers_without_a_task_for_a_group(spark, parts):
    rnd = random.Random(parts)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), k, "own") for k in rnd.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "g string, k int, part string").repartition(parts)
    got = {(r["g"], r["k"]): r["n"] for r in ordered.numbered(df, ["g"], ["k"], "n").collect()}
    groups = defaultdict(list)
    for g, k, _ in rows:
        groups[g].append(k)
    assert got == {(g, k): n for g, ks in groups.items() for n, k in enumerate(sorted(ks), 1)}
    batch = [r for r in ordered.batches(df, ["g"], ["k"], 50, "k").collect() if r["g"] == "a"]
    assert sum((r["keys"] for r in sorted(batch, key=lambda r: r["batch_number"])), []) == sorted(groups["a"])
    assert {r["total"] for r in batch} == {-(-len(groups["a"]) // 50)} and max(len(r["keys"]) for r in batch) == 50
    assert ordered.batches(df.limit(0), ["g"], ["k"], 50, "k").count() == 0


def test_digests_of_files(spark, tmp_path):
    sinks.write_json_gz(spark.range(30).repartition(3), str(tmp_path / "j"), ["id"])
    rows = sinks.file_manifest(spark, str(tmp_path / "j")).collect()
    files = [f for f in os.listdir(tmp_path / "j") if f.startswith("part-")]
    assert sorted(r["file"] for r in rows) == sorted(files)
    for r in rows:
        raw = (tmp_path / "j" / r["file"]).read_bytes()
        assert (r["byte_size"], r["sha256"]) == (len(raw), hashlib.sha256(raw).hexdigest()) and r["indexed_at"]
