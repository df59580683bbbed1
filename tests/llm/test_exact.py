from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from compare import assert_same
from pyspark.sql import functions as F

from millrace.llm.content_sort import OP12_SQL, exact_duplicates, op12_exact


def brute(rows, normal, largest):
    groups = defaultdict(list)
    for i, text in rows:
        groups[normal(text or "")].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if largest else min)(known) if known else None
        out += [(i, best, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr), groups


def check(df, rows, normal=lambda t: t, largest=False):
    got = df.collect()
    want, groups = brute(rows, normal, largest)
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=repr) == want
    kept = [(r["keep_id"], r["text_sha256"]) for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_matches_sql(spark, sf_dir, duck):
    assert_same(op12_exact(spark, sf_dir), duck, OP12_SQL)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_odd_rows(spark, odd, empty, keep):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(exact_duplicates(odd, keep=keep), rows, largest=keep == "largest")
    assert exact_duplicates(empty, keep=keep).count() == 0


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_hot_texts_are_settled_over_their_shares(spark, keep):
    """Half of the rows have one text and a sixth another that begins alike; ids are shared, null and tied."""
    texts = ["common " * 60, "common " * 60 + "x", None, "", "é", "é"]
    rows = [(None if k % 11 == 0 else k // 2, texts[0] if k % 2 else texts[1 + k % 5] if k % 3 == 0 else f"text {k}") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check(exact_duplicates(df, keep=keep), rows, largest=keep == "largest")


def test_normalised(spark):
    rows = [(1, "A  b"), (2, "a b "), (3, "a c")]
    df = spark.createDataFrame([(*r, 0, "h") for r in rows], "id long, body string, share int, hash string")
    out = exact_duplicates(df, "id", "body", lambda t: F.trim(F.regexp_replace(F.lower(t), r"\s+", " ")))
    check(out, rows, lambda t: " ".join(t.lower().split()))


def test_native_range_partition_and_sort(spark, sf_dir, tmp_path):
    plan = op12_exact(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    with pytest.raises(ValueError, match="first"):
        exact_duplicates(spark.range(1).selectExpr("id AS doc_id", "'a' AS text"), keep="first")
