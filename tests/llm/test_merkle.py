from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from brute import crc
from compare import assert_same
from pyspark.sql import functions as F

from millrace.llm.merkle import OP11_SQL, leaf_column, lower_ascii, merkle_manifest, op11_merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*xs: str) -> str:
    return hashlib.sha256("".join(xs).encode()).hexdigest()


def leaf(row: dict, change=lambda t: t) -> str:
    row = dict(row) | {"text": row["text"] if row["text"] is None else change(row["text"])}
    return h(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS])


def prove(nodes: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """The root and each leaf's siblings, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            lo = at[k] // 8 * 8
            path.append((nodes[lo : at[k]], nodes[at[k] + 1 : lo + 8]))
            at[k] //= 8
        nodes = [h(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows: list[dict]) -> list[tuple]:
    trees = defaultdict(list)
    for r in rows:
        trees[r["lang"]].append(r)
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    low = {}
    for t in order:
        trees[t].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        low[t] = prove([leaf(r) for r in trees[t]])
    root, above = prove([low[t][0] for t in order])
    lower = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    out = []
    for t, up in zip(order, above, strict=True):
        for r, path in zip(trees[t], low[t][1], strict=True):
            altered = crc("" if r["doc_id"] is None else r["doc_id"]) % 3 == 0
            now = leaf(r, (lambda x: x.translate(lower)) if altered else (lambda x: x))
            for left, right in path + up:
                now = h(*left, now, *right)
            out.append((r["doc_id"], leaf(r), low[t][0], root, h(*[x for left, right in path + up for x in left + right]), now, now == root))
    return sorted(out, key=repr)


def manifest(df):
    tampered = leaf_column([lower_ascii(F.col(f)) if f == "text" else F.col(f) for f in FIELDS])
    return merkle_manifest(df, FIELDS, altered=F.when(F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 0, tampered))


def test_matches_sql(spark, sf_dir, duck):
    assert_same(op11_merkle(spark, sf_dir), duck, OP11_SQL)


def test_brute_force(spark, sf_dir):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, op11_merkle(spark, sf_dir).collect()), key=repr) == brute(rows)


def test_odd_rows(spark, odd, empty):
    rows = [r.asDict() for r in odd.collect()]
    got = manifest(odd.repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert manifest(empty).count() == 0 and manifest(empty).columns == list(got[0].asDict())


@pytest.mark.parametrize("sizes", [[1], [8], [1, 1], [9, 1, 64], [65, 8, 2], [1] * 70, [513, 3]])
def test_shapes(spark, sizes):
    """Whole and broken runs, lone leaves, many trees; every tree is cut by partitions."""
    rows = [{"doc_id": 1000 * t + k, "source": "s", "lang": None if t == 1 else f"é{t}", "n_chars": k, "text": "Ab" if k % 2 else "ab"} for t, n in enumerate(sizes) for k in range(n)]
    df = spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted(map(tuple, manifest(df).collect()), key=repr) == brute(rows)


def test_tampering_is_found(spark):
    df = spark.createDataFrame([(k, "T") for k in range(40)], "doc_id long, lang string").withColumn("text", F.concat(F.lit("Text "), F.col("doc_id")))
    fields = ("doc_id", "text")
    other = F.when(F.col("doc_id") == 17, leaf_column([F.col("doc_id"), F.lit("forged")]))
    out = {r["doc_id"]: r["verified"] for r in merkle_manifest(df, fields, altered=other).collect()}
    assert [i for i, ok in out.items() if not ok] == [17]
    assert all(r["verified"] for r in merkle_manifest(df, fields).collect())
