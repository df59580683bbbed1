"""The automaton against plain search, the schema walker on odd schemas."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest

from millrace.operators import dictionary, flatten


def test_automaton_finds_what_search_finds():
    rnd = random.Random(1)
    for _ in range(200):
        entries = ["".join(rnd.choice("ab é") for _ in range(rnd.randrange(5))) for _ in range(12)]
        text = "".join(rnd.choice("ab éc") for _ in range(rnd.randrange(60)))
        assert dictionary.Automaton(entries).held(text) == {e for e in entries if e and e in text}


@pytest.mark.parametrize("block_chars", [1 << 20, 9])
def test_occurrences(spark, block_chars):
    rnd = random.Random(2)
    entries = ["a", "ab", "b a", "", None, "a", "zz", "日本", "ab"] + ["".join(rnd.choice("abz ") for _ in range(3)) for _ in range(20)]
    texts = ["", None, "ab a zz", "x日本x", "z" * 50_000] + ["".join(rnd.choice("abz 日本") for _ in range(rnd.randrange(40))) for _ in range(60)]
    df = spark.createDataFrame([(k, t, "mine") for k, t in enumerate([*texts, "ab a zz"])], "k int, text string, entry string").withColumnRenamed("entry", "other")
    edf = spark.createDataFrame([(e,) for e in entries], "entry string")
    got = sorted((r["k"], r["entry"]) for r in dictionary.occurrences(df, "text", edf, "entry", ("k",), block_chars).collect())
    assert got == sorted((k, e) for k, t in enumerate([*texts, "ab a zz"]) if t for e in {e for e in entries if e} if e in t)
    assert dictionary.occurrences(df, "text", edf.limit(0), "entry", ("k",), block_chars).count() == 0
    assert dictionary.occurrences(df.limit(0), "text", edf, "entry", ("k",), block_chars).count() == 0


NESTED = "id int, a struct<b:struct<c:struct<d:int>, e:string>, `f.g`:int>, h array<struct<x:int, y:struct<z:int>>>, m map<string,int>, b string"


def rows(spark):
    return spark.createDataFrame([(1, ((((5,), "e")), 6), [(1, (2,)), (3, None)], {"k": 1}, "top"), (2, None, None, None, None)], NESTED)


def test_walk(spark):
    out = flatten.flatten(rows(spark))
    assert out.columns == ["id", "a_b_c_d", "a_b_e", "a_f.g", "h", "m", "b"]
    assert [tuple(r)[:4] for r in out.collect()] == [(1, 5, "e", 6), (2, None, None, None)]
    assert flatten.flatten(rows(spark), deepest=2).columns == ["id", "a_b", "a_f.g", "h", "m", "b"]
    assert flatten.flatten(rows(spark), arrays="drop").columns == ["id", "a_b_c_d", "a_b_e", "a_f.g", "m", "b"]
    flat = flatten.flatten(rows(spark), arrays="flatten").orderBy("id").collect()
    assert flat[0]["h_x"] == [1, 3] and flat[0]["h_y_z"] == [2, None] and flat[1]["h_x"] is None


def test_names(spark):
    out = flatten.flatten(rows(spark), {"a.b": "q", "a.b.e": "b", "h": None, "m": None, "gone.away": "x"})
    assert out.columns == ["id", "q_c_d", "b", "a_f.g"]  # two paths of one name: the one that names lists counts first
    assert [r["b"] for r in out.orderBy("id").collect()] == ["e", None]
    first = flatten.flatten(spark.createDataFrame([(None, "y"), ("x", "y"), (None, None)], "p string, r string"), {"p": "n", "r": "n"})
    assert [r["n"] for r in first.collect()] == ["y", "x", None]


def test_award_with_missing_branches(spark):
    df = spark.createDataFrame([(("Acme",), Decimal("1.50"), "07", " ")], "recipient struct<recipient_name:string>, total_obligation decimal(10,2), type string, uri string")
    r = flatten.award_of(df).first().asDict()
    assert r == {"recipient_name": "ACME", "total_obligated_amount": Decimal("1.50"), "award_type": "07", "uri": None, "recipient_name_normalized": "acme", "category": "assistance"}
    bare = flatten.award_of(spark.createDataFrame([(1,)], "x int")).first().asDict()
    assert bare == {"x": 1, "recipient_name_normalized": "unknown"}
