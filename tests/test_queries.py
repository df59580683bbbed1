"""Every query against its SQL; those without run and keep their schema."""

from __future__ import annotations

import pytest
from compare import assert_same

from millrace import plans

QUERIES, SQL = plans.load()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, sf_dir, duck):
    assert_same(QUERIES[name](spark, sf_dir), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_scorers_meet_the_whole_list(spark, sf_dir):
    """Every filer against every reference, as brute force scores them."""
    from millrace.functions import similarity
    from millrace.plans import finance

    filer, ref = (df.collect() for df in finance._names(spark, sf_dir))
    pairs = {(f["s_suppkey"], r["ref_id"]): (f["filer"], r["ref_name"]) for f in filer for r in ref}
    got = {(r["s_suppkey"], r["ref_id"]): r["ratio"] for r in finance.sim_ratio(spark, sf_dir).collect()}
    assert got == pytest.approx({k: similarity.ratio(a.lower(), b.lower()) for k, (a, b) in pairs.items()}, abs=1e-6)
    rows = finance.fz_scores(spark, sf_dir).collect()
    assert len(rows) == len(pairs)
    assert {(r["s_suppkey"], r["ref_id"]): r["senate"] for r in rows} == pytest.approx({k: similarity.score_senate(*x) for k, x in pairs.items()}, abs=1e-6)
    assert {(r["s_suppkey"], r["ref_id"]): r["filing"] for r in rows} == pytest.approx({k: similarity.score_filing(*x) for k, x in pairs.items()}, abs=1e-6)


def test_districts_of_a_long_nation_table(spark, tmp_path):
    """No nation is dropped, however many there are."""
    spark.range(1500).selectExpr("cast(id as int) AS n_nationkey", "'NAME' AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(1500).selectExpr("id AS s_suppkey", "cast(id as int) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    assert QUERIES["str_district"](spark, str(tmp_path)).count() == 1500
