"""Hand-made rows that the tables do not have."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, numbers, similarity, strings, text
from millrace.operators import joins, merges, ordered, sinks
from millrace.sources import readers


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in zip(values, (kind(v) for v in values.values()), strict=True))) if values else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


def kind(v):
    return "string" if v is None or isinstance(v, str) else "bigint" if isinstance(v, int) else "double"


@pytest.mark.parametrize(("raw", "low", "high", "exact"), [("$1,001 - $15,000", 1001, 15000, None), ("$15,000 - $1,001", None, None, 15000), ("$50,000,001 +", 50000001, None, None), ("Over $50,000,000", 50000000, None, None), ("15000.5", None, None, 15000.5), ("", None, None, None), ("abc", None, None, None), ("$500 - $500", None, None, 500)])
def test_amounts(spark, raw, low, high, exact):
    a = one(spark, strings.amount_range(F.lit(raw)))
    assert (a["min"], a["max"], None if a["exact"] is None else float(a["exact"])) == (low, high, exact)


@pytest.mark.parametrize(("v", "box"), [(0, (0, 1000)), (-5, (0, 1000)), (1001, (1001, 15000)), (15000.5, (0, 1000)), (60000000, (50000001, None))])
def test_amount_bucket(spark, v, box):
    assert tuple(one(spark, numbers.amount_bucket(F.lit(v)))) == box


@pytest.mark.parametrize(("raw", "ymd"), [("8/14/25", 20250814), ("1/2/1999", 19990102), ("20251002", 20251002), ("1/2/70", 19700102), ("2024-02-30", None), ("2024-03-01T10:00", 20240301), ("soon", None)])
def test_dates(spark, raw, ymd):
    assert one(spark, dates.ymd_int(F.lit(raw))) == ymd


def test_fiscal_year_edges(spark):
    assert one(spark, dates.fiscal_year(F.lit(datetime.date(2024, 9, 30)))) == 2024
    assert one(spark, dates.fiscal_year(F.lit(datetime.date(2024, 10, 1)))) == 2025


def test_names(spark):
    assert one(spark, strings.clean_name(F.lit("Hon. Jane Roe [R-TX-3]"))) == "Jane Roe"
    assert one(spark, strings.flip_name(F.lit("Roe, Jane"))) == "Jane Roe"
    assert one(spark, strings.split_name(F.lit("Roe, Hon.. Jane Q.")))["last"] == "Roe"
    assert tuple(one(spark, strings.party_bracket(F.lit("Sen. X [I-VT]")))) == ("I", "VT", None)


def test_scorers():
    assert similarity.score_senate("Doe, John (Senator)", "john doe") == 1.0
    assert similarity.score_senate("John Doe", "John A. Doe") < 1.0
    assert similarity.score_filing("J Doe", "John Doe", ["j doe"]) == 0.95
    assert similarity.score_house("Michael Collins", "Mike", "Allen", "Collins", "Mike Allen Collins", nicknames={"michael": ["mike"]}) == 1.0
    assert similarity.score_house("Collins, Mike", "Mike", "", "Collins", "Mike Allen Collins") == 0.95
    assert similarity.score_bill("John Doe", "John Doe", "John", "John", "Doe", "Doe", "D", "Democrat", "NY", "ny") == pytest.approx(1.2)
    assert similarity.score_vote("John Doe", "John Doe", "John", "John", "Doe", "Roe") == pytest.approx(0.7)


def test_sector_order(spark):
    assert one(spark, numbers.sector(F.lit("2834"))) == "Health Care"
    assert one(spark, numbers.sector(F.lit("2834"), literal=True)) == "Materials"
    assert one(spark, numbers.sector(F.lit("9999"), F.lit("A drug maker"))) == "Health Care"
    assert one(spark, numbers.sector(F.lit("x"), F.lit("bank"))) == "Unknown"


def test_text(spark):
    assert one(spark, text.normal(F.lit("Don’t — STOP"))) == "don't - stop"
    assert one(spark, text.normal(F.lit("Don’t"), quotes=False)) == "don’t"
    assert one(spark, text.tokens(F.lit("a state-of-art b.c"))) == ["a", "state", "of", "art", "state-of-art", "b.c"]
    assert one(spark, text.phrases(F.array(*map(F.lit, "abc")))) == ["a b", "b c", "a b c"]
    assert one(spark, text.phrases(F.array(F.lit("a")))) == []
    assert one(spark, text.with_possessives(F.lit("walmart's sale"))) == "walmart's sale walmart sale walmart's walmart sale"
    assert one(spark, text.company_name(F.lit("Acme, Inc."))) == "acme"
    assert one(spark, text.company_name(F.lit("  Bank of Co-op Motors Co. (Holdings) "))) == "of op"
    assert one(spark, text.company_name(F.lit("Incorp Group LLC"))) == "incorp"
    held = lambda name: one(spark, text.company_in(F.lit("we asked general engines and it"), F.lit(name)))
    assert [held(x) for x in ("general engines", "general motors", "and it", "it", "and co", "tesla")] == ["general engines", "general", "and it", None, None, None]
    terms = one(spark, text.key_terms(F.array(F.lit("The rate's a rise"), F.lit("x" * 26))))
    assert terms == ["the", "rates", "rise", "x" * 26, "The rate's a rise"]
    short = F.array(*map(F.lit, ["the", "at", "ge", "rise", "y" * 51]))
    assert one(spark, text.without_common(short)) == ["rise"] and one(spark, text.without_common(short, F.array(F.lit("ge")))) == ["ge", "rise"]
    listed = F.array(*map(F.lit, ["international", "rate", "acme holdings x"]))
    assert one(spark, text.ranked_keywords(listed, F.array(F.lit("t")), F.array(F.lit("acme holdings x")))) == ["rate", "acme holdings x", "international"]
    assert one(spark, strings.pick_format(F.array(F.lit("a.PDF"), F.lit("b.htm")))) == "b.htm"


def test_asof_fallback_and_ties(spark):
    left = spark.createDataFrame([("a", 1), ("a", 5), ("b", 1)], "k string, t int")
    right = spark.createDataFrame([("a", 5, 50), ("a", 3, 30)], "k string, t int, v int")
    got = {(r.k, r.t): r.v for r in joins.asof(left, right, ["k"], "t", ["v"]).collect()}
    assert got == {("a", 1): 30, ("a", 5): 50, ("b", 1): None}
    strict = {(r.k, r.t): r.v for r in joins.asof(left, right, ["k"], "t", ["v"], fallback_first=False).collect()}
    assert strict[("a", 1)] is None


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", [1, 2]), (2, "b", None)], "k int, v string, xs array<int>")
    new = spark.createDataFrame([(1, None, [2, 3]), (3, "c", [9])], "k int, v string, xs array<int>")
    f = lambda o: merges.upsert(o, new, ["k"], lists=("xs",), counts={"n": "xs"})
    once = f(old)
    assert sorted(map(tuple, f(once.drop("n")).collect()), key=lambda r: r[0]) == sorted(map(tuple, once.collect()), key=lambda r: r[0])
    assert {r.k: (r.v, r.xs, r.n) for r in once.collect()} == {1: ("a", [1, 2, 3], 3), 2: ("b", None, 0), 3: ("c", [9], 1)}
    batch = merges.upsert(old, new, ["k"], lists=("xs",), counts={"n": "xs"}, counts_of="batch")
    assert {r.k: r.n for r in batch.collect()}[1] == 2


def test_merge_rows_keeps_keyless(spark):
    old = spark.createDataFrame([(1, "x")], "o int, key string")
    new = spark.createDataFrame([(1, "x"), (1, None), (1, None), (2, "x")], "o int, key string")
    assert sorted(map(str, merges.merge_rows(old, new, "o", F.col("key")).collect())) == sorted(map(str, spark.createDataFrame([(1, "x"), (1, None), (1, None), (2, "x")], "o int, key string").collect()))


def test_best_match_tie_and_bound(spark):
    ref = spark.createDataFrame([(2, "b"), (1, "b")], "r int, n string")
    left = spark.createDataFrame([(7, "b")], "i int, m string")
    assert joins.best_match(left, ref, F.when(F.col("n") == F.col("m"), 1.0).otherwise(0.0), "i", "r", 0.5).first()["r"] == 1


def test_batches_are_not_even(spark):
    df = spark.range(5).withColumn("g", F.lit(1))
    assert [len(r["keys"]) for r in ordered.batches(df, ["g"], ["id"], 2, "id").orderBy("batch_number").collect()] == [2, 2, 1]


def test_page_walks_all_rows(spark):
    df = spark.createDataFrame([(k, k % 3) for k in range(10)], "k int, s int")
    seen, after = [], None
    while rows := ordered.page(df, "s", "k", 4, after).collect():
        seen += [r.k for r in rows]
        after = (rows[-1].s, rows[-1].k)
    assert sorted(seen) == list(range(10)) and len(seen) == 10


def test_quarantine_and_stubs(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y" * 50)], "k int, v string")
    ok, bad = sinks.quarantine(df, {"v": F.col("v").isNotNull()})
    assert ok.count() == 2 and bad.first()["errors"] == ["v"]
    stub, whole = sinks.split_stubs(df, ["k"], most=40)
    assert whole.first()["k"] == 3 and {r.k: r.v for r in stub.collect()}[3] is None


def test_manifest_ignores_layout(spark):
    df = spark.range(100)
    assert sinks.manifest(df.repartition(7)).first() == sinks.manifest(df).first()
    assert sinks.manifest(df.filter("id < 0")).first()["row_count"] == 0


def test_readers(spark):
    assert one(spark, readers.untag(F.lit('{"N":"62"}'))) == "62" and one(spark, readers.untag(F.lit("x"))) == "x"
    cell = one(spark, readers.footnoted(F.lit("100 (2)"), F.create_map(F.lit(1), F.lit("a"))))
    assert cell["value"] == "100" and cell["footnote"]["explanation"] == ""


def test_metrics_need_two_points(spark):
    from millrace.plans.stocks import eod_metrics

    ts = [datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 20), datetime.datetime(2024, 1, 20, 12)]
    rows = [("one", ts[0], 5.0, 0, 5.0, 5.0, 1), ("few", ts[0], 0.0, 10, 1.0, 1.0, 1), ("few", ts[1], 4.0, 0, 6.0, 6.0, 1), ("few", ts[2], 8.0, 0, 8.0, 4.0, 1)]
    got = {(r.symbol, r.timeframe): r for r in eod_metrics(spark.createDataFrame(rows, "symbol string, ts timestamp, close double, volume bigint, high double, low double, market_cap bigint")).collect()}
    assert got["one", "1d"].current_price == 0.0 and got["one", "1y"].volatility == 0.0
    assert got["few", "1d"].previous_close == 4.0 and got["few", "30d"].previous_close == 0.0 and got["few", "30d"].price_change_percent == 0.0
    assert got["few", "30d"].avg_volume == 10 and got["few", "1y"].year_low == 1.0


def test_zip_and_constants(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/one.csv", "a,b\n1,2\n")
        z.writestr("two.txt", "no")
    got = readers.read_zip(spark, str(tmp_path), ".csv").collect()
    assert [(r["member"], r["content"]) for r in got] == [("x/one.csv", "a,b\n1,2\n")]
    assert readers.code_list(spark, {1: "one"}).first()["code"] == "1"
    assert one(spark, dates.congress_range(F.lit(2021), F.lit(2024))) == [117, 118]
    assert one(spark, dates.on_date(F.lit("1/2/2024"), "2024-01-02")) and not one(spark, dates.on_date(F.lit("soon"), "2024-01-02"))


def test_other_names_and_nicknames_reach_the_scores(spark):
    from pyspark.sql import functions as F

    from millrace.functions import similarity

    rows = [("Bob Roe", "Robert", "", "Roe", "Robert Roe", ["R. Roe", "Bobby Roe"]), ("Bobby Roe", "Robert", "", "Roe", "Robert Roe", ["R. Roe", "Bobby Roe"]), ("Ann Poe", "Robert", "", "Roe", "Robert Roe", [])]
    df = spark.createDataFrame(rows, "name string, first string, middle string, last string, ref string, alts array<string>")
    house = similarity.house_scorer({"robert": ["bob", "rob"]})
    got = df.select(house("name", "first", "middle", "last", "ref", "alts").alias("house"), similarity.house_score("name", "first", "middle", "last", "ref").alias("plain"), similarity.senate_score("name", "ref", "alts").alias("senate"), similarity.filing_score("name", "ref", "alts").alias("filing")).collect()
    assert got[0]["house"] == 1.0 > got[0]["plain"] and got[1]["house"] == got[1]["senate"] == 1.0 and got[1]["filing"] == 0.95
    assert all(got[2][c] < 0.85 for c in ("house", "senate", "filing"))
    assert df.select(F.round(similarity.sim_ratio("name", "ref"), 3)).count() == 3


def test_fuzzy_join_beyond_a_short_list(spark, monkeypatch):
    """A list longer than may be broadcast gives the same matches, dealt in blocks, and by shared words."""
    from pyspark.sql import functions as F

    from millrace.functions import similarity
    from millrace.operators import joins

    ref = spark.range(300).select(F.col("id").alias("ref_id"), F.concat(F.lit("Ann Number"), F.col("id").cast("string"), F.lit(" Roe")).alias("ref_name"))
    left = spark.range(12).select(F.col("id").alias("k"), F.concat(F.lit("Ann Number"), (F.col("id") * 7).cast("string"), F.lit(" Roes")).alias("name"))
    best = lambda **kw: {r["k"]: r["ref_id"] for r in joins.best_match(left, ref, similarity.senate_score("name", "ref_name"), "k", "ref_id", 0.85, **kw).collect()}
    want = best()
    assert want == {k: 7 * k for k in range(12)} == best(names=(F.col("name"), F.col("ref_name")))
    monkeypatch.setattr(joins, "SMALL_ROWS", 40)
    assert best() == want and joins.with_all(left, ref).count() == 12 * 300


def test_running_state_outlives_a_drain_with_nothing_new(spark, tmp_path):
    from pyspark.sql import functions as F

    from millrace.streaming import flows

    spark.range(20).select((F.col("id") % 3).alias("k")).write.parquet(str(tmp_path / "in"))
    count = lambda s: s.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    stream = lambda: flows.read_stream(spark, str(tmp_path / "in"), "*.parquet", 1)
    first = sorted(map(tuple, flows.latest_state(stream(), count, str(tmp_path / "state")).collect()))
    assert first == [(0, 7), (1, 7), (2, 6)]
    assert sorted(map(tuple, flows.latest_state(stream(), count, str(tmp_path / "state")).collect())) == first
    good, bad = flows.split_bad(stream().filter("k > 9"), {"k": F.col("k") > 0}, str(tmp_path / "split"))
    assert good.count() == bad.count() == 0
