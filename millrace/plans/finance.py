"""Campaign finance profiles, trades and insider forms.

On the fixture tables a supplier is a committee or candidate, a line's return flag
tells support from opposition, and a customer's nation is a seat.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, similarity, strings
from ..operators import forms, fuzzy, joins, ordered, search
from ..session import table
from ..sources import readers
from .registry import query

DEC = "decimal(18,2)"
NO_NAMES = "cast(array() as array<string>)"


@query("SELECT l_suppkey, CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'A'), 0) AS DECIMAL(38,2)) AS supporting, CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'R'), 0) AS DECIMAL(38,2)) AS opposing FROM lineitem GROUP BY l_suppkey")
def agg_ie_sum(spark, sf_dir):
    """Sums by indicator."""
    v = F.col("l_extendedprice").cast(DEC)
    total = lambda f: F.coalesce(F.sum(F.when(F.col("l_returnflag") == f, v)), F.lit(0)).cast("decimal(38,2)")
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(total("A").alias("supporting"), total("R").alias("opposing"))


@query("SELECT l_returnflag, l_suppkey, total FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY total DESC, l_suppkey) AS n FROM (SELECT l_returnflag, l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem GROUP BY 1, 2)) WHERE n <= 2")
def topk_outside(spark, sf_dir):
    """The two largest committees of each side, each once."""
    t = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_suppkey").agg(F.sum(F.col("l_extendedprice").cast(DEC)).alias("total"))
    return ordered.pick(t, ["l_returnflag"], [F.col("total").desc(), F.col("l_suppkey")], 2)


RIVALS = "FROM (SELECT a.c_nationkey, a.c_mktsegment, a.c_custkey, b.c_custkey AS rival, b.c_acctbal AS rival_total, row_number() OVER (PARTITION BY a.c_custkey ORDER BY b.c_acctbal DESC, b.c_custkey) AS place FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND a.c_custkey <> b.c_custkey) WHERE place <= 2"


@query(f"SELECT * {RIVALS}")
def join_rivals(spark, sf_dir):
    """Others of the same seat, the two with the highest receipts."""
    return joins.rivals(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], "c_custkey", "c_acctbal")


@query(f"SELECT c_custkey, rival {RIVALS} AND place = 1")
def topk_rivals(spark, sf_dir):
    return joins.rivals(table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], "c_custkey", "c_acctbal", 1).select("c_custkey", "rival")


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders) WHERE n <= 5")
def topk_recent(spark, sf_dir):
    """The newest five of each."""
    return ordered.pick(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")], 5)


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN year(o_orderdate) = 1998 THEN 0 ELSE 1 END, o_orderkey) AS n FROM orders) WHERE n = 1")
def win_pick_cycle(spark, sf_dir):
    """The row of a cycle, else the first."""
    return ordered.pick(table(spark, sf_dir, "orders"), ["o_custkey"], [F.year("o_orderdate") != 1998, F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END, o_orderkey) AS n FROM orders) WHERE n = 1")
def win_pick_principal(spark, sf_dir):
    return ordered.pick(table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderstatus") != "P", F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, strftime(l_shipdate, '%Y%m%d') || '#' || (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1) AS trade_id FROM lineitem")
def win_seq_id(spark, sf_dir):
    """A sequence number inside each filing."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")) - 1
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.concat_ws("#", F.date_format("l_shipdate", "yyyyMMdd"), n.cast("string")).alias("trade_id"))


@query("SELECT id FROM (SELECT l_suppkey AS id FROM lineitem WHERE l_shipdate > TIMESTAMP '1998-01-01' UNION SELECT unnest([s_suppkey, s_suppkey + 1000000]) FROM supplier)")
def set_discover(spark, sf_dir):
    """Distinct ids from scalar and from list columns."""
    a = table(spark, sf_dir, "lineitem").filter("l_shipdate > timestamp_ntz'1998-01-01'").select(F.col("l_suppkey").alias("id"))
    b = table(spark, sf_dir, "supplier").select(F.explode(F.array(F.col("s_suppkey"), F.col("s_suppkey") + 1_000_000)).alias("id"))
    return a.unionByName(b).distinct()


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 1001 WHEN 3 THEN 50000001 END AS lo, CASE p_partkey % 5 WHEN 0 THEN 15000 END AS hi, CASE p_partkey % 5 WHEN 1 THEN CAST(p_partkey AS DECIMAL(20,2)) WHEN 2 THEN CAST(15000 AS DECIMAL(20,2)) END AS exact FROM part")
def str_amount(spark, sf_dir):
    """Amount texts as ranges or exact amounts."""
    raw = F.expr("case p_partkey % 5 when 0 then '$1,001 - $15,000' when 1 then '$' || p_partkey when 2 then '$15,000 - $1,001' when 3 then '$50,000,001 +' else '' end")
    return table(spark, sf_dir, "part").select("p_partkey", strings.amount_range(raw).alias("a")).select("p_partkey", F.col("a.min").alias("lo"), F.col("a.max").alias("hi"), F.col("a.exact").alias("exact"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN upper(left(regexp_replace(p_brand, '[^A-Za-z]', '', 'g'), 4)) END AS ticker FROM part")
def str_ticker(spark, sf_dir):
    t = F.upper(F.left(F.regexp_replace("p_brand", "[^A-Za-z]", ""), F.lit(4)))
    raw = F.when(F.col("p_partkey") % 3 > 0, F.concat("p_name", F.lit(" ("), t, F.lit(") stock"))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", strings.ticker(raw).alias("ticker"))


@query("SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderkey & 1 > 0 THEN 'director' END, CASE WHEN o_orderkey & 2 > 0 THEN 'owner' END, CASE WHEN o_orderkey & 4 > 0 THEN 'officer' END, CASE WHEN o_orderkey & 8 > 0 THEN 'other' END], lambda x: x IS NOT NULL), ',') AS roles FROM orders")
def bitmask_decode(spark, sf_dir):
    """The relationships that a mask from 0 to 15 stands for."""
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(numbers.flags_of("o_orderkey", ["director", "owner", "officer", "other"]), ",").alias("roles"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(p_name, '') AS explanation FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 25) ON l_partkey = p_partkey")
def join_footnote(spark, sf_dir):
    """A cell's footnote text, empty where there is none."""
    notes = table(spark, sf_dir, "part").filter("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), F.array("p_name").alias("notes"))
    cell = readers.footnoted(F.concat(F.col("l_quantity").cast("string"), F.lit(" (1)")), F.col("notes"))
    return table(spark, sf_dir, "lineitem").join(notes, "l_partkey", "left").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cell["footnote"]["explanation"].alias("explanation"))


@query("SELECT p_partkey, p_name FROM part WHERE length(p_name) >= 5 AND regexp_matches(p_name, '^[A-Za-z][A-Za-z0-9 #''.-]*$') AND NOT regexp_matches(lower(p_name), '\\b(total|page|none)\\b')")
def flt_valid_name(spark, sf_dir):
    """Names without noise: long enough, plain letters, no stop word."""
    n = F.col("p_name")
    return table(spark, sf_dir, "part").filter((F.length(n) >= 5) & n.rlike(r"^[A-Za-z][A-Za-z0-9 #'.-]*$") & ~F.lower(n).rlike(r"\b(total|page|none)\b")).select("p_partkey", "p_name")


NAMES = "CASE o_orderkey % 12 WHEN 0 THEN 'Report ' || o_orderkey WHEN 1 THEN ' name ' WHEN 2 THEN 'Reporter ' || o_orderkey WHEN 3 THEN 'Yr Day x' WHEN 4 THEN 'AB C' WHEN 5 THEN '' || o_orderkey WHEN 6 THEN '--- !!' WHEN 7 THEN 'Al' WHEN 8 THEN 'the honorable X' WHEN 9 THEN NULL WHEN 10 THEN '12 34' ELSE 'Ann Roe ' || o_orderkey END"


@query(f"SELECT o_orderkey, name FROM (SELECT o_orderkey, {NAMES} AS name FROM orders) WHERE o_orderkey % 12 IN (2, 11)")
def flt_filer_name(spark, sf_dir):
    """Names of filers: header words, recognition noise and texts without letters are none."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(NAMES).alias("name"))
    return o.filter(strings.valid_name("name"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE (l_returnflag <> 'N' OR (l_linestatus = 'O' AND l_extendedprice > 50000)) AND NOT regexp_matches(l_returnflag, '[$0-9]')")
def flt_valid_trade(spark, sf_dir):
    """Security, or type and amount; a type that looks like an amount does not count."""
    ok = ((F.col("l_returnflag") != "N") | (F.col("l_linestatus") == "O") & (F.col("l_extendedprice") > 50000)) & ~F.col("l_returnflag").rlike("[$0-9]")
    return table(spark, sf_dir, "lineitem").filter(ok).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT s_suppkey, n_name AS position, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 2 AND s_acctbal >= 0")
def qry_trade(spark, sf_dir):
    t = table(spark, sf_dir, "supplier").join(joins.small(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).withColumnRenamed("n_name", "position")
    return search.lookup(t, "n_regionkey", 2, "s_acctbal", (0, None), tie="s_suppkey").select("s_suppkey", "position", "s_acctbal")


@query("SELECT o_orderkey, o_orderstatus AS form, o_orderdate FROM orders WHERE o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '1997-06-01' AND o_custkey % 10 = 3")
def qry_secf(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("form"), "o_orderdate", (F.col("o_custkey") % 10).alias("entity"))
    return o.filter(search.predicate(form="P", entity=3) & (F.col("o_orderdate") >= F.expr("timestamp_ntz'1997-06-01'"))).select("o_orderkey", "form", "o_orderdate")


FILINGS = "SELECT o_orderkey, o_orderstatus AS form, 'P' || o_custkey AS reporting_for, 'E' || o_custkey % 7 AS filing_entity, CASE WHEN o_orderkey % 3 > 0 THEN 'L' || o_orderkey % 5 END AS located, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 6 END AS incorporated, o_custkey % 40 AS cik, o_orderkey % 90 AS file_number, o_orderkey % 70 AS film_number, o_orderdate AS filing_date FROM {orders}"
FILING_ASKED = {"form": "P", "reporting_for": "P7", "entity": "E3", "location": "L1", "incorporated": 5, "cik": 9, "file_number": 30, "film_number": 11}


@query(" UNION ALL ".join(f"SELECT '{k}' AS index, o_orderkey FROM ({FILINGS.format(orders='orders')}) WHERE {forms.FILING_INDEXES[k][0]} = {v!r} AND filing_date BETWEEN TIMESTAMP '1994-06-01' AND TIMESTAMP '1997-06-01'" for k, v in FILING_ASKED.items()))
def qry_secf_keys(spark, sf_dir):
    """Every index of insider filings by its key, within a range of filing dates."""
    filings = spark.sql(FILINGS, orders=table(spark, sf_dir, "orders"))
    days = tuple(F.expr(f"timestamp_ntz'{d}'") for d in ("1994-06-01", "1997-06-01"))
    parts = [forms.by_index(filings, forms.FILING_INDEXES, k, v, days, tie="o_orderkey").select(F.lit(k).alias("index"), "o_orderkey") for k, v in FILING_ASKED.items()]
    return reduce(DataFrame.unionByName, parts)


@query("SELECT l_suppkey AS trade, CASE WHEN l_suppkey % 3 = 0 THEN -1 ELSE max_by(l_orderkey, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) END AS orderkey FROM lineitem GROUP BY l_suppkey UNION ALL SELECT -5, -1")
def ups_trade(spark, sf_dir):
    """The last write of a key wins over the stored row; stored rows without a write stay."""
    from ..operators import merges

    t = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("trade"), F.col("l_orderkey").alias("orderkey"), "l_shipdate", "l_linenumber", "l_partkey")
    stored = t.dropDuplicates(["trade"]).withColumn("orderkey", F.lit(-1).cast("bigint"))
    stored = stored.unionByName(stored.orderBy("trade").limit(1).withColumn("trade", F.lit(-5).cast("bigint")))
    out = merges.last_write(stored, t.filter("trade % 3 <> 0"), ["trade"], [F.col(c).desc() for c in ("l_shipdate", "orderkey", "l_linenumber", "l_partkey")])
    return out.select("trade", "orderkey")


@query("SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def join_bioguide(spark, sf_dir):
    """Equality of trimmed capitals on both sides."""
    ref = joins.small(table(spark, sf_dir, "nation").select(F.concat(F.lit(" n"), F.col("n_nationkey").cast("string")).alias("ref"), "n_name"))
    s = table(spark, sf_dir, "supplier").withColumn("key", F.concat(F.lit("N"), F.col("s_nationkey").cast("string"), F.lit("  ")))
    return s.join(ref, F.upper(F.trim("key")) == F.upper(F.trim("ref"))).select("s_suppkey", "n_name")


def _names(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Filer names with a slip, and the reference list."""
    ref = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ref_id"), F.concat(F.lit("Ann "), F.initcap("n_name")).alias("ref_name"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    filer = s.join(joins.small(ref), F.col("s_nationkey") == F.col("ref_id")).select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.substring_index("ref_name", " ", -1), F.lit(", Ann (Senator)"))).when(F.col("s_suppkey") % 3 == 1, F.concat(F.col("ref_name"), F.lit("s"))).otherwise(F.col("ref_name")).alias("filer"))
    return filer, ref


@query()
def sim_ratio(spark, sf_dir):
    """Each filer's ratio with every reference; equal names are scored once."""
    filer, ref = _names(spark, sf_dir)
    pairs = joins.with_all(filer.select("filer").distinct(), ref)
    scored = pairs.select("filer", "ref_id", F.round(similarity.sim_ratio(F.lower("filer"), F.lower("ref_name")), 6).alias("ratio"))
    return filer.join(scored, "filer").select("s_suppkey", "ref_id", "ratio")


@query("SELECT s_suppkey, s_nationkey AS ref_id FROM supplier")
def join_fuzzy(spark, sf_dir):
    """The most similar name of a list, from the accepted score on."""
    filer, ref = _names(spark, sf_dir)
    out = fuzzy.nearest(filer, ref.withColumn("alts", F.expr(NO_NAMES)), similarity.SENATE, ["filer"], ["ref_name", "alts"], "ref_id")
    return out.select("s_suppkey", F.col("ref_id").cast("int").alias("ref_id"))


@query("SELECT s_suppkey, s_nationkey AS ref_id FROM supplier")
def join_bio_else_fuzzy(spark, sf_dir):
    """By id where there is one, else by the most similar name."""
    filer, ref = _names(spark, sf_dir)
    ref = ref.withColumn("alts", F.expr(NO_NAMES))
    known = filer.join(table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey")).alias("bio")), "s_suppkey")
    known = known.withColumn("name", strings.flip_name(strings.clean_name("filer")))
    match = lambda rest: fuzzy.nearest(rest, ref, similarity.FILING, ["name"], ["ref_name", "alts"], "ref_id")
    return joins.by_key_else(known, ref, known["bio"], ref["ref_id"], match, "s_suppkey").select("s_suppkey", F.col("ref_id").cast("int").alias("ref_id"))


@query()
def fz_scores(spark, sf_dir):
    """All scorers side by side on the same pairs; equal names are scored once."""
    filer, ref = _names(spark, sf_dir)
    p = joins.with_all(filer.select("filer").distinct(), ref)
    s, r = strings.split_name("filer"), strings.split_name("ref_name")
    args = ["filer", "ref_name", s["first"], r["first"], s["last"], r["last"]]
    scored = p.select("filer", "ref_id", F.round(similarity.senate_score("filer", "ref_name"), 6).alias("senate"), F.round(similarity.filing_score("filer", "ref_name"), 6).alias("filing"), F.round(similarity.house_score(strings.flip_name(strings.clean_name("filer")), F.coalesce(r["first"], F.lit("")), F.coalesce(r["middle"], F.lit("")), F.coalesce(r["last"], F.lit("")), "ref_name"), 6).alias("house"), F.round(similarity.bill_score(*args), 6).alias("bill"), F.round(similarity.vote_score(*args), 6).alias("vote"))
    return filer.join(scored, "filer").drop("filer").select("s_suppkey", *scored.columns[1:])


# ---------------------------------------------------------------- best matches of the five scorers

#: Slips by c_custkey % 7, and what each leaves of a name of n characters: as it is with the office, flipped, one
#: letter more at the end, one more after the first name, one other, one less, and a nickname.
SLIPS = (
    lambda last: F.concat(F.lit("ANN "), F.upper(last), F.lit(" (Senator)")),
    lambda last: F.concat(last, F.lit(", Ann")),
    lambda last: F.concat(F.lit("Ann "), last, F.lit("s")),
    lambda last: F.concat(F.lit("Annq "), last),
    lambda last: F.concat(F.lit("Anx "), last),
    lambda last: F.concat(F.lit("An "), last),
    lambda last: F.concat(F.lit("Annie "), last),
)
RATIOS = "CASE c_custkey % 7 WHEN 0 THEN 1.0 WHEN 1 THEN 1.0 WHEN 2 THEN 2.0 * n / (2 * n + 1) WHEN 3 THEN 2.0 * n / (2 * n + 1) WHEN 4 THEN (n - 1.0) / n WHEN 5 THEN 2.0 * (n - 1) / (2 * n - 1) ELSE 2.0 * n / (2 * n + 2) END"
PEOPLE = f"FROM (SELECT *, {RATIOS} AS r, c_custkey % 7 AS slip FROM (SELECT c_custkey, c_nationkey, length(n_name) + 4 AS n FROM customer JOIN nation ON c_nationkey = n_nationkey))"


def _people(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Customers as people whose names have slips, and the reference list with its parts; ids are texts."""
    n = table(spark, sf_dir, "nation")
    last = F.initcap("n_name")
    ref = n.select(F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("ref_id"), F.concat(F.lit("Ann "), last).alias("ref_name"), F.lit("Ann").alias("first"), F.lit("").alias("middle"), last.alias("last"), F.lit("").alias("suffix"), F.upper(F.left("n_name", F.lit(1))).alias("party"), F.col("n_regionkey").cast("string").alias("state"), F.expr(NO_NAMES).alias("alts"))
    c = table(spark, sf_dir, "customer").join(joins.small(n), F.col("c_nationkey") == F.col("n_nationkey"))
    slip = F.coalesce(*[F.when(F.col("c_custkey") % 7 == k, f(last)) for k, f in enumerate(SLIPS)])
    people = c.select("c_custkey", slip.alias("name"), F.lit("Ann").alias("p_first"), last.alias("p_last"), F.left("n_name", F.lit(1)).alias("p_party"), F.col("n_regionkey").cast("string").alias("p_state"))
    return people, ref


def _matched(df: DataFrame) -> DataFrame:
    return df.select("c_custkey", F.substring("ref_id", 2, 2).cast("int").alias("ref_id"), F.round("score", 6).alias("score"))


@query(f"SELECT c_custkey, c_nationkey AS ref_id, round(CASE WHEN slip = 2 THEN greatest(r, 0.9) ELSE r END, 6)::DOUBLE AS score {PEOPLE} WHERE r >= 0.85")
def fz_senate(spark, sf_dir):
    """The Senate scorer's best match: flips and offices do not count, a contained name is worth .9."""
    people, ref = _people(spark, sf_dir)
    return _matched(fuzzy.nearest(people, ref, similarity.SENATE, ["name"], ["ref_name", "alts"], "ref_id"))


@query(f"SELECT c_custkey, c_nationkey AS ref_id, round(least(1.0, r + CASE WHEN slip = 2 THEN 0.0 ELSE 0.1 END), 6)::DOUBLE AS score {PEOPLE} WHERE r >= CASE WHEN slip = 2 THEN 0.85 ELSE 0.75 END")
def fz_filing(spark, sf_dir):
    """The filing scorer's best match, on cleaned names: equal last words add a tenth."""
    people, ref = _people(spark, sf_dir)
    people = people.withColumn("name", strings.flip_name(strings.clean_name("name")))
    return _matched(fuzzy.nearest(people, ref, similarity.FILING, ["name"], ["ref_name", "alts"], "ref_id"))


@query(f"SELECT c_custkey, c_nationkey AS ref_id, round(CASE slip WHEN 6 THEN 1.0 WHEN 2 THEN greatest(r, 0.9) ELSE r END, 6)::DOUBLE AS score {PEOPLE} WHERE r >= 0.85 OR slip = 6")
def fz_house(spark, sf_dir):
    """The House scorer's best match: first name or nickname and last name are enough; compound last names go by the ratio."""
    people, ref = _people(spark, sf_dir)
    people = people.withColumn("name", strings.flip_name(strings.clean_name("name")))
    ref = ref.withColumn("last", F.substring_index("last", " ", -1))
    return _matched(fuzzy.nearest(people, ref, similarity.house({"ann": ["annie", "nan"]}), ["name"], ["ref_name", "first", "middle", "last", "suffix", "alts"], "ref_id"))


@query(f"SELECT c_custkey, c_nationkey AS ref_id, round(0.5 * CASE WHEN slip = 2 THEN greatest(r, 0.9) ELSE r END + 0.7, 6)::DOUBLE AS score {PEOPLE}")
def fz_bill(spark, sf_dir):
    """The bill scorer's best match: name, first and last name, party and state."""
    people, ref = _people(spark, sf_dir)
    return _matched(fuzzy.nearest(people, ref, similarity.BILL, ["name", "p_first", "p_last", "p_party", "p_state"], ["ref_name", "first", "last", "party", "state", "alts"], "ref_id"))


@query(f"SELECT c_custkey, c_nationkey AS ref_id, round(0.5 * r + 0.4, 6)::DOUBLE AS score {PEOPLE}")
def fz_vote(spark, sf_dir):
    """The vote scorer's best match: half the ratio, and first and last name; a flipped name is turned first."""
    people, ref = _people(spark, sf_dir)
    people = people.withColumn("name", strings.flip_name(strings.clean_name("name")))
    return _matched(fuzzy.nearest(people, ref, similarity.VOTE, ["name", "p_first", "p_last"], ["ref_name", "first", "last", "alts"], "ref_id"))


@query("SELECT page, string_agg(line, chr(10) ORDER BY line_no) AS body FROM (SELECT l_orderkey AS page, l_linenumber AS line_no, string_agg(CAST(l_partkey AS VARCHAR), ' | ' ORDER BY l_partkey, l_suppkey) AS line FROM lineitem GROUP BY 1, 2) GROUP BY page")
def src_ocr_table(spark, sf_dir):
    """Cells regrouped into rows by their row and column, and rows into a table."""
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("line_no"), F.struct("l_partkey", "l_suppkey", F.col("l_partkey").cast("string").alias("text")).alias("cell"))
    rows = c.groupBy("page", "line_no").agg(F.array_sort(F.collect_list("cell")).alias("cells")).select("page", F.struct("line_no", F.array_join(F.transform("cells", lambda x: x["text"]), " | ").alias("line")).alias("r"))
    return rows.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["line"]), "\n").alias("body"))
