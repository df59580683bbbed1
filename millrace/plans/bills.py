"""Bills, votes, members.

On the fixture tables a conversation is a bill, its turns are rolls or actions,
and a role is a party or a vote.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, strings
from ..operators import forms, joins, merges, ordered, search
from ..session import table
from .registry import query


def turns(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations")


@query("SELECT conv_id, CAST(count(DISTINCT role) AS INTEGER) AS parties, CASE WHEN bool_or(role = 'user') AND bool_or(role = 'assistant') THEN 1 ELSE 0 END AS bipartisan FROM conversations GROUP BY conv_id")
def agg_party(spark, sf_dir):
    """Distinct parties of the sponsors, and whether both of the two are among them."""
    g = turns(spark, sf_dir).groupBy("conv_id").agg(F.collect_set("role").alias("p"))
    return g.select("conv_id", F.size("p").alias("parties"), (F.array_contains("p", "user") & F.array_contains("p", "assistant")).cast("int").alias("bipartisan"))


@query("SELECT roll, bill, role FROM (SELECT turn AS roll, CASE WHEN conv_id % 3 > 0 THEN CAST(conv_id AS VARCHAR) ELSE '' END AS bill, role, row_number() OVER (PARTITION BY turn ORDER BY CASE WHEN conv_id % 3 > 0 THEN 0 ELSE 1 END, conv_id) AS n FROM conversations) WHERE n = 1")
def win_dedup_one(spark, sf_dir):
    """One entry for each roll: one with a bill before one without, else the first seen."""
    v = turns(spark, sf_dir).select(F.col("turn").alias("roll"), F.when(F.col("conv_id") % 3 > 0, F.col("conv_id").cast("string")).otherwise("").alias("bill"), "role", "conv_id")
    return ordered.pick(v, ["roll"], [F.col("bill") == "", F.col("conv_id")]).select("roll", "bill", "role")


@query("SELECT conv_id, role, min(turn) AS first_turn, string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS votes FROM conversations GROUP BY conv_id, role")
def win_dedup_action(spark, sf_dir):
    """Equal actions merged into the first, with the votes of all."""
    a = turns(spark, sf_dir).select("conv_id", "role", "turn", F.array("turn").alias("votes"))
    g = a.groupBy("conv_id", "role").agg(F.min("turn").alias("first_turn"), F.array_sort(F.flatten(F.collect_list("votes"))).alias("v"))
    return g.select("conv_id", "role", "first_turn", F.array_join(F.col("v").cast("array<string>"), ",").alias("votes"))


@query("SELECT roll, role, src FROM (SELECT conv_id % 50 AS roll, role, CASE WHEN turn % 2 = 0 THEN 'action' ELSE 'bill' END AS src, row_number() OVER (PARTITION BY conv_id % 50, role ORDER BY CASE WHEN turn % 2 = 0 THEN 1 ELSE 0 END, conv_id, turn) AS n FROM conversations) WHERE n = 1")
def win_dedup_vote(spark, sf_dir):
    """One vote for each roll and chamber: a bill's own before an action's."""
    v = turns(spark, sf_dir).select((F.col("conv_id") % 50).alias("roll"), "role", F.when(F.col("turn") % 2 == 0, "action").otherwise("bill").alias("src"), "conv_id", "turn")
    return ordered.pick(v, ["roll", "role"], [F.col("src") == "action", F.col("conv_id"), F.col("turn")]).select("roll", "role", "src")


@query("SELECT conv_id || '-' || role || '-' || turn AS id, CAST(conv_id AS INTEGER) AS congress, upper(role) AS bill_type, CAST(turn AS INTEGER) AS number, conv_id || '-' || upper(role) || '-' || turn AS rebuilt FROM conversations")
def str_billid(spark, sf_dir):
    t = turns(spark, sf_dir).select(F.concat_ws("-", F.col("conv_id").cast("string"), "role", F.col("turn").cast("string")).alias("id")).withColumn("b", strings.parse_bill_id("id"))
    return t.select("id", "b.*", strings.bill_id("b.congress", "b.bill_type", "b.number").alias("rebuilt"))


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id % 50 ORDER BY CASE WHEN conv_id % 7 = 0 THEN -1 ELSE turn END DESC, conv_id DESC, turn) AS place FROM conversations")
def sort_votes(spark, sf_dir):
    """A member's votes, newest first, a number that is none as -1."""
    raw = F.when(F.col("conv_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("turn").cast("string"))
    n = F.coalesce(raw.try_cast("int"), F.lit(-1))
    return turns(spark, sf_dir).select("conv_id", "turn", F.row_number().over(Window.partitionBy(F.col("conv_id") % 50).orderBy(n.desc(), F.col("conv_id").desc(), "turn")).alias("place"))


@query("SELECT role, string_agg(DISTINCT CAST(conv_id % 12 AS VARCHAR), ',' ORDER BY CAST(conv_id % 12 AS VARCHAR)) AS rolls FROM conversations GROUP BY role")
def sort_rollkey(spark, sf_dir):
    """Rolls in the order of their text, in which 10 comes before 9."""
    return turns(spark, sf_dir).groupBy("role").agg(F.array_join(F.array_sort(F.collect_set((F.col("conv_id") % 12).cast("string"))), ",").alias("rolls"))


@query("(SELECT conv_id, turn FROM conversations WHERE turn < 3 AND (conv_id, turn) NOT IN (SELECT conv_id, turn FROM conversations WHERE conv_id % 2 = 0)) UNION (SELECT conv_id, turn FROM conversations WHERE conv_id % 2 = 0 AND role = 'system')")
def set_diff_union(spark, sf_dir):
    """Rolls found and not stored, and stored ones without members."""
    t = turns(spark, sf_dir)
    return merges.delta(t.filter("turn < 3"), t.filter("conv_id % 2 = 0").select("conv_id", "turn"), t.filter("conv_id % 2 = 0 and role = 'system'").select("conv_id", "turn"), ["conv_id", "turn"])


@query("SELECT c_custkey, 0 AS n_votes, '' AS last_roll FROM customer WHERE c_custkey NOT IN (SELECT conv_id FROM conversations)")
def set_seed(spark, sf_dir):
    """An empty row for each member without votes."""
    have = turns(spark, sf_dir).select(F.col("conv_id").alias("c_custkey"))
    return merges.seed(table(spark, sf_dir, "customer"), have, "c_custkey", n_votes=F.lit(0), last_roll=F.lit(""))


@query("SELECT conv_id, max(turn) FILTER (role <> 'system') AS new_turn, CASE WHEN conv_id % 4 = 0 THEN NULL ELSE min(role) END AS kept FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role <> 'system') > 0")
def ups_bill(spark, sf_dir):
    """The new row whole, but for columns that stay as stored where they are."""
    g = turns(spark, sf_dir).groupBy("conv_id")
    old = g.agg(F.min("role").alias("kept"), F.lit(-1).cast("bigint").alias("new_turn")).filter("conv_id % 4 <> 0")
    new = turns(spark, sf_dir).filter("role <> 'system'").groupBy("conv_id").agg(F.max("turn").alias("new_turn")).withColumn("kept", F.when(F.col("conv_id") % 4 != 0, "new"))
    return merges.upsert(old, new, ["conv_id"], keep_old=("kept",)).filter("new_turn >= 0").select("conv_id", "new_turn", "kept")


@query("SELECT conv_id % 20 AS member, turn AS roll, min_by(conv_id, (role, conv_id)) AS bill FROM conversations GROUP BY 1, 2")
def ups_vote(spark, sf_dir):
    """Entries of store and batch merged, one for each member and roll."""
    t = turns(spark, sf_dir).select((F.col("conv_id") % 20).alias("member"), F.col("turn").alias("roll"), F.col("conv_id").alias("bill"), "role")
    both = t.filter("bill % 2 = 0").unionByName(t.filter("bill % 2 = 1"))
    return ordered.pick(both, ["member", "roll"], [F.col("role"), F.col("bill")]).select("member", "roll", "bill")


@query("""
WITH old AS (SELECT conv_id % 20 AS member, 'R' || turn AS roll_id, CASE WHEN conv_id % 3 = 0 THEN '' ELSE 'B' || conv_id END AS bill_id, CASE role WHEN 'user' THEN 'Yea' WHEN 'assistant' THEN 'Nay' ELSE 'Present' END AS vote_type,
  0 AS side, CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END AS kind, conv_id, turn FROM conversations WHERE conv_id % 2 = 0 AND role IS NOT NULL),
new AS (SELECT conv_id % 20 AS member, 'R' || turn AS roll_id, CASE WHEN conv_id % 5 = 0 THEN '' ELSE 'N' || conv_id END AS bill_id, 'Not Voting' AS vote_type, 1 AS side, 0 AS kind, conv_id, turn FROM conversations WHERE conv_id % 2 = 1)
SELECT member, roll_id, bill_id, vote_type FROM (SELECT *, row_number() OVER (PARTITION BY member, roll_id ORDER BY CASE WHEN bill_id = '' THEN 1 ELSE 0 END, side, kind, conv_id, turn) AS n FROM (FROM old UNION ALL FROM new)) WHERE n = 1
""")
def ups_vote_lists(spark, sf_dir):
    """The store's eight lists as entries, merged with a batch's entries: one for each member and roll."""
    t = turns(spark, sf_dir).filter("role is not null").select((F.col("conv_id") % 20).alias("member"), "conv_id", "turn", "role")
    entry = F.struct("conv_id", "turn", F.when(F.col("conv_id") % 3 == 0, "").otherwise(F.concat(F.lit("B"), F.col("conv_id"))).alias("bill"), F.concat(F.lit("R"), F.col("turn")).alias("roll"))
    kind = F.when(F.col("role") == "user", "yea").when(F.col("role") == "assistant", "nea").otherwise("present")
    lists = t.filter("conv_id % 2 = 0").groupBy("member").agg(*[F.array_sort(F.collect_list(F.when(kind == k, entry))).alias(k) for k in ("yea", "nea", "present")])
    none = F.lit(None).cast("array<string>")
    cols = [F.transform(k, lambda e: e["bill"]).alias(f"bill_{k}") for k in ("yea", "nea", "present")] + [F.transform(k, lambda e: e["roll"]).alias(f"roll_{k}") for k in ("yea", "nea", "present")]
    store = merges.entries_of_lists(lists.select("member", *cols, none.alias("bill_not_voting"), none.alias("roll_not_voting")), "member")
    new = turns(spark, sf_dir).filter("conv_id % 2 = 1").select((F.col("conv_id") % 20).alias("member"), F.when(F.col("conv_id") % 5 == 0, "").otherwise(F.concat(F.lit("N"), F.col("conv_id"))).alias("bill_id"), F.concat(F.lit("R"), F.col("turn")).alias("roll_id"), F.lit("Not Voting").alias("vote_type"), (F.col("conv_id") * 1000 + F.col("turn")).alias("place"))
    return merges.merge_entries(store, new, "member").select("member", "roll_id", "bill_id", "vote_type")


@query("SELECT DISTINCT turn AS roll FROM conversations WHERE turn NOT IN (SELECT turn FROM conversations WHERE role = 'system')")
def ups_roll(spark, sf_dir):
    """Rolls that are written once: distinct, and none that is there."""
    r = turns(spark, sf_dir).select(F.col("turn").alias("roll")).dropDuplicates(["roll"])
    return r.join(turns(spark, sf_dir).filter("role = 'system'").select(F.col("turn").alias("roll")), "roll", "left_anti")


@query("SELECT conv_id, CAST(max(turn) AS BIGINT) AS current_roll, string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn DESC) AS rolls FROM (SELECT DISTINCT conv_id, turn FROM conversations) GROUP BY conv_id")
def ups_recorded(spark, sf_dir):
    """A roll is added if it is not there; the newest is the current one."""
    t = turns(spark, sf_dir)
    part = lambda c: t.filter(c).groupBy("conv_id").agg(F.collect_set("turn").alias("rolls"))
    out = merges.upsert(part("turn % 2 = 0"), part("turn % 2 = 1 or turn = 0"), ["conv_id"], lists=("rolls",)).withColumn("rolls", F.sort_array("rolls", asc=False))
    return out.select("conv_id", F.element_at("rolls", 1).alias("current_roll"), F.array_join(F.col("rolls").cast("array<string>"), ",").alias("rolls"))


@query("SELECT role AS cosponsor, conv_id AS bill, turn AS introduced FROM conversations WHERE role = 'assistant' AND turn >= 2")
def qry_cosponsor(spark, sf_dir):
    """A cosponsor's bills by date, over the exploded member lists."""
    b = turns(spark, sf_dir).groupBy("conv_id").agg(F.collect_list(F.struct("role", "turn")).alias("m"))
    e = b.select("conv_id", F.explode("m").alias("m")).select(F.col("m.role").alias("cosponsor"), F.col("conv_id").alias("bill"), F.col("m.turn").alias("introduced"))
    return search.lookup(e, "cosponsor", "assistant", "introduced", (2, None), tie="bill")


@query("SELECT conv_id, turn, role FROM conversations WHERE role = 'user' AND conv_id < 20")
def qry_vote(spark, sf_dir):
    """A member's votes under a key prefix."""
    v = turns(spark, sf_dir).withColumn("pk", F.concat(F.lit("VOTE#"), F.lpad(F.col("conv_id").cast("string"), 6, "0")))
    return v.filter(search.predicate(role="user", pk=("VOTE#000000", "VOTE#000019"))).select("conv_id", "turn", "role")


@query("SELECT conv_id, CASE WHEN count(*) > 3 THEN 1 ELSE 0 END AS has_roll_call, count(*) AS n FROM conversations GROUP BY conv_id HAVING count(*) > 3")
def qry_bill(spark, sf_dir):
    """Bills with a flag, over a sparse 0/1 index key."""
    b = turns(spark, sf_dir).groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("has_roll_call", (F.col("n") > 3).cast("int"))
    return search.lookup(b, "has_roll_call", 1, "n", tie="conv_id").select("conv_id", "has_roll_call", "n")


@query("SELECT conv_id, substr(string_agg(text, ' | ' ORDER BY turn), 1, 100) AS joined FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) WHERE n <= 3 GROUP BY conv_id")
def agg_concat_topn(spark, sf_dir):
    """The first three texts joined and cut."""
    first = turns(spark, sf_dir).withColumn("n", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))).filter("n <= 3")
    g = first.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("x"))
    return g.select("conv_id", F.substring(F.array_join(F.transform("x", lambda x: x["text"]), " | "), 1, 100).alias("joined"))


NAMES = "(VALUES (1, 'Hon. Smith, Jane Ann'), (2, 'Rep. John Doe [D-NY-12]'), (3, 'Sen. Roe, Rick (Senator)'), (4, 'Madonna')) n(id, name)"


@query(f"SELECT n_nationkey, CASE WHEN id = 1 THEN 'Smith, Jane Ann' WHEN id = 2 THEN 'John Doe' WHEN id = 3 THEN 'Roe, Rick' ELSE name END AS cleaned, CASE WHEN id = 1 THEN 'Jane Ann Smith' WHEN id = 2 THEN 'John Doe' WHEN id = 3 THEN 'Rick Roe' ELSE name END AS flipped, CASE id WHEN 1 THEN 'Jane' WHEN 2 THEN 'John' WHEN 3 THEN 'Rick' ELSE 'Madonna' END AS first, CASE id WHEN 1 THEN 'Smith' WHEN 2 THEN 'Doe' WHEN 3 THEN 'Roe' END AS last, CASE WHEN id = 2 THEN 'D' END AS party, CASE WHEN id = 2 THEN 'NY' END AS state, CASE WHEN id = 2 THEN 12 END AS district FROM nation JOIN {NAMES} ON id = n_nationkey % 4 + 1")
def str_names(spark, sf_dir):
    """Names without honorific, bracket and office; flipped; split."""
    raw = F.expr("element_at(array('Hon. Smith, Jane Ann', 'Rep. John Doe [D-NY-12]', 'Sen. Roe, Rick (Senator)', 'Madonna'), cast(n_nationkey % 4 + 1 as int))")
    n = table(spark, sf_dir, "nation").select("n_nationkey", raw.alias("name")).withColumn("cleaned", strings.clean_name("name"))
    n = n.withColumn("flipped", strings.flip_name("cleaned")).withColumn("s", strings.split_name("cleaned")).withColumn("b", strings.party_bracket("name"))
    return n.select("n_nationkey", "cleaned", "flipped", "s.first", "s.last", "b.party", "b.state", "b.district")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN upper(left(n_name, 2)) ELSE upper(left(n_name, 2)) || CASE WHEN s_suppkey % 7 = 0 THEN 'AL' ELSE lpad(CAST(s_suppkey % 60 AS VARCHAR), 2, '0') END END AS district FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def str_district(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").join(joins.small(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey")
    return s.select("s_suppkey", strings.district(F.left("n_name", F.lit(2)), F.when(k % 7 == 0, "AL").otherwise((k % 60).cast("string")), k % 5 == 0).alias("district"))


@query("SELECT event_id, CAST((CAST(floor(epoch(ts)) AS BIGINT) // 480) % 8 AS INTEGER) AS slot, strftime(ts, '%Y-%m-%d') AS voted FROM events")
def dt_rotate_votedate(spark, sf_dir):
    d = dates.first_date(F.lit(None).cast("string"), F.lit("2024"), F.col("ts").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", dates.rotation("ts").alias("slot"), F.date_format(d, "yyyy-MM-dd").alias("voted"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN 20250101 ELSE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) END AS ymd FROM orders")
def dt_ymdint(spark, sf_dir):
    """Dates in several forms as numbers, two-digit years split at 50, else the fallback."""
    d = lambda f: F.date_format("o_orderdate", f)
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, d("yyyy-MM-dd")).when(k == 1, d("M/d/yyyy")).when(k == 2, d("M/d/yy")).when(k == 3, d("yyyyMMdd")).otherwise("soon")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.ymd_int(raw, F.lit("2025-01-01")).alias("ymd"))


BILLS = "SELECT conv_id, upper(left(min(role), 1)) AS sponsor_party, 'Rep ' || conv_id % 9 AS sponsor_full_name, 100 + conv_id % 4 AS congress, CASE conv_id % 3 WHEN 0 THEN 'HR' WHEN 1 THEN 'S' ELSE 'HRES' END AS bill_type, 'Act ' || conv_id % 6 AS bill_title, conv_id % 25 AS bill_number, CASE WHEN count(DISTINCT role) > 2 THEN 1 END AS bipartisan, 'd' || conv_id % 5 AS latest_action_date, CASE WHEN conv_id % 2 = 0 THEN 'Area ' || conv_id % 3 END AS policy_area, CASE WHEN count(*) > 3 THEN 1 END AS has_roll_call, 'day ' || conv_id % 30 AS introduced_date FROM {conversations} GROUP BY conv_id"
BILL_ASKED = {"sponsor_party": "A", "sponsor_name": "Rep 2", "congress_type": 102, "type": "HR", "title": "Act 4", "number": 7, "bipartisan": 1, "latest_action": "d3", "policy_area": "Area 1", "has_roll_call": 1, "introduced": "day 8"}
BILL_ENDS = {"congress_type": ("HR", "HRES")}


def _bill_sql(k: str, v) -> str:
    hash_key, range_key = forms.BILL_INDEXES[k]
    lo, hi = BILL_ENDS.get(k, ("day 1", "day 3"))
    return f"SELECT '{k}' AS index, conv_id FROM ({BILLS.format(conversations='conversations')}) WHERE {hash_key} = {v!r}" + (f" AND {range_key} BETWEEN '{lo}' AND '{hi}'" if range_key else "")


@query(" UNION ALL ".join(_bill_sql(k, v) for k, v in BILL_ASKED.items()))
def qry_bill_keys(spark, sf_dir):
    """Every index of bills by its key, two of them without a sort key; flags that are not set are not in theirs."""
    b = spark.sql(BILLS, conversations=table(spark, sf_dir, "conversations"))
    parts = [forms.by_index(b, forms.BILL_INDEXES, k, v, BILL_ENDS.get(k, ("day 1", "day 3")), tie="conv_id").select(F.lit(k).alias("index"), "conv_id") for k, v in BILL_ASKED.items()]
    return reduce(DataFrame.unionByName, parts)
