"""Filings, contributions and the search over their parameters.

On the fixture tables a document is a filing and its words are names and codes;
an order's lines are its contribution items.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import strings
from ..operators import forms, joins, ordered, search
from ..session import table
from .registry import query

WORDS = "string_split(replace(text, chr(10), ' '), ' ')"


def filings(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", "source", F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ").alias("words"), "n_chars")


@query(f"WITH w AS (SELECT doc_id, unnest({WORDS}) AS w, generate_subscripts({WORDS}, 1) AS i FROM documents), f AS (SELECT doc_id, w, min(i) AS i FROM w GROUP BY doc_id, w) SELECT doc_id, count(*) AS n, md5(string_agg(w, ',' ORDER BY i)) AS names FROM f GROUP BY doc_id")
def agg_distinct_list(spark, sf_dir):
    """Distinct names in the order they come."""
    names = F.array_distinct("words")
    return filings(spark, sf_dir).select("doc_id", F.size(names).cast("bigint").alias("n"), F.md5(F.array_join(names, ",")).alias("names"))


@query("SELECT source, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs FROM documents GROUP BY source")
def agg_distinct_set(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"))


@query("SELECT l_orderkey, CASE WHEN sum(amount) > 0 THEN CAST(sum(amount) AS DECIMAL(20,2)) END AS contributions FROM (SELECT l_orderkey, CASE WHEN l_partkey % 3 > 0 THEN CAST(l_extendedprice AS DECIMAL(20,2)) END AS amount FROM lineitem) GROUP BY l_orderkey")
def agg_contrib_sum(spark, sf_dir):
    """Decimal sums over nested items, items that are no number left out, null up to zero."""
    raw = F.when(F.col("l_partkey") % 3 > 0, F.col("l_extendedprice").cast("string")).otherwise("n/a")
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(raw.alias("amount"))).alias("items"))
    typed = F.filter(F.transform("items", lambda i: i["amount"].try_cast("decimal(20,2)")), lambda v: v.isNotNull())
    total = F.aggregate(typed, F.lit(0).cast("decimal(20,2)"), lambda a, v: (a + v).cast("decimal(20,2)"))
    return g.select("l_orderkey", F.when(total > 0, total).alias("contributions"))


EDGES = f"""(SELECT DISTINCT doc_id, parameter_type, trim(v) AS parameter_value, n_chars FROM (
  SELECT doc_id, n_chars, 'lang' AS parameter_type, lang AS v FROM documents UNION ALL SELECT doc_id, n_chars, 'source', source FROM documents
  UNION ALL SELECT doc_id, n_chars, 'name', unnest({WORDS}) FROM documents) WHERE v IS NOT NULL AND trim(v) <> '') e"""


def edges(spark, sf_dir, *kinds: str) -> DataFrame:
    """Edges of the parameters asked for, or of all; only their columns are read."""
    every = {"lang": F.col("lang"), "source": F.col("source"), "name": F.col("words")}
    return search.edges(filings(spark, sf_dir), "doc_id", ["n_chars"], **{k: c for k, c in every.items() if not kinds or k in kinds})


@query(f"SELECT parameter_type, parameter_value, count(*) AS filings, max(n_chars) AS longest FROM {EDGES} GROUP BY 1, 2")
def qry_lda_param(spark, sf_dir):
    """Values of all parameters with their filings."""
    return edges(spark, sf_dir).groupBy("parameter_type", "parameter_value").agg(F.count(F.lit(1)).alias("filings"), F.max("n_chars").alias("longest"))


@query("SELECT doc_id FROM documents WHERE lang = 'en' AND source IN ('src1', 'src2', 'src3') AND n_chars > 500")
def join_intersect(spark, sf_dir):
    """Filings that all parameters name: a chain of semi-joins over the edges."""
    lang, source = edges(spark, sf_dir, "lang"), edges(spark, sf_dir, "source")
    return joins.intersect_all([lang.filter("parameter_value = 'en'"), source.filter("parameter_value in ('src1', 'src2', 'src3')"), lang.filter("n_chars > 500")], "doc_id")


@query("SELECT doc_id, source, n_chars FROM documents WHERE source = 'src5' AND n_chars BETWEEN 300 AND 3000")
def qry_lda(spark, sf_dir):
    return search.lookup(table(spark, sf_dir, "documents"), "source", "src5", "n_chars", (300, 3000), tie="doc_id").select("doc_id", "source", "n_chars")


@query("SELECT doc_id FROM documents WHERE lang IN ('fr', 'de') AND n_chars >= 200 AND text LIKE '%ou%' AND source LIKE 'src1%'")
def qry_lda_form(spark, sf_dir):
    """A form's parameters as one predicate."""
    return table(spark, sf_dir, "documents").filter(search.predicate(lang=["fr", "de"], n_chars=(200, None), text__contains="ou", source__prefix="src1")).select("doc_id")


@query(f"SELECT parameter_value AS value FROM (SELECT DISTINCT parameter_value FROM {EDGES} WHERE parameter_type = 'name' AND lower(parameter_value) LIKE 'th%') ORDER BY lower(value), value LIMIT 20")
def qry_autocomplete(spark, sf_dir):
    """The first twenty names with a prefix: a top-k report."""
    return search.autocomplete(edges(spark, sf_dir, "name"), "parameter_value", "th", 20)


@query("SELECT DISTINCT source AS value, lower(source) AS key FROM documents ORDER BY 2, 1")
def sort_ci(spark, sf_dir):
    """Distinct values in order without regard to case, ties by code point; a range-partitioned sort."""
    v = table(spark, sf_dir, "documents").select(F.col("source").alias("value")).distinct()
    return v.select("value", F.lower("value").alias("key")).orderBy("key", "value")


@query("WITH a AS (SELECT DISTINCT lang || source AS v FROM documents WHERE doc_id % 2 = 0), b AS (SELECT DISTINCT lang || source AS v FROM documents WHERE doc_id % 2 = 1) SELECT v, v NOT IN (SELECT v FROM a) AS is_new FROM (SELECT v FROM a UNION SELECT v FROM b)")
def set_union(spark, sf_dir):
    """Known and new values, and which are new."""
    d = table(spark, sf_dir, "documents").select(F.concat("lang", "source").alias("v"), (F.col("doc_id") % 2).alias("r"))
    old, new = d.filter("r = 0").select("v").distinct(), d.filter("r = 1").select("v").distinct()
    return old.withColumn("is_new", F.lit(False)).unionByName(new.join(old, "v", "left_anti").withColumn("is_new", F.lit(True)))


@query("SELECT o_orderkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey < 20")
def join_code(spark, sf_dir):
    """Code to name; rows with an unknown code are not in the index."""
    codes = joins.small(table(spark, sf_dir, "nation").filter("n_nationkey < 20"))
    c = table(spark, sf_dir, "customer").join(codes, F.col("c_nationkey") == F.col("n_nationkey"))
    return table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "n_name")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'other' END AS status FROM orders")
def prj_codemap(spark, sf_dir):
    """Code to label with a default."""
    labels = F.create_map(*[F.lit(x) for x in ("F", "filled", "O", "open")])
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(F.try_element_at(labels, F.col("o_orderstatus")), F.lit("other")).alias("status"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name WHEN c_custkey % 4 = 1 THEN c_mktsegment ELSE n_name END AS state, CASE WHEN c_custkey % 2 = 0 THEN 'client' WHEN c_custkey % 3 = 0 THEN 'lobbyist' END AS entity_type FROM customer JOIN nation ON c_nationkey = n_nationkey")
def prj_address_entity_state(spark, sf_dir):
    """Three levels of precedence for a field, and the tagged union of client and lobbyist."""
    c = table(spark, sf_dir, "customer").join(joins.small(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    c = c.select("c_custkey", F.struct(F.when(k % 4 == 0, F.col("c_name")).alias("state")).alias("address"), F.struct(F.struct(F.when(k % 4 == 1, F.col("c_mktsegment")).alias("state")).alias("address"), F.col("n_name").alias("state")).alias("registrant"), F.when(k % 2 == 0, F.struct(k.alias("id"))).alias("client"), F.when(k % 3 == 0, F.struct(k.alias("id"))).alias("lobbyist"))
    return c.select("c_custkey", strings.first_filled("address.state", "registrant.address.state", "registrant.state").alias("state"), F.when(F.col("client").isNotNull(), "client").when(F.col("lobbyist").isNotNull(), "lobbyist").alias("entity_type"))


@query("SELECT c_custkey, 'cust, ' || c_custkey || ' x' AS squeezed FROM customer")
def str_squeeze(spark, sf_dir):
    raw = F.concat(F.lit('"cust,   '), F.col("c_custkey").cast("string"), F.lit('\t x  "'))
    return table(spark, sf_dir, "customer").select("c_custkey", strings.squeeze(raw).alias("squeezed"))


@query("SELECT lang, doc_id, n FROM (SELECT lang, doc_id, n_chars AS n, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r <= 5")
def limit_test(spark, sf_dir):
    """At most five of each kind."""
    return ordered.pick(table(spark, sf_dir, "documents").select("lang", "doc_id", F.col("n_chars").alias("n")), ["lang"], [F.col("n").desc(), F.col("doc_id")], 5)


# ---------------------------------------------------------------- search forms

_HAS = "o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE {})"
#: Each parameter of the report form with a value, and what it means on the tables; {..} marks conditions on lines.
REPORT_ASKED = {
    "registrant_name": ("REG 1", "contains('reg ' || o_custkey, 'reg 1')"),
    "registrant_id": (7, "o_custkey = 7"),
    "registrant_country": ("C1", "o_custkey % 3 = 1"),
    "registrant_ppb_country": (["P0", "P3"], "o_custkey % 4 IN (0, 3)"),
    "client_name": ("client 2", "contains('client ' || o_custkey % 40, 'client 2')"),
    "client_id": (12, "o_custkey % 40 = 12"),
    "client_state": ("S3", "o_custkey % 5 = 3"),
    "client_country": ("K1", "o_custkey % 2 = 1"),
    "client_ppb_country": ("Q2", "o_custkey % 6 = 2"),
    "client_ppb_state": ("T4", "o_custkey % 7 = 4"),
    "lobbyist_name": ("LOB 3", "{contains('lob ' || l_suppkey, 'lob 3')}"),
    "lobbyist_id": ([1, 5], "{l_suppkey IN (1, 5)}"),
    "lobbyist_covered_position": ("aide 4", "{l_linenumber % 3 = 0 AND l_partkey % 10 = 4}"),
    "lobbyist_covered_position_indicator": (True, "{l_linenumber % 3 = 0}"),
    "lobbyist_conviction_disclosure": ("conv 6", "{l_returnflag = 'R' AND l_partkey % 10 = 6}"),
    "lobbyist_conviction_disclosure_indicator": (False, "NOT ({l_returnflag = 'R'})"),
    "lobbyist_conviction_date_range_after": ("1995-03-01", "{l_returnflag = 'R' AND l_shipdate >= DATE '1995-03-01'}"),
    "lobbyist_conviction_date_range_before": ("1994-03-01", "{l_returnflag = 'R' AND l_shipdate < DATE '1994-03-02'}"),
    "filing_type": (["F", "P"], "o_orderstatus IN ('F', 'P')"),
    "filing_period": ("period 2", "month(o_orderdate) % 4 = 2"),
    "filing_year": (1996, "year(o_orderdate) = 1996"),
    "filing_dt_posted_after": ("1997-05-05", "o_orderdate >= DATE '1997-05-05'"),
    "filing_dt_posted_before": ("1993-05-05", "o_orderdate < DATE '1993-05-06'"),
    "filing_amount_reported_min": (150000.0, "o_totalprice >= 150000"),
    "filing_amount_reported_max": (20000.0, "o_totalprice <= 20000"),
    "senate_doc_id": ("S11", "o_orderkey = 11"),
    "house_doc_id": ("H12", "o_orderkey = 12"),
    "filing_specific_lobbying_issues": ("Issue 1", "{contains('issue ' || l_partkey % 20, 'issue 1')}"),
    "general_issue_code": ("I3", "{l_partkey % 7 = 3}"),
    "government_entities": ([4, 9], "{l_suppkey % 30 IN (4, 9)}"),
    "affiliated_organization_name": ("aff 1", "{l_linestatus = 'O' AND contains('aff ' || l_suppkey % 12, 'aff 1')}"),
    "affiliated_organization_listed_indicator": (True, "{l_linestatus = 'O'}"),
    "affiliated_organization_country": ("A2", "{l_linestatus = 'O' AND l_partkey % 4 = 2}"),
    "foreign_entity_name": ("for 3", "{l_quantity > 30 AND contains('for ' || l_suppkey, 'for 3')}"),
    "foreign_entity_listed_indicator": (False, "NOT ({l_quantity > 30})"),
    "foreign_entity_country": ("F1", "{l_quantity > 30 AND l_partkey % 3 = 1}"),
    "foreign_entity_ppb_country": ("G1", "{l_quantity > 30 AND l_partkey % 5 = 1}"),
    "foreign_entity_ownership_percentage_min": (45.0, "{l_quantity > 30 AND l_quantity >= 45}"),
    "foreign_entity_ownership_percentage_max": (33.0, "{l_quantity > 30 AND l_quantity <= 33}"),
}
CONTRIBUTION_ASKED = {
    **{k: REPORT_ASKED[k] for k in ("registrant_name", "registrant_id", "filing_type", "filing_period", "filing_year", "filing_dt_posted_after", "filing_dt_posted_before", "senate_doc_id", "house_doc_id")},
    "lobbyist_name": ("one 2", "o_orderkey % 3 > 0 AND contains('one ' || o_custkey % 30, 'one 2')"),
    "lobbyist_id": (4, "o_orderkey % 3 > 0 AND o_custkey % 30 = 4"),
    "exclude_registrant_lobbyists": (True, "o_orderkey % 3 = 0"),
    "contribution_date_after": ("1997-01-01", "{l_shipdate >= DATE '1997-01-01'}"),
    "contribution_date_before": ("1993-01-01", "{l_shipdate < DATE '1993-01-02'}"),
    "contribution_amount_min": (60000.0, "{l_extendedprice >= 60000}"),
    "contribution_amount_max": (1500.0, "{l_extendedprice <= 1500}"),
    "contribution_type": (["A", "N"], "{l_returnflag IN ('A', 'N')}"),
    "contributor_name": ("Giver 2", "{contains('giver ' || l_suppkey, 'giver 2')}"),
    "payee_name": ("payee 5", "{contains('payee ' || l_partkey % 9, 'payee 5')}"),
    "honoree_name": ("hon 7", "{contains('hon ' || l_partkey % 11, 'hon 7')}"),
}
#: Several parameters at once; the two ends of the percentage must meet in one foreign entity.
TOGETHER = {"filing_year": 1995, "registrant_country": "C1", "foreign_entity_ownership_percentage_min": 35.0, "foreign_entity_ownership_percentage_max": 40.0, "general_issue_code": ["I1", "I2"]}
TOGETHER_SQL = "year(o_orderdate) = 1995 AND o_custkey % 3 = 1 AND {l_quantity BETWEEN 35 AND 40} AND {l_partkey % 7 IN (1, 2)}"


def _form_sql(form: str, name: str, condition: str) -> str:
    while "{" in condition:
        head, _, rest = condition.partition("{")
        inner, _, tail = rest.partition("}")
        condition = f"{head}{_HAS.format(inner)}{tail}"
    return f"SELECT '{form}' AS form, '{name}' AS parameter, count(*) AS n FROM orders WHERE {condition}"


def _filings(spark, sf_dir) -> DataFrame:
    """Orders as filings: lines are their lobbyists, convictions, activities, entities and contributions."""
    text = lambda head, c: F.concat(F.lit(head), F.expr(c).cast("string"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    li = table(spark, sf_dir, "lineitem")
    rows = lambda when, **fields: F.collect_list(F.when(F.expr(when), F.struct(*[v.alias(k) for k, v in fields.items()])))
    lines = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        rows("true", name=text("Lob ", "l_suppkey"), id=F.col("l_suppkey"), covered_position=F.when(F.expr("l_linenumber % 3 = 0"), text("Aide ", "l_partkey % 10"))).alias("lobbyists"),
        rows("l_returnflag = 'R'", description=text("Conv ", "l_partkey % 10"), date=day("l_shipdate")).alias("convictions"),
        rows("true", description=text("Issue ", "l_partkey % 20"), issue_code=text("I", "l_partkey % 7")).alias("activities"),
        F.collect_set(F.expr("l_suppkey % 30")).alias("entities"),
        rows("l_linestatus = 'O'", name=text("Aff ", "l_suppkey % 12"), country=text("A", "l_partkey % 4")).alias("affiliates"),
        rows("l_quantity > 30", name=text("For ", "l_suppkey"), country=text("F", "l_partkey % 3"), ppb_country=text("G", "l_partkey % 5"), percentage=F.col("l_quantity")).alias("foreign"),
        rows("true", date=day("l_shipdate"), amount=F.col("l_extendedprice"), type=F.col("l_returnflag"), contributor=text("Giver ", "l_suppkey"), payee=text("Payee ", "l_partkey % 9"), honoree=text("Hon ", "l_partkey % 11")).alias("items"),
    )
    struct = lambda **fields: F.struct(*[v.alias(k) for k, v in fields.items()])
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        struct(name=text("Reg ", "o_custkey"), id=F.col("o_custkey"), country=text("C", "o_custkey % 3"), ppb_country=text("P", "o_custkey % 4")).alias("registrant"),
        struct(name=text("Client ", "o_custkey % 40"), id=F.expr("o_custkey % 40"), state=text("S", "o_custkey % 5"), country=text("K", "o_custkey % 2"), ppb_country=text("Q", "o_custkey % 6"), ppb_state=text("T", "o_custkey % 7")).alias("client"),
        F.when(F.expr("o_orderkey % 3 > 0"), struct(name=text("One ", "o_custkey % 30"), id=F.expr("o_custkey % 30"))).alias("lobbyist"),
        F.col("o_orderstatus").alias("type"), text("period ", "month(o_orderdate) % 4").alias("period"), F.year("o_orderdate").alias("year"), day("o_orderdate").alias("posted"), F.col("o_totalprice").alias("amount"), text("S", "o_orderkey").alias("senate_doc_id"), text("H", "o_orderkey").alias("house_doc_id"),
    )
    return o.join(lines, "o_orderkey", "left")


@query(" UNION ALL ".join([*(_form_sql("report", k, c) for k, (_, c) in REPORT_ASKED.items()), *(_form_sql("contribution", k, c) for k, (_, c) in CONTRIBUTION_ASKED.items()), _form_sql("report", "together", TOGETHER_SQL)]))
def qry_lda_form_keys(spark, sf_dir):
    """All parameters of both search forms, each alone, and some together: how many filings each finds, in one pass."""
    f = _filings(spark, sf_dir)
    asked = [("report", k, forms.REPORT_FORM, {k: v}) for k, (v, _) in REPORT_ASKED.items()] + [("contribution", k, forms.CONTRIBUTION_FORM, {k: v}) for k, (v, _) in CONTRIBUTION_ASKED.items()] + [("report", "together", forms.REPORT_FORM, TOGETHER)]
    hits = [F.count(F.when(reduce(Column.__and__, forms.conditions(form, given)), 1)).alias(f"n{j}") for j, (_, _, form, given) in enumerate(asked)]
    found = f.agg(*hits)
    rows = F.array(*[F.struct(F.lit(form).alias("form"), F.lit(name).alias("parameter"), F.col(f"n{j}").alias("n")) for j, (form, name, _, _) in enumerate(asked)])
    return found.select(F.inline(rows))
