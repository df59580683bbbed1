"""Sources and sinks: tables written out in a landed format and read back."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ..operators import sinks
from ..session import scratch, table
from ..sources import bill_status, page_chains, readers, trade_reports
from ..streaming import flows
from .registry import query


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(20,2)) AS amount, CASE WHEN o_orderkey % 9 > 0 THEN o_orderstatus END AS status FROM orders")
def src_csv_prime(spark, sf_dir):
    """A CSV with a header, blanks as null, numbers typed where they can be."""
    path = scratch(spark, "csv")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 9 > 0, F.col("o_orderstatus")).otherwise("  ").alias("status"))
    o.write.option("header", True).csv(path)
    df = readers.read_csv(spark, path, ["o_orderkey", "o_totalprice", "status"])
    return df.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_totalprice").try_cast("decimal(20,2)").alias("amount"), "status")


@query("SELECT CASE WHEN l_linenumber = 1 THEN 'prime' ELSE 'sub' END AS kind, count(*) AS n FROM lineitem GROUP BY 1")
def src_csv_sub(spark, sf_dir):
    """Files of one folder dealt to awards and sub-awards by their names."""
    base = scratch(spark, "routed")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", (F.col("l_linenumber") != 1).alias("sub"))
    cols = ["l_orderkey", "l_partkey"]
    li.filter("not sub").select(*cols).write.option("header", True).csv(f"{base}/PrimeAwards")
    li.filter("sub").select(*cols).write.option("header", True).csv(f"{base}/Contracts_SubAwards")
    sinks.gather(spark, [f"{base}/PrimeAwards", f"{base}/Contracts_SubAwards"], f"{base}/landed")
    prime, sub = readers.read_awards(spark, f"{base}/landed", cols)
    n = lambda df, k: df.groupBy(F.lit(k).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return n(prime, "prime").unionByName(n(sub, "sub"))


@query("""
SELECT 'B' || c_custkey AS bioguide_id, CASE WHEN c_custkey % 4 = 0 THEN 'Ann M. ' || c_name ELSE c_name || ', full' END AS name, upper(left(c_mktsegment, 1)) AS party, 'NY' AS state,
  CASE c_custkey % 3 WHEN 0 THEN 'Senator' WHEN 1 THEN 'Representative' END AS position, CASE WHEN c_custkey % 3 = 1 THEN CAST(c_custkey % 50 AS VARCHAR) END AS district,
  CASE WHEN c_custkey % 2 = 0 THEN 'Nan ' || c_name || ';' ELSE '' END || 'Ann ' || c_name AS others
FROM customer
""")
def src_csv_ref(spark, sf_dir):
    """A list of legislators from CSV files: names quoted where they hold commas, blanks, other names from nicknames."""
    path = scratch(spark, "legislators")
    k, cols = F.col("c_custkey"), ["last_name", "first_name", "middle_name", "suffix", "nickname", "full_name", "type", "state", "district", "party", "bioguide_id"]
    full = F.when(k % 4 == 0, " ").otherwise(F.concat("c_name", F.lit(", full")))
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("last_name"), F.lit("Ann").alias("first_name"), F.lit("M.").alias("middle_name"), F.lit("").alias("suffix"), F.when(k % 2 == 0, "Nan").otherwise("").alias("nickname"), full.alias("full_name"), F.when(k % 3 == 0, "sen").when(k % 3 == 1, "rep").otherwise("del").alias("type"), F.lit("ny").alias("state"), F.when(k % 3 == 1, (k % 50).cast("string")).otherwise("").alias("district"), F.lower("c_mktsegment").alias("party"), F.concat(F.lit(" b"), k).alias("bioguide_id"))
    c.select(*cols).write.option("header", True).option("escape", '"').csv(path)
    out = readers.legislators(readers.read_csv(spark, path, cols))
    return out.select("bioguide_id", "name", "party", "state", "position", "district", F.array_join("alt_names", ";").alias("others"))


@query("SELECT upper(symbol) AS symbol, tier FROM (SELECT 's' || s_suppkey AS symbol, 'high' AS tier FROM supplier UNION ALL SELECT 'n.' || n_nationkey, 'low' FROM nation WHERE n_nationkey % 2 = 0)")
def src_csv_sym(spark, sf_dir):
    """Symbols of several lists, each a folder of CSV files, with their tier; odd characters do not count."""
    base = scratch(spark, "symbols")
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("Symbol"), F.col("s_name").alias("Security Name"))
    n = table(spark, sf_dir, "nation").select(F.concat(F.when(F.col("n_nationkey") % 2 == 0, "n.").otherwise("n^"), F.col("n_nationkey").cast("string")).alias("Symbol"), F.concat(F.col("n_name"), F.lit(", Inc")).alias("Security Name"))
    for tier, df in (("high", s), ("low", n)):
        df.write.option("header", True).csv(f"{base}/{tier}")
    return readers.symbols({tier: readers.read_csv(spark, f"{base}/{tier}", ["Symbol", "Security Name"]) for tier in ("high", "low")}, "Symbol")


@query("SELECT CAST(o_custkey AS VARCHAR) AS cik, CAST(o_orderdate AS DATE) AS filed, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-24-000001' AS accession FROM orders WHERE o_orderstatus = 'P'")
def src_pipe(spark, sf_dir):
    """Daily index lines of the forms named."""
    path = scratch(spark, "pipe")
    o = table(spark, sf_dir, "orders")
    line = F.concat_ws("|", F.col("o_custkey").cast("string"), F.lit("Name"), "o_orderstatus", F.date_format("o_orderdate", "yyyyMMdd"), F.concat(F.lit("forms/"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit("-24-000001.txt")))
    head = spark.createDataFrame([("Description: index",), ("CIK|Company Name|Form Type|Date Filed|File Name",), ("-----",)], "value string")
    head.unionByName(o.select(line.alias("value"))).write.text(path)
    return readers.read_pipe_index(spark, path, ["P"]).select("cik", "filed", "accession")


@query("SELECT CAST(user_id AS VARCHAR) AS symbol, CASE WHEN user_id % 2 = 0 THEN 'high' ELSE 'low' END AS tier, count(*) AS points, round(sum(value), 2) AS total FROM events GROUP BY user_id")
def src_json(spark, sf_dir):
    """Per-symbol documents under a folder for each tier."""
    base = scratch(spark, "json")
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("value").alias("close"))).alias("history"))
    e = e.select(F.col("user_id").cast("string").alias("symbol"), "history", (F.col("user_id") % 2 == 0).alias("high"))
    for tier, cond in (("high", "high"), ("low", "not high")):
        e.filter(cond).select("symbol", "history").write.json(f"{base}/{tier}")
    h = readers.read_history(spark, [f"{base}/high", f"{base}/low"])
    return h.groupBy("symbol", "tier").agg(F.count(F.lit(1)).alias("points"), F.round(F.sum("close"), 2).alias("total"))


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier")
def src_json_api(spark, sf_dir):
    """Items of landed API pages, some of whose values are tagged."""
    path = scratch(spark, "pages")
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 10).alias("page"), F.struct(F.col("s_suppkey").alias("id"), F.to_json(F.struct(F.col("s_name").alias("S"))).alias("name")).alias("item"))
    s.groupBy("page").agg(F.collect_list("item").alias("results")).select(F.to_json(F.struct("results")).alias("value")).write.text(path)
    return readers.read_pages(spark, path, "id:bigint,name:string").select("id", readers.untag(F.col("name")).alias("name"))


@query("SELECT '118-HR-' || conv_id AS bill_id, CAST(118 AS INTEGER) AS congress, CAST(conv_id AS INTEGER) AS bill_number, 'Title & ' || conv_id AS title, CAST(count(*) AS INTEGER) AS cosponsors FROM conversations GROUP BY conv_id")
def src_xml(spark, sf_dir):
    """Bill status documents, with namespaces and either name of a tag."""
    t = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    people = F.array_join(F.transform(F.sequence(F.lit(1), "n"), lambda k: F.concat(F.lit("<item><bioguideId>B"), k.cast("string"), F.lit("</bioguideId></item>"))), "")
    tag = F.when(F.col("conv_id") % 2 == 0, "number").otherwise("billNumber")
    xml = F.concat(F.lit('<billStatus xmlns:dc="http://x/"><bill><congress>118</congress><type>hr</type><'), tag, F.lit(">"), F.col("conv_id").cast("string"), F.lit("</"), tag, F.lit("><dc:title>Title &amp; "), F.col("conv_id").cast("string"), F.lit("</dc:title><introducedDate>2024-01-02</introducedDate><cosponsors>"), people, F.lit("</cosponsors></bill></billStatus>"))
    b = bill_status.parse_bills(t.select(xml.alias("xml")), dated=("2024-01-01", "2024-12-31"))
    return b.select("bill_id", "congress", "bill_number", "title", F.size("cosponsors").alias("cosponsors"))


@query("SELECT s_suppkey AS id, 0 AS n, 'Acme' || s_suppkey AS asset, 'ABC' AS symbol, 'P' AS kind, '$1,001 - $15,000' AS amount, 'SP' AS owner FROM supplier")
def src_text_trades(spark, sf_dir):
    """Trades in a report's text."""
    body = F.concat(F.lit("ID Owner Asset Transaction\nSP Acme"), F.col("s_suppkey").cast("string"), F.lit(" (ABC)\n[ST] P 01/02/2024 01/05/2024 $1,001 - $15,000\nF S: New\nS O: Trust\n"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.replace(body, F.lit(" (ABC)\n[ST]"), F.lit(" (ABC) [ST]")).alias("text"))
    return trade_reports.trade_reports(s, "s_suppkey", "text").select("id", "n", "asset", "symbol", "kind", "amount", "owner")


@query("SELECT code, name, n FROM (SELECT CAST(r_regionkey AS VARCHAR) AS code, r_name AS name FROM region) JOIN (SELECT CAST(n_regionkey AS VARCHAR) AS k, count(*) AS n FROM nation GROUP BY 1) ON code = k")
def src_const(spark, sf_dir):
    """A constant list joined with what uses it."""
    codes = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("name"))
    n = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").cast("string").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return n.join(codes, "code")


@query("SELECT p_partkey, p_size FROM part")
def src_zip(spark, sf_dir):
    """Members of archives, opened where they are read."""
    base = scratch(spark, "zip")

    def archive(parts):
        for part in parts:
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("a/part.csv", "".join(f"{a},{b}\n" for a, b in zip(part["p_partkey"], part["p_size"], strict=True)))
                z.writestr("readme.txt", "no data")
            yield pd.DataFrame({"archive": ["parts"], "raw": [buf.getvalue()]})

    table(spark, sf_dir, "part").select("p_partkey", "p_size").mapInPandas(archive, "archive string, raw binary").write.parquet(base)
    members = readers.zip_members(spark.read.parquet(base), "archive", "raw", ".csv")
    line = members.select(F.explode(F.split("content", "\n")).alias("l")).filter("l <> ''")
    return line.select(F.split("l", ",")[0].cast("bigint").alias("p_partkey"), F.split("l", ",")[1].cast("int").alias("p_size"))


@query("SELECT c_custkey, c_name FROM customer")
def snk_kv(spark, sf_dir):
    """One row for each key, the last write."""
    path = scratch(spark, "kv")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    both = c.withColumn("v", F.lit(1)).unionByName(c.withColumn("c_name", F.lit("old")).withColumn("v", F.lit(0)))
    sinks.put(both, path, ["c_custkey"], [F.col("v").desc()])
    return spark.read.parquet(path).select("c_custkey", "c_name")


@query("SELECT count(*) AS row_count, sum(length('{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\"}'))::BIGINT AS byte_size FROM nation")
def snk_jsongz(spark, sf_dir):
    """Compressed JSON and its manifest, from the files."""
    path = scratch(spark, "jsongz")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sinks.write_json_gz(n, path, ["n_nationkey"])
    return sinks.manifest(spark.read.schema(n.schema).json(path)).select("row_count", "byte_size")


@query("SELECT count(*) AS row_count, true AS sized, true AS digested, true AS stamped FROM nation")
def snk_jsongz_files(spark, sf_dir):
    """The files of compressed JSON, each with its size, the digest of its bytes and when it was indexed."""
    path = scratch(spark, "jsongz")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sinks.write_json_gz(n.repartition(3), path, ["n_nationkey"])
    files = sinks.file_manifest(spark, path).agg(F.min("byte_size").alias("least"), F.every(F.col("sha256").rlike("^[0-9a-f]{64}$")).alias("digested"), F.every(F.col("indexed_at").isNotNull()).alias("stamped"))
    rows = spark.read.schema(n.schema).json(path).agg(F.count(F.lit(1)).alias("row_count"))
    return rows.join(F.broadcast(files)).select("row_count", (F.col("least") > 0).alias("sized"), "digested", "stamped")


@query("SELECT DISTINCT source AS value FROM documents")
def snk_txt(spark, sf_dir):
    """Sorted distinct values, one to a line."""
    path = scratch(spark, "txt")
    sinks.write_sorted_text(table(spark, sf_dir, "documents"), "source", path)
    return spark.read.text(path)


def _land_chains(spark, sf_dir, path: str) -> None:
    """Suppliers as paged answers, a chain for each seventh of them; written by the tasks."""

    def land(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        items = [{"id": int(i), "info": {"name": n, "tags": [str(i % 3), "t"] if i % 2 else None}} for i, n in sorted(zip(part["s_suppkey"], part["s_name"], strict=True))]
        page_chains.write_chain(path, f"chain-{int(key[0]):03d}", items, 4)
        return pd.DataFrame({"chain": [int(key[0])]})

    table(spark, sf_dir, "supplier").groupBy((F.col("s_suppkey") % 7).alias("chain")).applyInPandas(land, "chain long").write.format("noop").mode("overwrite").save()


PAGED_ITEM = "id long, info struct<name: string, tags: array<string>>"


@query("SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 1 THEN s_suppkey % 3 || ',t' END AS tags, 'batch' AS side FROM supplier UNION ALL SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 1 THEN s_suppkey % 3 || ',t' END, 'stream' FROM supplier")
def src_page_chains(spark, sf_dir):
    """Chains of landed pages by a data source, at once and as a stream."""
    path, where = scratch(spark, "chains"), scratch(spark, "chained")
    page_chains.register(spark)
    _land_chains(spark, sf_dir, path)
    whole = spark.read.format("page_chains").schema(PAGED_ITEM).load(path)
    drained = flows.to_table(spark.readStream.format("page_chains").schema(PAGED_ITEM).load(path), where)
    cols = lambda df, side: df.select("id", F.col("info.name").alias("name"), F.array_join("info.tags", ",").alias("tags"), F.lit(side).alias("side"))
    return cols(whole, "batch").unionByName(cols(drained, "stream"))
