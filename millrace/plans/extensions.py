"""Forms that Spark offers beyond the surveyed operators, labelled as extensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import table
from .registry import query

DEC = "decimal(18,2)"


@query("SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS DECIMAL(18,2))) AS sum_qty, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sum_price, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def ext_pricing_summary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").filter("l_shipdate <= timestamp_ntz'1998-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum(F.col("l_quantity").cast(DEC)).alias("sum_qty"), F.sum(F.col("l_extendedprice").cast(DEC)).alias("sum_price"), F.count(F.lit(1)).alias("n"))


@query("SELECT n_name, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey = 2 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY n_name")
def ext_star_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter("o_orderdate >= timestamp_ntz'1996-01-01' and o_orderdate < timestamp_ntz'1998-01-01'").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(table(spark, sf_dir, "nation").filter("n_regionkey = 2"), F.col("c_nationkey") == F.col("n_nationkey"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_extendedprice").cast(DEC).alias("price"))
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name").agg(F.sum("price").alias("revenue"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def ext_rollup(spark, sf_dir):
    return table(spark, sf_dir, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def ext_cube(spark, sf_dir):
    return table(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders")
def ext_intersect(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey").intersect(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")))


@query("SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def ext_except(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey").subtract(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")))


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1")
def ext_pivot(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))
    return g.select("o_orderpriority", *[F.coalesce(c, F.lit(0)).alias(c.lower()) for c in ("F", "O", "P")])


@query()
def ext_approx(spark, sf_dir):
    """Approximate distinct counts and quantiles, whose sketches other engines build differently."""
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("parts"), F.percentile_approx("l_extendedprice", 0.5, 1000).alias("median"))


@query("SELECT user_id, event_id, sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM events")
def ext_running_sum(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.sum(F.col("value").cast(DEC)).over(w).alias("running"))
