"""Order-sensitive choices: first wins, preferred wins, top n, batches, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch


def pick(df: DataFrame, by: list[str], order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of each group; the order must be total for the result to be certain."""
    name = rank or "__n"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def first_attributes(df: DataFrame, by: list[str], order: list[Column | str], attributes: list[str], **aggs: Column) -> DataFrame:
    """Attributes of a group's first row, and aggregates over all of it; partial sums before the shuffle."""
    first = F.min_by(F.struct(*attributes), F.struct(*order))
    out = df.groupBy(*by).agg(first.alias("__f"), *[c.alias(k) for k, c in aggs.items()])
    return out.select(*by, *[F.col("__f")[a].alias(a) for a in attributes], *aggs)


def numbered(df: DataFrame, by: list[str], order: list[Column | str], name: str) -> DataFrame:
    """The rows with their number, from 1, inside their group by an order.

    The rows are cut into ranges over groups and order and written, each range is
    numbered on its own, and the sizes of a group's earlier ranges are added, so no
    task holds a group.  Rows that agree in group and order have either order.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, "ranges")
    ranged = df.repartitionByRange(*by, *order).withColumn("__part", F.spark_partition_id())
    ranged.write.parquet(path)
    held = spark.read.schema(ranged.schema).parquet(path)
    sizes = held.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(c).alias(f"__{k}") for k, c in enumerate(by)], F.col("__part").alias("__of"), F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"))
    own = held.withColumn("__n", F.row_number().over(Window.partitionBy("__part", *by).orderBy(*order)))
    same = [held[c].eqNullSafe(sizes[f"__{k}"]) for k, c in enumerate(by)] + [held["__part"] == sizes["__of"]]
    return own.join(sizes, same).select(*df.columns, (F.col("__before") + F.col("__n")).alias(name))


def batches(df: DataFrame, by: list[str], order: list[Column | str], size: int, key: str) -> DataFrame:
    """Batches of `size` rows in order: batch_number from 1, total, and the list of keys. (ntile would even them out instead.)"""
    out = numbered(df, by, order, "__n").withColumn("batch_number", (F.floor((F.col("__n") - 1) / size) + 1).cast("int"))
    out = out.groupBy(*by, "batch_number").agg(F.array_sort(F.collect_list(F.struct("__n", key))).alias("__k"))
    totals = out.groupBy(*[F.col(c).alias(f"__{k}") for k, c in enumerate(by)]).agg(F.max("batch_number").alias("total"))
    out = out.join(totals, [out[c].eqNullSafe(totals[f"__{k}"]) for k, c in enumerate(by)])
    return out.select(*by, "batch_number", "total", F.transform("__k", lambda x: x[key]).alias("keys"))


def page(df: DataFrame, sort: str, key: str, size: int, after: tuple | None = None, descending: bool = False) -> DataFrame:
    """A page by key: rows after (sort value, key) of the last row seen. The filter reaches the scan; nothing is skipped by number."""
    if after is not None:
        s, k = after
        beyond = F.col(sort) < s if descending else F.col(sort) > s
        df = df.filter(beyond | (F.col(sort) == s) & (F.col(key) > k))
    return df.orderBy(F.col(sort).desc() if descending else F.col(sort).asc(), key).limit(size)


def latest_filled(df: DataFrame, by: list[str], field: str, at: str, value: str, priority: list[str]) -> DataFrame:
    """The latest non-zero value of the first field, by priority, that has one."""
    live = df.filter(F.col(value).isNotNull() & (F.col(value) != 0) & F.col(field).isin(*priority))
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(field))
    out = live.groupBy(*by).agg(F.min_by(F.struct(field, at, value), F.struct(rank, -F.unix_micros(F.col(at).cast("timestamp")))).alias("b"))
    return out.select(*by, F.col("b")[field].alias(field), F.col("b")[at].alias(at), F.col("b")[value].alias(value))
