"""Joins that Spark has no single operator for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch

#: Rows up to which a reference list counts as small: it is checked before it is broadcast.
SMALL_ROWS = 50_000


def small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """The frame marked for broadcast if it has at most that many rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def asof(left: DataFrame, right: DataFrame, by: list[str], on: str, values: list[str], fallback_first: bool = True) -> DataFrame:
    """For each left row the values of the latest right row of its group with right.on <= left.on.

    If there is none: the group's earliest right row, or nulls.  Both sides are
    merged into one ordered stream of a group, so no pairs are made; a right row
    counts as before a left row at the same place.
    """
    packed = F.struct(*[F.col(v) for v in values])
    lcols = [c for c in left.columns if c not in (*by, on)]
    a = left.select(*by, on, F.lit(1).alias("__side"), F.struct(*lcols).alias("__left") if lcols else F.lit(None).alias("__left"), F.lit(None).cast(right.select(packed.alias("x")).schema["x"].dataType).alias("__right"))
    b = right.select(*by, on, F.lit(0).alias("__side"), F.lit(None).cast(a.schema["__left"].dataType).alias("__left"), packed.alias("__right"))
    order = Window.partitionBy(*by).orderBy(on, "__side")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    got = F.last("__right", ignorenulls=True).over(upto)
    if fallback_first:
        got = F.coalesce(got, F.first("__right", ignorenulls=True).over(every))
    out = a.unionByName(b).withColumn("__got", got).filter("__side = 1")
    return out.select(*by, on, *[F.col("__left")[c].alias(c) for c in lcols], *[F.col("__got")[v].alias(v) for v in values])


def attach_list(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, order: list[str], name: str, count: str) -> DataFrame:
    """The parent with an ordered list of its child rows and their number; without children both are null and 0."""
    cols = [c for c in child.columns if c != child_key]
    lists = child.groupBy(F.col(child_key).alias("__k")).agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in cols if c not in order]))).alias(name), F.count(F.lit(1)).alias(count))
    return parent.join(lists, parent[parent_key] == F.col("__k"), "left").drop("__k").withColumn(count, F.coalesce(count, F.lit(0)))


def routed(child: DataFrame, batch: DataFrame, store: DataFrame, child_key: str, parent_key: str, route: str = "route") -> DataFrame:
    """The children with their route: the parent is in the 'batch', in the 'store' only, or nowhere ('orphan', null keys too).

    One join on the parents' keys, each with where it is.
    """
    place = lambda p, n: p.select(F.col(parent_key).alias("__k"), F.lit(n).alias("__place"))
    parents = place(batch, 0).unionByName(place(store, 1)).groupBy("__k").agg(F.min("__place").alias("__place"))
    out = child.join(parents, child[child_key] == F.col("__k"), "left")
    return out.withColumn(route, F.when(F.col("__place") == 0, "batch").when(F.col("__place") == 1, "store").otherwise("orphan")).drop("__k", "__place")


def link_children(df: DataFrame, key: str, parent: str) -> DataFrame:
    """A self-join: each row with the sorted distinct keys of the rows that name it as parent, and their number."""
    kids = df.filter(F.col(parent).isNotNull()).groupBy(F.col(parent).alias("__p")).agg(F.array_sort(F.collect_set(key)).alias("children"))
    out = df.join(kids, df[key] == F.col("__p"), "left").drop("__p")
    return out.withColumn("n_children", F.coalesce(F.size("children"), F.lit(0)).cast("bigint")).withColumn("n_children", F.greatest("n_children", F.lit(0)))


def in_range(df: DataFrame, ranges: DataFrame, value: Column, low: str, high: str, gap_first: bool = False, levels: int = 40) -> DataFrame:
    """Left join with ranges, both ends included, a null high end open; every range that holds a value.

    A range is cut into at most 2 * levels blocks [k 2^l, (k + 1) 2^l) of whole
    numbers, a value lies in one block of each level in use, and the two meet on
    (level, block): an equi-join of any length, with no product.  With gap_first a
    value that no range holds takes the range of the least low end, as do values up
    to zero.  Null values match nothing.  Whole parts reach to 2^levels either way;
    ends beyond lie in blocks of their own.
    """
    edge, cols = 1 << levels, ranges.columns
    left = df.withColumn("__v", value)
    whole = lambda c: F.when(c.isNotNull(), F.floor(F.least(F.greatest(c, F.lit(-edge)), F.lit(edge))).cast("long"))
    r = ranges.withColumn("__lo", whole(ranges[low])).withColumn("__hi", F.coalesce(whole(ranges[high]), F.lit(edge))).filter("__lo <= __hi")
    blocks = F.udtf(RangeBlocks, returnType="level int, block long")
    r = r.lateralJoin(blocks(F.col("__lo").outer(), F.col("__hi").outer()))
    used = r.select("level").distinct().agg(F.array_sort(F.collect_list("level")).alias("levels"))  # one row of at most levels + 2 numbers
    keys = left.select("__v").distinct().filter("__v IS NOT NULL").crossJoin(F.broadcast(used)).withColumn("level", F.explode("levels"))
    keys = keys.select("__v", "level", F.call_function("shiftright", whole(F.col("__v")), F.col("level")).alias("block"))
    held = (F.col("__v") >= F.col(low)) & (F.col(high).isNull() | (F.col("__v") <= F.col(high)))
    got = keys.join(r.select(*cols, "level", "block"), ["level", "block"]).filter(held).select(F.col("__v").alias("__k"), F.struct(*cols).alias("__r"))
    out = left.join(got, F.col("__v") == F.col("__k"), "left")
    if gap_first:
        first = ranges.agg(F.min_by(F.struct(*cols), F.col(low)).alias("__first"))
        out = out.crossJoin(F.broadcast(first)).withColumn("__r", F.when((F.col("__v") > 0) & F.col("__r").isNotNull(), F.col("__r")).when(F.col("__v").isNotNull(), F.col("__first")))
    return out.select(*df.columns, *[F.col("__r")[c].alias(c) for c in cols])


def range_totals(df: DataFrame, ranges: DataFrame, value: Column, low: str, high: str, count: str, **sums: str) -> DataFrame:
    """The rows with the number of ranges that hold a value, and with sums of whole-number columns of theirs; 0 where none does.

    What in_range and a grouping give, without the pairs, of which open or long ranges
    make as many as values times ranges.  The ranges that hold v are those that begin
    up to v less those that end before it: ends and distinct values are cut into
    pieces of one order and written, each piece is summed up on its own, and the
    totals of the earlier pieces are added.  Ends and values are compared as doubles.
    """
    spark, path, names = df.sparkSession, scratch(df.sparkSession, "ends"), [count, *sums]
    keyed = df.withColumn("__v", value.cast("double"))
    adds = [F.lit(1), *[F.coalesce(F.col(c), F.lit(0)) for c in sums.values()]]
    lo, hi = F.col(low).cast("double"), F.col(high).cast("double")
    r = ranges.filter(lo.isNotNull() & (hi.isNull() | (lo <= hi)))

    def points(rows: DataFrame, at: Column, side: int, sign: int) -> DataFrame:
        return rows.filter(at.isNotNull()).select(at.alias("__at"), F.lit(side).alias("__side"), *[(c * sign).cast("decimal(28,0)").alias(n) for n, c in zip(names, adds if sign else [F.lit(0)] * len(names), strict=True)])

    every = points(r, lo, 0, 1).unionByName(points(keyed, F.col("__v"), 1, 0)).unionByName(points(r, hi, 2, -1))
    ranged = every.groupBy("__at", "__side").agg(*[F.sum(n).alias(n) for n in names]).repartitionByRange("__at", "__side").withColumn("__part", F.spark_partition_id())
    ranged.write.parquet(path)
    held = spark.read.schema(ranged.schema).parquet(path)
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each piece
    before = held.groupBy(F.col("__part")).agg(*[F.sum(n).alias(n) for n in names]).select(F.col("__part").alias("__of"), *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__before_{n}") for n in names])
    upto = Window.partitionBy("__part").orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = held.select("__part", "__at", "__side", *[F.sum(n).over(upto).alias(n) for n in names]).filter("__side = 1")
    got = own.join(F.broadcast(before), F.col("__part") == F.col("__of")).select(F.col("__at").alias("__k"), *[(F.col(n) + F.col(f"__before_{n}")).cast("bigint").alias(f"__sum_{n}") for n in names])
    return keyed.join(got, F.col("__v") == F.col("__k"), "left").select(*df.columns, *[F.coalesce(f"__sum_{n}", F.lit(0)).alias(n) for n in names])


class RangeBlocks:
    """Cuts [lo, hi] into the largest aligned blocks of whole numbers."""

    def eval(self, lo: int, hi: int):
        level, hi = 0, hi + 1
        while lo < hi:
            if lo & 1:
                yield level, lo
                lo += 1
            if hi & 1:
                hi -= 1
                yield level, hi
            lo, hi, level = lo >> 1, hi >> 1, level + 1


def by_key_else(left: DataFrame, ref: DataFrame, left_key: Column, ref_key: Column, fuzzy, id_col: str) -> DataFrame:
    """Equi-join first; only the rows without a match go to `fuzzy(rest)`, which returns the same columns."""
    got = left.join(small(ref), left_key == ref_key)
    rest = left.join(got.select(F.col(id_col).alias("__id")), left[id_col] == F.col("__id"), "left_anti")
    return got.unionByName(fuzzy(rest), allowMissingColumns=True)


def with_all(left: DataFrame, ref: DataFrame) -> DataFrame:
    """Each left row with every row of the reference list.

    A list of at most SMALL_ROWS rows is broadcast.  A longer one is dealt into blocks
    of about that many rows by hash, and each left row goes to every block, so that no
    task holds the whole list.
    """
    if ref.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        return left.join(F.broadcast(ref), F.lit(True), "cross")
    blocks = -(-ref.count() // SMALL_ROWS)
    spread = left.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = ref.withColumn("__block", F.pmod(F.xxhash64(*ref.columns), F.lit(blocks)).cast("int"))
    return spread.join(dealt, "__block").drop("__block")


def sharing_a_word(left: DataFrame, ref: DataFrame, left_name: Column, ref_name: Column, left_id: str, ref_id: str) -> DataFrame:
    """Pairs of a left and a reference row whose names have a word in common, each once.

    For scores that are accepted only with such a word this leaves out no match, and
    the list may have any length; words of the reference list are counted nowhere, so
    a word that most names have makes as many pairs as with_all does.
    """
    words = lambda c: F.explode(F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 1)))
    a = left.select(F.col(left_id).alias("__left"), words(left_name).alias("__word"))
    b = ref.select(F.col(ref_id).alias("__ref"), words(ref_name).alias("__word"))
    pairs = a.join(b, "__word").select("__left", "__ref").distinct()
    return left.join(pairs, left[left_id] == pairs["__left"]).join(ref, F.col("__ref") == ref[ref_id]).drop("__left", "__ref")


def best_match(left: DataFrame, ref: DataFrame, score: Column, left_id: str, ref_order: str, accept: float, names: tuple[Column, Column] | None = None) -> DataFrame:
    """For each left row the reference row of the highest score, the first in ref_order among equals, if it is accepted.

    For scores of any kind: every left row is held against the whole list, or, given the
    two names, against the rows that share a word with it; only the best survives the
    partial aggregation.  Names are matched by fuzzy.nearest, which scores few pairs.
    """
    pairs = sharing_a_word(left, ref, *names, left_id, ref_order) if names else with_all(left, ref)
    pairs = pairs.withColumn("score", score).filter(F.col("score") >= accept)
    best = F.min_by(F.struct(*[F.col(c) for c in pairs.columns]), F.struct(-F.col("score"), F.col(ref_order)))
    return pairs.groupBy(F.col(left_id).alias("__id")).agg(best.alias("b")).select("b.*")


def rivals(df: DataFrame, seat: list[str], key: str, rank: str, n: int = 2) -> DataFrame:
    """For each row the n others of its seat with the highest rank value.

    A row's rivals are among the n + 1 highest of its seat, so only those meet all rows.
    """
    top = df.withColumn("__r", F.row_number().over(Window.partitionBy(*seat).orderBy(F.col(rank).desc(), key))).filter(F.col("__r") <= n + 1)
    other = top.select(*[F.col(s).alias(f"__{s}") for s in seat], F.col(key).alias("rival"), F.col(rank).alias("rival_total"))
    same = [df[s] == other[f"__{s}"] for s in seat]
    pairs = df.select(*seat, key).join(other, [*same, df[key] != other["rival"]])
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.col("rival_total").desc(), "rival"))
    return pairs.withColumn("place", place).filter(F.col("place") <= n).select(*seat, key, "rival", "rival_total", "place")


def intersect_all(sets: list[DataFrame], key: str) -> DataFrame:
    """Keys that are in every set, as a chain of semi-joins."""
    out = sets[0].select(key).distinct()
    for s in sets[1:]:
        out = out.join(s.select(key), key, "left_semi")
    return out
