"""Set operations, list merges and upserts of a batch into a store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    return a.join(b.select(*key).distinct(), key, "left_anti")


def delta(found: DataFrame, stored: DataFrame, incomplete: DataFrame, key: list[str]) -> DataFrame:
    """Keys that were found and are not stored, and stored ones that are incomplete."""
    return missing(found.select(*key), stored, key).unionByName(incomplete.select(*key)).distinct()


def seed(base: DataFrame, existing: DataFrame, key: str, **defaults: Column) -> DataFrame:
    """A default row for each key of the base that the other table lacks."""
    return missing(base.select(key).distinct(), existing, [key]).select(key, *[c.alias(k) for k, c in defaults.items()])


def merge_rows(old: DataFrame, new: DataFrame, owner: str, key: Column) -> DataFrame:
    """Old rows, and the new ones whose key their owner does not hold yet; rows without a key are always appended.

    New rows are not held against each other.
    """
    have = old.select(F.col(owner).alias("__o"), key.alias("__k")).filter("__k is not null").distinct()
    fresh = new.withColumn("__key", key)
    added = fresh.join(have, (fresh[owner] == have["__o"]) & (fresh["__key"] == have["__k"]), "left_anti").drop("__key")
    return old.unionByName(added)


def upsert(old: DataFrame, new: DataFrame, key: list[str], keep_old: tuple[str, ...] = (), lists: tuple[str, ...] = (), counts: dict[str, str] | None = None, counts_of: str = "merged") -> DataFrame:
    """New non-null values over old ones, lists united in order, counts of the merged (or the batch's) lists.

    Columns in keep_old stay as stored where they are.  One full outer join on the
    key; with merged counts a second run with the same batch changes nothing.
    """
    cols = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in key]
    o = old.select(*key, *[F.col(c).alias(f"__o_{c}") for c in old.columns if c not in key])
    n = new.select(*key, *[F.col(c).alias(f"__n_{c}") for c in new.columns if c not in key])
    both = o.join(n, key, "full_outer")
    has = set(both.columns)

    def value(c: str) -> Column:
        a, b = (F.col(f"__{s}_{c}") if f"__{s}_{c}" in has else None for s in "on")
        if a is None or b is None:
            return b if a is None else a
        if c in lists:
            return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.array_union(a, b))
        return F.coalesce(a, b) if c in keep_old else F.coalesce(b, a)

    out = {c: value(c) for c in cols}
    for name, listed in (counts or {}).items():
        source = out[listed] if counts_of == "merged" or f"__n_{listed}" not in has else F.coalesce(F.col(f"__n_{listed}"), out[listed])
        out[name] = F.coalesce(F.size(source), F.lit(0)).cast("bigint")
    return both.select(*key, *[c.alias(k) for k, c in out.items()])


def last_write(old: DataFrame, new: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the batch's last by order, else the stored one."""
    w = Window.partitionBy(*key).orderBy(F.col("__new").desc(), *order)
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    return both.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "__new")


def obligations(total: str, dollars: str, combined: str, is_parent: str) -> Column:
    """The stored total, else the dollars, else for a parent the combined amount; 0 counts as none."""
    some = lambda c: F.nullif(F.col(c), F.lit(0).cast("decimal(20,2)"))
    return F.coalesce(some(total), some(dollars), F.when(F.col(is_parent), some(combined)))


#: The kinds of vote and the lists of bills and rolls that older records hold them in; the first two lists also had other names.
VOTE_LISTS = {"Yea": ("bill_yea", "roll_yea"), "Nay": ("bill_nea", "roll_nea"), "Present": ("bill_present", "roll_present"), "Not Voting": ("bill_not_voting", "roll_not_voting")}


def entries_of_lists(df: DataFrame, key: str, lists: dict[str, tuple[str, str]] = VOTE_LISTS) -> DataFrame:
    """(key, bill_id, roll_id, vote_type, place) of records that hold eight parallel lists: one entry for each roll, its bill by place or ''.

    Null lists hold nothing; bills beyond the rolls are dropped, as they have no roll.
    """

    def listed(k: int, kind: str, bills: str, rolls: str) -> Column:
        def entry(roll: Column, j: Column) -> Column:
            return F.struct(F.coalesce(F.get(F.col(bills), j), F.lit("")).alias("bill_id"), roll.alias("roll_id"), F.lit(kind).alias("vote_type"), (j + F.lit(k * (1 << 24))).cast("long").alias("place"))

        return F.transform(F.coalesce(F.col(rolls), F.array().cast("array<string>")), entry)

    return df.select(key, F.inline(F.concat(*[listed(k, kind, *cols) for k, (kind, cols) in enumerate(lists.items())])))


def merge_entries(store: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """One entry for each (key, roll): the first of the store, else of the batch; one with a bill before all without.

    Both have key, bill_id, roll_id, vote_type and place; entries without a roll go.
    """
    both = store.withColumn("__side", F.lit(0)).unionByName(batch.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    both = both.withColumn("roll_id", F.trim("roll_id")).filter("roll_id <> ''")
    order = F.struct(F.coalesce(F.trim("bill_id"), F.lit("")) == "", "__side", "place", "bill_id", "vote_type")
    first = both.groupBy(key, "roll_id").agg(F.min_by(F.struct("bill_id", "vote_type"), order).alias("e"))
    return first.select(key, "roll_id", F.coalesce("e.bill_id", F.lit("")).alias("bill_id"), "e.vote_type")
