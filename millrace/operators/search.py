"""The query surface: templates over keyed tables, edge tables, autocomplete."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def predicate(**conditions: Any) -> Column:
    """All of: `a=1` equal, `a=[1, 2]` one of, `a=(lo, hi)` between (None is open), `a__prefix`, `a__contains`, `a__has` (array)."""
    out = []
    for name, v in conditions.items():
        col, _, op = name.partition("__")
        c = F.col(col)
        if op == "prefix":
            out.append(F.startswith(c, F.lit(v)))
        elif op == "contains":
            out.append(F.contains(c, F.lit(v)))
        elif op == "has":
            out.append(F.array_contains(c, v))
        elif isinstance(v, tuple):
            out += [c >= v[0]] * (v[0] is not None) + [c <= v[1]] * (v[1] is not None)
        elif isinstance(v, list):
            out.append(c.isin(v))
        else:
            out.append(c == v)
    return reduce(Column.__and__, out, F.lit(True))


def index(df: DataFrame, hash_key: str, range_key: str, keys_only: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of a sparse index: without its keys a row is not in it."""
    out = df.filter(F.col(hash_key).isNotNull() & F.col(range_key).isNotNull())
    return out.select(*dict.fromkeys([hash_key, range_key, *keys_only])) if keys_only else out


def lookup(df: DataFrame, hash_key: str, value, range_key: str, between: tuple = (None, None), descending: bool = True, limit: int | None = None, tie: str | None = None) -> DataFrame:
    """Equality on the hash key, a range and an order on the range key."""
    out = index(df, hash_key, range_key).filter(predicate(**{hash_key: value, range_key: between}))
    order = [F.col(range_key).desc() if descending else F.col(range_key).asc(), *([F.col(tie)] if tie else [])]
    return out.orderBy(*order).limit(limit) if limit else out.orderBy(*order)


def edges(df: DataFrame, entity: str, carried: list[str], **params: Column) -> DataFrame:
    """(parameter_type, parameter_value, entity, carried...) rows of scalar or array parameters; blanks and repeats go."""
    kinds = df.select(*[c.alias(k) for k, c in params.items()]).schema

    def typed(kind: str, c: Column) -> Column:
        values = c.cast("array<string>") if kinds[kind].dataType.typeName() == "array" else F.array(c.cast("string"))
        once = F.array_distinct(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.trim(v)))  # by hash, as they are plain texts
        return F.transform(once, lambda v: F.struct(F.lit(kind).alias("parameter_type"), v.alias("parameter_value")))

    every = F.concat(*[typed(k, c) for k, c in params.items()])
    out = df.select(entity, *carried, F.explode(every).alias("p")).select("p.*", entity, *carried)
    return out.filter("parameter_value is not null and parameter_value <> ''")


def autocomplete(df: DataFrame, col: str, prefix: str, limit: int = 10) -> DataFrame:
    """Distinct values that start with a prefix, whatever its case, in alphabetical order."""
    v = df.select(F.col(col).alias("value")).filter(F.startswith(F.lower("value"), F.lit(prefix.lower()))).distinct()
    return v.orderBy(F.lower("value"), "value").limit(limit)
