"""Numeric expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x, kind: str = "decimal(20,2)") -> Column:
    """A decimal, null where the text is none; thousands separators and a dollar sign are allowed."""
    return F.regexp_replace(F.trim(_c(x).cast("string")), r"[,$]", "").try_cast(kind)


def plain_decimal(x, kind: str = "decimal(20,2)") -> tuple[Column, Column]:
    """(typed value, raw text where it cannot be typed)."""
    t = F.nullif(F.trim(_c(x).cast("string")), F.lit(""))
    v = t.try_cast(kind)
    return v, F.when(v.isNull(), t)


def finite(x) -> Column:
    """A double without NaN and infinities."""
    v = _c(x).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def bucket_10k(x) -> Column:
    """Cut towards zero to a multiple of 10,000."""
    return F.try_divide(_c(x), F.lit(10000)).cast("bigint") * 10000


def pe_ratio(price, eps) -> Column:
    return F.when(_c(eps) > 0, F.try_divide(_c(price), _c(eps)))


def dividend_yield(annual, price) -> Column:
    return F.when(_c(price) > 0, F.try_divide(_c(annual), _c(price)))


def market_cap(shares, price) -> Column:
    return F.when((_c(shares) > 0) & (_c(price) > 0), (_c(shares) * _c(price)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def pct_change(now, base) -> Column:
    return F.when(_c(base) > 0, (_c(now) - _c(base)) / _c(base) * 100).otherwise(F.lit(0.0))


def ieee_divide(a, b) -> Column:
    """A quotient of doubles by IEEE 754: an infinity or NaN over zero, where Spark has an error or null."""
    x, y = _c(a).cast("double"), _c(b).cast("double")
    over_zero = F.when((x == 0) | F.isnan(x), float("nan")).when(x.isNotNull(), F.signum(x) * float("inf"))
    return F.when(y == 0, over_zero).otherwise(F.try_divide(x, y))


def ieee_ln(x) -> Column:
    """A logarithm by IEEE 754: -inf of zero and NaN below it, where Spark has null."""
    v = _c(x).cast("double")
    return F.when(v == 0, float("-inf")).when(v < 0, float("nan")).otherwise(F.ln(v))


def flags_of(mask, names) -> Column:
    """The names of the bits set in a mask, lowest first."""
    return F.filter(F.array(*[F.when(_c(mask).bitwiseAND(F.lit(1 << k)) != 0, F.lit(n)) for k, n in enumerate(names)]), lambda x: x.isNotNull())


#: The disclosure forms' amount ranges.
AMOUNT_RANGES = [(0, 1000), (1001, 15000), (15001, 50000), (50001, 100000), (100001, 250000), (250001, 500000), (500001, 1000000), (1000001, 5000000), (5000001, 25000000), (25000001, 50000000), (50000001, None)]


def amount_bucket(x, ranges=AMOUNT_RANGES) -> Column:
    """struct<min, max> of the range that holds a value; what none holds falls into the first, as do values up to zero."""
    v = _c(x)
    box = lambda r: F.struct(F.lit(r[0]).cast("bigint").alias("min"), F.lit(r[1]).cast("bigint").alias("max"))
    held = lambda r: (v >= r[0]) & (F.lit(True) if r[1] is None else v <= r[1])
    return reduce(lambda w, r: w.when((v > 0) & held(r), box(r)), ranges, F).otherwise(box(ranges[0]))


#: Industry codes and their sectors; a narrower range inside a wider one is named before it.
SECTORS = [
    (100, 999, "Materials"),
    (1000, 1499, "Energy"),
    (1500, 1799, "Industrials"),
    (2830, 2836, "Health Care"),
    (2800, 2899, "Materials"),
    (3570, 3579, "Information Technology"),
    (3600, 3699, "Information Technology"),
    (3700, 3799, "Consumer Discretionary"),
    (2000, 3999, "Industrials"),
    (4800, 4899, "Communication Services"),
    (4000, 4999, "Utilities"),
    (5200, 5399, "Consumer Staples"),
    (5000, 5999, "Consumer Discretionary"),
    (6000, 6999, "Financials"),
    (7370, 7379, "Information Technology"),
    (7000, 7999, "Industrials"),
    (8000, 8099, "Health Care"),
    (8000, 8999, "Industrials"),
]
#: Words of a description that name a sector where no code does.
SECTOR_WORDS = [("software|computer|electronic", "Information Technology"), ("pharmaceutical|drug|medical|health", "Health Care"), ("bank|financial|insurance", "Financials")]


def sector(code, description=None, literal: bool = False) -> Column:
    """The sector of an industry code; with `literal` drugs (2830-2836) count as the chemicals around them."""
    n = _c(code).try_cast("int")
    out = reduce(lambda w, r: w.when(n.between(r[0], r[1]), F.lit(r[2])), [r for r in SECTORS if not (literal and r[0] == 2830)], F.when(n.isNull(), F.lit("Unknown")))
    if description is not None:
        out = reduce(lambda w, r: w.when(F.lower(_c(description)).rlike(r[0]), F.lit(r[1])), SECTOR_WORDS, out)
    return out.otherwise(F.lit("Unknown"))


def raw_value(json, *path: str) -> Column:
    """A number at a JSON path that may hold it bare or as `{"raw": ..}`."""
    at = "$." + ".".join(path)
    return F.coalesce(F.get_json_object(_c(json), at + ".raw").try_cast("double"), F.get_json_object(_c(json), at).try_cast("double"))
