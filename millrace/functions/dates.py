"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fiscal_year(x) -> Column:
    """October to December belong to the next year."""
    return (F.year(_c(x)) + (F.month(_c(x)) >= 10).cast("int")).cast("int")


def election_cycle(x) -> Column:
    y = F.year(_c(x))
    return (y + F.pmod(y, F.lit(2))).cast("int")


def congress(year) -> Column:
    return (F.floor((_c(year) - 1789) / 2) + 1).cast("int")


def congress_range(first, last) -> Column:
    return F.sequence(congress(first), congress(last))


def quarter(x) -> Column:
    return F.quarter(_c(x))


def any_date(x, pivot: int = 50) -> Column:
    """A date in one of the accepted forms; two-digit years from the pivot on are of the last century."""
    t = F.trim(_c(x).cast("string"))
    short = F.regexp_extract_all(t, F.lit(r"^(\d{1,2})[/-](\d{1,2})[/-](\d{2})$"), F.lit(3))
    yy = F.try_element_at(short, F.lit(1)).try_cast("int")
    parts = F.split(t, "[/-]")
    century = F.when(yy >= pivot, F.lit(1900)).otherwise(F.lit(2000)) + yy
    from_short = F.when(F.size(short) > 0, F.try_to_date(F.concat_ws("-", century.cast("string"), F.lpad(F.try_element_at(parts, F.lit(1)), 2, "0"), F.lpad(F.try_element_at(parts, F.lit(2)), 2, "0")), "yyyy-MM-dd"))
    # a pattern is only tried on texts of its shape, so no part of a text is taken for a date
    forms = [(r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{8}$", "yyyyMMdd"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy")]
    return F.coalesce(*[F.when(t.rlike(shape), F.try_to_date(t, form)) for shape, form in forms], from_short, F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]"), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd")))


def ymd_int(x, fallback=None) -> Column:
    """YYYYMMDD as a number, from the fallback where the text is no date."""
    d = any_date(x)
    d = F.coalesce(d, any_date(fallback)) if fallback is not None else d
    return F.date_format(d, "yyyyMMdd").cast("int")


def first_date(*xs) -> Column:
    """The first of some fields whose first ten characters are a date."""
    return F.coalesce(*[F.when(F.length(_c(x).cast("string")) >= 10, F.try_to_date(F.substring(_c(x).cast("string"), 1, 10), "yyyy-MM-dd")) for x in xs])


def is_weekday(ts, zone: str = "America/New_York") -> Column:
    """Monday to Friday in the zone; no holidays."""
    return ~F.dayofweek(F.from_utc_timestamp(_c(ts).cast("timestamp"), zone)).isin(1, 7)


def rotation(ts, seconds: int = 480, n: int = 8) -> Column:
    """Which of n things is due at a time."""
    return F.pmod(F.floor(F.unix_seconds(_c(ts).cast("timestamp")) / seconds), F.lit(n)).cast("int")


def within(x, first, last) -> Column:
    """Inclusive by date; what is no date passes."""
    d = any_date(x)
    return d.isNull() | d.between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def on_date(x, day) -> Column:
    """Equal by date; what is no date fails."""
    return F.coalesce(any_date(x) == F.lit(day).cast("date"), F.lit(False))


def day_window(ts, hour: int = 11) -> Column:
    """struct<first, last>: the day-long window from `hour` to `hour` UTC that a time lies in."""
    t = _c(ts).cast("timestamp")
    first = F.date_trunc("day", t - F.make_dt_interval(hours=F.lit(hour))) + F.make_dt_interval(hours=F.lit(hour))
    return F.struct(first.alias("first"), (first + F.make_dt_interval(days=F.lit(1))).alias("last"))


def yesterday(ts, zone: str = "America/New_York") -> Column:
    """The day before, by a zone's calendar."""
    return F.date_sub(F.to_date(F.from_utc_timestamp(_c(ts).cast("timestamp"), zone)), 1)
