"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import markup


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def norm(x) -> Column:
    """Trimmed text, null if nothing is left."""
    return F.nullif(F.trim(_c(x).cast("string")), F.lit(""))


def first_filled(*xs) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*[norm(x) for x in xs])


def null_word(x) -> Column:
    """Text without the words that stand for nothing: blank, none, null, nan."""
    t = F.trim(_c(x).cast("string"))
    return F.when(~F.lower(t).isin("", "none", "null", "nan"), t)


def squeeze(x) -> Column:
    """Quotes around the whole unwrapped, runs of white space as one space, trimmed."""
    t = F.trim(_c(x))
    t = F.when((F.length(t) >= 2) & t.startswith('"') & t.endswith('"'), F.substr(t, F.lit(2), F.length(t) - 2)).otherwise(t)
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def recipient(x) -> tuple[Column, Column]:
    """(display name, index name) of a recipient."""
    t = norm(x)
    return F.upper(F.coalesce(t, F.lit("unknown"))), F.lower(F.coalesce(t, F.lit("unknown")))


def parse_bill_id(x) -> Column:
    """struct<congress:int, bill_type, number:int> of `congress-type-number`, null if it is no such id."""
    p = F.split(_c(x), "-")
    ok = (F.size(p) == 3) & F.element_at(p, 1).rlike(r"^\d+$") & F.try_element_at(p, F.lit(3)).rlike(r"^\d+$")
    return F.when(ok, F.struct(F.try_element_at(p, F.lit(1)).try_cast("int").alias("congress"), F.upper(F.try_element_at(p, F.lit(2))).alias("bill_type"), F.try_element_at(p, F.lit(3)).try_cast("int").alias("number")))


def bill_id(congress, kind, number) -> Column:
    return F.concat_ws("-", _c(congress).cast("string"), F.upper(_c(kind)), _c(number).cast("string"))


def district(state, number, senator) -> Column:
    """`ST07` for a seat, `ST` for a senator; a number that is none is appended as it is."""
    n = norm(number)
    seat = F.coalesce(F.lpad(n.try_cast("int").cast("string"), 2, "0"), n, F.lit(""))
    return F.when(_c(senator), F.upper(_c(state))).otherwise(F.concat(F.upper(_c(state)), seat))


def clean_name(x) -> Column:
    """A person's name without honorific, bracketed party and bracketed office."""
    t = F.regexp_replace(_c(x), r"(?i)^\s*(?:hon\.?|honorable|the honorable|rep\.?|representative|sen\.?|senator|mr\.?|mrs\.?|ms\.?|dr\.?)\s+", "")
    t = F.regexp_replace(t, r"\s*\[[^\]]*\]", "")
    t = F.regexp_replace(t, r"(?i)\s*\([^)]*(?:senator|representative)[^)]*\)", "")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


#: Words of headers and labels that stand where a name should, and noise of text recognition.
NO_NAMES = ("report", "type", "date", "owner", "ticker", "asset", "security", "transaction", "amount", "comment", "filer", "name", "senator", "representative", "the honorable", "periodic", "filing", "form")
NAME_NOISE = (r"^[Yy]r\s+[Dd]ay", r"^[A-Z]{1,2}\s+[A-Z]{1,2}$", r"^\d+$", r"^[^\w\s]+$")


def valid_name(x) -> Column:
    """Whether a text may be a person's name: three characters, a letter, no header's word alone or in front, no noise; null is none."""
    t = F.trim(_c(x))
    headed = F.lower(t).rlike("^(?:" + "|".join(NO_NAMES) + r")(?: |$)")
    noisy = t.rlike("|".join(f"(?:{p})" for p in NAME_NOISE))
    return F.coalesce((F.length(t) >= 3) & t.rlike("[A-Za-z]") & ~headed & ~noisy, F.lit(False))


def flip_name(x) -> Column:
    """`Last, First` as `First Last`; other names as they are."""
    p = F.split(_c(x), ",")
    return F.when(F.size(p) == 2, F.trim(F.concat_ws(" ", F.trim(F.element_at(p, 2)), F.trim(F.element_at(p, 1))))).otherwise(F.trim(_c(x)))


def split_name(x) -> Column:
    """struct<first, middle, last> of `Last, Hon.. First Middle` or `First Middle Last`."""
    flipped = F.regexp_replace(flip_name(F.regexp_replace(_c(x), r"(?i),\s*hon\.+\s*", ", ")), r"\s+", " ")
    p = F.filter(F.split(flipped, " "), lambda w: w != "")
    n = F.size(p)
    return F.struct(F.try_element_at(p, F.lit(1)).alias("first"), F.when(n > 2, F.array_join(F.slice(p, F.lit(2), F.greatest(n - 2, F.lit(0))), " ")).alias("middle"), F.when(n > 1, F.try_element_at(p, n)).alias("last"))


PARTY_BRACKET = r"\[([DRIL])-([A-Z]{2})(?:-(\d+))?\]"


def party_bracket(x) -> Column:
    """struct<party, state, district> of the `[D-NY-12]` in a name."""
    g = lambda k: F.nullif(F.regexp_extract(_c(x), PARTY_BRACKET, k), F.lit(""))
    return F.struct(g(1).alias("party"), g(2).alias("state"), g(3).try_cast("int").alias("district"))


def ticker(x) -> Column:
    """The first symbol in brackets, of one to five capitals."""
    return F.nullif(F.regexp_extract(_c(x), r"\(([A-Z]{1,5})\)", 1), F.lit(""))


def amount_range(x) -> Column:
    """struct<min:bigint, max:bigint, exact:decimal> of `$1,001 - $15,000`: a range needs min < max, else the first number is exact."""
    t = F.lower(F.regexp_replace(_c(x), r"[\s,$]", ""))
    low, high = (F.nullif(F.regexp_extract(t, r"^(\d+(?:\.\d+)?)(?:[-–—](\d+(?:\.\d+)?))?", k), F.lit("")).try_cast("decimal(20,2)") for k in (1, 2))
    plus = t.rlike(r"^(?:over)?\d+(?:\.\d+)?\+?$") & (t.rlike(r"\+$") | t.startswith("over"))
    low = F.coalesce(low, F.nullif(F.regexp_extract(t, r"^over(\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("decimal(20,2)"))
    span = high.isNotNull() & (low < high)
    return F.struct(F.when(span | plus, low.cast("bigint")).alias("min"), F.when(span, high.cast("bigint")).alias("max"), F.when(~span & ~plus, low).alias("exact"))


def clean_html(x) -> Column:
    """Markup off, character references decoded, white space squeezed."""
    return markup.text_of(_c(x))


def pick_format(urls, order=("htm", "html", "xml", "pdf")) -> Column:
    """The best of an array of URLs by file ending."""
    first = lambda end: F.try_element_at(F.filter(_c(urls), lambda u: F.lower(u).endswith("." + end)), F.lit(1))
    return F.coalesce(*[first(e) for e in order])


def htm_of_xml(url) -> Column:
    """The `.htm` beside an `.xml`."""
    return F.regexp_replace(F.regexp_replace(_c(url), r"/xml/", "/html/"), r"\.xml$", ".htm")


def middle_variants(x) -> Column:
    """A middle name in full, its initial, its initial with a dot, and none."""
    t = F.lower(norm(x))
    return F.when(t.isNull(), F.array(F.lit(""))).otherwise(F.array(t, F.substring(t, 1, 1), F.concat(F.substring(t, 1, 1), F.lit(".")), F.lit("")))


def composite_key(*xs) -> Column:
    return F.concat_ws("#", *[_c(x).cast("string") for x in xs])
