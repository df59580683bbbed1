"""Trades in the text of periodic reports: a line machine cuts the text into trades, column expressions read their fields.

The machine is a table function, joined laterally: lines are of one of six kinds, and
a trade is what its opening line draws in from both sides.  All that can be read from
one trade's text alone is left to Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup, numbers

#: Words of table headers, by where they count: anywhere, inside a trade, between trades.
HEADER_WORDS = ("ownerasset", "transaction", "notification", "cap. gains", "filing id", "digitally signed", "certify", "id owner", "type date", "dateamount", "gains >", "$200?")
INNER_WORDS = ("ownerasset", "transaction", "notification", "id owner", "type date", "dateamount", "filing id")
BETWEEN_WORDS = ("id ownerasset", "transaction", "type date", "dateamount", "cap. gains", "$200?", "gains >")
#: Words of an asset's name, what marks metadata, codes, dates and money, and the kinds of trade.
ASSET_WORDS = ("stock", "common", "corporation", "inc", "ltd", "company", "shares")
METADATA, CODE, DATE, OWNER = r"(F\s+S:|S\s+O:|D:)", r"\[([A-Z]{2,3})\]", r"\d{1,2}/\d{1,2}/\d{4}", r"[A-Z]{1,3}\s+"
KINDS = {"P": "Purchase", "S": "Sale", "E": "Exercise"}
#: Lines before a trade's opening that may name its asset, and lines after it up to which an owner's code belongs to it.
REACH = 3

_META, _CODE, _DATE, _OWNER = re.compile(METADATA, re.I), re.compile(CODE), re.compile(DATE), re.compile(OWNER)
_CASH, _MONEY, _TICKER = re.compile(r"\$\d+"), re.compile(r"\$\d+"), re.compile(r"\([A-Z]{1,5}\)")


class Kind(Enum):
    """What a line is where a trade may open."""

    HEADER = 0
    METADATA = 1
    OPENING = 2
    TEXT = 3


def holds(line: str, words: tuple[str, ...]) -> bool:
    low = line.lower()
    return any(w in low for w in words)


def kind_of(line: str) -> Kind:
    if holds(line, HEADER_WORDS):
        return Kind.HEADER
    if _META.match(line):
        return Kind.METADATA
    opens = _CODE.search(line) and (_DATE.search(line) or _MONEY.search(line) or _OWNER.match(line))
    return Kind.OPENING if opens else Kind.TEXT


def names_asset(line: str) -> bool:
    """Whether a line before a trade is a part of its asset's name."""
    if _META.match(line) or holds(line, INNER_WORDS) or _CODE.search(line) or _DATE.search(line):
        return False
    return bool(_OWNER.match(line) or _TICKER.search(line) or holds(line, ASSET_WORDS))


def drawn_in(lines: list[str], at: int) -> tuple[list[str], int]:
    """The lines that follow a trade's opening and belong to it, and where they end."""
    taken, k = [], at + 1
    while k < len(lines):
        line = lines[k]
        coded, owned = _CODE.search(line), _OWNER.match(line)
        if _META.match(line) or coded and owned or holds(line, INNER_WORDS):
            break
        if coded:  # a code without an owner: another trade, if this one is whole
            text = " ".join([lines[at], *taken])
            if _DATE.search(text) and _MONEY.search(text):
                break
        elif owned and k > at + REACH:
            break
        else:
            taken.append(line)
            if _CASH.match(line) and not _DATE.search(line):
                return taken, k + 1
        k += 1
    return taken, k


def between(lines: list[str], at: int) -> list[str]:
    """All lines after a trade's opening up to the next trade, headers left out."""
    out = []
    for k in range(at + 1, len(lines)):
        if holds(lines[k], BETWEEN_WORDS):
            continue
        if _OWNER.match(lines[k]) and not _META.match(lines[k]) and any(_CODE.search(x) for x in lines[k : k + 2]):
            break
        out.append(lines[k])
    return out


def blocks_of(text: str | None) -> Iterator[tuple[int, str, str | None]]:
    """(number, text, metadata) of each trade in a report."""
    lines = [x for x in (y.strip() for y in (text or "").split("\n")) if x]
    at = n = end = 0
    while at < len(lines):
        if kind_of(lines[at]) is not Kind.OPENING:
            at += 1
            continue
        lead = [x for x in lines[max(end, at - REACH) : at] if names_asset(x)]
        after, end = drawn_in(lines, at)
        yield n, " ".join([*lead, lines[at], *after]), "\n".join(between(lines, at)) or None
        at, n = end, n + 1


class TradeBlocks:
    """The table function of a report's text."""

    def eval(self, text: str):
        yield from blocks_of(text)


# ---------------------------------------------------------------- fields


def _first(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def _let(c: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.element_at(F.transform(F.array(c), f), 1)


def _day(c: Column) -> Column:
    return F.try_to_date(c, "M/d/yyyy")


def signed(text: Column) -> Column:
    """The day of a report's signature, else its last date."""
    marks = [r"(?is)Digitally Signed:\s+[^,]+,\s*(\d{1,2}/\d{1,2}/\d{4})", r"(?is)Digitally Signed:\s+[^\d]+(\d{1,2}/\d{1,2}/\d{4})", r"(?is)(?:signed|signature)[:\s]+[^,]+,\s*(\d{1,2}/\d{1,2}/\d{4})", r"(?is)(?:signed|signature)[:\s]+[^\d]+(\d{1,2}/\d{1,2}/\d{4})"]
    last = lambda p, g: F.try_element_at(F.regexp_extract_all(text, F.lit(p), F.lit(g)), F.lit(-1))
    return F.coalesce(*[_day(last(m, 1)) for m in marks], _day(last(DATE, 0)))


def filer(text: Column) -> Column:
    """The name behind `Name:` (up to `Status:` where it stands), `Hon.` or `The Honorable`."""
    person = r"([A-Z][a-z]+(?:\s+[A-Z][a-z.]+)+)"
    found = [_first(text, p) for p in (r"(?i)Name:\s*(?:Hon\.?\s+)?([A-Z][a-z]+(?:\s+[A-Z][a-z.]+)+?)(?=\s+Status:)", rf"(?i)Name:\s*(?:Hon\.?\s+)?{person}", rf"Hon\.?\s+{person}", rf"The Honorable\s+{person}")]
    name = F.regexp_replace(F.coalesce(*found), r"(?i)^Hon\.?\s+|\s+Status\s*$", "")
    return F.nullif(F.trim(F.regexp_replace(name, r"\s+", " ")), F.lit(""))


def amounts(body: Column) -> Column:
    """struct<min, max, exact>: the standard range of an amount or of a range's middle; exact where it is one amount, or no rising range."""
    span = r"(?i)\$([\d,]+)\s*(?:[-–—]|\bto\b|\bthrough\b)\s*\$([\d,]+)"
    number = lambda c: F.replace(c, F.lit(","), F.lit("")).try_cast("decimal(20,2)")
    low, high, single = number(_first(body, span, 1)), number(_first(body, span, 2)), number(_first(body, r"\$([\d,]+)(?:\s|$|[^\d,])"))

    return standard_range(low, high, single)


def standard_range(low: Column, high: Column, single: Column) -> Column:
    """struct<min, max, exact> of the two ends of a range, or of one amount where they are null."""

    def boxed(x: Column) -> Column:
        ranged = F.coalesce(x["low"] < x["high"], F.lit(False))
        one = F.when(x["low"].isNotNull() & x["high"].isNotNull(), x["low"]).otherwise(x["single"])
        box = lambda v: F.when(v.isNotNull(), numbers.amount_bucket(v))
        return F.struct(_let(F.when(ranged, (x["low"] + x["high"]) / 2).otherwise(one), box).alias("box"), F.when(~ranged, one.cast("bigint")).alias("exact"))

    out = _let(F.struct(low.alias("low"), high.alias("high"), single.alias("single")), boxed)
    return F.struct(out["box"]["min"].alias("min"), out["box"]["max"].alias("max"), out["exact"].alias("exact"))


def asset(body: Column, owner: Column) -> tuple[Column, Column]:
    """(name, symbol) of what stands before a trade's code, freed of metadata, owners, dates and amounts."""
    text = F.regexp_replace(body, r"(?i)\s*F\s+S:\s*\S*|\s*C:\s*Ref:\s*\S*", "")
    text = F.when(owner.isNotNull(), F.regexp_replace(text, rf"^{OWNER}", "")).otherwise(text)
    front = F.regexp_extract(text, rf"^(.*?){CODE}", 1)
    symbol = _first(front, r"\(([A-Z]{1,5})\)")
    name = F.when(symbol.isNotNull(), F.regexp_extract(front, r"^(.*?)\([A-Z]{1,5}\)", 1)).otherwise(front)
    noise = (rf"{DATE}", r"\$\d+[\d,]*\s*[-–]?\s*\$?\d+[\d,]*", r"(?i)\s*\(partial\)\s*", r"(?i)\s*Account\s*#?\s*\d*", r"^\s*[PS]\s+", rf"^{OWNER}", r"\s+[PS]\s*$")
    for p in noise:
        name = F.regexp_replace(name, p, "")
    name = F.regexp_replace(name, r"\s+[PS]\s+", " ")
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(name, r"[,.]\s*$", ""), r"\s+", " ")), F.lit("")), symbol


def trade_reports(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each trade of each report: id, n (from 0 among the trades found), filer, owner, asset, symbol, code, kind, kind_name, traded, filed, amount, amount_min, amount_max, exact_amount, metadata.

    A trade needs a date, a kind, an amount, and a name or a symbol; others go, and
    leave a gap in n.  `filed` is a trade's second date, else the signature's, else the
    report's last.  Null and empty texts have no trades.
    """
    blocks = F.udtf(TradeBlocks, returnType="n int, body string, metadata string", useArrow=False)
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("__text")).filter("__text IS NOT NULL")
    rows = src.lateralJoin(blocks(F.col("__text").outer()))
    body = F.col("body")
    owner = _first(body, rf"^([A-Z]{{1,3}})\s+")
    kind = F.coalesce(_first(body, rf"{CODE}\s*([A-Z])(?:\s*\([^)]*\))?\s+{DATE}", 2), _first(body, rf"\s([PS])(?:\s*\([^)]*\))?\s+{DATE}"))
    dates = F.regexp_extract_all(body, F.lit(DATE), F.lit(0))
    name, symbol = asset(body, owner)
    kind_name = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in KINDS.items()], kind)
    out = rows.select(
        "id", "n", filer(F.col("__text")).alias("filer"), owner.alias("owner"), name.alias("asset"), symbol.alias("symbol"), _first(body, CODE).alias("code"),
        kind.alias("kind"), kind_name.alias("kind_name"), _day(F.try_element_at(dates, F.lit(1))).alias("traded"),
        F.coalesce(_day(F.try_element_at(dates, F.lit(2))), signed(F.col("__text"))).alias("filed"),
        _first(body, r"(?i)(\$[\d,]+(?:\s*(?:[-–—]|to|through)\s*\$[\d,]+)?)").alias("amount"), amounts(body).alias("__a"), "metadata",
    )
    out = out.filter(F.col("traded").isNotNull() & F.col("kind").isNotNull() & F.col("__a.min").isNotNull() & F.coalesce("asset", "symbol").isNotNull())
    return out.select(*[c for c in out.columns if c not in ("__a", "metadata")], F.col("__a.min").alias("amount_min"), F.col("__a.max").alias("amount_max"), F.col("__a.exact").alias("exact_amount"), "metadata")


# ---------------------------------------------------------------- reports with a table

#: The columns of a report's table, left of and beside the amount, and the words for buying and selling.
TABLE_COLUMNS = ("traded", "owner", "ticker", "asset", "asset_type", "kind", "amount", "comment")
BUYS, SELLS = ("purchase", "buy", "acquired"), ("sale", "sell", "disposed")
_NOTES = r"(?is)<div[^>]*class=\"text-muted\"[^>]*>(.*?)</div>"


def table_filer(html: Column) -> Column:
    """The name in the report's heading, without `The Honorable` and what stands in brackets."""
    head = _first(html, r"(?is)<h2[^>]*class=[\"']filedReport[\"'][^>]*>([^<]+)</h2>")
    name = F.regexp_replace(F.regexp_replace(markup.text_of(head), r"(?i)^The\s+Honorable\s+", ""), r"\s*\([^)]*\)?.*$", "")
    return F.nullif(F.trim(name), F.lit(""))


def table_trades(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """One row for each trade in the table of a report: id, n (the table's row, from 0), filer, traded, owner, symbol, asset, asset_type, kind, code, amount_min, amount_max, exact_amount, comment, metadata.

    Columns are counted from the first cell with an amount, else from the left, where a
    number of the row may stand.  Rows of fewer than seven cells, without a kind or
    without an amount go.  `metadata` maps the labels of the asset's small print.  A
    date that is none is null, as is the symbol `--`.
    """
    part = markup.before(markup.after(F.col(html_col), r"<table[^>]*class=[\"']table[^>]*>"), "</table")
    rows = F.flatten(F.transform(markup.elements(part, "tbody"), markup.grid))
    src = df.select(F.col(id_col).alias("id"), table_filer(F.col(html_col)).alias("filer"), F.posexplode(rows).alias("n", "raw")).filter("size(raw) >= 7")
    src = src.withColumn("cells", F.transform("raw", markup.text_of))
    paid = F.transform("cells", lambda c: F.contains(c, F.lit("$")) & c.rlike(r"[-\d]"))
    src = src.withColumn("at", (F.coalesce(F.array_position(paid, True), F.lit(0)) - 1).cast("int"))
    src = src.withColumn("base", F.when(F.col("at") >= 6, F.col("at") - 6).otherwise(F.get("cells", 0).rlike(r"^\d+$").cast("int")))
    cell = {c: F.coalesce(F.get("cells", F.col("base") + k), F.lit("")) for k, c in enumerate(TABLE_COLUMNS)}
    raw_asset = F.get("raw", F.col("base") + TABLE_COLUMNS.index("asset"))
    notes = F.regexp_extract_all(F.regexp_extract(raw_asset, _NOTES, 1), F.lit(r"(?is)<em>([^<]+):</em>\s*([^<]+)"), F.lit(0))
    pairs = F.transform(notes, lambda m: F.struct(markup.text_of(F.regexp_extract(m, r"(?is)<em>([^<]+):</em>", 1)).alias("k"), markup.text_of(F.regexp_extract(m, r"(?is)</em>(.*)$", 1)).alias("v")))
    pairs = markup.last_of(F.filter(pairs, lambda p: (p["k"] != "") & (p["v"] != "")), "k")
    digits = F.regexp_replace(cell["amount"], "[$,]", "")
    ends = [F.nullif(F.regexp_extract(digits, r"(?i)(\d+)\s*(?:[-–—]|\bto\b|\bthrough\b)\s*(\d+)", k), F.lit("")).try_cast("decimal(20,2)") for k in (1, 2)]
    single = F.nullif(F.regexp_replace(digits, r"[^\d.]", ""), F.lit("")).try_cast("decimal(20,2)")
    kind = F.lower(cell["kind"])
    out = src.select(
        "id", "n", "filer", _day(cell["traded"]).alias("traded"), cell["owner"].alias("owner"), F.when(~cell["ticker"].isin("--", ""), cell["ticker"]).alias("symbol"),
        markup.text_of(F.regexp_replace(F.coalesce(raw_asset, F.lit("")), _NOTES, "")).alias("asset"), cell["asset_type"].alias("asset_type"), cell["kind"].alias("kind"),
        F.when(kind.isin(*BUYS), "P").when(kind.isin(*SELLS), "S").otherwise(F.upper(F.left(cell["kind"], F.lit(1)))).alias("code"),
        cell["amount"].alias("amount"), standard_range(*ends, single).alias("__a"), cell["comment"].alias("comment"), markup.let(pairs, lambda ps: F.when(F.size(ps) > 0, F.map_from_entries(ps))).alias("metadata"),
    ).filter("kind <> '' AND amount NOT IN ('', '--')")
    return out.select(*out.columns[:10], F.col("__a.min").alias("amount_min"), F.col("__a.max").alias("amount_max"), F.col("__a.exact").alias("exact_amount"), "comment", "metadata")
