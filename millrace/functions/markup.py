"""Markup as columns: entities, cells of tables, text between marks.

Documents are cut with split, never with a pattern that walks over them, so the
length of a document sets no limit.
"""

from __future__ import annotations

import json
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F


#: The named references of HTML 4 and &apos;, as JSON.
NAMED = json.dumps({k: chr(v) for k, v in name2codepoint.items()} | {"apos": "'"})

#: A length that no array has: the rest of one, whose size is not asked for.
_ALL = 1 << 30


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def last_of(entries: Column, key: str) -> Column:
    """The entries (structs with a key) of an array, of those with one key the last."""
    return let(entries, lambda es: F.filter(es, lambda e, k: ~F.exists(F.slice(es, k + 2, _ALL), lambda later: later[key] == e[key])))


def _character(code: Column) -> Column:
    """The character of a code point; what is none is U+FFFD."""
    legal = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(legal, code).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")


def decode_entities(x: str | Column) -> Column:
    """Text with its character references decoded: decimal, hexadecimal and the named ones of HTML 4; others stay as they are."""
    names = F.from_json(F.lit(NAMED), "map<string,string>")  # one literal, folded once, not an expression for each name
    pieces = lambda c: F.regexp_extract_all(c, F.lit(r"&(?:#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]{1,30});|[^&]+|&"), F.lit(0))

    def one(p: Column) -> Column:
        name = F.substring_index(F.substring(p, 2, 40), ";", 1)
        code = F.when(F.lower(p).startswith("&#x"), F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(F.substring(name, 2, 8)).try_cast("bigint")
        coded = F.when(p.startswith("&#"), _character(code)).otherwise(F.coalesce(F.try_element_at(names, name), p))
        return F.when(p.startswith("&") & p.endswith(";"), coded).otherwise(p)

    return let(_c(x), lambda c: F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(pieces(c), one), "")).otherwise(c))


def text_of(x: str | Column) -> Column:
    """Markup off, references decoded, white space (that of &nbsp; too) squeezed and trimmed."""
    bare = F.regexp_replace(F.regexp_replace(_c(x), r"(?is)<(script|style)\b.*?</\1\s*>", " "), "<[^>]*>", " ")
    return F.trim(F.regexp_replace(F.replace(decode_entities(bare), F.lit(" "), F.lit(" ")), r"\s+", " "))


def after(x: Column, mark: str) -> Column:
    """What follows the first match of a pattern; null where it has none."""
    return F.try_element_at(F.split(x, f"(?is){mark}", 2), F.lit(2))


def before(x: Column, mark: str) -> Column:
    """What stands before the first match of a pattern, all of it where there is none."""
    return F.element_at(F.split(x, f"(?is){mark}", 2), 1)


def elements(x: Column, tag: str) -> Column:
    """Contents of the innermost elements of a tag (a pattern), markup in them included; an unclosed one ends with the next."""
    inside = F.slice(F.split(x, f"(?i)<{tag}\\b"), 2, _ALL)
    return F.transform(inside, lambda p: F.coalesce(after(before(p, f"</{tag}\\s*>"), ">"), F.lit("")))


def grid(x: Column) -> Column:
    """array<array<string>>: raw cells by row."""
    return F.transform(elements(x, "tr"), lambda r: elements(r, "t[dh]"))


def texts(x: Column) -> Column:
    """array<array<string>>: texts of the cells by row."""
    return F.transform(grid(x), lambda r: F.transform(r, text_of))


def bodies(x: Column) -> Column:
    """Raw rows of all table bodies; without any, of the whole."""
    return let(F.struct(x.alias("x"), elements(x, "tbody").alias("found")), lambda v: F.when(F.size(v["found"]) > 0, F.flatten(F.transform(v["found"], grid))).otherwise(grid(v["x"])))


def rows_of(x: str | Column) -> Column:
    """array<array<string>>: texts of the cells of all bodies."""
    return F.transform(bodies(_c(x)), lambda r: F.transform(r, text_of))


def table_with(x: str | Column, *headers: str) -> Column:
    """The first innermost table whose header row (the first with a cell) matches every pattern, without case; null if none does."""

    def fits(t: Column) -> Column:
        head = F.lower(F.array_join(F.transform(elements(F.try_element_at(elements(t, "tr"), F.lit(1)), "t[dh]"), text_of), "\n"))
        return F.coalesce(let(head, lambda c: reduce(Column.__and__, [c.rlike(h.lower()) for h in headers], F.lit(True))), F.lit(False))

    return F.try_element_at(F.filter(elements(_c(x), "table"), fits), F.lit(1))


def by_header(table: Column, columns: dict[str, str]) -> Column:
    """array<struct> of a table's rows below its header: each name takes the column whose header cell first matches its pattern, '' where a row is short, null where no header matches."""

    def place(head: Column, pattern: str) -> Column:
        return F.coalesce(F.array_position(F.transform(head, lambda h: h.rlike(pattern.lower())), True), F.lit(0)).cast("int")

    def rows(raw: Column, at: Column) -> Column:
        return F.transform(F.slice(raw, 2, _ALL), lambda r: F.struct(*[F.when(at[n] > 0, F.coalesce(text_of(F.get(r, at[n] - 1)), F.lit(""))).alias(n) for n in columns]))

    def read(raw: Column) -> Column:
        head = F.transform(F.try_element_at(raw, F.lit(1)), lambda h: F.lower(text_of(h)))
        places = let(head, lambda h: F.struct(*[place(h, p).alias(n) for n, p in columns.items()]))
        return let(places, lambda at: rows(raw, at))

    return let(grid(table), read)


def noted_cell(cell: Column, notes: Column) -> Column:
    """struct<value, footnote<number, explanation>> of a raw cell with a raised number; notes is a map by number, a missing explanation is empty."""
    number = F.nullif(F.regexp_extract(cell, r"(?i)<sup>\((\d+)\)</sup>", 1), F.lit("")).try_cast("int")
    bare = F.regexp_replace(F.regexp_replace(cell, r"(?is)<span[^>]*class=\"[^\"]*FootnoteData[^\"]*\"[^>]*>.*?</span>", ""), r"(?i)<sup>\(\d+\)</sup>", "")
    note = lambda n: F.when(n.isNotNull(), F.struct(n.alias("number"), F.coalesce(F.try_element_at(notes, n), F.lit("")).alias("explanation")))
    return F.struct(text_of(bare).alias("value"), let(number, note).alias("footnote"))
