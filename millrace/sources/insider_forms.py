"""Ownership reports (forms 3, 4 and 5) as columns: the fields of the head, and the rows of both tables with their footnotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup

#: What the columns of a table's rows are, by form, and how many cells make a row.
NON_DERIVATIVE = {
    "3": ["security", "shares", "ownership", "nature"],
    "4": ["security", "transacted", "deemed", "code", "code_v", "shares", "direction", "price", "owned_after", "ownership", "nature"],
}
DERIVATIVE = {
    "3": ["security", "exercisable", "expires", "underlying", "underlying_shares", "exercise_price", "ownership", "nature"],
    "4": ["security", "exercise_price", "transacted", "deemed", "code", "code_v", "acquired", "disposed", "exercisable", "expires", "underlying", "underlying_shares", "price", "owned_after", "ownership", "nature"],
}
LEAST_CELLS = {("I", "3"): 4, ("I", "4"): 8, ("II", "3"): 6, ("II", "4"): 10}
#: The dates' labels by form, the bits of a relationship, and the meanings of codes.
EVENT_LABEL = {"3": "Date of Event Requiring Statement", "4": "Date of Earliest Transaction", "5": "Statement for Issuer's Fiscal Year Ended"}
DIRECTOR, OFFICER, OWNER, OTHER = 1, 2, 4, 8
CODES = {
    "A": "Grant, award or other acquisition",
    "C": "Conversion of derivative security",
    "D": "Disposition to the issuer of issuer equity securities",
    "E": "Expiration of short derivative position",
    "F": "Payment of exercise price or tax liability by delivering or withholding securities",
    "G": "Bona fide gift",
    "H": "Expiration (or cancellation) of long derivative position with value received",
    "I": "Discretionary transaction in accordance with Rule 10b5-1",
    "J": "Other acquisition or disposition",
    "L": "Small acquisition under Rule 16a-6",
    "M": "Exercise or conversion of derivative security",
    "O": "Transaction in equity swap or instrument with similar characteristics",
    "P": "Open market or private purchase of non-derivative or derivative security",
    "S": "Open market or private sale of non-derivative or derivative security",
    "U": "Disposition pursuant to a tender of shares in a change of control transaction",
    "V": "Transaction voluntarily reported earlier than required",
    "W": "Acquisition or disposition by will or the laws of descent and distribution",
    "X": "Exercise of out-of-the-money derivative security",
    "Z": "Deposit into or withdrawal from voting trust",
}
OWNERSHIP, DIRECTION = {"D": "Direct", "I": "Indirect"}, {"A": "Acquired", "D": "Disposed"}
_DATE = r"(\d{1,2}/\d{1,2}/\d{4})"
_DATA = r"(?is)<span[^>]*class=\"FormData\"[^>]*>([^<]*)</span>"
_SIGNED = r"(?is)<u>\s*<span[^>]*class=\"FormData\"[^>]*>([^<]*)</span>\s*</u>"


def _filled(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    return _filled(F.regexp_extract(c, pattern, group))


def _day(c: Column) -> Column:
    return F.try_to_date(c, "M/d/yyyy")


def _data(c: Column) -> Column:
    """Texts of the filled-in spans."""
    return F.transform(F.regexp_extract_all(c, F.lit(_DATA), F.lit(1)), markup.text_of)


def _meaning(code: Column, names: dict[str, str], other: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.when(_filled(code).isNotNull(), F.coalesce(F.try_element_at(known, F.upper(code)), other))


# ---------------------------------------------------------------- head


def labelled_day(html: Column, label: str) -> Column:
    """The date in the first filled-in span behind a label, with nothing but spans and breaks between."""
    return _day(F.regexp_extract(html, rf"(?is){label}[^<]*(?:</?(?:span|br)\b[^>]*>[^<]*){{0,4}}?<span[^>]*class=\"FormData\"[^>]*>\s*{_DATE}", 1))


def address(html: Column) -> Column:
    """Street lines, city, state and zip by comma: the last filled-in table between the name and the mark (Street), and the first one behind it."""
    front = markup.before(markup.after(html, r"cgi-bin/browse-edgar[^\"]*CIK=\d+"), r"\(Street\)")
    tables = F.filter(markup.elements(front, "table"), lambda t: F.contains(t, F.lit("FormData")) & ~F.contains(t, F.lit("(Last)")) & ~F.contains(t, F.lit("(First)")))
    street = F.coalesce(_data(F.try_element_at(tables, F.lit(-1))), F.array().cast("array<string>"))
    place = F.coalesce(F.slice(_data(F.try_element_at(markup.elements(markup.after(html, r"\(Street\)"), "table"), F.lit(1))), 1, 3), F.array().cast("array<string>"))
    return F.nullif(F.array_join(F.filter(F.concat(street, place), lambda x: x != ""), ", "), F.lit(""))


def _checked(rows: Column, row: int, pair: int, label: str) -> Column:
    """Whether the box of a pair (box, text) of a row is checked and its text names the label."""
    r = F.get(rows, row)
    return F.coalesce(F.contains(F.get(r, pair), F.lit("X")) & F.lower(F.get(r, pair + 1)).rlike(label), F.lit(False))


def relationship(html: Column) -> Column:
    """struct<mask, officer_text, other_text>: a grid of boxes, two to a row: director and owner, officer and other, and the words for the latter below."""

    def read(rows: Column) -> Column:
        boxes = [(0, "director", DIRECTOR), (0, r"10%.*owner", OWNER), (1, "officer", OFFICER), (1, "other", OTHER)]
        bit = lambda row, label, value: F.when(_checked(rows, row, 0, label) | _checked(rows, row, 2, label), value).otherwise(0)
        mask = sum((bit(*b) for b in boxes[1:]), bit(*boxes[0]))
        words = lambda at, pair, label: F.when(_checked(rows, 1, pair, label), _filled(F.get(F.get(rows, 2), at)))
        return F.struct(F.when(mask > 0, mask.cast("int")).alias("mask"), words(1, 0, "officer").alias("officer_text"), words(3, 2, "other").alias("other_text"))

    table = F.try_element_at(markup.elements(markup.after(html, r"Relationship of Reporting Person\(s\) to Issuer"), "table"), F.lit(1))
    return markup.let(markup.texts(table), read)


def filing_type(html: Column, literal: bool = False) -> Column:
    """individual or joint/group, by the first checked line; with `literal` any line that says `one reporting person` is individual, also `more than one`."""
    table = F.try_element_at(markup.elements(markup.after(html, "Individual or Joint/Group Filing"), "table"), F.lit(1))
    lines = F.filter(markup.texts(table), lambda r: F.contains(F.get(r, 0), F.lit("X")) & (F.get(r, 1) != ""))

    def read(said: Column) -> Column:
        one, many = F.when(said.rlike("one reporting person|individual"), "individual"), F.when(said.rlike("more than one|joint|group"), "joint/group")
        return F.coalesce(one, many) if literal else F.coalesce(many, one)

    return markup.let(F.lower(F.get(F.get(lines, 0), 1)), read)


def signature(html: Column) -> Column:
    """The signer in lower case: the first underlined `/s/ name`, else the first underlined text; where that refers to an exhibit, the exhibit's signer among remarks, explanations or anywhere."""
    marks = F.transform(F.regexp_extract_all(html, F.lit(_SIGNED), F.lit(1)), markup.text_of)

    def exhibit(part: Column) -> Column:
        name = markup.let(part, lambda p: F.regexp_extract(F.when(p.rlike(r"(?i)Exhibit 99\.1"), p), r"(?i)/?s/\s*([A-Z][A-Za-z\s,.]+?)(?:\s+Date\b|\s+\d{1,2}/\d{1,2}/\d{4}|</|$)", 1))
        return markup.let(name, lambda n: F.when(F.length(F.trim(n)) > 2, F.trim(markup.text_of(n))))

    remarks = markup.before(markup.after(html, "<b>Remarks:</b>"), "</table")
    explained = markup.before(markup.after(html, "Explanation of Responses"), "<b>Remarks:</b>")
    anywhere = F.when(remarks.isNull() & explained.isNull(), html)

    def read(marks: Column) -> Column:
        refers = F.exists(marks, lambda m: F.lower(m).rlike(r"^see exhibit 99\.1 for signatures?$"))
        slash = F.filter(marks, lambda m: m.rlike("(?i)^/?s/"))
        plain = F.filter(marks, lambda m: (m != "") & ~m.rlike("(?i)^/?s/|see exhibit"))
        direct = F.coalesce(_filled(F.regexp_replace(F.get(slash, 0), r"(?i)^/?s/\s*", "")), F.get(plain, 0))
        return F.when(refers, F.coalesce(exhibit(remarks), exhibit(explained), exhibit(anywhere), F.lit("see exhibit 99.1 for signature"))).otherwise(direct)

    return F.lower(markup.let(marks, read))


def read_heads(df: DataFrame, html: str, form: str, accepted: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns in keep, and person, address, event_date, reporting_date, issuer, ticker, relationship, officer_text, other_text, filing_type, signature and amendment_date of each report.

    form is the column with 3, 4 or 5.  Names are in lower case; what a report lacks is null.
    """
    h, f = F.col(html), F.col(form).cast("string")
    person = markup.text_of(F.regexp_extract(h, r"(?i)<a[^>]*href=\"[^\"]*cgi-bin/browse-edgar[^\"]*CIK=\d+[^\"]*\">([^<]+)</a>", 1))
    issuer = markup.text_of(F.regexp_extract(h, r"(?is)Issuer Name[^<]*(?:<(?!a\b)[^>]*>[^<]*){0,6}?<a[^>]*>([^<]+)</a>", 1))
    event = F.coalesce(*[F.when(f == k, labelled_day(h, v)) for k, v in EVENT_LABEL.items()])
    dates = F.filter(F.transform(F.regexp_extract_all(h, F.lit(_SIGNED), F.lit(1)), lambda m: F.trim(m)), lambda m: m.rlike(f"^{_DATE}$"))
    given = F.to_date(F.substring_index(F.trim(F.col(accepted).cast("string")), " ", 1)) if accepted else F.lit(None).cast("date")
    rel = F.col("__rel")
    # Each of these stands in one column, as it is used more than once.
    df = df.select(*keep, F.col(html), F.col(form), *([F.col(accepted)] if accepted else []), relationship(h).alias("__rel"))
    return df.select(
        *keep, F.lower(F.nullif(person, F.lit(""))).alias("person"), address(h).alias("address"), event.alias("event_date"),
        F.coalesce(given, _day(F.get(dates, 0))).alias("reporting_date"), F.lower(F.nullif(issuer, F.lit(""))).alias("issuer"),
        _found(h, r"(?is)\[\s*<span[^>]*class=\"FormData\"[^>]*>([A-Z0-9]+)</span>\s*\]").alias("ticker"),
        rel["mask"].alias("relationship"), rel["officer_text"].alias("officer_text"), rel["other_text"].alias("other_text"),
        filing_type(h).alias("filing_type"), signature(h).alias("signature"), labelled_day(h, "If Amendment, Date of Original Filed").alias("amendment_date"),
    )


# ---------------------------------------------------------------- tables


def explanations(html: Column) -> Column:
    """map<int, string> of the numbered footnotes behind `Explanation of Responses`; of two with one number the last."""
    part = markup.before(markup.after(html, "Explanation of Responses"), "<b>Remarks|</table|</body")
    cells = F.transform(F.regexp_extract_all(part, F.lit(r"(?is)<td[^>]*class=\"[^\"]*FootnoteData[^\"]*\"[^>]*>\s*(\d+\.\s+.*?)</td>"), F.lit(1)), markup.text_of)
    notes = F.transform(cells, lambda c: F.struct(F.regexp_extract(c, r"^(\d+)\.", 1).try_cast("int").alias("n"), F.regexp_extract(c, r"(?s)^\d+\.\s+(.*)$", 1).alias("t")))
    notes = F.filter(F.coalesce(notes, F.array().cast("array<struct<n:int,t:string>>")), lambda x: x["n"].isNotNull() & (x["t"] != ""))
    return F.map_from_entries(markup.last_of(notes, "n"))


def _rows(html: Column, which: str) -> Column:
    """Raw rows of all bodies between a table's title and the next one."""
    two = r"Table\s+II\b"
    part = markup.before(markup.after(markup.before(html, two), r"Table\s+I\b"), "Explanation of Responses") if which == "I" else markup.before(markup.after(html, two), "Explanation of Responses")
    return F.flatten(F.transform(markup.elements(part, "tbody"), markup.grid))


def read_table(df: DataFrame, html: str, form: str, which: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of table "I" (non-derivative) or "II" (derivative): the columns in keep, n from 0, and the table's columns.

    A cell is struct<value, footnote<number, explanation>>; codes are plain texts with
    their meanings beside them.  Columns that a form does not have are null, as are
    cells that a row lacks.  In table II `shares` is the acquired amount or less the
    disposed one, and rows of form 3 without a title go.
    """
    kind = F.when(F.col(form).cast("string") == "3", "3").otherwise("4")
    layout = NON_DERIVATIVE if which == "I" else DERIVATIVE
    src = df.select(*keep, kind.alias("__kind"), explanations(F.col(html)).alias("__notes"), _rows(F.col(html), which).alias("__rows"))
    src = src.select(*keep, "__kind", "__notes", F.posexplode("__rows").alias("__at", "__row"))
    least = F.when(F.col("__kind") == "3", LEAST_CELLS[which, "3"]).otherwise(LEAST_CELLS[which, "4"])
    src = src.filter(F.size("__row") >= least)

    def cell(name: str) -> Column:
        at = [F.when(F.col("__kind") == k, F.get("__row", names.index(name))) for k, names in layout.items() if name in names]
        raw = F.coalesce(*at)
        return F.when(raw.isNotNull(), markup.noted_cell(raw, F.col("__notes")))

    names = list(dict.fromkeys(n for k in ("4", "3") for n in layout[k]))
    read = src.select(*keep, "__at", "__kind", *[cell(n).alias(f"__{n}") for n in names])
    if which == "II":
        read = read.filter((F.col("__kind") != "3") | (F.col("__security.value") != ""))
    plain = {"code", "direction", "ownership", "acquired", "disposed"}
    out = [F.col(f"__{n}").alias(n) for n in names if n not in plain]
    value = lambda n: F.col(f"__{n}.value")
    code = value("code")
    out += [code.alias("code"), _meaning(code, CODES, F.concat(F.lit("Transaction code "), code, F.lit(" (meaning not specified)"))).alias("code_text")]
    if which == "II":
        amount = lambda n: F.replace(_filled(value(n)), F.lit(","), F.lit("")).try_cast("double")
        acquired = _filled(value("acquired")).isNotNull()
        direction = F.when(acquired, F.when(amount("acquired").isNotNull(), "A")).when(amount("disposed").isNotNull(), "D")
        out.append(F.when(acquired, amount("acquired")).otherwise(-amount("disposed")).alias("shares"))
    else:
        direction = value("direction")
    out += [direction.alias("direction"), _meaning(direction, DIRECTION, direction).alias("direction_text"), value("ownership").alias("ownership"), _meaning(value("ownership"), OWNERSHIP, value("ownership")).alias("ownership_text")]
    return read.select(*keep, F.col("__at").alias("n"), *out)
