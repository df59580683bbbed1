"""Trade reports, insider forms and tables in markup, by hand-made documents."""

from __future__ import annotations

import datetime
import html
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import markup
from millrace.sources import bill_status, insider_forms, readers, trade_reports

HEAD = "ID OwnerAsset Transaction Type Date Notification DateAmount Cap. Gains > $200?\n"
SIGNED = "Digitally Signed: Hon. Jane Doe , 03/09/2024\n"
D = datetime.date
#: (report, trades as (n, owner, asset, symbol, code, kind, traded, filed, min, max, exact, metadata))
REPORTS = {
    "one line": (HEAD + "SP Acme Corp (ACM) [ST] P 01/02/2024 01/05/2024 $1,001 - $15,000\nF S: New\n" + SIGNED, [(0, "SP", "Acme Corp", "ACM", "ST", "Purchase", D(2024, 1, 2), D(2024, 1, 5), 1001, 15000, None, "F S: New\n" + SIGNED.strip())]),
    "no name but the symbol": ("SP (ACM) [ST] P 01/02/2024 01/05/2024 $1,001 - $15,000\nF S: x", [(0, "SP", None, "ACM", "ST", "Purchase", D(2024, 1, 2), D(2024, 1, 5), 1001, 15000, None, "F S: x")]),
    "owner and name above": (HEAD + "JT Beta (BET)\n[OP]S (partial) 02/03/2024 02/05/2024 $500\nD: calls\n", [(0, "JT", "Beta", "BET", "OP", "Sale", D(2024, 2, 3), D(2024, 2, 5), 0, 1000, 500, "D: calls")]),
    "a line that names no asset stays out": ("Beta Fund\nJT Beta (BET)\n[OP]S 02/03/2024 02/05/2024 $500\nD: c\n", [(0, "JT", "Beta", "BET", "OP", "Sale", D(2024, 2, 3), D(2024, 2, 5), 0, 1000, 500, "D: c")]),
    "filed by the signature": ("Gamma Inc [GS] E 03/04/2024 $50,001 - $100,000\nF S: New\n" + SIGNED, [(0, None, "Gamma Inc", None, "GS", "Exercise", D(2024, 3, 4), D(2024, 3, 9), 50001, 100000, None, "F S: New\n" + SIGNED.strip())]),
    "filed by the last date": ("Gamma Inc [GS] P 03/04/2024 $50,001 - $100,000\nF S: New\nseen 04/05/2024\nclosed 6/7/2024", [(0, None, "Gamma Inc", None, "GS", "Purchase", D(2024, 3, 4), D(2024, 6, 7), 50001, 100000, None, "F S: New\nseen 04/05/2024\nclosed 6/7/2024")]),
    "amount on the next line": ("SP Acme [ST] S 01/02/2024 01/05/2024 $100,001 -\n$250,000\nF S: New", [(0, "SP", "Acme", None, "ST", "Sale", D(2024, 1, 2), D(2024, 1, 5), 100001, 250000, None, "$250,000\nF S: New")]),
    "falling range is exact": ("SP Acme [ST] S 01/02/2024 01/05/2024 $15,000 - $1,001\nF S: New", [(0, "SP", "Acme", None, "ST", "Sale", D(2024, 1, 2), D(2024, 1, 5), 1001, 15000, 15000, "F S: New")]),
    "the last range is open": ("SP Acme [ST] S 01/02/2024 01/05/2024 $60,000,000\nF S: New", [(0, "SP", "Acme", None, "ST", "Sale", D(2024, 1, 2), D(2024, 1, 5), 50000001, None, 60000000, "F S: New")]),
    "to and through": ("SP Acme [ST] S 01/02/2024 01/05/2024 $1,001 to $15,000\nF S: New\nSP Beta [ST] P 01/02/2024 01/05/2024 $1,001 through $15,000\nF S: x", [(0, "SP", "Acme", None, "ST", "Sale", D(2024, 1, 2), D(2024, 1, 5), 1001, 15000, None, "F S: New"), (1, "SP", "Beta", None, "ST", "Purchase", D(2024, 1, 2), D(2024, 1, 5), 1001, 15000, None, "F S: x")]),
    "another kind keeps its letter": ("SP Acme [ST] G 01/02/2024 01/05/2024 $1,001 - $15,000\nF S: New", [(0, "SP", "Acme", None, "ST", "G", D(2024, 1, 2), D(2024, 1, 5), 1001, 15000, None, "F S: New")]),
    "headers inside go": ("SP Acme [ST] P 01/02/2024 01/05/2024 $1,001 - $15,000\n" + HEAD + "S O: Trust\n" + HEAD + "JT Beta [ST] P 01/02/2024 01/05/2024 $1,001 - $15,000", [(0, "SP", "Acme", None, "ST", "Purchase", D(2024, 1, 2), D(2024, 1, 5), 1001, 15000, None, "S O: Trust"), (1, "JT", "Beta", None, "ST", "Purchase", D(2024, 1, 2), D(2024, 1, 5), 1001, 15000, None, None)]),
    "name over three lines": ("SP First Part\nSecond Company\nThird (TRD)\n[ST] P 01/02/2024 01/05/2024 $1,001 - $15,000\nF S: n", [(0, "SP", "First Part Second Company Third", "TRD", "ST", "Purchase", D(2024, 1, 2), D(2024, 1, 5), 1001, 15000, None, "F S: n")]),
    "lines of an earlier trade are not an asset": ("SP Acme Corp\n(ABC) [ST] P 01/02/2024 01/05/2024 $1,001 - $15,000\nF S: New\nJT Big [OP] S 02/03/2024 02/04/2024 $500\nS O: x", [(0, "SP", "Acme Corp", "ABC", "ST", "Purchase", D(2024, 1, 2), D(2024, 1, 5), 1001, 15000, None, "F S: New"), (1, "JT", "Big", None, "OP", "Sale", D(2024, 2, 3), D(2024, 2, 4), 0, 1000, 500, "S O: x")]),
    "without a date": ("SP Acme [ST] P $1,001 - $15,000\nF S: New", []),
    "an impossible date": ("SP Acme [ST] P 13/45/2024 01/05/2024 $1,001 - $15,000\nF S: New", []),
    "without an amount": ("SP Acme [ST] P 01/02/2024 01/05/2024\nF S: New", []),
    "without a name": ("[ST] P 01/02/2024 01/05/2024 $1,001 - $15,000", []),
    "without a kind": ("SP Acme [ST] 01/02/2024 01/05/2024 $1,001 - $15,000", []),
    "a gap in n": ("SP Acme [ST] P $1,001\nF S: New\nJT Beta [ST] P 01/02/2024 01/05/2024 $1,001 - $15,000", [(1, "JT", "Beta", None, "ST", "Purchase", D(2024, 1, 2), D(2024, 1, 5), 1001, 15000, None, None)]),
    "no trades": ("Just a letter of 01/02/2024 about $500.", []),
    "empty": ("", []),
    "null": (None, []),
}


def test_trade_reports(spark):
    df = spark.createDataFrame([(k, text, 1) for k, (text, _) in REPORTS.items()], "k string, text string, n int")
    got: dict = {k: [] for k in REPORTS}
    for r in trade_reports.trade_reports(df, "k", "text").orderBy("id", "n").collect():
        got[r["id"]].append((r["n"], r["owner"], r["asset"], r["symbol"], r["code"], r["kind_name"], r["traded"], r["filed"], r["amount_min"], r["amount_max"], r["exact_amount"], r["metadata"]))
    for k, (_, want) in REPORTS.items():
        assert got[k] == want, k


@pytest.mark.parametrize(("text", "name"), [("Name: Hon. Jane Q. Doe Status: Member", "Jane Q. Doe"), ("Name:  Jane Doe\n", "Jane Doe"), ("by Hon. Jane Doe, 2024", "Jane Doe"), ("The Honorable John A. Roe", "John A. Roe"), ("nobody", None)])
def test_filer(spark, text, name):
    assert spark.range(1).select(trade_reports.filer(F.lit(text)).alias("x")).first()["x"] == name


def test_entities_as_the_standard_library_decodes_them(spark):
    rnd = random.Random(5)
    texts = ["", "&", "&;", "&&amp;&", "a & b", "&#x110000;&#0;&#xD800;", "&#65;&#x41;&#X1F600;", "&nope;", "&lt&gt", None]
    texts += ["".join(rnd.choice(["&amp;", "&lt;", "&eacute;", "&#8364;", "&Omega;", "&apos;", "x", " ", "&", ";", "#", "é", "😀"]) for _ in range(rnd.randrange(30))) for _ in range(150)]
    got = [r["x"] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(markup.decode_entities("t").alias("x")).collect()]
    for t, x in zip(texts, got, strict=True):
        if t is None or t == "&lt&gt":  # without their semicolons they stay
            assert x == t
        elif t == "&#x110000;&#0;&#xD800;":
            assert x == "�" * 3
        else:
            assert x == html.unescape(t), t


def test_tables(spark):
    two = "<table><tbody><tr><td>a &amp; b</td></tr></tbody><tbody><tr><td>c</td><td> <i>d</i>\n e</tr></tbody></table>"
    df = spark.createDataFrame([(1, two), (2, "<table><tr><th>A b</th><th>C</th></tr><tr><td>1</td></tr></table>"), (3, "no table"), (4, None), (5, "<td>" * 20_000)], "k int, h string")
    got = {r["k"]: r for r in df.select("k", readers.html_rows(F.col("h")).alias("rows"), markup.by_header(markup.table_with("h", "a b"), {"c": "^c$", "a": "a", "x": "none"}).alias("t")).collect()}
    assert got[1]["rows"] == [["a & b"], ["c", "d e"]] and got[2]["rows"] == [["A b", "C"], ["1"]]
    assert [tuple(r) for r in got[2]["t"]] == [("", "1", None)] and got[1]["t"] is None
    assert got[3]["rows"] == got[5]["rows"] == [] and not got[4]["rows"]


def test_insider_heads_of_odd_pages(spark):
    rows = [(1, "4", None), (2, "4", ""), (3, "9", "<table>" * 500), (4, "3", '<u><span class="FormData">Plain Name</span></u>'), (5, "5", '<u><span class="FormData">s/ Short Form</span></u><u><span class="FormData">1/2/2024</span></u>')]
    rows += [(6, "4", 'Relationship of Reporting Person(s) to Issuer <table><tr><td>X</td><td>Director</td></tr></table> Individual or Joint/Group Filing <table><tr><td>X</td><td>Form filed by More than One Reporting Person</td></tr></table>')]
    rows += [(7, "4", '<u><span class="FormData">See Exhibit 99.1 for Signatures</span></u>Explanation of Responses: Exhibit 99.1 s/ Ann Agent</td><b>Remarks:</b> none</table>')]
    df = spark.createDataFrame(rows, "k int, form string, html string")
    got = {r["k"]: r for r in insider_forms.read_heads(df, "html", "form", keep=("k",)).collect()}
    assert all(got[1][c] is None and got[2][c] is None and got[3][c] is None for c in got[1].asDict() if c != "k")
    assert got[4]["signature"] == "plain name" and got[5]["signature"] == "short form" and got[5]["reporting_date"] == D(2024, 1, 2)
    assert got[6]["relationship"] == 1 and got[6]["filing_type"] == "joint/group" and got[7]["signature"] == "ann agent"
    literal = df.filter("k = 6").select(insider_forms.filing_type(F.col("html"), literal=True).alias("f")).first()["f"]
    assert literal == "individual"
    given = df.withColumn("accepted", F.lit("2024-05-06 10:11:12"))
    assert insider_forms.read_heads(given, "html", "form", "accepted", ("k",)).filter("k = 5").first()["reporting_date"] == D(2024, 5, 6)


def test_insider_tables_of_odd_pages(spark):
    ok = "<tr>" + "".join(f"<td>{x}</td>" for x in ("A<sup>(2)</sup>", "1", "D", "")) + "</tr>"
    page = f"Table I <tbody>{ok}<tr><td>short</td></tr></tbody><tbody>{ok}</tbody> Table II <tbody></tbody> Explanation of Responses</td></tr><tr><td class=\"FootnoteData\">2. first</td></tr><tr><td class=\"FootnoteData\">2. last</td></tr></table>"
    df = spark.createDataFrame([(1, "3", page), (2, "3", None), (3, "3", ""), (4, "3", "Table II <tbody>" + ok + "</tbody>")], "k int, form string, html string")
    got = insider_forms.read_table(df, "html", "form", "I", ("k",)).orderBy("k", "n").collect()
    assert [(r["k"], r["n"], r["security"]["value"], r["security"]["footnote"]["explanation"]) for r in got] == [(1, 0, "A", "last"), (1, 2, "A", "last")]
    assert insider_forms.read_table(df, "html", "form", "II", ("k",)).count() == 0


def bill(inner: str, ns: str = "") -> str:
    return f"<?xml version='1.0'?><billStatus {ns}><bill><congress>118</congress><type>S</type><number>7</number>{inner}</bill></billStatus>"


BILLS = {
    "plain": bill("<title> T </title><introducedDate>2024-03-01</introducedDate>"),
    "prefixed": bill("<x:title>P</x:title>", 'xmlns:x="http://x/" xmlns="http://y/"'),
    "late": bill("<introducedDate>2025-03-01</introducedDate>"),
    "undated": bill("<introducedDate>soon</introducedDate>"),
    "empty parts": bill("<titles/><actions><item></item><item><text> </text></item></actions><laws><item><number></number></item></laws>"),
    "twice": bill("<actions><item><actionDate>d</actionDate><text>a</text><recordedVotes><recordedVote><rollNumber>1</rollNumber></recordedVote></recordedVotes></item><item><text>a</text></item><item><actionDate>d</actionDate><text> a </text><recordedVotes><recordedVote><rollNumber>2</rollNumber></recordedVote><recordedVote><rollNumber>1</rollNumber></recordedVote></recordedVotes></item></actions>"),
    "one sponsor's name": bill("<sponsors><item><bioguideId>b1</bioguideId><fullName>Full Name</fullName></item></sponsors><amendments><amendment><number>3</number><congress>117</congress><sponsors><name>Solo</name></sponsors><actions><count>4</count></actions></amendment></amendments>"),
    "no xml": "<billStatus><bill><title>cut",
    "no bill": "<other/>",
    "nothing": None,
}


def test_bill_status(spark):
    df = spark.createDataFrame([(k, x, "mine") for k, x in BILLS.items()], "k string, xml string, b string")
    got = {r["k"]: r for r in bill_status.parse_bills(df, dated=("2024-01-01", "2024-12-31"), keep=("k",)).collect()}
    assert set(got) == set(BILLS) - {"late"}
    assert got["plain"]["title"] == "T" and got["plain"]["bill_id"] == "118-S-7" and got["plain"]["introduced"] == D(2024, 3, 1)
    assert got["prefixed"]["title"] == "P" and got["undated"]["introduced"] is None
    assert all(got["empty parts"][c] is None for c in ("titles", "actions", "laws", "summaries", "committees"))
    acts = got["twice"]["actions"]
    assert [(a["actionDate"], a["text"], [v["rollNumber"] for v in a["recordedVotes"]]) for a in acts] == [("d", "a", ["1", "2", "1"]), (None, "a", [])]
    assert [v["rollNumber"] for v in got["twice"]["recorded_votes"]] == ["1", "2"]
    one = got["one sponsor's name"]
    assert one["sponsors"][0]["bioguideId"] == "B1" and one["sponsors"][0]["fullName"] == "Full Name"
    assert (one["amendments"][0]["congress"], one["amendments"][0]["sponsors"], one["amendments"][0]["actionsCount"]) == (117, ["Solo"], 4)
    for k in ("no bill", "nothing"):
        assert got[k]["title"] is None and got[k]["actions"] is None and got[k]["congress"] is None


def test_table_trades_of_odd_pages(spark):
    row = lambda *cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    ok = row("1", "01/02/2024", "Self", "ABC", "Acme <div class=\"text-muted\"><em>A:</em> x<br><em>A:</em> y</div>", "Stock", "buy", "$1,001 - $15,000", "note")
    page = lambda rows: f"<h2 class='filedReport'>Ann Roe</h2><table class='other'></table><table class=\"table x\"><tbody>{rows}</tbody></table>"
    rows = [("ok", page(ok)), ("short", page(row(*"abcdef"))), ("no amount", page(row("01/02/2024", "Self", "--", "Acme", "Stock", "sell", "--", ""))), ("falls", page(row("01/02/2024", "Self", "--", "Acme", "Stock", "given", "$15,000 - $1,001"))), ("no table", "<table><tbody>" + ok), ("null", None), ("empty", "")]
    got = {r["id"]: r for r in trade_reports.table_trades(spark.createDataFrame(rows, "k string, h string"), "k", "h").collect()}
    assert set(got) == {"ok", "falls"}
    a, b = got["ok"], got["falls"]
    assert (a["filer"], a["traded"], a["symbol"], a["asset"], a["code"], a["amount_min"], a["exact_amount"], a["comment"], a["metadata"]) == ("Ann Roe", D(2024, 1, 2), "ABC", "Acme", "P", 1001, None, "note", {"A": "y"})
    assert (b["symbol"], b["code"], b["amount_min"], b["exact_amount"], b["comment"], b["metadata"]) == (None, "G", 1001, 15000, "", None)
