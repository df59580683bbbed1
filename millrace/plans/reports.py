"""Disclosure reports: trades in texts, heads and tables of insider forms, tables in markup.

On the fixture tables a customer files a report whose parts differ by its key, and its
orders are the trades and the rows of the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from ..session import spread, table
from ..sources import bill_status, insider_forms, trade_reports
from .registry import query


def _t(*parts) -> Column:
    """Text from literals and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _day(c: str, plus: int = 0) -> Column:
    return F.date_format(F.date_add(F.col(c), plus), "MM/dd/yyyy")


# ---------------------------------------------------------------- trades in texts

#: A report's trades by o_orderkey % 4: on one line, with the asset's name before it, with a partial sale and one date, with the amount on the next line.
TRADES = """
SELECT o_custkey AS id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS n, 'Ann B. Filer' AS filer,
  CASE o_orderkey % 4 WHEN 1 THEN 'SP' WHEN 2 THEN 'JT' END AS owner,
  CASE o_orderkey % 4 WHEN 0 THEN 'Acme Corporation Common Stock' WHEN 2 THEN 'Beta' ELSE 'Acme Corp' END AS asset,
  CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE 'ABC' END AS symbol,
  CASE o_orderkey % 4 WHEN 2 THEN 'OP' WHEN 3 THEN 'GS' ELSE 'ST' END AS code,
  CASE o_orderkey % 4 WHEN 2 THEN 'Sale' WHEN 3 THEN 'Exercise' ELSE 'Purchase' END AS kind_name,
  CAST(o_orderdate AS DATE) AS traded,
  CASE WHEN o_orderkey % 4 = 2 THEN DATE '2031-05-04' ELSE CAST(o_orderdate AS DATE) + 3 END AS filed,
  CAST(CASE o_orderkey % 4 WHEN 0 THEN 1001 WHEN 1 THEN 15001 WHEN 2 THEN 0 ELSE 50001 END AS BIGINT) AS amount_min,
  CAST(CASE o_orderkey % 4 WHEN 0 THEN 15000 WHEN 1 THEN 50000 WHEN 2 THEN 1000 ELSE 100000 END AS BIGINT) AS amount_max,
  CAST(CASE WHEN o_orderkey % 4 = 2 THEN 500 END AS BIGINT) AS exact_amount
FROM orders
"""


def _trade_text() -> Column:
    k = F.col("o_orderkey") % 4
    one = _t("Acme Corporation\nCommon Stock (ABC) [ST] P ", _day("o_orderdate"), " ", _day("o_orderdate", 3), " $1,001 - $15,000\nF S: New\nS O: Trust\n")
    two = _t("SP Acme Corp (ABC)\n[ST]P ", _day("o_orderdate"), " ", _day("o_orderdate", 3), " $15,001 - $50,000\nF S: New\nBeta Fund\n")
    three = _t("JT Beta (ABC) [OP]S (partial) ", _day("o_orderdate"), " $500\nD: ", F.col("o_orderkey"), " calls\n")
    four = _t("Acme Corp [GS] E ", _day("o_orderdate"), " ", _day("o_orderdate", 3), " $50,001 -\n$100,000\nF S: New\n")
    return F.when(k == 0, one).when(k == 1, two).when(k == 2, three).otherwise(four)


@query(TRADES)
def src_trade_reports(spark, sf_dir):
    """Whole reports of several trades, whose lines, owners, dates and amounts differ."""
    o = spread(table(spark, sf_dir, "orders"), "o_custkey").select("o_custkey", "o_orderkey", F.array_join(F.array(_trade_text()), "").alias("part"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "part"))), lambda x: x["part"]), "")
    head = "Periodic Report\nName: Hon. Ann B. Filer Status: Member\nID OwnerAsset Transaction Type Date Notification DateAmount Cap. Gains > $200?\n"
    r = o.groupBy("o_custkey").agg(text.alias("part")).select("o_custkey", _t(head, F.col("part"), "Digitally Signed: Hon. Ann B. Filer , 05/04/2031\n").alias("text"))
    out = trade_reports.trade_reports(r, "o_custkey", "text")
    return out.select("id", "n", "filer", "owner", "asset", "symbol", "code", "kind_name", "traded", "filed", "amount_min", "amount_max", "exact_amount")


TABLED = """
SELECT o_custkey AS id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS n, 'Ann B. Filer' AS filer, o_orderkey % 6 AS shape,
  CASE WHEN o_orderkey % 6 <> 3 THEN CAST(o_orderdate AS DATE) END AS traded, CASE WHEN o_orderkey % 2 = 0 THEN 'Self' ELSE 'Spouse' END AS owner, CASE WHEN o_orderkey % 3 > 0 THEN 'T' || o_orderkey % 90 END AS symbol,
  'Acme & ' || o_orderkey AS asset, CASE o_orderkey % 4 WHEN 0 THEN 'Purchase' WHEN 1 THEN 'Sale' WHEN 2 THEN 'Exchange' ELSE 'Sale (Full)' END AS kind, CASE o_orderkey % 4 WHEN 0 THEN 'P' WHEN 2 THEN 'E' ELSE 'S' END AS code,
  CAST(CASE o_orderkey % 6 WHEN 1 THEN 50000001 WHEN 2 THEN 0 ELSE 15001 END AS BIGINT) AS amount_min, CAST(CASE o_orderkey % 6 WHEN 1 THEN NULL WHEN 2 THEN 1000 ELSE 50000 END AS BIGINT) AS amount_max,
  CAST(CASE o_orderkey % 6 WHEN 1 THEN 50000001 WHEN 2 THEN 700 END AS BIGINT) AS exact_amount, CASE WHEN o_orderkey % 5 = 0 THEN '3.5% / ' || o_orderkey END AS rate
FROM orders
"""


@query(f"SELECT * EXCLUDE (shape) FROM ({TABLED}) WHERE shape < 4")
def src_table_trades(spark, sf_dir):
    """Trades in the tables of reports: with and without row numbers, small print under the asset, ranges and single amounts; rows without kind or amount go."""
    k, shape = F.col("o_orderkey"), F.col("o_orderkey") % 6
    cells = [
        F.when(shape == 3, "soon").otherwise(_day("o_orderdate")), F.when(k % 2 == 0, "Self").otherwise("Spouse"), F.when(k % 3 > 0, _t('<a href="x">T', k % 90, "</a>")).otherwise("--"),
        _t(" Acme &amp;\n", k, F.when(k % 5 == 0, _t('<div class="text-muted"><em>Rate/Coupon:</em> 3.5% <br> <em>Matures:</em> ', k, "</div>")).otherwise("")),
        F.lit("Stock"), F.when(shape == 4, "").when(k % 4 == 0, "Purchase").when(k % 4 == 1, "Sale").when(k % 4 == 2, "Exchange").otherwise("Sale (Full)"),
        F.when(shape == 1, "Over $50,000,001").when(shape == 2, "$700").when(shape == 5, "--").otherwise("$15,001 - $50,000"), F.lit("--"),
    ]
    row = _t("<tr>", F.when(F.col("o_custkey") % 2 == 0, _t("<td>", k, "</td>")).otherwise(""), *[_t("<td>", c, "</td>") for c in cells], "</tr>")
    o = spread(table(spark, sf_dir, "orders"), "o_custkey").select("o_custkey", F.struct(k.alias("k"), row.alias("row")).alias("r")).groupBy("o_custkey").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    page = o.select("o_custkey", _t('<h2 class="filedReport">The Honorable Ann B. Filer (Filer, Ann)</h2><table class="table table-striped"><thead><tr><th>#</th></tr></thead><tbody>', F.array_join(F.transform("rs", lambda r: r["row"]), ""), "</tbody></table>").alias("html"))
    t = trade_reports.table_trades(page, "o_custkey", "html")
    rate = F.concat_ws(" / ", F.try_element_at("metadata", F.lit("Rate/Coupon")), F.try_element_at("metadata", F.lit("Matures")))
    return t.select("id", "n", "filer", "traded", "owner", "symbol", "asset", "kind", "code", "amount_min", "amount_max", "exact_amount", F.when(F.col("metadata").isNotNull(), rate).alias("rate"))


# ---------------------------------------------------------------- insider forms


def _span(c) -> Column:
    return _t('<span class="FormData">', c, "</span>")


def _forms(spark, sf_dir) -> DataFrame:
    """Forms 3, 4 and 5 of customers; what a form holds differs by the customer's key."""
    c = spread(table(spark, sf_dir, "customer"), "c_custkey").select("c_custkey", "c_name", (F.col("c_custkey") % 3 + 3).cast("string").alias("form"))
    k, form = F.col("c_custkey"), F.col("form")
    row = lambda *cells: _t("<tr>", *[_t("<td>", x, "</td>") if isinstance(x, str) else F.concat(F.lit("<td>"), x.cast("string"), F.lit("</td>")) for x in cells], "</tr>")
    box = lambda bit: F.when(k.bitwiseAND(F.lit(bit)) != 0, _span("X")).otherwise(F.lit(""))
    label = F.when(form == "3", "2. Date of Event Requiring Statement").when(form == "4", "3. Date of Earliest Transaction").otherwise("3. Statement for Issuer's Fiscal Year Ended")
    person = _t('<table><tr><td><a href="/cgi-bin/browse-edgar?action=getcompany&amp;CIK=0', k, '">', F.col("c_name"), " &amp; Sons</a></td></tr><tr><td>(Last)</td><td>(First)</td></tr></table>")
    street = _t('<table border="0" width="100%">', row(_span(_t(k, " Main St"))), F.when(k % 2 == 0, row(_span(_t("Suite ", k % 50)))).otherwise(""), '</table><hr><span class="MedSmallFormText">(Street)</span>')
    place = _t('<table border="0" width="100%">', row(_span("Springfield"), _span(F.when(k % 5 == 0, "").otherwise("IL")), _span(F.lpad(k.cast("string"), 5, "0"))), "</table><hr>(City)")
    dates = _t('<span class="MedSmallFormText">', label, ' (Month/Day/Year)</span><br><span class="FormData">', F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int")), "MM/dd/yyyy"), "</span>", F.when(k % 4 == 1, _t('<span>4. If Amendment, Date of Original Filed (Month/Day/Year)</span><br><span class="FormData">2/3/2023</span>')).otherwise(""))
    issuer = _t("<span>3. Issuer Name <b>and</b> Ticker or Trading Symbol</span><br><a href='x'>Big &#38; Co&#8482;</a> [ ", _span(_t("T", k % 90)), " ]")
    grid = _t("<span>5. Relationship of Reporting Person(s) to Issuer</span><br>(Check all applicable)<table>", row(box(1), "Director", box(4), "10% Owner"), row(box(2), "Officer (give title below)", box(8), "Other (specify below)"), row("", _t("<b>President &amp; CEO</b>"), "", _t("Trustee ", k)), "</table>")
    filed = _t("6. Individual or Joint/Group Filing (Check Applicable Line)<table>", row(F.when(k % 2 == 0, _span("X")).otherwise(""), "Form filed by One Reporting Person"), row(F.when(k % 2 == 1, _span("X")).otherwise(""), "Form filed by More than One Reporting Person"), "</table>")
    signer = F.when(k % 4 == 0, _t("/s/ ", F.col("c_name"))).when(k % 4 == 1, F.col("c_name")).otherwise("See Exhibit 99.1 for Signature")
    remarks = F.when(k % 4 == 2, _t("<table><tr><td><b>Remarks:</b></td></tr><tr><td>Exhibit 99.1 (Signature) /s/ Jane Agent 01/05/2024</td></tr></table>")).otherwise("")
    head = _t(person, street, place, dates, issuer, grid, filed)
    foot = _t("<table><tr><td>Explanation of Responses:</td></tr><tr><td class='x'></td></tr><tr><td class=\"FootnoteData\">1. Held by a <i>trust</i> &amp; others.</td></tr><tr><td class=\"FootnoteData\">2. Price of ", k, "</td></tr></table>", remarks, "** Signature of Reporting Person <u>", _span(signer), "</u><u>", _span("01/09/2024"), "</u>")
    rows = spread(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"), "c_custkey")
    note = F.when(F.col("o_orderkey") % 2 == 0, "<sup>(1)</sup>").otherwise("")
    code = F.when(F.col("o_orderkey") % 3 == 0, "P").when(F.col("o_orderkey") % 3 == 1, "S").otherwise("Q")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    name = _t(" <b>", F.col("o_orderpriority"), "</b>&nbsp;&lt;", F.col("o_orderkey"), "&gt; ")
    one3 = row(_t(name, note), price, "D", "")
    one4 = row(_t(name, note), _day("o_orderdate"), "", code, "", _t(price, note), F.when(F.col("o_orderkey") % 3 == 0, "A").otherwise("D"), _t("$10.5<sup>(9)</sup>"), "100", "I", "By &#233;state")
    two3 = row(name, _day("o_orderdate"), "", "Common", "10", "$1", F.lit("D"), "")
    two4 = row(name, "$5", _day("o_orderdate"), "", code, "", F.when(F.col("o_orderkey") % 2 == 0, F.format_number(price, 2)).otherwise(""), F.when(F.col("o_orderkey") % 2 == 1, F.format_number(price, 2)).otherwise(""), "", "", "Common", "10", "$1", "5", "I", "")
    lists = rows.select("c_custkey", F.struct("o_orderkey", one3.alias("one3"), one4.alias("one4"), two3.alias("two3"), two4.alias("two4")).alias("r")).groupBy("c_custkey").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    joined = c.join(lists, "c_custkey", "left")
    pick = lambda a, b: F.coalesce(F.array_join(F.transform("rs", lambda r: F.when(F.col("form") == "3", r[a]).otherwise(r[b])), ""), F.lit(""))
    tables = _t("<table><thead><tr><th>Table I - Non-Derivative Securities</th></tr></thead><tbody>", pick("one3", "one4"), "</tbody></table><table><thead><tr><th>Table II - Derivative Securities</th></tr></thead><tbody>", pick("two3", "two4"), "</tbody></table>")
    return joined.select("c_custkey", "form", _t("<html><body>", head, tables, foot, "</body></html>").alias("html"))


@query("""
SELECT c_custkey, lower(c_name) || ' & sons' AS person,
  concat_ws(', ', c_custkey || ' Main St', CASE WHEN c_custkey % 2 = 0 THEN 'Suite ' || c_custkey % 50 END, 'Springfield', CASE WHEN c_custkey % 5 > 0 THEN 'IL' END, lpad(CAST(c_custkey AS VARCHAR), 5, '0')) AS address,
  DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER) AS event_date, DATE '2024-01-09' AS reporting_date, 'big & co™' AS issuer, 'T' || c_custkey % 90 AS ticker,
  CAST(nullif(c_custkey % 16, 0) AS INTEGER) AS relationship, CASE WHEN c_custkey & 2 > 0 THEN 'President & CEO' END AS officer_text, CASE WHEN c_custkey & 8 > 0 THEN 'Trustee ' || c_custkey END AS other_text,
  CASE WHEN c_custkey % 2 = 0 THEN 'individual' ELSE 'joint/group' END AS filing_type,
  CASE c_custkey % 4 WHEN 2 THEN 'jane agent' WHEN 3 THEN 'see exhibit 99.1 for signature' ELSE lower(c_name) END AS signature,
  CASE WHEN c_custkey % 4 = 1 THEN DATE '2023-02-03' END AS amendment_date
FROM customer
""")
def src_insider_heads(spark, sf_dir):
    """Address, box grid, dates by form, signer and exhibit of forms that differ by row."""
    return insider_forms.read_heads(_forms(spark, sf_dir), "html", "form", keep=("c_custkey",))


def _note(n: str, text: str) -> str:
    return f"CAST({n} AS INTEGER) AS note, {text} AS explanation"


@query(f"""
SELECT c_custkey, CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS n, o_orderpriority || ' <' || o_orderkey || '>' AS security,
  {_note("CASE WHEN o_orderkey % 2 = 0 THEN 1 END", "CASE WHEN o_orderkey % 2 = 0 THEN 'Held by a trust & others.' END")},
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS shares, CASE WHEN c_custkey % 3 > 0 THEN CASE o_orderkey % 3 WHEN 0 THEN 'P' WHEN 1 THEN 'S' ELSE 'Q' END END AS code,
  CASE WHEN c_custkey % 3 > 0 THEN CASE o_orderkey % 3 WHEN 0 THEN 'Open market or private purchase of non-derivative or derivative security' WHEN 1 THEN 'Open market or private sale of non-derivative or derivative security' ELSE 'Transaction code Q (meaning not specified)' END END AS code_text,
  CASE WHEN c_custkey % 3 > 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'Acquired' ELSE 'Disposed' END END AS direction_text, CASE WHEN c_custkey % 3 > 0 THEN '$10.5' END AS price, CASE WHEN c_custkey % 3 > 0 THEN '' END AS price_note,
  CASE WHEN c_custkey % 3 > 0 THEN 'Indirect' ELSE 'Direct' END AS ownership_text, CASE WHEN c_custkey % 3 > 0 THEN 'By éstate' ELSE '' END AS nature
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def src_insider_table_i(spark, sf_dir):
    """Rows of table I with footnotes in two columns; a footnote without a text is empty."""
    t = insider_forms.read_table(_forms(spark, sf_dir), "html", "form", "I", ("c_custkey",))
    cols = ["c_custkey", "n", F.col("security.value").alias("security"), F.col("security.footnote.number").alias("note"), F.col("security.footnote.explanation").alias("explanation"), F.col("shares.value").alias("shares")]
    return t.select(*cols, "code", "code_text", "direction_text", F.col("price.value").alias("price"), F.col("price.footnote.explanation").alias("price_note"), "ownership_text", F.col("nature.value").alias("nature"))


@query("""
SELECT c_custkey, CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS n, o_orderpriority || ' <' || o_orderkey || '>' AS security,
  CASE WHEN c_custkey % 3 > 0 THEN CAST(CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE -CAST(o_totalprice AS DECIMAL(18,2)) END AS DOUBLE) END AS shares,
  CASE WHEN c_custkey % 3 > 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'D' END END AS direction, CASE WHEN c_custkey % 3 > 0 THEN '$5' ELSE '$1' END AS exercise_price,
  CASE WHEN c_custkey % 3 > 0 THEN NULL ELSE strftime(o_orderdate, '%m/%d/%Y') END AS exercisable_3, CASE WHEN c_custkey % 3 > 0 THEN 'I' ELSE 'D' END AS ownership
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def src_insider_table_ii(spark, sf_dir):
    """Rows of table II: acquired and disposed amounts as one signed number."""
    t = insider_forms.read_table(_forms(spark, sf_dir), "html", "form", "II", ("c_custkey",))
    return t.select("c_custkey", "n", F.col("security.value").alias("security"), "shares", "direction", F.col("exercise_price.value").alias("exercise_price"), F.when(F.col("direction").isNull(), F.col("exercisable.value")).alias("exercisable_3"), "ownership")


@query("SELECT o_custkey, o_orderkey, o_orderpriority || ' & ' || o_orderkey AS asset, CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus END AS status, '$' || CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders")
def src_html_by_header(spark, sf_dir):
    """The right one of several tables by its header; columns in either order, some missing; rows in several bodies."""
    o = spread(table(spark, sf_dir, "orders"), "o_custkey")
    even = F.col("o_custkey") % 2 == 0
    cells = [_t("<td>", F.col("o_orderkey"), "</td>"), _t("<td><b>", F.col("o_orderpriority"), "</b> &amp;\n", F.col("o_orderkey"), "</td>"), _t("<td>&#36;", F.col("o_totalprice").cast("decimal(18,2)"), "</td>")]
    row = F.when(even, _t("<tr>", cells[0], "<td>", F.col("o_orderstatus"), "</td>", cells[1], cells[2], "</tr>")).otherwise(_t("<tr>", cells[2], cells[1], cells[0], "</tr>"))
    lists = o.groupBy("o_custkey", (F.col("o_orderkey") % 2).alias("half")).agg(F.array_join(F.collect_list(row), "").alias("rows")).groupBy("o_custkey").agg(F.array_join(F.collect_list(_t("<tbody>", F.col("rows"), "</tbody>")), "").alias("rows"))
    head = F.when(even, "<tr><th>#</th><th>Status of it</th><th>Asset Name</th><th>Amount</th></tr>").otherwise("<tr><th>Amount</th><th>Asset&nbsp;Name</th><th>#</th></tr>")
    page = lists.select("o_custkey", _t("<table><tr><th>Asset</th></tr><tr><td>no</td></tr></table><table><thead>", head, "</thead>", F.col("rows"), "</table>").alias("html"))
    found = markup.by_header(markup.table_with("html", "asset name", "amount"), {"o_orderkey": "^#$", "asset": "asset name", "status": "status", "amount": "amount"})
    return page.select("o_custkey", F.inline(found)).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("SELECT c_custkey, 'é€😀 <' || c_custkey || '> \"q\" &bogus; & ' || chr(65 + CAST(c_custkey % 26 AS INTEGER)) || ' A&B' AS text FROM customer")
def txt_entities(spark, sf_dir):
    """Character references of every kind, by column functions."""
    raw = _t("&eacute;&#8364;&#x1F600; &lt;", F.col("c_custkey"), "&gt; &quot;q&quot; &bogus; & &#", F.col("c_custkey") % 26 + 65, "; A&amp;B")
    return table(spark, sf_dir, "customer").select("c_custkey", markup.decode_entities(raw).alias("text"))


# ---------------------------------------------------------------- bill status documents


def _bill_xml(spark, sf_dir) -> DataFrame:
    """A status document for each customer, its orders the actions; every other one in the older form, with a namespace."""
    k, old = F.col("c_custkey"), F.col("c_custkey") % 2 == 1
    o = spread(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderpriority"), "c_custkey")
    vote = _t("<recordedVotes><recordedVote><chamber>House</chamber><rollNumber>", F.col("o_orderkey") % 5, "</rollNumber><sessionNumber>1</sessionNumber></recordedVote></recordedVotes>")
    action = _t("<item><actionDate>", F.col("day"), "</actionDate><text> Act ", F.col("o_orderpriority"), " </text><type>F</type><links><link><name>l</name><url>u", F.col("o_orderkey"), "</url></link></links>", vote, "</item>")
    acts = o.select("c_custkey", F.struct("day", "o_orderkey", F.concat(action, action).alias("x")).alias("a")).groupBy("c_custkey").agg(F.array_sort(F.collect_list("a")).alias("acts"))
    c = spread(table(spark, sf_dir, "customer"), "c_custkey").join(acts, "c_custkey", "left")
    person = _t("<item><identifiers><bioguideId>b", k, "</bioguideId></identifiers><firstName>Ann</firstName><lastName>Roe ", k % 7, "</lastName><party>D</party></item>")
    titles = _t("<titles><item><titleType>Official Title as Introduced</titleType><title>To do ", k, "</title></item>", F.when(k % 3 == 0, _t("<item><titleType>Display Title</titleType><title> Act &amp; ", k, " </title></item>")).otherwise(""), "<item><titleType> </titleType></item></titles>")
    subjects = F.when(old, _t("<subjects><billSubjects><otherSubjects><item><name>Roads</name><parentSubject><name>Transport</name></parentSubject></item><item><name>Rail ", k, "</name></item></otherSubjects><primarySubjects><name>Taxes</name></primarySubjects></billSubjects><policyArea><name>Area ", k % 4, "</name></policyArea></subjects>")).otherwise(_t("<subjects><legislativeSubjects><item><name>Law ", k, "</name></item><item><name/></item></legislativeSubjects><policyArea><name>Area ", k % 4, "</name></policyArea></subjects>"))
    summaries = F.when(old, _t("<summaries><billSummaries><item><versionCode>00</versionCode><text>Sum ", k, "</text></item><item><versionCode>1</versionCode></item></billSummaries></summaries>")).otherwise(_t("<summaries><summary><versionCode>07</versionCode><cdata><text>Cdata ", k, "</text></cdata></summary></summaries>"))
    inner = _t("<item><name>Panel ", k, "</name><systemCode>hs00</systemCode><activities><item><name>Referred</name><date>2024-01-0", k % 9 + 1, "</date></item></activities><subcommittees><item><name>Sub</name></item></subcommittees></item>")
    committees = F.when(old, _t("<committees><billCommittees>", inner, "</billCommittees></committees>")).otherwise(_t("<committees>", inner, inner, "</committees>"))
    amendments = _t("<amendments><amendment><number>", k, "</number><type>", F.when(k % 4 < 2, "SAMDT").otherwise("HAMDT"), "</type><sponsors><item><name>Ann</name></item><item><name>Bob</name></item></sponsors><actions><count>x</count><actions><item><text>t</text></item></actions></actions></amendment></amendments>")
    rest = _t("<textVersions><item><type>Introduced</type><formats><item><url> u", k, " </url></item></formats></item></textVersions><calendarNumbers><item><calendar>Union</calendar><number>", k, "</number></item></calendarNumbers><cboCostEstimates><item><rptTitle>cost</rptTitle></item></cboCostEstimates><committeeReports><committeeReport><citation>H. Rept. ", k, "</citation></committeeReport></committeeReports>", F.when(k % 5 == 0, _t("<laws><item><number>118-", k, "</number><type>Public Law</type></item></laws>")).otherwise("<laws></laws>"), "<notes><", F.when(old, "Item").otherwise("item"), "><text>note</text></", F.when(old, "Item").otherwise("item"), "></notes><relatedBills><item><number>", k + 1, "</number><relationshipDetails><item><type>Related</type></item></relationshipDetails></item></relatedBills>")
    tag = F.when(old, "billNumber").otherwise("number")
    xml = _t("<?xml version=\"1.0\"?><billStatus", F.when(old, ' xmlns:dc="http://purl.org/" xmlns="http://x/"').otherwise(""), "><version>3</version><bill><", tag, ">", k, "</", tag, "><congress>118</congress><type>hr</type><introducedDate>2024-0", k % 9 + 1, "-02</introducedDate>", F.when(old, "<lastAction><text>last</text></lastAction>").otherwise("<latestAction><text>latest</text></latestAction>"), titles, "<sponsors>", person, "</sponsors><cosponsors>", person, person, "</cosponsors><actions>", F.coalesce(F.array_join(F.transform("acts", lambda a: a["x"]), ""), F.lit("")), "</actions><recordedVotes><recordedVote><chamber>House</chamber><rollNumber>3</rollNumber><sessionNumber>1</sessionNumber></recordedVote></recordedVotes>", subjects, summaries, committees, amendments, rest, "</bill></billStatus>")
    return c.select("c_custkey", xml.alias("xml"))


@query("""
WITH acts AS (SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m-%d') || ' Act ' || o_orderpriority AS act FROM orders),
lists AS (SELECT o_custkey, string_agg(act, ';' ORDER BY act) AS actions FROM acts GROUP BY o_custkey),
votes AS (SELECT o_custkey, string_agg(roll, ',' ORDER BY roll) AS votes FROM (SELECT DISTINCT o_custkey, CAST(o_orderkey % 5 AS VARCHAR) AS roll FROM orders UNION SELECT c_custkey, '3' FROM customer) GROUP BY o_custkey)
SELECT '118-HR-' || c_custkey AS bill_id, CASE WHEN c_custkey % 3 = 0 THEN 'Act & ' || c_custkey ELSE 'To do ' || c_custkey END AS title, CAST(CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS n_titles,
  'Area ' || c_custkey % 4 AS policy_area, CASE WHEN c_custkey % 2 = 1 THEN 'last' ELSE 'latest' END AS latest, 'B' || c_custkey || ' Ann Roe ' || c_custkey % 7 AS sponsor, actions, votes,
  CASE WHEN c_custkey % 2 = 1 THEN 'Roads<Transport;Rail ' || c_custkey || ';Taxes!' ELSE 'Law ' || c_custkey || ';Area ' || c_custkey % 4 || '!' END AS subjects,
  CASE WHEN c_custkey % 2 = 1 THEN '00:Sum ' ELSE '07:Cdata ' END || c_custkey AS summaries, CAST(CASE WHEN c_custkey % 2 = 1 THEN 1 ELSE 2 END AS INTEGER) AS n_committees,
  'Panel ' || c_custkey || ' Referred 2024-01-0' || c_custkey % 9 + 1 || ' Sub' AS committee, 'https://www.congress.gov/amendment/118th-congress/' || CASE WHEN c_custkey % 4 < 2 THEN 'senate' ELSE 'house' END || '-amendment/' || c_custkey || ' Ann,Bob' AS amendment,
  'u' || c_custkey || ' Union ' || c_custkey || ' cost H. Rept. ' || c_custkey AS others, CASE WHEN c_custkey % 5 = 0 THEN '118-' || c_custkey END AS law, 'note' AS note, c_custkey + 1 || ' Related' AS related
FROM customer LEFT JOIN lists l ON l.o_custkey = c_custkey LEFT JOIN votes v ON v.o_custkey = c_custkey WHERE c_custkey % 9 > 0
""")
def src_bill_status(spark, sf_dir):
    """All collections of status documents in both forms, within a window of introduction dates."""
    b = bill_status.parse_bills(_bill_xml(spark, sf_dir), dated=("2024-01-03", "2024-12-31"))
    join = lambda a, f: F.array_join(F.transform(a, f), ";")
    first = lambda c: F.get(c, 0)
    committee, amendment = first("committees"), first("amendments")
    return b.select(
        "bill_id", "title", F.size("titles").alias("n_titles"), "policy_area", F.col("latest_action.text").alias("latest"), F.concat_ws(" ", first("sponsors")["bioguideId"], first("sponsors")["fullName"]).alias("sponsor"),
        F.array_join(F.array_sort(F.transform("actions", lambda a: F.concat_ws(" ", a["actionDate"], a["text"]))), ";").alias("actions"),
        F.array_join(F.array_sort(F.transform("recorded_votes", lambda v: v["rollNumber"])), ",").alias("votes"),
        join("subjects", lambda s: F.concat(s["name"], F.when(s["primary"], "!").otherwise(""), F.coalesce(F.concat(F.lit("<"), s["parent"]), F.lit("")))).alias("subjects"),
        join("summaries", lambda s: F.concat_ws(":", s["versionCode"], s["text"])).alias("summaries"), F.size("committees").alias("n_committees"),
        F.concat_ws(" ", committee["name"], first(committee["activities"])["name"], first(committee["activities"])["date"], first(committee["subcommittees"])["name"]).alias("committee"),
        F.concat_ws(" ", amendment["url"], F.array_join(amendment["sponsors"], ",")).alias("amendment"),
        F.concat_ws(" ", first("text_versions")["url"], first("calendar_numbers")["calendar"], first("calendar_numbers")["number"], first("cost_estimates")["rptTitle"], first("committee_reports")).alias("others"),
        first("laws")["number"].alias("law"), first("notes")["text"].alias("note"), F.concat_ws(" ", first("related_bills")["number"], first(first("related_bills")["relationshipDetails"])["type"]).alias("related"),
    )
