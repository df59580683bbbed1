"""Bill status documents: one schema for all their collections, from which the XML is read and tidied.

TREE is the schema: a dict is an element with parts, a list of one dict a repeated
element, None a text.  It gives Spark's schema for from_xml, and the expressions that
trim every text, drop what is empty and drop elements of which nothing is left.  What
a later feed names otherwise stands beside its older name and fills it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import markup


def texts(*names: str) -> dict:
    return dict.fromkeys(names)


#: The elements of a status document.
PERSON = texts("bioguideId", "fullName", "firstName", "middleName", "lastName", "name", "party", "state", "district", "isByRequest", "isOriginalCosponsor", "sponsorshipDate", "sponsorshipWithdrawnDate") | {"identifiers": texts("bioguideId", "lisID", "gpoId")}
VOTE = texts("chamber", "congress", "date", "fullActionName", "rollNumber", "sessionNumber", "url")
LINKS = {"link": [texts("name", "url")]}
SHORT_ACTION = texts("actionDate", "actionTime", "text", "type", "actionCode")
SUBJECT = texts("name", "updateDate") | {"parentSubject": texts("name")}
SUMMARY = texts("text", "actionDate", "actionDesc", "versionCode", "name", "updateDate", "lastSummaryUpdateDate") | {"cdata": texts("text")}
COMMITTEE = texts("chamber", "name", "systemCode", "type") | {"activities": {"item": [texts("date", "name")]}, "subcommittees": {"item": [texts("name", "systemCode")]}}
NOTE = texts("text") | {"links": LINKS}
TREE = texts("number", "billNumber", "type", "billType", "congress", "title", "introducedDate", "createDate", "updateDate", "updateDateIncludingText", "originChamber", "isByRequest", "version", "constitutionalAuthorityStatementText") | {
    "cdata": texts("constitutionalAuthorityStatementText"),
    "titles": {"item": [texts("chamberCode", "chamberName", "parentTitleType", "titleType", "title")]},
    "lastAction": texts("actionDate", "actionTime", "text") | {"links": LINKS},
    "latestAction": texts("actionDate", "actionTime", "text") | {"links": LINKS},
    "policyArea": texts("name"),
    "subjects": {
        "policyArea": texts("name"),
        "billSubjects": {"otherSubjects": [{"item": [SUBJECT]}], "primarySubjects": [SUBJECT]},
        "legislativeSubjects": {"item": [SUBJECT]},
        "item": [SUBJECT],
    },
    "sponsors": {"item": [PERSON]},
    "cosponsors": {"item": [PERSON]},
    "actions": {"item": [SHORT_ACTION | {"committee": texts("name", "systemCode"), "sourceSystem": texts("code", "name"), "links": LINKS, "recordedVotes": {"recordedVote": [VOTE]}}]},
    "recordedVotes": {"recordedVote": [VOTE]},
    "summaries": {"billSummaries": {"item": [SUMMARY]}, "summary": [SUMMARY]},
    "amendments": {
        "amendment": [
            texts("number", "description", "purpose", "type", "submittedDate", "chamber", "updateDate", "congress")
            | {
                "latestAction": texts("actionDate", "text"),
                "amendedBill": texts("congress", "number", "originChamber", "originChamberCode", "title", "type", "updateDateIncludingText"),
                "sponsors": texts("name") | {"item": [texts("name")]},
                "actions": texts("count") | {"actions": {"item": [SHORT_ACTION]}},
            }
        ]
    },
    "textVersions": {"item": [texts("type", "date") | {"formats": {"item": [texts("url", "type")]}}]},
    "calendarNumbers": {"item": [texts("calendar", "number")]},
    "cboCostEstimates": {"item": [texts("rptPubDate", "rptTitle", "rptUrl")]},
    "committeeReports": {"committeeReport": [texts("citation")]},
    "committees": {"billCommittees": {"item": [COMMITTEE]}, "item": [COMMITTEE]},
    "laws": {"item": [texts("number", "type")]},
    "notes": {"item": [NOTE]},
    "relatedBills": {"item": [texts("title", "congress", "number", "type", "latestTitle") | {"latestAction": texts("actionDate", "text"), "relationshipDetails": {"item": [texts("type", "identifiedBy")]}}]},
}
#: The titles that name a bill, the first first, and the paths of amendments.
NAMING_TITLES = ("Display Title", "Official Title as Introduced")
AMENDMENT_PATHS = {"HAMDT": "house-amendment", "SAMDT": "senate-amendment"}


def schema_of(tree) -> T.DataType:
    if tree is None:
        return T.StringType()
    if isinstance(tree, list):
        return T.ArrayType(schema_of(tree[0]))
    return T.StructType([T.StructField(k, schema_of(v)) for k, v in tree.items()])


def tidy(c: str, tree, depth: int = 0) -> str:
    """SQL of a value with its texts trimmed and empty ones null; elements and lists of which nothing is left are null.

    Text, as the parser reads a large expression much sooner than it is built call by call.
    """
    let, x = (lambda value, then: f"element_at(transform(array({value}), w{depth} -> CASE WHEN {then} THEN w{depth} END), 1)"), f"x{depth}"
    if tree is None:
        return f"nullif(trim({c}), '')"
    if isinstance(tree, list):
        return let(f"filter(transform({c}, {x} -> {tidy(x, tree[0], depth + 1)}), {x} -> {x} IS NOT NULL)", f"size(w{depth}) > 0")
    parts = ", ".join(f"'{k}', {tidy(f'{c}.{k}', v, depth + 1)}" for k, v in tree.items())
    return let(f"named_struct({parts})", " OR ".join(f"w{depth}.{k} IS NOT NULL" for k in tree))


def _first_of(a: Column, same) -> Column:
    """The elements of an array that no earlier one equals."""
    return markup.let(a, lambda all_: F.filter(all_, lambda x, k: ~F.exists(F.slice(all_, F.lit(1), k), lambda y: same(x, y))))


def _or_empty(c: Column, like: str) -> Column:
    return F.coalesce(c, F.expr(f"cast(array() as {like})"))


def _ddl(tree) -> str:
    return schema_of(tree).simpleString()


def _person(x: Column) -> Column:
    """A sponsor with one place for its id and its full name."""
    full = F.coalesce(x["fullName"], x["name"], F.nullif(F.concat_ws(" ", x["firstName"], x["middleName"], x["lastName"]), F.lit("")))
    same = ("firstName", "middleName", "lastName", "party", "state", "district", "isOriginalCosponsor", "sponsorshipDate", "sponsorshipWithdrawnDate")
    return F.struct(F.upper(F.coalesce(x["identifiers"]["bioguideId"], x["bioguideId"])).alias("bioguideId"), full.alias("fullName"), *[x[n].alias(n) for n in same])


def _actions(actions: Column) -> Column:
    """Actions of one day and text once, the first, with the votes of all of them."""
    same = lambda x, y: x["actionDate"].eqNullSafe(y["actionDate"]) & x["text"].eqNullSafe(y["text"])
    votes = lambda x: F.flatten(F.transform(F.filter(actions, lambda y: same(x, y)), lambda y: _or_empty(y["recordedVotes"]["recordedVote"], _ddl([VOTE]))))
    return F.transform(_first_of(actions, same), lambda x: x.withField("recordedVotes", votes(x)).withField("links", x["links"]["link"]))


def _subjects(s: Column) -> Column:
    """Other subjects, then the primary ones; without either the plain list and the policy area."""
    one = lambda primary: lambda x: F.struct(x["name"].alias("name"), x["parentSubject"]["name"].alias("parent"), x["updateDate"].alias("updateDate"), F.lit(primary).alias("primary"))
    lists = _or_empty(s["billSubjects"]["otherSubjects"], _ddl([{"item": [SUBJECT]}]))
    other = F.flatten(F.transform(lists, lambda o: _or_empty(o["item"], _ddl([SUBJECT]))))
    primary = F.filter(_or_empty(s["billSubjects"]["primarySubjects"], _ddl([SUBJECT])), lambda x: x["name"].isNotNull())
    full = F.concat(F.transform(other, one(False)), F.transform(primary, one(True)))
    plain = F.transform(_or_empty(F.coalesce(s["legislativeSubjects"]["item"], s["item"]), _ddl([SUBJECT])), one(False))
    area = F.when(s["policyArea"]["name"].isNotNull(), F.array(F.struct(s["policyArea"]["name"].alias("name"), F.lit(None).cast("string").alias("parent"), F.lit(None).cast("string").alias("updateDate"), F.lit(True).alias("primary"))))
    short = markup.let(plain, lambda p: F.concat(p, F.coalesce(area, F.filter(p, lambda _: F.lit(False)))))
    return markup.let(full, lambda f: F.when(F.size(f) > 0, f).otherwise(short))


def _amendment(congress: Column):
    def one(a: Column) -> Column:
        c = F.coalesce(a["congress"].try_cast("int"), congress)
        kind = F.coalesce(*[F.when(F.upper(a["type"]) == k, F.lit(v)) for k, v in AMENDMENT_PATHS.items()], F.lit(AMENDMENT_PATHS["HAMDT"]))
        url = F.when(a["number"].isNotNull() & c.isNotNull(), F.concat(F.lit("https://www.congress.gov/amendment/"), c.cast("string"), F.lit("th-congress/"), kind, F.lit("/"), a["number"]))
        names = F.coalesce(F.transform(a["sponsors"]["item"], lambda s: s["name"]), F.when(a["sponsors"]["name"].isNotNull(), F.array(a["sponsors"]["name"])))
        plain = ("number", "type", "description", "purpose", "submittedDate", "chamber", "updateDate", "latestAction", "amendedBill")
        return F.struct(c.alias("congress"), *[a[n].alias(n) for n in plain], names.alias("sponsors"), a["actions"]["count"].try_cast("int").alias("actionsCount"), a["actions"]["actions"]["item"].alias("actions"), url.alias("url"))

    return one


def parse_bills(df: DataFrame, xml: str = "xml", dated: tuple[str, str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One wide row for each status document: its head, and its collections as arrays (null where there are none).

    Namespaces and prefixes go.  With a window the introduction date is read first, so
    documents outside of it are not parsed; a document without a date is.  A document
    that is no XML, or has no bill, gives a row of nulls.
    """
    bare = F.regexp_replace(F.regexp_replace(F.col(xml), r'\sxmlns(:\w+)?="[^"]*"', ""), r"(</?)\w+:", "$1")
    bare = F.regexp_replace(bare, r"(</?)Item\b", "$1item")  # either case occurs, and names of columns have none
    df = df.withColumn("__x", bare)
    if dated:
        d = F.try_to_date(F.regexp_extract("__x", r"<introducedDate>\s*([0-9-]{10})", 1), "yyyy-MM-dd")
        df = df.filter(d.isNull() | d.between(F.lit(dated[0]).cast("date"), F.lit(dated[1]).cast("date")))
    body = F.concat(F.lit("<bill"), F.element_at(F.split(F.substring_index("__x", "</bill>", 1), r"<bill(?=[\s>])", 2), -1), F.lit("</bill>"))
    # Each top element is tidied once, in a column; those that nobody asks for are not.
    df = df.withColumn("b", F.from_xml(F.when(F.col("__x").rlike(r"<bill[\s>]"), body), schema_of(TREE), {"mode": "PERMISSIVE", "attributePrefix": "_"}))
    df = df.select(*keep, *[F.expr(tidy(f"b.{k}", v)).alias(f"__t_{k}") for k, v in TREE.items()])
    t = {k: F.col(f"__t_{k}") for k in TREE}
    congress = t["congress"].try_cast("int")
    kind = F.upper(F.coalesce(t["type"], t["billType"]))
    number = F.coalesce(t["number"], t["billNumber"])
    titles = t["titles"]["item"]
    titled = lambda kind: F.try_element_at(F.filter(titles, lambda x: (x["titleType"] == kind) & x["title"].isNotNull()), F.lit(1))["title"]
    named = [titled(n) for n in NAMING_TITLES]
    summaries = F.coalesce(t["summaries"]["billSummaries"]["item"], t["summaries"]["summary"])
    summaries = F.filter(F.transform(summaries, lambda s: s.withField("text", F.coalesce(s["cdata"]["text"], s["text"])).dropFields("cdata")), lambda s: s["text"].isNotNull())
    committees = F.coalesce(t["committees"]["billCommittees"]["item"], t["committees"]["item"])
    flat = df.select(
        *keep, F.concat_ws("-", congress.cast("string"), kind, number).alias("bill_id"), congress.alias("congress"), kind.alias("bill_type"), number.try_cast("int").alias("bill_number"),
        F.coalesce(*named, t["title"]).alias("title"), F.try_to_date(t["introducedDate"], "yyyy-MM-dd").alias("introduced"),
        F.coalesce(t["policyArea"]["name"], t["subjects"]["policyArea"]["name"]).alias("policy_area"),
        *[t[k].alias(v) for k, v in (("originChamber", "origin_chamber"), ("createDate", "created"), ("updateDate", "updated"), ("updateDateIncludingText", "updated_text"), ("isByRequest", "by_request"), ("version", "version"))],
        F.coalesce(t["lastAction"], t["latestAction"]).alias("latest_action"),
        F.coalesce(t["constitutionalAuthorityStatementText"], t["cdata"]["constitutionalAuthorityStatementText"]).alias("authority"),
        titles.alias("titles"), F.transform(t["sponsors"]["item"], _person).alias("sponsors"), F.transform(t["cosponsors"]["item"], _person).alias("cosponsors"),
        t["actions"]["item"].alias("__actions"), t["recordedVotes"]["recordedVote"].alias("__votes"), summaries.alias("summaries"), t["subjects"].alias("__subjects"),
        F.transform(t["amendments"]["amendment"], _amendment(congress)).alias("amendments"),
        F.transform(t["textVersions"]["item"], lambda v: v.withField("formats", v["formats"]["item"]).withField("url", F.get(v["formats"]["item"], 0)["url"])).alias("text_versions"),
        t["calendarNumbers"]["item"].alias("calendar_numbers"), t["cboCostEstimates"]["item"].alias("cost_estimates"), F.transform(t["committeeReports"]["committeeReport"], lambda r: r["citation"]).alias("committee_reports"),
        F.transform(committees, lambda c: c.withField("activities", c["activities"]["item"]).withField("subcommittees", c["subcommittees"]["item"])).alias("committees"),
        t["laws"]["item"].alias("laws"), F.transform(t["notes"]["item"], lambda n: n.withField("links", n["links"]["link"])).alias("notes"),
        F.transform(t["relatedBills"]["item"], lambda r: r.withField("relationshipDetails", r["relationshipDetails"]["item"])).alias("related_bills"),
    )
    whole = flat.withColumn("actions", _actions(F.col("__actions"))).withColumn("subjects", _subjects(F.col("__subjects")))
    votes = F.concat(_or_empty(F.col("__votes"), _ddl([VOTE])), F.flatten(F.transform(_or_empty(F.col("actions"), whole.schema["actions"].dataType.simpleString()), lambda a: a["recordedVotes"])))
    same = lambda x, y: x["chamber"].eqNullSafe(y["chamber"]) & x["rollNumber"].eqNullSafe(y["rollNumber"]) & x["sessionNumber"].eqNullSafe(y["sessionNumber"])
    return whole.withColumn("recorded_votes", _first_of(votes, same)).drop("__actions", "__votes", "__subjects")
