"""News text and pages: tokens, phrases, keywords, markup.

On the fixture tables a document is an article.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import strings, text
from ..operators import dictionary, search
from ..operators.joins import small
from ..session import table
from ..sources import readers
from .registry import query

LOWER = "translate(lower(text), '–—“”‘’', '--\"\"''''')"
RAW = f"regexp_extract_all({LOWER}, '\\w+(?:[-\\.]\\w+)*')"
TOKENS = f"flatten(list_transform({RAW}, lambda w: CASE WHEN contains(w, '-') THEN list_concat(string_split(w, '-'), [w]) ELSE [w] END))"
KEPT = f"list_filter({TOKENS}, lambda w: length(w) >= 3 OR w IN {text.SHORT_WORDS})"

def articles(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text", "n_chars")


def _digest(xs, sep=" "):
    return F.md5(F.array_join(xs, sep))


@query(f"SELECT doc_id, md5({LOWER}) AS digest FROM documents")
def txt_norm(spark, sf_dir):
    """Lower case, plain dashes and quotes."""
    return articles(spark, sf_dir).select("doc_id", F.md5(text.normal("text")).alias("digest"))


@query()
def txt_norm_nfkc(spark, sf_dir):
    """The same after the compatibility normal form."""
    return articles(spark, sf_dir).select("doc_id", F.md5(text.normal(text.nfkc("text"))).alias("digest"))


@query("SELECT doc_id, md5(w || ' ' || regexp_replace(w, '(\\w+)''s\\b', '\\1', 'g') || ' ' || regexp_replace(w, '(\\w+)''s\\b', '\\1''s \\1', 'g')) AS digest FROM (SELECT doc_id, lang || '''s ' || source || ' news' AS w FROM documents)")
def txt_possessive(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", F.md5(text.with_possessives(F.concat("lang", F.lit("'s "), "source", F.lit(" news")))).alias("digest"))


@query(f"SELECT doc_id, CAST(len({TOKENS}) AS INTEGER) AS n, md5(array_to_string({TOKENS}, ' ')) AS digest FROM documents")
def txt_tokens(spark, sf_dir):
    t = articles(spark, sf_dir).withColumn("t", text.tokens(text.normal("text")))
    return t.select("doc_id", F.size("t").alias("n"), _digest("t").alias("digest"))


@query()
def txt_tokens_unicode(spark, sf_dir):
    """Words of every script."""
    t = articles(spark, sf_dir).withColumn("t", text.tokens(text.normal(text.nfkc("text")), unicode=True))
    return t.select("doc_id", F.size("t").alias("n"), _digest("t").alias("digest"))


@query(f"SELECT doc_id, CAST(len({KEPT}) AS INTEGER) AS n, md5(array_to_string({KEPT}, ' ')) AS digest FROM documents")
def txt_filter(spark, sf_dir):
    t = articles(spark, sf_dir).withColumn("t", text.keep_tokens(text.tokens(text.normal("text"))))
    return t.select("doc_id", F.size("t").alias("n"), _digest("t").alias("digest"))


UNIQ = f"""WITH w AS (SELECT doc_id, unnest({KEPT}) AS w, generate_subscripts({KEPT}, 1) AS i FROM documents), f AS (SELECT doc_id, w, min(i) AS i FROM w GROUP BY doc_id, w),
r AS (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM f), u AS (SELECT doc_id, list(w ORDER BY n) AS t FROM r WHERE n <= 100 GROUP BY doc_id) """


def uniques(spark, sf_dir) -> DataFrame:
    t = text.unique_tokens(text.keep_tokens(text.tokens(text.normal("text"))))
    # one generated row each: no filter passes below it, so the words are taken once
    return articles(spark, sf_dir).select("doc_id", F.explode(F.array(t)).alias("t")).filter(F.size("t") > 0)


@query(UNIQ + "SELECT doc_id, CAST(len(t) AS INTEGER) AS n, md5(array_to_string(t, ' ')) AS digest FROM u")
def txt_uniq(spark, sf_dir):
    """The first hundred distinct words, in order."""
    return uniques(spark, sf_dir).select("doc_id", F.size("t").alias("n"), _digest("t").alias("digest"))


@query(UNIQ + "SELECT doc_id, md5(array_to_string(list_concat(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]), list_transform(range(1, greatest(len(t) - 1, 1)), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])), '|')) AS digest FROM u")
def txt_ngram(spark, sf_dir):
    """Phrases of two and three of them."""
    return uniques(spark, sf_dir).select("doc_id", _digest(text.phrases("t"), "|").alias("digest"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'artificial intelligence|ai|machine intelligence|' || source WHEN 1 THEN 'coronavirus|covid|covid-19|' || source ELSE source END AS words FROM documents".replace("artificial intelligence|ai|machine intelligence|' || source", "ai|artificial intelligence|machine intelligence|' || source"))
def txt_syn(spark, sf_dir):
    """Words with their synonyms, and the synonyms of those."""
    seed = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("ai"), "source")).when(F.col("doc_id") % 3 == 1, F.array(F.lit("covid"), "source")).otherwise(F.array("source"))
    return articles(spark, sf_dir).select("doc_id", F.array_join(text.synonym_closure(seed), "|").alias("words"))


@query(UNIQ + ", q AS (SELECT doc_id FROM u WHERE list_contains(t, 'the') AND list_contains(t, 'and')) SELECT doc_id FROM q")
def txt_query(spark, sf_dir):
    """Articles that hold all words of a query, taken through the same path."""
    q = spark.range(1).select(text.unique_tokens(text.keep_tokens(text.tokens(text.normal(F.lit("The AND"))))).alias("q"))
    return uniques(spark, sf_dir).join(F.broadcast(q), F.size(F.array_except("q", "t")) == 0).select("doc_id")


@query("SELECT c_custkey, 'acme ' || c_custkey AS name FROM customer")
def txt_company(spark, sf_dir):
    raw = F.concat(F.lit("  Acme "), F.col("c_custkey").cast("string"), F.lit(", Inc. Holdings Ltd "))
    return table(spark, sf_dir, "customer").select("c_custkey", text.company_name(raw).alias("name"))


TICKERS = "SELECT DISTINCT CASE n_nationkey % 6 WHEN 0 THEN 'THE' WHEN 1 THEN 'WAS' WHEN 2 THEN 'A' WHEN 3 THEN 'AT' WHEN 4 THEN 'T' ELSE n_name END AS ticker FROM nation"
COMPANIES = "SELECT DISTINCT CASE n_nationkey % 4 WHEN 0 THEN 'thinger' WHEN 1 THEN 'with ' || lower(n_name) WHEN 2 THEN 'of the' ELSE 'the ' || lower(n_name) END AS name FROM nation"


def _listed(spark, sf_dir, sql: str) -> DataFrame:
    """A short list made of the nations; checked before it is broadcast."""
    return small(spark.sql(sql.replace("FROM nation", "FROM {nation}"), nation=table(spark, sf_dir, "nation")))


@query(f"WITH w AS (SELECT DISTINCT doc_id, unnest(string_split_regex(text, '[^A-Za-z0-9_]+')) AS t FROM documents) SELECT doc_id, lower(t) AS ticker FROM w WHERE regexp_matches(t, '^[A-Z]{{1,5}}$') AND (length(t) >= 3 OR t IN ('BA', 'GE', 'GM', 'AT', 'T')) AND t IN ({TICKERS})")
def txt_tickers(spark, sf_dir):
    """Words of capitals that are in the list of tickers."""
    found = articles(spark, sf_dir).select("doc_id", F.explode(text.ticker_candidates("text")).alias("ticker"))
    return found.join(_listed(spark, sf_dir, TICKERS), "ticker", "left_semi").select("doc_id", F.lower("ticker").alias("ticker"))


@query(f"""WITH c AS (SELECT name, split_part(name, ' ', 1) AS head FROM ({COMPANIES}) WHERE length(name) > 3)
SELECT DISTINCT doc_id, CASE WHEN contains(lower(text), name) THEN name ELSE head END AS company FROM documents, c WHERE contains(lower(text), name) OR length(head) BETWEEN 4 AND 15 AND contains(lower(text), head)""")
def txt_companies(spark, sf_dir):
    """Names of a short list that a text holds, whole or by their first word."""
    a = articles(spark, sf_dir).select("doc_id", F.lower("text").alias("low"))
    names = _listed(spark, sf_dir, COMPANIES).filter(F.length("name") > 3).withColumn("head", F.substring_index("name", " ", 1))
    looked = names.select(F.col("name").alias("entry")).unionByName(names.filter(F.length("head").between(4, 15)).select(F.col("head").alias("entry")))
    found = dictionary.occurrences(a, "low", looked, "entry", ("doc_id",))
    whole = found.join(names, F.col("entry") == F.col("name")).select("doc_id", "name", F.col("name").alias("company"), F.lit(0).alias("rank"))
    first = found.join(names, F.col("entry") == F.col("head")).filter(F.length("head").between(4, 15)).select("doc_id", "name", F.col("head").alias("company"), F.lit(1).alias("rank"))
    # of each name the whole, else its first word
    best = whole.unionByName(first).groupBy("doc_id", "name").agg(F.min_by("company", "rank").alias("company"))
    return best.select("doc_id", "company").distinct()


@query(UNIQ + "SELECT doc_id, md5(array_to_string(list_concat(list_filter(t, lambda w: w = 'the' OR w = 'ing' OR length(w) <= 10), list_filter(t, lambda w: NOT (w = 'the' OR w = 'ing' OR length(w) <= 10)))[1:20], ' ')) AS digest FROM u")
def topk_keywords(spark, sf_dir):
    """Tickers, companies and short words first, twenty at most."""
    k = text.ranked_keywords("t", F.array(F.lit("the")), F.array(F.lit("ing")))
    return uniques(spark, sf_dir).select("doc_id", _digest(k).alias("digest"))


@query(f"""WITH p AS (SELECT DISTINCT doc_id, trim(p, ' ') AS p FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[.,;:!?\n|]+')) AS p FROM documents) WHERE length(trim(p, ' ')) BETWEEN 4 AND 40),
w AS (SELECT doc_id, unnest(string_split_regex(p, '[ \t\r\f]+')) AS w FROM p), k AS (SELECT doc_id, regexp_replace(w, '\\W', '', 'g') AS k FROM w UNION SELECT doc_id, p FROM p WHERE length(p) <= 25)
SELECT doc_id, count(*) AS n_terms, md5(string_agg(k, '|' ORDER BY k)) AS digest FROM k WHERE length(k) BETWEEN 3 AND 50 AND k NOT IN {text.COMMON_WORDS} GROUP BY doc_id""")
def txt_keyterms(spark, sf_dir):
    """Terms of the phrases between punctuation, common words left out."""
    p = F.filter(F.transform(F.split(F.lower("text"), "[.,;:!?\n|]+"), lambda x: F.trim(x)), lambda x: F.length(x).between(4, 40))
    # one generated row each, so that the terms are taken once
    t = articles(spark, sf_dir).select("doc_id", F.explode(F.array(text.without_common(text.key_terms(p)))).alias("t")).filter(F.size("t") > 0)
    return t.select("doc_id", F.size("t").cast("bigint").alias("n_terms"), _digest(F.array_sort("t"), "|").alias("digest"))


@query("SELECT min(doc_id) AS doc_id, md5(text) AS article FROM documents GROUP BY text")
def set_dedup_id(spark, sf_dir):
    """Repeated articles once, the first of them."""
    a = articles(spark, sf_dir).select("doc_id", F.md5("text").alias("article"))
    return a.groupBy("article").agg(F.min("doc_id").alias("doc_id"))


@query("WITH old AS (SELECT * FROM documents WHERE doc_id % 2 = 0), new AS (SELECT * FROM documents WHERE doc_id % 2 = 1) SELECT doc_id FROM new WHERE md5(text) NOT IN (SELECT md5(text) FROM old) AND doc_id // 2 NOT IN (SELECT doc_id FROM old WHERE doc_id % 10 = 0)")
def set_dup_url(spark, sf_dir):
    """New articles whose id and address are both unseen."""
    d = articles(spark, sf_dir).select("doc_id", F.md5("text").alias("url"), F.floor(F.col("doc_id") / 2).alias("key"))
    old, new = d.filter("doc_id % 2 = 0"), d.filter("doc_id % 2 = 1")
    return new.join(old.select("url"), "url", "left_anti").join(old.filter("doc_id % 10 = 0").select(F.col("doc_id").alias("key")), "key", "left_anti").select("doc_id")


@query("SELECT doc_id, source, n_chars FROM documents WHERE lang = 'de' AND contains(text, 'ung') AND n_chars >= 1000")
def qry_news(spark, sf_dir):
    d = articles(spark, sf_dir).filter(search.predicate(text__contains="ung"))
    return search.lookup(d, "lang", "de", "n_chars", (1000, None), tie="doc_id").select("doc_id", "source", "n_chars")


@query("SELECT doc_id, sha256(doc_id || '|' || lang || '|' || source || '|' || text) AS digest FROM documents")
def hash_documents(spark, sf_dir):
    """A digest of each record's content, for change detection."""
    return articles(spark, sf_dir).select("doc_id", F.sha2(F.concat_ws("|", F.col("doc_id").cast("string"), "lang", "source", "text"), 256).alias("digest"))


@query("SELECT page_id, CAST(len(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS INTEGER) AS n_links, regexp_extract(html, 'href=\"([^\"]*)\"', 1) AS first_link FROM pages")
def src_html_links(spark, sf_dir):
    """Links by the first pattern that finds any."""
    p = table(spark, sf_dir, "pages").withColumn("l", readers.html_links(F.col("html"), [r'data-url="([^"]*)"', r'href="([^"]*)"']))
    return p.select("page_id", F.size("l").alias("n_links"), F.coalesce(F.try_element_at("l", F.lit(1)), F.lit("")).alias("first_link"))


@query("SELECT page_id, regexp_extract(html, '<html lang=\"(\\w+)\"', 1) AS lang, trim(regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '\\s+', ' ', 'g')) AS title FROM pages")
def src_html_fields(spark, sf_dir):
    """Labelled fields, each by the first pattern that matches."""
    h = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", readers.html_field(h, [r'<body lang="(\w+)"', r'<html lang="(\w+)"']).alias("lang"), readers.html_field(h, [r"(?is)<h1>(.*?)</h1>", r"(?is)<title>(.*?)</title>"]).alias("title"))


@query("SELECT o_orderkey, o_orderpriority AS cell, o_orderstatus AS second, CAST(1 AS INTEGER) AS n_rows FROM orders")
def src_html_table(spark, sf_dir):
    """Cells of tables in markup."""
    html = F.concat(F.lit("<table><thead><tr><th>h</th></tr></thead><tbody><tr><td> <b>"), "o_orderpriority", F.lit("</b>\n</td><td class=x>"), "o_orderstatus", F.lit("</td></tr></tbody></table>"))
    o = table(spark, sf_dir, "orders").withColumn("r", readers.html_rows(html))
    return o.select("o_orderkey", F.col("r")[0][0].alias("cell"), F.col("r")[0][1].alias("second"), F.size("r").alias("n_rows"))


@query("SELECT c_custkey, c_name || ' & <b> \"x\"' AS cleaned FROM customer")
def str_htmlclean(spark, sf_dir):
    raw = F.concat(F.lit("<p>"), "c_name", F.lit("</p>\n &amp; <script>var a=1</script>&lt;b&gt; &quot;x&quot;"))
    return table(spark, sf_dir, "customer").select("c_custkey", strings.clean_html(raw).alias("cleaned"))


@query("SELECT page_id, regexp_replace(url, '[?#].*$', '') || '.htm' AS picked, regexp_replace(url, '[?#].*$', '') || '/html/a.htm' AS beside FROM pages")
def str_formpick(spark, sf_dir):
    base = F.regexp_replace("url", "[?#].*$", "")
    urls = F.array(F.concat(base, F.lit(".pdf")), F.concat(base, F.lit(".htm")), F.concat(base, F.lit(".xml")))
    return table(spark, sf_dir, "pages").select("page_id", strings.pick_format(urls).alias("picked"), strings.htm_of_xml(F.concat(base, F.lit("/xml/a.xml"))).alias("beside"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'michael,mike,mick' ELSE 'bob,robert' END AS forms, 'ann,a,a.,' AS middles FROM customer")
def str_nick_middle(spark, sf_dir):
    """Nicknames both ways, and the forms of a middle name."""
    nick = {"michael": ["mike", "mick"], "robert": ["bob", "rob"]}
    table_ = F.create_map(*[x for k, v in nick.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    back = F.create_map(*[x for k, v in nick.items() for n in v for x in (F.lit(n), F.array(F.lit(k)))])
    name = F.when(F.col("c_custkey") % 2 == 0, "michael").otherwise("bob")
    none = F.array().cast("array<string>")
    forms = F.array_union(F.array(name), F.concat(F.coalesce(F.try_element_at(table_, name), none), F.coalesce(F.try_element_at(back, name), none)))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(forms, ",").alias("forms"), F.array_join(strings.middle_variants(F.lit("Ann")), ",").alias("middles"))
