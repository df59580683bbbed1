"""News text: tokens, phrases, synonyms, tickers, companies.

The built-in path has ASCII words, as SQL engines have; `unicode=True` makes \\w
mean letters and digits of every script.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words, with inner hyphens and dots; runs are greedy, so they end at word boundaries.
TOKEN = r"\w+(?:[-\.]\w+)*"
#: Short words that count although they have fewer than three letters.
SHORT_WORDS = ("ai", "uk", "us", "eu", "ev", "g7", "qe", "m&a", "pe", "vc", "un", "ml")
#: Synonyms of a term.
SYNONYMS = {
    "ai": ["artificial intelligence", "machine intelligence"],
    "artificial intelligence": ["ai"],
    "us": ["united states", "usa", "america"],
    "united states": ["us", "usa", "america"],
    "uk": ["united kingdom", "britain", "england"],
    "united kingdom": ["uk", "britain", "england"],
    "eu": ["european union", "europe"],
    "european union": ["eu", "europe"],
    "ev": ["electric vehicle", "electric vehicles"],
    "electric vehicle": ["ev"],
    "electric vehicles": ["ev"],
    "ipo": ["initial public offering"],
    "initial public offering": ["ipo"],
    "m&a": ["mergers and acquisitions", "merger", "acquisition"],
    "mergers and acquisitions": ["m&a"],
    "ceo": ["chief executive officer"],
    "cfo": ["chief financial officer"],
    "cto": ["chief technology officer"],
    "covid-19": ["covid", "coronavirus"],
    "covid": ["covid-19", "coronavirus"],
    "coronavirus": ["covid", "covid-19"],
}
#: Words after a company's name that are no part of it; a dot after them goes with the punctuation.
COMPANY_SUFFIXES = ("inc", "corp", "corporation", "llc", "ltd", "limited", "co", "company", "group", "holdings", "technologies", "systems", "solutions", "motors", "airlines", "bank", "financial", "capital")
#: Words that are no keywords.
COMMON_WORDS = (
    "the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by", "a", "an", "is", "are", "was", "were", "be", "been", "being", "have", "has",
    "had", "do", "does", "did", "will", "would", "could", "should", "may", "might", "can", "this", "that", "these", "those", "i", "you", "he", "she", "it", "we", "they",
)
#: Tickers of fewer than three letters that count.
SHORT_TICKERS = ("BA", "GE", "GM", "AT", "T")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


@F.pandas_udf(T.StringType())
def nfkc(x: pd.Series) -> pd.Series:
    """Compatibility normal form, which has no built-in counterpart."""
    return x.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(T.StringType())
def unescape(x: pd.Series) -> pd.Series:
    """All character references decoded."""
    return x.map(lambda t: None if t is None else html.unescape(t))


def normal(x, quotes: bool = True) -> Column:
    """Lower case, dashes as hyphens and, unless `quotes` is off, curly quotes as straight ones. NFKC is a step of its own."""
    t = F.translate(F.lower(_c(x)), "–—", "--")
    return F.translate(t, "“”‘’", "\"\"''") if quotes else t


def with_possessives(x, unicode: bool = False) -> Column:
    """The text, followed by itself without each 's and by itself with both forms, where they differ."""
    w = r"(?U)(\w+)'s\b" if unicode else r"(\w+)'s\b"
    t = _c(x)
    off, both = F.regexp_replace(t, w, "$1"), F.regexp_replace(t, w, "$1's $1")
    return F.when(off == t, t).otherwise(F.concat_ws(" ", t, off, both))


def tokens(x, unicode: bool = False) -> Column:
    """Words, with the parts of a hyphenated word before it."""
    found = F.regexp_extract_all(_c(x), F.lit("(?U)" + TOKEN if unicode else TOKEN), F.lit(0))
    return F.flatten(F.transform(found, lambda w: F.when(F.contains(w, F.lit("-")), F.concat(F.split(w, "-"), F.array(w))).otherwise(F.array(w))))


def keep_tokens(xs, short=SHORT_WORDS) -> Column:
    trimmed = F.transform(_c(xs), lambda w: F.trim(w, F.lit('.,!?;:"()[]{}')))
    return F.filter(trimmed, lambda w: (F.length(w) >= 3) | w.isin(*short))


def unique_tokens(xs, most: int = 100) -> Column:
    return F.slice(F.array_distinct(_c(xs)), 1, most)


def phrases(xs, longest: int = 3) -> Column:
    """Runs of 2 to `longest` words, the shorter ones first."""
    t = _c(xs)

    def runs(n: int) -> Column:
        return F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), F.size(t) - n + 1), lambda i: F.array_join(F.slice(t, i, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))

    return F.concat(*[runs(n) for n in range(2, longest + 1)])


def synonym_closure(xs, table: dict[str, list[str]] = SYNONYMS) -> Column:
    """The words, their synonyms, and the synonyms of those; sorted, since the set has no order."""
    near = {k: sorted({k, *v, *(z for s in v for z in table.get(s, ()))}) for k, v in table.items()}
    known = F.create_map(*[x for k, v in near.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.array_sort(F.array_distinct(F.flatten(F.transform(_c(xs), lambda w: F.coalesce(F.try_element_at(known, w), F.array(w))))))


def company_name(x) -> Column:
    """A company's name in lower case, its suffixes, punctuation and white space made single spaces."""
    return F.trim(F.regexp_replace(F.lower(_c(x)), r"(?:\b(?:" + "|".join(COMPANY_SUFFIXES) + r")\b|[^\w\s]|\s)+", " "))


def company_in(x, name) -> Column:
    """What a lower-case text holds of a lower-case name: the whole, else a first word of 4 to 15 letters, else null; names of up to three letters are not looked for."""
    t, whole = _c(x), _c(name)
    first = F.substring_index(whole, " ", 1)
    return F.when(F.length(whole) <= 3, None).when(F.contains(t, whole), whole).when(F.length(first).between(4, 15) & F.contains(t, first), first)


def key_terms(xs) -> Column:
    """Distinct words of two letters or more of the phrases, and the phrases of up to 25 characters."""
    words = F.flatten(F.transform(_c(xs), lambda p: F.transform(F.split(p, r"[ \t\n\r\f]+"), lambda w: F.regexp_replace(F.lower(w), r"\W", ""))))
    return F.array_distinct(F.concat(F.filter(words, lambda w: F.length(w) >= 2), F.filter(_c(xs), lambda p: F.length(p) <= 25)))


def without_common(xs, tickers=None) -> Column:
    """Terms of 3 to 50 characters that are no common words, and tickers (an array in lower case) of two."""
    plain = lambda w: (F.length(w) > 2) & ~w.isin(*COMMON_WORDS)
    listed = (lambda w: F.array_contains(_c(tickers), w) & (F.length(w) >= 2)) if tickers is not None else lambda w: F.lit(False)
    return F.filter(_c(xs), lambda w: (plain(w) | listed(w)) & (F.length(w) <= 50))


def ticker_candidates(x) -> Column:
    """Distinct words of capitals that may be tickers; joined with the list of tickers by the caller."""
    found = F.array_distinct(F.filter(F.split(_c(x), "[^A-Za-z0-9_]+"), lambda w: w.rlike("^[A-Z]{1,5}$")))
    return F.filter(found, lambda w: (F.length(w) >= 3) | w.isin(*SHORT_TICKERS))


def ranked_keywords(xs, tickers, companies, most: int = 20, short: int = 10) -> Column:
    """Tickers, companies and words of up to `short` letters first, in their order, then the rest."""
    first = lambda w: F.array_contains(_c(tickers), w) | F.array_contains(_c(companies), w) | (F.length(w) <= short)
    return F.slice(F.concat(F.filter(_c(xs), first), F.filter(_c(xs), lambda w: ~first(w))), 1, most)
