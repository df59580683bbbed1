"""How far the sources of a language differ: an upper-bound search for terms, postings for pairs.

Terms are counted inside tasks and summed over the corpus; a posting is a (language,
source, term) with its count.  Probabilities are whole parts of SCALE, so all
arithmetic is exact.

Top terms: the postings of a group fall into buckets by count.  The largest
probability of a bucket less the smallest probability that its terms have in the
language bounds their divergence.  Buckets are evaluated best first, a few more in
each round, and a group's search ends once the bounds of its unseen buckets are
strictly below its k-th value; only postings of buckets asked for are evaluated.

Pairs: postings are dealt by (slice of terms, two blocks of sources).  A task lays
the probabilities of its terms into a matrix of bounded size, where a term that a
source lacks has the source's probability of nothing, and adds up the differences of
its pairs of sources.  Terms that neither block has differ alike and are multiplied.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import _LOWER, materialize, table

SCALE, SMOOTH, MIN_DOCS, TOP = 1_000_000_000, 5, 30, 50
#: Entries that a task holds before it sends them; postings in a slice of terms; sources in a block; terms in a strip of the matrix.
HELD, SLICE, BLOCK, STRIP = 400_000, 4_000, 256, 1024
_TERM, _TABLE = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"), _LOWER.tobytes()


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group and the group's documents that hold it."""

    def emit(groups: dict) -> pa.RecordBatch:
        rows = [(lang, source, term, n, found[term]) for (lang, source), (counts, found) in groups.items() for term, n in counts.items()]
        lang, source, term, n, found = zip(*rows, strict=True)
        text = [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*text, pa.array(n, pa.int64()), pa.array(found, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def count(batches):
        groups, size = {}, 0
        for b in batches:
            for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                terms = _TERM.findall(bytes(text).translate(_TABLE))
                if not terms:
                    continue
                counts, found = groups.setdefault((lang, source), (Counter(), Counter()))
                before = len(counts)
                counts.update(terms)
                found.update(set(terms))
                size += len(counts) - before
                if size >= held:
                    yield emit(groups)
                    groups, size = {}, 0
        if groups:
            yield emit(groups)

    told = docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return told.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * terms)) in decimals, exact for any count; null where no term is kept."""
    part = f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + {SMOOTH} AS DECIMAL(20,0)) div CAST({total} + {SMOOTH} * {terms} AS DECIMAL(20,0))"
    return F.expr(f"CASE WHEN {terms} > 0 THEN 1 + ({part}) END")


# ---------------------------------------------------------------- terms


def top_terms(probs: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a group holds and has oftener than its language, by difference."""
    group = ["lang", "source"]
    buckets = probs.groupBy(*group, "bucket").agg((F.max("p") - F.min("q")).alias("bound"), F.count(F.lit(1)).alias("size")).filter("bound > 0")
    first = Window.partitionBy(*group).orderBy(F.desc("bound"), "bucket")
    before = F.coalesce(F.sum("size").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Any search must see k terms; from there on each round takes twice as many buckets as the one before.
    buckets = buckets.withColumn("late", F.sum((before >= top).cast("int")).over(first))
    buckets = materialize(buckets.withColumn("round", F.when(F.col("late") == 0, 0).otherwise(1 + F.floor(F.log2("late"))).cast("int")), "buckets")
    rounds = buckets.agg(F.max("round")).first()[0]
    best = None
    for r in range(0 if rounds is None else rounds + 1):
        asked = buckets.filter(F.col("round") == r).select(*group, "bucket", "bound")
        if best is not None:
            kth = best.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("kth")).filter(F.col("n") == top)
            asked = asked.join(kth, group, "left").filter(F.col("bound") >= F.coalesce("kth", F.lit(1)))
            if asked.isEmpty():  # bounds fall from round to round, so no group has any left
                break
        found = probs.join(asked.select(*group, "bucket"), [*group, "bucket"]).filter("p > q").select(*group, F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        found = found if best is None else best.select(*found.columns).unionByName(found)
        place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("value"), "item"))
        best = materialize(found.withColumn("rank", place).filter(F.col("rank") <= top), "best")
    return probs.sparkSession.createDataFrame([], "lang string, source string, item string, value long, rank int") if best is None else best


# ---------------------------------------------------------------- pairs


def tile(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Sums of |p_a - p_b| over the terms of a slice that a source of either block holds, for pairs a < b between its two blocks."""
    lang, _, i, j = key
    right = right.drop_duplicates("idx").sort_values("idx")
    idx, absent, block = right["idx"].to_numpy(), right["absent"].to_numpy(), right["block"].to_numpy()
    term, terms = pd.factorize(left["term"])
    at = np.searchsorted(idx, left["idx"].to_numpy())
    p, order = left["p"].to_numpy(), np.argsort(term, kind="stable")
    rows, cols = np.flatnonzero(block == i), np.flatnonzero(block == j)
    sums = np.zeros((len(rows), len(cols)), np.int64)
    for lo in range(0, len(terms), STRIP):
        here = order[np.searchsorted(term[order], lo) : np.searchsorted(term[order], lo + STRIP)]
        matrix = np.tile(absent, (min(STRIP, len(terms) - lo), 1))
        matrix[term[here] - lo, at[here]] = p[here]
        others = matrix[:, cols]
        for k, a in enumerate(rows):
            sums[k] += np.abs(others - matrix[:, a : a + 1]).sum(0)
    a, b = np.meshgrid(idx[rows], idx[cols], indexing="ij")
    up = a < b
    return pd.DataFrame({"lang": lang, "a": a[up], "b": b[up], "sum": sums[up], "seen": len(terms)})


def pair_values(probs: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): for each two sources of a language the sum of their differences over all kept terms."""
    key = ["lang", "slice", "i", "j"]
    all_blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = probs.withColumn("slice", F.pmod(F.xxhash64("term"), "slices")).withColumn("other", all_blocks)
    dealt = dealt.select("lang", "slice", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "term", "idx", "p")
    lacks = groups.filter("terms > 0").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))).withColumn("other", all_blocks)
    lacks = lacks.select("lang", "slice", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "idx", "block", "absent")
    sums = dealt.groupBy(*key).cogroup(lacks.groupBy(*key)).applyInPandas(tile, "lang string, a int, b int, sum long, seen long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("sum").alias("sum"), F.sum("seen").alias("seen"))
    one = groups.withColumn("other", all_blocks).select("lang", "source", "idx", "absent", "terms", "other")
    two = groups.select(F.col("lang").alias("__lang"), F.col("source").alias("item"), F.col("idx").alias("__idx"), F.col("absent").alias("__absent"), F.col("block").alias("__block"))
    both = one.join(two, (F.col("lang") == F.col("__lang")) & (F.col("other") == F.col("__block")) & (F.col("idx") != F.col("__idx")))
    both = both.withColumn("a", F.least("idx", "__idx")).withColumn("b", F.greatest("idx", "__idx")).join(sums, ["lang", "a", "b"], "left")
    lacking = (F.col("terms") - F.coalesce("seen", F.lit(0))) * F.abs(F.col("absent") - F.col("__absent"))
    return both.select("lang", "source", "item", (F.coalesce("sum", F.lit(0)) + F.coalesce(lacking, F.lit(0))).cast("long").alias("value"))


def source_divergence(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK, slice_: int = SLICE, held: int = HELD) -> DataFrame:
    """lang, source, part, item, value, rank for each (lang, source) that occurs.

    A null text, language or source is ''.  Terms are runs of letters and of
    characters beyond ASCII, A-Z lower-cased; a language keeps those that min_docs
    of its documents hold.  p of a term in a group: see probability.  Part `pair`:
    each other source of the language by the sum of |p - p'| over all kept terms (0
    where none is kept).  Part `term`: the `top` kept terms that occur in the group
    with p above that of the language, by the difference.  Ranks go by falling
    value, then item.  A language of one source has no pairs, one without kept terms
    no terms; an empty table gives no rows.  Repeated rows count each time.
    """
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counted = materialize(term_counts(docs, held), "terms")
    in_lang = Window.partitionBy("lang", "term")
    posts = counted.withColumn("of_lang", F.row_number().over(in_lang.orderBy("source"))).withColumn("lang_n", F.sum("n").over(in_lang)).withColumn("docs", F.sum("docs").over(in_lang)).filter(F.col("docs") >= min_docs)
    posts = materialize(posts.select("lang", "source", "term", "n", "lang_n", (F.col("of_lang") == 1).cast("long").alias("first")), "postings")

    totals = posts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = posts.groupBy("lang").agg(F.sum("first").alias("terms"), F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("posts"))
    groups = docs.select("lang", "source").distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    groups = groups.withColumn("idx", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).withColumn("sources", F.count(F.lit(1)).over(Window.partitionBy("lang")))
    groups = groups.withColumn("block", F.floor(F.col("idx") / block).cast("int")).withColumn("blocks", F.ceil(F.col("sources") / block).cast("int"))
    # A slice holds more postings where a task has more pairs to add up.
    width = F.least("sources", F.lit(block).cast("long"))
    groups = groups.withColumn("slices", F.ceil(F.col("posts") / (F.lit(slice_) + width * width)).cast("long"))
    groups = materialize(groups.withColumn("absent", probability("0", "total", "terms")), "groups")
    probs = posts.join(groups, ["lang", "source"]).withColumn("p", probability("n", "total", "terms")).withColumn("q", probability("lang_n", "lang_total", "terms"))
    # Four buckets for each doubling of the count.
    probs = probs.withColumn("bucket", F.floor(4 * F.log2("n")).cast("int")).select("lang", "source", "term", "p", "q", "bucket", "idx", "block", "blocks", "slices")
    probs = materialize(probs, "probabilities")

    cols = ["lang", "source", "part", "item", "value", "rank"]
    terms = top_terms(probs, top).withColumn("part", F.lit("term")).select(*cols)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(probs, groups).withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(by_value)).select(*cols)
    return terms.unionByName(pairs)


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents
), words AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs
), kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= {MIN_DOCS}
), langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), posts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM docs)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM posts GROUP BY lang, source) USING (lang, source)
), probs AS (
  SELECT g.lang, g.source, k.term, coalesce(p.n, 0) AS n,
    1 + CAST({SCALE} AS HUGEINT) * (coalesce(p.n, 0) + {SMOOTH}) // (g.total + {SMOOTH} * l.v) AS p,
    1 + CAST({SCALE} AS HUGEINT) * (k.n + {SMOOTH}) // (l.total + {SMOOTH} * l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN posts p ON p.lang = g.lang AND p.source = g.source AND p.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM probs x JOIN probs y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) d
    ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
), every AS (
  SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM probs WHERE n > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= {TOP}
"""
