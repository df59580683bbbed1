from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from compare import assert_same

from millrace.llm.divergence import OP13_SQL, op13_divergence, source_divergence


def brute(rows, min_docs, top):
    """Straight from the definitions, every term of every group."""
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        groups[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in c.items() if n >= min_docs) for lang, c in docs.items()}
    langs = defaultdict(Counter)
    for (lang, _), c in groups.items():
        langs[lang].update(c)

    def probs(c, terms):
        total = sum(c[t] for t in terms)
        return {t: 1 + 1000000000 * (c[t] + 5) // (total + 5 * len(terms)) for t in terms}

    out = []
    for (lang, source), c in groups.items():
        terms = kept.get(lang, [])
        p, q = probs(c, terms), probs(langs[lang], terms)
        found = [(p[t] - q[t], t) for t in terms if c[t] and p[t] > q[t]]
        pairs = [(sum(abs(p[t] - o[t]) for t in terms), s) for (la, s), other in groups.items() if la == lang and s != source for o in [probs(other, terms)]]
        for part, items, most in (("term", found, top), ("pair", pairs, None)):
            ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def test_matches_sql(spark, sf_dir, duck):
    assert_same(op13_divergence(spark, sf_dir), duck, OP13_SQL)


SOME = [("en" if k % 4 else "fr", f"s{k % 7}", " ".join(f"w{chr(97 + (k * j) % 23)} É{chr(97 + j % 5)}" for j in range(k % 40))) for k in range(200)]
CASES = {
    "some": SOME,
    "odd": [(None, None, None), ("", "a", "One one"), ("en", None, "one ONE oneé 3 x-ray"), ("en", "a", ""), ("en", "b", "zz " * 5000), ("x", "only", "one"), ("en", "a", "one two"), ("en", "a", "one two")],
    "ties": [("en", f"s{k % 3}", f"t{k % 3} common") for k in range(30)],
    "hot": [("en", "hot" if k % 3 else f"s{k % 30}", "the " * 20 + chr(97 + k % 26)) for k in range(300)],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize(("min_docs", "top", "small"), [(1, 3, False), (2, 50, True)])
def test_brute_force(spark, case, min_docs, top, small):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in CASES[case]], "lang string, source string, text string, value int, term string, rank int").repartition(3)
    got = source_divergence(df, min_docs=min_docs, top=top, **({"block": 2, "slice_": 3, "held": 4} if small else {}))
    assert sorted(map(tuple, got.collect())) == brute(CASES[case], min_docs, top)


def test_search_ends_early(spark, monkeypatch):
    """Buckets whose bounds are below the k-th value are never evaluated."""
    from millrace.llm import divergence

    seen = []
    plain = divergence.materialize
    monkeypatch.setattr(divergence, "materialize", lambda df, name: (seen.append(name), plain(df, name))[1])
    rows = [("en", f"s{s}", " ".join("t" + chr(97 + t // 26) + chr(97 + t % 26) for t in range(600) for _ in range(1 + (t * t // 300 if t % 2 == s else t // 100)))) for s in range(2)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    got = source_divergence(df, min_docs=1, top=5)
    assert sorted(map(tuple, got.collect())) == brute(rows, 1, 5)
    assert seen.count("best") <= 3


def test_empty(spark, empty):
    out = source_divergence(empty)
    assert out.count() == 0 and out.columns == ["lang", "source", "part", "item", "value", "rank"]
