"""The similarity join against brute force: the same best match, ties and all, for each scorer."""

from __future__ import annotations

import random

import pytest

from millrace.functions import similarity
from millrace.operators import fuzzy

FIRST = "ann bob carl dora emil faye greg hana ivan jo kim lea max nina otto paul quin rosa stan tom uma vera walt michael robert".split()
LAST = "smith johnson brown davis wilson moore taylor thomas white harris martin garcia clark lewis walker hall young king wright scott".split()


def people(rnd, n):
    return [(rnd.choice(FIRST), rnd.choice(["", "a.", "james"]), rnd.choice(LAST) + rnd.choice(["", "son", "er", "s", "ez"])) for _ in range(n)]


def full(first, middle, last):
    return " ".join(x for x in (first, middle, last) if x).title()


def slip(rnd, text):
    for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
        k = rnd.randrange(len(text) + 1)
        text = rnd.choice([text[:k] + text[k + 1 :], text[:k] + rnd.choice("abxyz ,é") + text[k:]])
    return text


def written(rnd, first, middle, last):
    text, kind = slip(rnd, full(first, middle, last)), rnd.random()
    return slip(rnd, f"{last}, {first}") if kind < 0.2 else f"{text} (Senator)" if kind < 0.3 else f"Rep. {text} [D-NY-1]" if kind < 0.4 else text


def sides(rnd, n_names, n_refs):
    refs = people(rnd, n_refs)
    who = [rnd.choice(refs) if rnd.random() < 0.6 else people(rnd, 1)[0] for _ in range(n_names)] + [("", "", ""), ("x", "", "")]
    return [written(rnd, *w) for w in who], who, refs, [[f"{f[:3]} {x}"] if rnd.random() < 0.3 else [] for f, _, x in refs]


def cases(rnd, n_names=120, n_refs=80):
    texts, who, refs, alts = sides(rnd, n_names, n_refs)
    some = lambda *xs: rnd.choice(xs)
    names = [full(*r) for r in refs]
    return {
        "senate": (similarity.SENATE, [(t,) for t in texts], list(zip(names, alts, strict=True))),
        "filing": (similarity.FILING, [(t,) for t in texts], list(zip(names, alts, strict=True))),
        "house": (similarity.house({"michael": ["mike"], "robert": ["bob"]}), [(t,) for t in texts], [(n, *r, some("", "jr"), a) for n, r, a in zip(names, refs, alts, strict=True)]),
        "bill": (similarity.BILL, [(t, some(w[0], "", w[0][:2]), some(w[2], "", slip(rnd, w[2])), some("D", "R", " "), some("NY", "")) for t, w in zip(texts, who, strict=True)], [(n, r[0], r[2], some("Democrat", "R", ""), some("NY", "TX", ""), a) for n, r, a in zip(names, refs, alts, strict=True)]),
        "vote": (similarity.VOTE, [(t, some(w[0], ""), some(w[2], "")) for t, w in zip(texts, who, strict=True)], [(n, r[0], r[2], a) for n, r, a in zip(names, refs, alts, strict=True)]),
    }


def brute(names, refs, scorer, accept):
    out = []
    for k, name in enumerate(names):
        best, at = 0.0, -1
        for r, ref in enumerate(refs):
            score = scorer.score(name, ref)
            if score > best:
                best, at = score, r
        if at >= 0 and best >= accept:
            out.append((k, at, best))
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("kind", ["senate", "filing", "house", "bill", "vote"])
def test_scorers_against_brute_force(kind, seed):
    scorer, names, refs = cases(random.Random(seed))[kind]
    got, scored = fuzzy.best_of(names, refs, scorer, scorer.accept)
    assert got == brute(names, refs, scorer, scorer.accept) and got
    assert scored < 0.1 * len(names) * len(refs)


def test_few_pairs_are_scored_of_a_long_list():
    rnd = random.Random(7)
    texts, _, refs, alts = sides(rnd, 60, 6000)
    rows = [(full(*r), a) for r, a in zip(refs, alts, strict=True)]
    names = [(t,) for t in texts if t]
    got, scored = fuzzy.best_of(names, rows, similarity.SENATE, 0.85)
    assert scored < 0.05 * len(names) * len(rows)
    assert got[:15] == brute(names[:20], rows, similarity.SENATE, 0.85)[:15]


@pytest.mark.parametrize("least", [0.4, 0.75, 0.85, 1.0])
def test_bounds_lose_no_pair(least):
    rnd = random.Random(int(100 * least))
    texts = ["".join(rnd.choice("abcdé -.") for _ in range(rnd.randrange(14))) for _ in range(250)] + ["a" * 30, "ab" * 20]
    held = fuzzy.Texts(list(enumerate(texts)))
    for a in texts[::3]:
        may, within = set(held.reach(a, least).tolist()), set(held.parts(a).tolist())
        assert {k for k, b in enumerate(texts) if similarity.ratio(a, b) >= least} <= may
        assert {k for k, b in enumerate(texts) if a in b or b in a} <= within


@pytest.mark.parametrize(("slice_rows", "block_rows"), [(5000, 20000), (7, 9)])
def test_join(spark, slice_rows, block_rows):
    """Text ids, ties, repeated and null names, clashing scores, columns of both sides; slices and blocks change nothing."""
    rnd = random.Random(3)
    texts, _, refs, alts = sides(rnd, 60, 40)
    rows = [(f"S{k:06d}", full(*r), a or None, k / 2) for k, (r, a) in enumerate(zip(refs, alts, strict=True))]
    rows += [("A" + r[0][1:], *r[1:]) for r in rows[:10]] + [(None, rows[11][1], None, None)]  # ties: A.. comes first, no id last
    left = [(k, t) for k, t in enumerate([*texts, *texts[:5], None])]
    ldf = spark.createDataFrame(left, "k long, name string")
    rdf = spark.createDataFrame(rows, "bioguide string, ref_name string, alts array<string>, weight double").repartition(3)
    out = fuzzy.nearest(ldf, rdf, similarity.SENATE, ["name"], ["ref_name", "alts"], "bioguide", slice_rows=slice_rows, block_rows=block_rows)
    assert out.columns == ["k", "name", "bioguide", "ref_name", "alts", "weight", "score"]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or ""))
    want = {left[k][0]: (*order[r], s) for k, r, s in brute([(t or "",) for _, t in left], [(r[1], r[2] or ()) for r in order], similarity.SENATE, 0.85)}
    assert {r["k"]: tuple(r)[2:] for r in out.collect()} == want
    assert fuzzy.nearest(ldf.limit(0), rdf, similarity.SENATE, ["name"], ["ref_name", "alts"], "bioguide").count() == 0
    assert fuzzy.nearest(ldf, rdf.limit(0), similarity.SENATE, ["name"], ["ref_name", "alts"], "bioguide").count() == 0


def test_nearest_makes_no_product(spark):
    df = spark.createDataFrame([(1, "a")], "k long, name string")
    ref = spark.createDataFrame([(1, "a", ["b"])], "r long, ref_name string, alts array<string>")
    plan = fuzzy.nearest(df, ref, similarity.SENATE, ["name"], ["ref_name", "alts"], "r")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
