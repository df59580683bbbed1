from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import words

from millrace.llm.graph import components
from millrace.llm.jaccard_join import count_bin, fragment_of, jaccard_components, keep_one, overlaps


def brute(rows, n: int, percent: int) -> list[tuple]:
    """(shingles, component, links) of each row."""
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            holders[g].append(k)
    parent, links = list(range(len(rows))), Counter()

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, s in enumerate(sets):
        for j, both in Counter(j for g in s for j in holders[g] if j > k).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                links[k] += 1
                links[j] += 1
                parent[root(j)] = root(k)
    least: dict = {}
    for k, (i, _) in enumerate(rows):
        r = root(k)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    return [(len(sets[k]), least[root(k)], links[k]) for k in range(len(rows))]


@pytest.mark.parametrize(("n", "percent", "sizes"), [(3, 90, {}), (5, 80, {"chunk_bytes": 9_000, "range_bytes": 9_000, "block": 2}), (2, 50, {"block": 3})])
def test_matches_brute_force(docs, n, percent, sizes):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r for r in jaccard_components(docs, n_words=n, percent=percent, **sizes).collect()}
    assert [(got[i]["n_shingles"], got[i]["component_id"], got[i]["n_links"]) for i, _ in rows] == brute(rows, n, percent)


def test_chain_of_near_copies_in_blocks(spark):
    """Neighbours link, others do not; the one component is found although no class is near all."""
    base = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(25):
        w = list(base)
        for j in range(k):
            w[j * 12] = f"x{j}"
        rows.append((100 + k, " ".join(w)))
    rows += [(500, rows[3][1]), (501, rows[3][1].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in jaccard_components(df, block=4, chunk_bytes=3000, range_bytes=5000).collect()}
    assert [(got[i]["n_shingles"], got[i]["component_id"], got[i]["n_links"]) for i, _ in rows] == brute(rows, 3, 90)
    assert len({r["component_id"] for r in got.values()}) == 1


def test_odd_rows(odd, empty, spark):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = Counter((i, *x) for (i, _), x in zip(rows, brute(rows, 3, 90), strict=True))
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard_components(odd).collect())
    assert got == want
    assert jaccard_components(empty).count() == 0
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "6", "8", "None"])


def test_overlaps_add_up_over_fragments():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 1 << 63, 300)[rng.integers(0, 300, rng.integers(1, 200))]).astype(np.uint64) for _ in range(12)]
    pool = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    sets += [np.unique(pool[rng.integers(0, 300, rng.integers(1, 200))]) for _ in range(20)]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(32), np.arange(32)))
    a, b = a[a != b], b[a != b]
    want = [len(np.intersect1d(sets[x], sets[y])) for x, y in zip(a, b, strict=True)]
    count = {int(g): int(sum(g in s for s in sets)) for g in np.concatenate(sets)}
    mass = np.linspace(0, 1, 257)
    part = [fragment_of(np.array([count[int(g)] for g in s]), s, mass, 5) for s in sets]
    assert set(np.concatenate(part)) <= set(range(5))
    summed = sum(overlaps([s[p == f] for s, p in zip(sets, part, strict=True)], a, b, strip=64) for f in range(5))
    assert (summed == want).all() and (overlaps(sets, a, b) == want).all()


def test_fragments_follow_the_order():
    """A rarer n-gram never lies in a later fragment, and all fragments are used alike."""
    rng = np.random.default_rng(1)
    count, grams = rng.geometric(0.3, 20_000) + 1, rng.integers(0, 1 << 63, 20_000).astype(np.uint64) * np.uint64(2)
    mass = np.append(0, np.cumsum(np.bincount(count_bin(count), minlength=256))) / len(count)
    part = fragment_of(count, grams, mass, 4)
    order = np.lexsort((grams, count_bin(count)))
    assert (np.diff(part[order]) >= 0).all() and np.bincount(part).min() > 4000


def test_words_that_collide_under_a_polynomial_do_not_link(spark):
    bits = [bin(k).count("1") & 1 for k in range(8192)]
    rows = [(1, "".join("ab"[x] for x in bits)), (2, "".join("ba"[x] for x in bits)), (3, "x y z " + "".join("cd"[x] for x in bits)), (4, "x y z " + "".join("dc"[x] for x in bits))]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4}


def test_near_copies_at_the_threshold(spark):
    """Links start exactly at the threshold: of 100 shingles, 95 shared by both are 90.5 %, 94 are 88.7 %."""
    base = [f"w{k}" for k in range(102)]
    changed = lambda n: [*base[: 102 - n], *[f"x{n}y{k}" for k in range(n)]]
    rows = [(1, " ".join(base)), (2, " ".join(changed(5))), (3, " ".join(changed(6)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard_components(df).orderBy("doc_id").collect()]
    assert got == brute(rows, 3, 90) and [c for _, c, _ in got] == [1, 1, 3]


def test_long_chain_in_small_blocks(spark):
    """A cluster far larger than a block: only blocks that share a key are compared, and all links are found."""
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(600):
        rows.append((k, " ".join(base)))
        base[(7 * k) % 120] = f"n{k}"
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in jaccard_components(df, block=64, block_bytes=40_000, fragments=3).collect()}
    assert [(got[i]["n_shingles"], got[i]["component_id"], got[i]["n_links"]) for i, _ in rows] == brute(rows, 3, 90)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 101), (105, 101), (7, 7), (None, 3)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 1), 100: 100, 101: 100, 105: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_null_and_repeated_ids_with_different_texts(spark):
    """Rows are judged by their texts: a shared or missing id neither joins nor drops different ones."""
    text = [" ".join(f"t{k}w{j}" for j in range(60)) for k in range(6)]
    near = lambda t: t + " more"
    rows = [(None, text[0]), (None, text[1]), (None, near(text[1])), (None, near(text[0]) + " of"), (7, text[2]), (7, text[3]), (8, near(text[3])), (9, text[4]), (9, text[4]), (None, near(text[4])), (None, None), (None, ""), (None, ""), (3, near(text[2])), (5, text[5]), (5, near(text[5]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = Counter((i, *x) for (i, _), x in zip(rows, brute(rows, 3, 90), strict=True))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard_components(df).collect()) == want
    kept = Counter((r["doc_id"], r["text"]) for r in keep_one(df).collect())
    five = [(i, t) for i, t in kept if i == 5]
    assert len(five) == 1 and five[0][1] in rows[14] + rows[15]
    pick = lambda k: [(i, t) for i, t in kept if i is None and t and t.startswith(f"t{k}w")]
    assert len(pick(0)) == len(pick(1)) == 1
    rest = kept - Counter(five) - Counter(pick(0)) - Counter(pick(1))
    assert rest == Counter({(3, near(text[2])): 1, (7, text[3]): 1, (9, text[4]): 1, (None, None): 1, (None, ""): 2})
