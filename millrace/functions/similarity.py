"""Name similarity: Ratcliff/Obershelp ratio and the five scorers built on it.

The ratio has no built-in counterpart, so the scorers run as Arrow-fed UDFs.  They
are meant for candidate pairs against a short reference list, after exact keys
have been joined.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F

from ..operators.fuzzy import Rule, Scorer

#: What stands in names as the sources write them, and the accepted scores.
_OFFICE = re.compile(r"\s*\([^)]*(?:senator|representative)[^)]*\)", re.I)
_TITLE = re.compile(r"^(?:rep\.|sen\.|representative|senator)\s+")
_BRACKET = re.compile(r"\s*\[[^\]]+\]")
ACCEPT, ACCEPT_BY_PARTS = 0.85, 0.6


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def _flip(name: str) -> str | None:
    parts = [p.strip() for p in name.split(",")]
    return f"{parts[1]} {parts[0]}".strip() if len(parts) == 2 else None


def score_senate(name: str, ref: str, alts=()) -> float:
    """1 for the name, an alternative or its flip; else the ratio, 0.9 at least if one holds the other, and a flip's ratio if that is better."""
    n, r = _OFFICE.sub("", name.lower().strip()).strip(), ref.lower().strip()
    flipped = _flip(n)
    if n == r or flipped == r or n in {a.lower().strip() for a in alts}:
        return 1.0
    turned = ratio(flipped, r) if flipped else 0.0
    if turned > 0.9:
        return turned
    best = max(ratio(n, r), 0.9 if n in r or r in n else 0.0)
    return max(best, turned) if best < ACCEPT else best


def score_filing(name: str, ref: str, alts=()) -> float:
    """1 for the name, .95 for an alternative, else the ratio with a tenth more for equal last words."""
    n, r = name.lower(), ref.lower()
    if n == r:
        return 1.0
    if n in {a.lower() for a in alts}:
        return 0.95
    extra = 0.1 if n.split() and r.split() and n.split()[-1] == r.split()[-1] else 0.0
    return min(1.0, ratio(n, r) + extra)


def _part(given: str, known: str, exact: float, partial: float) -> float:
    g, k = given.strip().lower(), known.strip().lower()
    if not g or not k:
        return 0.0
    return exact if g == k else partial if g in k or k in g else 0.0


def listed(name: str) -> str:
    """A name of a roll or bill record without title and bracketed seat."""
    return _BRACKET.sub("", _TITLE.sub("", _OFFICE.sub("", name.lower().strip()))).strip()


def score_bill(name, ref, first="", ref_first="", last="", ref_last="", party="", ref_party="", state="", ref_state="", alts=()) -> float:
    """Half the name's score above .7, and shares for first and last name, party and state; a tenth more for three hits."""
    whole = score_senate(listed(name), ref, alts)
    hits = [0.5 * whole if whole > 0.7 else 0.0, _part(first, ref_first, 0.2, 0.15), _part(last, ref_last, 0.2, 0.15)]
    hits.append(0.1 if party.strip() and party.strip()[0].upper() == ref_party.strip()[:1].upper() else 0.0)
    hits.append(0.1 if state.strip() and state.strip().upper() == ref_state.strip().upper() else 0.0)
    return sum(hits) + (0.1 if sum(h > 0 for h in hits) >= 3 else 0.0)


def score_vote(name, ref, first="", ref_first="", last="", ref_last="", alts=()) -> float:
    """Half the ratio (1 for another name), and a fifth each for equal first and last names."""
    equal = lambda a, b: bool(a.strip()) and a.strip().lower() == b.strip().lower()
    n = listed(name)
    whole = 1.0 if n in {a.lower().strip() for a in alts} else ratio(n, ref.lower().strip())
    return 0.5 * whole + 0.2 * equal(first, ref_first) + 0.2 * equal(last, ref_last)


def score_house(name: str, first: str, middle: str, last: str, ref: str, alts=(), suffix: str = "", nicknames: dict[str, list[str]] | None = None) -> float:
    """1 for the name or for first (or a nickname of it) and last name (with its suffix), .95 for `Last, First`, else the ratio or .9 for a part."""
    table = nicknames or {}

    def forms(x: str) -> set[str]:
        back = next((k for k, v in table.items() if x in v), None)
        return {x, *table.get(x, ()), *([back] if back else ())}

    n, r, first, last = " ".join(name.lower().split()), ref.lower().strip(), first.lower().strip(), last.lower().strip()
    if n == r or n in {a.lower().strip() for a in alts}:
        return 1.0
    words = n.split()
    ends = {last, last + suffix.lower().strip()}
    if len(words) >= 2 and words[-1] in ends and forms(words[0]) & forms(first):
        return 1.0
    if "," in n:
        tail = n.split(",")[1].split()
        if tail and n.split(",")[0].strip() == last and forms(tail[0]) & forms(first):
            initial = middle.lower().strip()[:1]
            if len(tail) == 1:
                return 0.95
            if tail[1] in {middle.lower().strip(), initial, initial + "."} - {"", "."}:
                return 1.0
    return max(ratio(n, r), 0.9 if n in r or r in n else 0.0)


def _udf(scorer):
    def run(*cols: pd.Series) -> pd.Series:
        return pd.Series([float(scorer(*[("" if v is None else v) for v in row])) for row in zip(*cols, strict=True)])

    def two(a: pd.Series, b: pd.Series) -> pd.Series:
        return run(a, b)

    def three(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return run(a, b, c)

    def five(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series, e: pd.Series) -> pd.Series:
        return run(a, b, c, d, e)

    def six(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series, e: pd.Series, f: pd.Series) -> pd.Series:
        return run(a, b, c, d, e, f)

    typed = {2: two, 3: three, 5: five, 6: six}
    return lambda *xs: F.pandas_udf(typed[len(xs)], "double")(*xs)


def house_scorer(nicknames: dict[str, list[str]]):
    """The House score with a table of nicknames: of name, first, middle, last, reference and, if given, an array of other names."""
    return _udf(lambda *xs: score_house(*xs, nicknames=nicknames))


#: Columns in, a score out; the Senate, filing and House scores take an array of other names as a last column.
sim_ratio, senate_score, filing_score = _udf(ratio), _udf(score_senate), _udf(score_filing)
house_score = _udf(score_house)
vote_score, bill_score = _udf(score_vote), _udf(score_bill)


# ---------------------------------------------------------------- scorers with the rules of what they can accept


def _plain(k: int):
    return lambda row: (row[k].lower().strip(),)


def _senate_forms(row: tuple) -> tuple[str, ...]:
    n = _OFFICE.sub("", row[0].lower().strip()).strip()
    flipped = _flip(n)
    return (n,) if flipped is None else (n, flipped)


def _listed_forms(row: tuple) -> tuple[str, ...]:
    return _senate_forms((listed(row[0]),))


def _known(row: tuple, at: int) -> tuple[str, ...]:
    return (row[0].lower().strip(), *(a.lower().strip() for a in row[at] if a is not None))


#: Of (name) and (name, other names).
SENATE = Scorer(
    lambda a, b: score_senate(a[0], b[0], b[1]),
    (Rule("ratio", _senate_forms, _plain(0), ACCEPT), Rule("part", _senate_forms, _plain(0)), Rule("equal", _senate_forms, lambda b: _known(b, 1))),
    ACCEPT,
)
FILING = Scorer(
    lambda a, b: score_filing(a[0], b[0], b[1]),
    (Rule("ratio", lambda a: (a[0].lower(),), lambda b: (b[0].lower(),), ACCEPT - 0.1), Rule("equal", lambda a: (a[0].lower(),), lambda b: (b[0].lower(), *(x.lower() for x in b[1])))),
    ACCEPT,
)
#: Of (name, first, last, party, state) and (name, first, last, party, state, other names).
BILL = Scorer(
    lambda a, b: score_bill(a[0], b[0], a[1], b[1], a[2], b[2], a[3], b[3], a[4], b[4], b[5]),
    (
        Rule("ratio", _listed_forms, _plain(0), 0.7),
        Rule("part", _listed_forms, _plain(0)),
        Rule("equal", _listed_forms, lambda b: _known(b, 5)),
        # without the name a pair needs both its first and its last name
        Rule("part", lambda a: (a[2].strip().lower(),) if a[1].strip() and a[2].strip() else (), lambda b: (b[2].strip().lower(),) if b[1].strip() and b[2].strip() else ()),
    ),
    ACCEPT_BY_PARTS,
)
#: Of (name, first, last) and (name, first, last, other names): without an equal first or last name half a score is too little.
VOTE = Scorer(
    lambda a, b: score_vote(a[0], b[0], a[1], b[1], a[2], b[2], b[3]),
    (
        Rule("ratio", lambda a: (listed(a[0]),), _plain(0), 0.8),
        Rule("equal", lambda a: (listed(a[0]),), lambda b: _known(b, 3)),
        Rule("equal", lambda a: (f"{a[1].strip()}\n{a[2].strip()}".lower(),), lambda b: (f"{b[1].strip()}\n{b[2].strip()}".lower(),)),
    ),
    ACCEPT_BY_PARTS,
)


def house(nicknames: dict[str, list[str]] | None = None) -> Scorer:
    """Of (name) and (name, first, middle, last, suffix, other names)."""

    def ends(b: tuple) -> set[str]:
        last = b[3].lower().strip()
        return {last, last + b[4].lower().strip()}

    def own(a: tuple) -> tuple[str, ...]:
        return (" ".join(a[0].lower().split()),)

    def lasts(a: tuple) -> set[str]:
        n = own(a)[0]
        return {*n.split()[-1:], n.split(",")[0].strip()}

    return Scorer(
        lambda a, b: score_house(a[0], b[1], b[2], b[3], b[0], b[5], b[4], nicknames),
        (Rule("ratio", own, _plain(0), ACCEPT), Rule("part", own, _plain(0)), Rule("equal", own, lambda b: _known(b, 5)), Rule("equal", lasts, ends)),
        ACCEPT,
    )
