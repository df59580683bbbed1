"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

The standard library's parser streams a page once.  Text between two block-level
tags is a line; its ratio is its characters over the tags met in it, a part of that
where an element's name says menu, notice or the like.  The ratios of a page are
smoothed with a Gaussian, and lines above a threshold taken from their spread form
the content cluster.  Where elements say that they are articles (or the main part),
they are the region; else the deepest element that holds most of the cluster is.  The
region's lines are the result, so that its short paragraphs are not lost.

A name marks an element if all of it says so: each of its words is one of menus,
notices or the like, or of layout (`cookie-notice`, `share-buttons`), so that
`share-price` and `has-sidebar` do not.  A marked element is left out unless it is a
wrapper, which holds all articles of the page, or a body that holds most of the
cluster.  A form is one if nothing in it can be filled in, or if it frames a page.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Standard deviation of the smoothing in lines, the threshold as a part of the spread of the smoothed ratios,
#: the weight of lines in elements of a telling name, and the part of the cluster that makes an element its region.
SIGMA, SPREAD, NAMED, MOST = 1.0, 0.5, 0.25, 0.6

#: Elements whose text is never content, those that frame a page, and those that hold content.
HIDDEN = ("head", "script", "style", "noscript", "template", "iframe", "svg", "button", "select", "textarea", "label", "legend", "object", "canvas", "audio", "video", "map")
FRAME = ("nav", "footer", "aside", "dialog", "menu")
HOLDERS = ("body", "div", "section", "article", "main", "header", "form", "td")
#: Elements inside a line; all others end it.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in a class, id or role that mark an element as no content.
NOISE = frozenset((
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
    "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "nav", "navbar",
    "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "masthead", "comment",
    "comments", "reply", "replies", "disqus", "share", "sharing", "social", "related", "recommended",
    "newsletter", "subscribe", "signup", "login", "popup", "modal", "overlay", "widget", "pagination",
    "pager", "toolbar", "contentinfo", "complementary", "search",
))
#: Words of layout, which say nothing beside one of those.
LAYOUT = frozenset((
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "card", "cards", "col", "column",
    "container", "content", "form", "group", "header", "icon", "icons", "inner", "item", "items", "left",
    "link", "links", "list", "main", "module", "outer", "panel", "posts", "primary", "right", "row",
    "secondary", "section", "site", "slot", "stories", "text", "title", "top", "unit", "wrap", "wrapper",
))
#: Those that tell of readers or trade where an article has such a name.
READERS = frozenset(("comment", "comments", "ad", "ads", "related"))
#: What is filled in, and what frames a page but no form.
FIELDS, FRAMES = ("select", "textarea", "label"), ("nav", "header", "footer", "aside", "article", "main", "h1")
UNFILLED = ("hidden", "submit", "button", "reset", "image")
_WORDS = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
#: A tag that the end of the page cuts off.
_CUT = re.compile(r"<[A-Za-z/!?][^<>]*\Z")
#: What an unclosed one of these is closed by.
_SELF_CLOSING = {"p": frozenset("p div ul ol table section article h1 h2 h3 h4 h5 h6 blockquote pre form hr header footer nav aside main".split()), "li": frozenset(("li",)), "dd": frozenset(("dd", "dt")), "dt": frozenset(("dd", "dt")), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "tr": frozenset(("tr",)), "option": frozenset(("option",))}


#: How an element is marked: not, as a form, by its name, by its kind, as invisible.
CLEAR, FORM, NAME, KIND, UNSEEN = range(5)


class Lines(HTMLParser):
    """Collects (text, tags, element) for each line, and (tag, parent, mark) for each element that may hold or spoil content; element 0 is the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, int, int]] = []
        self.elements: list[tuple[str, int, int]] = [("page", -1, CLEAR)]
        self.open: list[tuple[str, int]] = []  # tag, the element around it
        self.here, self.text, self.tags, self.depth = 0, [], 0, 0
        self.forms: dict[int, list[bool]] = {}  # whether a form has something to fill in, whether it frames a page
        self.button: list[str] | None = None  # words of a button inside a sentence, which count if the sentence goes on
        self.pressed = False

    def end_line(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            if line:
                self.rows.append((line, self.tags, self.here))
            self.text.clear()
            self.tags = 0
        self.button, self.pressed = None, False

    def handle_starttag(self, tag, attrs):
        if tag == "button" and "".join(self.text).strip() and not self.around("form"):
            self.button, self.pressed = [], True
            self.tags += 1
            return
        if tag not in INLINE:
            self.end_line()
        self.tags += 1
        while self.open and tag in _SELF_CLOSING.get(self.open[-1][0], ()):
            self.leave()
        fills = tag in FIELDS or tag == "input" and (dict(attrs).get("type") or "").lower() not in UNFILLED
        if fills or tag in FRAMES:
            for form in self.around("form"):
                self.forms[form][0 if fills else 1] = True
        if tag in VOID:
            return
        mark = self.mark(tag, attrs)
        if mark or tag in HOLDERS or tag in _SELF_CLOSING:
            self.open.append((tag, self.here))
            if mark or tag in HOLDERS:
                self.end_line()
                self.elements.append((tag, self.here, mark))
                self.here = len(self.elements) - 1
                if tag == "form":
                    self.forms[self.here] = [False, False]

    def mark(self, tag, attrs) -> int:
        if tag in HIDDEN:
            return UNSEEN
        out = KIND if tag in FRAME or tag == "header" and not self.around("article", "main") else FORM if tag == "form" else CLEAR
        for k, v in attrs if tag not in ("html", "body") else ():
            if k == "hidden" or k == "aria-hidden" and v == "true" or v and k == "style" and _HIDDEN.search(v.lower()):
                return UNSEEN
            if v and k in ("class", "id", "role"):
                for name in v.lower().split():
                    words = set(_WORDS.findall(name))
                    if words & (READERS if tag in ("article", "main") else NOISE) and words <= NOISE | LAYOUT:
                        out = max(out, NAME)
        return out

    def around(self, *tags) -> list[int]:
        """The open elements of these tags."""
        at, out = self.here, []
        while at > 0:
            if self.elements[at][0] in tags:
                out.append(at)
            at = self.elements[at][1]
        return out

    def leave(self) -> None:
        self.end_line()
        self.here = self.open.pop()[1]

    def handle_endtag(self, tag):
        if tag == "button" and self.pressed:
            self.pressed = False
            return
        if tag not in INLINE:
            self.end_line()
        self.tags += 1
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                while len(self.open) > k:
                    self.leave()
                break
            if self.open[k][0] in ("article", "main") and tag in ("p", "li", "td", "tr"):
                break

    def handle_data(self, data):
        if self.pressed:
            self.button.append(data)
            return
        if self.button and data.strip():
            self.text += self.button
            self.button = None
        self.text.append(data)


def smoothed(ratio: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel)[reach:-reach]
    return np.convolve(ratio, kernel)[reach:-reach] / weight


def region(p: Lines, size: np.ndarray, cluster: np.ndarray) -> tuple[set[int], list[int]]:
    """(elements whose lines are left out, elements that hold the article; none: the cluster itself)."""
    n = len(p.elements)
    parent = [e[1] for e in p.elements]
    mass, words = np.zeros(n), np.zeros(n)  # characters of the cluster, and of all lines, in each element with all inside it
    at = np.array([r[2] for r in p.rows])
    np.add.at(mass, at, size * cluster)
    np.add.at(words, at, size)
    marks = [e[2] for e in p.elements]
    hidden = [False] * n
    for k in range(1, n):
        hidden[k] = hidden[parent[k]] or marks[k] == UNSEEN
    for k in range(n - 1, 0, -1):
        if not hidden[k]:
            mass[parent[k]] += mass[k]
            words[parent[k]] += words[k]

    def held(k: int, inside: int) -> bool:
        while k > inside:
            k = parent[k]
        return k == inside

    def out_of() -> list[bool]:
        left = [False] * n
        for k in range(1, n):
            left[k] = hidden[k] or left[parent[k]] or marks[k] != CLEAR
        return left

    bodies = [k for k in range(n) if p.elements[k][0] in ("article", "main") and marks[k] == CLEAR and not hidden[k]]
    if any(p.elements[b][0] == "article" for b in bodies):
        bodies = [b for b in bodies if p.elements[b][0] == "article"]
    for k in range(1, n):
        if marks[k] not in (FORM, NAME) or hidden[k]:
            continue
        inside = [b for b in bodies if b > k and held(b, k)]
        if inside and (len(inside) == len(bodies) if marks[k] == FORM else 2 * max(mass[b] for b in inside) >= mass[k] and 2 * mass[k] >= mass[0]):
            marks[k] = CLEAR  # a wrapper
        elif marks[k] == FORM and not bodies and (not p.forms[k][0] or p.forms[k][1]):
            left = out_of()
            others = sum(s for s, c, r in zip(size, cluster, p.rows, strict=True) if c and not left[r[2]])
            if 4 * others <= mass[k] > 0:
                marks[k] = CLEAR
    gone = {k for k, out in enumerate(out_of()) if out}
    mains = [k for k in range(n) if p.elements[k][0] == "main" and marks[k] == CLEAR]
    for holders in (bodies, mains):
        found = [b for b in holders if b not in gone and words[b] > 0]
        if found:
            return gone, [b for b in found if not any(a != b and held(b, a) for a in found)]
    clear = np.zeros(n)
    np.add.at(clear, at, size * cluster * np.array([r[2] not in gone for r in p.rows]))
    for k in range(n - 1, 0, -1):
        clear[parent[k]] += clear[k]
    top = 0
    while True:
        inner = [k for k in range(top + 1, n) if parent[k] == top and k not in gone and clear[k] >= MOST * clear[0] > 0]
        if not inner:
            return gone, [top] if top and p.elements[top][0] != "body" else []
        top = inner[0]


def main_text(html: str, sigma: float = SIGMA, spread: float = SPREAD) -> str:
    """The article's text, its lines joined by one space; empty if there is none."""
    p = Lines()
    p.feed(_CUT.sub("", html))
    p.close()
    p.end_line()
    rows = p.rows
    if not rows:
        return ""
    weight = [1.0] * len(p.elements)
    for k in range(1, len(weight)):
        _, up, mark = p.elements[k]
        weight[k] = 0.0 if mark == UNSEEN else min(weight[up], NAMED if mark else 1.0)
    size = np.array([len(r[0]) if weight[r[2]] else 0 for r in rows], float)
    heavy = size * np.array([weight[r[2]] for r in rows])
    ratio = smoothed(heavy / np.array([max(1, r[1]) for r in rows], float), sigma)
    cluster = (ratio >= spread * ratio.std()) & (size > 0)
    gone, holds = region(p, size, cluster)
    live = [k for k, r in enumerate(rows) if r[2] not in gone]
    if holds:
        within = set(holds)
        for k in range(holds[0] + 1, len(p.elements)):
            if p.elements[k][1] in within:
                within.add(k)
        return " ".join(rows[k][0] for k in live if rows[k][2] in within)
    chosen = [k for k in live if cluster[k]]
    if not chosen:
        return ""
    # no element holds the article alone: the cluster's lines, and short ones between them
    return " ".join(rows[k][0] for k in live if chosen[0] <= k <= chosen[-1] and (cluster[k] or rows[k][1] <= 2))


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """page_id, the columns in keep, text and n_chars (code points) for each page.

    Null and empty pages give an empty text.  A page cut off anywhere gives the
    text up to there.  Repeated rows are extracted alike; an empty table gives no
    rows.
    """
    picked = df.select(F.col(id_col).alias("page_id"), *[F.col(k).alias(k) for k in keep], F.col(html_col).cast("string").alias("__html"))
    names = ["page_id", *keep]

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                texts = [main_text(x) if x else "" for x in part.column("__html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(k) for k in names] + [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*names, "text", "n_chars"])

    return picked.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields if f.name != "__html") + ", text string, n_chars long")


def op4_extract(spark, sf_dir: str) -> DataFrame:
    from .base import table

    return extract(table(spark, sf_dir, "pages"))
