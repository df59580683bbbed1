from __future__ import annotations

import html
import random
import re

import pytest

from millrace.llm.html_extract import extract, main_text

ARTICLE = "<article><h1>Title</h1><p>First para &amp; more of it, long enough to count.</p><p>Ok.</p></article>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain words", "plain words"),
        (f"<nav><a>Home</a></nav>{ARTICLE}<footer>&copy; x</footer>", "Title First para & more of it, long enough to count. Ok."),
        (f"<header><h1>Site</h1></header><div class='cookie-notice'>We use cookies, a long text about cookies.</div><main>{ARTICLE}</main><aside>side</aside>", "Title First para & more of it, long enough to count. Ok."),
        (f"{ARTICLE}<section class='comments'><article class='comment'><p>{'A reader says much. ' * 40}</p></article></section>", "Title First para & more of it, long enough to count. Ok."),
        ("<article><p>a<br>b  c</p><script>var t='</p>'</script><form><label>x</label></form><p>d</p>", "a b c d"),
        (f"<div class='page has-sidebar'>{ARTICLE}<div class='sidebar'><p>{'Side text of some length. ' * 3}</p></div></div>", "Title First para & more of it, long enough to count. Ok."),
        ("<div id='content' class='no-sidebar'><h1>Head</h1><p>" + "Plain text here. " * 20 + "</p><p>End.</p></div><footer>foot</footer>", "Head " + "Plain text here. " * 20 + "End."),
        (f"<div class='search-page'><main>{ARTICLE.replace('article', 'div')}</main></div>", "Title First para & more of it, long enough to count. Ok."),
        (f"<form id='aspnetForm'><nav><a>Home</a></nav>{ARTICLE}<label>Search</label><input></form>", "Title First para & more of it, long enough to count. Ok."),
        (f"<main>{ARTICLE}<article><p>A second article, short.</p></article></main><div class='ad'>buy</div>", "Title First para & more of it, long enough to count. Ok. A second article, short."),
        (f"<article><div class='comment-enabled'><h2>In</h2><p>{'Some words of text. ' * 30}</p></div></article>", "In " + ("Some words of text. " * 30).strip()),
        ("<body><nav><a>one</a><a>two</a></nav><form><p>Write to us about all you like, at length.</p><label>Name</label></form><footer>foot</footer></body>", ""),
        (f"<div class='post'><p>{'The post itself. ' * 30}</p></div><div class='comments'><p>{'Readers talk a lot here. ' * 80}</p></div>", ("The post itself. " * 30).strip()),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>cut <b", "cut"),
        ("<div id='menu'><a>a</a></div><div><p>" + "Long text here. " * 20 + "</p></div>", ("Long text here. " * 20).strip()),
        ("<article><ul><li>one</li><li>two</li></ul><p hidden>no</p><div style='display:none'>no</div>&nbsp;end</article>", "one two end"),
        (f"<article>{'<p>A line of the article.</p>' * 4}</article><section><h2>What others wrote</h2><p>{'Much longer words of readers. ' * 60}</p></section>", " ".join(["A line of the article."] * 4)),
        ("<article><p>One.</p><p class='share-price'>Shares at 12.</p><div class='search-and-rescue'>They searched.</div><section id='related-work'>Earlier work.</section><div class='share-buttons'>Tweet</div><div class='ad-box'>Buy this now.</div></article>", "One. Shares at 12. They searched. Earlier work."),
        ("<div><article><p>First of two.</p></article></div><section><div><article><p>Second of two.</p></article></div></section>", "First of two. Second of two."),
        ("<article><p>Press <button>the red one</button> to stop.</p><p>Done. <button>Share</button></p><button>Send</button></article>", "Press the red one to stop. Done."),
        ("<form class='page'><p>" + "w" * 50 + "</p></form>", "w" * 50),
        ("<form class='page'><p>" + "w" * 5000 + "</p></form>", "w" * 5000),
        ("<form><input type='hidden'><h1>Title of it</h1><p>Text of it.</p><label>Search</label><input></form>", "Title of it Text of it."),
        ("<div class='layout has-sidebar'><div class='sidebar-widget'>side</div><p>" + "Words of it. " * 20 + "</p></div>", ("Words of it. " * 20).strip()),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_whole_table_against_markup(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r for r in extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        body = re.sub(r"<[^>]*>?", "", re.sub(r"</?(p|br|h1)\b[^>]*>", "\n", body))
        want = " ".join(html.unescape(body).split())
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


@pytest.mark.parametrize("change", [lambda h: h.replace("<article>", "<div>").replace("</article>", "</div>"), lambda h: h.replace("<article>", "<section class='post with-sidebar'>").replace("</article>", "</section>"), lambda h: h.replace("<body>", "<body><div class='layout no-sidebar'><form id='aspnetForm'>")])
def test_pages_without_the_telling_markup(spark, sf_dir, change):
    """The cluster finds the same text where no element says that it is the article."""
    rows = [r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    same = [main_text(change(h)) == main_text(h) for h in rows]
    assert sum(same) >= 0.97 * len(same)


def made_page(rnd: random.Random) -> tuple[str, str]:
    """A page of random parts, and its article's blocks by one space: the generator knows what is what."""
    words = lambda n: " ".join(rnd.choice("alpha beta gamma delta eps zeta eta".split()) for _ in range(n))
    sentence = lambda: words(rnd.randrange(1, 30)) + "."
    junk = ["<nav><ul><li><a>Home</a></li><li><a>{0}</a></li></ul></nav>", "<div class='cookie-notice'>{0}</div>", "<aside><p>{0}</p></aside>", "<form><label>{0}</label><input><button>Go</button></form>", "<div id='ad-box'>{0}</div>", "<script>{0}</script>", "<footer>{0}</footer>", "<ul class='share-buttons'><li>{0}</li></ul>", "<div hidden>{0}</div>", "<!-- {0} -->"]
    noise = lambda: rnd.choice(junk).format(words(rnd.randrange(1, 60)))
    truth, inside = [], []
    for _ in range(rnd.randrange(1, 9)):
        if rnd.random() < 0.2:
            inside.append(noise())
            continue
        text = sentence()
        name = rnd.choice(["", " class='share-price'", " class='search-and-rescue'", " id='related-work'", " class='lead has-ad'", " class='no-comments'"])
        shape = rnd.choice(["<p{1}>{0}</p>", "<div{1}><p>{0}</p></div>", "<h2{1}>{0}</h2>", "<ul><li{1}>{0}</li></ul>", "<section{1}><p>{0}", "<blockquote{1}>{0}</blockquote>"])
        inside.append(shape.format(text.replace(" ", rnd.choice([" ", "\n  ", " <b>", " &nbsp;"]), 1), name) + ("</section>" if "<section" in shape else ""))
        truth.append(text)
    if not truth:
        truth, inside = ["only."], [*inside, "<p>only.</p>"]
    article = "<article>" + "".join(inside) + "</article>"
    for _ in range(rnd.randrange(3)):
        article = rnd.choice(["<div class='layout with-sidebar'>{}</div>", "<main>{}</main>", "<form id='aspnetForm'>{}</form>", "<section>{}</section>"]).format(article)
    readers = f"<section class='comments'><article class='comment'><p>{words(200)}</p></article></section>" if rnd.random() < 0.4 else ""
    page = "".join(noise() for _ in range(rnd.randrange(4))) + article + readers + "".join(noise() for _ in range(rnd.randrange(3)))
    return f"<html><head><title>t</title></head><body>{page}</body></html>", " ".join(truth)


@pytest.mark.parametrize("seed", range(8))
def test_made_pages(seed):
    rnd = random.Random(seed)
    for _ in range(120):
        page, want = made_page(rnd)
        assert main_text(page) == want, page


def test_odd_rows(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<article>" + "<p>very long text " * 20_000, "y"), (3, "u", "<<<>>><!-- <!DOCTYPE", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(df).collect()
    assert len(got) == 4 and got[0]["text"] == "" and got[2]["n_chars"] == 20_000 * 15 - 1
    assert extract(df.limit(0)).count() == 0
