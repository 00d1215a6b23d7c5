import re
import time
from html import unescape

import pytest

from tidematch.llm import html

PROSE = "This is the story of a man and the sea that was in his dreams for all of the years. "


def test_article_without_furniture():
    page = f"""<!DOCTYPE html><head><title>T</title><style>p{{}}</style></head><body>
    <header>Site name</header><nav><a href=/a>Home</a> <a href=/b>About</a></nav>
    <!-- <p>{PROSE}</p> --><div class="ad">{PROSE * 4}</div>
    <article><h1>Heading &amp; more</h1><p><b>{PROSE}<br><p>Short.<p>A  b&nbsp;c &lt;d&gt;
    <script>var t="</p><p>{PROSE}";</script><p>{PROSE * 3}</article>
    <section id=comments><p>{PROSE * 4}</p></section><form><p>{PROSE}</p></form>
    <footer>&copy; x</footer>"""
    long = " ".join((PROSE * 3).split())
    assert html.main_text(page) == "\n\n".join(
        ["Heading & more", PROSE.strip(), "Short.", "A b c <d>", long]
    )


def test_without_an_article_the_rules_decide():
    page = (
        "<body><div class='sidebar'>Some text in the sidebar</div><div id=content><h2>Title here</h2>"
        f"<p>{PROSE * 4}</p><p>Short one.</p></div><ul><li><a href=x>One</a><li><a href=y>Two</a></ul>"
        "<div class='cookie-notice'>We use cookies</div>"
    )
    assert html.main_text(page).split("\n\n") == ["Title here", (PROSE * 4).strip(), "Short one."]


def test_an_article_of_short_or_odd_blocks_stays():
    assert html.main_text("<nav>x</nav><article><p>Und.<p>a | b | c</article>") == "Und.\n\na | b | c"


def test_broken_and_long_pages():
    assert html.main_text(None) == html.main_text("") == html.main_text("<p></p>") == ""
    assert html.main_text("<article><p>cut &am") == "cut &am"
    for page in ("<" * 100_000, '<a "' * 30_000, "<script>" * 20_000, "<div>" * 20_000 + "x"):
        html.main_text(page)


def test_rows(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'own' AS text", "'own' AS n_chars"
    )
    got = sorted(html.extract(pages).collect(), key=str)
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in got] == [
        (1, "a", 1), (1, "a", 1), (2, "", 0), (None, "", 0)
    ]
    assert html.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<div class='layout with-sidebar'><p>{}</p></div>",
        "<article class='post no-promo'><p>{}</p></article>",
        "<section class='ads-free content'><p>{}</p></section>",
        "<div id=main data-x=share><p>{}</p></div>",
        "<p>{}</p>",
        "<div class='sidebar'><article><p>{}</p></article></div>",
        "<div class='site-overlay'><div><p>{}</p></div></div><p>Short.</p>",
    ],
)
def test_names_are_read_whole_and_not_believed_blindly(page):
    text = (PROSE * 4 + "© 1999 " + PROSE).strip()
    assert text in html.main_text(f"<body>{page.format(text)}</body>")


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "cookie-notice box", "x ad", "leftNav", "post_comments"])
def test_furniture_names(name):
    page = f"<body><div class='{name}'><p>{PROSE * 3}</p></div><article><p>{PROSE * 4}</p></article></body>"
    assert html.main_text(page) == (PROSE * 4).strip()


def test_comments_longer_than_the_article_go():
    page = f"<article><p>{PROSE * 4}</p></article><div id='comments'>{f'<p>{PROSE * 6}</p>' * 9}</div>"
    assert html.main_text(page) == (PROSE * 4).strip()


def test_stop_words_decide_inside_an_article_too():
    lists = "<li>" + "<a href=x>Some words of another page here and so on</a> " * 3
    odd = "zzxq vbrt kkll mmnn ppqq " * 6
    page = f"<article><ul>{lists}</ul><p>{odd}</p><ul>{lists}</ul></article><p>{PROSE * 4}</p>"
    assert html.main_text(page) == (PROSE * 4).strip()
    assert odd.strip() in html.main_text(f"<article><p>{PROSE * 4}</p><p>{odd}</p></article>")


def test_long_attributes_take_linear_time():
    for attributes in ("id= " * 300_000, "class=a " * 150_000, "a=b " * 300_000, " " * 1_000_000, "=" * 1_000_000):
        for page in (f"<div {attributes}>x", f"<div class='{attributes}'>x"):
            began = time.time()
            html.main_text(page)
            assert time.time() - began < 2


def test_articles_of_the_given_pages(spark):
    """Recall and precision in blocks, an article's own blocks being the right ones."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()
    right = found = both = 0
    for page in pages:
        article = re.search(r"<article[^>]*>(.*)</article>", page["html"], re.S)
        if article is None:
            continue
        parts = re.split(r"</?(?:p|h\d|ul|ol|li|div|blockquote|section|table|tr|td|br|pre)\b[^>]*>", article[1])
        wanted = {" ".join(unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts} - {""}
        got = {x for b in html.main_text(page["html"]).split("\n\n") for x in [" ".join(b.split())] if x}
        right, found, both = right + len(wanted), found + len(got), both + len(wanted & got)
    assert right > 10_000
    assert both / right > 0.97 and both / found > 0.97
