"""HTML extraction on odd layouts, pages without hints, odd rows, and its query."""

import re

import pytest
from pyspark.sql import functions as F

from shelfmatch.llm import html, queries

LONG = [f"{c} {'word ' * 80}".strip() for c in "abcdefgh"]
NAV = "<nav><ul>" + "".join(f"<li><a href=/>menu {i}</a></li>" for i in range(5)) + "</ul></nav>"
FOOT = "<footer>&copy; someone, some rights reserved, and so on and on</footer>"


def p(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


CASES = {
    "a class that contains a word": (f"<div class='content has-sidebar'><article>{p(LONG)}</article></div>", LONG),
    "a wrapper with a telling class": (f"<div class='content sidebar'><article>{p(LONG)}</article></div>", LONG),
    "a section's id": (
        f"<article>{p(LONG[:4])}<section id='search-algorithms'><h2>Search</h2>{p(LONG[4:])}</section></article>",
        [*LONG[:4], "Search", *LONG[4:]],
    ),
    "ids of headings": (
        f"<article>{p(LONG[:4])}<h2 id='related-work'>Related</h2>{p(LONG[4:6])}<h2 id='notice'>Notice</h2>{p(LONG[6:])}</article>",
        [*LONG[:4], "Related", *LONG[4:6], "Notice", *LONG[6:]],
    ),
    "an article's header": (f"<article><header><h1>A title</h1></header>{p(LONG)}</article>", ["A title", *LONG]),
    "math and label": (
        f"<article><p>Let <math><mi>x</mi></math> be {LONG[0]} <label>named</label></p>{p(LONG[1:])}</article>",
        [f"Let x be {LONG[0]} named", *LONG[1:]],
    ),
    "a paragraph that is a link": (
        f"<article>{p(LONG[:4])}<p><a href=/>The whole paragraph is one link</a></p>{p(LONG[4:])}</article>",
        [*LONG[:4], "The whole paragraph is one link", *LONG[4:]],
    ),
    "nested divs with short paragraphs": (
        f"<div><div><h1>T</h1><div>{p(LONG[:3])}</div><div>{p(['one', 'two'])}</div><div>{p(LONG[3:])}</div></div></div>",
        ["T", *LONG[:3], "one", "two", *LONG[3:]],
    ),
    "comments and a notice": (
        f"<article>{p(LONG)}</article><section id='comments'>{p(LONG[:3])}</section><div class='cookie'><p>Cookies, {LONG[0]}</p></div>",
        LONG,
    ),
    "two articles": (f"<main><article>{p(LONG[:3])}</article><article>{p(LONG[3:])}</article></main>", LONG),
    "all in a widget": (f"<div class='widget'>{p(LONG)}</div>", LONG),
    "a form around the page": (f"<form><div>{p(LONG)}</div></form>", LONG),
    "a menu without a name": (
        f"<div>{''.join(f'<div><a href=/>to page {i}</a></div>' for i in range(6))}</div><div>{p(LONG)}</div>", LONG,
    ),
    "hidden text": (f"<article>{p(LONG)}<p hidden>{LONG[0]}</p><p style='display: none'>x</p></article>", LONG),
}


@pytest.mark.parametrize("case", CASES)
def test_layouts(case):
    body, want = CASES[case]
    assert html.main_text(f"<body>{NAV}{body}{FOOT}</body>") == "\n\n".join(want)


def test_short_article_before_a_long_footer():
    foot = f"<footer>&copy; {'word ' * 30}</footer>"
    page = f"<body>{NAV}<div class='ad'>Buy this.</div><article><h1>A title.</h1><p>Text of it.</p></article>{foot}"
    assert html.main_text(page) == "A title.\n\nText of it."


def test_nothing_but_marked_text():
    for page in (None, "", NAV, FOOT, NAV + FOOT, f"<aside>{LONG[0]}</aside>", "<script>x</script>", "<p> \n </p>"):
        assert html.main_text(page) == ""


def plain(page):
    """The page without a name that says what a part is."""
    return re.sub(r"<(/?)(nav|article|footer)>", r"<\1div>", page).replace('class="ad"', "")


def test_pages_without_hints(spark, data):
    """Ratio and clustering alone find most articles; what is found of the others holds the article."""
    pages = [r.html or "" for r in spark.read.parquet(f"{data}/pages.parquet").collect()]
    with_hints = [html.main_text(x) for x in pages]
    without = [html.main_text(plain(x)) for x in pages]
    same = sum(a == b for a, b in zip(with_hints, without))
    assert same >= 0.5 * len(pages) and sum(a in b for a, b in zip(with_hints, without)) >= 0.8 * len(pages)


def test_region():
    lines = [html.Line("x" * n, 0, 1, c, ()) for n, c in ((50, 1), (60, 2), (10, 2), (70, 3), (30, 4))]
    content = [False, True, False, True, False]
    assert html.content_region(lines, content, [0, 0, 0, 2, 2]) == {2, 3, 4}
    assert html.content_region(lines, [True] * 5, [0, 0, 0, 2, 2]) == {0, 1, 2, 3, 4}


def test_tables(spark):
    page = f"<article>{p(LONG)}</article>"
    rows = [(1, page, "a"), (1, page, "a"), (None, None, "b"), (3, "", None), (4, "<p>é &amp; 🙂</p>", "d")]
    rows += [(5, f"<article>{p(LONG * 400)}</article>", "long"), (6, "<div>" * 3000 + "deep", "e"), (7, "<" * 9000, "f")]
    df = spark.createDataFrame(rows, "id int, html string, main string").withColumns(
        {"_row": F.lit(1), "_html": F.lit("x"), "text": F.lit(None).cast("int")}
    )
    got = html.extract(df.repartition(3))
    assert got.columns == ["id", "_row", "_html", "text", "main"]
    found = sorted(((r.id or 0, r.main.text, r.main.n_chars) for r in got.collect()))
    want = sorted((i or 0, html.main_text(h), len(html.main_text(h))) for i, h, _ in rows)
    assert found == want and len({r for r in found if r[0] == 1}) == 1
    assert html.extract(df.limit(0)).count() == 0


def test_query(spark, data):
    """The given pages have one article each, of which everything is kept."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.op2_html_extraction(spark, data).collect()}
    assert got.keys() == pages.keys()
    for i, r in pages.items():
        inside = re.search("<article>(.*)</article>", r.html, re.DOTALL)[1]
        blocks = [html.Lines() for _ in (0,)]
        blocks[0].feed(inside)
        want = "\n\n".join(x.text for x in blocks[0].finish())
        assert (got[i].url, got[i].text, got[i].n_chars) == (r.url, want, len(want))
