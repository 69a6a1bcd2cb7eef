"""Pages with the text that is expected of them."""

from __future__ import annotations

import time

import pytest

from orderlens.llm.main_text import extracted, main_text

LINE = "A paragraph, with commas, long enough to count for the page."
P = f"<p>{LINE}</p>"
SIDE = "<div class=sidebar><p>Side stuff, which is long, but is not the text of the page.</p></div>"

PAGES = {
    "form around the page": (
        f"<body><form action=x><input type=hidden>{SIDE}{P * 3}<label>Your name</label><select><option>A</select><button>Go</button></form>",
        [LINE] * 3,
    ),
    "form for a search": (
        f"<div><form><label>Search the whole site, please, with a long, long label</label><input></form>{P * 2}</div>",
        [LINE] * 2,
    ),
    "form in a form's label": (f"<form>{P * 3}<div><label>Mail <b>address</b></label> here</div></form>", [*[LINE] * 3, "here"]),
    "a short section beside a long one": (
        f"<section><h2>One</h2>{P * 9}</section><section><h2>Two</h2>{P}</section>", ["One", *[LINE] * 9, "Two", LINE],
    ),
    "links between paragraphs": (
        f"<div>{P * 2}<ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul>{P}</div>", [LINE, LINE, "one", "two", LINE],
    ),
    "links behind the text": (f"<div>{P * 2}<ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul></div>", [LINE] * 2),
    "headline in the page header": (f"<header><h1>The headline</h1><p>Menu</p></header><div>{P * 2}</div>", ["The headline", *[LINE] * 2]),
    "logo in the page header": (f"<header><h1><a href=/>Site</a></h1></header><div>{P * 2}</div>", [LINE] * 2),
    "heading in the text": (f"<header><h1>Site</h1></header><div><h2>Two</h2>{P * 2}</div>", ["Two", *[LINE] * 2]),
    "comment without an end": (f"<div>{P * 2}</div><!-- <p>no text, and no text, and no text at all, of course.</p>", [LINE] * 2),
    "marks in a script": (f"<script>var x = '<!-- ';</script><div>{P * 2}</div><style>a{{}}</style>", [LINE] * 2),
    "cut off in a tag": (f"<div>{P * 2}<a href='x", [LINE] * 2),
    "short paragraphs of an article": ("<article><h1>One</h1><p><b>Two<br><p>Three</p></article><footer>No</footer>", ["One", "Two", "Three"]),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_page(name):
    html, want = PAGES[name]
    assert main_text(html).split("\n") == want


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 100_000 + P, "<a" * 500_000, "<div>" * 40_000 + "</x>" * 150_000 + P, "<article>" * 20_000 + P * 1000,
        ("<div>" + P) * 12_000, "<!--" * 250_000, "<script>" * 120_000, "<p>x" + "<b>" * 300_000, "<ul><li>" * 60_000 + "x",
        "<label>" * 50_000 + "<form>" * 1000 + "<label>" * 60_000,
    ],
    ids=lambda h: h[:14],
)
def test_time_grows_with_the_length_of_hostile_pages(html):
    """A page of up to a megabyte, whatever its nesting; the bound is ten times what a slow machine takes."""
    start = time.process_time()
    main_text(html)
    assert time.process_time() - start < 20


def test_pages_with_other_columns_and_none(spark):
    rows = [(1, "u", P * 2), (None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars", "3 as `a.b`")
    assert [(r.page_id, r.text, r.n_chars) for r in extracted(frame).orderBy("page_id").collect()] == [
        (None, "", 0), (1, f"{LINE}\n{LINE}", 2 * len(LINE) + 1),
    ]
    assert extracted(frame.where("false")).count() == 0
