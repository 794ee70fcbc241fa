"""Links over blocks, inline mathematics, deep pages, comments in plain divisions."""

from __future__ import annotations

import time

import pytest

from disclosure_spark.llm import mincut

FIRST = "This is the first long sentence of the article, and it goes on. And more text follows here, with several words."
LAST = "Let us see what comes of it in the end, after all that was said. It is a good one."
ARTICLE = f"<article><h1>Title here</h1><p>{FIRST}</p><p>{LAST}</p></article>"
TEXT = f"Title here\n\n{FIRST}\n\n{LAST}"


@pytest.mark.parametrize(
    "around",
    [
        "<div><a href='/1'><h3>Linked headline one</h3></a><a href='/2'><h3>Another linked headline</h3></a></div>{}",
        "{}<div class='thread'><div><b>joe</b><p>I liked this article a lot. Thanks for it!</p></div></div>",
        "{}<a href='/next'><div><p>Read this other long article next. It has many words in it, as well.</p></div></a>",
        "<a name='top'>{}",  # no link, and never closed
        "<div><a href='/open'>Home</div>{}",  # never closed, but its element is
    ],
)
def test_pages(around):
    assert mincut.main_text(f"<html><body>{around.format(ARTICLE)}</body></html>") == TEXT


def test_mathematics_stays_in_its_sentence():
    page = f"<article><h1>Title here</h1><p>{FIRST}</p><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be a number, and go on with it. It is a good one.</p></article>"
    assert mincut.main_text(page).endswith("Let x=2 be a number, and go on with it. It is a good one.")
    noted = page.replace("</mn>", "</mn><annotation encoding='tex'>x = 2</annotation>")
    assert mincut.main_text(noted) == mincut.main_text(page)


def test_a_link_lasts_over_blocks():
    found = {b.text: b.linked for b in mincut.blocks("<div><a href='x'><h2>one</h2><p>two</p></a><p>three</p></div><p>four</p>")}
    assert found == {"one": 3, "two": 3, "three": 0, "four": 0}


@pytest.mark.parametrize("shape", ["<div>x", "<ul><li>x", "<div>x</b></section>", "<b><div>x</div>", "<p>x", "<table><tr><td>x"])
def test_work_grows_with_the_page(shape):
    def seconds(n):
        began = time.process_time()
        mincut.main_text("<html><body>" + shape * n)
        return time.process_time() - began

    seconds(1000)
    # Eight times the page: eight times the work, not sixty-four.
    assert seconds(32_000) < 24 * max(seconds(4000), 0.05)


def test_long_texts_and_odd_tables(spark):
    long = "Word after word it goes on. " * 40_000
    rows = [(1, "u", f"<p>{long}</p>"), (1, "u", None), (None, None, ""), (2, "v", "<p>only < text & more"), (2, "v", "<p>only < text & more")]
    df = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = mincut.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = got.collect()
    assert len(found) == 5 and max(r.n_chars for r in found) == len(long.strip())
    assert [r.text for r in found if r.page_id is None] == [""]
    assert mincut.extract(df.limit(0)).collect() == []
