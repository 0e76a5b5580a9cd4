"""Page differencing where pages have an article, and where copies stand next to each other."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from tallyspan.llm import html_text  # noqa: E402


def texts(spark, pages):
    df = spark.createDataFrame([(k, url, page) for k, (url, page) in enumerate(pages)], "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in html_text.extract(df).collect()}


def own(k):
    return f"the body text of page {k} with words of its own"


def test_body_outside_the_article(spark):
    """A teaser card is an article; the body in a div stays, what neighbours share goes."""
    page = "<div>Site line</div><article>Teaser {}</article><div>{}</div><div>Contact</div>"
    got = texts(spark, [(f"http://h/a/{k}", page.format(k, own(k))) for k in range(4)])
    assert got == {k: f"Teaser {k}\n\n{own(k)}" for k in range(4)}


@pytest.mark.parametrize("copies", [2, 5])
def test_copies_as_neighbours(spark, copies):
    page = "<div>Site line</div><p>{}</p><div>Contact</div>"
    pages = [(f"http://h/a/b/{k}", page.format(own(0))) for k in range(copies)] + [("http://h/z", page.format(own(1)))]
    got = texts(spark, pages)
    assert got == {**{k: own(0) for k in range(copies)}, copies: own(1)}


def test_no_neighbour_leaves_marks_to_decide(spark):
    assert texts(spark, [("http://h/a", "<div>open</div><article>inside</article>")]) == {0: "inside"}
