"""Marks in doubt, articles in marked elements, broken attributes, long pages; differencing beside plain Python."""

import sys
import time
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from tallyspan.llm import html_text  # noqa: E402
from tallyspan.llm.queries import QUERIES  # noqa: E402

SCHEMA = "page_id bigint, url string, html string"


@pytest.mark.parametrize(
    "page, text",
    [
        ('<article class="post comments-open"><p>body</p></article>', "body"),
        ('<div class="container notice-period"><p>body</p></div>', "body"),
        ('<div class="container notice-period"><article><p>body</p></article></div>', "body"),
        ('<article><p id="search-results">one</p><div class="social-history">two</div></article>', "one\n\ntwo"),
        ('<div class="page-widget"><article><p>body</p><div class=share>no</div></article></div>', "body"),
        ('<div class="related"><article>card</article></div><article>body</article>', "body"),
        ('<article>body<article class="comment">no</article><div class="comment-list">no</div></article>', "body"),
        ('<div class="comments"><article>no</article></div><p>body</p>', "body"),
        ('<div class="cookie-banner">no</div><div class="site-footer">no</div><div class="related-posts">no</div><p>body</p>', "body"),
        ('<div class="newsletter-signup-2">no</div><div id="social-links">no</div><p>body</p>', "body"),
        ('<div hidden><article>no</article></div><p>body</p>', "body"),
        ('<p class="x>hello', "hello"),
        ('<p class="x>hello</p><p>more</p>', "hello\n\nmore"),
        ("<p title=it's>hello</p><p title=that's>more</p>", "hello\n\nmore"),
        ('<p title="a > b">hello</p>', "hello"),
        ("<p it's>hello <b don't>you</b></p>", "hello you"),
        ('<script src="x>var a = 1;</script><p>hello</p>', "hello"),
        ("<script data-a='</script>'>no()</script><p>hello</p>", "hello"),
        ("<p>a &lt; b</p><p", "a < b"),
        ("", ""),
    ],
)
def test_marks(page, text):
    assert html_text.main_text(page) == text


def test_blocks_in_doubt_that_neighbours_share_go(spark):
    page = '<article><p>{}</p><div class="share-this">Tell your friends</div><div class="notice-period">{}</div></article>'
    rows = [(k, f"http://h/a/{k}", page.format(f"the body of page {k} " * 9, f"until day {k}")) for k in range(4)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: f"{' '.join([f'the body of page {k}'] * 9)}\n\nuntil day {k}" for k in range(4)}


def test_unclosed_quotes_and_long_pages_take_linear_time():
    start = time.time()
    assert html_text.main_text('<p a="' * 30_000 + "end") is not None
    assert html_text.main_text("<p a='b\" c=" * 30_000) is not None
    long = "<article>" + "".join(f"<p class='k{k}'>text {k}</p>" for k in range(100_000)) + "</article>"
    assert html_text.main_text(long).count("\n\n") == 99_999
    assert time.time() - start < 30


def test_query_beside_plain_python(spark):
    """Every page of the smallest tables, with neighbours found by sorting in plain Python."""
    folder = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()
    place = lambda u: (u.split("://", 1)[1] + "/").split("/", 1)
    order = sorted(pages, key=lambda p: (place(p.url)[0].lower(), "/" + place(p.url)[1].rstrip("/"), p.page_id))
    read = {p.page_id: html_text.read_blocks(p.html or "") for p in pages}
    sides = {i: {"hashes": [t for t, _ in b], "sizes": [len(t) for t, _ in b], "kinds": [k for _, k in b]} for i, b in read.items()}
    wanted = {}
    for k, page in enumerate(order):
        near = [o for o in order[max(0, k - 1) : k] + order[k + 1 : k + 2] if place(o.url)[0] == place(page.url)[0]]
        wanted[page.page_id] = html_text.main_text(page.html or "", html_text.flipped(sides[page.page_id], [sides[o.page_id] for o in near]))
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op9_html_text"](spark, folder).collect()}
    assert got == {i: (t, len(t)) for i, t in wanted.items()}
