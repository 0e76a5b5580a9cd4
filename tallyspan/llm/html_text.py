"""Operator 9, HTML extraction with nearest-URL page differencing.

Every page is read into visible blocks in page order.  Within a host, pages are sorted by
URL path and each is compared with the page before and after it whose text differs, the one with
the nearer path (more leading path parts in common) first; the first that is no copy decides.
The blocks of the pair are aligned by longest common subsequence, and open blocks that both
share are deleted: what stands in the same order on two pages is the site's, not the article's.
Open blocks outside an article that the page does have are kept if its neighbour does not share them.

Two things limit the deletion.  Blocks inside an article or main element are the text
itself and stay, and pages of which most text is shared are copies of each other,
so neither decides over the other.  Menus, headers, footers, sidebars, notices, adverts, forms and
comments that are marked as such go in any case, shared or not.

A mark in the middle of a longer name (``search-results``, ``notice-period``) only raises doubt: outside an
article such blocks are open like any other, inside it they stay unless the neighbour shares them.  An
article or main element is never marked by its own class, but for reader comments; one inside an
element marked by class counts if the page has nothing else.  A quote opens a value only after an equals
sign, as in browsers, and one that is never closed ends with its tag.

Hosts of any size are sorted by range slices; only block hashes travel to be aligned.

Defined results: NULL html is empty text; pages without url, or alone in their host, are
cleaned by marks alone (open blocks go if there is an article); repeated rows each give their row; markup that breaks off ends with
the page; an empty table gives no rows; columns beyond the three are ignored.
"""

from __future__ import annotations

import html as references
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import kept, query, row_keys, small_batches, table
from tallyspan.llm.warc import bounded_broadcast
from tallyspan.operators.skew import SLICE, ordered_slices

# A pair of pages with more than this share of the smaller one's open text in common is
# taken for two copies of one page.
COPY = 0.5

# Elements and names that mark what is not the article.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head nav aside footer form button select option menu dialog title label fieldset".split())
SILENT = "script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|textarea"
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright disclaimer disqus footer form gdpr login masthead menu modal nav navbar navigation "
    "newsletter notice notices pagination pager popup promo promoted promotion recommended related replies responses search "
    "share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies responses".split())
# Words that leave the meaning of a mark before them as it is.
GENERIC = frozenset(
    "area bar block body box button buttons card cards col column container content group header heading icon icons inner item "
    "items label left link links list main message outer overlay page panel post posts right row section text title top "
    "widget wrap wrapper".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

ATTRIBUTES = r"(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:{SILENT})\b{ATTRIBUTES}(?:(?<=/)>|>.*?(?:</(?:{SILENT})\s*>|\Z))"
    rf"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<([/!?]?)([a-zA-Z][\w:-]*)({ATTRIBUTES})(?:>|\Z|(?=<))|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([\w:-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NAME = re.compile(r"[a-z0-9]+")
# Blocks: to be dropped, outside and inside an article, inside it and in doubt.
BOILER, OPEN, MAIN, WEAK = 0, 1, 2, 3
NESTED = 4  # in an article inside a marked element, until the page is read
# Marks of elements: none, in doubt, by class or id, beyond doubt.
DOUBT, NAMED, SURE = 1, 2, 3


def named(name: str) -> int:
    """Mark of one class or id name."""
    words = NAME.findall(name)
    places = [i for i, w in enumerate(words) if w in MARKS]
    if not places:
        return 0
    if places[-1] == len(words) - 1 or GENERIC.issuperset(w for w in words[places[-1] + 1 :] if not w.isdigit()):
        return NAMED if COMMENTS.isdisjoint(words) else SURE
    return DOUBT


def marked(name: str, attributes: str, in_main: bool) -> int:
    """How an element is marked as something other than the article."""
    if name in DROPPED or (name == "header" and not in_main):
        return SURE
    if not attributes or name in ("html", "body"):
        return 0
    found, own = 0, name in ("article", "main")
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if own:
            if key in ("class", "id") and not COMMENTS.isdisjoint(value.split()):
                return SURE
            continue
        if key in ("class", "id"):
            found = max([found, *map(named, value.split())])
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return SURE
        if key == "style" and HIDDEN.search(value):
            return SURE
    return found


def read_blocks(page: str) -> list[tuple[str, int]]:
    """Visible blocks in page order, each BOILER, MAIN or WEAK (inside an article) or OPEN."""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int, bool, bool]] = []  # name, mark, inside an article, and that inside something marked
    parts: list[str] = []
    linked = plain = 0  # characters inside and outside links
    at, links = 0, 0

    def flush() -> None:
        nonlocal linked, plain
        text = " ".join(references.unescape("".join(parts)).split())
        if text:
            off, main, nested = stack[-1][1:] if stack else (0, False, False)
            if off > DOUBT or not main and linked and not plain:
                kind = BOILER
            else:
                kind = NESTED if nested else OPEN if not main else WEAK if off else MAIN
            out.append((text, kind))
        parts.clear()
        linked = plain = 0

    def say(text: str) -> None:
        nonlocal linked, plain
        parts.append(text)
        size = len(text.strip())
        if links:
            linked += size
        else:
            plain += size

    for m in TOKEN.finditer(page):
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name or m[1] in ("!", "?"):
            continue
        if m[1] == "/":
            if name == "a":
                links = max(0, links - 1)
            if name in BLOCKS:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name == "a":
            links += 1
        if name == "br":
            parts.append(" ")
        if name in BLOCKS:
            flush()
            links = 0
            if name in ("body", "p", "li", "td", "tr", "dt", "dd", "option"):
                _close(stack, name)
        if name not in VOID and not m[3].rstrip().endswith("/"):
            off, main, nested = stack[-1][1:] if stack else (0, False, False)
            mark = marked(name, m[3], main)
            if name in ("article", "main") and not mark and not main and off < SURE:
                off, main, nested = 0, True, off == NAMED
            stack.append((name, max(off, mark), main, nested))
    if at < len(page):
        say(page[at:])
    flush()
    alone = not any(kind in (OPEN, MAIN, WEAK) for _, kind in out)
    return [(t, (MAIN if alone else BOILER) if kind == NESTED else kind) for t, kind in out]


def _close(stack: list, name: str) -> None:
    """What a new element ends without saying so: the head, or its like before it."""
    if name == "body":
        stack[:] = [s for s in stack if s[0] == "html"]
        return
    limits = {"li": ("ul", "ol", "menu"), "td": ("tr", "table"), "tr": ("table", "tbody", "thead", "tfoot")}.get(name)
    for k in range(len(stack) - 1, -1, -1):
        if stack[k][0] == name:
            del stack[k:]
            return
        if stack[k][0] in BLOCKS and (limits is None or stack[k][0] in limits):
            return


def common_subsequence(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    places: dict = {}
    for j in range(len(b) - high - 1, low - 1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    links: list[tuple[int, object]] = []
    for i in range(low, len(a) - high):
        for j in places.get(a[i], ()):  # from the back, so one place of a is used once
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    middle, link = [], links[-1] if links else None
    while link:
        middle.append(link[0])
        link = link[1]
    return [*range(low), *reversed(middle), *range(len(a) - high, len(a))]


def flipped(mine: dict, others: list) -> list[int]:
    """Open blocks that the first neighbour which is no copy decides otherwise than marks alone:
    those it shares, or, on a page that has an article, those it does not share; and the
    blocks in doubt that it shares."""
    for other in others:
        if other is None:
            continue
        shared = set(common_subsequence(mine["hashes"], other["hashes"]))
        weight = lambda page, places: sum(page["sizes"][i] for i in places if page["kinds"][i] != BOILER)
        smaller = min(weight(mine, range(len(mine["hashes"]))), weight(other, range(len(other["hashes"]))))
        if weight(mine, shared) <= COPY * smaller:
            inside = MAIN in mine["kinds"] or WEAK in mine["kinds"]
            return [i for i, kind in enumerate(mine["kinds"]) if kind == OPEN and (i in shared) != inside or kind == WEAK and i in shared]
    return []


def main_text(page: str, flip: list[int] | None = None) -> str:
    """By marks alone, the blocks inside an article if the page has any, else the open ones;
    neighbours turn that around for the blocks in ``flip``."""
    blocks, turned = read_blocks(page), set(flip or ())
    inside = any(kind in (MAIN, WEAK) for _, kind in blocks)
    wanted = (MAIN, WEAK) if inside else (OPEN,)
    return "\n\n".join(t for i, (t, kind) in enumerate(blocks) if (kind in wanted) != (i in turned))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def neighbours(pages: DataFrame) -> DataFrame:
    """row, near, far: for each page the page before and the page after it in its host whose
    text differs, the one with the nearer path first (the one before if both are as near).
    Pages are sorted in slices; the edges of slices, one row each, are joined on, so the slicing
    shows only where equal pages fill a whole slice."""
    place = F.struct("host", "path", "row", "body")
    sliced = ordered_slices(pages.where("host <> ''").select("host", "path", "row", "body"), ["host", "path", "row"])
    order = ("host", "path", "row")
    onward = Window.partitionBy(SLICE).orderBy(*order)
    backward = Window.partitionBy(SLICE).orderBy(*(F.col(c).desc() for c in order))
    differs = lambda p: (p["host"] != F.col("host")) | (p["body"] != F.col("body"))
    near = sliced
    for name, way in (("a", onward), ("b", backward)):
        near = near.withColumn("next", F.lag(place).over(way)).withColumn(
            name, F.last(F.when(differs(F.col("next")), F.col("next")), ignorenulls=True).over(way.rowsBetween(Window.unboundedPreceding, 0))
        )
    near = near.drop("next")
    edges = near.groupBy(SLICE).agg(
        F.min(F.struct(place.alias("at"), F.col("b").alias("other"))).alias("low"),
        F.max(F.struct(place.alias("at"), F.col("a").alias("other"))).alias("high"),
    )
    slices = Window.orderBy(SLICE)  # one row for each slice
    edges = edges.select(SLICE, F.lag("high").over(slices).alias("low"), F.lead("low").over(slices).alias("high"))
    edge = lambda e: F.when(differs(F.col(e)["at"]), F.col(e)["at"]).otherwise(F.col(e)["other"])
    joined = near.join(F.broadcast(edges), SLICE).select(
        "host", "path", "row", F.coalesce("a", edge("low")).alias("a"), F.coalesce("b", edge("high")).alias("b")
    )
    parts = lambda p: F.split(p, "/")
    common = lambda p: F.aggregate(
        F.zip_with(parts(F.col("path")), parts(p), lambda x, y: x.eqNullSafe(y)),
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
        lambda s, same: F.struct((s["n"] + (s["on"] & same).cast("int")).alias("n"), (s["on"] & same).alias("on")),
        lambda s: s["n"],
    )
    near_by = lambda c: F.when(F.col(c)["host"] == F.col("host"), common(F.col(c)["path"])).otherwise(-1)
    scored = joined.select("row", "a", "b", F.coalesce(near_by("a"), F.lit(-1)).alias("na"), F.coalesce(near_by("b"), F.lit(-1)).alias("nb"))
    other = lambda c: F.when(F.col(f"n{c}") >= 0, F.col(c)["row"])
    return scored.where("na >= 0 OR nb >= 0").select(
        "row", F.when(F.col("na") >= F.col("nb"), other("a")).otherwise(other("b")).alias("near"),
        F.when(F.col("na") >= F.col("nb"), other("b")).otherwise(other("a")).alias("far"),
    )


def outlines(pages: DataFrame) -> DataFrame:
    """row, host, path and the hashes, sizes and kinds of each page's blocks; body, a hash of
    those that are not boilerplate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [read_blocks(h or "") for h in batch.column("html").to_pylist()]
            hashes = [[xxhash.xxh3_64_intdigest(t.encode()) - (1 << 63) for t, _ in page] for page in blocks]
            bodies = [xxhash.xxh3_64_intdigest("\n".join(t for t, k in p if k != BOILER).encode()) - (1 << 63) for p in blocks]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("host"), batch.column("path"), pa.array(hashes, pa.list_(pa.int64())),
                    pa.array([[len(t) for t, _ in p] for p in blocks], pa.list_(pa.int32())),
                    pa.array([[k for _, k in p] for p in blocks], pa.list_(pa.int32())),
                    pa.array(bodies, pa.int64()),
                ],
                ["row", "host", "path", "hashes", "sizes", "kinds", "body"],
            )

    url = F.coalesce("url", F.lit(""))
    return pages.select("row", host_of(url).alias("host"), path_of(url).alias("path"), "html").mapInArrow(
        run, "row bigint, host string, path string, hashes array<bigint>, sizes array<int>, kinds array<int>, body bigint"
    )


def turned_blocks(pages: DataFrame) -> DataFrame:
    """row, flip: the open blocks that neighbours decide otherwise than marks alone, for pages that have any."""
    lined = kept(outlines(pages))
    whole = F.struct("hashes", "sizes", "kinds")
    mine = lined.where(F.array_contains("kinds", OPEN) | F.array_contains("kinds", WEAK)).select("row", whole.alias("mine")).join(neighbours(lined), "row")
    side = lambda name: lined.select(F.col("row").alias(name), whole.alias(f"of_{name}"))
    both = mine.join(side("near"), "near").join(side("far"), "far", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(*(batch.column(c).to_pylist() for c in ("mine", "of_near", "of_far")))
            found = [flipped(m, others) for m, *others in sides]
            some = np.array([bool(f) for f in found], bool)
            flip = pa.array([f for f in found if f], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("row").filter(pa.array(some)), flip], ["row", "flip"])

    return both.select("row", "mine", "of_near", "of_far").mapInArrow(run, "row bigint, flip array<int>")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page (page_id, url, html) that comes straight from a scan."""
    small_batches(pages.sparkSession)
    rows = row_keys(pages.select("page_id", "url", "html"), "row")
    flips = kept(turned_blocks(rows))
    longest = flips.agg(F.max(F.size("flip"))).first()[0] or 0
    joined = rows.join(bounded_broadcast(flips, 32 + 4 * longest), "row", "left").drop("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "", d) for h, d in zip(batch.column("html").to_pylist(), batch.column("flip").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return joined.mapInArrow(run, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string")


@query("op9_html_text")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
