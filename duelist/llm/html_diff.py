"""Main text of web pages by nearest-URL page differencing.

Pages of one host whose URL paths are next to each other in sorted order come from the same template. The text
lines of a page and of its neighbour are aligned by their longest common subsequence; shared lines are
template and are deleted. Page structure comes first where it speaks plainly: scripts, menus, adverts, forms,
comments and the like are no text, and what stands inside ``<article>`` or ``<main>`` is the article, of which
differencing may only delete lines that are nothing but links. Articles of a host often share sentences; those stay.
Classes and ids speak less plainly: they rule out no ``<html>``, ``<body>``, ``<main>`` or ``<article>`` and no element that holds
the larger part of the text. Only an element whose class or id *is* a word for reader comments goes whatever its tag
and length. One ``<article>`` or ``<main>`` is the text. Of several beside each other the one with the page's one
``<h1>`` is; without such a one they are teasers or parts, and all of the page is compared.

How much two pages share decides nothing: a short article on a rich template shares almost all of its lines. Pages of
a host with the same lines are one page for the search, so a neighbour always differs somewhere. Where nothing
of a page would be left, the neighbour holds the same article and says nothing; the page stays as it is.

The neighbour is found without a window over a host: addresses are ranked in one range-sorted table and joined
with ranks one higher and one lower. Of the neighbour only line hashes travel. Pages are read twice (hashes, then
text) and shuffled once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.llm.common import importable, staged

# HTML elements that end a block of text, that hold no text, that never close, words in class or id
# that mark what is not the article, class names and ids of reader comments.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title "
    "tr ul".split())
NO_TEXT = set("script style noscript template head title nav footer aside form button select textarea iframe svg canvas object menu dialog".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NOT_ARTICLE = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer masthead menu "
    "modal nav navbar navigation newsletter notice popup promo related share sharing sidebar social sponsor sponsored subscribe widget".split())
ARTICLE = {"article", "main"}
NEVER_MARKED = ARTICLE | {"html", "body"}
COMMENTS = set("comment comments comment-list comment-body comments-area commentlist disqus_thread".split())
FOREIGN = {"svg", "math"}
INLINE_NO_TEXT = NO_TEXT - BLOCKS

_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[^a-z0-9]+")


class _Lines(HTMLParser):
    """Blocks of a page in order: text, whether the structure rules it out, number of the outermost article around it
    (0: none), whether links only, whether a main heading."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # tag, ruled out, outermost article, elements around it with a word of NOT_ARTICLE
        self.open: list[tuple[str, bool, int, tuple[int, ...]]] = [("", False, 0, ())]
        self.lines: list[tuple[str, bool, int, bool, bool, tuple[int, ...]]] = []
        self.articles = 0
        self.marked: list[int] = []  # length of the text in each element with such a word
        self.total = 0
        self.text: list[str] = []
        self.where = self.open[0]  # element in which the block's text began
        self.in_link = 0
        self.plain, self.blank = False, True

    def flush(self) -> None:
        line = _SPACE.sub(" ", "".join(self.text)).strip()
        if line:
            tag, out, article, marks = self.where
            self.lines.append((line, out, article, not self.plain, tag == "h1", marks))
            if not out:
                self.total += len(line)
                for k in marks:
                    self.marked[k] += len(line)
        self.text, self.plain, self.blank = [], False, True

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
            if tag == "p" and self.open[-1][0] == "p":
                self.open.pop()
        elif tag == "br":
            self.text.append(" ")
        elif tag == "a":
            self.in_link += 1
        if tag in VOID or (tag not in BLOCKS and tag not in NO_TEXT):
            return
        _, out, article, marks = self.open[-1]
        named = {k: (v or "").lower() for k, v in attrs}
        words = set(_PART.split(f"{named.get('class', '')} {named.get('id', '')} {named.get('role', '')}"))
        out = (
            out or tag in NO_TEXT or "hidden" in named
            or named.get("aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", "")
            or (tag == "header" and not article)
            or (tag not in ("html", "body", "main") and not COMMENTS.isdisjoint(f"{named.get('class', '')} {named.get('id', '')}".split()))
        )
        if tag in ARTICLE and not article and not out:
            article = self.articles = self.articles + 1
        if words & NOT_ARTICLE and tag not in NEVER_MARKED:
            marks = (*marks, len(self.marked))
            self.marked.append(0)
        self.open.append((tag, out, article, marks))

    def handle_startendtag(self, tag, attrs):
        # the slash closes elements of drawings and formulas only; elsewhere HTML ignores it
        if tag in FOREIGN or any(t in FOREIGN for t, *_ in self.open):
            return
        self.handle_starttag(tag, attrs)
        if tag in self.CDATA_CONTENT_ELEMENTS:
            self.set_cdata_mode(tag)

    def handle_endtag(self, tag):
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if tag in BLOCKS:
            self.flush()
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        if self.open[-1][0] in INLINE_NO_TEXT:
            return
        if not data.isspace():
            if self.blank:
                self.blank = False
                self.where = self.open[-1]
            self.plain |= not self.in_link
        self.text.append(data)


def page_lines(html: str | None) -> list[tuple[str, bool, int, bool, bool]]:
    if not html:
        return []
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    # an element with the larger part of the text is not beside the article, whatever it is called
    beside = {k for k, n in enumerate(parser.marked) if 2 * n <= parser.total}
    return [(line, out or not beside.isdisjoint(marks), *rest) for line, out, *rest, marks in parser.lines]


def _hashes(lines: list[tuple[str, bool, int, bool, bool]]) -> list[int]:
    return [xxhash.xxh64_intdigest(line[0]) - (1 << 63) for line in lines]


def _row(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common subsequences of ``a`` and every prefix of ``b``."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], np.where(b == x, row[:-1] + 1, 0)))
    return row


def shared(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``; memory grows with the longer one only."""
    if not len(a) or not len(b):
        return []
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    if head:
        return [*range(head), *(head + k for k in shared(a[head:], b[head:]))]
    found = np.isin(a, b)
    if not found.all():
        at = np.flatnonzero(found)
        return [int(at[k]) for k in shared(a[at], b)]
    if len(a) == 1:
        return [0]
    half = len(a) // 2
    split = int(np.argmax(_row(a[:half], b) + _row(a[half:][::-1], b[::-1])[::-1]))
    return [*shared(a[:half], b[:split]), *(half + k for k in shared(a[half:], b[split:]))]


def main_text(html: str | None, neighbour: list[int] | None) -> tuple[str, int]:
    """The article's blocks joined by an empty line, and how many lines differencing deleted from it."""
    lines = page_lines(html)
    common = set(shared(np.array(_hashes(lines), np.int64), np.array(neighbour, np.int64))) if neighbour and lines else set()
    body = [(k, line) for k, line in enumerate(lines) if not line[1]]
    articles = {line[2] for _, line in body if line[2]}
    if len(articles) > 1:
        headings = [line[2] for _, line in body if line[4]]
        articles = set(headings) if len(headings) == 1 and headings[0] else set()
    if articles:
        body = [(k, line) for k, line in body if line[2] in articles]
    kept = [line[0] for k, line in body if k not in common or (line[2] and not line[3])] or [line[0] for _, line in body]
    return "\n\n".join(kept), len(body) - len(kept)


def neighbours(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """``host``, ``path``, ``near_id``: for every address the page at the nearest path of the host that has other lines.

    Addresses are compared without scheme, query, fragment, final slash and ``.html``. Pages of a host with the same lines
    (``lines``: ``near_id``, ``alike``) stand at the first of their addresses. Nearest is the neighbour in sorted order that
    shares more leading path segments, the earlier one if they share as many. Pages without a host have none.
    """
    addresses = pages.filter("host <> ''").groupBy("host", "path").agg(F.min("page_id").alias("near_id")).join(lines, "near_id")
    first = addresses.groupBy("host", "alike").agg(F.min(F.struct("path", "near_id")).alias("at")).selectExpr(
        "host", "alike", "at.path", "at.near_id AS page_id")
    ordered = staged(
        first.repartitionByRange("host", "path").sortWithinPartitions("host", "path")
        .select("*", F.monotonically_increasing_id().alias("_at")).selectExpr("*", "shiftright(_at, 33) AS _part", "_at & ((1L << 33) - 1) AS _k"),
        "addresses")
    # one row per part of the sorted table
    parts = ordered.groupBy("_part").agg(F.count("*").alias("n")).selectExpr("_part", "sum(n) OVER (ORDER BY _part) - n AS before")
    ranked = staged(ordered.join(parts, "_part").selectExpr("host", "path", "alike", "page_id", "before + _k AS rank"), "ranked-addresses")
    out = ranked
    for name, step in (("prev", 1), ("next", -1)):
        other = ranked.selectExpr(f"rank + {step} AS rank", f"host AS {name}_host", f"path AS {name}_path", f"page_id AS {name}_id")
        out = out.join(other, "rank", "left")
    common = lambda n: (
        f"if({n}_host = host, aggregate(zip_with(split(path, '/'), split({n}_path, '/'), (x, y) -> x <=> y), "
        f"named_struct('n', 0, 'on', true), (a, e) -> named_struct('n', a.n + if(a.on AND e, 1, 0), 'on', a.on AND e), a -> a.n), -1)")
    nearest = out.selectExpr("host", "alike", f"coalesce({common('prev')}, -1) AS p", f"coalesce({common('next')}, -1) AS n", "prev_id", "next_id").selectExpr(
        "host", "alike", "CASE WHEN p < 0 AND n < 0 THEN NULL WHEN p >= n THEN prev_id ELSE next_id END AS near_id").filter("near_id IS NOT NULL")
    return addresses.drop("near_id").join(nearest, ["host", "alike"]).select("host", "path", "near_id")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` (empty if there is none), ``n_deleted`` for every row of ``pages``.

    NULL html is an empty page; NULL or broken URLs have no neighbour; several rows may share an id or an address.
    Other columns are ignored; an empty table gives an empty result.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r"(?:/index)?\.html?$", ""), "/+$", "")
    own = importable(pages).select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"), path.alias("path"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([_hashes(page_lines(h.as_py())) for h in batch.column(1)], pa.list_(pa.int64()))],
                names=["near_id", "lines"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [main_text(h.as_py(), n.as_py()) for h, n in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int32())],
                names=["page_id", "url", "text", "n_deleted"])

    lines = staged(own.select("page_id", "html").mapInArrow(hashed, "near_id long, lines array<long>"), "page-lines")
    lines = lines.groupBy("near_id").agg(F.min("lines").alias("lines"))
    near = neighbours(own.select("page_id", "host", "path"), lines.selectExpr("near_id", "xxhash64(lines) AS alike"))
    references = near.join(lines, "near_id").select("host", "path", "lines")
    paired = own.join(references, ["host", "path"], "left").select("page_id", "url", "html", "lines")
    return paired.mapInArrow(texts, "page_id long, url string, text string, n_deleted int")
