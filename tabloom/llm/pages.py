"""Main text of web pages by differencing pages with near URLs.

Pages of a host are paired by URL path. The text lines of a pair are aligned by longest common subsequence; lines that
both pages have are the site's, not the page's, and are deleted, inside a marked article too. Three things differencing
cannot see are read off the markup: what is no text at all, what stands in a menu, footer, advert, form or the like
although its words change from page to page, and what the page itself marks as its article. An article that is mostly
shared is kept whole, for then the pages are copies.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import kept, on_executors, schema_with, sliced
from tabloom.llm.components import components

# Element and attribute names of HTML, and words that sites use for parts which are not the article.
NO_TEXT = {"script", "style", "head", "title", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "textarea", "select", "option", "datalist"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "button", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html",
    "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "dfn", "em", "font", "i", "ins", "del", "kbd", "label", "mark", "q", "s", "samp", "small", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
REMARKS = {"comment", "comments", "commentlist", "disqus", "reply", "replies", "respond"}
PARTS = REMARKS | {
    "ad", "ads", "adsbygoogle", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "consent", "cookie",
    "cookies", "copyright", "disclaimer", "discussion", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "related", "responses", "search", "share", "sharing", "sidebar",
    "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget",
}
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
OUTSIDE, ARTICLE, REMOVED, ALWAYS_REMOVED, UNSEEN = range(5)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Cells (bits) of the alignment held at once; longer pairs are halved first.
CELLS = 1 << 30
#: An article with more than this share of its characters in lines of the other page is a copy.
COPIED = 0.5
#: So is a page without a marked article with this share of the characters it could keep.
COPIED_PAGE = 0.9


class _Lines(HTMLParser):
    """Text lines of a page with the kind of place each stands in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int]] = []
        self.open: list[tuple[str, int]] = []
        self.held: list[str] = []

    def _end_line(self) -> None:
        text = " ".join("".join(self.held).split())
        self.held.clear()
        if text:
            self.lines.append((text, self.open[-1][1] if self.open else OUTSIDE))

    def _kind(self, tag: str, attributes: list[tuple[str, str | None]]) -> int:
        above = self.open[-1][1] if self.open else OUTSIDE
        if above == UNSEEN or tag in NO_TEXT:
            return UNSEEN
        if above == ALWAYS_REMOVED:
            return ALWAYS_REMOVED
        named = {k: v or "" for k, v in attributes}
        words = {w.lower() for k in ("class", "id") for w in _NAME.findall(named.get(k, ""))}
        if words & REMARKS and tag not in ("html", "body", "main"):
            return ALWAYS_REMOVED
        if tag in ("article", "main") or named.get("role") in ("main", "article"):
            return ARTICLE
        if tag in ASIDE or named.get("role") in ROLES or tag == "header" and above != ARTICLE:
            return ALWAYS_REMOVED
        if "hidden" in named or named.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", named.get("style", "")):
            return ALWAYS_REMOVED
        if words & PARTS and tag not in ("html", "body"):
            return REMOVED
        return above

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._end_line()
            if tag != "br":  # a block ends the head, what was left open inside a paragraph, and the paragraph
                self.open = [x for x in self.open if x[0] != "head"]
                while self.open and self.open[-1][0] in INLINE | {"span", "p"} | ENDED_BY.get(tag, set()):
                    self.open.pop()
        if tag not in VOID:
            self.open.append((tag, self._kind(tag, attributes)))

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attributes)
        if tag not in VOID and tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_line()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                del self.open[at:]
                break

    def handle_data(self, data: str) -> None:
        kind = self.open[-1][1] if self.open else OUTSIDE
        if kind >= REMOVED:  # part of a line of its own, or of one that stays without it
            block = next((k for t, k in reversed(self.open) if t in BLOCKS), OUTSIDE)
            if kind == UNSEEN or block < REMOVED:
                return
        self.held.append(data)


def text_lines(html: str | None) -> list[tuple[str, int]]:
    """(line, kind) in page order; white space within a line is one space."""
    parser = _Lines()
    if html:
        parser.feed(html)
        parser.close()
    parser._end_line()
    return parser.lines


def line_hashes(lines: list[tuple[str, int]]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t, _ in lines]


def _rows(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Bit rows of the alignment: in row i, bit j is 0 where the common length of a[:i] and b[:j+1] exceeds that of b[:j]."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, [full]
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    return rows


def common_lines(a: Sequence[int], b: Sequence[int], cells: int = CELLS) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    inner_a, inner_b = a[head:len(a) - tail], b[head:len(b) - tail]
    found: list[int] = []
    if inner_a and inner_b:
        if len(inner_a) > 1 and len(inner_a) * len(inner_b) > cells:  # halve one side where the other divides best
            half = len(inner_a) // 2
            first, second = _lengths(inner_a[:half], inner_b), _lengths(inner_a[half:][::-1], inner_b[::-1])[::-1]
            at = int(np.argmax(first + second))
            found = common_lines(inner_a[:half], inner_b[:at], cells)
            found += [half + i for i in common_lines(inner_a[half:], inner_b[at:], cells)]
        else:
            rows, i, j = _rows(inner_a, inner_b), len(inner_a), len(inner_b)
            while i and j:
                if rows[i] >> j - 1 & 1:
                    j -= 1
                elif not rows[i - 1] >> j - 1 & 1:
                    i -= 1
                else:
                    i, j = i - 1, j - 1
                    found.append(i)
            found.reverse()
    return [*range(head), *[head + i for i in found], *range(len(a) - tail, len(a))]


def _lengths(a: Sequence[int], b: Sequence[int]) -> np.ndarray:
    """Common length of ``a`` with every beginning of ``b``."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")[: len(b)]
    return np.append(0, np.cumsum(1 - bits.astype(np.int64)))


def _keyed(pages: DataFrame) -> DataFrame:
    """``pages`` with a key that rows alike in id, URL and text share."""
    return pages.withColumn("_key", F.xxhash64(F.col("page_id").cast("string"), "url", "html"))


def _wanted(lines: list[tuple[str, int]]) -> int:
    """The kind of line that a page gives: those of the article if it marks one."""
    return ARTICLE if any(kind == ARTICLE for _, kind in lines) else OUTSIDE


def _hashed(pages: DataFrame) -> DataFrame:
    """(key, host, path, hashes, sizes, marked) of every different page, kept in the shared folder. Pages without a host
    have none. ``sizes`` are the characters of each line that the page could give, 0 for other lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            read = [text_lines(h) for h in batch.column("html").to_pylist()]
            kinds = [_wanted(lines) for lines in read]
            sizes = [[len(text) if kind == wanted else 0 for text, kind in lines] for lines, wanted in zip(read, kinds)]
            names = [n for n in batch.schema.names if n != "html"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array([line_hashes(lines) for lines in read], pa.list_(pa.int64())),
                 pa.array(sizes, pa.list_(pa.int32())), pa.array([k == ARTICLE for k in kinds], pa.bool_())], [*names, "hashes", "sizes", "marked"],
            )

    url = F.col("url")
    parsed = _keyed(pages).select(
        F.col("_key").alias("key"), F.lower(F.try_parse_url(url, F.lit("HOST"))).alias("host"),
        F.coalesce(F.try_parse_url(url, F.lit("FILE")), F.lit("")).alias("path"), "html",
    )
    hashed = on_executors(parsed, run, "key bigint, host string, path string, hashes array<bigint>, sizes array<int>, marked boolean")
    return kept(hashed.dropDuplicates(["key"]), "page-lines")


def neighbours(hashed: DataFrame) -> DataFrame:
    """(key, other, nearness): for each page the page before and after it by path on its host.

    Pages are sorted by host and path in ranges, so a host of any size is many tasks; the first and last page of each
    range, two rows a task, find the missing neighbour in one small window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*[b.column(n).to_pylist() for n in ("host", "path", "key")])]
        if not rows:
            return
        around = list(zip([None, *rows[:-1]], rows, [*rows[1:], None]))
        edge = [i in (0, len(rows) - 1) for i in range(len(rows))]
        columns = [[r[c] for r in rows] for c in range(3)]
        before = [a[2] if a and a[0] == r[0] else None for a, r, _ in around]
        after = [b[2] if b and b[0] == r[0] else None for _, r, b in around]
        paths = [[a[1] if a and a[0] == r[0] else None for a, r, _ in around], [b[1] if b and b[0] == r[0] else None for _, r, b in around]]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip((*columns, before, after, *paths, edge), kinds)],
            ["host", "path", "key", "before", "after", "path_before", "path_after", "edge"],
        )

    rows = hashed.where("host IS NOT NULL").select("host", "path", "key")
    ranges = rows.repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key")
    schema = "host string, path string, key bigint, before bigint, after bigint, path_before string, path_after string, edge boolean"
    inside = kept(on_executors(ranges, run, schema), "page-order")
    order = Window.orderBy("host", "path", "key")

    def beside(column: str, step) -> F.Column:
        return F.when(step("host").over(order) == F.col("host"), step(column).over(order))

    edges = inside.where("edge").select(
        "host", "path", "key", F.coalesce("before", beside("key", F.lag)).alias("before"), F.coalesce("after", beside("key", F.lead)).alias("after"),
        F.coalesce("path_before", beside("path", F.lag)).alias("path_before"), F.coalesce("path_after", beside("path", F.lead)).alias("path_after"),
        F.lit(False).alias("edge"),
    )
    whole = inside.where("NOT edge").unionByName(edges)
    both = F.array(
        F.struct(F.col("before").alias("other"), _shared_beginning("path", "path_before").alias("nearness")),
        F.struct(F.col("after").alias("other"), _shared_beginning("path", "path_after").alias("nearness")),
    )
    return whole.select("key", F.explode(both).alias("x")).select("key", "x.other", "x.nearness").where("other IS NOT NULL")


def _shared_beginning(a: str, b: str):
    """How many path segments two paths share from the left."""
    pairs = F.arrays_zip(F.split(a, "[/?#]"), F.split(b, "[/?#]"))
    same = F.transform(pairs, lambda p: (p["0"] == p["1"]) & p["0"].isNotNull())
    first = F.array_position(F.transform(same, lambda s: F.coalesce(s, F.lit(False))), False)
    return F.when(F.col(b).isNotNull(), F.when(first == 0, F.size(same)).otherwise(first - 1))


def _copied(found: Sequence[int], sizes: Sequence[int], marked: bool) -> bool:
    """Whether the lines ``found`` hold so much of what a page could give that the other page has its text."""
    whole = sum(sizes)
    share = sum(sizes[i] for i in found) / whole if whole else len(found) / max(1, len(sizes))
    return share > COPIED if marked else share >= COPIED_PAGE


def shared_lines(pages: DataFrame) -> DataFrame:
    """(key, shared): places of the lines that a page has in common with its nearest neighbour that differs.

    Pages of a host with the very same lines are one page here, at the first of their paths. Two pages that each have
    nearly all of the other's text are copies and show nothing; then the other neighbour is taken. A page between copies
    only forms a group with them, and is compared with the pages before and after the group, until one differs or none
    is left. Groups are runs in the order of paths, so each round is one sort of a page per group.
    """
    hashed = _hashed(pages)
    text = ("hashes", "sizes", "marked")
    alike = hashed.where("host IS NOT NULL").select("key", "host", "path", F.xxhash64(*text).alias("content"))
    first = F.min(F.struct("path", "key")).alias("first")
    texts = kept(alike.groupBy("host", "content").agg(first).select("host", "content", "first.path", F.col("first.key").alias("text")), "page-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            shared, copies = [], []
            for hashes, sizes, marked, beside in zip(*[batch.column(n).to_pylist() for n in (*text, "beside")]):
                for other in beside:
                    found = common_lines(hashes, other["hashes"])
                    if not _copied(found, sizes, marked) or not _copied(common_lines(other["hashes"], hashes), other["sizes"], other["marked"]):
                        shared.append(found)
                        copies.append(None)
                        break
                else:
                    shared.append(None)
                    copies.append([other["other"] for other in beside])
            columns = [batch.column(n) for n in ("text", "host", "run")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(shared, pa.list_(pa.int32())), pa.array(copies, pa.list_(pa.int64()))], ["text", "host", "run", "shared", "copies"],
            )

    places = texts.select("host", "path", F.col("text").alias("key"))
    undecided = texts.select("text", "host", F.col("text").alias("run"))
    decided = None
    while True:
        others = hashed.select(F.col("key").alias("other"), *text)
        beside = neighbours(places).join(others, "other").groupBy(F.col("key").alias("run")).agg(
            F.sort_array(F.collect_list(F.struct("nearness", "other", *text)), asc=False).alias("beside"),
        )
        rows = undecided.join(beside, "run").join(hashed.select(F.col("key").alias("text"), *text), "text")
        compared = on_executors(rows, run, "text bigint, host string, run bigint, shared array<int>, copies array<bigint>")
        compared = kept(compared, "page-pairs")
        found = compared.where("copies IS NULL").select("text", "shared")
        decided = found if decided is None else decided.unionByName(found)
        left = compared.where("copies IS NOT NULL")
        if left.isEmpty():
            break
        runs = kept(components(left.select(F.col("run").alias("a"), F.explode("copies").alias("b"))), "page-runs")
        inside = runs.where("node <> component").select(F.col("node").alias("key"))
        places = kept(places.join(left.select("host").distinct(), "host", "left_semi").join(inside, "key", "left_anti").select("host", "path", "key"), "page-places")
        undecided = left.join(runs, F.col("run") == F.col("node")).select("text", "host", F.col("component").alias("run"))
    of_text = alike.join(texts.select("host", "content", "text"), ["host", "content"]).select("key", "text")
    return kept(of_text.join(decided.where(F.size("shared") > 0), "text").select("key", "shared"), "shared-lines")


def main_text(lines: list[tuple[str, int]], shared: Sequence[int]) -> str:
    """The marked article's lines if there are any, else the lines that stand nowhere special, without the shared ones.

    An article that shares more than ``COPIED`` of its characters is a copy of the other page's, not boilerplate: it stays whole.
    """
    wanted = _wanted(lines)
    gone = set(shared)
    if wanted == ARTICLE:
        sizes = {at: len(text) for at, (text, kind) in enumerate(lines) if kind == ARTICLE}
        if sum(size for at, size in sizes.items() if at in gone) > COPIED * sum(sizes.values()):
            gone = set()
    return "\n".join(text for at, (text, kind) in enumerate(lines) if kind == wanted and at not in gone)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``text`` and ``n_chars`` instead of html.

    Null or empty html has empty text. A null or malformed URL, or a host whose pages are all copies of one, leaves
    nothing to compare with; then only the markup decides. Rows alike in id, URL and html are one page and get the same text. Columns named text
    or n_chars are replaced. Whole pages are read; cut-off markup is read as far as it goes.
    """
    base = _keyed(pages.drop("text", "n_chars"))
    joined = base.join(shared_lines(pages).select(F.col("key").alias("_k"), "shared"), F.col("_key") == F.col("_k"), "left")
    joined = joined.drop("_key", "_k").withColumnRenamed("shared", "_shared")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [main_text(text_lines(h), s or ()) for h, s in zip(batch.column("html").to_pylist(), batch.column("_shared").to_pylist())]
            names = [n for n in batch.schema.names if n not in ("html", "_shared")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*names, "text", "n_chars"],
            )

    return on_executors(joined, run, schema_with(joined, ["html", "_shared"], "text string, n_chars bigint"))
