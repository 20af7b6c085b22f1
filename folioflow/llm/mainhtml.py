"""Main text of web pages by nearest-URL page differencing, with markup to cut and to protect.

A page is cut into text blocks, its lines. Scripts, styles, forms and everything in a menu,
header, footer, sidebar, notice, advert or comment element is dropped there. All pages are then
sorted by host and path, each is paired with the page of its host and layout (with an <article>
or <main>, or without) whose path is nearest, and the lines of the two are aligned by longest
common subsequence. The shared lines are deleted, unless they lie in such an element: sites quote
the same passages in many articles, and copies of one article share all lines. A page with such
an element keeps only what lies in it.

Only digests of lines are sorted and compared; the texts stay where they are.
"""

from __future__ import annotations

import html
import re
from collections.abc import Hashable, Sequence
from itertools import islice
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ARROW_ROWS, bounded_bytes, materialise, partitions, small_batches
from .urlfilter import host, path

#: Pages of a range partition, about.
PART_ROWS = 20_000

# Element names and the words of class, id and role names.
_RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "head"}
_DROPPED = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "menuitem", "input", "label", "fieldset"}
_MAIN = {"article", "main"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
_INLINE |= {"math", "semantics", "annotation", "mrow", "mi", "mn", "mo", "ms", "mtext", "mspace", "mfrac", "msup", "msub", "msubsup", "msqrt", "mroot", "mover", "munder", "munderover", "mstyle", "mpadded", "menclose", "tspan"}
_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer",
    "masthead", "comment", "comments", "respond", "reply", "replies", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "newsletter", "subscribe", "signup", "share", "sharing", "social",
    "related", "widget", "toolbar", "pagination", "pager", "skip",
}
_PLAIN = {
    "area", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "form", "group", "icons", "inner", "item", "items", "left", "link", "links", "list", "main",
    "outer", "overlay", "page", "panel", "post", "posts", "primary", "right", "secondary", "section", "side", "site", "slot", "thread", "to", "top", "unit", "wrap", "wrapper",
}
_PART = re.compile(r"[-_]+")
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
_RAW_END = {name: re.compile(f"</{name}", re.I) for name in _RAW}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([A-Za-z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_SPACE = re.compile(r"\s+")


def _names_boilerplate(value: str) -> bool:
    """Whether one of the names says what it is: all its parts are of the lists, or numbers.

    So `share-buttons` and `ad-slot-2` are, and `share-price` and `related-work` are not.
    """
    for word in value.lower().split():
        parts = [x for x in _PART.split(word) if x and not x.isdigit()]
        if any(x in _NAMES for x in parts) and all(x in _NAMES or x in _PLAIN for x in parts):
            return True
    return False


def _boilerplate(name: str, attributes: str) -> bool:
    if name in _DROPPED:
        return True
    if not attributes or name in ("html", "body"):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
        if key in ("class", "id") and _names_boilerplate(value) or key == "role" and value.lower() in _ROLES or key == "hidden":
            return True
    return False


def blocks(page: str) -> list[tuple[str, bool, bool]]:
    """(text, inside a main element, dropped by markup) of each text block, in page order.

    Character references are decoded, white space is one space, blocks are trimmed and not
    empty. Elements left open end with the page; a closing tag without its element is ignored.
    A page that breaks off in a tag or comment ends there.
    """
    out: list[tuple[str, bool, bool]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, main, dropped

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if text:
            out.append((text, stack[-1][1], stack[-1][2]) if stack else (text, False, False))

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            held.append(page[at:])
            break
        held.append(page[at:lt])
        m = _TOKEN.match(page, lt)
        if not m:
            if _cut_tag(page, lt):
                break
            held.append("<")
            at = lt + 1
            continue
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if not m[4]:
            break
        if name in _INLINE:
            if name in ("br", "wbr", "img"):
                held.append(" ")
            continue
        flush()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in _RAW and name != "head":
            stop = _RAW_END[name].search(page, at)
            close = page.find(">", stop.start()) if stop else -1
            at = close + 1 if close >= 0 else end
            continue
        if name in _VOID or m[3].endswith("/"):
            continue
        if name == "p" and stack and stack[-1][0] == "p" or name == "li" and stack and stack[-1][0] == "li":
            stack.pop()
        main, dropped = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        stack.append((name, main or name in _MAIN, dropped or name == "head" or _boilerplate(name, m[3])))
    flush()
    return out


def _cut_tag(page: str, at: int) -> bool:
    """Whether an unfinished tag starts at this place: the page breaks off in it."""
    return bool(re.match(r"</?[A-Za-z]", page[at : at + 3])) and page.find(">", at) < 0


def common_lines(a: Sequence[Hashable], b: Sequence[Hashable]) -> set[int]:
    """Positions in a of a longest common subsequence of lines with b.

    A row of the alignment is one integer with a bit for each line of b: 0 where the subsequence
    grows. Rows are kept at intervals and the others made again, so that of a page's n rows about
    twice the root of n are held at once. Only lines that both have can take part.
    """
    in_a, in_b = set(a), set(b)
    own, other = [i for i, x in enumerate(a) if x in in_b], [x for x in b if x in in_a]
    places: dict[Hashable, list[int]] = {}
    for j, x in enumerate(other):
        places.setdefault(x, []).append(j)
    # of lines that come often, as others' places are quickly marked when they are met
    mask = {x: int("".join("1" if y == x else "0" for y in reversed(other)), 2) for x, at in places.items() if len(at) > 64}
    full, gap = (1 << len(other)) - 1, isqrt(len(own)) + 1

    def grow(row: int, line: Hashable) -> int:
        hit = row & (mask[line] if line in mask else sum(1 << j for j in places[line]))
        return ((row + hit) | (row - hit)) & full

    kept, row = [], full
    for n, i in enumerate(own):
        if n % gap == 0:
            kept.append(row)
        row = grow(row, a[i])
    found, column = set(), len(other)
    for at in range(len(kept) - 1, -1, -1):
        some, rows = own[at * gap : (at + 1) * gap], [kept[at]]
        for i in some:
            rows.append(grow(rows[-1], a[i]))
        n = len(some)
        while n and column:
            bit = column - 1
            if rows[n] >> bit & 1:
                column -= 1
            else:
                n -= 1
                if rows[n] >> bit & 1:
                    found.add(some[n])
                    column -= 1
    return found


def structured(pages: DataFrame) -> DataFrame:
    """(row_key, page_id, url, lines, main) in a written table: blocks that markup leaves in.

    main says of each line whether it lies in a main element; row_key numbers the rows.
    """
    small_batches(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            found = [[(t, main) for t, main, dropped in blocks(page or "") if not dropped] for page in batch.column(2).to_pylist()]
            keys = pa.array(range(part << 36 | count, (part << 36 | count) + len(found)), pa.int64())
            count += len(found)
            yield pa.RecordBatch.from_arrays(
                [keys, batch.column(0), batch.column(1), pa.array([[t for t, _ in x] for x in found], pa.list_(pa.string())), pa.array([[m for _, m in x] for x in found], pa.list_(pa.bool_()))],
                names=["row_key", "page_id", "url", "lines", "main"],
            )

    return materialise(pages.select("page_id", "url", "html").mapInArrow(run, f"row_key long, page_id {kind}, url string, lines array<string>, main array<boolean>"))


def ordered(pages: DataFrame) -> DataFrame:
    """(row_key, host, path, digests, key, seq, part) in the order of host, path, id, url and lines.

    host tells the layouts of a host apart: no host has the slash that marks pages with a main
    element. digests stand for the lines and key for all of them. seq ascends with the order, and part is
    the range partition that holds the page. Rows that are equal in all else are told apart by
    row_key, so a host, a path or a copy of any count is split.
    """
    spark = pages.sparkSession
    # lines have no line breaks and are not empty, so joined they stay distinct
    key = F.md5(F.array_join("lines", "\n").cast("binary"))
    site = F.concat(host(F.col("url")), F.when(F.exists("main", lambda m: m), "/main").otherwise(""))
    rows = pages.select("row_key", site.alias("host"), path(F.col("url")).alias("path"), "page_id", "url", key.alias("key"), F.transform("lines", lambda x: F.xxhash64(x)).alias("digests"))
    order = ["host", "path", "page_id", "url", "key", "row_key"]
    parts = max(partitions(spark), -(-pages.count() // PART_ROWS))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("page_id", "url")
    return materialise(dealt.withColumn("seq", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()))


def edges(pages: DataFrame) -> list[tuple[int, int]]:
    """(part, seq) of the pages of other parts that a part's first and last pages may be paired with.

    These are the nearest pages before and after it on the same host with other lines. A part
    that is all copies of one page is passed over. Only places and digests of four pages a part
    come to the driver.
    """
    at = F.struct("seq", "host", "key")
    ends = pages.groupBy("part").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    inner = pages.join(F.broadcast(ends), "part")

    def other(end):
        return F.when((F.col("host") != F.col(f"{end}.host")) | (F.col("key") != F.col(f"{end}.key")), at)

    found = inner.groupBy("part", "first", "last").agg(F.min(other("first")).alias("second"), F.max(other("last")).alias("before")).orderBy("part").collect()
    out = []
    for way, own, near, far in ((found, "first", "last", "before"), (found[::-1], "last", "first", "second")):
        seen = []  # of the parts passed so far, the nearest page and the nearest page unlike it
        for r in way:
            meant = next((x for x in seen if (x.host, x.key) != (r[own].host, r[own].key)), None)
            if meant and meant.host == r[own].host:
                out.append((r.part, meant.seq))
            unlike = r[far] or next((x for x in seen if (x.host, x.key) != (r[near].host, r[near].key)), None)
            seen = [r[near], unlike] if unlike else [r[near]]
    return out


def _shared_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def differenced(structure: DataFrame) -> DataFrame:
    """(row_key, n_shared, own) of pages with lines shared with their neighbour.

    own says of each line whether it is not shared.

    In the order of host and path each page is compared with the nearest page before or after it
    that has other lines (a copy says nothing about what is shared), the one whose path shares
    the longer prefix, the one before at a tie. Pages are sorted in range partitions, and each
    partition gets the pages beyond its edges that its own are paired with, so a host of any size
    is compared as one. A page alone on its host shares nothing.
    """
    spark = structure.sparkSession
    small_batches(spark)
    pages = ordered(structure)
    # two numbers for each of at most two pages a part
    beyond = F.broadcast(spark.createDataFrame(edges(pages), "to int, seq long"))
    columns = ["part", "seq", "own", "row_key", "host", "path", "digests"]
    guests = pages.join(beyond, "seq").withColumn("part", F.col("to")).withColumn("own", F.lit(False))
    rows = pages.withColumn("own", F.lit(True)).select(*columns).unionByName(guests.select(*columns))
    parts = max(partitions(spark), pages.agg(F.max("part")).first()[0] or 0)

    def compare(batches):
        # a run is a row of pages of one host with the same lines
        where, lines, before, run = None, None, None, []

        def finish(after):
            gone = {}
            for key, at in run:
                near = [o for o in (before, after) if o]
                best = max(near, key=lambda o: _shared_prefix(o[0], at)) if near else None
                if id(best) not in gone:
                    gone[id(best)] = common_lines(lines, best[1]) if best else set()
                if shared := gone[id(best)]:
                    yield key, len(shared), [i not in shared for i in range(len(lines))]

        def done():
            for batch in batches:
                nonlocal where, lines, before, run, last
                for part, _, own, key, name, at, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if where != (part, name):
                        yield from finish(None)
                        where, lines, before, run = (part, name), found, None, []
                    elif lines != found:
                        yield from finish((at, found))
                        lines, before, run = found, (last, lines), []
                    last = at
                    if own:
                        run.append((key, at))
            yield from finish(None)

        last = ""
        rows = done()
        while some := list(islice(rows, ARROW_ROWS)):
            keys, shared, own = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(shared, pa.int64()), pa.array(own, pa.list_(pa.bool_()))], names=["row_key", "n_shared", "own"])

    return materialise(rows.repartition(parts, "part").sortWithinPartitions("part", "seq").mapInArrow(compare, "row_key long, n_shared long, own array<boolean>"))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (empty if none), n_shared.

    n_shared is the number of the page's lines that the nearest-URL page has too, those that are
    protected included. Null html counts as empty. Rows may repeat and each is a page of its own;
    null ids and urls are kept as they are, and a null url has the empty host. Pages of one path
    follow each other by id, so ties of nearness have one outcome. A page of 20,000 lines is
    compared in under 100 MB. Other columns are ignored, whatever their
    names. An empty table gives no rows.
    """
    found = structured(pages).withColumn("protects", F.exists("main", lambda m: m))
    rows = found.join(bounded_bytes(differenced(found), F.size("own")), "row_key", "left")
    kept = F.when(F.col("protects"), F.col("main")).otherwise(F.col("own"))
    # array_join leaves nulls out
    text = F.array_join(F.when(kept.isNull(), F.col("lines")).otherwise(F.zip_with("lines", kept, lambda x, k: F.when(k, x))), "\n\n")
    return rows.select("page_id", "url", text.alias("text"), F.coalesce("n_shared", F.lit(0).cast("long")).alias("n_shared"))
