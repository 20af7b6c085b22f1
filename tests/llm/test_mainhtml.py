import hashlib
import html
import os
import random
import re
from collections import Counter
from itertools import combinations

from folioflow.llm import mainhtml, queries
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SMALL


def test_articles_of_the_table(spark):
    got = {r.page_id: r for r in queries.op9_html_extraction(spark, SMALL).collect()}
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert got.keys() == {p.page_id for p in pages}
    for p in pages:
        inner = re.search(r"(?s)<article>(.*?)(?:</article>|\Z)", p.html)[1]
        parts = [" ".join(html.unescape(re.sub(r"<(?:/?b|br)>", "", x)).split()) for x in re.split(r"</?(?:h1|p)>", inner)]
        assert got[p.page_id].text == "\n\n".join(x for x in parts if x)
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def texts(page):
    return [t for t, main, dropped in mainhtml.blocks(page) if main and not dropped]


def test_blocks():
    page = """<html><head><title>T</title><script>var t="</p><article>x";</script></head><body><header>H</header><nav><p>N</p></nav>
    <main><h1>One &amp; two</h1><div class="ad">buy</div><p>a <b>b</b>
    c<br>d<p>e<aside>s</aside><div id="comments"><p>nice!</p></div><form><p>f</p></form><!-- <p>no</p> --><p>1 < 2 &lt;b&gt;</p></main><footer>F</footer><div"""
    assert texts(page) == ["One & two", "a b c d", "e", "1 < 2 <b>"]
    assert mainhtml.blocks("") == [] and texts("<article><p>cut <b>of") == ["cut of"] and texts("<article><p>cut</p><p cl") == ["cut"]
    assert texts("<article>" + "<p>x</p>" * 20_000) == ["x"] * 20_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=7), st.lists(st.sampled_from("abcd"), max_size=7))
def test_common_lines_are_longest(a, b):
    found = mainhtml.common_lines(a, b)

    def within(x):
        it = iter(b)
        return all(c in it for c in x)

    assert within([a[i] for i in sorted(found)])
    longest = max(n for n in range(len(a) + 1) if any(within(c) for c in combinations(a, n)))
    assert len(found) == longest


def test_pages_without_a_main_element_and_odd_rows(spark):
    rows = [(i, f"https://h.example/a/{i}", f"<body><p>Site name</p><p>Text {i}</p><p>All rights</p></body>") for i in range(6)]
    rows += [(10, None, None), (11, "no url", ""), (None, "https://h.example/a/0", "<article><p>A</p></article>"), (12, "https://x.example/", "<p>alone</p>"), (12, "https://x.example/", "<p>alone</p>")]
    got = mainhtml.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(by[i] == f"Text {i}" for i in range(6)) and by[10] == by[11] == "" and by[None] == "A" and by[12] == "alone"
    assert mainhtml.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_of_a_large_host_meet_their_nearest_path(spark, monkeypatch):
    monkeypatch.setattr(mainhtml, "PART_ROWS", 100)
    pages = [(s * 4 + i, f"https://big.example/s{s:04}/{i}", f"<p>Menu of section {s}</p><p>Text {s} {i}</p>") for s in range(300) for i in range(4)]
    # more copies of one page than a partition holds stand between two pages that share their menu
    pages += [(5000 + i, f"https://copies.example/b/{i:04}", "<p>Menu</p><p>Copy</p>") for i in range(500)]
    pages += [(6000, "https://copies.example/a", "<p>Menu</p><p>First</p>"), (6001, "https://copies.example/c", "<p>Menu</p><p>Last</p>")]
    got = {r.page_id: r.text for r in mainhtml.main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()}
    want = {s * 4 + i: f"Text {s} {i}" for s in range(300) for i in range(4)}
    want |= dict.fromkeys(range(5000, 5500), "Copy") | {6000: "First", 6001: "Last"}
    assert got == want


def nearest(order, k):
    """The page of the same host and other lines whose path shares the longest prefix, by a full search."""

    def host(r):
        return r[1].split("/")[2], r[3:] and any(m for _, m in r[3])

    r, near = order[k], []
    for side in (order[:k][::-1], order[k + 1 :]):
        near += [o for o in [next((o for o in side if o[2] != r[2] and host(o) == host(r)), None)] if o]
    return max(near, key=lambda o: len(os.path.commonprefix([o[1], r[1]])), default=None)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1], r[0] is not None, r[0] or 0, hashlib.md5("\n".join(r[2]).encode()).hexdigest()))


def test_differencing_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mainhtml, "PART_ROWS", 5)
    draw = random.Random(7)
    rows = [(draw.choice([None, *range(40)]), f"https://{draw.choice(['one', 'two', 'two', 'two'])}.example/{''.join(draw.choices('ab/', k=4))}", draw.choices("uvwxyz", k=draw.choice([0, 2, 2, 4]))) for _ in range(200)]
    rows += [(1, "https://two.example/b", ["u", "v"])] * 30
    order = in_order(rows)
    want = Counter()
    for k, r in enumerate(order):
        best = nearest(order, k)
        if gone := best and sorted(mainhtml.common_lines(r[2], best[2])):
            want[r[0], r[1], tuple(r[2]), tuple(gone)] += 1
    pages = spark.createDataFrame([(i, *r, [False for _ in r[2]]) for i, r in enumerate(rows)], "row_key long, page_id long, url string, lines array<string>, main array<boolean>")
    got = mainhtml.differenced(pages).collect()
    assert Counter((*rows[r.row_key][:2], tuple(rows[r.row_key][2]), tuple(i for i, x in enumerate(r.own) if not x)) for r in got) == want


def test_the_whole_query_against_brute_force(spark):
    """Of the table: its pages, and its pages without <article> or with lines that their host shares."""
    pages = [(p.page_id, p.url, p.html) for p in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    pages += [(p + 1000, u, re.sub("</?article>", "", h).replace("<nav>", f"<p>All of {u.split('/')[2]}</p><nav>")) for p, u, h in pages]
    pages += [(p + 2000, u, h.replace("<article>", f"<article><p>All of {u.split('/')[2]}</p>")) for p, u, h in pages[:50]]
    found = [(p, u, [(t, main) for t, main, dropped in mainhtml.blocks(h) if not dropped]) for p, u, h in pages]
    order, want = in_order([(p, u, tuple(t for t, _ in x), x) for p, u, x in found]), {}
    # urls of the table have no # or ? that would change their order
    order.sort(key=lambda r: (re.match(r"[^:]*://([^/?#]*)([^?#]*)", r[1]).groups(), r[0]))
    for k, (p, u, lines, x) in enumerate(order):
        best = nearest(order, k)
        gone = mainhtml.common_lines(lines, best[2]) if best else set()
        some = any(m for _, m in x)
        want[p] = (u, "\n\n".join(t for i, (t, m) in enumerate(x) if (m if some else i not in gone)), len(gone))
    got = {r.page_id: (r.url, r.text, r.n_shared) for r in mainhtml.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == want
    opened = [p for p, _, _ in pages if 1000 <= p < 2000]
    assert any("All of" in got[p][1] for p in opened) and sum("All of" not in got[p][1] for p in opened) > len(opened) / 2
    assert all(got[p + 2000][1].startswith("All of") for p in range(50))


def test_long_pages_are_aligned_in_little_memory(spark):
    import tracemalloc

    draw = random.Random(3)
    a, b = ([str(draw.choice([0, draw.randrange(40_000)])) for _ in range(20_000)] for _ in range(2))
    menu = [f"menu {i}" for i in range(3_000)]
    tracemalloc.start()
    found = mainhtml.common_lines(menu + a, menu + b)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(range(3_000)) <= found and most < 100 << 20
    pages = [(k, f"https://long.example/{k}", "".join(f"<p>{x}</p>" for x in menu + [f"{k} {i}" for i in range(20_000)])) for k in range(2)]
    got = {r.page_id: r for r in mainhtml.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[k].text == "\n\n".join(f"{k} {i}" for i in range(20_000)) and got[k].n_shared == 3_000 for k in range(2))


def test_letters_whose_lower_case_is_longer_move_nothing():
    assert texts("\u0130" * 30 + "<script>x</SCRIPT><article><p>A</p></article>") == ["A"]


def test_columns_with_names_of_the_results(spark):
    rows = spark.createDataFrame([(1, "https://a.example/", "<p>x</p>", "t", "h", "p", 3)], "page_id long, url string, html string, text string, host string, path string, row_key int")
    assert [tuple(r) for r in mainhtml.main_text(rows).collect()] == [(1, "https://a.example/", "x", 0)]


def test_names_that_only_hold_a_known_word_stay(spark):
    page = """<article><h1>Title</h1><div class="share-price">Price 5</div><section id="related-work">Work</section><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.</p>
    <svg><text>Label</text></svg><object data="a"><p>Instead</p></object><div class="share-buttons top">S</div><div id="ad-slot-2">A</div><div class="cookie-consent-banner">C</div>
    <div class="x comments-thread">R</div><ul class="related-articles"><li>L</li></ul><div class="sidebar left">B</div></article>"""
    rows = spark.createDataFrame([(1, "http://h.example/a", page)], "page_id long, url string, html string")
    assert mainhtml.main_text(rows).first().text.split("\n\n") == ["Title", "Price 5", "Work", "Let x=2 hold.", "Label", "Instead"]
