import hashlib
import math
import random
import re
from collections import defaultdict

from folioflow.llm import queries, urlfilter
from tests.conftest import SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule(host, path):
    fits = [r for r, _ in queries.URL_RULES for at, _, rest in [r.partition("/")] if (host == at or host.endswith("." + at)) and path.startswith("/" + rest)]
    return max(fits, key=len, default=None)


def test_rules_against_brute_force(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op4_url_filter(spark, SMALL).collect()}
    assert len(got) == len(pages)
    for p in pages:
        r = got[p.page_id]
        assert (r.host, r.path) == parts(p.url) and r.rule == rule(r.host, r.path)
        assert r.verdict == dict(queries.URL_RULES)[r.rule] if r.rule else r.verdict in ("allow", "block")


def test_bad_templates_are_rejected_and_odd_rows_kept(spark):
    rows = [(i, f"http://H.example/{'junk' if i % 2 else 'good'}/{i}?x") for i in range(200)]
    rows += [(500, None), (None, "http://h.example/junk/7"), (501, "no url"), (502, "ftp://Net/"), (503, "http://x.net"), (503, "http://x.net"), (504, "http://h.example/" + "a/" * 40), (505, "http://ärger.NET/EN/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 120)] + [(None, 1), (3, None)], "doc_id long, bad int")
    got = urlfilter.judge(pages, queries.URL_RULES, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.host == "h.example" and r.page_id != 504:  # that one has no labels but its half-bad host's
            assert r.verdict == ("block" if r.path.startswith("/junk") else "allow")
    by = {r.page_id: r for r in got}
    assert (by[500].host, by[500].path, by[500].rule) == ("", "", None) and by[502].rule == "net/" and by[503].rule is None and by[505].host == "ärger.net"
    assert urlfilter.judge(pages.limit(0), queries.URL_RULES, labels).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages, [], None).collect()} == {"allow"}


def words(n):
    return [a + b for a in "abcdefghijklmnop" for b in "qrstuvwxyz"][:n]


def test_bad_directory_among_many_is_rejected(spark):
    pages, labels = [], []
    for host, names, each, bad in (("few.example", words(50), 20, {"aq"}), ("many.example", words(51), 20, {"aq"}), ("tiny.example", words(60), 1, {"aq", "bq"})):
        for name in names:
            for _ in range(each):
                pages.append((len(pages), f"https://{host}/{name}/{len(pages)}"))
                labels.append((len(labels), int(name in bad)))
    got = urlfilter.judge(spark.createDataFrame(pages, "page_id long, url string"), [], spark.createDataFrame(labels, "doc_id long, bad int")).collect()
    blocked = {(r.host, r.path.split("/")[1]) for r in got if r.verdict == "block"}
    assert blocked == {("few.example", "aq"), ("many.example", "aq")}
    assert {r.template for r in got if r.verdict == "block"} == {"/aq/*"}


def test_small_bad_directories_are_merged_with_each_other(spark):
    """None of 30 directories stands out alone, nor does the host; half of the pages have no label."""
    names = [f"{a}{b}" for a in words(160) for b in "xy"][:300]
    pages, labels = [], {}
    for k, name in enumerate(names):
        for i in range(40):
            pages.append((len(pages), f"https://wide.example/{name}/{len(pages)}"))
            if i < 3:
                labels[len(pages) - 1] = int(k < 30)
    got = urlfilter.judge(spark.createDataFrame(pages, "page_id long, url string"), [], spark.createDataFrame(list(labels.items()), "doc_id long, bad int")).collect()
    blocked = {r.page_id for r in got if r.verdict == "block"}
    assert blocked == set(range(30 * 40)) and len({r.template for r in got if r.verdict == "block"}) == 30


def test_noise_makes_no_branch(spark):
    """Labels that are bad by chance alone, at any rate below the limit, block nothing."""
    draw = random.Random(8)
    names = [f"{a}{b}" for a in words(160) for b in "xy"][:300]
    for rate in (0.05, 0.15, 0.3):
        pages = [(i, f"https://noise.example/{names[i % 300]}/{i}") for i in range(1500)]
        labels = [(i, int(draw.random() < rate)) for i in range(1500)]
        got = urlfilter.judge(spark.createDataFrame(pages, "page_id long, url string"), [], spark.createDataFrame(labels, "doc_id long, bad int"))
        assert got.where("verdict = 'block'").count() == 0


def test_only_rejected_paths_are_looked_up(spark, monkeypatch):
    pages = [(i, f"https://slugs.example/{'good' if i % 4 else 'junk'}/{''.join(words(160)[int(c)] for c in str(i))}/{i}") for i in range(4000)]
    rows = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 400)], "doc_id long, bad int")
    kept = []
    real = urlfilter._looked_up
    monkeypatch.setattr(urlfilter, "_looked_up", lambda r, f: kept.append(f.count()) or real(r, f))
    assert {r.page_id for r in urlfilter.judge(rows, [], labels).where("verdict = 'block'").collect()} == set(range(0, 4000, 4))
    assert kept == [1000]
    monkeypatch.setattr(urlfilter, "FEW", 10)
    monkeypatch.setattr(urlfilter, "HOT_PATH", 0)
    assert urlfilter.judge(rows, [], labels).where("verdict = 'block'").count() == 1000


def test_segments_at_any_depth_tell_pages_apart(spark):
    paths = [f"en/2024/05/12/news/local/{'casino' if i % 2 else 'council'}/{i}" for i in range(120)]
    # a level with many directories below one with few, and one path of 400 segments
    paths += [f"a/b/c/d/e/f/g/{name}/x/{120 + 20 * k + i}" for k, name in enumerate(words(60)) for i in range(20)] + ["a/" * 400 + "1320"]
    pages = spark.createDataFrame([(i, f"https://deep.example/{p}") for i, p in enumerate(paths)], "page_id long, url string")
    labels = spark.createDataFrame([(i, int("casino" in p or "/cq/" in p)) for i, p in enumerate(paths[:-1])], "doc_id long, bad int")
    got = {r.page_id: r for r in urlfilter.judge(pages, [], labels).collect()}
    assert {i for i, r in got.items() if r.verdict == "block"} == {i for i, p in enumerate(paths) if "casino" in p or "/cq/" in p}
    assert {r.template for r in got.values()} == {None, "/en/{n}/{n}/{n}/news/local/casino/*", "/a/b/c/d/e/f/g/cq/*/*"}


def shape(x):
    bare = re.sub(r"\.[A-Za-z]{1,5}\Z", "", x)
    if re.fullmatch("[0-9]+", bare):
        return "{n}"
    if re.fullmatch("[0-9a-fA-F-]{8,}", bare) and re.search("[0-9]", bare):
        return "{x}"
    return "*" if re.search("[0-9]{3}|[0-9].*[0-9].*[0-9]", bare) or len(bare) > 40 else bare


def apart(bad, n, all_bad, all_n, tested):
    def fit(b, k):
        return sum(x * math.log(x / k) for x in (b, k - b) if x > 0)

    return 2 * (fit(bad, n) + fit(all_bad - bad, all_n - n) - fit(all_bad, all_n)) > 4 + 2 * math.log(max(tested, 1))


def plain_verdicts(pages, labels):
    """(page_id, path) to the method's verdict, by a walk over each host's tree."""
    rows, out = defaultdict(list), {}
    for key, url in pages:
        host, path = parts(url)
        m = re.search(r"([0-9]{1,18})(?:\.[A-Za-z]{1,5})?/*\Z", path)
        number = int(m[1]) if m else None
        rows[host].append((key, path, tuple(shape(x) for x in path.split("/") if x), labels.get(number), int(hashlib.md5(str(number).encode()).hexdigest()[:8], 16) % 2))
    known = [r[3] for of_host in rows.values() for r in of_host if r[3] is not None]
    base = sum(known) / len(known) if known else 0.0
    for of_host in rows.values():
        count = defaultdict(lambda: [[0, 0], [0, 0]])  # by half: labelled, bad
        for _, _, way, bad, half in of_host:
            for d in range(len(way) + 1):
                if bad is not None:
                    count[way[:d]][half][0] += 1
                    count[way[:d]][half][1] += bad
        total = {k: tuple(map(sum, zip(*v, strict=True))) for k, v in count.items()}
        children = defaultdict(list)
        for node in total:
            if node:
                children[node[:-1]].append(node)
        marks = {}
        for above, below in children.items():
            n, bad = total[above]
            single = [c for c in below if apart(total[c][1], total[c][0], bad, n, len(below))]
            marks |= {c: total[c] for c in single}
            rest = [c for c in below if c not in single]
            sides = {True: [0, 0], False: [0, 0]}
            for own in (0, 1):
                pool = [sum(count[c][own][i] for c in rest) for i in (0, 1)]
                for c in rest:
                    if count[c][own][0]:
                        high = count[c][own][1] / count[c][own][0] > pool[1] / pool[0]
                        for i in (0, 1):
                            sides[high][i] += count[c][1 - own][i]
            (hn, hb), (ln, lb) = sides[True], sides[False]
            if len(rest) > 1 and hn and ln:
                high, low = (hb + 0.5) / (hn + 1), (lb + 0.5) / (ln + 1)
                if high > low and apart(hb, hn, hb + lb, hn + ln, 1):
                    for c in rest:
                        k, b = total[c]
                        marks[c] = (hn, hb) if b * math.log(high / low) + (k - b) * math.log((1 - high) / (1 - low)) > 0 else (ln, lb)
        n, bad = total.get((), (0, 0))
        rate = (bad + 10 * base) / (n + 10)
        for key, path, way, _, _ in of_host:
            node = way
            while node and node not in marks:
                node = node[:-1]
            k, b = marks.get(node, (n, bad))
            out[key, path] = "block" if n and (b + 10 * rate) / (k + 10) >= 0.5 else "allow"
    return out


def test_every_verdict_against_brute_force(spark):
    """The whole query over the small table with a planted bad branch, and a random tree."""
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    draw = random.Random(5)
    names = words(45)
    pages += [(10_000 + i, f"https://www.big.example.org/{draw.choice(['a', 'b', 'c'])}/{draw.choice(names)}/{draw.choice(['x', 'y', 'z9'])}/{10_000 + i}.html") for i in range(3000)]
    pages += [(20_000 + i, f"https://blog.example.org/{'spam' if i % 3 else 'news'}/{20_000 + i}") for i in range(90)]
    labels = {i: int(p.split("/")[3] == "c" and "z9" in p or "/spam/" in p or draw.random() < 0.1) for i, p in pages if i >= 10_000 and draw.random() < 0.7}
    want = plain_verdicts(pages, labels)
    got = urlfilter.judge(spark.createDataFrame(pages, "page_id long, url string"), queries.URL_RULES, spark.createDataFrame(list(labels.items()), "doc_id long, bad int")).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.verdict == (dict(queries.URL_RULES)[r.rule] if r.rule else want[r.page_id, r.path]), r
    blocked = {r.page_id for r in got if r.rule is None and r.verdict == "block"}
    assert {i for i, p in pages if "/spam/" in p} <= blocked and any(10_000 <= i < 20_000 for i in blocked) and not any("/news/" in p and i in blocked for i, p in pages)


def test_columns_with_names_of_the_results(spark):
    rows = spark.createDataFrame([(1, "http://a.net/x", "h", "p", "r", "v", "t", 0)], "page_id long, url string, host string, path string, rule string, verdict string, template string, doc_id long")
    assert [tuple(r)[:5] for r in urlfilter.judge(rows, queries.URL_RULES).collect()] == [(1, "a.net", "/x", "net/", "block")]
