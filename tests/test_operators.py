import random
import re
from urllib.parse import urlparse

import pytest
from folioflow import schemas
from folioflow.functions import text as T
from folioflow.functions import urls as U
from folioflow.functions.fold import fold
from folioflow.operators import classifier, downloads, papers, responses, resultlog
from folioflow.sources import fetch, files, jsonl, remote
from pyspark.sql import functions as F


def test_latest_result_is_the_fold_in_append_order(spark):
    chance = random.Random(5)
    rows = [(s, str(chance.randrange(40)), str(chance.randrange(3)), chance.random() < 0.6) for s in range(1500)]
    want = {}
    for r in rows:
        old = want.get(r[1])
        if old is None or r[3] or not (old[3] and old[2] == r[2]):
            want[r[1]] = r
    got = resultlog.latest(spark.createDataFrame(rows, "seq long, id string, key string, ok boolean"))
    assert {r.id: (r.seq, r.id, r.key, r.ok) for r in got.collect()} == want


HEADING = re.compile(r"[ \t]*(?:\d+(?:\.\d+)*[.)]?[ \t]+)?(?:REFERENCES|References|Bibliography)[ \t]*\Z").match
AGAIN = re.compile(r"[ \t]*(?:Appendix|Acknowledg|Methods[ \t]*\Z)").match
FIGURE = re.compile(r"[ \t]*(?:Fig\.|Table)[ \t]*\d").match


def cut(pages):
    """Line by line: what a list of lines keeps after the last heading of the paper."""
    book = [p.split("\n") for p in pages]
    marks = [(i, k) for i, lines in enumerate(book) for k, line in enumerate(lines) if HEADING(line)]
    if not marks:
        return pages
    out, (page, line) = list(pages), max(marks)
    for i in range(page, len(book)):
        before, after = (book[i][:line], book[i][line:]) if i == page else ([], book[i])
        keep, resumed = [], False
        for text in after:
            resumed = resumed or bool(AGAIN(text))
            if keep or resumed or FIGURE(text):
                keep.append(text)
        out[i] = "\n\n".join(x for x in ("\n".join(before).rstrip(), "\n".join(keep)) if x).strip()
        if resumed:
            break
    return out


def test_reference_lists_are_cut(spark):
    chance = random.Random(2)
    lines = ["text one", "References", "2.1 REFERENCES ", "Appendix B", "Acknowledgements", "Methods", "Methods used", "Fig. 3 shows", "Table 1", "", "  Bibliography", "[1] A. B."]
    books = [["\n".join(chance.choice(lines) for _ in range(chance.randrange(6))) for _ in range(chance.randrange(1, 5))] for _ in range(150)]
    rows = [(str(b), n + 1, p) for b, book in enumerate(books) for n, p in enumerate(book)]
    got = {(r.paper, r.page): r.text for r in papers.strip_references(spark.createDataFrame(rows, "paper string, page int, text string")).collect()}
    for b, book in enumerate(books):
        assert [got[str(b), n + 1] for n in range(len(book))] == cut(book)


URLS = ["https://ARXIV.org/abs/1", "http://user@host.example:80/a?b#c", "//no.scheme/x", "plain", "https://a_b.example/p|q r", "http://[::1]x/", "https://doi.org?x=/y", "mailto:x@y", ""]


def test_hosts(spark):
    rows = spark.createDataFrame([(u,) for u in URLS], "u string").select("u", U.host(F.col("u")).alias("h")).collect()
    for r in rows:
        if "[" not in r.u:
            assert r.h == (urlparse(r.u).hostname or "")


def test_percent_coding_and_white_space(spark):
    row = spark.createDataFrame([("a+b%20c%zz", "a+b%20c", "x/y z*~", "a \t b  \n\n\n\n c ")], "bad string, good string, plain string, white string")
    got = row.select(U.percent_decode(F.col("bad")), U.percent_decode(F.col("good")), U.percent_encode(F.col("plain")), U.percent_encode(F.col("plain"), True), T.normalise_white(F.col("white")), fold(F.lit("ﬁn"))).first()
    assert list(got) == ["a+b%20c%zz", "a+b c", "x%2Fy%20z%2A~", "x/y%20z%2A~", "a b\n\n c", "fin"]


def test_ladders(spark):
    F_array = F.array().cast("array<string>")
    cases = [(403, "cloudflare", "text/html", False, "blocked"), (200, "nginx", "text/html", False, "permanent"), (200, "nginx", None, False, None), (200, "nginx", "text/html", True, None), (429, "nginx", "x", False, "transient"), (503, "AkamaiGHost", "x", False, "transient"), (404, "nginx", "x", False, "permanent")]
    df = spark.createDataFrame(cases, "status int, server string, kind string, magic boolean, want string")
    bot = downloads.bot_protection(F.col("status"), F.col("server"), F_array, F.lit(False))
    got = df.select("want", downloads.response_failure(F.col("status"), F.col("kind"), F.col("magic"), bot)["category"].alias("got")).collect()
    assert all(r.want == r.got for r in got)
    # the same responses through the boundary
    class Replies:
        def get(self, url):
            status, server, kind, magic, _ = cases[int(url.rpartition("/")[2])]
            return status, {"Server": server} | ({"Content-Type": kind} if kind else {}), b"%PDF-" if magic else b"", url

    urls = spark.createDataFrame([(k, f"j{k}", f"https://h{k}.example/{k}") for k in range(len(cases))], "seq long, bibcode string, url string")
    through = {r.seq: r.category for r in fetch.fetch(urls, Replies(), NoWait, check=lambda rows: rows.withColumn("invalid", F.lit(None).cast("string"))).collect()}
    assert through == {k: c[-1] for k, c in enumerate(cases)}


class Service:
    def get(self, url):
        if "down" in url:
            raise OSError("no route")
        if "wall" in url:
            return 403, {"server": "cloudflare"}, b"", url
        return 200, {"content-type": "application/pdf"}, b"%PDF-1.7" if "good" in url else b"<html>", url


class NoWait(fetch.Spacer):
    def __init__(self):
        super().__init__(sleep=lambda s: None)


def test_fetch_blocks_hosts_and_keeps_spacing(spark):
    urls = [(1, "a", "https://wall.example/1"), (2, "b", "https://wall.example/2"), (3, "a", "https://good.example/1"), (4, "b", "https://down.example/1"), (5, "c", "https://other.example/1")]
    got = {r.seq: (r.status, r.category) for r in fetch.fetch(spark.createDataFrame(urls, "seq long, bibcode string, url string"), Service(), NoWait).collect()}
    assert got == {1: ("failed", "blocked"), 2: ("skipped", "blocked"), 3: ("downloaded", None), 4: ("failed", "transient"), 5: ("failed", "permanent")}
    now, starts = [0.0], []
    spacer = fetch.Spacer(clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    for u in ("https://arxiv.org/1", "https://x.example", "https://arxiv.org/2"):
        spacer.run(u, lambda: starts.append(now[0]))
    assert starts == [0.0, 3.0, 15.0]


def test_json_lines(spark, tmp_path):
    def put(text):
        (tmp_path / "t.jsonl").write_text(text)
        return sorted(r.a for r in jsonl.read(spark, str(tmp_path / "t.jsonl"), "a int").collect())

    assert put('{"a":1}\n\n{"a":2}\n') == [1, 2] and put('{"a":1}\n{"a":2}') == [1, 2] and put('{"a":1}\n{"a":') == [1]
    for bad in ('{"a":1}\n{"a":\n', '{"a":\n{"a":1}\n'):
        with pytest.raises(jsonl.TornTable):
            put(bad)


def test_remote_index(spark):
    link = '{"access":"open","type":"pdf","url":"https://x.example/1"}'
    rows = [{"bibcode": f"b{i}", "links_data": [link] if i else None, "doi": [f"10.1/{i}"], "abstract": "a"} for i in range(5)]
    got = remote.search(spark, remote.MemoryTransport(rows), "q", limit=4, rows=2).collect()
    assert [r.bibcode for r in got] == ["b0", "b1", "b2", "b3"] and got[0].links_data == [] and got[1].links_data[0].url == "https://x.example/1"
    assert remote.library(spark, remote.MemoryTransport(rows, lost=2), rows=3).count() == 5
    with pytest.raises(Exception, match="empty page"):
        remote.search(spark, remote.MemoryTransport(rows, lost=2), "q", rows=3).collect()
    with pytest.raises(ValueError):
        remote.search(spark, remote.MemoryTransport(rows), "q", limit=0)
    with pytest.raises(ValueError):
        remote.auth_header("")


class Stubborn:
    def decide(self, pages):
        return {"include": "YES", "basis": ["REVIEW"], "mission_mentioned": True, "evidence": [{"page": 9, "reason": "x"}]}


def test_classifier_asks_twice_and_checks_pages(spark):
    pages = spark.createDataFrame([("p", 1, "the one"), ("p", 2, " "), ("q", 1, "")], "paper string, page int, text string")
    row, = classifier.classify(pages, Stubborn).collect()
    assert row.paper == "p" and row.include is None and len(row.errors) == 2 and "not sent" in row.errors[0]
    row, = classifier.classify(pages).collect()
    assert row.include == "UNCERTAIN" and row.errors == []


class Moody:
    """A paper each for an answer with provenance, an error of one paper and one of the account."""

    def decide(self, pages):
        text = " ".join(pages.values())
        if "timeout" in text:
            raise classifier.ServiceError("", "timeout")
        if "closed" in text:
            raise classifier.ServiceError("no such model", "not_found")
        if "odd" in text:
            return {"include": "NO"}
        return classifier.TermClassifier().decide(pages) | {"response": {"model": "m-2", "request_id": "r1", "input_tokens": 7, "output_tokens": 3}}


def test_records_of_answers_and_errors(spark):
    pages = spark.createDataFrame([("a", 1, "the one"), ("a", 2, "two"), ("b", 1, "timeout"), ("c", 1, "odd"), ("d", 1, "closed"), ("e", 1, " ")], "paper string, page int, text string")
    decided = classifier.classify(pages, Moody)
    jobs = spark.createDataFrame([(x, x, f"k{x}", f"s{x}") for x in "abcde"], "id string, bibcode string, key string, sha string")
    log = resultlog.records(jobs, decided, papers.context(pages).drop("context"), model="m", effort="low", pipeline="p", prompt_version="v", prompt_sha256="h", start=5)
    assert log.schema.simpleString() == spark.createDataFrame([], schemas.RESULTS).schema.simpleString()
    got = {r.id: r for r in log.collect()}
    assert set(got) == set("abce") and min(r.seq for r in got.values()) >= 5
    a = got["a"]
    assert (a.evaluation_key, a.pages_sent, a.characters_sent, a.result.status, a.result.classification.include, a.result.pdf_sha256) == ("ka", 2, 10, "CLASSIFIED", "UNCERTAIN", "sa")
    assert a.result.provenance.asDict() == {"pipeline_version": "p", "prompt_version": "v", "prompt_sha256": "h", "model": "m-2", "reasoning_effort": "low", "request_id": "r1", "input_tokens": 7, "output_tokens": 3}
    assert got["b"].result.errors == ["ServiceError"] and got["b"].result.provenance.model == "m" and got["b"].result.classification is None
    assert got["c"].result.errors == ["'basis'"] and got["e"].result.errors == [resultlog.NO_TEXT] and got["e"].pages_sent == 0
    broken = schemas.result_violations(F.col("result.status"), F.col("result.classification").isNotNull(), F.col("result.errors"))
    assert log.where(F.size(broken) > 0).count() == 0
    with pytest.raises(classifier.RunStopped, match="no such model"):
        classifier.stopped(decided)


def test_errors_that_stop_a_run_are_told_alike(spark):
    cases = [(k, c, p) for k in ("authentication", "permission_denied", "not_found", "bad_request", "rate_limit", "timeout") for c in (None, "insufficient_quota", "slow") for p in (None, "text.format", "reasoning.effort", "input")]
    rows = spark.createDataFrame(cases, "kind string, code string, param string")
    for r in rows.withColumn("stops", responses.stops_run(F.col("kind"), F.col("code"), F.col("param"))).collect():
        assert r.stops == responses.account_wide(r.kind, r.code, r.param)


def test_files(spark, tmp_path):
    for name in ("b/2.pdf", "b.pdf", "a/1.PDF", "a/skip.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    found = files.listing(spark, str(tmp_path))
    assert [r.id for r in files.jobs(found).collect()] == ["1", "2", "b"] and files.jobs(found, 2).count() == 2
    out = files.save(spark.createDataFrame([("k", f"{tmp_path}/out/k.pdf", b"x")], "id string, target string, content binary")).collect()
    assert out[0].status == "downloaded" and (tmp_path / "out/k.pdf").read_bytes() == b"x"


def test_two_decimals_are_those_of_the_exact_value(spark):
    shares = sorted({a / b for b in (*range(1, 41), 200, 400, 625) for a in range(b + 1)})
    rows = spark.createDataFrame([(x,) for x in shares], "x double").select("x", T.two_decimals(F.col("x")).alias("t")).collect()
    assert [r.t for r in rows] == [f"{r.x:.2f}" for r in rows]
