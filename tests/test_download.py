import hashlib

import pytest
from folioflow import schemas
from folioflow.sources import download_stage, fetch, files
from pyspark.sql import functions as F

ABSTRACT = " ".join(f"word{chr(97 + i)}{chr(97 + i)}" for i in range(24))
GOOD = b"%PDF-1.7 " + ABSTRACT.encode()


class NoWait(fetch.Spacer):
    def __init__(self):
        super().__init__(sleep=lambda s: None)


class Web:
    """Deterministic answers; every request is noted in a file."""

    def __init__(self, log):
        self.log = str(log)

    def get(self, url):
        with open(self.log, "a") as out:
            out.write(url + "\n")
        if "down" in url:
            raise OSError("no route")
        if "moved" in url:
            return 403, {"server": "cloudflare"}, b"", "https://wall.example/landing"
        if "other" in url:
            return 200, {"content-type": "application/pdf"}, b"%PDF-1.7 something else altogether", url
        return 200, {"content-type": "application/pdf"}, GOOD if "good" in url else b"<html>", url


class Works:
    def work(self, doi):
        if doi == "10.1/broken":
            raise OSError("timeout")
        if doi == "10.1/open":
            return {"ids": {}, "locations": [{"is_oa": True, "pdf_url": "https://bad.example/5"}, {"is_oa": True, "pdf_url": "http://good.example/open", "landing_page_url": None}, {"is_oa": False, "pdf_url": "https://good.example/closed"}]}
        return None


def pages(rows):
    """The text after the signature is one page."""
    return rows.select("id", F.lit(1).alias("page"), F.regexp_replace(F.decode("content", "ISO-8859-1"), r"%PDF-1.7 ?", "").alias("text"), F.lit(None).cast("string").alias("error"))


def record(bibcode, *urls, doi=None, sha=None):
    return {"bibcode": bibcode, "links_data": [], "doi": [doi] if doi else [], "abstract": ABSTRACT, "pdf_links": list(urls), "pdf_sha256": sha}


def test_the_stage_end_to_end(spark, tmp_path):
    folder, log = tmp_path / "pdfs", tmp_path / "requests"
    folder.mkdir()
    (folder / "have.pdf").write_bytes(GOOD)
    (folder / "clash.pdf").write_bytes(GOOD)
    (folder / "spoilt.pdf").write_bytes(b"no file")
    rows = [
        record("first", "https://good.example/1", "https://good.example/never"), record("second", "https://bad.example/2", "https://good.example/2"),
        record("moved", "https://moved.example/3", "https://wall.example/3"), record("zlate", "https://bad.example/8", "https://wall.example/4"), record("text", "https://other.example/6"),
        record("open", "https://bad.example/5", doi="10.1/open"), record("lost", "https://down.example/7", doi="10.1/broken"), record("none"),
        record("have", "https://good.example/have"), record("clash", "https://good.example/clash", sha=hashlib.sha256(b"x").hexdigest()), record("spoilt", "https://good.example/spoilt"),
    ]
    records = spark.createDataFrame(rows, schemas.CANDIDATES)
    queue = spark.createDataFrame([(k, "t", [], c, ["x"], None) for k, c in (("gone", "blocked"), ("first", "blocked"), ("none", "transient"))], schemas.MANUAL)
    attempts, entries, counts = download_stage.run(records, str(folder), Web(log), Works(), extract=pages, make_spacer=NoWait, queue=queue)
    asked = log.read_text().split()
    assert len(asked) == len(set(asked)) and not {"https://good.example/never", "https://wall.example/3", "https://wall.example/4", "https://good.example/have", "https://good.example/clash", "https://good.example/closed"} & set(asked)
    assert {p.name for p in folder.iterdir() if p.suffix == ".pdf"} == {f"{k}.pdf" for k in ("first", "second", "open", "have", "clash", "spoilt")}
    assert (folder / f"spoilt.{hashlib.sha256(b'no file').hexdigest()}.rejected").read_bytes() == b"no file" and (folder / "spoilt.pdf").read_bytes() == GOOD
    left = {r.id: (r.category, list(r.errors)) for r in entries.collect()}
    assert left == {
        "moved": ("blocked", ["HTTP 403 (bot protection: Cloudflare)", "skipped: wall.example already blocked a request in this run"]), "zlate": ("blocked", ["content has no PDF signature", "skipped: wall.example already blocked a request in this run"]),
        "text": ("permanent", ["PDF text does not match the abstract (overlap 0.00)"]), "lost": ("transient", ["open-access lookup failed: timeout", "no route"]),
        "none": ("permanent", ["no open-access PDF URL was found in the search index (no DOI for the open-access source)"]), "clash": ("permanent", [download_stage.CONFLICT]),
    }
    assert counts == {"records": 11, "existing": 1, "attempted": 9, "downloaded": 4, "failed": 6, "manual_queue": 6}
    asked_for = {r.id: (list(r.urls), r.target) for r in entries.collect()}
    assert asked_for["moved"] == (["https://moved.example/3", "https://wall.example/3"], f"{folder}/moved.pdf") and asked_for["none"][0] == [] and entries.where("updated_at is null").count() == 0
    by = {(r.bibcode, r.method): r.status for r in attempts.collect()}
    assert by["open", "open_access"] == "downloaded" and by["lost", "open_access"] == "failed" and by["spoilt", "existing"] == "failed"
    assert attempts.where("at is null").count() == 0


def test_a_file_that_cannot_be_kept(spark, tmp_path):
    (tmp_path / "blocked").write_text("a file where the folder should be")
    records = spark.createDataFrame([record("a", "https://good.example/1")], schemas.CANDIDATES)
    attempts, entries, counts = download_stage.run(records, str(tmp_path / "blocked"), Web(tmp_path / "log"), make_spacer=NoWait)
    assert [(r.method, r.status, r.category) for r in attempts.collect()] == [("write", "failed", "transient")]
    assert counts["failed"] == 1 and [r.category for r in entries.collect()] == ["transient"]


def test_missing_files_of_cases_are_prepared(spark, tmp_path):
    good = hashlib.sha256(GOOD).hexdigest()
    (tmp_path / "one").mkdir()
    (tmp_path / "one/have.pdf").write_bytes(GOOD)

    def case(name, folder, bibcode, sha=good, url="https://good.example/"):
        return {"id": name, "path": f"{tmp_path}/{folder}/{name}.pdf", "pdf_sha256": sha, "bibcode": bibcode, "pdf_links": [f"{url}{name}"], "doi": []}

    cases = [case("have", "one", None), case("lost", "one", "lost"), case("far", "two", "far"), case("bad", "two", "bad", url="https://bad.example/")]
    web = Web(tmp_path / "log")
    got = download_stage.prepare(spark.createDataFrame(cases, schemas.CASES), web, extract=pages, make_spacer=NoWait)
    assert (got["records"], got["downloaded"], got["failed"]) == (3, 2, 1) and len((tmp_path / "log").read_text().split()) == 3
    assert (tmp_path / "one/lost.pdf").read_bytes() == GOOD and (tmp_path / "two/far.pdf").read_bytes() == GOOD
    with pytest.raises(ValueError, match="cannot be acquired"):
        download_stage.prepare(spark.createDataFrame([case("x", "three", "y")], schemas.CASES), web, make_spacer=NoWait)


class Host:
    """One host that serves files until a given request and is a wall from then on."""

    def __init__(self, log, wall=None):
        self.log, self.wall = str(log), wall

    def get(self, url):
        with open(self.log, "a") as out:
            out.write(url + "\n")
        n = int(url.rpartition("/")[2])
        if self.wall is not None and n >= self.wall:
            return 403, {"server": "cloudflare"}, b"", "https://landing.example/x" if "moved" in url else url
        if "forbidden" in url:
            return 403, {"server": "nginx"}, b"", url
        return (404, {}, b"", url) if "gone" in url else (200, {"content-type": "application/pdf"}, GOOD, url)


def asked_rounds(spark, monkeypatch, *args, **more):
    """The attempts by seq, and the rounds that were needed."""
    rounds, real = [], fetch.lane
    monkeypatch.setattr(fetch, "lane", lambda *a, **b: rounds.append(1) or real(*a, **b))
    out = fetch.fetch(*args, make_spacer=NoWait, **more)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan  # whatever the rounds
    return {r.seq: (r.status, r.category) for r in out.collect()}, len(rounds)


URLS = "seq long, bibcode string, url string"


def test_a_thousand_urls_of_one_host_take_one_round(spark, tmp_path, monkeypatch):
    urls = spark.createDataFrame([(i, f"j{i}", f"https://one.example/{i}") for i in range(1000)], URLS)
    got, rounds = asked_rounds(spark, monkeypatch, urls, Host(tmp_path / "log"), most=10_000)
    assert set(got.values()) == {("downloaded", None)} and len(got) == 1000 and rounds == 2  # the last one finds nothing left
    assert [int(x.rpartition("/")[2]) for x in (tmp_path / "log").read_text().split()] == list(range(1000))


def test_a_job_goes_on_after_sure_failures_in_the_same_round(spark, tmp_path, monkeypatch):
    urls = spark.createDataFrame([(i, "j", f"https://one.example/gone/{i}") for i in range(200)] + [(200, "j", "https://one.example/200"), (201, "j", "https://one.example/201")], URLS)
    got, rounds = asked_rounds(spark, monkeypatch, urls, Host(tmp_path / "log"))
    assert rounds == 2 and got[200] == ("downloaded", None) and 201 not in got and sum(v == ("failed", "permanent") for v in got.values()) == 200


def test_a_wall_in_the_middle_ends_a_host(spark, tmp_path, monkeypatch):
    urls = spark.createDataFrame([(i, f"j{i}", f"https://one.example/{i}") for i in range(60)] + [(100 + i, f"j{i}", f"https://two.example/{i % 40}") for i in range(60)], URLS)
    got, rounds = asked_rounds(spark, monkeypatch, urls, Host(tmp_path / "log", wall=40))
    asked = (tmp_path / "log").read_text().split()
    assert "https://one.example/40" in asked and "https://one.example/41" not in asked
    assert all(got[i] == ("downloaded", None) for i in range(40)) and got[40] == ("failed", "blocked")
    assert all(got[i] == ("skipped", "blocked") and got[100 + i] == ("downloaded", None) for i in range(41, 60)) and rounds <= 4


def test_forbidden_answers_that_are_no_wall_do_not_close_a_host(spark, tmp_path, monkeypatch):
    urls = spark.createDataFrame([(i, f"j{i}", f"https://one.example/{'forbidden/' if i % 3 == 0 else ''}{i}") for i in range(9)], URLS)
    got, rounds = asked_rounds(spark, monkeypatch, urls, Host(tmp_path / "log"))
    assert got == {i: ("failed", "permanent") if i % 3 == 0 else ("downloaded", None) for i in range(9)} and rounds == 5


def test_a_redirect_to_a_wall_closes_the_host_that_answered(spark, tmp_path, monkeypatch):
    urls = spark.createDataFrame([(1, "a", "https://moved.example/5"), (2, "b", "https://landing.example/1"), (3, "c", "https://moved.example/2")], URLS)
    got, _ = asked_rounds(spark, monkeypatch, urls, Host(tmp_path / "log", wall=5))
    assert got == {1: ("failed", "blocked"), 2: ("skipped", "blocked"), 3: ("downloaded", None)}


def test_small_rounds_and_earlier_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fetch, "AHEAD", 5)
    urls = spark.createDataFrame([(i, f"j{i}", f"https://h{i % 2}.example/{i}") for i in range(12)], URLS)
    before = spark.createDataFrame([(-1, None, "x", "u", "https://h1.example/z", "http", "failed", "blocked", "e", None)], fetch.ATTEMPTS)
    got, rounds = asked_rounds(spark, monkeypatch, urls, Host(tmp_path / "log"), most=2, before=before)
    assert got == {i: ("skipped", "blocked") if i % 2 else ("downloaded", None) for i in range(12)} and rounds <= 5
    assert fetch.fetch(urls.limit(0), Host(tmp_path / "log"), NoWait).count() == 0


def test_ids_stay_in_their_folder(spark, tmp_path):
    odd = ["../up", "a/b", ".hidden", "_marked", "50%2Fx", "plain&+1"]
    records = spark.createDataFrame([record(k, f"https://good.example/{i}") for i, k in enumerate(odd)], schemas.CANDIDATES)
    _, _, counts = download_stage.run(records, f"{tmp_path}/pdfs", Web(tmp_path / "log"), make_spacer=NoWait)
    assert counts["downloaded"] == len(odd) and sorted(p.name for p in tmp_path.iterdir()) == ["log", "pdfs"]
    assert {r.id for r in files.listing(spark, f"{tmp_path}/pdfs").collect()} == set(odd)
    assert download_stage.run(records, f"{tmp_path}/pdfs", Web(tmp_path / "log"), make_spacer=NoWait)[2]["existing"] == len(odd)


def test_only_new_or_changed_files_are_opened(spark, tmp_path):
    import os

    for i in range(6):
        (tmp_path / f"{i}.pdf").write_bytes(b"%d first" % i)
    known = files.hashed(files.listing(spark, str(tmp_path)))
    known = spark.createDataFrame(known.collect(), known.schema)
    for i, keep_time in ((1, True), (2, False), (3, False)):
        at = (tmp_path / f"{i}.pdf").stat().st_mtime_ns
        (tmp_path / f"{i}.pdf").write_bytes(b"%d other" % i)
        os.utime(tmp_path / f"{i}.pdf", ns=(at, at) if keep_time else (at + 10**9,) * 2)
    (tmp_path / "9.pdf").write_bytes(b"9 other")
    sha = lambda x: hashlib.sha256(x).hexdigest()
    got = {r.id: r.pdf_sha256 for r in files.hashed(files.listing(spark, str(tmp_path)), known).collect()}
    # of 1 neither length nor time tell that it changed, so that it kept its hash shows it was not opened
    assert got == {str(i): sha(b"%d %s" % (i, b"other" if i in (2, 3, 9) else b"first")) for i in (0, 1, 2, 3, 4, 5, 9)}
    opened = files.contents(files.jobs(files.listing(spark, str(tmp_path)), 2).select("path", "id")).collect()
    assert [(r.id, bytes(r.content)) for r in opened] == [("0", b"0 first"), ("1", b"1 other")]


def test_inputs_that_are_no_pdf(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "one.PDF").write_text("x")
    with pytest.raises(FileNotFoundError):
        files.listing(spark, f"{tmp_path}/none")
    with pytest.raises(ValueError, match="not a PDF"):
        files.listing(spark, f"{tmp_path}/a.txt")
    assert [r.id for r in files.listing(spark, f"{tmp_path}/one.PDF").collect()] == ["one"]
