"""Command line: search, download, classify, evaluate, run. Remote services are transports.

A transport is named as `module:attribute`; the attribute is called without arguments. It has what
the command needs of: `count` and `page` of a search index, `get` of files, `work` of a second
source of files, `library`, an index of the curated library. A classifier is named likewise and is
called with the model and the effort, in each task; without one a stand-in decides. What a command
lacks is an error before it does any work.
"""

from __future__ import annotations

import argparse
import importlib
import importlib.util
import json
import logging
import sys
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .functions import text as T
from .operators import classifier, papers, report, resultlog, snapshots
from .session import session, shared_dir
from .sources import download_stage, files, jsonl, remote, storage

MODEL, EFFORT, PIPELINE, PROMPT_VERSION, PROMPT = "term-classifier", "medium", "whole-paper-1", "prompt-1", "0" * 64
log = logging.getLogger(__name__)


def _attribute(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _named(name: str | None, what: str):
    if not name:
        raise ValueError(f"{what} needs --transport module:attribute")
    return _attribute(name)()


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="folioflow", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, *options: tuple) -> None:
        sub = commands.add_parser(name, help=text)
        for flags, settings in options:
            sub.add_argument(*flags, **settings)

    transport = (("--transport",), {"help": "module:attribute of the remote service"})
    limit, force = (("--limit",), {"type": int}), (("--force",), {"action": "store_true", "help": "classify again what has a result"})
    library = (("--library",), {"help": "a text file of the curated library's ids; without it, that of the transport"})
    texts = (("--pages",), {"help": "a table of pages; without it the files' texts are extracted"}), (("--extract",), {"help": "module:attribute of a function from (id, content) to (id, page, text, error)"})
    model = (("--model",), {"default": MODEL}), (("--effort",), {"default": EFFORT}), (("--classifier",), {"help": "module:attribute, called with model and effort"})
    queue = (("--queue",), {"help": "the manual queue of a download"})
    state = (("--state",), {"help": "the state of a search; the report is held to its current ids"})
    add("search", "write the candidates of a query and what became of earlier ones", (("query",), {"help": "{year} stands for the year"}), (("output",), {}), (("--year",), {"type": int}), limit, transport)
    add("download", "fetch candidates and write attempts and the manual queue", (("candidates",), {}), (("output",), {}), limit, transport, texts[1])
    add("classify", "classify a page table or PDF files, resuming from the log", (("input",), {"help": "a table of pages, or PDF files"}), (("log",), {}), (("--pdfs",), {"action": "store_true", "help": "the input is a PDF file or a folder of them"}), limit, force, library, queue, state, texts[1], *model)
    add("evaluate", "classify the labelled cases and score the log", (("log",), {}), (("cases",), {}), (("--case-id",), {"action": "append"}), (("--prepare-pdfs",), {"action": "store_true"}), limit, force, transport, *texts, *model)
    add("run", "search, download, classify and report", (("query",), {"help": "{year} stands for the year"}), (("output",), {}), (("--year",), {"type": int}), limit, force, library, transport, *texts, *model)
    return parser


# settings


@dataclass(frozen=True)
class Setup:
    """What a classification depends on, and how it is made."""

    model: str
    effort: str
    make: Callable

    def key(self, sha) -> F.Column:
        return T.evaluation_key(sha, self.model, self.effort, PIPELINE, PROMPT)


def _setup(args) -> Setup:
    """The classifier, checked before any work if it can be: `check` of it raises what is wrong."""
    make = partial(_attribute(args.classifier), args.model, args.effort) if args.classifier else classifier.TermClassifier
    if check := getattr(make(), "check", None):
        check()
    return Setup(args.model, args.effort, make)


def _extractor(args) -> Callable | None:
    if args.extract:
        return _attribute(args.extract)
    return files.pages if importlib.util.find_spec("pymupdf") else None


def _library(spark: SparkSession, args, folder: str) -> str | None:
    """The path of the library's ids: the given file, which must be there, or today's, fetched."""
    if args.library:
        if storage.kind(*storage.of(args.library)) == "absent":
            raise FileNotFoundError(f"library file not found: {args.library}")
        return args.library
    index = getattr(_named(args.transport, "library"), "library", None) if getattr(args, "transport", None) else None
    if index is None:
        return None
    path = f"{folder.rstrip('/')}/library-{datetime.now(UTC).date()}"
    remote.library(spark, index).write.mode("overwrite").text(path)
    return path


def _query(args) -> str:
    return args.query.replace("{year}", str(args.year)) if args.year else args.query


# stages


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or an empty one if it was never written."""
    return jsonl.read(spark, path, schema) if jsonl.exists(path) else spark.createDataFrame([], schema)


def _search(spark: SparkSession, index, query: str, output: str, limit: int | None) -> dict:
    """Replaces the candidates and folds the snapshot into the state beside them, `<output>.state`."""
    most = remote.MOST if limit is None else limit
    found = index.count(query)
    jsonl.write(remote.search(spark, index, query, most), output)
    records = jsonl.read(spark, output, schemas.CANDIDATES)
    past = _read(spark, f"{output}.state", snapshots.STATE)
    kept = shared_dir(spark)  # the state is read while the new one is made
    snapshots.fold(past, snapshots.digested(records, "bibcode"), datetime.now(UTC).isoformat(timespec="seconds")).write.parquet(kept)
    state = spark.read.parquet(kept)
    jsonl.write(state.orderBy("id"), f"{output}.state")
    return {"found": found, "written": records.count(), "dropped": state.where("not current").count()}


def _download(spark: SparkSession, service, candidates: str, output: str, limit: int | None, extract: Callable | None) -> dict:
    """Files below the output's pdfs folder, attempts and the manual queue beside it."""
    records = jsonl.read(spark, candidates, schemas.CANDIDATES)
    if limit is not None:
        records = records.orderBy("bibcode").limit(limit)
    queue = _read(spark, f"{output}/manual_downloads", schemas.MANUAL)
    attempts, entries, counts = download_stage.run(records, f"{output}/pdfs", service, service if hasattr(service, "work") else None, extract=extract, queue=queue)
    attempts.write.mode("append").parquet(f"{output}/attempts")
    jsonl.write(entries.orderBy("id"), f"{output}/manual_downloads")
    return counts


def _missing(spark: SparkSession, queue: str) -> DataFrame:
    """The queue's papers whose file is still not there; told in a warning."""
    rows = files.absent(_read(spark, queue, schemas.MANUAL))
    if n := rows.count():
        log.warning("%d papers have no file yet and will not be classified; see %s", n, queue)
    return rows


def _page_jobs(pages: DataFrame) -> DataFrame:
    """(id, bibcode, sha) of a table of pages; the hash is that of a paper's pages in order."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), "\f")
    return pages.groupBy(F.col("paper").alias("id")).agg(F.sha2(text, 256).alias("sha")).select("id", F.col("id").alias("bibcode"), "sha")


def _file_jobs(spark: SparkSession, path: str, limit: int | None, memory: str) -> DataFrame:
    """(id, bibcode, sha, path) of files in order of their paths; the limit counts before the resume.

    Hashes of files that have not changed come from the memory, so that they are not opened again.
    """
    listed = files.jobs(files.listing(spark, path), limit)
    kind = "path string, length long, modified timestamp, pdf_sha256 string"
    known = _read(spark, memory, kind)
    kept = shared_dir(spark)
    files.hashed(listed, known).write.parquet(kept)
    rows = spark.read.parquet(kept)
    jsonl.append(rows.select("path", "length", "modified", "pdf_sha256").join(known, ["path", "length", "modified"], "left_anti"), memory)
    return rows.select("id", F.col("id").alias("bibcode"), F.col("pdf_sha256").alias("sha"), "path")


def _file_texts(jobs: DataFrame, extract: Callable | None, expected: DataFrame | None = None) -> DataFrame:
    """(paper, page, text, problem) of jobs (id, path): what was extracted, or why nothing could be.

    With expected (id, pdf_sha256), a file that differs from its hash is not extracted.
    """
    if extract is None:
        raise ValueError("texts of files need --extract module:attribute, --pages, or the optional extractor library")
    opened = files.contents(jobs.select("id", "path"))
    wrong = None
    if expected is not None:
        opened = opened.join(expected.select("id", "pdf_sha256"), "id", "left").withColumn("fits", F.coalesce(F.sha2("content", 256) == F.col("pdf_sha256"), F.lit(True)))
        wrong = opened.where("not fits").select(F.col("id").alias("paper"), F.lit(1).alias("page"), F.lit("").alias("text"), F.concat(F.lit("PDF checksum does not match reviewed manifest: "), "path").alias("problem"))
        opened = opened.where("fits")
    texts = extract(opened.select("id", "content")).select(F.col("id").alias("paper"), F.coalesce("page", F.lit(1)).alias("page"), F.coalesce("text", F.lit("")).alias("text"), F.col("error").alias("problem"))
    return texts if wrong is None else texts.unionByName(wrong)


def _classify(spark: SparkSession, jobs: DataFrame, texts: Callable[[DataFrame], DataFrame], path: str, setup: Setup, force: bool, usable: bool) -> dict:
    """Appends a record of each job that the log has no success of; counts of this run.

    texts gives (paper, page, text, problem) of the jobs that are left. With `usable`, papers with
    too few letters are sent no text.
    """
    past = resultlog.flat(_read(spark, path, schemas.RESULTS))
    kept = shared_dir(spark)  # answers are asked for once, whatever becomes of the later steps
    jobs.withColumn("key", setup.key(F.col("sha"))).write.parquet(f"{kept}/jobs")
    jobs = spark.read.parquet(f"{kept}/jobs")
    (jobs if force else resultlog.pending(jobs, past)).write.parquet(f"{kept}/todo")
    todo = spark.read.parquet(f"{kept}/todo")
    texts(todo).write.parquet(f"{kept}/texts")
    rows = spark.read.parquet(f"{kept}/texts")
    plain = rows.where("problem is null").select("paper", "page", T.normalise_white(F.col("text")).alias("text"))
    if usable:
        plain = plain.join(papers.usable(plain).where("usable").select("paper"), "paper", "left_semi")
    papers.strip_references(plain).write.parquet(f"{kept}/pages")
    pages = spark.read.parquet(f"{kept}/pages")
    classifier.classify(pages, setup.make).write.parquet(f"{kept}/decided")
    decided = spark.read.parquet(f"{kept}/decided")
    done = resultlog.records(
        todo.select("id", "bibcode", "key", "sha"), decided, papers.context(pages).drop("context"), model=setup.model, effort=setup.effort, pipeline=PIPELINE, prompt_version=PROMPT_VERSION,
        prompt_sha256=PROMPT, start=jsonl.next_seq(past), failed=rows.where("problem is not null").select("paper", "problem"),
    )
    done.write.parquet(f"{kept}/records")
    done = spark.read.parquet(f"{kept}/records")
    jsonl.append(done, path)
    classifier.stopped(decided)
    return resultlog.summary(resultlog.flat(done), jobs.count() - todo.count()).first().asDict()


def _latest(spark: SparkSession, path: str, setup: Setup) -> DataFrame:
    """The current results of this configuration."""
    rows = resultlog.flat(_read(spark, path, schemas.RESULTS))
    return resultlog.latest(resultlog.of_configuration(rows, setup.model, setup.effort, PIPELINE, PROMPT))


def _report(spark: SparkSession, path: str, results: DataFrame, setup: Setup, *, library: str | None = None, missing: DataFrame | None = None, state: str | None = None) -> None:
    """The report beside the log and, with a library, the links of the papers to review.

    With the state of a search, results of ids that it no longer finds are left out and told.
    """
    if state:
        ids = snapshots.current(_read(spark, state, snapshots.STATE))
        old = resultlog.stale(results, ids)
        if n := old.count():
            log.warning("%d results are of ids that the search no longer finds, such as %s", n, ", ".join(r.id for r in old.orderBy("id").limit(20).collect()))
        results = resultlog.current(results, ids)
    members = jsonl.library(spark, library) if library else None
    name = library.rstrip("/").rpartition("/")[2] if library else ""
    base = path.rstrip("/")
    report.write(report.full(results, setup.model, setup.effort, PROMPT_VERSION, PROMPT, library=members, library_name=name, queue=missing), f"{base}.report")
    if library:
        report.write(report.review_links(results, members), f"{base}_to_review")


# commands


def search(spark: SparkSession, args) -> dict:
    return _search(spark, _named(args.transport, "search"), _query(args), args.output, args.limit)


def download(spark: SparkSession, args) -> dict:
    counts = _download(spark, _named(args.transport, "download"), args.candidates, args.output, args.limit, _extractor(args))
    _missing(spark, f"{args.output}/manual_downloads")
    return counts


def classify(spark: SparkSession, args) -> dict:
    setup = _setup(args)
    library = _library(spark, args, args.log)
    missing = _missing(spark, args.queue) if args.queue else None
    if args.pdfs:
        jobs = _file_jobs(spark, args.input, args.limit, f"{args.log.rstrip('/')}.hashes")
        counts = _classify(spark, jobs, partial(_file_texts, extract=_extractor(args)), args.log, setup, args.force, usable=True)
    else:
        pages = jsonl.read(spark, args.input, schemas.PAGES)
        jobs = _page_jobs(pages)
        jobs = jobs if args.limit is None else jobs.orderBy("id").limit(args.limit)
        counts = _classify(spark, jobs, partial(_page_texts, pages), args.log, setup, args.force, usable=False)
    _report(spark, args.log, _latest(spark, args.log, setup), setup, library=library, missing=missing, state=args.state)
    return counts


def _page_texts(pages: DataFrame, todo: DataFrame) -> DataFrame:
    return pages.join(todo.select(F.col("id").alias("paper")), "paper", "left_semi").select("paper", "page", "text", F.lit(None).cast("string").alias("problem"))


def evaluate(spark: SparkSession, args) -> dict:
    """Classifies the labelled cases and scores the log; without any way to their texts, it scores only."""
    setup = _setup(args)
    cases = files.case_jobs(jsonl.read(spark, args.cases, schemas.CASES), args.case_id, args.limit)
    extract, counts = _extractor(args), {}
    if args.prepare_pdfs:
        service = _named(args.transport, "prepare-pdfs")
        prepared = download_stage.prepare(jsonl.read(spark, args.cases, schemas.CASES), service, service if hasattr(service, "work") else None, extract=extract)
        counts |= {f"prepared_{k}": n for k, n in prepared.items()}
    jobs = cases.select("id", "bibcode", F.col("pdf_sha256").alias("sha"), "path")
    if args.pages:
        counts |= _classify(spark, jobs, partial(_page_texts, jsonl.read(spark, args.pages, schemas.PAGES)), args.log, setup, args.force, usable=False)
    elif extract:
        counts |= _classify(spark, jobs, partial(_file_texts, extract=extract, expected=cases), args.log, setup, args.force, usable=True)
    results = resultlog.relabel(_latest(spark, args.log, setup), cases)
    _report(spark, args.log, results, setup)
    return counts | resultlog.accuracy(results).first().asDict()


def run(spark: SparkSession, args) -> dict:
    """One stage's output is the next one's input; what could fail is checked before the first."""
    setup, service, extract = _setup(args), _named(args.transport, "run"), _extractor(args)
    if not args.pages and extract is None:
        raise ValueError("texts of files need --extract module:attribute, --pages, or the optional extractor library")
    out = args.output.rstrip("/")
    library = _library(spark, args, out)
    found = _search(spark, service, _query(args), f"{out}/candidates", args.limit)
    saved = _download(spark, service, f"{out}/candidates", out, None, extract)
    missing = _missing(spark, f"{out}/manual_downloads")
    if args.pages:
        pages = jsonl.read(spark, args.pages, schemas.PAGES)
        jobs = _page_jobs(pages)
        jobs = jobs if args.limit is None else jobs.orderBy("id").limit(args.limit)
        counts = _classify(spark, jobs, partial(_page_texts, pages), f"{out}/log", setup, args.force, usable=False)
    else:
        jobs = _file_jobs(spark, f"{out}/pdfs", args.limit, f"{out}/hashes")
        counts = _classify(spark, jobs, partial(_file_texts, extract=extract), f"{out}/log", setup, args.force, usable=True)
    _report(spark, f"{out}/log", _latest(spark, f"{out}/log", setup), setup, library=library, missing=missing, state=f"{out}/candidates.state")
    return counts | {"downloaded": saved["downloaded"], "manual_downloads": saved["manual_queue"], "metadata_found": found["found"]}


def main(argv: list[str] | None = None) -> int:
    parser = build_parser()
    args = parser.parse_args(argv)
    try:
        print(json.dumps(globals()[args.command](session(), args), sort_keys=True))
    except (OSError, ValueError, classifier.RunStopped, classifier.ServiceError) as e:
        parser.error(str(e))
    return 0


if __name__ == "__main__":
    sys.exit(main())
