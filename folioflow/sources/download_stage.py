"""The download stage: candidates to files, attempts and the queue of what is left to do by hand.

Files that are there are checked first. Then each job's own URLs are tried, and for jobs without
a file that have a DOI the open copies that a second source knows. That source has `work(doi)`,
which returns its record of a DOI as a dict, None if it knows none, or raises OSError.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as T
from ..functions import urls as U
from ..functions.fold import fold
from ..operators import downloads, resultlog
from ..session import shared_dir
from . import fetch, files

LOCATION = "struct<is_oa:boolean,pdf_url:string,landing_page_url:string>"
CONFLICT = "existing valid PDF conflicts with the expected SHA-256; file was preserved"
Extract = Callable[[DataFrame], DataFrame]


class Source(Protocol):
    def work(self, doi: str) -> dict | None: ...


def jobs(records: DataFrame, folder: str) -> DataFrame:
    """(id, doi, sha, abstract, target): ids as text, empty hashes and abstracts as null.

    A record's own `target` is the place of its file; without one it is named after the id.
    """
    blank, key = F.lit(""), F.col("bibcode").cast("string")
    target = F.concat(F.lit(folder.rstrip("/") + "/"), files.name(key))
    if "target" in records.columns:
        target = F.coalesce(F.col("target"), target)
    return records.select(key.alias("id"), U.first_doi(F.col("doi"), F.col("links_data")).alias("doi"), F.nullif(F.col("pdf_sha256"), blank).alias("sha"), F.nullif(F.col("abstract"), blank).alias("abstract"), target.alias("target"))


def checked(rows: DataFrame, extract: Extract | None) -> DataFrame:
    """Adds `invalid`, the first failing test of a file, from (id, content, sha, abstract).

    `extract` gives (id, page, text, error) of (id, content); without it pages are not looked at.
    Only the first three pages are compared with the abstract.
    """
    signature, fits = downloads.has_signature(F.col("content")), F.coalesce(F.sha2("content", 256) == F.col("sha"), F.lit(True))
    if extract is None:
        return rows.withColumn("invalid", downloads.pdf_error(signature, fits, F.lit(1), F.lit(""), F.lit(True), F.lit(None).cast("double")))
    front = F.transform(F.array_sort(F.collect_list(F.when(F.col("page") <= 3, F.struct("page", "text")))), lambda x: x["text"])
    pages = extract(rows.where(signature).select("id", "content")).groupBy("id").agg(F.when(F.max("error").isNull(), F.coalesce(F.max("page"), F.lit(0))).alias("page_count"), F.array_join(front, " ").alias("front"))
    full = rows.join(pages, "id", "left")
    overlap = T.overlap(fold(F.col("abstract")), fold(F.coalesce("front", F.lit(""))))
    error = downloads.pdf_error(signature, fits, F.col("page_count"), F.col("abstract"), T.strip(F.col("front")) != "", overlap)
    return full.withColumn("invalid", error).select(*rows.columns, "invalid")


def existing(spark: SparkSession, wanted: DataFrame, extract: Extract | None) -> DataFrame:
    """(id, state, error): what the files at the jobs' targets mean; see downloads.existing_file.

    A rejected file is renamed, so that it is no longer found, and its error names the new file.
    """
    found = files.contents(wanted.select("id", F.col("target").alias("path"), F.col("sha").alias("expected"), F.lit(None).cast("string").alias("sha"), "abstract"))
    state = downloads.existing_file(F.lit(True), F.col("invalid").isNull(), F.coalesce(F.col("pdf_sha256") == F.col("expected"), F.lit(True)))
    kept = shared_dir(spark)
    checked(found.withColumn("pdf_sha256", F.sha2("content", 256)), extract).select("id", "path", "pdf_sha256", state.alias("state"), F.col("invalid").alias("error")).write.parquet(kept)
    seen = spark.read.parquet(kept)
    files.set_aside(seen.where("state = 'rejected'").select("path", "pdf_sha256"))
    aside = F.concat("error", F.lit("; file preserved as "), F.regexp_extract("path", r"([^/]*\.)[^./]*$", 1), "pdf_sha256", F.lit(".rejected"))
    error = F.when(F.col("state") == "rejected", aside).when(F.col("state") == "conflict", CONFLICT)
    return wanted.select("id").join(seen.select("id", "state", error.alias("error")), "id", "left").select("id", F.coalesce("state", F.lit("absent")).alias("state"), "error")


def lookups(wanted: DataFrame, source: Source) -> DataFrame:
    """(id, locations, pmcid, error): what the second source knows of each job's DOI, in a written table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, doi in zip(batch["id"], batch["doi"], strict=True):
                try:
                    work = source.work(doi) or {}
                    places = [{k: x.get(k) for k in ("is_oa", "pdf_url", "landing_page_url")} for x in work.get("locations") or []]
                    rows.append((key, places, (work.get("ids") or {}).get("pmcid"), None))
                except (OSError, ValueError, AttributeError, TypeError) as e:
                    rows.append((key, [], None, f"open-access lookup failed: {str(e) or type(e).__name__}"))
            yield pd.DataFrame(rows, columns=["id", "locations", "pmcid", "error"])

    path = shared_dir(wanted.sparkSession)
    wanted.select("id", "doi").mapInPandas(run, f"id string, locations array<{LOCATION}>, pmcid string, error string").write.parquet(path)
    return wanted.sparkSession.read.parquet(path)


def _attempt(rows: DataFrame, method: str, category: str) -> DataFrame:
    empty = F.lit("")
    return rows.select(F.lit(-1).cast("long").alias("seq"), F.current_timestamp().alias("at"), F.col("id").alias("bibcode"), empty.alias("url"), empty.alias("final_url"), F.lit(method).alias("method"), F.lit("failed").alias("status"), F.lit(category).alias("category"), "error", F.lit(None).cast("binary").alias("content"))


def _numbered(urls: DataFrame, start: int = 0) -> DataFrame:
    return urls.orderBy("bibcode", "ord").withColumn("seq", F.monotonically_increasing_id() + start)


def run(records: DataFrame, folder: str, transport: fetch.Transport, source: Source | None = None, *, extract: Extract | None = None, make_spacer: Callable[[], fetch.Spacer] = fetch.Spacer, queue: DataFrame | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """(attempts, manual queue as schemas.MANUAL, counts); files are written to the jobs' targets.

    `queue` is the queue of an earlier run: its entries stay for ids that are still among the
    records and were not settled now. A conflict is never fetched again.
    """
    spark = records.sparkSession
    wanted = jobs(records, folder)
    there = existing(spark, wanted, extract)
    open_jobs = wanted.join(there.where("state in ('absent', 'rejected')").select("id"), "id")

    def check(rows: DataFrame) -> DataFrame:
        known = wanted.select("id", "sha", "abstract")
        return checked(rows.withColumn("id", F.col("bibcode")).join(known, "id", "left"), extract).drop("id", "sha", "abstract")

    def save(contents: DataFrame) -> DataFrame:
        return files.save(contents.join(wanted.select("id", "target"), "id"))

    direct = downloads.candidate_urls(records).join(open_jobs.select(F.col("id").alias("bibcode")), "bibcode", "left_semi")
    how = {"check": check, "save": save, "make_spacer": make_spacer}
    attempts = fetch.fetch(_numbered(direct), transport, **how)
    more = []
    if source is not None:
        second = downloads.open_access_phase(open_jobs, attempts.withColumnRenamed("bibcode", "id"))
        known = lookups(second, source)
        tried = direct.groupBy(F.col("bibcode").alias("id")).agg(F.collect_list("url").alias("tried"))
        copies = U.open_locations(F.col("locations"), F.col("pmcid"))
        extra = known.join(tried, "id", "left").select(F.col("id").alias("bibcode"), F.posexplode(downloads.untried(copies, F.coalesce("tried", F.array().cast("array<string>")))).alias("ord", "url"))
        after = (attempts.agg(F.max("seq")).first()[0] or 0) + 1
        more = [_attempt(known.where("error is not null"), "open_access", "transient"), fetch.fetch(_numbered(extra, after), transport, method="open_access", before=attempts, **how)]
    for part in (_attempt(there.where("error is not null"), "existing", "permanent"), *more):
        attempts = attempts.unionByName(part.select(*attempts.columns))
    path = shared_dir(spark)
    attempts.drop("content").write.parquet(path)
    attempts = spark.read.parquet(path)

    todo = wanted.join(there.where("state <> 'valid'").select("id"), "id")
    tries = direct.select(F.col("bibcode").alias("id"), F.lit(0).alias("phase"), "ord", "url")
    if source is not None:
        tries = tries.unionByName(extra.select(F.col("bibcode").alias("id"), F.lit(1).alias("phase"), "ord", "url"))
    urls = tries.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("phase", "ord", "url"))), lambda x: x["url"]).alias("urls"))
    entries = downloads.manual_queue(todo, attempts.withColumnRenamed("bibcode", "id")).join(todo.select("id", "target"), "id").join(urls, "id", "left")
    entries = entries.select("id", "target", F.coalesce("urls", F.array().cast("array<string>")).alias("urls"), "category", "errors", F.current_timestamp().alias("updated_at"))
    if queue is not None:
        settled = wanted.select("id").join(entries.select("id"), "id", "left_anti").select("id", F.lit(True).alias("ok"), *(F.lit(None).cast(entries.schema[c].dataType).alias(c) for c in entries.columns if c != "id"))
        entries = resultlog.upsert(resultlog.current(queue.select(*entries.columns), wanted), settled.unionByName(entries.withColumn("ok", F.lit(False))))
    won = attempts.where("status = 'downloaded'").select(F.col("bibcode").alias("id"), F.lit(True).alias("won"))
    state = F.when(F.col("state") == "valid", "existing").when(F.col("state") == "conflict", "conflict").when(F.col("won"), "downloaded").otherwise("failed")
    path = shared_dir(spark)
    entries.write.parquet(path)
    entries = spark.read.parquet(path)
    counts = downloads.summary(there.join(won, "id", "left").select(state.alias("state"))).first().asDict()
    return attempts, entries, counts | {"manual_queue": entries.count()}


def prepare(cases: DataFrame, transport: fetch.Transport, source: Source | None = None, *, extract: Extract | None = None, make_spacer: Callable[[], fetch.Spacer] = fetch.Spacer) -> dict:
    """Fetches the labelled cases' files that are missing or differ from their hash; counts.

    A missing file must be named after its bibcode, else ValueError is raised before any request.
    One run of the stage serves the cases of all folders; each is known by its path.
    """
    spark = cases.sparkSession
    have = files.hashed(cases.select("path").distinct()).withColumnRenamed("pdf_sha256", "have")
    path = shared_dir(spark)
    cases.join(have, "path").where(F.col("have").isNull() | (F.col("have") != F.col("pdf_sha256"))).drop("have").write.parquet(path)
    missing = spark.read.parquet(path)
    named = F.regexp_extract("path", r"([^/]*)$", 1) == F.concat("bibcode", F.lit(".pdf"))
    odd = missing.where(F.coalesce("bibcode", F.lit("")).eqNullSafe("") | ~named).select("path").first()
    if odd:
        raise ValueError(f"Missing reviewed PDF cannot be acquired automatically: {odd.path}")
    records = missing.select(F.col("path").alias("bibcode"), F.col("path").alias("target"), "pdf_sha256", "pdf_links", "doi", F.array().cast(f"array<{schemas.LINK}>").alias("links_data"), F.lit(None).cast("string").alias("abstract")).dropDuplicates(["target"])
    return run(records, "", transport, source, extract=extract, make_spacer=make_spacer)[2]
