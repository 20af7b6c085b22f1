"""The fetch boundary: candidate URLs to attempts, in rounds.

A transport has `get(url)` and returns (status, headers, body, final_url) or raises OSError. What
an answer means is decided by the column operators of `operators.downloads` only. A round is one
task, the lane, that makes requests one after the other and keeps them apart: the stage is bound
by that spacing, whatever the cluster. The lane goes on where no verdict can matter and waits
where one can: a job whose answer may be a file waits, and so does a host whose answer may be a
wall. So 1,000 URLs of one host take one round, a job ends with its first file, and a host that
blocked a request, also after a redirect, gets no other one in this run.

Each round's attempts and what is left to ask are written, so a lost executor costs at most the
requests of one round, and the plan of a round is the same whatever came before it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import downloads
from ..session import shared_dir

SPACING, PREPRINT_SPACING = 3.0, 15.0
# The header names and body texts that the walls of vendors leave in a response.
HEADER_MARKS = ("x-datadome", "cf-mitigated")
BODY_MARKS = {"captcha-delivery": b"captcha-delivery", "just-a-moment": b"<title>Just a moment", "edgesuite": b"edgesuite"}
ANSWER = "seq long, bibcode string, url string, final_url string, at timestamp, status int, server string, content_type string, marks array<string>, content binary, problem string, host string, skipped boolean"
ATTEMPTS = "seq long, at timestamp, bibcode string, url string, final_url string, method string, status string, category string, error string, content binary"
ATTEMPT = tuple(c.split()[0] for c in ATTEMPTS.split(", "))
#: Requests of a round, and rows that its lane looks at, at most; more of either take more rounds.
ROUND, AHEAD = 500, 20_000
Response = tuple[int, dict[str, str], bytes, str]


class Transport(Protocol):
    def get(self, url: str) -> Response: ...


def is_preprint(url: str) -> bool:
    host = urlsplit(url).hostname or ""
    return host == U.PREPRINT_HOST or host.endswith(f".{U.PREPRINT_HOST}")


class Spacer:
    """Keeps requests apart: each kind of request has a time before which it may not start."""

    def __init__(self, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.clock, self.sleep = clock, sleep
        self.due = {"any": clock(), "preprint": clock()}

    def resume(self, ended: dict[str, float]) -> None:
        """Goes on after requests of the kinds that ended at the given times."""
        gaps = {"any": SPACING, "preprint": PREPRINT_SPACING}
        self.due |= {k: at + gaps[k] for k, at in ended.items()}

    def run(self, url: str, request: Callable[[], Response]) -> Response:
        kinds = {"any": SPACING} | ({"preprint": PREPRINT_SPACING} if is_preprint(url) else {})
        self.sleep(max(0.0, max(self.due[k] for k in kinds) - self.clock()))
        try:
            return request()
        finally:
            self.due |= {k: self.clock() + gap for k, gap in kinds.items()}


def may_be_wall(status: int, marks: list[str]) -> bool:
    """Whether `downloads.bot_protection` might name a vendor; all its cases need one of these."""
    return bool(marks) or status == 403


def _ask(row: dict, transport: Transport, spacer: Spacer) -> dict:
    """The row with what came back."""
    try:
        status, headers, body, final_url = spacer.run(row["url"], lambda: transport.get(row["url"]))
        headers = {k.lower(): v for k, v in headers.items()}
        marks = [m for m in HEADER_MARKS if m in headers] + [m for m, text in BODY_MARKS.items() if text in body]
        return row | {"status": status, "final_url": final_url, "server": headers.get("server"), "content_type": headers.get("content-type"), "marks": marks, "content": body}
    except OSError as e:
        return row | {"problem": str(e) or type(e).__name__}


def lane(asked: DataFrame, transport: Transport, make_spacer: Callable[[], Spacer], ended: dict[str, float], most: int = ROUND) -> DataFrame:
    """ANSWER of (seq, bibcode, url, host, closed) in order of seq, not judged; `closed` ones are skipped.

    At most `most` requests are made. Later URLs of a job, or of a host, for which a verdict is
    needed first are left for the next round; a sure failure lets its job go on at once.
    """
    names = [c.split()[0] for c in ANSWER.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spacer = make_spacer()
        spacer.resume(ended)
        made, waiting, paused = 0, set(), set()
        for batch in batches:
            for seq, job, url, host, closed in zip(*(batch[c] for c in ("seq", "bibcode", "url", "host", "closed")), strict=True):
                if made == most:
                    return
                if job in waiting:
                    continue
                row = {"seq": seq, "bibcode": job, "url": url, "host": host, "status": 0, "marks": [], "skipped": bool(closed)}
                if not closed and host in paused:
                    waiting.add(job)
                    continue
                if not closed:
                    row = _ask(row, transport, spacer)
                    made += 1
                    if may_be_wall(row["status"], row["marks"]):
                        paused.add(urlsplit(row["final_url"]).netloc)
                    if 200 <= row["status"] < 300:
                        waiting.add(job)
                row["at"] = pd.Timestamp.now(tz="UTC")
                # a frame for each answer, so that one body at a time is held
                yield pd.DataFrame([[row.get(n) for n in names]], columns=names)

    return asked.select("seq", "bibcode", "url", "host", "closed").coalesce(1).sortWithinPartitions("seq").mapInPandas(run, ANSWER)


Check = Callable[[DataFrame], DataFrame]


def signature_only(rows: DataFrame) -> DataFrame:
    """Adds `invalid`, why the content is no file, or null."""
    return rows.withColumn("invalid", F.when(~downloads.has_signature(F.col("content")), downloads.NO_SIGNATURE))


def judged(rows: DataFrame, check: Check, method: str) -> DataFrame:
    """Attempts from answers: transport problems, the triage of responses, and the check of files."""
    magic = F.coalesce(downloads.has_signature(F.col("content")), F.lit(False))
    wall = downloads.bot_protection(F.col("status"), F.coalesce("server", F.lit("")), F.col("marks"), U.is_preprint_host(U.host(F.col("final_url"))))
    found = rows.withColumn("failure", downloads.response_failure(F.col("status"), F.col("content_type"), magic, wall))
    found = check(found)
    category = F.when(F.col("problem").isNotNull(), "transient").when(F.col("failure").isNotNull(), F.col("failure.category")).when(F.col("invalid").isNotNull(), "permanent")
    error = F.coalesce("problem", "failure.error", "invalid")
    state = F.when(error.isNull(), "downloaded").otherwise("failed")
    content = F.when(error.isNull(), F.col("content"))
    return found.select("seq", "at", "bibcode", "url", "final_url", F.lit(method).alias("method"), state.alias("status"), category.alias("category"), error.alias("error"), content.alias("content"))


def _skipped(rows: DataFrame, method: str) -> DataFrame:
    error = F.concat(F.lit("skipped: "), F.col("host"), F.lit(" already blocked a request in this run"))
    none = F.lit(None)
    return rows.select("seq", "at", "bibcode", "url", none.cast("string").alias("final_url"), F.lit(method).alias("method"), F.lit("skipped").alias("status"), F.lit("blocked").alias("category"), error.alias("error"), none.cast("binary").alias("content"))


def _unsaved(new: DataFrame, lost: DataFrame) -> DataFrame:
    """Attempts whose file could not be kept are failed ones of method `write`; contents are let go."""
    bad = F.col("lost").isNotNull() & (F.col("status") == "downloaded")
    told = {"method": F.lit("write"), "status": F.lit("failed"), "category": F.col("why"), "error": F.col("lost")}
    kept = {c: F.when(bad, told[c]).otherwise(F.col(c)) if c in told else F.col(c) for c in ATTEMPT}
    return new.join(lost, "bibcode", "left").select(*(v.alias(c) for c, v in (kept | {"content": F.lit(None).cast("binary")}).items()))


def walls(attempts: DataFrame) -> DataFrame:
    """The hosts that answered a request with a block."""
    return attempts.where("category = 'blocked' and status = 'failed'").select(U.netloc(F.col("final_url")).alias("host")).distinct()


def fetch(urls: DataFrame, transport: Transport, make_spacer: Callable[[], Spacer] = Spacer, *, check: Check = signature_only, save: Callable[[DataFrame], DataFrame] | None = None, method: str = "http", before: DataFrame | None = None, most: int = ROUND) -> DataFrame:
    """Attempts for (seq, bibcode, url) in order of seq; ATTEMPTS.

    `before` are earlier attempts of the run, whose blocks hold. `save` takes (id, content) of new
    files and returns (id, status, category, error); a file that it could not keep is a failed
    attempt of method `write`, and the job goes on. Contents are kept in the attempts only
    without `save`. The rounds are as many as a job has answers that turn out to be no file, or a
    host answers that turn out to be no wall, and at least the requests over `most`.
    """
    spark = urls.sparkSession
    path = shared_dir(spark)
    urls.select("seq", "bibcode", "url", U.netloc(F.col("url")).alias("host")).write.parquet(f"{path}/left-0")
    none = spark.createDataFrame([], ATTEMPTS)
    none.write.parquet(f"{path}/attempts/before")
    walls(none if before is None else before).write.parquet(f"{path}/walls/before")

    def folder(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/{name}")

    ended: dict[str, float] = {}
    number = 0
    while True:
        left = spark.read.parquet(f"{path}/left-{number}")
        closed = folder("walls", "host string").distinct().withColumn("closed", F.lit(True))
        coming = left.orderBy("seq").limit(AHEAD).join(closed, "host", "left").withColumn("closed", F.coalesce("closed", F.lit(False)))
        # written at once: what is derived from the answers below must not ask again
        lane(coming, transport, make_spacer, ended, most).write.parquet(f"{path}/answers-{number}")
        told = spark.read.schema(ANSWER).parquet(f"{path}/answers-{number}")
        if told.isEmpty():
            return folder("attempts", ATTEMPTS).orderBy("seq")
        judged(told.where("not skipped"), check, method).unionByName(_skipped(told.where("skipped"), method)).write.parquet(f"{path}/judged-{number}")
        new = spark.read.schema(ATTEMPTS).parquet(f"{path}/judged-{number}")
        if save:
            save(new.where("status = 'downloaded'").select(F.col("bibcode").alias("id"), "content")).write.parquet(f"{path}/saved-{number}")
            saved = spark.read.parquet(f"{path}/saved-{number}")
            new = _unsaved(new, saved.where("status = 'failed'").select(F.col("id").alias("bibcode"), F.col("category").alias("why"), F.col("error").alias("lost")))
        new.write.parquet(f"{path}/attempts/round-{number}")
        new = spark.read.schema(ATTEMPTS).parquet(f"{path}/attempts/round-{number}")
        walls(new).write.parquet(f"{path}/walls/round-{number}")
        won = new.where("status = 'downloaded'").select("bibcode").distinct()
        left.join(new.select("seq"), "seq", "left_anti").join(won, "bibcode", "left_anti").write.parquet(f"{path}/left-{number + 1}")
        last = new.where("status <> 'skipped'").agg(F.max(F.unix_micros("at")), F.max(F.when(U.is_preprint_host(U.host(F.col("url"))), F.unix_micros("at")))).first()
        ended |= {k: at / 1e6 for k, at in zip(("any", "preprint"), last, strict=True) if at}
        number += 1
