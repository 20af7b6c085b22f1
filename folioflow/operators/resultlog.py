"""The append-only result log: latest results, resume, relabelling, scores and queues.

A log has `seq` (append position), `id`, `key` (evaluation key) and `ok` (classified or failed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as T

NO_TEXT = "The paper has no text to classify"


def latest(log: DataFrame) -> DataFrame:
    """The current row of each id, with first_seq (its order of first appearance).

    A later row replaces the current one unless it failed and the current one succeeded under the
    same key. So only the last run of rows with one key counts, and in it the last success.
    """
    # the last key's run begins after the last row of any other key; each step is a partial aggregate
    won = F.when(F.col("ok"), F.col("seq"))
    rows = log.withColumn("row", F.struct(*log.columns))
    by_key = rows.groupBy("id", "key").agg(F.min("seq").alias("low"), F.max("seq").alias("top"), F.max(won).alias("won"), F.max_by("row", "seq").alias("last"), F.max_by("row", won).alias("best"))
    tops = F.sort_array(F.collect_list("top"), asc=False)
    by_id = by_key.groupBy("id").agg(F.min("low").alias("first_seq"), F.get(tops, F.lit(1)).alias("broken"), F.max_by(F.struct("won", "last", "best"), "top").alias("x"))
    kept = F.col("x.won") > F.coalesce(F.col("broken"), F.col("x.won") - 1)
    return by_id.select(F.when(F.coalesce(kept, F.lit(False)), F.col("x.best")).otherwise(F.col("x.last")).alias("row"), "first_seq").select("row.*", "first_seq")


def records(jobs: DataFrame, decided: DataFrame, sent: DataFrame, *, model: str, effort: str, pipeline: str, prompt_version: str, prompt_sha256: str, start: int = 0, failed: DataFrame | None = None) -> DataFrame:
    """Rows of the log (schemas.RESULTS) for jobs (id, bibcode, key, sha).

    decided is what the classifier gave, sent (paper, pages_sent, characters_sent) what it was
    given, failed (paper, problem) why other papers have no text. A job without text is a failed
    record with that problem; one that was sent but not asked for has none.
    """
    if failed is None:
        jobs = jobs.withColumn("problem", F.lit(NO_TEXT))
    else:
        jobs = jobs.join(failed.groupBy(F.col("paper").alias("id")).agg(F.min("problem").alias("problem")), "id", "left").withColumn("problem", F.coalesce("problem", F.lit(NO_TEXT)))
    got = jobs.join(sent, F.col("id") == sent["paper"], "left").drop("paper").join(decided.where("stop is null"), F.col("id") == decided["paper"], "left")
    got = got.where("pages_sent is null or paper is not null")
    done = F.col("include").isNotNull()
    said = {k: F.col(f"response.{k}") for k in ("request_id", "input_tokens", "output_tokens")}
    source = {"pipeline_version": F.lit(pipeline), "prompt_version": F.lit(prompt_version), "prompt_sha256": F.lit(prompt_sha256), "model": F.coalesce("response.model", F.lit(model)), "reasoning_effort": F.lit(effort), **said}
    kind = F.when(done, F.struct("include", "basis", "mission_mentioned", "evidence"))
    result = F.struct(F.lit(1).alias("schema_version"), "bibcode", F.col("sha").alias("pdf_sha256"), F.when(done, "CLASSIFIED").otherwise("PROCESSING_FAILED").alias("status"), kind.alias("classification"), F.struct(*(c.alias(k) for k, c in source.items())).alias("provenance"), F.coalesce("errors", F.array("problem")).alias("errors"))
    number = F.coalesce(F.col("pages_sent"), F.lit(0)).cast("int"), F.coalesce(F.col("characters_sent"), F.lit(0)).cast("long")
    return got.select((F.monotonically_increasing_id() + start).alias("seq"), F.col("key").alias("evaluation_key"), "id", "bibcode", number[0].alias("pages_sent"), number[1].alias("characters_sent"), result.cast(schemas.RESULT).alias("result"))


def flat(log: DataFrame) -> DataFrame:
    """(seq, id, key, pdf_sha256, ok, include, basis, evidence, errors) of rows of schemas.RESULTS."""
    r, c = F.col("result"), F.col("result.classification")
    return log.select("seq", "id", F.col("evaluation_key").alias("key"), r["pdf_sha256"].alias("pdf_sha256"), (r["status"] == "CLASSIFIED").alias("ok"), c["include"].alias("include"), c["basis"].alias("basis"), c["evidence"].alias("evidence"), r["errors"].alias("errors"))


def of_configuration(log: DataFrame, model: str, effort: str, pipeline: str, prompt_sha256: str) -> DataFrame:
    """The rows whose key is that of their own pdf_sha256 under the given configuration."""
    return log.where(F.col("key") == T.evaluation_key(F.col("pdf_sha256"), model, effort, pipeline, prompt_sha256))


def pending(jobs: DataFrame, log: DataFrame, limit: int | None = None) -> DataFrame:
    """Jobs without a success under their key; a limit counts jobs that are done as well."""
    if limit is not None:
        jobs = jobs.orderBy("id").limit(limit)
    return jobs.join(log.where("ok").select("id", "key").distinct(), ["id", "key"], "left_anti")


def outcome(ok: Column, include: Column) -> Column:
    return F.when(~ok, "failed").when(include == "YES", "positive").when(include == "NO", "negative").otherwise("uncertain")


def summary(results: DataFrame, skipped: int | Column = 0) -> DataFrame:
    """One row of counts, zeros included; skipped are the jobs that the resume step left out."""
    kind = outcome(F.col("ok"), F.col("include"))
    skipped = skipped if isinstance(skipped, Column) else F.lit(skipped)
    return results.agg(*(F.count_if(kind == k).alias(k) for k in ("positive", "negative", "uncertain", "failed")), skipped.cast("long").alias("skipped"))


def review(results: DataFrame, library: DataFrame) -> DataFrame:
    """YES and UNCERTAIN results that the library lacks; a null id stays."""
    wanted = results.where(F.col("ok") & F.col("include").isin("YES", "UNCERTAIN"))
    return wanted.join(library.select("id").distinct(), "id", "left_anti")


def current(results: DataFrame, ids: DataFrame) -> DataFrame:
    return results.join(ids.select("id").distinct(), "id", "left_semi")


def stale(results: DataFrame, ids: DataFrame) -> DataFrame:
    return results.select("id").distinct().join(ids.select("id").distinct(), "id", "left_anti")


def relabel(results: DataFrame, cases: DataFrame) -> DataFrame:
    """Stored labels are dropped; those of the current cases are attached where there are any."""
    return results.drop("expected_include", "expected_basis").join(cases.select("id", "expected_include", "expected_basis"), "id", "left")


def accuracy(results: DataFrame) -> DataFrame:
    """Counts over labelled results; rates have classified ones as their denominator."""
    labelled = results.where("expected_include is not null")
    right = F.col("ok") & (F.col("include") == F.col("expected_include"))
    same = F.array_sort(F.array_distinct("basis")) == F.array_sort(F.array_distinct("expected_basis"))
    return labelled.agg(
        F.count_if(right).alias("correct"), F.count_if(F.col("ok") & ~right).alias("incorrect"), F.count_if(~F.col("ok")).alias("failed"),
        F.count_if(F.col("ok") & same).alias("basis_matches"), F.count_if(F.col("ok")).alias("classified"),
    )


def upsert(queue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The queue with this run's failures in place of any older entry, its successes removed.

    outcomes is (id, ok, ...queue columns).
    """
    kept = queue.join(outcomes.select("id").distinct(), "id", "left_anti")
    return kept.unionByName(outcomes.where("not ok").select(*queue.columns))
