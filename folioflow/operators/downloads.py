"""Operators of the download stage: candidates, triage of responses and files, attempt rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U

# States of a response that may pass, and the words of failed file checks.
TRANSIENT_STATUS = (408, 425, 429)
NO_SIGNATURE = "content has no PDF signature"
WRONG_CHECKSUM = "PDF checksum does not match the expected SHA-256"
UNREADABLE = "PDF cannot be opened or its first page cannot be read"
NO_PAGES, NO_TEXT, OTHER_TEXT = "PDF has no pages", "PDF has no extractable text", "PDF text does not match the abstract (overlap {})"


def routed_links(records: DataFrame) -> DataFrame:
    """(bibcode, pos, class, url) of the open links that lead to a file."""
    links = records.select("bibcode", F.posexplode("links_data").alias("pos", "link"))
    parsed = links.withColumns({"_host": U.host(F.col("link.url")), "_path": U.path(F.col("link.url")), "_doi": U.doi_of(F.col("link.url"))})
    resolved = parsed.withColumn("_resolved", U.from_doi(F.col("_doi")))
    found = U.route(F.col("link"), F.col("_host"), F.col("_path"), F.col("_resolved"), F.col("bibcode"))
    # exploded instead of filtered: a filter would be pushed below with a copy of the expression
    return resolved.select("bibcode", "pos", F.explode(F.array_compact(F.array(found))).alias("r")).select("bibcode", "pos", "r.class", "r.url")


def candidate_urls(records: DataFrame) -> DataFrame:
    """(bibcode, ord, url): each record's URLs by class and position, once whatever the scheme.

    A URL stands where its first variant stood; an https variant is preferred.
    """
    links = routed_links(records).select("bibcode", "class", F.lit(1).alias("of_link"), "pos", "url")
    given = records.select("bibcode", F.posexplode("pdf_links").alias("pos", "url")).select("bibcode", F.lit(1).alias("class"), F.lit(0).alias("of_link"), "pos", "url")
    ordered = given.unionByName(links).where("url != ''").withColumn("ord", F.row_number().over(Window.partitionBy("bibcode").orderBy("class", "of_link", "pos")))
    keyed = ordered.groupBy("bibcode", U.without_scheme(F.col("url")).alias("key"))
    https = F.max(F.when(F.col("url").startswith("https://"), F.col("url")))
    return keyed.agg(F.min("ord").alias("ord"), F.coalesce(https, F.min_by("url", "ord")).alias("url")).select("bibcode", "ord", "url")


def bot_protection(status: Column, server: Column, marks: Column, preprint: Column) -> Column:
    """Who blocked a request: marks has the names of headers and body markers that were seen."""
    server = F.lower(server)
    return (
        F.when(F.arrays_overlap(marks, F.array(F.lit("x-datadome"), F.lit("captcha-delivery"))), "DataDome")
        .when(F.arrays_overlap(marks, F.array(F.lit("cf-mitigated"), F.lit("just-a-moment"))) | ((server == "cloudflare") & (status == 403)), "Cloudflare")
        .when((status == 403) & (server.startswith("akamaighost") | F.array_contains(marks, "edgesuite")), "Akamai")
        .when((status == 403) & preprint, "arXiv")
    )


def response_failure(status: Column, content_type: Column, magic: Column, protection: Column) -> Column:
    """struct(category, error) of a response that is no file, else null."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    fine = status.between(200, 299)
    as_file = (kind == "") | kind.contains("pdf") | kind.contains("octet-stream")
    error = F.when(fine, F.concat(F.lit("unexpected content type: "), kind)).otherwise(F.concat(F.lit("HTTP "), status.cast("string")))
    blocked = F.struct(F.lit("blocked").alias("category"), F.concat(error, F.lit(" (bot protection: "), protection, F.lit(")")).alias("error"))
    category = F.when(status.isin(*TRANSIENT_STATUS) | (status >= 500), "transient").otherwise("permanent")
    return F.when(~(fine & (as_file | magic)), F.when(protection.isNotNull(), blocked).otherwise(F.struct(category.alias("category"), error.alias("error"))))


def has_signature(content: Column) -> Column:
    return F.instr(F.decode(F.substring(content, 1, 1024), "ISO-8859-1"), "%PDF-") > 0


def pdf_error(signature: Column, checksum_fits: Column, page_count: Column, abstract: Column, has_text: Column, overlap: Column) -> Column:
    """The first failing test of a file, or null; page_count is null for an unreadable one."""
    judged = F.coalesce(abstract, F.lit("")) != ""
    return (
        F.when(~signature, NO_SIGNATURE).when(~checksum_fits, WRONG_CHECKSUM).when(page_count.isNull(), UNREADABLE).when(page_count < 1, NO_PAGES)
        .when(judged & ~has_text, NO_TEXT).when(judged & (overlap < 0.6), F.replace(F.lit(OTHER_TEXT), F.lit("{}"), T.two_decimals(overlap)))
    )


def sticky_blocks(attempts: DataFrame) -> DataFrame:
    """Adds `skipped`: an earlier attempt (by seq) on the host was blocked, so this one is not made.

    The first block of a host decides. It is a partial aggregate, joined back: a host's rows are
    never gathered in one task.
    """
    first = attempts.where("category = 'blocked'").groupBy("host").agg(F.min("seq").alias("_first"))
    joined = attempts.join(first, "host", "left")
    return joined.select(*attempts.columns, F.coalesce(F.col("seq") > F.col("_first"), F.lit(False)).alias("skipped"))


def first_success(attempts: DataFrame) -> DataFrame:
    """Attempts up to each job's first success; those after it are never made."""
    win = F.min(F.when(F.col("status") == "downloaded", F.col("seq"))).over(Window.partitionBy("id"))
    return attempts.withColumn("won", win).where(F.col("won").isNull() | (F.col("seq") <= F.col("won"))).drop("won")


def manual_queue(jobs: DataFrame, attempts: DataFrame) -> DataFrame:
    """(id, category, errors) of jobs without a success: worst category first, errors in order."""
    rank = F.expr("case category when 'transient' then 0 when 'blocked' then 1 else 2 end")
    rolled = attempts.groupBy("id").agg(
        F.count_if(F.col("status") == "downloaded").alias("wins"), F.min(rank).alias("worst"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("seq", "error")))), lambda x: x["error"]).alias("errors"),
    )
    category = F.element_at(F.array(F.lit("transient"), F.lit("blocked"), F.lit("permanent")), F.coalesce(F.col("worst"), F.lit(2)) + 1)
    nothing = F.concat(F.lit("no open-access PDF URL was found in "), F.when(F.col("doi").isNotNull(), "the search index or the open-access source").otherwise("the search index (no DOI for the open-access source)"))
    rows = jobs.join(rolled, "id", "left").where(F.coalesce("wins", F.lit(0)) == 0)
    return rows.select("id", category.alias("category"), F.when(F.coalesce(F.size("errors"), F.lit(0)) > 0, F.col("errors")).otherwise(F.array(nothing)).alias("errors"))


def existing_file(present: Column, valid: Column, checksum_fits: Column) -> Column:
    """What a file on disk means: absent, rejected, conflict (kept, never fetched again), valid."""
    return F.when(~present, "absent").when(~valid, "rejected").when(~checksum_fits, "conflict").otherwise("valid")


def summary(jobs: DataFrame) -> DataFrame:
    """jobs has one `state` each: existing, conflict, downloaded or failed."""
    made = F.count_if(F.col("state").isin("downloaded", "failed"))
    return jobs.agg(
        F.count("*").alias("records"), F.count_if(F.col("state") == "existing").alias("existing"), made.alias("attempted"),
        F.count_if(F.col("state") == "downloaded").alias("downloaded"), (made - F.count_if(F.col("state") == "downloaded") + F.count_if(F.col("state") == "conflict")).alias("failed"),
    )


def untried(urls: Column, tried: Column) -> Column:
    """URLs that were not tried under any scheme, in their order."""
    return F.filter(urls, lambda u: ~F.array_contains(F.transform(tried, U.without_scheme), U.without_scheme(u)))


def open_access_phase(jobs: DataFrame, attempts: DataFrame) -> DataFrame:
    """Jobs for the second source: a DOI is known and no direct URL gave a file."""
    won = attempts.where("status = 'downloaded'").select("id").distinct()
    return jobs.where("doi is not null").join(won, "id", "left_anti")
