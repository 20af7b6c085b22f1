"""Every query of the curation engine by name, with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fold
from ..functions import text as T
from ..functions import urls as U
from ..operators import classifier, containment, discovery, downloads, papers, report, responses, resultlog, snapshots
from ..operators.discovery import Branch, Term
from ..session import shared_dir
from ..sources import jsonl, storage
from . import views
from .views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: What an evaluation key is made of besides the file's hash.
MODEL, EFFORT, PIPELINE, PROMPT = "model-a", "medium", "whole-paper-1", "0" * 64


def query(sql: str | None = None):
    def register(f: Callable[[Views], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to normalised, reference-free, labelled contexts to a decision for each paper."""
    return classifier.classify(papers.strip_references(_normal(Views(spark, sf_dir).papers_with_references())))


def _normal(pages: DataFrame) -> DataFrame:
    return pages.select("paper", "page", T.normalise_white(F.col("text")).alias("text"))


_MESSY = "messy AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace(text, ' ', '  ') WHEN 1 THEN replace(text, chr(10), ' ' || chr(10) || chr(10) || chr(10)) ELSE text END AS t FROM documents)"


@query(f"WITH {_MESSY} SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(t, '[ \\t]+', ' ', 'g'), '(?m) +$', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS text FROM messy")
def whitespace_normalize(v: Views) -> DataFrame:
    way, text = F.col("doc_id") % 3, F.col("text")
    messy = F.when(way == 0, F.replace(text, F.lit(" "), F.lit("  "))).when(way == 1, F.replace(text, F.lit("\n"), F.lit(" \n\n\n"))).otherwise(text)
    return v.table("documents").select("doc_id", T.normalise_white(messy).alias("text"))


@query(f"WITH {views.PAPERS} SELECT paper, CAST(sum(length(regexp_replace(text, '[^\\p{{L}}]', '', 'g'))) AS BIGINT) AS letters, sum(length(regexp_replace(text, '[^\\p{{L}}]', '', 'g'))) >= 100 AS usable FROM papers GROUP BY paper")
def letter_count_filter(v: Views) -> DataFrame:
    return papers.usable(v.papers())


_CTX = "string_agg('[PAGE ' || page || ']' || chr(10) || text || chr(10) || '[END PAGE ' || page || ']', chr(10) || chr(10) ORDER BY page)"


@query(f"WITH {views.PAPERS} SELECT paper, {_CTX} AS context FROM papers WHERE trim(text) <> '' GROUP BY paper")
def page_context(v: Views) -> DataFrame:
    return papers.context(v.papers()).select("paper", "context")


@query(f"WITH {views.PAPERS} SELECT paper, count(*) AS pages_sent, CAST(sum(length(text)) AS BIGINT) AS characters_sent FROM papers WHERE trim(text) <> '' GROUP BY paper")
def pages_chars_sent(v: Views) -> DataFrame:
    return papers.context(v.papers()).select("paper", "pages_sent", "characters_sent")


# The pages of the view have their headings at known places, so SQL can say directly what is cut.
_STRIP = (
    f"{views.REFS}, s0 AS (SELECT *, CASE WHEN regexp_matches(text, '(?m)^References$') THEN length(regexp_extract(text, '(?sm)\\A(.*)^References$', 1)) END AS hoff FROM refs), "
    "s1 AS (SELECT *, max(CASE WHEN hoff IS NOT NULL THEN page END) OVER (PARTITION BY paper) AS sp FROM s0), s2 AS (SELECT *, CASE WHEN page = sp THEN hoff ELSE 0 END AS off FROM s1), "
    "s3 AS (SELECT *, substr(text, off + 1) AS tail FROM s2), s4 AS (SELECT *, CASE WHEN regexp_matches(tail, '(?m)^Appendix') THEN length(regexp_extract(tail, '(?sm)\\A(.*?)^Appendix', 1)) END AS rpos FROM s3), "
    "s5 AS (SELECT *, min(CASE WHEN page >= sp AND rpos IS NOT NULL THEN page END) OVER (PARTITION BY paper) AS rp, coalesce(rpos, length(tail)) AS cut FROM s4), "
    "s6 AS (SELECT *, CASE WHEN regexp_matches(substr(tail, 1, cut), '(?m)^Fig\\. \\d') THEN length(regexp_extract(substr(tail, 1, cut), '(?sm)\\A(.*?)^Fig\\. \\d', 1)) END AS cap FROM s5), "
    "stripped AS (SELECT paper, page, CASE WHEN sp IS NULL OR page < sp OR (rp IS NOT NULL AND page > rp) THEN text ELSE trim(rtrim(substr(text, 1, off), ' ' || chr(10)) || chr(10) || chr(10) || substr(tail, coalesce(cap, cut) + 1), ' ' || chr(10)) END AS text FROM s6)"
)


@query(f"WITH {_STRIP} SELECT paper, page, text FROM stripped")
def strip_references(v: Views) -> DataFrame:
    return papers.strip_references(v.papers_with_references())


_WORDS = "list_distinct(regexp_extract_all(lower({}), '[a-z]+'))"


@query(f"SELECT doc_id, CAST(len({_WORDS.format('text')}) AS INT) AS n, list_aggregate(list_sort({_WORDS.format('text')}), 'string_agg', ' ') AS words FROM documents WHERE regexp_matches(lower(text), '[a-z]')")
def word_sets(v: Views) -> DataFrame:
    sets = v.table("documents").where(F.lower("text").rlike("[a-z]")).select("doc_id", T.word_set(F.col("text")).alias("words"))
    return sets.select("doc_id", F.size("words").alias("n"), F.array_join(F.sort_array("words"), " ").alias("words"))


@query(f"SELECT doc_id, CAST(len({_WORDS.format('text')}) AS INT) AS n, sha256(coalesce(list_aggregate(list_sort({_WORDS.format('text')}), 'string_agg', ' '), '')) AS words_sha256 FROM documents")
def compatibility_words(v: Views) -> DataFrame:
    """Texts with ligatures, full-width and long letters and parted accents have the words of the plain texts."""
    odd = F.col("text")
    for plain, coded in (("ffi", "\ufb03"), ("fi", "\ufb01"), ("the", "\uff54\uff48\uff45"), ("ss", "\u017fs"), ("\u00e9", "e\u0301"), ("\u00f1", "n\u0303"), ("\u00fc", "u\u0308"), ("on ", "o\U0001d427 ")):
        odd = F.replace(odd, F.lit(plain), F.lit(coded))
    # sets in a step of their own: in one step, each of the two columns would make them
    sets = v.table("documents").select("doc_id", fold.words(odd).alias("words"))
    return sets.select("doc_id", F.array_size("words").alias("n"), F.sha2(F.coalesce(F.array_join(F.sort_array("words"), " "), F.lit("")), 256).alias("words_sha256"))


_LONG = f"list_filter({_WORDS.format('abstract')}, lambda w: length(w) >= 5)"


@query(
    "WITH d AS (SELECT a.doc_id, CASE WHEN a.doc_id % 5 = 0 THEN b.text ELSE a.text END AS abstract, a.text FROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id + 1), "
    f"w AS (SELECT doc_id, {_LONG} AS aw, {_WORDS.format('text')} AS tw FROM d) SELECT doc_id, CASE WHEN len(aw) >= 20 THEN len(list_intersect(aw, tw)) / len(aw) END AS overlap FROM w"
)
def abstract_overlap_self(v: Views) -> DataFrame:
    docs = v.table("documents").select("doc_id", "text")
    after = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("next"))
    abstract = F.when(F.col("doc_id") % 5 == 0, F.col("next")).otherwise(F.col("text"))
    return docs.join(after, "doc_id", "left").select("doc_id", T.overlap(abstract, F.col("text")).alias("overlap"))


@query(
    f"WITH b AS (SELECT item_id, list_filter({_WORDS.format('text')}, lambda w: length(w) >= 5) AS bw FROM benchmark), d AS (SELECT doc_id, {_WORDS.format('text')} AS dw FROM documents) "
    "SELECT item_id, doc_id, len(list_intersect(bw, dw)) / len(bw) AS overlap FROM b, d WHERE len(bw) >= 20 AND len(list_intersect(bw, dw)) / len(bw) >= 0.6"
)
def abstract_overlap_cross(v: Views) -> DataFrame:
    """Items against all documents, each looked up by its rarest words."""
    long = F.filter(T.word_set(F.col("text")), lambda w: F.length(w) >= T.LONG_WORD)
    items = v.table("benchmark").select(F.col("item_id").alias("short"), long.alias("words")).where(F.size("words") >= T.LEAST_ABSTRACT_WORDS)
    # only long words can be shared with an item
    docs = v.table("documents").select(F.col("doc_id").alias("text"), long.alias("words"))
    return containment.containing(items, docs, T.LEAST_OVERLAP).select(F.col("short").alias("item_id"), F.col("text").alias("doc_id"), "overlap")


@query("SELECT sha256(text) AS digest, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def content_hash_dupes(v: Views) -> DataFrame:
    return v.table("documents").groupBy(T.sha256(F.col("text")).alias("digest")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


@query(f"""SELECT doc_id, sha256('{{"model": "{MODEL}", "pdf_sha256": "' || sha256(text) || '", "pipeline_version": "{PIPELINE}", "prompt_sha256": "{PROMPT}", "reasoning_effort": "{EFFORT}"}}') AS key FROM documents""")
def evaluation_key(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", T.evaluation_key(T.sha256(F.col("text")), MODEL, EFFORT, PIPELINE, PROMPT).alias("key"))


@query("SELECT page_id, lower(regexp_replace(regexp_replace(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')) AS host, regexp_extract(url, '^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)', 1) AS path FROM pages")
def url_host_path(v: Views) -> DataFrame:
    return v.table("pages").select("page_id", U.host(F.col("url")).alias("host"), U.path(F.col("url")).alias("path"))


@query(f"WITH {views.LINKS} SELECT bibcode, class, url FROM routed WHERE of_link = 1")
def candidate_urls_routed(v: Views) -> DataFrame:
    return downloads.routed_links(v.links()).select("bibcode", "class", "url")


@query(f"WITH {views.LINKS} SELECT bibcode, CAST(min(ord) AS INT) AS ord, coalesce(max(CASE WHEN url LIKE 'https://%' THEN url END), min_by(url, ord)) AS url FROM ordered GROUP BY bibcode, regexp_replace(url, '^.*?://', '')")
def candidate_urls_dedup(v: Views) -> DataFrame:
    return downloads.candidate_urls(v.links())


@query(f"WITH {views.LINKS} SELECT bibcode, CASE WHEN page_id % 4 = 0 THEN '10.5/' || page_id ELSE prefix || suffix END AS doi FROM lk")
def first_doi(v: Views) -> DataFrame:
    return v.links().select("bibcode", U.first_doi(F.col("doi"), F.col("links_data")).alias("doi"))


@query("SELECT page_id, false AS preprint, false AS resolver FROM pages CROSS JOIN (SELECT unnest(range(5)))")
def lookalike_hosts(v: Views) -> DataFrame:
    """URLs that only look like a preprint or resolver host: in path, query, user, prefix, suffix."""
    url = F.col("url")
    forms = F.array(F.concat(url, F.lit("/arxiv.org/abs/1")), F.concat(url, F.lit("?u=https://doi.org/10.1007/x")), F.lit("https://arxiv.org@evil.example/abs/1"), F.lit("https://notarxiv.org/abs/1"), F.lit("https://doi.org.evil.example/10.1007/x"))
    rows = v.table("pages").select("page_id", F.explode(forms).alias("u"))
    return rows.select("page_id", U.is_preprint_host(U.host(F.col("u"))).alias("preprint"), U.host(F.col("u")).isin(*U.DOI_HOSTS).alias("resolver"))


@query("SELECT p_partkey, 'https://ui.adsabs.harvard.edu/abs/' || url_encode(p_name) || '/abstract' AS link FROM part")
def record_links(v: Views) -> DataFrame:
    return v.table("part").select("p_partkey", U.record_link(F.col("p_name")).alias("link"))


def _triaged(v: Views) -> DataFrame:
    a = v.attempts()
    bot = downloads.bot_protection(F.col("http"), F.col("server"), F.array().cast("array<string>"), F.col("preprint"))
    failure = downloads.response_failure(F.col("http"), F.col("content_type"), F.lit(False), bot)
    return a.withColumn("f", failure).select("seq", "id", "host", "f.category", "f.error")


@query(f"WITH {views.ATTEMPTS} SELECT seq, category, error FROM att")
def response_triage(v: Views) -> DataFrame:
    return _triaged(v).select("seq", "category", "error")


@query(
    f"WITH {views.ATTEMPTS}, r AS (SELECT id, count(*) FILTER (category IS NULL) AS wins, min(CASE category WHEN 'transient' THEN 0 WHEN 'blocked' THEN 1 ELSE 2 END) AS worst, string_agg(error, '; ' ORDER BY seq) AS errors FROM att GROUP BY id) "
    "SELECT c.id, ['transient', 'blocked', 'permanent'][coalesce(worst, 2) + 1] AS category, coalesce(errors, 'no open-access PDF URL was found in ' || CASE WHEN c.k % 2 = 0 THEN 'the search index or the open-access source' ELSE 'the search index (no DOI for the open-access source)' END) AS errors "
    "FROM (SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey AS k FROM customer) c LEFT JOIN r USING (id) WHERE coalesce(wins, 0) = 0"
)
def manual_queue_rollup(v: Views) -> DataFrame:
    attempts = _triaged(v).withColumn("status", F.when(F.col("category").isNull(), "downloaded").otherwise("failed"))
    jobs = v.table("customer").select(F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_custkey") % 2 == 0, "d").alias("doi"))
    return downloads.manual_queue(jobs, attempts).select("id", "category", F.array_join("errors", "; ").alias("errors"))


@query(f"WITH {views.ATTEMPTS}, b AS (SELECT host, min(seq) AS s FROM att WHERE category = 'blocked' GROUP BY host) SELECT att.seq, att.host, coalesce(att.seq > b.s, false) AS skipped FROM att LEFT JOIN b USING (host)")
def sticky_host_block(v: Views) -> DataFrame:
    path = shared_dir(v.spark)  # the first block of a host and the join both need the verdicts
    _triaged(v).select("seq", "host", "category").write.parquet(path)
    return downloads.sticky_blocks(v.spark.read.parquet(path)).select("seq", "host", "skipped")


@query(
    f"WITH {views.LOG}, x AS (SELECT seq, include, CASE seq % 4 WHEN 0 THEN basis WHEN 1 THEN ['REVIEW'] WHEN 2 THEN ['REVIEW', 'REVIEW'] ELSE [] END AS basis, seq % 3 > 0 AS ev FROM log) SELECT seq, concat_ws(',', CASE WHEN len(list_distinct(basis)) < len(basis) THEN 'duplicate' END, "
    "CASE WHEN include = 'NO' AND len(basis) > 0 THEN 'no_with_basis' END, CASE WHEN include = 'YES' AND len(list_filter(basis, lambda b: b <> 'REVIEW')) = 0 THEN 'yes_without_basis' END, CASE WHEN include = 'UNCERTAIN' AND len(list_filter(basis, lambda b: b <> 'REVIEW')) > 0 THEN 'uncertain_with_basis' END, "
    "CASE WHEN len(basis) > 0 AND NOT ev THEN 'basis_without_evidence' END, CASE WHEN ev AND seq % 5 = 0 THEN 'page' END) AS violations FROM x"
)
def classification_invariants(v: Views) -> DataFrame:
    way = F.col("seq") % 4
    basis = F.when(way == 0, F.col("basis")).when(way == 1, F.array(F.lit("REVIEW"))).when(way == 2, F.array(F.lit("REVIEW"), F.lit("REVIEW"))).otherwise(F.array().cast("array<string>"))
    items = F.array(F.struct(F.when(F.col("seq") % 5 == 0, 0).otherwise(1).alias("page"), F.lit("x").alias("reason")))
    evidence = F.when(F.col("seq") % 3 > 0, items).otherwise(F.array().cast(f"array<{schemas.EVIDENCE}>"))
    return v.log().select("seq", F.array_join(schemas.classification_violations(F.col("include"), basis, evidence), ",").alias("violations"))


@query(f"WITH {views.LOG} SELECT seq, concat_ws(',', CASE WHEN ok AND seq % 3 = 0 THEN 'classified_without' END, CASE WHEN NOT ok AND seq % 3 <> 0 THEN 'failed_with' END, CASE WHEN NOT ok AND seq % 4 = 0 THEN 'failed_without_error' END, CASE WHEN seq % 4 = 1 THEN 'blank_error' END) AS violations FROM log")
def status_invariants(v: Views) -> DataFrame:
    errors = F.when(F.col("seq") % 4 == 0, F.array().cast("array<string>")).when(F.col("seq") % 4 == 1, F.array(F.lit(" "))).otherwise(F.array(F.lit("e")))
    broken = schemas.result_violations(F.when(F.col("ok"), "CLASSIFIED").otherwise("PROCESSING_FAILED"), F.col("seq") % 3 != 0, errors)
    return v.log().select("seq", F.array_join(broken, ",").alias("violations"))


@query(f"WITH {views.LATEST} SELECT id, seq, first_seq, key, ok, include FROM latest")
def latest_result(v: Views) -> DataFrame:
    return resultlog.latest(v.log()).select("id", "seq", "first_seq", "key", "ok", "include")


_JOBS = "jobs AS (SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey % 3 AS VARCHAR) AS key FROM customer)"


def _jobs(v: Views) -> DataFrame:
    return v.table("customer").select(F.col("c_custkey").cast("string").alias("id"), (F.col("c_custkey") % 3).cast("string").alias("key"))


@query(f"WITH {views.LOG}, {_JOBS} SELECT id, key FROM jobs WHERE NOT EXISTS (SELECT 1 FROM log WHERE ok AND log.id = jobs.id AND log.key = jobs.key)")
def resume_pending(v: Views) -> DataFrame:
    return resultlog.pending(_jobs(v), v.log()).select("id", "key")


@query(f"WITH {views.LOG}, {_JOBS}, j AS (SELECT * FROM jobs ORDER BY id LIMIT 200) SELECT id, key FROM j WHERE NOT EXISTS (SELECT 1 FROM log WHERE ok AND log.id = j.id AND log.key = j.key)")
def limit_before_resume(v: Views) -> DataFrame:
    return resultlog.pending(_jobs(v), v.log(), limit=200).select("id", "key")


@query(f"WITH {views.LATEST} SELECT count(*) FILTER (ok AND include = 'YES') AS positive, count(*) FILTER (ok AND include = 'NO') AS negative, count(*) FILTER (ok AND include = 'UNCERTAIN') AS uncertain, count(*) FILTER (NOT ok) AS failed, 0::BIGINT AS skipped FROM latest")
def outcome_summary(v: Views) -> DataFrame:
    return resultlog.summary(resultlog.latest(v.log()))


_DECISION = "CASE WHEN len(basis) > 0 THEN include || ' (' || list_aggregate(basis, 'string_agg', ', ') || ')' ELSE include END"


def _library(v: Views) -> DataFrame:
    return v.table("customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("id"))


@query(f"WITH {views.LATEST} SELECT id, {_DECISION} AS decision, 'https://ui.adsabs.harvard.edu/abs/' || id || '/abstract' AS link FROM latest WHERE ok AND include IN ('YES', 'UNCERTAIN') AND id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 3 = 0)")
def review_list(v: Views) -> DataFrame:
    rows = resultlog.review(resultlog.latest(v.log()), _library(v))
    return rows.select("id", T.decision(F.col("include"), F.col("basis")).alias("decision"), U.record_link(F.col("id")).alias("link"))


@query(f"WITH {views.LATEST} SELECT id FROM latest WHERE id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 3 = 0)")
def stale_ids(v: Views) -> DataFrame:
    return resultlog.stale(resultlog.latest(v.log()), _library(v))


@query(f"WITH {views.LATEST} SELECT id, seq FROM latest WHERE id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 3 = 0)")
def current_results(v: Views) -> DataFrame:
    return resultlog.current(resultlog.latest(v.log()), _library(v)).select("id", "seq")


_CASES = "cases AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN quality = 0 THEN 'NO' WHEN toxic = 0 THEN 'YES' ELSE 'UNCERTAIN' END AS expected_include FROM labels)"


def _cases(v: Views) -> DataFrame:
    include = F.when(F.col("quality") == 0, "NO").when(F.col("toxic") == 0, "YES").otherwise("UNCERTAIN")
    basis = F.when(include == "YES", F.array(F.lit("COMPANION_PAPER"), F.lit("OBSERVATIONAL_DATA"))).when(include == "UNCERTAIN", F.array(F.lit("REVIEW"))).otherwise(F.array().cast("array<string>"))
    return v.table("labels").select(F.col("doc_id").cast("string").alias("id"), include.alias("expected_include"), basis.alias("expected_basis"))


@query(
    f"WITH {views.LATEST}, {_CASES}, j AS (SELECT l.*, c.expected_include AS e, CASE c.expected_include WHEN 'YES' THEN ['COMPANION_PAPER', 'OBSERVATIONAL_DATA'] WHEN 'UNCERTAIN' THEN ['REVIEW'] ELSE [] END AS eb FROM latest l JOIN cases c USING (id)) "
    "SELECT count(*) FILTER (ok AND include = e) AS correct, count(*) FILTER (ok AND include <> e) AS incorrect, count(*) FILTER (NOT ok) AS failed, count(*) FILTER (ok AND list_sort(list_distinct(basis)) = list_sort(list_distinct(eb))) AS basis_matches, count(*) FILTER (ok) AS classified FROM j"
)
def relabel_score(v: Views) -> DataFrame:
    return resultlog.accuracy(resultlog.relabel(resultlog.latest(v.log()), _cases(v)))


@query(f"WITH {views.LOG}, q AS (SELECT DISTINCT id FROM log WHERE NOT ok) SELECT id FROM q WHERE id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 2 = 0)")
def missing_pdfs(v: Views) -> DataFrame:
    files = v.table("documents").where("doc_id % 2 = 0").select(F.col("doc_id").cast("string").alias("id"))
    return v.log().where("not ok").select("id").distinct().join(files, "id", "left_anti")


_SPOKEN = "' ' || lower(array_to_string(regexp_extract_all({}, '[\\p{{L}}\\p{{N}}]+'), ' ')) || ' '"
_ANY = "({})"


def _says(column: str, *phrases: str) -> str:
    return _ANY.format(" OR ".join(f"contains({column}, ' {p} ')" for p in phrases))


# Words that the tables have in the places of the standard query's phrases.
NAME, SHORT_NAME, THANKS = "Apache License", "The", ("All rights reserved", "Released under the MIT License")
SIDES = ("with the", "and the")
FIRST, SECOND, THIRD = ("the and", "of of", "the of", "orre orre"), ("attion to", "thanedble the", "in the", "that that"), ("of the", "to to", "is the")


@query(
    f"WITH c AS (SELECT doc_id, lang, {_SPOKEN.format('text')} AS t, {_SPOKEN.format('substr(text, 1, 600)')} AS a, regexp_matches(text, '(^|[^\\p{{L}}\\p{{N}}])The($|[^\\p{{L}}\\p{{N}}])') AS named FROM documents JOIN orders ON o_orderkey = doc_id "
    "WHERE source <> 'src0' AND n_chars BETWEEN 200 AND 20000 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01') "
    f"SELECT doc_id FROM c WHERE {_says('t', NAME.lower())} OR EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = c.doc_id AND l.l_partkey < 50) OR (named AND {_says('t', *SIDES)} AND lang = 'en') "
    f"OR {_says('t', *(x.lower() for x in THANKS))} OR ({_says('a', *FIRST)} AND {_says('a', *SECOND)} AND {_says('a', *THIRD)} AND lang = 'en')"
)
def discovery_predicate(v: Views) -> DataFrame:
    """All five branches and the conjuncts, a range of months among them."""
    dates = v.table("orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderdate").cast("date").alias("date"))
    docs = v.table("documents").join(dates, "doc_id")
    cites = v.table("lineitem").where("l_partkey < 50").select(F.col("l_orderkey").alias("doc_id"))
    english = F.col("lang") == "en"
    branches = [
        Branch((Term("full", (NAME,)),)), Branch((Term("full", (SHORT_NAME,), cased=True), Term("full", SIDES)), english),
        Branch((Term("full", THANKS),)), Branch((Term("abstract", FIRST), Term("abstract", SECOND), Term("abstract", THIRD)), english),
    ]
    conjuncts = [F.col("source") != "src0", F.col("n_chars").between(200, 20000), discovery.months(F.col("date"), "1996-01", "1998-12")]
    return discovery.discover(docs, "doc_id", {"full": F.col("text"), "abstract": F.substring("text", 1, 600)}, branches, cites, conjuncts).select("doc_id")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def citation_semi_join(v: Views) -> DataFrame:
    return v.table("orders").join(v.table("lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi").select("o_orderkey")


_EVIDENCE = "ev AS (SELECT paper, CAST(page + (conv_id % 3) AS INT) AS page, turn AS ord, 'a | b ' || chr(10) || ' ' || turn AS reason FROM papers)"


def _evidence(v: Views) -> DataFrame:
    return v.papers().select("paper", (F.col("page") + F.col("conv_id") % 3).cast("int").alias("page"), F.col("turn").alias("ord"), F.concat(F.lit("a | b \n "), F.col("turn").cast("string")).alias("reason"))


@query(f"WITH {views.PAPERS}, {_EVIDENCE} SELECT paper, coalesce(string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) FILTER (bad), '') AS invented FROM (SELECT DISTINCT e.paper, e.page, p.page IS NULL AS bad FROM ev e LEFT JOIN papers p ON p.paper = e.paper AND p.page = e.page AND trim(p.text) <> '') GROUP BY paper")
def evidence_pages_subset(v: Views) -> DataFrame:
    rows = papers.invented_pages(_evidence(v), v.papers())
    return rows.select("paper", F.array_join(F.transform("invented", lambda p: p.cast("string")), ",").alias("invented"))


@query(f"WITH {views.PAPERS}, {_EVIDENCE} SELECT paper, replace(trim(regexp_replace(string_agg('p' || page || ': ' || reason, '; ' ORDER BY ord), '\\s+', ' ', 'g')), '|', '/') AS evidence FROM ev GROUP BY paper")
def evidence_render(v: Views) -> DataFrame:
    return papers.render_evidence(_evidence(v))


_COUNTS = "t AS (SELECT count(*) AS n, count(*) FILTER (ok AND include = 'YES') AS p, count(*) FILTER (ok AND include = 'NO') AS g, count(*) FILTER (ok AND include = 'UNCERTAIN') AS u, count(*) FILTER (NOT ok) AS f FROM latest)"
_HEAD = (
    "SELECT 1 AS section, 0::BIGINT AS ord, '# Paper classification report' AS line UNION ALL SELECT 1, 1, '' UNION ALL SELECT 1, 2, '- Results: ' || n || ' papers' FROM t UNION ALL SELECT 1, 3, '- Positive: ' || p FROM t UNION ALL SELECT 1, 4, '- Negative: ' || g FROM t UNION ALL SELECT 1, 5, '- Uncertain: ' || u FROM t UNION ALL SELECT 1, 6, '- Failed: ' || f FROM t"
)
_STATED = " UNION ALL SELECT 1, {0}, '- Model: `model-a`, reasoning effort `medium`' UNION ALL SELECT 1, {1}, '- Prompt: `prompt-1`, SHA-256 `" + "0" * 64 + "`'"
_PAPER_TABLE = " UNION ALL SELECT 6, -3, '' UNION ALL SELECT 6, -2, '| Paper | Expected | Predicted | Basis | Status |' UNION ALL SELECT 6, -1, '|---|---|---|---|---|'"
_PREDICTED = "CASE WHEN ok THEN include ELSE '-' END || ' | ' || CASE WHEN ok AND len(basis) > 0 THEN array_to_string(basis, ', ') ELSE '-' END || ' | ' || CASE WHEN ok THEN 'CLASSIFIED' ELSE 'PROCESSING_FAILED' END || ' |'"
_CONFIGURATION = (MODEL, EFFORT, "prompt-1", PROMPT)


@query(f"WITH {views.LATEST}, {_COUNTS} {_HEAD}{_STATED.format(7, 8)}{_PAPER_TABLE} UNION ALL SELECT 6, first_seq, '| `' || id || '` | - | ' || {_PREDICTED} FROM latest")
def report_lines(v: Views) -> DataFrame:
    """Without labels, library or queue: counts, configuration and the papers."""
    results = resultlog.latest(v.log())
    return report.lines(results, *_CONFIGURATION).unionByName(report.paper_lines(results))


@query("SELECT lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS dir, count(*) AS files, CAST(sum(length(html)) AS BIGINT) AS chars, count(*) FILTER (page_id % 7 = 0) AS failed FROM pages GROUP BY 1")
def prepare_groups(v: Views) -> DataFrame:
    return v.table("pages").groupBy(U.host(F.col("url")).alias("dir")).agg(F.count("*").alias("files"), F.sum(F.length("html")).alias("chars"), F.count_if(F.col("page_id") % 7 == 0).alias("failed"))


@query(
    "SELECT 'p' || page_id AS bibcode, CASE WHEN page_id % 3 > 0 THEN url || ' ' ELSE '' END || 'https://pmc-oa-opendata.s3.amazonaws.com/PMC' || page_id || '.1/PMC' || page_id || '.1.pdf' AS urls FROM pages"
)
def oa_locations_flatten(v: Views) -> DataFrame:
    url, n = F.col("url"), F.col("page_id").cast("string")

    def location(is_oa, pdf, landing):
        return F.struct(is_oa.alias("is_oa"), pdf.alias("pdf_url"), landing.alias("landing_page_url"))

    landing = F.concat(F.lit("https://pmc.example/pmc/articles/PMC"), n, F.lit("/"))
    locations = F.array(location(F.col("page_id") % 3 > 0, url, landing), location(F.lit(True), F.concat(F.lit("https://doi.org/10.1/"), n), F.lit(None).cast("string")), location(F.lit(False), F.lit("https://closed.example/x.pdf"), F.lit("https://pmc.example/articles/9")), location(F.col("page_id") % 3 > 0, url, landing))
    return v.table("pages").select(F.concat(F.lit("p"), n).alias("bibcode"), F.array_join(U.open_locations(locations, F.lit(None).cast("string")), " ").alias("urls"))


@query(f"WITH {views.LATEST}, mid AS (SELECT max(seq) / 2 AS m FROM log), o AS (SELECT DISTINCT id, 'old' AS category FROM log, mid WHERE seq < m AND NOT ok), n AS (SELECT l.id, l.ok FROM latest l, mid WHERE l.seq >= m) SELECT id, category FROM o WHERE id NOT IN (SELECT id FROM n) UNION ALL SELECT id, 'new' FROM n WHERE NOT ok")
def queue_upsert(v: Views) -> DataFrame:
    log = v.log()
    middle = F.broadcast(log.agg((F.max("seq") / 2).alias("m")))  # one row
    queue = log.join(middle).where("seq < m and not ok").select("id", F.lit("old").alias("category")).distinct()
    return resultlog.upsert(queue, resultlog.latest(log).join(middle).where("seq >= m").select("id", "ok", F.lit("new").alias("category")))


@query("SELECT d.doc_id, CASE WHEN d.doc_id % 4 = 0 THEN 'absent' WHEN NOT regexp_matches(text, '^[A-Z]') THEN 'rejected' WHEN d.doc_id % 5 = 0 THEN 'conflict' ELSE 'valid' END AS state FROM documents d")
def existing_file_triage(v: Views) -> DataFrame:
    expected = F.when(F.col("doc_id") % 5 == 0, "0").otherwise(T.sha256(F.col("text")))
    state = downloads.existing_file(F.col("doc_id") % 4 != 0, F.col("text").rlike("^[A-Z]"), T.sha256(F.col("text")) == expected)
    return v.table("documents").select("doc_id", state.alias("state"))


@query(f"WITH {views.ATTEMPTS}, w AS (SELECT id, min(CASE WHEN category IS NULL THEN seq END) AS won FROM att GROUP BY id), j AS (SELECT CAST(id AS BIGINT) AS k, CASE WHEN CAST(id AS BIGINT) % 11 = 0 THEN 'existing' WHEN CAST(id AS BIGINT) % 11 = 1 THEN 'conflict' WHEN won IS NOT NULL THEN 'downloaded' ELSE 'failed' END AS s FROM w) SELECT count(*) AS records, count(*) FILTER (s = 'existing') AS existing, count(*) FILTER (s IN ('downloaded', 'failed')) AS attempted, count(*) FILTER (s = 'downloaded') AS downloaded, count(*) FILTER (s = 'failed') + count(*) FILTER (s = 'conflict') AS failed FROM j")
def download_summary(v: Views) -> DataFrame:
    won = _triaged(v).groupBy("id").agg(F.bool_or(F.col("category").isNull()).alias("won"))
    n = F.col("id").cast("long") % 11
    return downloads.summary(won.select("id", F.when(n == 0, "existing").when(n == 1, "conflict").when(F.col("won"), "downloaded").otherwise("failed").alias("state")))


@query(f"WITH {views.ATTEMPTS}, w AS (SELECT id, min(CASE WHEN category IS NULL THEN seq END) AS won FROM att GROUP BY id) SELECT att.seq, att.id FROM att JOIN w USING (id) WHERE won IS NULL OR att.seq <= won")
def first_success(v: Views) -> DataFrame:
    rows = _triaged(v).withColumn("status", F.when(F.col("category").isNull(), "downloaded").otherwise("failed"))
    return downloads.first_success(rows).select("seq", "id")


_HITS = "regexp_matches(text, '(?i)\\b(?:the|der|que|les)\\b')"


@query(
    f"WITH {views.PAPERS}, h AS (SELECT paper, count(*) FILTER ({_HITS}) AS h, coalesce(string_agg('p' || page || ': TERM', '; ' ORDER BY page) FILTER ({_HITS}), '') AS evidence FROM papers WHERE trim(text) <> '' GROUP BY paper) "
    "SELECT paper, CASE WHEN h >= 2 THEN 'YES' WHEN h = 1 THEN 'UNCERTAIN' ELSE 'NO' END AS include, CASE WHEN h >= 2 THEN 'OBSERVATIONAL_DATA' WHEN h = 1 THEN 'REVIEW' ELSE '' END AS basis, evidence FROM h"
)
def classify_udf(v: Views) -> DataFrame:
    rows = classifier.classify(v.papers().select("paper", "page", "text"))
    return rows.select("paper", "include", F.array_join("basis", ",").alias("basis"), F.array_join(F.transform("evidence", lambda e: F.concat(F.lit("p"), e["page"].cast("string"), F.lit(": "), e["reason"])), "; ").alias("evidence"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '' ELSE 'https://b.example/' || page_id END AS left_over FROM pages")
def already_tried_subtraction(v: Views) -> DataFrame:
    n, url = F.col("page_id").cast("string"), F.col("url")
    twin = F.regexp_replace(url, "^https?:", "ftp:")
    urls = F.array(url, F.concat(F.lit("https://b.example/"), n))
    tried = F.when(F.col("page_id") % 3 == 0, F.array(twin, F.concat(F.lit("http://b.example/"), n))).otherwise(F.array(twin))
    return v.table("pages").select("page_id", F.array_join(downloads.untried(urls, tried), " ").alias("left_over"))


@query(f"WITH {views.ATTEMPTS} SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey % 2 = 0 AND CAST(c_custkey AS VARCHAR) NOT IN (SELECT id FROM att WHERE category IS NULL)")
def open_access_phase(v: Views) -> DataFrame:
    attempts = _triaged(v).withColumn("status", F.when(F.col("category").isNull(), "downloaded").otherwise("failed"))
    jobs = v.table("customer").select(F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_custkey") % 2 == 0, "d").alias("doi"))
    return downloads.open_access_phase(jobs, attempts).select("id")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'content has no PDF signature' WHEN event_id % 3 = 0 THEN 'PDF checksum does not match the expected SHA-256' WHEN event_id % 5 = 0 THEN 'PDF cannot be opened or its first page cannot be read' WHEN event_id % 7 = 0 THEN 'PDF has no pages' WHEN event_id % 13 > 0 AND event_id % 11 = 0 THEN 'PDF has no extractable text' WHEN event_id % 13 > 0 AND event_id % 17 < 5 THEN 'PDF text does not match the abstract (overlap ' || printf('%.2f', CAST(event_id % 120 AS DOUBLE) / 200) || ')' END AS error FROM events")
def pdf_validation(v: Views) -> DataFrame:
    n = F.col("event_id")
    content = F.when(n % 2 == 0, F.concat(F.lit("x" * 1100), F.lit("%PDF-1.7"))).otherwise(F.lit("\n\n%PDF-1.7")).cast("binary")
    pages = F.when(n % 5 == 0, F.lit(None).cast("int")).when(n % 7 == 0, F.lit(0)).otherwise(F.lit(3))
    overlap = F.when(n % 17 < 5, (n % 120) / F.lit(200.0)).when(n % 17 < 9, F.lit(None).cast("double")).otherwise(0.64)
    error = downloads.pdf_error(downloads.has_signature(content), n % 3 != 0, pages, F.when(n % 13 > 0, "a"), n % 11 != 0, overlap)
    return v.table("events").select("event_id", error.alias("error"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'response incomplete' || CASE WHEN event_id % 8 = 0 THEN ': max_output_tokens' ELSE '' END WHEN event_id % 4 = 1 THEN 'refused: no' WHEN event_id % 4 = 2 THEN 'no parsed output' END AS problem, event_id % 7 = 0 OR (event_id % 7 = 1 AND event_id % 2 = 0) OR (event_id % 7 = 2 AND event_id % 3 = 0) AS stops FROM events")
def llm_response_problem(v: Views) -> DataFrame:
    n = F.col("event_id")
    text = responses.problem(F.when(n % 4 == 0, "incomplete").otherwise("completed"), F.when(n % 8 == 0, "max_output_tokens"), F.when(n % 4 == 1, "no"), F.when(n % 4 == 3, "{}"))
    kind = F.when(n % 7 == 0, "authentication").when(n % 7 == 1, "rate_limit").when(n % 7 == 2, "bad_request").otherwise("timeout")
    stops = responses.stops_run(kind, F.when(n % 2 == 0, "insufficient_quota"), F.when(n % 3 == 0, "text.format"))
    return v.table("events").select("event_id", text.alias("problem"), stops.alias("stops"))


_LABELLED = f"{views.LATEST}, {_CASES}, j AS (SELECT l.*, c.expected_include AS e, CASE c.expected_include WHEN 'YES' THEN ['COMPANION_PAPER', 'OBSERVATIONAL_DATA'] WHEN 'UNCERTAIN' THEN ['REVIEW'] WHEN 'NO' THEN [] END AS eb FROM latest l LEFT JOIN cases c USING (id))"


@query(
    f"WITH {_LABELLED}, {_COUNTS}, rv AS (SELECT * FROM latest WHERE ok AND include IN ('YES', 'UNCERTAIN') AND id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 3 = 0)), fl AS (SELECT * FROM latest WHERE NOT ok), "
    "s AS (SELECT count(*) FILTER (ok AND include = e) AS c, count(*) FILTER (ok AND include <> e) AS i, count(*) FILTER (NOT ok) AS f, count(*) FILTER (ok AND list_sort(list_distinct(basis)) = list_sort(list_distinct(eb))) AS b, count(*) FILTER (ok) AS k FROM j WHERE e IS NOT NULL), "
    f"r AS ({_HEAD} UNION ALL SELECT 1, 7, '- No PDF, not classified: ' || count(*) FROM supplier{_STATED.format(8, 9)} "
    "UNION ALL SELECT 2, -5, '' UNION ALL SELECT 2, -4, '## To review: YES or UNCERTAIN, not in `members` (' || count(*) || ')' FROM rv UNION ALL SELECT 2, -3, '' UNION ALL SELECT 2, -2, '| Paper | Decision | Evidence |' UNION ALL SELECT 2, -1, '|---|---|---|' "
    f"UNION ALL SELECT 2, first_seq, '| [' || id || '](https://ui.adsabs.harvard.edu/abs/' || id || '/abstract) | ' || {_DECISION} || ' | p' || (seq % 9 + 1) || ': a / b; p2: c |' FROM rv "
    "UNION ALL SELECT 3, unnest([-5, -4, -3, -2, -1]), unnest(['', '## No PDF, not classified (' || n || ')', '', '| Paper | Why | Save the PDF as |', '|---|---|---|']) FROM (SELECT count(*) AS n FROM supplier) WHERE n > 0 "
    "UNION ALL SELECT 3, 0, '| [' || s_suppkey || '](https://ui.adsabs.harvard.edu/abs/' || s_suppkey || '/abstract) | blocked: HTTP 403; x / y | `pdfs/' || s_suppkey || '.pdf` |' FROM supplier "
    "UNION ALL SELECT 4, unnest([-5, -4, -3, -2, -1]), unnest(['', '## Could not be classified (' || n || ')', '', '| Paper | Error |', '|---|---|']) FROM (SELECT count(*) AS n FROM fl) WHERE n > 0 UNION ALL SELECT 4, first_seq, '| `' || id || '` | no text / found |' FROM fl "
    "UNION ALL SELECT 5, unnest([-3, -2, -1, 0]), unnest(['', '| Include correct | Include incorrect | Failed | Basis exact match |', '|---:|---:|---:|---:|', '| ' || c || ' | ' || i || ' | ' || f || ' | ' || b || ' of ' || k || ' |']) FROM s WHERE c + i + f > 0"
    f"{_PAPER_TABLE} UNION ALL SELECT 6, first_seq, '| `' || id || '` | ' || CASE WHEN e IS NULL THEN '-' WHEN len(eb) > 0 THEN e || ' (' || array_to_string(eb, ', ') || ')' ELSE e END || ' | ' || {_PREDICTED} FROM j) SELECT section, CAST(ord AS BIGINT) AS ord, line FROM r"
)
def report_sections(v: Views) -> DataFrame:
    """All sections: library, queue and labels are given."""
    cited = F.array(F.struct((F.col("seq") % 9 + 1).cast("int").alias("page"), F.lit("a | b").alias("reason")), F.struct(F.lit(2).alias("page"), F.lit("c").alias("reason")))
    results = resultlog.latest(v.log()).withColumn("errors", F.array(F.lit("first"), F.lit("no text |\n found"))).withColumn("evidence", cited)
    key = F.col("s_suppkey").cast("string")
    queue = v.table("supplier").select(key.alias("id"), F.lit("blocked").alias("category"), F.array(F.lit("HTTP 403"), F.lit("x |\ny"), F.lit("HTTP 403")).alias("errors"), F.concat(F.lit("pdfs/"), key, F.lit(".pdf")).alias("target"))
    return report.full(resultlog.relabel(results, _cases(v)), *_CONFIGURATION, library=_library(v), library_name="members", queue=queue)


@query(
    f"WITH {views.PAPERS}, h AS (SELECT paper, count(*) FILTER ({_HITS}) AS h FROM papers WHERE trim(text) <> '' GROUP BY paper), j AS (SELECT DISTINCT paper, CAST(turn % 2 AS VARCHAR) AS key FROM papers) "
    "SELECT j.paper AS id, key, CASE WHEN h >= 2 THEN 'YES' WHEN h = 1 THEN 'UNCERTAIN' WHEN h = 0 THEN 'NO' END AS include, CAST(CASE WHEN h IS NULL THEN 0 ELSE 1 END AS BIGINT) AS successes FROM j LEFT JOIN h USING (paper)"
)
def stream_resume(v: Views) -> DataFrame:
    """A job for each page of a paper, under two keys, in three arrivals and four runs.

    However often an id and key come, they are classified once.
    """
    from ..streaming.resume import arrivals

    jobs = v.papers().select(F.col("conv_id").cast("long").alias("seq"), F.col("paper").alias("id"), (F.col("turn") % 2).cast("string").alias("key"), "turn")
    parts = [jobs.where(F.col("turn") % 3 == k).drop("turn") for k in range(3)]
    rows = arrivals(v.spark, parts, v.papers().select("paper", "page", "text"))
    return rows.groupBy("id", "key").agg(F.max("include").alias("include"), F.count_if("ok").alias("successes"))


@query("SELECT doc_id, lang, source, n_chars, sha256(text) AS text_sha256 FROM documents")
def jsonl_log(v: Views) -> DataFrame:
    """Whole texts as JSON Lines in two appends, torn behind each and repaired by the next, then read with a torn tail."""
    path = shared_dir(v.spark)
    rows = v.table("documents").select("doc_id", "text", "lang", "source", "n_chars")
    for part in range(2):
        jsonl.append(rows.where(F.pmod("doc_id", F.lit(2)) == part), path)
        system, root = storage.of(path)
        last = storage.visible(system, root)[-1][0]
        storage.extend(system, last, [], '{"doc_id": 1, "text": "\u00e9'.encode()[:-1])
    read = jsonl.read(v.spark, path, "doc_id long, text string, lang string, source string, n_chars long", split=1 << 20)
    return read.select("doc_id", "lang", "source", "n_chars", T.sha256(F.col("text")).alias("text_sha256"))


@query(
    "WITH o AS (SELECT CAST(doc_id AS VARCHAR) AS id, n_chars % 5 AS d FROM documents WHERE doc_id % 3 <> 0), n AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 7 = 0 THEN 9 ELSE n_chars % 5 END AS d FROM documents WHERE doc_id % 3 <> 1) "
    "SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'dropped' WHEN o.d <> n.d THEN 'changed' ELSE 'kept' END AS change, CASE WHEN o.id IS NULL THEN 'r2' ELSE 'r1' END AS first_run, CASE WHEN n.id IS NULL THEN 'r1' ELSE 'r2' END AS last_run, n.id IS NOT NULL AS current FROM o FULL JOIN n USING (id)"
)
def search_states(v: Views) -> DataFrame:
    """Two snapshots of a search: what changed, and the state that keeps every id."""
    key, told = F.col("doc_id"), F.col("n_chars") % 5
    old = snapshots.digested(v.table("documents").where(key % 3 != 0).select(key.alias("id"), told.alias("d")), "id")
    new = snapshots.digested(v.table("documents").where(key % 3 != 1).select(key.alias("id"), F.when(key % 7 == 0, 9).otherwise(told).alias("d")), "id")
    state = snapshots.fold(snapshots.fold(v.spark.createDataFrame([], snapshots.STATE), old, "r1"), new, "r2")
    return snapshots.changes(old, new).join(state, "id").select("id", "change", "first_run", "last_run", "current")


@query("SELECT doc_id AS seq, lang AS id FROM documents WHERE doc_id % 3 = 1")
def configuration_filter(v: Views) -> DataFrame:
    """Rows whose key is that of their own hash under the model in use; the others were made by another model or effort."""
    sha = T.sha256(F.col("text"))
    made = F.when(F.col("doc_id") % 3 == 1, T.evaluation_key(sha, MODEL, EFFORT, PIPELINE, PROMPT)).when(F.col("doc_id") % 3 == 0, T.evaluation_key(sha, "model-b", EFFORT, PIPELINE, PROMPT)).otherwise(T.evaluation_key(sha, MODEL, "low", PIPELINE, PROMPT))
    log = v.table("documents").select(F.col("doc_id").alias("seq"), F.col("lang").alias("id"), made.alias("key"), sha.alias("pdf_sha256"))
    return resultlog.of_configuration(log, MODEL, EFFORT, PIPELINE, PROMPT).select("seq", "id")


@query(
    f"WITH {views.PAPERS}, h AS (SELECT paper, count(*) FILTER ({_HITS}) AS h, count(*) AS pages, sum(length(text)) AS chars FROM papers WHERE trim(text) <> '' AND conv_id % 5 > 0 GROUP BY paper), j AS (SELECT DISTINCT paper, conv_id FROM papers) "
    f"SELECT paper AS id, coalesce(CAST(pages AS INT), 0) AS pages_sent, coalesce(CAST(chars AS BIGINT), 0) AS characters_sent, CASE WHEN h IS NULL THEN 'PROCESSING_FAILED' ELSE 'CLASSIFIED' END AS status, CASE WHEN h >= 2 THEN 'YES' WHEN h = 1 THEN 'UNCERTAIN' WHEN h = 0 THEN 'NO' END AS include, "
    "CASE WHEN h IS NOT NULL THEN '' WHEN conv_id % 2 = 0 THEN 'cannot open' ELSE 'The paper has no text to classify' END AS errors, 0 AS violations FROM j LEFT JOIN h USING (paper)"
)
def result_records(v: Views) -> DataFrame:
    """Records of the log: decisions, papers that could not be opened, and papers without text."""
    pages = v.papers()
    jobs = pages.select(F.col("paper").alias("id"), F.col("paper").alias("bibcode"), "conv_id").distinct().withColumns({"sha": T.sha256(F.col("id")), "key": F.lit("k")})
    sent = pages.where(F.col("conv_id") % 5 > 0).select("paper", "page", "text")
    failed = jobs.where((F.col("conv_id") % 5 == 0) & (F.col("conv_id") % 2 == 0)).select(F.col("id").alias("paper"), F.lit("cannot open").alias("problem"))
    rows = resultlog.records(jobs.drop("conv_id"), classifier.classify(sent), papers.context(sent).drop("context"), model=MODEL, effort=EFFORT, pipeline=PIPELINE, prompt_version="v", prompt_sha256=PROMPT, failed=failed)
    broken = schemas.result_violations(F.col("result.status"), F.col("result.classification").isNotNull(), F.col("result.errors"))
    return rows.select("id", "pages_sent", "characters_sent", "result.status", "result.classification.include", F.array_join("result.errors", "; ").alias("errors"), F.size(broken).alias("violations"))


@query(
    "WITH e AS (SELECT CAST(page_id % 199 AS VARCHAR) AS lane, page_id AS seq, 1700000000000 + page_id % 977 * 1000 AS ms, page_id % 4 = 3 AS wall FROM pages), "
    "n AS (SELECT *, count(CASE WHEN NOT wall THEN 1 END) OVER (PARTITION BY lane ORDER BY ms, seq) AS n FROM e), "
    "m AS (SELECT *, max(CASE WHEN NOT wall THEN ms - n * 3000 END) OVER (PARTITION BY lane ORDER BY ms, seq) + n * 3000 AS made FROM n) "
    "SELECT lane, seq, CAST(CASE WHEN wall THEN greatest(ms, coalesce(made + 3000, 0)) ELSE made END AS BIGINT) AS lease_ms, wall AS skipped FROM m"
)
def stream_leases(v: Views) -> DataFrame:
    """Pages as requests in lanes, to four hosts of which one is a wall: when each may start, or that it is skipped."""
    from ..streaming import leases

    start = 1_700_000_000_000
    host = F.concat(F.lit("h"), (F.col("page_id") % 4).cast("string"))
    none, no = F.lit(None).cast("string"), F.lit(False)
    lane = (F.col("page_id") % 199).cast("string").alias("lane")
    asked = v.table("pages").select(lane, F.col("page_id").alias("seq"), F.timestamp_millis(F.lit(start) + F.col("page_id") % 977 * 1000).alias("at"), "url", host.alias("host"), no.alias("preprint"), no.alias("wall"))
    walls = v.table("pages").select(lane).distinct().select("lane", F.lit(-1).cast("long").alias("seq"), F.timestamp_millis(F.lit(start)).alias("at"), none.alias("url"), F.lit("h3").alias("host"), no.alias("preprint"), F.lit(True).alias("wall"))
    return leases.schedule([asked.unionByName(walls)], delay="1 hour").select("lane", "seq", "lease_ms", "skipped")
