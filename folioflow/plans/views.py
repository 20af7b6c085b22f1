"""Views of the driver's tables in the shapes of the engine's own tables, for Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def papers(self) -> DataFrame:
        return self.table("conversations").select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("paper"), (F.col("turn") + 1).cast("int").alias("page"), "text", "conv_id", "turn")

    def papers_with_references(self) -> DataFrame:
        way = (F.col("conv_id") + F.col("turn")) % 4
        text = F.when(way == 1, F.concat("text", F.lit("\nReferences\nAlpha, A. 2020"))).when(way == 2, F.concat(F.lit("Appendix A\n"), "text")).when(way == 3, F.concat("text", F.lit("\nFig. 1 x"))).otherwise(F.col("text"))
        return self.papers().select("paper", "page", text.alias("text"))

    def log(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int") % 3
        include = F.when(F.col("event_type") == "purchase", "YES").when(F.col("event_type") == "signup", "UNCERTAIN").otherwise("NO")
        basis = F.when((include == "YES") & (F.col("event_id") % 2 == 0), F.array(F.lit("OBSERVATIONAL_DATA"), F.lit("COMPANION_PAPER"))).when(include == "YES", F.array(F.lit("OBSERVATIONAL_DATA"))).when(include == "UNCERTAIN", F.array(F.lit("REVIEW"))).otherwise(F.array().cast("array<string>"))
        return self.table("events").select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("id"), k.cast("string").alias("key"), (F.col("event_type") != "error").alias("ok"), include.alias("include"), basis.alias("basis"))

    def attempts(self) -> DataFrame:
        """Responses to requests: status, server, host and what they mean by the triage operator."""
        status = F.element_at(F.array(*map(F.lit, (200, 403, 404, 429, 500, 503))), (F.col("event_id") % 6 + 1).cast("int"))
        server = F.element_at(F.array(F.lit("nginx"), F.lit("Cloudflare"), F.lit("AkamaiGHost")), (F.col("event_id") % 5 % 3 + 1).cast("int"))
        kind = F.when(F.col("event_id") % 7 == 0, "text/html").when(F.col("event_id") % 7 == 1, F.lit(None)).otherwise("application/pdf")
        return self.table("events").select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("id"), F.concat(F.lit("h"), (F.col("user_id") % 10).cast("string")).alias("host"), status.alias("http"), server.alias("server"), kind.alias("content_type"), (F.col("event_id") % 11 == 0).alias("preprint"))

    def links(self) -> DataFrame:
        """Four links of each page: a closed and an open file, a resolver link and a preprint."""
        twin = F.regexp_replace("url", "^https?:", F.when(F.col("page_id") % 2 == 0, "http:").otherwise("https:"))
        prefix = F.element_at(F.array(*map(F.lit, ("10.1007/", "10.1038/", "10.3389/", "10.9999/"))), (F.col("page_id") % 4 + 1).cast("int"))
        doi = F.concat(F.lit("https://doi.org/"), F.replace(prefix, F.lit("/"), F.lit("%2F")), F.lit("s"), F.col("page_id").cast("string"))

        def link(access, kind, url):
            return F.struct(access.alias("access"), F.lit(kind).alias("type"), url.alias("url"))

        access = F.when(F.col("page_id") % 3 == 0, "closed").otherwise("open")
        links = F.array(link(access, "pdf", F.col("url")), link(F.lit("open"), "pdf", twin), link(F.lit("open"), "electr", doi), link(F.lit("open"), "preprint", F.concat(F.lit("http://arxiv.org/abs/"), F.col("page_id").cast("string"))))
        scan = link(F.lit("open"), "gif", F.concat(F.lit("http://articles.adsabs.harvard.edu/full/"), F.col("page_id").cast("string")))
        return self.table("pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("bibcode"), F.when(F.col("page_id") % 5 == 0, F.concat(links, F.array(scan))).otherwise(links).alias("links_data"), F.when(F.col("page_id") % 6 == 0, F.array(F.col("url"))).otherwise(F.array().cast("array<string>")).alias("pdf_links"), F.when(F.col("page_id") % 4 == 0, F.array(F.concat(F.lit("10.5/"), F.col("page_id").cast("string")))).alias("doi"), "page_id", "url")


# The same views for the SQL side.
PAPERS = "papers AS (SELECT 'c' || conv_id AS paper, CAST(turn + 1 AS INT) AS page, text, conv_id, turn FROM conversations)"
REFS = (
    "refs AS (SELECT 'c' || conv_id AS paper, CAST(turn + 1 AS INT) AS page, CASE (conv_id + turn) % 4 WHEN 1 THEN text || chr(10) || 'References' || chr(10) || 'Alpha, A. 2020' "
    "WHEN 2 THEN 'Appendix A' || chr(10) || text WHEN 3 THEN text || chr(10) || 'Fig. 1 x' ELSE text END AS text FROM conversations)"
)
LOG = (
    "l0 AS (SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INT) % 3 AS k, CASE event_type WHEN 'purchase' THEN 'YES' WHEN 'signup' THEN 'UNCERTAIN' ELSE 'NO' END AS include FROM events), "
    "log AS (SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS id, CAST(k AS VARCHAR) AS key, event_type <> 'error' AS ok, include, CASE WHEN include = 'YES' AND event_id % 2 = 0 THEN ['OBSERVATIONAL_DATA', 'COMPANION_PAPER'] "
    "WHEN include = 'YES' THEN ['OBSERVATIONAL_DATA'] WHEN include = 'UNCERTAIN' THEN ['REVIEW'] ELSE [] END AS basis FROM l0)"
)
LATEST = (
    f"{LOG}, la AS (SELECT *, last_value(key) OVER w AS lk, min(seq) OVER (PARTITION BY id) AS first_seq FROM log WINDOW w AS (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), "
    "lb AS (SELECT *, max(CASE WHEN key <> lk THEN seq END) OVER (PARTITION BY id) AS brk FROM la), "
    "lc AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE WHEN ok THEN 0 ELSE 1 END, seq DESC) AS rn FROM lb WHERE seq > coalesce(brk, -1)), latest AS (SELECT * FROM lc WHERE rn = 1)"
)
ATTEMPTS = (
    "a0 AS (SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS id, 'h' || (user_id % 10) AS host, [200, 403, 404, 429, 500, 503][event_id % 6 + 1] AS http, ['nginx', 'cloudflare', 'akamaighost'][event_id % 5 % 3 + 1] AS server, "
    "CASE event_id % 7 WHEN 0 THEN 'text/html' WHEN 1 THEN '' ELSE 'application/pdf' END AS ct, event_id % 11 = 0 AS preprint FROM events), "
    "a1 AS (SELECT *, CASE WHEN http = 403 AND server = 'cloudflare' THEN 'Cloudflare' WHEN http = 403 AND server = 'akamaighost' THEN 'Akamai' WHEN http = 403 AND preprint THEN 'arXiv' END AS bot FROM a0), "
    "a2 AS (SELECT *, CASE WHEN http = 200 AND ct = 'text/html' THEN 'unexpected content type: text/html' WHEN http <> 200 THEN 'HTTP ' || http END AS err0 FROM a1), "
    "att AS (SELECT seq, id, host, CASE WHEN err0 IS NULL THEN NULL WHEN bot IS NOT NULL THEN 'blocked' WHEN http IN (408, 425, 429) OR http >= 500 THEN 'transient' ELSE 'permanent' END AS category, "
    "CASE WHEN err0 IS NOT NULL AND bot IS NOT NULL THEN err0 || ' (bot protection: ' || bot || ')' ELSE err0 END AS error FROM a2)"
)
LINKS = (
    "lk AS (SELECT page_id, 'p' || page_id AS bibcode, url, regexp_replace(url, '^https?:', CASE WHEN page_id % 2 = 0 THEN 'http:' ELSE 'https:' END) AS twin, ['10.1007/', '10.1038/', '10.3389/', '10.9999/'][page_id % 4 + 1] AS prefix, 's' || page_id AS suffix FROM pages), "
    "routed AS (SELECT bibcode, 1 AS class, 0 AS of_link, 0 AS pos, url FROM lk WHERE page_id % 6 = 0 UNION ALL SELECT bibcode, 1, 1, 0, url FROM lk WHERE page_id % 3 <> 0 UNION ALL SELECT bibcode, 1, 1, 1, twin FROM lk "
    "UNION ALL SELECT bibcode, 2, 1, 2, CASE prefix WHEN '10.1007/' THEN 'https://link.springer.com/content/pdf/' || prefix || suffix || '.pdf' WHEN '10.1038/' THEN 'https://www.nature.com/articles/' || suffix || '.pdf' ELSE 'https://www.frontiersin.org/articles/' || prefix || suffix || '/pdf' END FROM lk WHERE prefix <> '10.9999/' "
    "UNION ALL SELECT bibcode, 0, 1, 3, 'https://arxiv.org/pdf/' || page_id FROM lk UNION ALL SELECT bibcode, 3, 1, 4, 'https://articles.adsabs.harvard.edu/pdf/' || bibcode FROM lk WHERE page_id % 5 = 0), "
    "ordered AS (SELECT *, row_number() OVER (PARTITION BY bibcode ORDER BY class, of_link, pos) AS ord FROM routed)"
)
