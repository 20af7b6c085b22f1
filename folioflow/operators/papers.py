"""Operators on page texts: (paper, page, text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def usable(pages: DataFrame, least: int = T.LEAST_LETTERS) -> DataFrame:
    """(paper, letters, usable): whether the pages of a paper have enough letters."""
    return pages.groupBy("paper").agg(F.sum(T.letters(F.col("text"))).alias("letters")).withColumn("usable", F.col("letters") >= least)


def strip_references(pages: DataFrame) -> DataFrame:
    """Cuts each paper's last reference list; captions and what follows a resuming heading stay."""
    whole = Window.partitionBy("paper")
    a = pages.withColumn("heading", T.last_offset(F.col("text"), T.REFERENCES))
    a = a.withColumn("start", F.max(F.when(F.col("heading").isNotNull(), F.col("page"))).over(whole))
    a = a.withColumn("off", F.when(F.col("page") == F.col("start"), F.col("heading")).otherwise(F.lit(0)))
    a = a.withColumn("tail", F.expr("substring(text, off + 1)")).withColumn("resume", T.first_offset(F.col("tail"), T.RESUME))
    a = a.withColumn("stop", F.min(F.when((F.col("page") >= F.col("start")) & F.col("resume").isNotNull(), F.col("page"))).over(whole))
    a = a.withColumn("cut", F.coalesce("resume", F.length("tail"))).withColumn("caption", T.first_offset(F.expr("substring(tail, 1, cut)"), T.CAPTION))
    kept = T.strip(F.concat(T.strip_right(F.expr("substring(text, 1, off)")), F.lit("\n\n"), F.expr("substring(tail, coalesce(caption, cut) + 1)")))
    inside = (F.col("page") >= F.col("start")) & ((F.col("page") <= F.col("stop")) | F.col("stop").isNull())
    return a.select("paper", "page", F.when(F.coalesce(inside, F.lit(False)), kept).otherwise(F.col("text")).alias("text"))


def context(pages: DataFrame) -> DataFrame:
    """(paper, context, pages_sent, characters_sent); a paper without text has no row."""
    full = pages.where(T.strip(F.col("text")) != "")
    label = F.concat(F.lit("[PAGE "), F.col("page").cast("string"), F.lit("]\n"), F.col("text"), F.lit("\n[END PAGE "), F.col("page").cast("string"), F.lit("]"))
    return full.groupBy("paper").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", label.alias("label")))), lambda x: x["label"]), "\n\n").alias("context"),
        F.count("*").alias("pages_sent"),
        F.sum(F.length("text")).alias("characters_sent"),
    )


def invented_pages(evidence: DataFrame, pages: DataFrame) -> DataFrame:
    """(paper, invented): sorted evidence pages that were not sent."""
    sent = pages.where(T.strip(F.col("text")) != "").groupBy("paper").agg(F.collect_set("page").alias("sent"))
    cited = evidence.groupBy("paper").agg(F.collect_set("page").alias("cited"))
    return cited.join(sent, "paper", "left").select("paper", F.array_sort(F.array_except("cited", F.coalesce("sent", F.array().cast("array<int>")))).alias("invented"))


def render_evidence(evidence: DataFrame) -> DataFrame:
    """(paper, evidence): `p<page>: reason` joined in the items' order, fit for a table cell."""
    item = F.concat(F.lit("p"), F.col("page").cast("string"), F.lit(": "), F.col("reason"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", item.alias("item")))), lambda x: x["item"]), "; ")
    return evidence.groupBy("paper").agg(T.table_cell(joined).alias("evidence"))
