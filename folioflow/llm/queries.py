"""The queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fim, langid, mainhtml, neardup, packing, personal, quality_rules, ranking, substrings, tokenfile, urlfilter, veccodes
from .common import table


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ranking.classify(docs, ranking.train(docs, table(spark, sf_dir, "labels")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return rows.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


#: Host and path prefix, verdict.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES, labels)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(table(spark, sf_dir, "documents"), digest=True)
    return rows.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(docs, model, "doc_id")


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tokenfile.write_tokens(table(spark, sf_dir, "documents"))
    # the length is that of the list as read, not the one that was written beside it
    return packing.with_crc32(tokenfile.read_tokens(spark, out).withColumn("n_tokens", F.size("ids").cast("long")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mainhtml.main_text(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = personal.find(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *(f"n_{k}" for k in personal.KINDS), F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.arrange(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fim.*")
    digest = F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digest)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = veccodes.compress(table(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(books.digest if books else None).alias("codebooks_sha256"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_near_duplicates, op2_quality_classifier, op3_decontamination, op4_url_filter, op5_packing, op6_quality_rules, op7_token_file, op8_substring_dedup, op9_html_extraction, op10_personal_data, op11_fill_in_middle, op12_vector_codes, op13_language_id)
}
