"""The corpus pipeline: quality rules, near-dedup, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns a DataFrame;
all but the last return the columns of documents. Between stages the rows are written as Parquet
in the folder of spark.checkpoint.dir and read again.

Every stage takes nulls in any column, texts that are empty or of any length, rows and ids that
repeat, further columns whatever their names, and tables without rows; each says what becomes of
them. Null texts count as empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import decontaminate, neardup, packing, personal, quality_rules
from folioflow.llm.common import materialise, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; the trees are fitted on the labelled ones among `docs`.

    Texts of under 50 words, null and empty ones among them, are left out. Rows that repeat are
    judged alike, a null id is judged by its text, and without labels the base rules alone decide.
    """
    return quality_rules.keep_good(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies: five-word shingles, similarity 0.8.

    Each row counts for itself, whatever its id. Of equal ids and texts one row stays, of a group
    that of the least id, and one without an id only if none has one; of equal rows without words one.
    """
    return neardup.keep_one(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item.

    Documents and items without words share none, so such documents stay; a row is judged by its
    own text, whatever ids repeat or are null.
    """
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in the text replaced by its kind in brackets.

    No row is left out. Where found spans overlap, the first to start names what covers the rest.
    """
    return personal.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in pieces whose lengths are powers of two; no sequence crosses documents.

    A null or empty text has one piece with the end id; each row is packed for itself.
    """
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("near_dedup", dedup), ("decontamination", decontamination), ("personal_data", personal_data), ("packing", pack)]

#: Trees, sketches and a tokenizer have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if at + 1 < len(STAGES):
            rows = materialise(rows)
    return rows
