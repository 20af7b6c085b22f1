"""Which texts hold most of the words of which short ones, without comparing all pairs.

A text that holds at least `need` of n words misses at most n - need of them, so it holds one of
any n - need + 1. Each short text is looked up by its n - need + 1 rarest words only; texts with
fewer than `need` of the words that any short text has are left out by their number. What is left
is counted exactly. So a word that nearly all texts have is looked up only for a short text that
has too few rarer ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir


def postings(texts: DataFrame, short: DataFrame) -> DataFrame:
    """(text, word) of (text, words), for words of `short` only; written, as three steps read it."""
    wanted = short.select(F.explode("words").alias("word")).distinct()
    path = shared_dir(texts.sparkSession)
    texts.select("text", F.explode(F.array_distinct("words")).alias("word")).join(wanted, "word", "left_semi").write.parquet(path)
    return texts.sparkSession.read.parquet(path)


def prefixes(short: DataFrame, held: DataFrame, least: float) -> DataFrame:
    """(short, word, need): the rarest words of each short text, by the number of texts that hold them.

    A word that no text holds is the rarest; equally rare words go by their letters.
    """
    often = held.groupBy("word").agg(F.count("*").alias("often"))
    # a hair below the exact product, so that rounding never asks for a word too many
    need = F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(least) - F.lit(1e-6)).cast("int"))
    words = short.select("short", F.size("words").alias("n"), F.explode("words").alias("word")).join(often, "word", "left").withColumn("need", need)
    rank = F.row_number().over(Window.partitionBy("short").orderBy(F.coalesce("often", F.lit(0)), "word"))
    return words.withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.col("need") + 1).select("short", "word", "need")


def candidates(short: DataFrame, held: DataFrame, least: float) -> DataFrame:
    """(short, text): the pairs that have to be counted."""
    sizes = held.groupBy("text").agg(F.count("*").alias("size"))
    pairs = held.join(prefixes(short, held, least), "word").select("short", "text", "need").distinct()
    return pairs.join(sizes, "text").where(F.col("size") >= F.col("need")).select("short", "text")


def containing(short: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(short, text, overlap) where the share of the short text's distinct words that the text holds is at least `least`.

    short is (short, words), texts is (text, words); both ids are unique and not null. Rows without
    words take no part. `least` is above 0.
    """
    some = short.select("short", F.array_distinct("words").alias("words")).where(F.size("words") > 0)
    held = postings(texts, some)
    each = some.select("short", F.size("words").alias("n"), F.explode("words").alias("word"))
    counted = candidates(some, held, least).join(held, "text").join(each, ["short", "word"]).groupBy("short", "text", "n").agg(F.count("*").alias("shared"))
    return counted.select("short", "text", (F.col("shared") / F.col("n")).alias("overlap")).where(F.col("overlap") >= least)
