"""Incremental classification: a file stream in available-now runs, resumed from its checkpoint.

Each micro-batch drops the jobs that the result table has as successes under the same id and key,
classifies the papers of the rest and appends what came of it. The checkpoint replaces per-record
appends: a batch that failed half-way is run again, and the anti-join makes that harmless. Of the
result table a batch reads the ids and keys of successes only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import classifier, papers, resultlog
from ..session import shared_dir

JOB = "seq long, id string, key string"
RESULT = f"{JOB}, ok boolean, include string, basis array<string>, errors array<string>"


def run_once(spark: SparkSession, inbox: str, pages: DataFrame, results: str, checkpoint: str, make=classifier.TermClassifier) -> None:
    """Works off the files that came to the inbox since the last run.

    pages is (paper, page, text). A paper without text is a failed row. If the service refuses
    every paper, the batch's finished papers are kept and the run ends in an error; the batch
    comes again in the next run.
    """

    def batch(rows: DataFrame, _: int) -> None:
        done = spark.read.schema(RESULT).parquet(results) if _exists(spark, results) else spark.createDataFrame([], RESULT)
        one = rows.groupBy("id", "key").agg(F.min("seq").alias("seq"))
        path = shared_dir(spark)
        resultlog.pending(one, done).write.parquet(f"{path}/jobs")
        jobs = spark.read.parquet(f"{path}/jobs")
        texts = papers.strip_references(pages.join(jobs.select(F.col("id").alias("paper")).distinct(), "paper", "left_semi"))
        sent = texts.where(T.strip(F.col("text")) != "")
        classifier.classify(sent, make).write.parquet(f"{path}/decided")
        decided = spark.read.parquet(f"{path}/decided")
        told = jobs.join(sent.select("paper").distinct().withColumn("sent", F.lit(True)), F.col("id") == F.col("paper"), "left").drop("paper")
        told = told.join(decided.where("stop is null"), F.col("id") == F.col("paper"), "left").where("sent is null or paper is not null")
        ok, why = F.col("include").isNotNull(), F.coalesce("errors", F.array(F.lit(resultlog.NO_TEXT)))
        told.select("seq", "id", "key", ok.alias("ok"), "include", "basis", why.alias("errors")).write.mode("append").parquet(results)
        classifier.stopped(decided)

    stream = spark.readStream.schema(JOB).parquet(inbox)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def arrivals(spark: SparkSession, parts: list[DataFrame], pages: DataFrame) -> DataFrame:
    """The result table after the jobs came in parts, one run each, and a last run without any."""
    root = shared_dir(spark)
    for part in parts:
        part.write.mode("append").parquet(f"{root}/inbox")
        run_once(spark, f"{root}/inbox", pages, f"{root}/results", f"{root}/checkpoint")
    run_once(spark, f"{root}/inbox", pages, f"{root}/results", f"{root}/checkpoint")
    return spark.read.schema(RESULT).parquet(f"{root}/results")
