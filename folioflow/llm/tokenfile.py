"""Token ids as Parquet list columns.

A token file is a folder of Parquet files in ascending doc_id order, one per range partition:
doc_id, part, local_start (ids before the document in its part), n_tokens, ids. Ids are
dictionary-encoded, or delta-encoded where a dictionary grows too large (format version 2), in
row groups of a set size with page indexes, so a reader that wants a few documents or only the
metadata reads only those pages. Positions over the whole corpus are local_start plus the
totals of the parts before, which a reader adds from the metadata columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir, small_batches
from .tokens import encoder, id_lists, vocabulary

ROW_GROUP_BYTES, PAGE_BYTES, END_ID = 32 << 20, 64 << 10, 1


def write_tokens(docs: DataFrame, out: str | None = None, *, path: str | None = None, end_id: int = END_ID, id_column: str = "doc_id", text_column: str = "text", encoding: str = "dictionary", row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> str:
    """Encodes every document and writes the token file; returns its path.

    `encoding` is that of numbers: dictionary, with delta where a dictionary grows too large, or
    delta for all, which suits ids without frequent values.

    Null text counts as empty, so it has only the end id; a text of any length is one list. Rows
    with one doc_id keep an order by a hash of their text, and equal rows are each written; null
    ids come first. The one shuffle deals the texts by ranges of (doc_id, hash), so a doc_id that
    holds many rows is split too. Other columns are ignored, whatever their names. An empty table
    gives a token file without rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path, out = path or vocabulary(), out or shared_dir(spark)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        encode, part, before = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            flat, at = encode.ids(batch.column(1), end_id)
            starts, before = before + at[:-1], before + len(flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(starts), part, dtype=np.int32)), pa.array(starts), pa.array(np.diff(at)), id_lists(flat, at)],
                names=["doc_id", "part", "local_start", "n_tokens", "ids"],
            )

    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = dealt.mapInArrow(run, f"doc_id {kind}, part int, local_start long, n_tokens long, ids array<int>")
    (
        rows.write.option("compression", "zstd").option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower()).option("parquet.writer.version", "PARQUET_2_0").parquet(out)
    )
    return out


def _placed(rows: DataFrame, path: str) -> DataFrame:
    """Rows of a token file with `start`, the ids of all documents before.

    The totals by part come from two metadata columns; there are as many as the writer had range
    partitions, whatever the corpus, and so they are broadcast.
    """
    totals = rows.sparkSession.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(earlier, F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("local_start"))


def read_tokens(spark: SparkSession, path: str, doc_ids: list | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids; of some documents only, if given.

    Columns that are not used are not read, so positions and lengths alone open no page of ids.
    Chosen documents are looked for in the row groups and pages whose range of doc_ids has them.
    """
    small_batches(spark)
    rows = spark.read.parquet(path)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(doc_ids))
    return _placed(rows, path).select("doc_id", "start", "n_tokens", "ids")
