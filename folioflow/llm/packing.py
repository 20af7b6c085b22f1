"""Packing by power-of-two decomposition.

A document of n ids is cut into as many pieces of the full sequence length as fit, and the rest
into pieces of the lengths that its binary digits name, longest first. Pieces of one length
form one bucket, and a batch taken from a bucket needs no padding; every piece is a sequence of
its own, so no sequence holds ids of two documents. There is no shuffle: a document's pieces
depend on that document alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .tokens import crc32, encoder, id_lists, list_crc32, vocabulary

SEQUENCE, END_ID = 2048, 1


def piece_lengths(n: int, sequence: int = SEQUENCE) -> list[int]:
    full, rest = divmod(n, sequence)
    return [sequence] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, *, path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID, id_column: str = "doc_id", text_column: str = "text", digest: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset (always 0).

    With `digest` ids_crc32, the CRC-32 of the ids as little-endian unsigned 32-bit numbers, stands
    in the place of ids. `sequence` must be a power of two. A null or empty text has only the end
    id: one piece of length 1; a text of any length is cut like all others. Repeated rows and
    repeated or null ids are packed row by row. sequence_id holds the bucket (log2 of the length)
    in its top byte, then the input partition and a count, so a bucket is a contiguous range of ids
    and a rerun of a lost task gives the same ids. Other columns are ignored, whatever their names.
    An empty table gives no rows.
    """
    if sequence & (sequence - 1) or sequence < 1:
        raise ValueError("sequence must be a power of two")
    small_batches(docs.sparkSession)
    path = path or vocabulary()
    kind = docs.schema[id_column].dataType.simpleString()
    content = "ids_crc32" if digest else "ids"

    def run(batches):
        encode, part, count = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            flat, at = encode.ids(batch.column(1), end_id)
            tokens = np.diff(at)
            lengths = [piece_lengths(n, sequence) for n in tokens.tolist()]
            row = np.repeat(np.arange(len(lengths)), [len(x) for x in lengths])
            length = np.asarray([x for of_doc in lengths for x in of_doc], dtype=np.int64)
            # the pieces follow each other as the ids do
            begin = np.concatenate([[0], np.cumsum(length)])
            bucket = np.frexp(length)[1].astype(np.int64) - 1
            number = bucket << 56 | part << 36 | np.arange(count, count + len(length))
            count += len(length)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(begin[:-1] - at[row]), pa.array(length), (crc32 if digest else id_lists)(flat, begin), pa.array(tokens[row]), pa.array(number), pa.array(np.zeros(len(length), dtype=np.int64))],
                names=["doc_id", "start", "length", content, "doc_tokens", "sequence_id", "offset"],
            )

    schema = f"doc_id {kind}, start long, length long, {content} {'long' if digest else 'array<int>'}, doc_tokens long, sequence_id long, offset long"
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, schema)


def with_crc32(rows: DataFrame) -> DataFrame:
    """The rows with ids_crc32, the CRC-32 of the ids as little-endian unsigned 32-bit numbers, for ids."""
    keep = [c for c in rows.columns if c != "ids"]

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), list_crc32(batch.column("ids"))], names=[*keep, "ids_crc32"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "ids")
    return rows.mapInArrow(run, f"{schema}, ids_crc32 long")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Writes the pieces with one folder for each length."""
    pieces.write.partitionBy("length").parquet(path)
