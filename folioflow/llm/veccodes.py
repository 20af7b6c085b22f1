"""Vector code compression: product quantisation with integer codebooks.

A vector's components become integers and the vector is cut into equal parts. Each part position
has a codebook, a short list of typical parts; a vector's code names the nearest entry of each of
its parts. A round assigns all parts by exact integer arithmetic (|x|^2 - 2xc + |c|^2 as int64
matrix products, first least entry), adds the parts of each entry up within the task, and merges
these sums by one grouped shuffle of at most parts x entries x (length + 1) rows a task. Only
those totals, whose number does not depend on the rows, come to the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded, materialise, small_batches

#: Rows of one label from which on its total is broadcast instead of shuffled to them.
HOT_LABEL = 1_000_000


@dataclass(frozen=True)
class Codebooks:
    """entries: int64 of shape (parts, entries, length of a part)."""

    entries: np.ndarray

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def digits_each(entries: int) -> int:
    """Hexadecimal digits of an index in a code: two, more for codebooks of over 256 entries."""
    return max(2, len(f"{entries - 1:x}"))


def largest(length: int) -> int:
    """Components beyond this magnitude are held to it, so that squared distances fit in a long."""
    return math.isqrt((1 << 62) // max(1, length)) // 2


def usable(vector: Column) -> Column:
    """A vector without null or non-finite components."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


def quantised(vector: Column, scale: int = 4096) -> Column:
    """floor(scale * component) of each; `largest` bounds it."""
    most = F.greatest(F.lit(1), F.size(vector))
    bound = F.floor(F.sqrt(F.lit(float(1 << 62)) / most) / 2) - 1
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, -bound.cast("double")), bound.cast("double"))).cast("int"))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.int64).reshape(len(column), length)


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, squared distances), each (rows, parts), of the nearest entries; ties to the first."""
    parts, _, length = books.shape
    cut = x.reshape(len(x), parts, length).transpose(1, 0, 2)
    d = (cut * cut).sum(axis=2)[:, :, None] - 2 * np.matmul(cut, books.transpose(0, 2, 1)) + (books * books).sum(axis=2)[:, None, :]
    best = d.argmin(axis=2)
    return best.T, np.take_along_axis(d, best[:, :, None], axis=2)[:, :, 0].T


def entry_sums(x: np.ndarray, books: np.ndarray) -> np.ndarray:
    """(parts, entries, length + 1): sums of the parts of each entry, and in the last place their number."""
    parts, entries, length = books.shape
    best, _ = nearest(x, books)
    cut = np.concatenate([x.reshape(len(x), parts, length), np.ones((len(x), parts, 1), dtype=np.int64)], axis=2)
    mine = (best.T[:, None, :] == np.arange(entries)[None, :, None]).astype(np.int64)
    return np.matmul(mine, cut.transpose(1, 0, 2))


def _totals(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """entry_sums of all rows: summed in each task, then by (part, entry, position) in Spark."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        total = np.zeros((*books.shape[:2], books.shape[2] + 1), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                total += entry_sums(_matrix(batch.column(0), books.shape[0] * books.shape[2]), books)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total.reshape(-1)[at])], names=["place", "amount"])

    summed = rows.select("q").mapInArrow(run, "place int, amount long").groupBy("place").agg(F.sum("amount").alias("amount")).collect()
    shared.unpersist()
    total = np.zeros(books.shape[0] * books.shape[1] * (books.shape[2] + 1), dtype=np.int64)
    for r in summed:
        total[r.place] = r.amount
    return total.reshape(*books.shape[:2], -1)


def prepared(vectors: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", scale: int = 4096) -> DataFrame:
    """(vec_id, label, q): the rows with usable vectors, their components as integers; written once."""
    v = F.col(vector_column)
    kept = vectors.where(usable(v)).select(F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), quantised(v, scale).alias("q"))
    return materialise(kept)


def fit(rows: DataFrame, *, parts: int = 8, entries: int = 16, rounds: int = 6) -> Codebooks | None:
    """Codebooks from rows of `prepared`, or None if no row can be coded.

    They start as the parts of the rows with the least ids (equal ids by their vectors, null ids
    last). The first of them tells how long vectors are; other lengths take no part. With fewer
    rows than entries, there are as many entries as rows. Unused entries stay as they are.
    """
    order = [F.col("vec_id").asc_nulls_last(), F.col("q")]
    least = rows.orderBy(*order).limit(entries).select("q").collect()
    length = len(least[0].q) if least else 0
    if not length or length % parts:
        return None
    same = rows.where(F.size("q") == length)
    if any(len(r.q) != length for r in least):
        least = same.orderBy(*order).limit(entries).select("q").collect()
    books = np.asarray([r.q for r in least], dtype=np.int64).reshape(len(least), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        total = _totals(same, books)
        count = total[:, :, -1:]
        books = np.where(count > 0, total[:, :, :-1] // np.maximum(count, 1), books)
    return Codebooks(books)


def encode(rows: DataFrame, books: Codebooks | None) -> DataFrame:
    """(vec_id, label, code, error) of rows of `prepared`: two hexadecimal digits a part.

    A vector whose length does not fit the codebooks has a null code and error.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    if books is None:
        return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    shared = rows.sparkSession.sparkContext.broadcast(books.entries)
    parts, entries, part = books.entries.shape
    width, length = digits_each(entries), parts * part
    digits = np.array([f"{i:0{width}x}" for i in range(entries)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            fits = vectors.value_lengths().to_numpy(zero_copy_only=False) == length
            code, error = np.full(len(fits), None, dtype=object), np.zeros(len(fits), dtype=np.int64)
            if fits.any():
                best, distance = nearest(_matrix(vectors.filter(pa.array(fits)), length), shared.value)
                code[fits] = ["".join(row) for row in digits[best].tolist()]
                error[fits] = distance.sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error, mask=~fits)], names=["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "q").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds `label_error`, the error summed over equal labels, null labels together.

    Totals are partial aggregates. They are broadcast if they were counted and are few; else those
    of labels with many rows are, whose number is bounded by the rows over HOT_LABEL, and the rest
    is joined by label. A total over 2^63-1 is null.
    """
    totals = materialise(coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"), F.count("*").alias("_rows")))
    same, found = coded["label"].eqNullSafe(F.col("_label")), totals.select("_label", "label_error")
    if totals.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return coded.join(F.broadcast(found), same, "left").drop("_label")
    hot = bounded(found.join(totals.where(F.col("_rows") > HOT_LABEL).select(F.col("_label").alias("_hot")), F.col("_label").eqNullSafe(F.col("_hot")), "left_semi"))
    cold = coded.join(hot, same, "left_anti")
    return coded.join(hot, same, "inner").unionByName(cold.join(found, same, "left"), allowMissingColumns=False).drop("_label")


def compress(vectors: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, Codebooks | None]:
    """((vec_id, label, code, error, label_error), codebooks); see `fit` and `encode`.

    Rows whose vector is null or holds null or non-finite components are dropped; all others
    stay, repeated ids and rows included. Other columns are left out. Components beyond `largest`
    (some 32,768 before scaling, at 64 components) are held to it. An empty table has no codebooks.
    """
    small_batches(vectors.sparkSession)
    rows = prepared(vectors, id_column=id_column, vector_column=vector_column, label_column=label_column, scale=scale)
    books = fit(rows, parts=parts, entries=entries, rounds=rounds)
    return with_label_error(materialise(encode(rows, books))), books


def decode(code: Column, books: Codebooks) -> Column:
    """The integer vector that a code stands for, its entries one after the other."""
    table = F.lit(books.entries.tolist())
    width = digits_each(books.entries.shape[1])
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(books.entries.shape[0] - 1)), lambda p: F.get(F.get(table, p), F.conv(F.substring(code, p * width + 1, F.lit(width)), 16, 10).cast("int"))))
