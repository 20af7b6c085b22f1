"""Files as tables: discovery, hashes, page texts, and a sink that reports what it did."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

NOT_THERE = (FileNotFoundError, NotADirectoryError)


def name(key: Column) -> Column:
    """The file name that stands for an id: what would lead out of the folder or hide the file is coded."""
    coded = F.replace(F.replace(F.replace(key, F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F")), F.lit("\0"), F.lit("%00"))
    return F.concat(F.regexp_replace(F.regexp_replace(coded, r"\A\.", "%2E"), r"\A_", "%5F"), F.lit(".pdf"))


def _key(path: Column) -> Column:
    """The id that a file's name stands for."""
    coded = F.regexp_extract(path, r"([^/]*)\.[^./]*$", 1)
    for code, plain in (("%5F", "_"), ("%2E", "."), ("%00", "\0"), ("%2F", "/"), ("%25", "%")):
        coded = F.replace(coded, F.lit(code), F.lit(plain))
    return coded


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, id, length, modified) of the PDF files below a folder, or of one file; none is opened.

    A path that is not there, or a single file with another ending, is an error before any work.
    """
    system, root = storage.of(path)
    found = storage.kind(system, root)
    if found == "absent":
        raise FileNotFoundError(f"PDF input does not exist: {path}")
    if found == "file" and not root.lower().endswith(".pdf"):
        raise ValueError(f"input file is not a PDF: {path}")
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][dD][fF]").load(path)
    return rows.select("path", _key(F.col("path")).alias("id"), "length", F.col("modificationTime").alias("modified"))


def jobs(files: DataFrame, limit: int | None = None) -> DataFrame:
    """Files in order of their path's components; a limit counts before anything is resumed."""
    out = files.orderBy(F.split("path", "/"))
    return out if limit is None else out.limit(limit)


def _blocks(path: str) -> Iterator[bytes]:
    system, at = storage.of(path)
    with system.open_input_stream(at) as data:
        while block := data.read(storage.COPY):
            yield block


def _digest(path: str) -> str | None:
    """SHA-256 of a file; None if it is not there."""
    out = hashlib.sha256()
    try:
        for block in _blocks(path):
            out.update(block)
    except NOT_THERE:
        return None
    return out.hexdigest()


def hashed(files: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The rows of `listing` with pdf_sha256, which `known` (path, length, modified, pdf_sha256) may give.

    Only files that `known` lacks, or that have changed since, are opened, and read in blocks.
    """
    digest = F.pandas_udf(lambda paths: paths.map(_digest), "string", F.PandasUDFType.SCALAR).asNondeterministic()
    if known is None:
        return files.withColumn("pdf_sha256", digest("path"))
    same = ["path", "length", "modified"]
    old = known.groupBy(*same).agg(F.max("pdf_sha256").alias("pdf_sha256"))
    new = files.join(old, same, "left_anti").withColumn("pdf_sha256", digest("path"))
    return files.join(old, same).select(*new.columns).unionByName(new)


def contents(files: DataFrame) -> DataFrame:
    """The rows with `content`, but for those whose file is not there (path, ...).

    One file at a time is held in a task. Put filters below this: only the files of its rows are opened.
    """
    names = [*files.columns, "content"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                try:
                    yield pd.DataFrame([[*row, b"".join(_blocks(row.path))]], columns=names)
                except NOT_THERE:
                    continue

    return files.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields) + ", content binary")


def absent(rows: DataFrame, column: str = "target") -> DataFrame:
    """The rows whose file, named in the column, is not there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[[storage.kind(*storage.of(at)) != "file" for at in batch["at"]]]

    missing = rows.select(F.col(column).alias("at")).distinct().mapInPandas(run, "at string")
    return rows.join(missing, F.col(column) == F.col("at"), "left_semi")


def pages(files: DataFrame) -> DataFrame:
    """(id, page, text, error) by an optional extractor library, one file at a time; errors are rows.

    The page table is where tests enter the engine.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pymupdf

        for batch in batches:
            rows = []
            for key, content in zip(batch["id"], batch["content"], strict=True):
                try:
                    with pymupdf.open(stream=content, filetype="pdf") as document:
                        rows += [(key, n, page.get_text(), None) for n, page in enumerate(document, start=1)]
                except Exception as e:  # a broken file is a failed record, not a failed job
                    rows.append((key, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["id", "page", "text", "error"])

    return files.select("id", "content").mapInPandas(run, "id string, page int, text string, error string")


def case_jobs(cases: DataFrame, ids: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Labelled cases: chosen ids first, then the limit."""
    rows = cases if not ids else cases.where(F.col("id").isin(ids))
    rows = rows if limit is None else rows.orderBy("id").limit(limit)
    return rows.withColumn("expected", F.struct(F.col("expected_include").alias("include"), F.col("expected_basis").alias("basis")))


def set_aside(rejected: DataFrame) -> None:
    """Renames files (path, pdf_sha256) beside their place, under a name that discovery passes over."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, digest in zip(batch["path"], batch["pdf_sha256"], strict=True):
                system, at = storage.of(path)
                if storage.kind(system, at) == "file":  # else an earlier try of this task renamed it
                    system.move(at, f"{at.rpartition('.')[0]}.{digest}.rejected")
            yield batch[["path"]]

    rejected.mapInPandas(each, "path string").write.format("noop").mode("overwrite").save()


def save(contents: DataFrame) -> DataFrame:
    """(id, status, category, error): writes (id, target, content) to files of a shared storage.

    Each file is written beside its place and renamed, so a reader or a task that is run again
    never sees half of one. A failure is a transient attempt row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, target, content in zip(batch["id"], batch["target"], batch["content"], strict=True):
                try:
                    storage.put(target, content)
                    rows.append((key, "downloaded", None, None))
                except OSError as e:
                    rows.append((key, "failed", "transient", str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["id", "status", "category", "error"])

    return contents.select("id", "target", "content").mapInPandas(run, "id string, status string, category string, error string")
