"""JSON Lines tables: byte-range scan with a torn tail, append that repairs, atomic replacement.

A table is a folder of files, or a single file that another program writes. A folder may hold
snapshots: data folders, of which the highest numbered pointer `_current-<n>` names the one that
counts. Reading and appending follow the pointer.

The scan is a Python data source. It gives lines as bytes with their places; records are made of
them by Spark's own JSON functions.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from . import storage

#: Bytes of a scan's partition, of one read, and of the lines that go to Spark at once.
SPLIT, BLOCK, BATCH = 64 << 20, 1 << 20, 4 << 20
LINES = "path string, at long, value binary, ended boolean"
POINTER = "_current-"
log = logging.getLogger(__name__)


class TornTable(ValueError):
    """A line that is no record and not a torn last line."""


# places


def current(path: str) -> str:
    """The folder or file that holds the table's records now."""
    system, root = storage.of(path)
    pointer = _pointer(system, root)
    return path if pointer is None else f"{path.rstrip('/')}/{_named(system, root, pointer)}"


def _pointer(system, root: str) -> int | None:
    if storage.kind(system, root) != "folder":
        return None
    names = (f.base_name for f in system.get_file_info(storage.fs.FileSelector(root)))
    return max((int(n[len(POINTER) :]) for n in names if n.startswith(POINTER) and n[len(POINTER) :].isdigit()), default=None)


def _named(system, root: str, pointer: int) -> str:
    with system.open_input_file(f"{root}/{POINTER}{pointer:010d}") as held:
        return held.read().decode()


def exists(path: str) -> bool:
    """Whether the table was ever written."""
    return storage.kind(*storage.of(current(path))) != "absent"


# scan


def lines_of(source, start: int, end: int, block: int = BLOCK) -> Iterator[tuple[int, bytes, bool]]:
    """(offset, line, ended) of the lines of a binary file that begin in [start, end).

    A range that does not begin at 0 looks for its first line from the byte before it, so that
    each line belongs to one range wherever the edges fall, also inside a character. `ended` is
    whether a line feed follows. Memory is needed for one line and one block.
    """
    at = start
    if start:
        at -= 1
        source.seek(at)
        while True:
            data = source.read(block)
            found = data.find(b"\n")
            at += found + 1 if found >= 0 else len(data)
            if not data or at >= end and found < 0:
                return
            if found >= 0:
                break
    source.seek(at)
    held: list[bytes] = []
    while at < end:
        data = source.read(block)
        if not data:
            if held:
                yield at, b"".join(held), False
            return
        *whole, rest = data.split(b"\n")
        for piece in whole:
            line = b"".join([*held, piece])
            held = []
            yield at, line, True
            at += len(line) + 1
            if at >= end:
                return
        if rest:
            held.append(rest)


@dataclass
class _Ranges(InputPartition):
    ranges: list[tuple[str, int, int]]


class _Scan(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[InputPartition]:
        """Ranges of about `split` bytes: pieces of long files, several short files together."""
        out, now, size = [], [], 0
        for path, length in storage.visible(*storage.of(current(self.path))):
            for start in range(0, length, self.split):
                end = min(start + self.split, length)
                if now and size + end - start > self.split:
                    out.append(_Ranges(now))
                    now, size = [], 0
                now.append((path, start, end))
                size += end - start
        return [*out, _Ranges(now)]

    def read(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        system, _ = storage.of(self.path)
        for path, start, end in partition.ranges:
            rows, size = [], 0
            with system.open_input_file(path) as source:
                for row in lines_of(source, start, end):
                    rows.append(row)
                    size += len(row[1]) + 64
                    if size > BATCH:
                        yield _batch(path, rows)
                        rows, size = [], 0
            if rows:
                yield _batch(path, rows)


def _batch(path: str, rows: list[tuple[int, bytes, bool]]) -> pa.RecordBatch:
    at, value, ended = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), pa.array(at, pa.int64()), pa.array(value, pa.binary()), pa.array(ended)], names=["path", "at", "value", "ended"])


# append


@dataclass
class _Part(WriterCommitMessage):
    name: str | None


class _Append(DataSourceArrowWriter):
    """Tasks write parts into a folder that readers pass over; commit shows them all by one rename."""

    def __init__(self, path: str):
        self.system, self.target = storage.of(current(path))
        self.job = uuid.uuid4().hex
        self.single = storage.kind(self.system, self.target) == "file"
        base = self.target.rpartition("/")[0] if self.single else self.target
        self.staged = f"{base}/_staged-{self.job}"

    def __getstate__(self):
        return {**self.__dict__, "system": None}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.system, _ = storage.of(self.target)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        out, name = None, f"part-{uuid.uuid4().hex}.json"
        try:
            for batch in iterator:
                if batch.num_rows:
                    if out is None:
                        self.system.create_dir(self.staged, recursive=True)
                        out = self.system.open_output_stream(f"{self.staged}/{name}")
                    out.write("".join(f"{line}\n" for line in batch.column(0).to_pylist()).encode())
        finally:
            if out is not None:
                out.close()
        return _Part(None if out is None else name)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        wanted = [m.name for m in messages if isinstance(m, _Part) and m.name]
        repair(self.target)
        if not wanted:
            return
        for path, _ in storage.visible(self.system, self.staged):
            if path.rpartition("/")[2] not in wanted:  # of a task that ran twice
                self.system.delete_file(path)
        if self.single:
            storage.extend(self.system, self.target, [f"{self.staged}/{n}" for n in wanted])
            self.system.delete_dir(self.staged)
        else:
            self.system.move(self.staged, f"{self.target}/batch-{self.job}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        if storage.kind(self.system, self.staged) == "folder":
            self.system.delete_dir(self.staged)


def repair(path: str) -> list[str]:
    """Ends a complete last line of each file that lacks its line feed, cuts off a partial one.

    Returns the files that were partial. Of other files only the last byte is read.
    """
    system, root = storage.of(path)
    torn = []
    for name, size in storage.visible(system, root):
        with system.open_input_file(name) as source:
            if not size or source.read_at(1, size - 1) == b"\n":
                continue
            begin = size
            while begin:
                step = min(BLOCK, begin)
                found = source.read_at(step, begin - step).rfind(b"\n")
                if found >= 0:
                    begin = begin - step + found + 1
                    break
                begin -= step
            tail = source.read_at(size - begin, begin)
        try:
            json.loads(tail)
        except ValueError:
            log.warning("%s: a partial last line is cut off", name)
            storage.cut(system, name, begin)
            torn.append(name)
        else:
            storage.extend(system, name, [], b"\n")
    return torn


class JsonLines(DataSource):
    """Options: path; split, the bytes of a partition. Reads LINES, appends a column of lines."""

    @classmethod
    def name(cls) -> str:
        return "json_lines"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> DataSourceReader:
        return _Scan(self.options["path"], int(self.options.get("split", SPLIT)))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a table is replaced by jsonl.write")
        return _Append(self.options["path"])


# tables


def lines(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """(path, at, value, ended): every line as bytes, with its file and offset."""
    spark.dataSource.register(JsonLines)
    return spark.read.format("json_lines").option("path", path).option("split", split).load()


def _parsed(rows: DataFrame, schema: str) -> tuple[DataFrame, Column]:
    """Lines that are not blank with `r`, their record, and the test that it is none."""
    wide = T.StructType([*T._parse_datatype_string(schema).fields, T.StructField("_corrupt", T.StringType())])
    text = F.col("value").cast("string")
    made = rows.where(~text.rlike(r"^[ \t\r]*$")).withColumn("r", F.from_json(text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    return made, F.col("r").isNull() | F.col("r._corrupt").isNotNull() | ~F.is_valid_utf8(text)


def read(spark: SparkSession, path: str, schema: str, split: int = SPLIT) -> DataFrame:
    """Records of the table, with explicit schema. Blank lines are skipped.

    A line that is no record is left out, with a warning, only if it is the last of its file and
    no line feed follows (an append that was cut off); any other one raises TornTable with its
    file and line number. Lines are checked in one pass, in which nothing is kept.
    """
    rows = lines(spark, path, split)
    made, bad = _parsed(rows, schema)
    found = made.where(bad).agg(F.min(F.when(F.col("ended"), F.struct("path", "at"))).alias("wrong"), F.count_if(~F.col("ended")).alias("torn")).first()
    if found.wrong:
        before = rows.where((F.col("path") == found.wrong.path) & (F.col("at") < found.wrong.at)).count()
        raise TornTable(f"{found.wrong.path}:{before + 1}: a line that is no record")
    if found.torn:
        log.warning("%s: %d partial last lines are left out", path, found.torn)
    return made.where(~bad).select("r.*").drop("_corrupt")


def append(df: DataFrame, path: str) -> None:
    """Adds records to a folder, or to a single file that is continued, after repairing its tail.

    Until the commit's rename readers see none of them, and a failed job leaves none. A single
    file is continued by one process, as its bytes have one order.
    """
    df.sparkSession.dataSource.register(JsonLines)
    df.select(F.to_json(F.struct("*")).alias("line")).write.format("json_lines").option("path", path).mode("append").save()


def write(df: DataFrame, path: str) -> None:
    """Replaces the table: a new data folder, then a new pointer that readers follow from then on.

    Nothing is overwritten, so a failure at any point leaves the old table. The replaced data stay
    for readers that began before; those replaced by earlier calls are deleted.
    """
    system, root = storage.of(path)
    if storage.kind(system, root) == "file":
        raise FileExistsError(f"{path} is a single file; it can be continued, not replaced")
    old = _pointer(system, root)
    name = f"_data-{uuid.uuid4().hex}"
    df.write.json(f"{path.rstrip('/')}/{name}")
    number = 0 if old is None else old + 1
    part = f"{root}/_pointer-{name}"
    with system.open_output_stream(part) as out:
        out.write(name.encode())
    system.move(part, f"{root}/{POINTER}{number:010d}")
    for past in range(number - 2, -1, -1):
        try:
            stale = _named(system, root, past)
        except OSError:
            break  # this one and those before it are gone
        if storage.kind(system, f"{root}/{stale}") == "folder":
            system.delete_dir(f"{root}/{stale}")
        system.delete_file(f"{root}/{POINTER}{past:010d}")


def sweep(path: str, hours: float = 24) -> int:
    """Deletes what appends left behind that were killed at least so long ago; their number."""
    system, root = storage.of(current(path))
    before = time.time() - 3600 * hours
    found = system.get_file_info(storage.fs.FileSelector(root))
    old = [f.path for f in found if f.base_name.startswith("_staged-") and f.mtime.timestamp() <= before]
    for folder in old:
        system.delete_dir(folder)
    return len(old)


def next_seq(log: DataFrame) -> int:
    """The append position after the last record of a log."""
    return (log.agg(F.max("seq")).first()[0] or 0) + 1


def library(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of a text file of ids between white space."""
    return spark.read.text(path).select(F.explode(F.split("value", r"\s+")).alias("id")).where("id != ''").distinct()


def decode_links(records: DataFrame, column: str = "links_data") -> DataFrame:
    """Links that arrive as JSON strings become structs; a null list becomes an empty one."""
    link = "access string, type string, url string"
    return records.withColumn(column, F.coalesce(F.transform(column, lambda x: F.from_json(x, link)), F.array().cast(f"array<struct<{link.replace(' string', ':string')}>>")))
