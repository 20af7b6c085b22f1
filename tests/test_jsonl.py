import io
import json
import os
import signal
import tracemalloc

import pytest
from folioflow.sources import jsonl, storage
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

ID = "id int"


def ids(spark, path, **more):
    return sorted(r.id for r in jsonl.read(spark, str(path), ID, **more).collect())


def plain(data):
    """(offset, line, ended) of all lines."""
    out, at = [], 0
    *whole, rest = data.split(b"\n")
    for line in whole:
        out.append((at, line, True))
        at += len(line) + 1
    return out + ([(at, rest, False)] if rest else [])


@settings(max_examples=200, deadline=None)
@given(st.text("aé𝔘\n\r {", max_size=60).map(str.encode), st.integers(1, 70), st.integers(1, 9))
def test_every_line_belongs_to_one_range(data, split, block):
    found = [x for start in range(0, len(data), split) for x in jsonl.lines_of(io.BytesIO(data), start, min(start + split, len(data)), block)]
    assert found == plain(data)


def test_a_long_torn_line_needs_memory_for_itself_only(tmp_path):
    path = tmp_path / "log.jsonl"
    line = b'{"id": 1, "text": "' + "é".encode() * 500 + b'"}\n'
    with path.open("wb") as out:
        for _ in range(64):
            out.write(line * 1000)
        out.write(b'{"id": 2, "text": "' + b"x" * (1 << 20))
    tracemalloc.start()
    n = torn = 0
    with storage.of(str(path))[0].open_input_file(str(path)) as source:
        for start in range(0, path.stat().st_size, 10_000_001):
            for _, value, ended in jsonl.lines_of(source, start, start + 10_000_001):
                n, torn = n + ended, torn + (len(value) if not ended else 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (n, torn) == (64_000, (1 << 20) + 19) and peak < 8 << 20


def test_ranges_pack_short_files_and_split_long_ones(tmp_path):
    for i, size in enumerate((10, 10, 10, 95, 5)):
        (tmp_path / f"{i}.json").write_bytes(b"x" * size)
    (tmp_path / "_hidden").write_bytes(b"x")
    (tmp_path / ".hidden").mkdir()
    (tmp_path / ".hidden" / "a").write_bytes(b"x")
    parts = [[(os.path.basename(p), a, b) for p, a, b in r.ranges] for r in jsonl._Scan(str(tmp_path), 40).partitions()]
    assert parts == [[("0.json", 0, 10), ("1.json", 0, 10), ("2.json", 0, 10)], [("3.json", 0, 40)], [("3.json", 40, 80)], [("3.json", 80, 95), ("4.json", 0, 5)]]


def test_scan_with_edges_inside_characters(spark, tmp_path):
    rows = [{"id": i, "text": "é𝔘ß" * (i % 7) + str(i)} for i in range(300)]
    (tmp_path / "t.jsonl").write_text("\n\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n \t\n")
    for split in (13, 1000, 1 << 20):
        got = jsonl.read(spark, str(tmp_path / "t.jsonl"), "id int, text string", split=split).collect()
        assert sorted((r.id, r.text) for r in got) == [(r["id"], r["text"]) for r in rows]


def test_only_a_torn_tail_is_left_out(spark, tmp_path):
    path = tmp_path / "t.jsonl"
    path.write_text('{"id":1}\n{"id":2}\n{"id":')
    assert ids(spark, path) == [1, 2]
    path.write_text('{"id":1}\n\n{"id":2}')
    assert ids(spark, path) == [1, 2]
    path.write_bytes(b'{"id":1}\n{"id":2, "t": "\xc3')
    assert ids(spark, path) == [1]
    for text, line in (('{"id":1}\n{"id":\n{"id":3}\n', 2), ('{"id":1}\n\n{"id":\n', 3), ('{"id":"x"}\n{"id":', 1)):
        path.write_text(text)
        with pytest.raises(jsonl.TornTable, match=rf"t\.jsonl:{line}: "):
            jsonl.read(spark, str(path), ID)
    path.write_bytes(b'{"id":1}\n{"id":2, "t": "\xc3"}\n')
    with pytest.raises(jsonl.TornTable, match=":2:"):
        jsonl.read(spark, str(path), ID)


def test_append_ends_or_cuts_the_last_line(spark, tmp_path):
    more = spark.createDataFrame([(3,)], ID)
    path = tmp_path / "single.jsonl"
    path.write_text('{"id":1}\n{"id":2}\n{"id":')
    jsonl.append(more, str(path))
    assert path.read_text() == '{"id":1}\n{"id":2}\n{"id":3}\n'
    path.write_text('{"id":1}')
    jsonl.append(more, str(path))
    assert path.read_text() == '{"id":1}\n{"id":3}\n'
    path.write_bytes(b'{"id":1, "t": "' + b"x" * (3 << 20))
    jsonl.append(more, str(path))
    assert path.read_text() == '{"id":3}\n' and [p.name for p in tmp_path.iterdir()] == ["single.jsonl"]

    folder = tmp_path / "log"
    jsonl.append(spark.range(20).select(F.col("id").cast("int").alias("id")).repartition(3), str(folder))
    (folder / "other.jsonl").write_text('{"id":100}\n{"id":10')
    (folder / "ended.jsonl").write_text('{"id":101}')
    jsonl.append(more, str(folder))
    assert (folder / "other.jsonl").read_text() == '{"id":100}\n' and (folder / "ended.jsonl").read_text() == '{"id":101}\n'
    assert ids(spark, folder) == sorted([*range(20), 3, 100, 101])
    jsonl.append(more.limit(0), str(folder))
    assert len(ids(spark, folder)) == 23 and not [p for p in folder.iterdir() if p.name.startswith("_staged")]


class KilledBeforeCommit(jsonl.JsonLines):
    @classmethod
    def name(cls):
        return "killed_lines"

    def writer(self, schema, overwrite):
        class Killed(jsonl._Append):
            def commit(self, messages):
                os.kill(os.getpid(), signal.SIGKILL)

        return Killed(self.options["path"])


def test_a_write_killed_between_tasks_and_commit_leaves_the_log_whole(spark, tmp_path):
    folder = tmp_path / "log"
    jsonl.append(spark.createDataFrame([(1,), (2,)], ID), str(folder))
    spark.dataSource.register(KilledBeforeCommit)
    lines = spark.range(10).select(F.to_json(F.struct(F.col("id").cast("int").alias("id"))).alias("line"))
    with pytest.raises(Exception):  # noqa: B017
        lines.write.format("killed_lines").option("path", str(folder)).mode("append").save()
    assert ids(spark, folder) == [1, 2]
    jsonl.append(spark.createDataFrame([(3,)], ID), str(folder))
    assert ids(spark, folder) == [1, 2, 3]


def test_a_failed_append_leaves_nothing(spark, tmp_path):
    folder = tmp_path / "log"
    jsonl.append(spark.createDataFrame([(1,)], ID), str(folder))
    bad = spark.range(0, 40, 1, 4).select(F.when(F.col("id") == 39, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("id").cast("int")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        jsonl.append(bad, str(folder))
    assert ids(spark, folder) == [1]
    # a task that was still running may have staged a part after the abort; nobody reads it
    assert all(p.name.startswith(("batch-", "_staged-")) for p in folder.iterdir())
    (folder / "_staged-left").mkdir(exist_ok=True)
    assert jsonl.sweep(str(folder), hours=1) == 0 and jsonl.sweep(str(folder), hours=0) > 0
    assert [p.name[:6] for p in folder.iterdir()] == ["batch-"] and ids(spark, folder) == [1]


def test_replacement_is_whole_or_not_at_all(spark, tmp_path):
    path = tmp_path / "queue"
    path.mkdir()
    (path / "old.jsonl").write_text('{"id":7}\n')
    assert ids(spark, path) == [7]
    jsonl.write(spark.createDataFrame([(1,)], ID), str(path))
    assert ids(spark, path) == [1]
    bad = spark.range(0, 40, 1, 4).select(F.when(F.col("id") == 39, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("id").cast("int")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        jsonl.write(bad, str(path))
    assert ids(spark, path) == [1]
    begun = jsonl.read(spark, str(path), ID)
    jsonl.write(begun.select((F.col("id") + 1).alias("id")), str(path))  # a table may be replaced by what is read from it
    assert ids(spark, path) == [2] and [r.id for r in begun.collect()] == [1]  # what began before goes on
    jsonl.append(spark.createDataFrame([(9,)], ID), str(path))
    assert ids(spark, path) == [2, 9]
    for i in range(4):
        jsonl.write(spark.createDataFrame([(i,)], ID), str(path))
    assert ids(spark, path) == [3]
    assert sum(p.name.startswith("_current-") for p in path.iterdir()) == 2


def test_a_failed_pointer_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "queue")
    jsonl.write(spark.createDataFrame([(1,)], ID), path)
    real = storage.of

    class NoMove:
        def __init__(self, system):
            self.system = system

        def __getattr__(self, name):
            return getattr(self.system, name)

        def move(self, *_):
            raise OSError("disk full")

    monkeypatch.setattr(storage, "of", lambda p: (NoMove(real(p)[0]), real(p)[1]))
    with pytest.raises(OSError, match="disk full"):
        jsonl.write(spark.createDataFrame([(2,)], ID), path)
    monkeypatch.undo()
    assert ids(spark, path) == [1]
    assert jsonl.exists(path) and not jsonl.exists(str(tmp_path / "none"))
