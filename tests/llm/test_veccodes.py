import hashlib
import math

import numpy as np
import pytest
from folioflow.llm import queries, veccodes
from pyspark.sql import functions as F
from tests.conftest import SMALL


def brute(rows, parts=8, entries=16, rounds=6):
    """{(vec_id, label, vector): (code, error, label_error)} and the digest, in plain Python integers."""
    kept = [(k, lab, [math.floor(4096 * x) for x in v]) for k, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    size = len(kept[0][2]) // parts
    cut = lambda q: [q[i * size : (i + 1) * size] for i in range(parts)]
    books = [[cut(q)[p] for _, _, q in kept[:entries]] for p in range(parts)]

    def near(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in books[p]]
        return min(range(len(d)), key=lambda i: (d[i], i)), min(d)

    for _ in range(rounds):
        mine = [[[] for _ in books[p]] for p in range(parts)]
        for _, _, q in kept:
            for p, x in enumerate(cut(q)):
                mine[p][near(p, x)[0]].append(x)
        books = [[[sum(col) // len(m) for col in zip(*m, strict=True)] if m else c for m, c in zip(mine[p], books[p], strict=True)] for p in range(parts)]
    found = []
    for k, lab, q in kept:
        best = [near(p, x) for p, x in enumerate(cut(q))]
        found.append((k, lab, "".join(f"{i:0{max(2, len(f'{len(books[0]) - 1:x}'))}x}" for i, _ in best), sum(d for _, d in best)))
    total = {}
    for _, lab, _, e in found:
        total[lab] = total.get(lab, 0) + e
    flat = ",".join(str(x) for b in books for c in b for x in c)
    return sorted(((k, lab, c, e, total[lab]) for k, lab, c, e in found), key=repr), hashlib.sha256(flat.encode()).hexdigest()


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def holds(spark, rows, kind="float", **more):
    out, books = veccodes.compress(frame(spark, rows, kind), **more)
    want, digest = brute(rows, **more)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    assert books.digest == digest
    return out, books


def test_whole_table_against_plain_python(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label")
    want, digest = brute([tuple(r) for r in table.collect()])
    rows = queries.op12_vector_codes(spark, SMALL).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in rows) == sorted((k, c, e, t) for k, _, c, e, t in want)
    assert {r.codebooks_sha256 for r in rows} == {digest}


def test_dropped_vectors_ties_repeats_and_null_labels(spark):
    chance = np.random.default_rng(3)
    some = [(i, [float(x) for x in chance.integers(-3, 4, 16) / 4096 + chance.choice([0, 1e-5, -1e-5], 16)], i % 3 if i % 4 else None) for i in range(90)]
    bad = [(1000, None, 1), (1001, [None] + [0.5] * 15, 1), (1002, [float("nan")] + [0.5] * 15, 1), (-5, [float("inf")] + [0.5] * 15, None), (-6, [0.1] * 15 + [float("-inf")], 2)]
    again = [some[5], some[5], (7, some[9][1], 8), (None, some[3][1], None)]
    rows = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for k, v, lab in (*some, *bad, *again)]
    out, _ = holds(spark, rows)
    assert out.count() == len(some) + len(again)


def test_few_rows_negative_floors_and_other_sizes(spark):
    holds(spark, [(9, [-0.00001] * 8, None)])
    holds(spark, [(3, [0.25, -1.5, 0.3, 7.0], 1), (1, [0.0, -0.1, 0.2, 9.0], 1), (2, [5.0, -0.1, 0.0, -9.0], None)], "double", parts=2, entries=2, rounds=3)
    chance = np.random.default_rng(5)
    rows = [(i, [float(x) for x in chance.normal(size=6)], 0) for i in range(600)]
    out, books = holds(spark, rows, "double", parts=3, entries=300, rounds=1)
    assert {len(r.code) for r in out.collect()} == {9}


def test_magnitudes_up_to_the_bound_are_exact(spark):
    chance = np.random.default_rng(8)
    holds(spark, [(i, [float(np.float32(x)) for x in chance.choice([-30000.5, 30000.25, 0.0, 1.0], 64)], i % 2) for i in range(60)])
    out, _ = veccodes.compress(frame(spark, [(1, [1e30] * 64, 1), (2, [-1e30] * 64, 1), (3, [0.0] * 64, 2)], "double"))
    assert {r.vec_id: r.error for r in out.collect()} == {1: 0, 2: 0, 3: 0}


def test_other_lengths_have_no_code(spark):
    out, books = veccodes.compress(frame(spark, [(1, [0.5] * 16, 1), (2, [0.5] * 8, 1), (3, [], 1), (4, [0.25] * 16, None)]))
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in out.collect()}
    assert got[2] == (None, None, 0) and got[3] == (None, None, 0) and got[1][0] == "00" * 8 and got[4][0] == "01" * 8
    out, books = veccodes.compress(frame(spark, [(1, [0.5] * 7, 1)]))
    assert books is None and [tuple(r) for r in out.collect()] == [(1, 1, None, None, None)]


def test_empty_table_and_extra_columns(spark):
    out, books = veccodes.compress(frame(spark, []))
    assert books is None and out.count() == 0
    rows = frame(spark, [(i, [float(i)] * 8, None) for i in range(20)]).withColumns({"q": F.lit(1), "code": F.lit("x"), "_label": F.lit(2)})
    out, books = veccodes.compress(rows)
    assert out.columns == ["vec_id", "label", "code", "error", "label_error"] and out.count() == 20


def test_codes_stand_for_their_entries(spark):
    out, books = veccodes.compress(spark.read.parquet(f"{SMALL}/embeddings.parquet"))
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    for r in out.withColumn("v", veccodes.decode(F.col("code"), books)).collect():
        assert sum((math.floor(4096 * x) - y) ** 2 for x, y in zip(vectors[r.vec_id], r.v, strict=True)) == r.error


@pytest.mark.parametrize("most", [0, 1000])
def test_label_totals_without_a_broadcast(spark, monkeypatch, most):
    monkeypatch.setattr(veccodes, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(veccodes, "HOT_LABEL", most)
    chance = np.random.default_rng(3)
    holds(spark, [(i, [float(np.float32(x)) for x in chance.normal(size=16)], [None, 1, 2, 3][i % 4] if i % 7 else None) for i in range(80)])
