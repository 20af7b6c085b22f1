import re

import numpy as np
from folioflow.llm import neardup, queries
from folioflow.llm.components import components
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets(text, size):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(docs, size, percent):
    own = {k: sets(t, size) for k, t in docs}
    root = {k: k for k in own}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(own)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(own[a] & own[b])
            if both and 100 * both >= percent * len(own[a] | own[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((k, len(own[k]), find(k), find(k) == k) for k in own)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.op1_near_duplicates(spark, SMALL).collect())
    assert got == brute(docs, 3, 85)


def test_groups_of_near_copies_and_odd_rows(spark, odd_docs):
    chance = np.random.default_rng(3)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(120):  # a drifting chain: neighbours are alike, the ends are not
        if i % 2:
            base = [*base]
            base[int(chance.integers(80))] = f"v{i}"
        rows.append((1000 + i, " ".join(base)))
    rows += [(1, "One two"), (2, "one TWO"), (3, ""), (4, None), (5, "one"), (6, "word " * 20_000), (7, "word word word word word")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size, percent in ((3, 85), (5, 80)):
        got = sorted(tuple(r) for r in neardup.near_duplicates(docs, size=size, percent=percent).collect())
        assert got == brute(rows, size, percent)
    kept = neardup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "6", "None"]


def test_estimates_are_close():
    errors = []
    for j in (0.3, 0.8, 0.85, 0.95):
        common = int(2000 * j)
        for seed in range(12):
            h = np.random.default_rng(seed).integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2)
            rest = (2000 - common) // 2
            a, b = np.unique(h[: common + rest]), np.unique(np.concatenate([h[:common], h[common + rest :]]))
            k = neardup.registers([a, b])
            errors.append(neardup.estimate(k[:1], k[1:], np.array([float(len(a))]), np.array([float(len(b))]))[0] - j)
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.2


def test_components_of_a_path_a_star_and_a_ring(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 340)] + [(500 + i, 500 + (i + 1) % 9) for i in range(9)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(300, 340)} == {7} and {got[i] for i in range(500, 509)} == {500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_with_repeated_or_null_ids_count_for_themselves(spark):
    one, two, three, four = (" ".join(f"{c}{i}" for i in range(30)) for c in "abcd")
    rows = [(1, one, "x"), (1, two, "x"), (2, one, "y"), (2, three, "y"), (None, four, "x"), (None, four, "x"), (None, two, "x"), (3, "", "x"), (3, "", "x"), (3, "", "y"), (None, None, "x"), (None, None, "x"), (9, three + " more", "x"), (0, one, "z")]
    got = neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3))
    want = [(0, one, "z"), (1, two, "x"), (2, three, "y"), (None, four, "x"), (3, "", "x"), (3, "", "y"), (None, None, "x")]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_rows_have_numbers_of_their_own(spark):
    kind = "doc_id long, text string"
    plain = spark.createDataFrame([(5, "a"), (7, "b")], kind)
    assert {(r.doc_id, r.at) for r in neardup.numbered(plain, "at").collect()} == {(5, 5), (7, 7)}
    for low, high in ((-3, 90), (1 << 61, (1 << 63) - 1), (-(1 << 63), 4), (-(1 << 63), (1 << 63) - 1)):
        rows = [(low, "a"), (high, "b"), (high, "b"), (high, "c"), (None, "d"), (None, "d"), (0, "e")]
        got = neardup.numbered(spark.createDataFrame(rows, kind), "at").collect()
        assert len({r.at for r in got}) == len(rows) and sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(rows, key=repr)
        if (low, high) != (-(1 << 63), (1 << 63) - 1):
            ids = {low, high, 0}
            assert all(r.at == r.doc_id if r.doc_id in (low, 0) else r.at not in ids for r in got)
    nothing = spark.createDataFrame([(None, "x"), (None, "x")], kind)
    assert len({r.at for r in neardup.numbered(nothing, "at").collect()}) == 2


def test_of_each_group_one_row_stays_whatever_the_ids(spark):
    text = " ".join(f"w{i}" for i in range(200))
    near = text.replace("w150", "x")
    rows = [(4, text, 1), (9, near, 2), (9, "quite another text of its own " * 9, 3), (None, text, 4), (None, near + " more", 5), (2, "alone " * 40, 6), (4, text, 1), (None, None, 7), (None, None, 7), (3, "", 8)]
    got = neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string, row int")).collect()
    assert sorted(r.row for r in got) == [1, 3, 6, 7, 8]
