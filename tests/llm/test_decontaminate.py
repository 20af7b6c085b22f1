import hashlib
import re

from folioflow.llm import decontaminate, queries
from tests.conftest import SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(None if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if found := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    names |= found
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names - {None})).encode()).hexdigest(), bool(hit)))
    return out


def rows(df):
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()]


def test_query_against_brute_force(spark):
    d = SMALL
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()
    want = sorted(brute(docs, items))
    assert sorted(rows(queries.op3_decontamination(spark, d))) == want
    assert any(x[5] for x in want)


def test_odd_rows_and_short_items(spark, odd_docs, no_docs):
    more = spark.createDataFrame([(7, "Ünïcode one TWO three four"), (8, "one two three four five six seven eight nine ten eleven twelve"), (9, "x one two x")], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(more)
    items = [(1, "one two"), (2, "THREE four five six seven eight nine ten eleven twelve"), (3, None), (4, ""), (5, "one two"), (6, "word word word"), (None, "alpha beta")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, bench).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()], items)
    assert all(len(r.items) == r.n_items - (r.doc_id == 1) for r in got)  # the item without an id hits, but has no name
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got) == sorted((str(x[0]), *x[1:4], x[5]) for x in want)
    kept = decontaminate.remove_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "5", "6", "None"]
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert decontaminate.remove_contaminated(odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_runs_are_hashes_of_their_words(spark):
    df = spark.createDataFrame([(list("abcdefghijkl"),), (list("xabcdefghijk"),), (list("ab"),)], "h array<string>")
    for size in (1, 2, 3, 5, 7, 10):
        got = [r[0] for r in decontaminate.with_runs(df, "h", size, "f").select("f").collect()]
        assert [len(x) for x in got] == [max(0, 12 - size + 1)] * 2 + [max(0, 2 - size + 1)]
        assert got[0][: 12 - size] == got[1][1:] and len(set(got[0])) == len(got[0])
