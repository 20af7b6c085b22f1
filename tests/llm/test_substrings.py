import hashlib
import re

from folioflow.llm import queries, substrings
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, size):
    first, out = {}, []
    split = {k: WORD.findall(t or "") for k, t in docs}
    for k in sorted(split):
        w = split[k]
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), (k, i))
    for k, w in sorted(split.items()):
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] != (k, i):
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.op8_substring_dedup(spark, SMALL).collect())
    assert got == brute(docs, 20) and sum(x[2] for x in got)


def test_small_windows_and_odd_rows(spark, odd_docs, no_docs):
    rows = [(5, "a b c d e f g h i j k l"), (2, "x y c d e f g h z"), (9, "q q q q q q q q q q q q q"), (7, "q q q q q q q q"), (1, None), (3, ""), (4, "c d e"), (8, "g h i j k l m n o"), (6, "a b c d e f g h i j k l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in substrings.without_repeats(docs, window=6, base=2).collect()]
    assert sorted(got) == brute(rows, 6)
    got = substrings.without_repeats(odd_docs).collect()
    assert len(got) == odd_docs.count() and {r.n_removed for r in got if r.doc_id == 4} == {29_999}
    assert substrings.without_repeats(no_docs).count() == 0


def test_each_level_leaves_out_what_is_repeated_at_half_its_length_only(spark, monkeypatch):
    assert substrings.levels(20, 5) == [5, 10] and substrings.levels(6, 2) == [2, 4]
    words = [[f"{k}{i}" for i in range(40)] for k in "abc"]
    words[1][3:11] = words[0][3:11]  # eight shared words: four runs of five, none of ten
    words[2][9:24] = words[0][20:35]  # fifteen shared words: six runs of ten, no window
    rows = [(k, " ".join(w)) for k, w in enumerate(words)]
    met, whole = [], substrings.repeated
    monkeypatch.setattr(substrings, "repeated", lambda level: met.append(level.count()) or whole(level))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.without_repeats(docs).collect()
    # the level of ten words looks only at documents whose windows have a repeated run of five
    alive = {r.key for r in whole(substrings.first_level(docs.withColumn("key", docs.doc_id), 20, 5)).collect()}
    assert {r.n_removed for r in got} == {0} and met == [3, len(alive)] and 0 < len(alive) < 4
    alone = substrings.without_repeats(docs.limit(1)).collect()
    assert [(r.n_words, r.n_removed) for r in alone] == [(40, 0)] and met[2:] == [1]  # nothing lives, so there is no second level
    for window, base in ((20, 5), (20, 3), (13, 6), (16, 2), (9, 1)):
        texts = [(k, " ".join(w[:30])) for k, w in enumerate([*words, words[0][10:] + words[1]])]
        got = substrings.without_repeats(spark.createDataFrame(texts, "doc_id long, text string"), window=window, base=base).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in got) == brute(texts, window)


def test_columns_with_names_of_the_results(spark):
    rows = spark.createDataFrame([(1, "a b", 1, 2, "k", 3)], "doc_id long, text string, n_words int, n_removed int, key string, starts int")
    assert [tuple(r) for r in substrings.without_repeats(rows).collect()] == [(1, 2, 0, "a b")]
