import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from folioflow.llm import langid, queries
from pyspark.sql import functions as F
from tests.conftest import SMALL


def plain_grams(text):
    text = (text or "").lower()
    kind = lambda c: unicodedata.category(c)[0]
    found = Counter()
    if any(kind(c) == "L" for c in text):
        for w in "".join(c if kind(c) in "LM" else " " for c in text).split(" "):
            if w:
                padded = f" {w} "
                found.update(w)
                found.update(padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1))
    return found


def number(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def top(found):
    return sorted(found, key=lambda g: (-found[g], number(g)))[:400]


def held(k):
    return k is not None and zlib.crc32(str(k).encode()) % 4 == 2


def brute(docs):
    """{doc_id: (held out, language, score)} from rows (doc_id, text, lang)."""
    learnt = {}
    for k, text, lang in docs:
        if not held(k) and lang is not None:
            learnt.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {lang: {g: i for i, g in enumerate(top(n))} for lang, n in learnt.items() if n}
    out = {}
    for k, text, _ in docs:
        mine = top(plain_grams(text))
        far = sorted((sum(abs(p[g] - i) if g in p else 400 for i, g in enumerate(mine)), lang) for lang, p in profiles.items())
        second = far[1][0] if len(far) > 1 else 400 * len(mine)
        pred = (far[0][1], second / (far[0][0] + second) if second else 0.5) if mine and far else ("und", 0.0)
        out[k] = (held(k), *pred)
    return out


def test_whole_table_against_plain_python(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = brute(docs)
    rows = queries.op13_language_id(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.held_out, r.lang_pred) == want[r.doc_id][:2] and r.score == pytest.approx(want[r.doc_id][2])


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = [r for r in queries.op13_language_id(spark, d).collect() if r.held_out]
    assert len(rows) > 200 and np.mean([r.lang_pred == lang[r.doc_id] for r in rows]) > 0.995
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_languages_are_not_used(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = langid.held_out(F.col("doc_id"))
    a, b = langid.train(docs), langid.train(docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))))
    assert a.names == b.names and np.array_equal(a.keys, b.keys) and np.array_equal(a.ranks, b.ranks)


def test_grams_in_blocks(monkeypatch):
    chance = random.Random(4)
    monkeypatch.setattr(langid, "BLOCK", 7)
    for _ in range(300):
        text = "".join(chance.choices("abAÉñß 𝔘1-\n\u0301क्ष", k=chance.randrange(60)))
        keys, count = langid.grams(text)
        assert dict(zip(keys.tolist(), count.tolist(), strict=True)) == {number(g): n for g, n in plain_grams(text).items()}
        assert (np.diff(keys) > 0).all()


def test_counts_are_handed_on_early(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    all_at_once = langid.train(docs)
    monkeypatch.setattr(langid, "HELD", 500)
    b = langid.train(docs)
    assert np.array_equal(all_at_once.keys, b.keys) and np.array_equal(all_at_once.ranks, b.ranks)


def test_odd_rows_and_clashing_names(spark, odd_docs, no_docs):
    rows = odd_docs.withColumn("held_out", F.lit("x")).withColumn("lang_pred", F.lit(1)).withColumn("gram", F.lit(1))
    got = langid.identify(rows, langid.train(rows)).collect()
    want = brute([(r.doc_id, r.text, r.lang) for r in odd_docs.collect()])
    assert len(got) == odd_docs.count()
    for r in got:
        assert (r.held_out, r.lang_pred) == want[r.doc_id][:2] and r.score == pytest.approx(want[r.doc_id][2])
    assert {r.doc_id: r.lang_pred for r in got}[2] == "und" and {r.doc_id: r.score for r in got}[6] == 0
    assert langid.identify(no_docs, langid.train(no_docs)).count() == 0
    nothing = langid.identify(odd_docs, langid.train(no_docs)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_ties_go_by_name_and_one_language_is_enough(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    same = spark.createDataFrame([(ids[0], "abc abd", "zz"), (ids[1], "abc abd", "aa"), (ids[2], "123", "mm"), (ids[3], "qqq", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(same, langid.train(same)).collect()}
    assert got[ids[0]] == got[ids[1]] == ("aa", 0.5) and got[ids[2]] == ("und", 0.0) and got[ids[3]] == ("aa", 0.5)
    one = langid.identify(same, langid.train(same.where("lang = 'zz'"))).collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in one}[ids[0]] == ("zz", 1.0)
