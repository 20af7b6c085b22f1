import re
import zlib
from collections import Counter

import numpy as np
import pytest
from folioflow.llm import boosting, quality_rules, queries, ranking
from folioflow.llm.docstats import FEATURES, statistics
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(wins)
    hit = {i + k for i, w in enumerate(wins) if seen[w] > 1 for k in range(3)}
    lines, before, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in before
            before.add(x)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_base_counts_match_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op6_quality_rules(spark, d).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert rows.keys() == docs.keys()
    for k, text in docs.items():
        want = brute(text)
        assert (rows[k].n_words, rows[k].word_chars, rows[k].n_symbols, rows[k].n_dup_lines, rows[k].n_repeat_words) == want
        assert rows[k].base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (rows[k].base_failed and rows[k].kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    right = [rows[k].kept == (v == 1) for k, v in labels.items() if not rows[k].base_failed]
    assert np.mean(right) > 0.97


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    rows = queries.op2_quality_classifier(spark, d).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for _, y, p in held]) > 0.95
    good, bad = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.98


def test_held_out_labels_are_not_used(spark):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(ranking.train(docs, labels).weights, ranking.train(docs, turned).weights)


def test_trees_keep_their_direction_and_match_a_walk():
    chance = np.random.default_rng(1)
    x = chance.normal(size=(600, 3))
    y = ((x[:, 0] + 0.5 * chance.normal(size=600) < 0) & (x[:, 1] > -1)).astype(float)
    m = boosting.fit(x, y, monotone={0: -1})
    grid = np.repeat(x[:50], 40, axis=0)
    grid[:, 0] = np.tile(np.linspace(-3, 3, 40), 50)
    assert (np.diff(m.margin(grid).reshape(50, 40), axis=1) <= 1e-12).all()
    assert np.mean((m.score(x) > 0.5) == y) > 0.85

    def walk(row):
        total = m.start
        for node in m.roots:
            while m.feature[node] >= 0:
                node = m.left[node] if row[m.feature[node]] <= m.threshold[node] else m.right[node]
            total += m.value[node]
        return total

    assert np.allclose(m.margin(x[:50]), [walk(r) for r in x[:50]])


def test_verdicts_and_scores_against_plain_versions(spark):
    """The whole result of both queries, text by text: trees walked, strengths summed."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rules, order, texts = quality_rules.train(docs, labels), ranking.train(docs, labels), {r.doc_id: r.text for r in docs.collect()}

    def by_trees(x):
        total = rules.start
        for node in rules.roots:
            while rules.feature[node] >= 0:
                node = rules.left[node] if x[rules.feature[node]] <= rules.threshold[node] else rules.right[node]
            total += rules.value[node]
        return 1 / (1 + np.exp(-total))

    def by_strength(x):
        z = [min(8, max(-8, (v - c) / s)) for v, c, s in zip(x, order.centre, order.scale, strict=True)]
        terms = z + [max(0, v - k) for knots in order.knots for v, k in zip(z, knots, strict=True)]
        return 1 / (1 + np.exp(-(sum(t * w for t, w in zip(terms, order.weights, strict=True)) - order.cut) / order.width))

    found = queries.op6_quality_rules(spark, SMALL)
    assert found.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    for r in found.collect():
        want = by_trees(statistics(texts[r.doc_id])[1])
        assert abs(r.score - want) < 1e-9 and r.kept == (not r.base_failed and want >= 0.5)
    for r in queries.op2_quality_classifier(spark, SMALL).collect():
        want = by_strength(statistics(texts[r.doc_id])[1])
        assert abs(r.score - want) < 1e-6 and r.predicted == (r.score >= 0.5)


def test_names_of_the_results(spark):
    rows = spark.createDataFrame([(1, "a b", "s", 1.0, True)], "doc_id long, text string, features string, score double, kept boolean")
    model = quality_rules.train(rows, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality_rules.apply_rules(rows, model, "doc_id", "features").columns[:2] == ["doc_id", "features"]
    with pytest.raises(ValueError, match="score"):
        quality_rules.apply_rules(rows, model, "score")
    assert quality_rules.keep_good(rows, model).count() == 0


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (None, 1, 0), (4, None, 0), (4, 0, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality_rules.train(odd_docs, labels)
    rows = quality_rules.apply_rules(odd_docs, model, "doc_id").collect()
    assert len(rows) == odd_docs.count()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (2, 3, 6))
    ranked = ranking.classify(odd_docs, ranking.train(odd_docs, labels)).collect()
    assert len(ranked) == odd_docs.count() and all(0 <= r.score <= 1 for r in ranked)
    none = labels.limit(0)
    assert quality_rules.apply_rules(no_docs, quality_rules.train(no_docs, none), "doc_id").count() == 0
    assert ranking.classify(no_docs, ranking.train(no_docs, none)).count() == 0
    assert quality_rules.keep_good(odd_docs, model).columns == odd_docs.columns
    assert len(FEATURES) == 12
