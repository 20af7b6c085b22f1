import hashlib
import re

import pytest
from folioflow.llm import fim, queries
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SMALL

PLAIN_MARKS = ("<P>", "<S>", "<M>")


def brute(doc_id, text, recipe=fim.Recipe()):
    """(n, form, prefix, middle, output) by the rules in plain words."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"{recipe.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in (recipe.prefix, recipe.suffix, recipe.middle)) or h[2] % 100 >= recipe.rate:
        return n, "plain", None, None, text
    if h[3] % 100 < recipe.spm:
        return n, "spm", len(pre), len(mid), recipe.suffix + suf + recipe.prefix + pre + recipe.middle + mid
    return n, "psm", len(pre), len(mid), recipe.prefix + pre + recipe.suffix + suf + recipe.middle + mid


def arranged(spark, rows, recipe=fim.Recipe()):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = fim.arrange(docs, recipe)
    return [(r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in out.select("doc_id", "text", "fim.*", fim.restore(out.fim.output, out.fim.form, recipe).alias("back")).collect()]


def holds(spark, rows, recipe=fim.Recipe()):
    got = sorted(arranged(spark, rows, recipe), key=repr)
    want = sorted(((k, t, *brute(k, t, recipe), t or "") for k, t in rows), key=repr)
    assert got == want
    return got


def test_whole_table_against_plain_python(spark):
    d = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = queries.op11_fill_in_middle(spark, d).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, form, p, m, out = brute(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, p, m, sha(out), sha(docs[r.doc_id]))


TEXTS = ["", None, "\n", "\n\n\n", "a", "a\n", "a\nb", "\r\n x\r", "é𝔘\nß\n", "<P>", "x<S>y", "<<M", "<\n<P\nS>\nM>", "<P\n>", "plain <m> text\nmore", "x" * 70_000 + "\n" + "y", "\n" * 30_000, "\\E.*$1\n\\1", "\u2028a\u0085b\x0bc\x0c\n"]


def test_odd_texts(spark):
    got = holds(spark, [(i, t) for t in TEXTS for i in range(12)] + [(None, "a\nb"), (None, "a\nb"), (1, "a\nb"), (1, "a\nb")])
    assert {f for _, t, _, f, *_ in got if t in ("<P>", "x<S>y", "", None)} == {"plain"}
    assert {"psm", "spm"} == {f for _, t, _, f, *_ in got if t == "<\n<P\nS>\nM>"}


@pytest.mark.parametrize("recipe", [fim.Recipe(seed=0, rate=0), fim.Recipe(rate=40, spm=100), fim.Recipe(seed=123, rate=70, spm=0, prefix="[(pre)]", suffix="[(suf)]", middle="[(mid)]")])
def test_other_recipes(spark, recipe):
    got = holds(spark, [(i, t) for t in (*TEXTS, "[(pre)]", "a [(\n(mid)]") for i in range(8)], recipe)
    assert len({f for _, _, _, f, *_ in got}) <= 2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 10**12), st.text("<PSM>\n ab\u00e9", max_size=30)), max_size=40))
def test_every_arrangement_is_taken_apart(spark, rows):
    holds(spark, rows)


def test_clashing_names_and_empty_table(spark, odd_docs, no_docs):
    rows = odd_docs.withColumnRenamed("lang", "_text").withColumnRenamed("source", "_Units").withColumn("fim", odd_docs.score)
    out = fim.arrange(rows)
    assert out.columns == [*(c for c in rows.columns if c != "fim"), "fim"] and out.count() == odd_docs.count()
    assert sorted(map(repr, out.drop("fim").collect())) == sorted(map(repr, rows.drop("fim").collect()))
    assert fim.arrange(no_docs).count() == 0


def test_no_python_and_no_shuffle(spark):
    plan = queries.op11_fill_in_middle(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Pandas" not in plan
    assert plan.count("regexp_extract_all") == 1
