import re
import unicodedata

import duckdb
from folioflow.functions import fold
from folioflow.functions import text as T
from folioflow.plans import catalogue
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.conftest import SMALL


def plain(text):
    return sorted(set(re.findall("[a-z]+", unicodedata.normalize("NFKC", text).lower())))


def same(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    words = F.array_sort(T.word_set(fold.fold(F.col("t"))))
    for r in rows.select("t", words.alias("w")).collect():
        assert r.w == plain(r.t), (r.t, r.w, plain(r.t))


def test_every_character_beside_letters(spark):
    points = [p for p in range(0x80, 0x110000) if not 0xD800 <= p <= 0xDFFF and unicodedata.normalize("NFKC", chr(p)) != chr(p)]
    same(spark, [f"a{chr(p)}b {chr(p)}" for p in points] + [f"e{chr(p)}́x" for p in points[:2000]])


def test_letters_with_marks(spark):
    marks = [chr(p) for p in range(0x300, 0x370)] + ["̣", "̧", "᷄", "⃐", "ุ", "ͅ", "゙", "ः"]
    same(spark, [f"x{c}{m}y" for c in fold.LETTERS for m in marks])
    same(spark, [f"{c}{m}{n}y{m}" for c in "aeIiqZ" for m in marks[:60:2] for n in marks[:90:3]])


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text("aeIqzE ﬁﬂﬃſKＡｅ̧̣́̂̇ͅ͏‍éṩİßΣς™Ⅷ𝐀𝒻㎏İ\n$\\", max_size=12), max_size=60))
def test_mixed_texts(spark, texts):
    same(spark, texts)


def test_it_stays_in_the_jvm_and_keeps_nulls(spark):
    rows = spark.createDataFrame([(None,), ("",), ("Ofﬁce ＡＢＣ étude",)], "t string").select(fold.fold(F.col("t")).alias("f"))
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [r.f for r in rows.collect()] == [None, "", f"office abc {fold.COMPOSED}́tude"]


def same_by_pieces(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in rows.select("t", fold.words(F.col("t")).alias("w")).collect():
        assert sorted(r.w) == plain(r.t), (r.t, r.w, plain(r.t))


def test_words_by_pieces(spark):
    points = [p for p in range(0x80, 0x110000) if not 0xD800 <= p <= 0xDFFF and unicodedata.normalize("NFKC", chr(p)) != chr(p)]
    same_by_pieces(spark, [f"Ab{chr(p)}b AB{chr(p)}\nx_{chr(p)}́c 1́d" for p in points] + ["".join(map(chr, points))])
    marks = [chr(p) for p in range(0x300, 0x370)] + ["\u0323", "\u0327", "\u20d0", "\u0e38", "\u0345", "\u3099", "\u0903"]
    same_by_pieces(spark, [" ".join(f"x{c}{m}y {c}{m}{n}z{m}" for m in marks for n in marks[::7]) for c in fold.LETTERS])
    same_by_pieces(spark, ["", " ", "--", "the The THE", "of\ufb01ce of\ufb01ce\x00of\ufb01ce\x7f", "I\u0307 \u0130 H\u0331 h\u0331", "\u0301a \u0301"])


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text("aeIqzE @[`{\x00\x7f-ﬁﬂﬃſKＡｅ̧̣́̂̇ͅ͏‍éṩİßΣς™Ⅷ𝐀𝒻㎏İ\n$\\", max_size=14), max_size=60))
def test_mixed_texts_by_pieces(spark, texts):
    same_by_pieces(spark, texts)


def test_marks_that_are_newer_than_the_jvm(spark):
    same(spark, ["xe\u1dfa\u0301y", "xe\u0301\u1dfay", "xq\u1dfa\u0301y"])
    same_by_pieces(spark, ["xe\u1dfa\u0301y", "xe\u0301\u1dfay", "xq\u1dfa\u0301y"])


def test_a_dotted_capital_with_other_marks(spark):
    texts = [f"x\u0130{m}y" for m in ("", "\u0323", "\u0328", "\u0330", "\u0301", "\u0323\u0301", "\u0301\u0323")]
    same(spark, texts)
    same_by_pieces(spark, texts)


def test_the_queries_make_each_set_once(spark):
    for name in ("compatibility_words", "word_sets"):
        plan = catalogue.QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert sum(len(re.findall(r"\(text#", line)) for line in plan.splitlines() if "Project" in line) == 1, name


def test_rows_without_words_are_those_of_the_sql(spark, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(1, None), (2, ""), (3, "12 --"), (4, "Office the")], "doc_id long, text string").write.parquet(path)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{path}/*.parquet'")
    got = catalogue.QUERIES["compatibility_words"](spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == con.sql(catalogue.ORACLES["compatibility_words"] + " ORDER BY doc_id").fetchall()
