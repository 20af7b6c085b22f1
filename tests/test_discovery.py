import random
import re
from datetime import date

import pytest
from folioflow.operators import containment, discovery
from folioflow.operators.discovery import Branch, Term
from pyspark.sql import functions as F

DOC = "id int, full string, abstract string"


def words(text):
    return re.findall(r"[^\W_]+", text or "")


def brute(text, term):
    own = words(text)
    low = [w.lower() for w in own]
    for phrase in term.phrases:
        p = words(phrase)
        seen, p = (own, p) if term.cased else (low, [w.lower() for w in p])
        if any(seen[i : i + len(p)] == p for i in range(len(seen) - len(p) + 1)):
            return True
    return False


def test_phrases_against_plain_python(spark):
    chance = random.Random(3)
    vocabulary = ["la", "La", "mg", "II", "slit", "jaw", "É", "x1"]
    glue = [" ", " ", "-", ", ", "_", "\n", "…"]

    def text():
        return None if chance.random() < 0.1 else "".join(chance.choice(vocabulary) + chance.choice(glue) for _ in range(chance.randrange(25)))

    docs = [(i, text(), text()) for i in range(300)]
    terms = [
        Term("full", ("la la", "mg ii")), Term("abstract", ("Slit-Jaw", "x1 É la")), Term("full", ("La",), cased=True), Term("full", ("la LA la",)),
        Term("abstract", ("II II", "nowhere")), Term("full", ("jaw", "jaw slit")), Term("abstract", ("La la",), cased=True),
    ]
    rows = spark.createDataFrame(docs, DOC)
    index = discovery.positions(rows, "id", {"full": F.col("full"), "abstract": F.col("abstract")})
    want = {i: tuple(brute({"full": f, "abstract": a}[t.field], t) for t in terms) for i, f, a in docs}
    for made in (index, discovery.write_index(index, "id", f"{spark.conf.get('spark.sql.warehouse.dir')}/index")):
        found = discovery.matches(made, "id", terms)
        got = {r.id: tuple(r[1:]) for r in found.collect()}
        assert all(got.get(i, (False,) * len(terms)) == w for i, w in want.items()) and all(any(t) for t in got.values())


def test_any_number_of_phrases_costs_one_exchange(spark):
    terms = [Term("a", discovery.LINES), Term("a", discovery.SYNTHESIS), Term("a", discovery.CONTEXT)]
    index = discovery.positions(spark.createDataFrame([(1, "Mg II flare")], "id int, a string"), "id", {"a": F.col("a")})
    plan = discovery.matches(index, "id", terms)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastExchange") == 1


def test_a_written_index_is_read_for_its_words_only(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"w{i % 50:02d} filler") for i in range(500)], "id int, a string")
    made = discovery.write_index(discovery.positions(rows, "id", {"a": F.col("a")}), "id", str(tmp_path / "index"))
    plan = discovery.matches(made, "id", [Term("a", ("w07 filler",))])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*In\(word", plan)
    assert discovery.matches(made, "id", [Term("a", ("w07 filler",))]).count() == 10


CASES = [
    (1, "The Some Region Camera of 2013", "", "astro", "yes"), (2, "the some region  CAMERA", "", "other", "yes"), (3, "Some region with a camera", "", "astro", None),
    (4, "We use SRC and slit-jaw images", "", "astro", "yes"), (5, "We use SRC and slit jaw images", "", "other", None), (6, "the src and Mg II", "", "astro", None), (7, "SRC alone", "", "astro", None),
    (8, "thanks: SRC is a small explorer", "", "other", "yes"),
    (9, "", "Synthetic Mg II in a solar flare", "astro", "yes"), (10, "", "Synthetic Mg II in a solar flare", "other", None), (11, "", "Mg II in a solar flare", "astro", None), (12, "", "radiative-hydrodynamic Fe XII 1349, transition region", "astro", "yes"),
    (13, "Synthetic Mg II in a flare", "Synthetic Mg II", "astro", None), (14, "", "non-LTE near-UV continuum of flares", "astro", "yes"), (15, None, None, None, None), (16, "", "", "other", "yes"), (17, "", "Mg IIb synthetic flare", "astro", None),
]


def test_the_standard_branches(spark):
    docs = spark.createDataFrame([(i, f, a, d) for i, f, a, d, _ in CASES], "id int, full string, abstract string, db string")
    branches = discovery.standard("Some Region Camera", "SRC", ("SRC is a small explorer", "developed and operated by us"), F.col("db") == "astro")
    cites = spark.createDataFrame([(16,), (16,), (99,)], "id int")
    fields = {"full": F.col("full"), "abstract": F.col("abstract")}
    found = discovery.discover(docs, "id", fields, branches, cites, [F.col("id") > 0])
    assert found.columns == docs.columns and sorted(r.id for r in found.collect()) == [c[0] for c in CASES if c[4]]
    index = discovery.positions(docs, "id", fields)
    assert sorted(r.id for r in discovery.discover(docs, "id", fields, branches, cites, [F.col("id") > 4], index=index).collect()) == [c[0] for c in CASES if c[4] and c[0] > 4]


def test_a_range_of_months(spark):
    days = [date(2024, 12, 31), date(2025, 1, 1), date(2025, 12, 31), date(2026, 1, 1), None]
    rows = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r.d for r in rows.where(discovery.months(F.col("d"), "2025-01", "2025-12")).orderBy("d").collect()] == days[1:3]


def pairs(short, texts, least):
    out = set()
    for a, x in short:
        for b, y in texts:
            if x and y and len(set(x) & set(y)) / len(set(x)) >= least:
                out.add((a, b, len(set(x) & set(y)) / len(set(x))))
    return out


@pytest.mark.parametrize("least", [0.6, 0.35, 1.0])
def test_containment_against_all_pairs(spark, least):
    chance = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]

    def draw(n):
        return chance.choices(vocabulary, weights, k=n)

    short = [(i, draw(chance.randrange(0, 30))) for i in range(40)] + [(90, ["only"]), (91, ["w0"]), (92, ["w0", "w0", "w1"])]
    texts = [(i, draw(chance.randrange(0, 60))) for i in range(150)] + [(200, []), (201, None)]
    got = containment.containing(spark.createDataFrame(short, "short int, words array<string>"), spark.createDataFrame(texts, "text int, words array<string>"), least)
    assert {tuple(r) for r in got.collect()} == pairs(short, texts, least) and got.count() > 0


def test_common_words_are_not_looked_up(spark):
    """All texts share ten words with every short one; only the right ones are counted."""
    common = [f"common{i}" for i in range(10)]
    short = spark.createDataFrame([(i, common + [f"own{i}x{k}" for k in range(15)]) for i in range(20)], "short int, words array<string>")
    texts = spark.createDataFrame([(i, common + [f"own{i}x{k}" for k in range(15)] if i < 20 else common + [f"t{i}x{k}" for k in range(9)]) for i in range(400)], "text int, words array<string>")
    held = containment.postings(texts, short)
    chosen = containment.prefixes(short, held, 0.6)
    assert chosen.where("word like 'common%'").count() == 0 and chosen.groupBy("short").count().where("count <> 11").count() == 0
    assert containment.candidates(short, held, 0.6).count() == 20
    assert {(r.short, r.text) for r in containment.containing(short, texts, 0.6).collect()} == {(i, i) for i in range(20)}
    assert containment.containing(short, texts.limit(0), 0.6).count() == 0
