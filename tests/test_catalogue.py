"""Every query with SQL gives the rows that DuckDB gives for that SQL."""

import os

import duckdb
import pytest
from folioflow.operators import classifier, resultlog
from folioflow.plans import catalogue
from folioflow.streaming import resume
from tests.conftest import SMALL


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SMALL}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SMALL)
    want = duck.sql(catalogue.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(repr(tuple(r)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())


class Refusing:
    """Refuses all from the third paper on, as a service without quota does."""

    def __init__(self, after=2):
        self.left, self.inner = after, classifier.TermClassifier()

    def decide(self, pages):
        if not self.left:
            raise classifier.ServiceError("no quota left", "rate_limit", "insufficient_quota")
        self.left -= 1
        return self.inner.decide(pages)


def test_a_run_that_was_stopped_is_resumed(spark, tmp_path):
    inbox, results, checkpoint = (f"{tmp_path}/{k}" for k in ("inbox", "results", "checkpoint"))
    pages = spark.createDataFrame([(f"p{k}", 1, "the text") for k in range(6)] + [("blank", 1, " \n")], "paper string, page int, text string").coalesce(1)
    jobs = [(k, f"p{k}", "a") for k in range(6)] + [(9, "blank", "a"), (10, "nowhere", "a"), (11, "p0", "b"), (12, "p0", "a")]
    spark.createDataFrame(jobs, resume.JOB).coalesce(1).write.parquet(inbox)
    with pytest.raises(Exception, match="no quota left"):
        resume.run_once(spark, inbox, pages, results, checkpoint, Refusing)
    first = spark.read.parquet(results)
    won = {(r.id, r.key) for r in first.where("ok").collect()}
    assert 0 < len({i for i, _ in won}) < 6 and first.where("ok").count() == len(won)
    resume.run_once(spark, inbox, pages, results, checkpoint)
    rows = spark.read.parquet(results)
    assert sorted((r.id, r.key) for r in rows.where("ok").collect()) == sorted([(f"p{k}", "a") for k in range(6)] + [("p0", "b")])
    assert {(r.id, r.errors[0]) for r in rows.where("not ok").collect()} == {("blank", resultlog.NO_TEXT), ("nowhere", resultlog.NO_TEXT)}


def test_entry(spark):
    assert catalogue.entry(spark, SMALL).count() > 0
