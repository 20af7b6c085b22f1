"""Boolean discovery over a corpus by a positional index of its words.

The index has a row for each word of a field with its position. A phrase is found where its words
stand at adjacent positions: each occurrence of a word of the query votes for the place at which
its phrase would begin, and a place with as many votes as the phrase has words is a match. So all
phrases of all branches cost one pass over the index and one exchange of the words that the query
names, whatever their number. The index is made in passing or written once for many queries.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What the standard query looks for beside the instrument's own names.
CHANNELS = ("slit-jaw", "slit jaw", "SJI", "Mg II", "Si IV", "C II")
LINES = ("Mg II", "Si IV", "C II", "O IV", "Fe XII 1349", "Fe XXI", "Cl I", "NUV continuum", "near-ultraviolet continuum", "near-UV continuum")
SYNTHESIS = (
    "synthetic", "synthesized", "synthesised", "synthesis", "forward model", "forward modeling", "forward modelling", "radiative transfer", "non-LTE", "NLTE",
    "radiative hydrodynamic", "radiative-hydrodynamic", "radiation hydrodynamic",
)
CONTEXT = ("chromosphere", "chromospheric", "transition region", "flare", "flares")

NOT_WORD = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Term:
    """Any of some phrases in a field; words are compared in lower case unless `cased`."""

    field: str
    phrases: tuple[str, ...]
    cased: bool = False


@dataclass(frozen=True)
class Branch:
    """All of some terms, and a condition on the document's own columns if there is one."""

    terms: tuple[Term, ...]
    also: Column | None = None


def standard(instrument: str, acronym: str, acknowledgements: tuple[str, ...], astronomy: Column, *, full: str = "full", abstract: str = "abstract") -> list[Branch]:
    """The branches on words: the full name, the acronym with a channel, an acknowledgement, and
    synthetic observables, for which the abstract must name a line, a synthesis and a context.

    The one on citations is `citing` of `discover`.
    """
    return [
        Branch((Term(full, (instrument,)),)),
        Branch((Term(full, (acronym,), cased=True), Term(full, CHANNELS)), astronomy),
        Branch((Term(full, acknowledgements),)),
        Branch((Term(abstract, LINES), Term(abstract, SYNTHESIS), Term(abstract, CONTEXT)), astronomy),
    ]


def months(date: Column, first: str, last: str) -> Column:
    """Dates from the first day of a month (YYYY-MM) to the last day of another."""
    end = F.add_months(F.to_date(F.lit(f"{last}-01")), 1)
    return (date >= F.to_date(F.lit(f"{first}-01"))) & (date < end)


def positions(corpus: DataFrame, key: str, fields: dict[str, Column]) -> DataFrame:
    """(key, field, pos, word, form): the words of the fields, `word` in lower case; null fields have none."""
    texts = F.array(*(F.struct(F.lit(name).alias("field"), F.split(text, NOT_WORD).alias("words")) for name, text in fields.items()))
    each = corpus.select(key, F.explode(texts).alias("x")).select(key, "x.field", F.posexplode("x.words").alias("pos", "form"))
    return each.where("form <> ''").select(key, "field", "pos", F.lower("form").alias("word"), "form")


def write_index(rows: DataFrame, key: str, path: str) -> DataFrame:
    """Writes the rows of `positions` sorted by word and reads them back.

    A query then reads only the row groups whose range of words has one of its own. Frequent words
    are spread over many files, since the ranges are of words and keys.
    """
    rows.repartitionByRange("word", key).sortWithinPartitions("word", key, "pos").write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _patterns(spark: SparkSession, terms: list[Term]) -> DataFrame:
    """(field, word, exact, term, phrase, offset, size): one row a word of a phrase."""
    rows = []
    for i, term in enumerate(terms):
        for j, phrase in enumerate(term.phrases):
            words = [w for w in re.split(r"[^\w]+|_", phrase) if w]
            rows += [(term.field, w.lower(), w if term.cased else None, i, j, at, len(words)) for at, w in enumerate(words)]
    return spark.createDataFrame(rows, "field string, word string, exact string, term int, phrase int, offset int, size int")


def matches(index: DataFrame, key: str, terms: Iterable[Term]) -> DataFrame:
    """(key, t0, t1, ...): which terms a document has, for those with any; from rows of `positions`."""
    terms = list(terms)
    patterns = _patterns(index.sparkSession, terms)  # as long as the query's text
    named = sorted({r.word for r in patterns.select("word").collect()})
    here = index.where(F.col("word").isin(named)).join(F.broadcast(patterns), ["field", "word"]).where(F.col("exact").isNull() | (F.col("exact") == F.col("form")))
    votes = here.select(key, "term", "phrase", "size", (F.col("pos") - F.col("offset")).alias("start")).repartition(key)
    found = votes.groupBy(key, "term", "phrase", "size", "start").agg(F.count("*").alias("n")).where(F.col("n") == F.col("size"))
    return found.groupBy(key).agg(*(F.bool_or(F.col("term") == i).alias(f"t{i}") for i in range(len(terms))))


def discover(corpus: DataFrame, key: str, fields: dict[str, Column], branches: list[Branch], citing: DataFrame, conjuncts: list[Column], *, index: DataFrame | None = None) -> DataFrame:
    """Rows that satisfy every conjunct and either a branch or membership in `citing` (key).

    The conjuncts filter first, so they reach the scan. Texts are read to make the index only, and
    not at all if `index` is given, which may hold more documents. Keys are unique and not null.
    """
    rows = corpus.where(reduce(lambda a, b: a & b, conjuncts))
    terms = list(dict.fromkeys(t for b in branches for t in b.terms))
    found = matches(positions(rows, key, fields) if index is None else index, key, terms)
    also = [(F.lit(True) if b.also is None else b.also).alias(f"_also{i}") for i, b in enumerate(branches)]
    narrow = rows.select(F.col(key).alias("_key"), *also)
    named = citing.select(F.col(key).alias("_cites")).distinct().withColumn("_cited", F.lit(True))
    told = narrow.join(found, narrow["_key"] == found[key], "left").join(named, F.col("_key") == F.col("_cites"), "left")
    hit = F.coalesce("_cited", F.lit(False))
    for i, b in enumerate(branches):
        every = reduce(lambda a, c: a & c, (F.coalesce(f"t{terms.index(t)}", F.lit(False)) for t in b.terms))
        hit = hit | (every & F.coalesce(f"_also{i}", F.lit(False)))
    return rows.join(told.where(hit).select("_key"), rows[key] == F.col("_key"), "left_semi")
