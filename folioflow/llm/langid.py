"""Language identification by rank-order profiles.

A profile lists a language's most frequent n-grams of one to three characters by rank. A text's
own most frequent n-grams are ranked likewise; its distance to a profile is the sum, over them, of
how far each is out of place there, an n-gram that the profile lacks counting as the profile's
whole length. The nearest language is predicted.

Words are runs of letters and of the marks that belong to them, lower-cased; one blank stands
between words and at both ends, and an n-gram of the blank alone is none. An n-gram is its code
points, 21 bits each, in one integer, so that equal integers are equal n-grams.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches

#: N-grams of a language's profile, and of a text, at most.
PROFILE = 400
#: Languages at most: bounds the profiles that are broadcast by 48 MB.
LANGUAGES = 10_000
#: Different n-grams that a task counts before it hands its counts on.
HELD = 1 << 20
UNKNOWN = "und"
#: Places of a text whose n-grams are sorted at once.
BLOCK = 1 << 20
_BITS, _BLANK = 21, 0x20


@cache
def _kinds() -> np.ndarray:
    """By code point: 1 for a letter, 2 for a mark, else 0."""
    return np.fromiter(({"L": 1, "M": 2}.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)), dtype=np.uint8, count=0x110000)


def _summed(keys: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys that may repeat, each once with its summed count."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(count, first)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, count = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(keys, kind="stable")
    return _summed(keys[order], count[order]) if len(keys) else (keys, count)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams in ascending order, their counts) of a whole text; empty without a letter."""
    none = np.zeros(0, dtype=np.int64)
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _kinds()[points]
    if not (kinds == 1).any():
        return none, none
    line = np.full(len(points) + 4, _BLANK, dtype=np.int64)
    line[1:-3] = np.where(kinds > 0, points, _BLANK)
    blank = line == _BLANK
    blank[1:] &= blank[:-1].copy()
    blank[[0, -2, -1]] = False
    line = line[~blank]
    # every place begins a run of three, and shorter n-grams are beginnings of those; a block of
    # places at a time, so that sorting needs memory for a block
    parts = []
    for at in range(0, len(line) - 2, BLOCK):
        end = min(at + BLOCK, len(line) - 2)
        parts.append(np.unique((line[at:end] << 2 * _BITS) | (line[at + 1 : end + 1] << _BITS) | line[at + 2 : end + 2], return_counts=True))
    three, n_three = _merged(parts)
    two, n_two = _summed(three >> _BITS, n_three)
    one, n_one = _summed(two >> _BITS, n_two)
    found = [(one, n_one, one != _BLANK), (two, n_two, two != (_BLANK << _BITS | _BLANK)), (three, n_three, (three >> _BITS) & ((1 << _BITS) - 1) != _BLANK)]
    return np.concatenate([k[ok] for k, _, ok in found]), np.concatenate([c[ok] for _, c, ok in found])


def ranked(found: tuple[np.ndarray, np.ndarray], most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams by rank; equally frequent ones in ascending order."""
    keys, count = found
    return keys[np.argsort(-count, kind="stable")[:most]]


@dataclass(frozen=True)
class Profiles:
    """names: languages in order; keys: their n-grams, ascending; ranks: (keys, languages), PROFILE where absent."""

    names: tuple[str, ...]
    keys: np.ndarray
    ranks: np.ndarray

    def distances(self, mine: np.ndarray) -> np.ndarray:
        """The out-of-place distance of n-grams in their order to each language."""
        far = np.full((len(mine), len(self.names)), PROFILE, dtype=np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, mine), len(self.keys) - 1)
            known = self.keys[at] == mine
            far[known] = self.ranks[at[known]]
        place = np.arange(len(mine))[:, None]
        return np.where(far < PROFILE, np.abs(far - place), PROFILE).sum(axis=0)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): 0.5 if another language is as near, 1 if the profile fits exactly."""
        mine = ranked(grams(text))
        if not len(mine) or not self.names:
            return UNKNOWN, 0.0
        d = self.distances(mine)
        best = int(d.argmin())
        rest = np.delete(d, best)
        second = int(rest.min()) if len(rest) else PROFILE * len(mine)
        return self.names[best], second / (int(d[best]) + second) if second else 0.5


def held_out(id_column: Column) -> Column:
    """Rows that are not learnt from: the CRC-32 of the id as text leaves 2 by 4; a null id is learnt from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def gram_counts(docs: DataFrame, *, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """(lang, gram, n) over the whole texts; tasks add up before the shuffle, in bounded memory."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def out(lang: str, keys: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(count)], names=["lang", "gram", "n"])

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = grams(text.as_py())
                held.setdefault(lang, []).append(found)
                size += len(found[0])
            if size > HELD:
                held = {lang: [_merged(parts)] for lang, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > HELD // 2:
                    for lang, parts in held.items():
                        yield out(lang, *parts[0])
                    held, size = {}, 0
        for lang, parts in held.items():
            yield out(lang, *_merged(parts))

    rows = docs.where(F.col(lang_column).isNotNull()).select(F.col(text_column).cast("string").alias("text"), F.col(lang_column).cast("string").alias("lang"))
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Profiles:
    """The profiles of all languages of rows that are not held out and whose language is known.

    A language whose texts have no letter has no profile and is never predicted. Only the first
    PROFILE n-grams of each language come to the driver; more than LANGUAGES languages are an error.
    """
    counts = gram_counts(docs.where(~held_out(F.col(id_column))), text_column=text_column, lang_column=lang_column)
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    # the rank's limit is applied before the shuffle as well, so no language lands whole in a task
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    rows = top.select("lang", "gram", "rank").limit(LANGUAGES * PROFILE + 1).toPandas()
    if len(rows) > LANGUAGES * PROFILE:
        raise ValueError(f"over {LANGUAGES} languages")
    names = tuple(sorted(set(rows["lang"])))
    keys, back = np.unique(rows["gram"].to_numpy(dtype=np.int64), return_inverse=True)
    ranks = np.full((len(keys), len(names)), PROFILE, dtype=np.int32)
    ranks[back, np.searchsorted(np.array(names, dtype=object), rows["lang"].to_numpy(dtype=object))] = rows["rank"].to_numpy() - 1
    return Profiles(names, keys, ranks)


def identify(docs: DataFrame, profiles: Profiles, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row; the whole text is the only input.

    A null or empty text, or one without a letter, is `und` with score 0, and so is every text if
    nothing was learnt. Languages that are equally near go by their names. Repeated rows and ids
    stay, a null id is not held out, other columns are left out, and an empty table has no rows.
    A text may be of any length; one text at a time is held beside its batch.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_column).alias("doc_id"), held_out(F.col(id_column)).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
