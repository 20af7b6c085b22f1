"""Quality rules: two fixed limits and gradient-boosted trees over document statistics.

The trees are fitted on the driver on at most SAMPLE labelled documents, chosen by a hash of
doc_id; every document is scored. More repetition, symbols, copied lines, shouting or bare
separators may only lower a score (monotonic constraints).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Trees, fit
from .common import small_batches
from .docstats import BASE, FEATURES, statistics

#: Labelled documents that the model is fitted on, at most: 20,000 rows of 16 bytes to choose
#: them and 20,000 rows of 12 numbers to fit.
SAMPLE = 20_000
LEAST_WORDS, MOST_REPEATED = 50, 50
#: A document is rejected below this score.
THRESHOLD = 0.5
LOWERS = {FEATURES.index(k): -1 for k in ("symbol_rate", "dup_line_share", "repeat_share", "upper_share", "bare_share", "bang_rate")}


def features(docs: DataFrame, *keep: str, text_column: str = "text") -> DataFrame:
    """The kept columns, the base counts as longs and `features` as an array, for each row."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            done = [statistics(t) for t in batch.column(len(keep)).to_pylist()]
            base = np.asarray([b for b, _ in done], dtype=np.int64).reshape(-1, len(BASE))
            flat = np.asarray([f for _, f in done], dtype=np.float64).reshape(-1)
            offsets = np.arange(len(done) + 1, dtype=np.int32) * len(FEATURES)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(pa.array(base[:, k]) for k in range(len(BASE))), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[*keep, *BASE, "features"])

    types = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    counts = ", ".join(f"{k} long" for k in BASE)
    return docs.select(*keep, F.col(text_column).alias("text")).mapInArrow(run, f"{types}, {counts}, features array<double>")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, features, labels) of at most `most` labelled documents, the same ones each time.

    Null ids and labels are left out; of several labels of an id the largest counts. The chosen
    ids are at most `most` rows, so they are broadcast.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).dropna().groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = features(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "doc_id", "y").select("doc_id", "y", "features").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).toPandas()
    x = np.asarray(rows["features"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return rows["doc_id"].to_numpy(), x, rows["y"].to_numpy(dtype=np.float64)


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", most: int = SAMPLE) -> Trees:
    _, x, y = labelled_sample(docs, labels, label, most)
    return fit(x, y, monotone=LOWERS)


def verdicts(texts: list[str | None], model: Trees, threshold: float) -> tuple[np.ndarray, ...]:
    """(base counts, whether they break a limit, whether the text is kept, its score) of whole texts."""
    done = [statistics(t) for t in texts]
    base = np.asarray([b for b, _ in done], dtype=np.int64).reshape(-1, len(BASE))
    score = model.score(np.asarray([f for _, f in done], dtype=np.float64).reshape(-1, len(FEATURES)))
    failed = (base[:, 0] < LEAST_WORDS) | (100 * base[:, 4] > MOST_REPEATED * base[:, 0])
    return base, failed, ~failed & ((score >= threshold) | (len(model.roots) == 0)), score


def apply_rules(docs: DataFrame, model: Trees, *keep: str, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The kept columns, the base counts, base_failed, kept and score, for each row.

    Null or empty text has no words, fails the base limits and is not kept. Every row is judged on
    its own whole text, so repeated rows get equal results; an empty table gives no rows. A score
    at the threshold is kept. Without labels of both classes the model has no trees and the base
    limits alone decide. Columns to keep must not have the names of the results.
    """
    trees, n = model, len(keep)
    if clash := {*BASE, "base_failed", "kept", "score"}.intersection(keep):
        raise ValueError(f"columns {sorted(clash)} have names of the results")
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            base, failed, kept, score = verdicts(batch.column(n).to_pylist(), trees, threshold)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *(pa.array(base[:, k]) for k in range(len(BASE))), pa.array(failed), pa.array(kept), pa.array(score)], names=[*names, *BASE, "base_failed", "kept", "score"])

    names = [f"k{i}" for i in range(n)]
    types = ", ".join(f"k{i} {docs.schema[k].dataType.simpleString()}" for i, k in enumerate(keep))
    counts = ", ".join(f"{k} long" for k in BASE)
    rows = docs.select(*keep, F.col(text_column).alias("_text"))
    return rows.mapInArrow(run, f"{types}, {counts}, base_failed boolean, kept boolean, score double").toDF(*keep, *BASE, "base_failed", "kept", "score")


def keep_good(docs: DataFrame, model: Trees, *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents that the rules keep, with their own columns, in one pass."""
    names = docs.columns
    at = names.index("text")
    trees = model
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(verdicts(batch.column(at).to_pylist(), trees, threshold)[2]))

    return docs.mapInArrow(run, docs.schema)
