"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of its statistics. The weights are those under which
the better document of each preference pair most likely wins: P(a beats b) = sigmoid(w.(xa-xb)),
so the loss is logistic loss on feature differences. A score is the strength against the
quantile of the training strengths that has as many of them below it as there are documents
marked bad, on a logistic scale; 0.5 lies at that quantile.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .docstats import FEATURES, statistics
from .quality_rules import labelled_sample

#: Labelled documents for training at most, and preference pairs for each document.
SAMPLE, PAIRS_EACH = 20_000, 24
STEPS, RATE, L2 = 400, 0.5, 1e-3


@dataclass(frozen=True)
class Ranking:
    centre: np.ndarray
    scale: np.ndarray
    knots: np.ndarray
    weights: np.ndarray
    cut: float
    width: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return expand(x, self.centre, self.scale, self.knots) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.strength(x) - self.cut) / self.width, -40, 40)))


def expand(x: np.ndarray, centre: np.ndarray, scale: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Standardised features and hinges at the training quantiles, so that limits can be learnt."""
    z = np.clip((x - centre) / scale, -8, 8)
    hinges = [np.maximum(0, z - k) for k in knots]
    return np.concatenate([z, *hinges], axis=1)


def fit(x: np.ndarray, y: np.ndarray) -> Ranking:
    """Deterministic. With one class only, or no rows, every score is that class's rate."""
    width = len(FEATURES)
    centre = x.mean(axis=0) if len(x) else np.zeros(width)
    scale = np.maximum(x.std(axis=0), 1e-6) if len(x) else np.ones(width)
    z = np.clip((x - centre) / scale, -8, 8)
    knots = np.quantile(z, (0.05, 0.25, 0.5, 0.75, 0.95), axis=0) if len(x) else np.zeros((5, width))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    n_weights = width * (1 + len(knots))
    if not len(good) or not len(bad):
        return Ranking(centre, scale, knots, np.zeros(n_weights), -1.0 if len(good) else (1.0 if len(bad) else 0.0), 1.0)
    e = expand(x, centre, scale, knots)
    chance = np.random.default_rng(7)
    # every document meets as many opponents of the other class
    winners = np.concatenate([np.repeat(good, PAIRS_EACH), chance.choice(good, len(bad) * PAIRS_EACH)])
    losers = np.concatenate([chance.choice(bad, len(good) * PAIRS_EACH), np.repeat(bad, PAIRS_EACH)])
    w, speed = np.zeros(n_weights), np.zeros(n_weights)
    for _ in range(STEPS):
        s = e @ w
        pull = 1 / (1 + np.exp(np.clip(s[winners] - s[losers], -40, 40)))
        # the gradient over pairs, gathered by document: no matrix of pair differences is built
        g = (np.bincount(winners, pull, len(x)) - np.bincount(losers, pull, len(x))) @ e / len(winners) - L2 * w
        speed = 0.9 * speed + g
        w = w + RATE * 0.1 * speed
    s = e @ w
    share = len(bad) / len(y)
    low, high = np.quantile(s[bad], 0.5), np.quantile(s[good], 0.5)
    ordered = np.sort(s)
    at = min(len(s) - 1, max(1, round(share * len(s))))
    cut = (ordered[at - 1] + ordered[at]) / 2
    return Ranking(centre, scale, knots, w, float(cut), float(max((high - low) / 8, 1e-6)))


def training_rows(labels: DataFrame) -> DataFrame:
    """Labels of the rows that may be learnt from: CRC-32 of the id as text leaves 0 or 2 by 3."""
    return labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", most: int = SAMPLE) -> Ranking:
    _, x, y = labelled_sample(docs, training_rows(labels), label, most)
    return fit(x, y)


def classify(docs: DataFrame, model: Ranking, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for each row; text is the only input of a score.

    Null and empty texts are scored as texts without words; a text of any length is scored as a
    whole. A score of exactly 0.5 is predicted 1. Rows that repeat have equal scores and each stays;
    a null id is not held out. Other columns are left out, whatever their names, and an empty table
    gives no rows. A model of no labelled rows gives all texts one score.
    """
    ranking = model
    small_batches(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = np.asarray([statistics(t)[1] for t in batch.column(2).to_pylist()], dtype=np.float64).reshape(-1, len(FEATURES))
            score = ranking.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return docs.select(F.col(id_column).alias("doc_id"), held.alias("held_out"), F.col(text_column).alias("text")).mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
