"""The classifier boundary: any object with decide(pages) may stand behind it.

A decision must obey the classification rules and cite only pages that were sent; one that does
not is asked for once more, and a second failure makes a failed result that keeps both errors.
An error of the service fails its paper, except one that every paper would meet: then the task asks
no more, what it has is kept, and `stopped` tells the caller to end the run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import BASES, CLASSIFICATION, DECISIONS, RESPONSE
from .responses import account_wide

TRIES = 2


class ServiceError(Exception):
    """An error of the service, with the code and the parameter it names, if any."""

    def __init__(self, text: str, kind: str, code: str | None = None, param: str | None = None):
        super().__init__(text)
        self.kind, self.code, self.param = kind, code, param


class RunStopped(RuntimeError):
    """The service refuses every paper; results from before are kept."""


class Classifier(Protocol):
    def decide(self, pages: dict[int, str]) -> dict:
        """A decision, with what the service tells of its answer under `response`, if anything."""


class TermClassifier:
    """Deterministic stand-in: pages with a term decide; two or more mean YES."""

    def __init__(self, pattern: str = r"(?ai)\b(?:the|der|que|les)\b"):
        self.pattern = re.compile(pattern)

    def decide(self, pages: dict[int, str]) -> dict:
        hits = [p for p, text in sorted(pages.items()) if self.pattern.search(text)]
        include = "YES" if len(hits) > 1 else "UNCERTAIN" if hits else "NO"
        basis = {"YES": ["OBSERVATIONAL_DATA"], "UNCERTAIN": ["REVIEW"], "NO": []}[include]
        return {"include": include, "basis": basis, "mission_mentioned": bool(hits), "evidence": [{"page": p, "reason": "TERM"} for p in hits]}


def problems(decision: dict, sent: set[int]) -> list[str]:
    basis, evidence, include = decision["basis"], decision["evidence"], decision["include"]
    other = [b for b in basis if b != "REVIEW"]
    rules = (
        (include not in DECISIONS or any(b not in BASES for b in basis), "unknown decision or basis"),
        (len(basis) != len(set(basis)), "basis repeats a tag"),
        (include == "NO" and basis, "NO has a basis"),
        (include == "YES" and not other, "YES has no basis of its own"),
        (include == "UNCERTAIN" and other, "UNCERTAIN has a basis"),
        (basis and not evidence, "a basis has no evidence"),
        (any(e["page"] < 1 or not e["reason"] for e in evidence), "evidence has no page or reason"),
        ({e["page"] for e in evidence} - sent, "evidence cites pages that were not sent"),
    )
    return [text for broken, text in rules if broken]


def _ask(client: Classifier, texts: dict[int, str]) -> tuple[dict, list[str], str | None]:
    """(fields of the row, errors, why the run must stop or None) of one paper."""
    errors, told = [], None
    try:
        for _ in range(TRIES):
            answer = client.decide(texts)
            told = answer.get("response")
            found = problems(answer, set(texts))
            if not found:
                return {k: answer[k] for k in FIELDS} | {"response": told}, errors, None
            errors.append("; ".join(found))
    except ServiceError as e:
        errors.append(str(e) or type(e).__name__)
        if account_wide(e.kind, e.code, e.param):
            return dict.fromkeys(FIELDS) | {"response": told}, errors, errors[-1]
    except (OSError, KeyError, TypeError, ValueError) as e:  # no answer, or none with a decision's shape
        errors.append(str(e) or type(e).__name__)
    return dict.fromkeys(FIELDS) | {"response": told}, errors, None


FIELDS = ("include", "basis", "mission_mentioned", "evidence")


def classify(pages: DataFrame, make=TermClassifier) -> DataFrame:
    """(paper, include, basis, mission_mentioned, evidence, response, errors, stop) for papers with any text.

    One client is made in each task. Put resume joins below this: no plan moves them through it.
    Rows with `stop` are no results: see `stopped`; papers that were not asked for have no row.
    """
    sent = pages.where(T.strip(F.col("text")) != "").groupBy("paper").agg(F.collect_list(F.struct("page", "text")).alias("pages"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, stop = make(), None
        for batch in batches:
            rows = []
            for paper, items in zip(batch["paper"], batch["pages"], strict=True):
                if stop is None:
                    fields, errors, stop = _ask(client, {int(x["page"]): x["text"] for x in items})
                    rows.append({"paper": paper, **fields, "errors": errors, "stop": stop})
            yield pd.DataFrame(rows, columns=["paper", *FIELDS, "response", "errors", "stop"])

    inner = CLASSIFICATION.removeprefix("struct<").removesuffix(">")
    return sent.mapInPandas(run, f"paper string, {_columns(inner)}, response {RESPONSE}, errors array<string>, stop string")


def stopped(decided: DataFrame) -> None:
    """Raises RunStopped if the service refused all; call it after the other rows were kept."""
    row = decided.where("stop is not null").select("stop").first()
    if row:
        raise RunStopped(row.stop)


def _columns(inner: str) -> str:
    """Top-level fields `a:type` as columns `a type`."""
    out, depth, name = [], 0, ""
    for c in inner:
        depth += (c == "<") - (c == ">")
        if c == ":" and not depth:
            name += " "
        elif c == "," and not depth:
            out.append(name)
            name = ""
        else:
            name += c
    return ", ".join([*out, name])
