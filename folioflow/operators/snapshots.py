"""Snapshots of a search that is run again and again, and what became of each id.

A record may come back under another id, and its old id then drops out. The state of a search
keeps every id that was ever found, with the runs that found it first and last, so that reports
can be held to the current ids and the others can be told.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = "id string, digest string, first_run string, last_run string, current boolean"


def digested(records: DataFrame, key: str) -> DataFrame:
    """(id, digest): a hash of each record's other columns; of equal ids the least digest counts."""
    rest = [c for c in sorted(records.columns) if c != key]
    text = F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}) if rest else F.lit("")
    return records.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("id")).agg(F.min(F.sha2(text, 256)).alias("digest"))


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(id, change) between two tables (id, digest): added, dropped, changed or kept."""
    both = old.select("id", F.col("digest").alias("_old")).join(new.select("id", F.col("digest").alias("_new")), "id", "full")
    kind = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "dropped").when(F.col("_old") != F.col("_new"), "changed").otherwise("kept")
    return both.select("id", kind.alias("change"))


def fold(state: DataFrame, new: DataFrame, run: str) -> DataFrame:
    """The state after a run whose snapshot is `new` (id, digest); an id that comes back is current again."""
    found = new.select("id", F.col("digest").alias("_new"))
    here = F.col("_new").isNotNull()
    return state.join(found, "id", "full").select(
        "id", F.coalesce("_new", "digest").alias("digest"), F.coalesce("first_run", F.lit(run)).alias("first_run"),
        F.when(here, F.lit(run)).otherwise(F.col("last_run")).alias("last_run"), here.alias("current"),
    )


def current(state: DataFrame) -> DataFrame:
    return state.where("current").select("id")


def replaced(results: DataFrame, state: DataFrame, by: Column) -> DataFrame:
    """(id, successor): ids of `results` that are no longer current, with the least current id of equal `by`.

    Where a file came again under its final id, its hash is what the two have in common.
    """
    rows = results.select("id", by.alias("_by"))
    now = rows.join(current(state), "id", "left_semi").groupBy("_by").agg(F.min("id").alias("successor"))
    return rows.join(current(state), "id", "left_anti").join(now, "_by", "left").select("id", "successor").distinct()
