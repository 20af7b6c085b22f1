"""Benchmark decontamination by winnowing. DataFrame code only.

Words of documents and benchmark items are hashed, runs of K words by doubling, and of every
ALIGN consecutive run hashes the least is kept as a fingerprint. K + ALIGN - 1 is the window, so
a document that shares a whole window with an item shares that window's fingerprint with it.
Fingerprints are joined; a document with a hit is extended to its matching windows, which are
joined on a 128-bit hash of all their words. Items shorter than a window are one window of
their own length and are looked up as such, for the lengths that occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, bounded, free_name, materialise

WINDOW, K = 10, 4
#: Fixed value: runs of what is not a word character.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), _BETWEEN), ""), F.array().cast("array<string>"))


def _zip(column: str, gap: int, join) -> Column:
    """join(x[i], x[i+gap]) for every i that has both."""
    n = F.greatest(F.size(column) - gap, F.lit(0))
    return F.zip_with(F.slice(column, F.lit(1), n), F.slice(column, F.lit(gap + 1), n), join)


def _joined(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _lesser(a: Column, b: Column) -> Column:
    return F.least(a, b)


def with_runs(df: DataFrame, column: str, size: int, into: str, join=_joined) -> DataFrame:
    """Adds the joined values of all runs of `size` entries, built by doubling.

    With a join that may see an entry twice (a minimum) the last step overlaps; otherwise a run
    is put together from the powers of two in its size.
    """
    df, at, have = df.withColumn(into, F.col(column)), 1, 1
    if join is not _joined:
        while at < size:
            step = min(at, size - at)
            df = df.withColumn(into, _zip(into, step, join))
            at += step
        return df
    powers, part = {}, f"_{into}"
    df = df.withColumn(part, F.col(column))
    while have * 2 <= size:
        df = df.withColumn(part, _zip(part, have, join))
        have *= 2
        if size & have:
            df = df.withColumn(f"{part}{have}", F.col(part))
            powers[have] = f"{part}{have}"
    if size & 1:
        powers[1] = column
    total, name = 0, None
    for length in sorted(powers, reverse=True):
        if name is None:
            df, name, total = df.withColumn(into, F.col(powers[length])), into, length
        else:
            n = F.greatest(F.size(into) - length, F.lit(0))
            df = df.withColumn(into, F.zip_with(F.slice(into, F.lit(1), n), F.slice(powers[length], F.lit(total + 1), n), join))
            total += length
    return df.drop(part, *(p for p in powers.values() if p != column))


def fingerprints(df: DataFrame, hashes: str, into: str) -> DataFrame:
    """Adds the distinct winnowed fingerprints of an array of word hashes."""
    df = with_runs(df, hashes, K, "_runs")
    return with_runs(df, "_runs", WINDOW - K + 1, "_least", _lesser).withColumn(into, F.array_distinct("_least")).drop("_runs", "_least")


def _hashed(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("h", F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))


def _windows(df: DataFrame, text: str, size: int) -> DataFrame:
    """Adds `windows`: (first hash, second hash) of every run of `size` words."""
    df = df.withColumn("_w", words(F.col(text)))
    df = df.withColumn("_a", F.transform("_w", lambda w: F.xxhash64(w))).withColumn("_b", F.transform("_w", lambda w: F.xxhash64(w, F.lit(1)))).drop("_w")
    df = with_runs(with_runs(df, "_a", size, "_ra"), "_b", size, "_rb")
    return df.withColumn("windows", F.arrays_zip(F.col("_ra").alias("a"), F.col("_rb").alias("b"))).drop("_a", "_b", "_ra", "_rb")


def _key(id_column: str, text: str) -> list[Column]:
    """Two longs that stand for a row, so that repeated and null ids do no harm."""
    return [F.xxhash64(id_column, text).alias("k1"), F.xxhash64(F.lit(7), text, id_column).alias("k2")]


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (sorted strings), contaminated.

    Null and empty texts have no words and no hits; benchmark items without words are left out.
    Items with a null id are hit like others and count as one item, which has no name among
    items. Items of one id are one item. Equal rows get equal results, and a text of any length is
    looked at as a whole. Other columns are ignored, whatever their names. An empty table gives no
    rows; an empty benchmark hits nothing. The benchmark's windows are broadcast
    only if they were counted and are few; else both sides are shuffled by hash.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text")).where("text is not null")
    items = materialise(_hashed(items, "text").withColumn("n", F.size("h")).where("n > 0"))
    short = sorted(r[0] for r in items.where(F.col("n") < WINDOW).select("n").distinct().collect())  # at most WINDOW - 1 lengths
    fp = [fingerprints(items.where(F.col("n") >= WINDOW).select("h"), "h", "f").select(F.explode_outer("f").alias("f"), F.lit(WINDOW).alias("size"))]
    windows = [_windows(items.where(F.col("n") >= WINDOW).select("item", "text"), "text", WINDOW).select("item", F.explode_outer("windows").alias("w"), F.lit(WINDOW).alias("size"))]
    for n in short:
        own = items.where(F.col("n") == n)
        fp.append(with_runs(own.select("h"), "h", n, "f").select(F.explode_outer("f").alias("f"), F.lit(n).alias("size")))
        windows.append(_windows(own.select("item", "text"), "text", n).select("item", F.explode_outer("windows").alias("w"), F.lit(n).alias("size")))

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # the outer forms keep the optimiser from copying the arrays' expressions into filters below
    prints = materialise(union(fp).where("f is not null").distinct())
    table = materialise(union(windows).where("w is not null").select("item", "w.a", "w.b", "size").distinct())

    rows = docs.select(F.col(id_column).alias("doc_id"), *_key(id_column, text_column), F.col(text_column).alias("text"))
    scanned = fingerprints(_hashed(rows, "text").drop("text").withColumn("n_words", F.size("h").cast("long")), "h", f"f{WINDOW}")
    for n in short:
        scanned = with_runs(scanned, "h", n, f"f{n}").withColumn(f"f{n}", F.array_distinct(f"f{n}"))
    scanned = materialise(scanned.drop("h"))
    hit_rows = union([scanned.select("k1", "k2", F.explode(f"f{n}").alias("f"), F.lit(n).alias("size")) for n in (WINDOW, *short)])
    candidates = materialise(hit_rows.join(bounded(prints), ["f", "size"]).select("k1", "k2", "size").distinct())

    near = rows.join(bounded(candidates), ["k1", "k2"])
    found = []
    starts = table.select("a", "b", "size").distinct()
    for n in (WINDOW, *short):
        at = _windows(near.where(F.col("size") == n).select("k1", "k2", "text"), "text", n).select("k1", "k2", F.posexplode_outer("windows").alias("pos", "w"), F.lit(n).alias("size"))
        found.append(at.select("k1", "k2", "pos", "w.a", "w.b", "size"))
    matched = materialise(union(found).join(bounded(starts), ["a", "b", "size"]).distinct())

    before = Window.partitionBy("k1", "k2").orderBy("pos", "size").rowsBetween(Window.unboundedPreceding, -1)
    ends = matched.withColumn("stop", F.col("pos") + F.col("size"))
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest(F.col("pos"), F.coalesce(F.max("stop").over(before), F.lit(0))))
    covered = ends.withColumn("fresh", fresh).groupBy("k1", "k2").agg(F.sum("fresh").alias("n_hit"))
    of_items = matched.select("k1", "k2", "a", "b", "size").distinct().join(bounded(table), ["a", "b", "size"]).select("k1", "k2", "item").distinct()
    named = of_items.groupBy("k1", "k2").agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    hits = covered.join(named, ["k1", "k2"])
    out = scanned.select("doc_id", "k1", "k2", "n_words").join(hits, ["k1", "k2"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "k1", "k2", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of documents without a hit, with their own columns."""
    one, two = free_name(docs, "k1"), free_name(docs, "k2")
    dirty = materialise(contamination(docs, benchmark, id_column=id_column, text_column=text_column).where("contaminated").select("k1", "k2").distinct())
    k1, k2 = _key(id_column, text_column)
    return docs.select("*", k1.alias(one), k2.alias(two)).join(bounded(dirty.toDF(one, two)), [one, two], "left_anti").select(*docs.columns)
