"""Near-duplicate documents by SetSketch registers, banding, joint likelihood and exact checks.

Each text becomes the set of its distinct word shingles and a sketch of it: register i holds
floor(1 - log_b(m)), cut to 16 bits, of the least m of exponentially distributed hashes of the
shingles. Registers of a union are the maxima of two sketches' registers, and with a base near 1
two sets agree in a register with a probability close to their Jaccard similarity.

1. Texts with one set are one representative (the least doc_id).
2. Representatives that agree in all registers of a band share a bucket. A bucket proposes its
   members' pairs with its least member: as many pairs as members, never all pairs.
3. A pair's similarity is estimated by maximum likelihood from the numbers of registers that are
   greater, equal and less; pairs well below the limit are left out (five standard deviations).
4. What is left is checked on the full sets, a leader with a bounded block of members at a time.
5. Links give components. In buckets whose members are then not all in one component, members
   outside the bucket's largest component are compared with all others, block by block; pairs of
   different components that pass 3 are checked in the block, and only links leave it. No cap
   drops a pair.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, free_name, materialise, small_batches
from .components import components
from .textkit import chunks, mix, window_hashes, word_hashes

BANDS, ROWS = 28, 4
REGISTERS = BANDS * ROWS
#: SetSketch's base, rate and largest register value.
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
DEVIATIONS = 5.0
#: Members that are checked with a leader in one group; home and outside rows of a block.
CHECK_BLOCK, HOME_BLOCK, OUTSIDE_BLOCK = 64, 256, 1024
_chance = np.random.default_rng(20240229)
_FACTORS = _chance.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TURNS = _chance.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z are lower-cased first.

    A text with fewer words than a shingle, but not none, has one shingle of all its words.
    """
    h, offsets = word_hashes([t.lower() for t in texts])
    runs = window_hashes(h, size) if len(h) >= size else h[:0]
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        n = b - a
        if n >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif n:
            out.append(mix(window_hashes(h[a:b], int(n)) + np.uint64(n)))
        else:
            out.append(h[:0])
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The sketch of each set, which must not be empty: one row of 16-bit registers each."""
    if not sets:
        return np.zeros((0, REGISTERS), dtype=np.uint16)
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    least = np.empty((len(sets), REGISTERS), dtype=np.float64)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat((flat ^ _TURNS[i]) * _FACTORS[i], starts)
    u = (least + 0.5) / 2.0**64
    value = np.floor(1 - np.log(-np.log1p(-np.minimum(u, 1 - 2.0**-53)) / RATE) / np.log(BASE))
    return np.clip(value, 0, TOP).astype(np.uint16)


def estimate(k1: np.ndarray, k2: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches of sets of known sizes."""
    more, less = (k1 > k2).sum(axis=1), (k1 < k2).sum(axis=1)
    same = k1.shape[1] - more - less
    u = n1 / (n1 + n2)
    v = 1 - u
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def p(x):
        return np.maximum(-np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE), 1e-12)

    def fit(j):
        a, b = p(u - v * j), p(v - u * j)
        return more * np.log(a) + less * np.log(b) + same * np.log(np.maximum(1 - a - b, 1e-12))

    for _ in range(24):  # the likelihood has one peak
        third = (high - low) / 3
        left = fit(low + third) < fit(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


def cutoff(percent: int) -> float:
    j = percent / 100
    return j - DEVIATIONS * (j * (1 - j) / REGISTERS) ** 0.5


def sketches(docs: DataFrame, size: int, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, digest, registers) in a written table; null text has no shingles."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            n, digest, regs = [], [], []
            for _, part in chunks(texts):
                sets = shingle_sets(part, size)
                full = [s for s in sets if len(s)]
                rows = iter(registers(full))
                for s in sets:
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    regs.append(next(rows).astype("<u2").tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(regs, pa.binary())], names=["doc_id", "n_shingles", "digest", "registers"])

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return materialise(rows.mapInArrow(run, f"doc_id {kind}, n_shingles long, digest binary, registers binary"))


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, REGISTERS)


def likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow the wanted similarity."""
    one = reps.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("registers").alias("ra"))
    two = reps.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("registers").alias("rb"))
    rows = pairs.join(one, "a").join(two, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    least = cutoff(percent)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(i).to_numpy().astype(float) for i in (2, 4))
                ok = estimate(_matrix(batch.column(3)), _matrix(batch.column(5)), na, nb) >= least
                yield batch.select([0, 1]).filter(pa.array(ok))

    return rows.select("a", "b", "na", "ra", "nb", "rb").mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the wanted similarity: a leader and a block at a time.

    docs is (doc_id, text). A leader's members are dealt to blocks by hash, and the leader's text
    goes to each block, so a group holds a bounded number of texts however many members there are.
    """
    pairs = materialise(pairs)
    blocks = materialise(pairs.groupBy("a").agg(F.ceil(F.count("*") / CHECK_BLOCK).cast("int").alias("blocks")))
    members = pairs.join(blocks, "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), F.col("b").alias("doc_id"))
    leaders = blocks.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("a").alias("doc_id"))
    need = materialise(members.unionByName(leaders))
    small_batches(docs.sparkSession)

    def check(keys, group):
        leader = keys[0].as_py()
        ids = group.column("doc_id").to_pylist()
        sets = shingle_sets([(t or "").encode("utf-8", "surrogatepass") for t in group.column("text").to_pylist()], size)
        own = [s for i, s in zip(ids, sets, strict=True) if i == leader and len(s)]
        linked = set()
        for i, s in zip(ids, sets, strict=True):
            if i != leader and len(s):
                for x in own:
                    both = len(np.intersect1d(x, s, assume_unique=True))
                    if 100 * both >= percent * (len(x) + len(s) - both):
                        linked.add(i)
        return pa.table({"a": pa.array([leader] * len(linked), pa.int64()), "b": pa.array(sorted(linked), pa.int64())})

    texts = docs.join(bounded(need), "doc_id").select("a", "block", "doc_id", "text")
    return materialise(texts.groupBy("a", "block").applyInArrow(check, "a long, b long"))


def _others(bands: DataFrame, sized: DataFrame, reps: DataFrame, found: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between different components of one bucket that the bucket's leader did not show.

    Members outside the bucket's largest component meet all others, a block of home rows and a
    block of outside rows at a time. Pairs that pass the estimate are checked on their full sets
    there and then, and of an outside member's links to one component in a block one is enough.
    """
    member = bands.join(sized.where("members > 2").select("bucket", "leader"), "bucket").join(found, F.col("rep") == F.col("node"), "left")
    member = member.select("bucket", "leader", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = member.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    rows = materialise(member.join(mixed, "bucket"))
    each = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    shape = each.groupBy("bucket").agg(F.sum("n").alias("n"), F.max_by("component", F.struct("n", "component")).alias("largest"), F.max("n").alias("most"))
    shape = shape.select("bucket", "largest", F.ceil(F.col("n") / HOME_BLOCK).cast("int").alias("homes"), F.ceil((F.col("n") - F.col("most")) / OUTSIDE_BLOCK).cast("int").alias("outsides"))
    full = rows.join(shape, "bucket")
    home = full.select("bucket", F.pmod(F.xxhash64("rep"), F.col("homes")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("outsides") - 1)).alias("j"), F.lit(True).alias("home"), "leader", "rep", "component")
    outside = full.where("component != largest").select("bucket", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)).alias("i"), F.pmod(F.xxhash64("rep", F.lit(1)), F.col("outsides")).cast("int").alias("j"), F.lit(False).alias("home"), "leader", "rep", "component")
    placed = materialise(home.unionByName(outside))
    sketch = reps.select("rep", "n_shingles", "registers")
    texts = docs.select(F.col("doc_id").alias("rep"), "text").join(bounded(placed.select("rep").distinct()), "rep", "left_semi")
    least = cutoff(percent)

    def compare(group):
        group = group.combine_chunks()
        is_home = np.asarray(group.column("home").to_pylist(), dtype=bool)
        rep, part, n = (group.column(c).to_numpy() for c in ("rep", "component", "n_shingles"))
        leader = group.column("leader")[0].as_py()
        regs, raw = _matrix(group.column("registers")), group.column("text")
        sets: dict[int, np.ndarray] = {}

        def full_set(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = shingle_sets([(raw[row].as_py() or "").encode("utf-8", "surrogatepass")], size)[0]
            return sets[row]

        at = np.flatnonzero(is_home)
        a, b = [], []
        for o in np.flatnonzero(~is_home):
            near = at[(part[at] != part[o]) & (rep[at] != leader) & (100 * np.minimum(n[at], n[o]) >= percent * np.maximum(n[at], n[o]))]
            if rep[o] == leader or not len(near):
                continue
            guess = estimate(np.broadcast_to(regs[o], (len(near), REGISTERS)), regs[near], np.full(len(near), float(n[o])), n[near].astype(float))
            done = set()
            for x in near[np.argsort(-guess, kind="stable")][: int((guess >= least).sum())]:
                if part[x] not in done:
                    one, two = full_set(int(o)), full_set(int(x))
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    if 100 * both >= percent * (len(one) + len(two) - both):
                        done.add(part[x])
                        a.append(min(rep[o], rep[x]))
                        b.append(max(rep[o], rep[x]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    ready = placed.join(sketch, "rep").join(texts, "rep")
    return materialise(ready.groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |intersection| >= percent * |union| of their shingle sets;
    component_id is the least doc_id that links reach. Texts without words (null, empty) have no
    shingles, are linked with nothing and are kept. Rows with one doc_id are one document whose
    links are those of any of its texts. A null doc_id takes no part: its component_id is null
    and it is kept. doc_id must be a whole number. A text of any length is sketched and checked as
    a whole. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    if percent < 80:
        raise ValueError("the bands are laid out for 80 percent or more")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    drawn = sketches(rows, size)
    usable = drawn.where("n_shingles > 0 and doc_id is not null")
    reps = materialise(usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"), F.count("*").alias("copies")))
    keys = F.array(*(F.xxhash64(F.lit(b), F.substring("registers", 2 * ROWS * b + 1, 2 * ROWS)) for b in range(BANDS)))
    bands = reps.select("rep", F.explode(keys).alias("bucket"))
    sized = materialise(bands.groupBy("bucket").agg(F.min("rep").alias("leader"), F.count("*").alias("members")).where("members > 1"))
    stars = materialise(bands.join(sized, "bucket").where("rep != leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct())
    links = verify(likely(stars, reps, percent), rows, size, percent)
    found = components(links)
    more = _others(bands, sized, reps, found, rows, size, percent)
    if not more.isEmpty():
        found = components(links.unionByName(more))
    grouped = reps.join(found, F.col("rep") == F.col("node"), "left").select("digest", "rep", "copies", F.coalesce("component", "rep").alias("component"))
    known = materialise(grouped.where("copies > 1 or component != rep").select("digest", "component"))
    # texts without words get a key of their own, so they spread and match nothing
    spread = F.coalesce("digest", F.col("doc_id").cast("string").cast("binary"))
    out = drawn.withColumn("digest", spread).join(bounded(known), "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def numbered(docs: DataFrame, row: str) -> DataFrame:
    """The rows with a column `row`, a whole number of its own for each: its doc_id where no other
    row has that one, else a number that is no doc_id.

    Only rows whose doc_id is null or repeated are written again, whatever their share; all others
    are read where they are. Should doc_ids leave no room for other numbers, all rows are numbered.
    """
    number = F.col("doc_id").cast("long")
    odd = materialise(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias("_odd")))
    if odd.isEmpty():
        return docs.withColumn(row, number)
    ends = docs.agg(F.min(number).alias("low"), F.max(number).alias("high")).first()
    low, high = (0, -1) if ends.low is None else (ends.low, ends.high)
    room = 1 << 62  # over what monotonically_increasing_id gives
    if high < room:
        other = F.lit(high + 1) + F.monotonically_increasing_id()
    elif low > -room:
        other = F.lit(low - 1) - F.monotonically_increasing_id()
    else:
        return materialise(docs.withColumn(row, F.monotonically_increasing_id()))
    same = docs["doc_id"].eqNullSafe(F.col("_odd"))
    ids = bounded(odd)
    again = materialise(docs.join(ids, same, "left_semi").withColumn(row, other))
    return docs.join(ids, same, "left_anti").withColumn(row, number).unionByName(again)


def keep_one(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of documents without the near copies of an earlier one, with their own columns.

    Every row counts for itself, whether its doc_id is repeated, null or neither. Of a group of
    near copies the row of the least doc_id stays, one without an id only if none has one. Of
    equal rows without words one stays.
    """
    row = free_name(docs, "row")
    rows = numbered(docs, row)
    marked = materialise(near_duplicates(rows, size=size, percent=percent, id_column=row).withColumnRenamed("doc_id", row))
    later = marked.where("not kept").select(row, "component_id")
    group = materialise(later.unionByName(later.select(F.col("component_id").alias(row), "component_id").distinct()))
    named = rows.select(row, "doc_id").join(bounded(group), row)
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("at"))).alias("first")).select(F.col("first.at").alias(row))
    empty = marked.where("n_shingles = 0").select(row)
    alike = rows.join(bounded(empty), row, "left_semi").groupBy(*docs.columns).agg(F.min(row).alias(row)).select(row)
    gone = materialise(group.select(row).unionByName(empty).join(first.unionByName(alike), row, "left_anti"))
    return rows.join(bounded(gone), row, "left_anti").select(*docs.columns)
