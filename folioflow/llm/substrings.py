"""Substring dedup by level-wise doubling of repeated windows.

A window's hash is joined from the hashes of runs of half its length, so one pass over a text
gives all lengths: 5, 10 and 20 words by default. At each length a window is represented by the
least hash of its runs of that length, which equal windows share; consecutive windows mostly have
the same one, so a level carries about one row in eight words. Windows whose run is repeated
anywhere in the corpus are extended to twice the length; all others are left out, until the full
length is reached or no candidates survive. Only the candidates' starts and hashes go from level
to level, never texts.

Exchanges are kept free of hot keys: runs are counted with partial aggregates and joined back by
a join that splits skewed keys; full windows are first reduced within blocks of documents, so the
most common window sends one entry per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_bytes, materialise, small_batches
from .textkit import chunks, valid_starts, window_hashes, word_hashes

WINDOW, LEVEL_ONE = 20, 5
#: Documents that are reduced together, and windows that are compared together, about.
BLOCK, BUCKET = 1000, 500_000
_NULL_ID = np.iinfo(np.int64).min


def levels(window: int, base: int) -> list[int]:
    """The lengths of runs before the full window, each twice the one before."""
    out = []
    while base < window:
        out.append(base)
        base *= 2
    return out


def _least_runs(h: np.ndarray, window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start the least hash of the runs inside it, and where the first such is."""
    low, have, want = window_hashes(h, size), 1, window - size + 1
    at = np.arange(len(low))
    while have < want:
        step = min(have, want - have)
        less = low[step:] < low[:-step]
        low, at = np.where(less, low[step:], low[:-step]), np.where(less, at[step:], at[:-step])
        have += step
    return low, at


def _segments(of: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where windows begin whose text or least run is not that of the window before."""
    return np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (at[1:] != at[:-1])])) if len(of) else np.zeros(0, dtype=np.int64)


def _texts(column) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def _windows(part: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, the texts' offsets in them, start and text of each window)."""
    h, offsets = word_hashes(part)
    start = np.flatnonzero(valid_starts(offsets, window, len(h))) if len(h) >= window else np.zeros(0, dtype=np.int64)
    return h, offsets, start, np.searchsorted(offsets, start, "right") - 1


def _lists(values: np.ndarray, of: np.ndarray, n: int) -> pa.ListArray:
    """Lists of the values of each of n texts; of ascends."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)).astype(np.int32)), pa.array(values))


def _blobs(values: np.ndarray, of: np.ndarray, n: int) -> pa.Array:
    cuts = np.searchsorted(of, np.arange(n + 1)) * values.itemsize
    raw = memoryview(np.ascontiguousarray(values)).cast("B")
    return pa.array([raw[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], pa.binary())


def first_level(rows: DataFrame, window: int, base: int) -> DataFrame:
    """(key, runs): the least runs of a document's windows, an entry for each place of one."""

    def run(batches):
        for batch in batches:
            for first, part in chunks(_texts(batch.column(1))):
                h, _, start, of = _windows(part, window)
                if len(start):
                    low, at = _least_runs(h, window, base)
                    cut = _segments(of, at[start])
                    runs = _lists(low[start[cut]].view(np.int64), of[cut], len(part))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), runs], names=["key", "runs"]).filter(pa.array(np.bincount(of, minlength=len(part)) > 0))

    return materialise(rows.select("key", "text").mapInArrow(run, "key long, runs array<long>"))


def repeated(level: DataFrame) -> DataFrame:
    """(key, alive): of each document's runs those that the corpus has at two places or more."""
    each = level.select("key", F.explode("runs").alias("run"))
    twice = each.groupBy("run").agg(F.count("*").alias("n")).where("n > 1").select("run")
    return materialise(each.join(twice.hint("merge"), "run").groupBy("key").agg(F.collect_set("run").alias("alive")))


def _extended(rows: DataFrame, window: int, lengths: list[int]) -> DataFrame:
    """Candidate windows of each document, from its text and the runs of level one that live.

    One row per document: starts and full hashes as binary, and for each further level the least
    runs with the number of windows that each stands for.
    """

    def run(batches):
        for batch in batches:
            alive_of = batch.column(3)
            for first, part in chunks(_texts(batch.column(2))):
                h, offsets, start, of = _windows(part, window)
                if not len(start):
                    continue
                # a run that lives in one document lives in all that have it
                alive = np.unique(alive_of.slice(first, len(part)).flatten().to_numpy()).view(np.uint64)
                ok = np.isin(_least_runs(h, window, lengths[0])[0][start], alive)
                start, of = start[ok], of[ok]
                n, out, names = len(part), [], []
                for size in lengths[1:]:
                    low, at = _least_runs(h, window, size)
                    cut = _segments(of, at[start])
                    out += [_lists(low[start[cut]].view(np.int64), of[cut], n), _blobs(np.diff(cut, append=len(of)).astype(np.int32), of[cut], n)]
                    names += [f"runs{size}", f"sizes{size}"]
                full = window_hashes(h, window)[start]
                out = [batch.column(0).slice(first, n), batch.column(1).slice(first, n), _blobs((start - offsets[of]).astype(np.int32), of, n), _blobs(full, of, n), *out]
                yield pa.RecordBatch.from_arrays(out, names=["key", "doc_id", "starts", "hashes", *names]).filter(pa.array(np.bincount(of, minlength=n) > 0))

    more = "".join(f", runs{size} array<long>, sizes{size} binary" for size in lengths[1:])
    return materialise(rows.select("key", "doc_id", "text", "alive").mapInArrow(run, f"key long, doc_id long, starts binary, hashes binary{more}"))


def _narrowed(found: DataFrame, lengths: list[int]) -> DataFrame:
    """The candidates whose run of the first of the lengths lives; that level's columns go."""
    names = ["key", "doc_id", "starts", "hashes", *(c for size in lengths[1:] for c in (f"runs{size}", f"sizes{size}"))]

    def run(batches):
        for batch in batches:
            rows = {c: [] for c in names}
            for r in batch.to_pylist():
                def of_windows(size, r=r):
                    return np.repeat(np.asarray(r[f"runs{size}"], dtype=np.int64), np.frombuffer(r[f"sizes{size}"], dtype=np.int32))

                ok = np.isin(of_windows(lengths[0]), np.asarray(r["alive"], dtype=np.int64))
                if not ok.any():
                    continue
                for c in ("key", "doc_id"):
                    rows[c].append(r[c])
                rows["starts"].append(np.frombuffer(r["starts"], dtype=np.int32)[ok].tobytes())
                rows["hashes"].append(np.frombuffer(r["hashes"], dtype=np.uint64)[ok].tobytes())
                for size in lengths[1:]:
                    own = of_windows(size)[ok]
                    cut = _segments(own, own)
                    rows[f"runs{size}"].append(own[cut].tolist())
                    rows[f"sizes{size}"].append(np.diff(cut, append=len(own)).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([batch.schema.field(c) for c in names]))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema if f.name in names)
    return materialise(found.select(*names[:4], *(c for size in lengths for c in (f"runs{size}", f"sizes{size}")), "alive").mapInArrow(run, kinds))


def _by(group: np.ndarray) -> list[np.ndarray]:
    """The positions of each value of a group, values ascending."""
    order = np.argsort(group, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if len(order) else []


def _joined(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def repeats(found: DataFrame, window: int, last: int | None = None, alive: DataFrame | None = None) -> DataFrame:
    """(key, spans): of each document the words covered by windows whose sequence also starts earlier.

    spans holds pairs of first word and end as 32-bit numbers. With a last level its living runs
    are given too, and the candidates are narrowed by them here.
    """
    size = found.agg(F.count("*"), F.sum(F.length("starts"))).first()
    blocks, buckets = max(1, -(-size[0] // BLOCK)), max(1, -(-(size[1] or 0) // 4 // BUCKET))
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block")

    def firsts(group, living=None):
        """The block's first occurrence of each window by bucket, and its others under bucket -1."""
        ids, keys = group.column("doc_id").fill_null(_NULL_ID).to_numpy(), group.column("key").to_numpy()
        # equal rows are one document: only one of them counts
        rank = np.lexsort((keys, ids))
        once = rank[np.concatenate([[True], keys[rank][1:] != keys[rank][:-1]])] if len(rank) else rank
        group = group.take(pa.array(once))
        ids, keys = ids[once], keys[once]
        owner = np.repeat(np.arange(len(once)), [len(x) // 4 for x in group.column("starts").to_pylist()])
        start, h = _joined(group.column("starts"), np.int32), _joined(group.column("hashes"), np.uint64)
        if living is not None:
            runs = group.column(f"runs{last}").combine_chunks().flatten().to_numpy()
            ok = np.isin(np.repeat(runs, _joined(group.column(f"sizes{last}"), np.int32)), living.column("alive").combine_chunks().flatten().to_numpy())
            owner, start, h = owner[ok], start[ok], h[ok]
        by_hash = np.argsort(h, kind="stable")
        first = np.empty(len(h), dtype=bool)
        first[by_hash] = np.concatenate([[True], h[by_hash][1:] != h[by_hash][:-1]]) if len(h) else first
        bucket = np.where(first, ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64), -1)
        parts = _by(bucket)
        values = {"hashes": h, "ids": ids[owner], "keys": keys[owner], "starts": start}
        home = group.column("block").slice(0, 1).to_pylist() * len(parts)
        return pa.table({"bucket": pa.array([int(bucket[p[0]]) for p in parts], pa.int64()), "block": pa.array(home, pa.int64()), **{k: pa.array([v[p].tobytes() for p in parts], pa.binary()) for k, v in values.items()}})

    def later(group):
        """Of the blocks' first occurrences those that are not the corpus's first, by block."""
        hashes, ids, keys, starts = (_joined(group.column(c), t) for c, t in (("hashes", np.uint64), ("ids", np.int64), ("keys", np.int64), ("starts", np.int32)))
        home = np.repeat(group.column("block").to_numpy(), [len(b) // 8 for b in group.column("hashes").to_pylist()])
        order = np.lexsort((starts, keys, ids, hashes))
        again = order[1:][hashes[order][1:] == hashes[order][:-1]]
        parts = [again[p] for p in _by(home[again])]
        return pa.table({"block": pa.array([int(home[p[0]]) for p in parts], pa.int64()), "keys": pa.array([keys[p].tobytes() for p in parts], pa.binary()), "starts": pa.array([starts[p].tobytes() for p in parts], pa.binary())})

    def gathered(group):
        keys, starts = _joined(group.column("keys"), np.int64), _joined(group.column("starts"), np.int32)
        spans = []
        parts = _by(keys)
        for p in parts:
            at = np.sort(starts[p])
            gap = np.flatnonzero(at[1:] > at[:-1] + window)
            spans.append(np.stack([at[np.concatenate([[0], gap + 1])], at[np.append(gap, len(at) - 1)] + window], axis=1).astype(np.int32).tobytes())
        return pa.table({"key": pa.array([int(keys[p[0]]) for p in parts], pa.int64()), "spans": pa.array(spans, pa.binary())})

    kind = "bucket long, block long, hashes binary, ids binary, keys binary, starts binary"
    own = [c for c in found.columns if c in ("key", "doc_id", "starts", "hashes", f"runs{last}", f"sizes{last}")]
    grouped = found.select(block, *own).groupBy("block")
    if alive is None:
        records = grouped.applyInArrow(firsts, kind)
    else:
        records = grouped.cogroup(alive.select(block, "alive").groupBy("block")).applyInArrow(firsts, kind)
    records = materialise(records)
    others = records.where("bucket >= 0").groupBy("bucket").applyInArrow(later, "block long, keys binary, starts binary")
    return materialise(records.where("bucket < 0").select("block", "keys", "starts").unionByName(others).groupBy("block").applyInArrow(gathered, "key long, spans binary"))


def without_repeats(docs: DataFrame, *, window: int = WINDOW, base: int = LEVEL_ONE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id (as a long), n_words, n_removed, text (the words left).

    A word goes if it lies in a window of `window` words whose sequence also starts earlier: in
    a document of smaller doc_id, or earlier in the same one. Words left are joined by a space. A
    null id is before all others. Rows that share an id but not the text are ordered by a hash;
    equal rows are one document and get the same result. Null and empty texts have no words; a
    very long text is worked on alone. Windows are compared by a 64-bit hash of all their words.
    Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    lengths = levels(window, base)
    if not lengths:
        raise ValueError("level one must be shorter than the window")
    alive = repeated(first_level(rows, window, base))
    found = _extended(rows.join(alive, "key"), window, lengths)
    alive = None
    for k, size in enumerate(lengths[1:], start=1):
        if found.isEmpty():
            break
        alive = repeated(found.select("key", F.col(f"runs{size}").alias("runs")))
        if size != lengths[-1]:
            found = _narrowed(found.join(alive, "key"), lengths[k:])
    gone = repeats(found, window, lengths[-1], alive)

    def finish(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                words, at, left = text.split(), 0, []
                for a, b in np.frombuffer(spans or b"", dtype=np.int32).reshape(-1, 2).tolist():
                    left += words[at:a]
                    at = b
                left += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "text"])

    return rows.join(bounded_bytes(gone, F.length("spans")), "key", "left").select("doc_id", "text", "spans").mapInArrow(finish, "doc_id long, n_words long, n_removed long, text string")
