"""Personal data: fixed base kinds, and bootstrapped contextual extraction of what they miss.

One pass over the texts finds the spans of the base kinds and every other identifier-like token
(six characters or more with a digit), each with its left context as a lexical pattern. Base
spans and long hexadecimal strings are the seeds. Patterns and instances (token values) form a
bipartite graph; a pattern's score for a kind is the smoothed share of its instances that are
of that kind, an instance's score the best score of its patterns, and a few rounds let
confident patterns lend score to instances seen in other contexts. Patterns with a high score
and enough distinct seeds and documents then mark the unseen instances they introduce.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialise, small_batches

KINDS = ("email", "ip", "card", "phone")
ROUNDS, CONFIDENT, LEAST_SEEDS, LEAST_DOCUMENTS, SMOOTHING = 3, 0.8, 3, 3, 0.5
#: Longer tokens are known by a digest of all their characters.
LONG = 200

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# possessive forms: what follows never needs the characters that a run has taken
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_CANDIDATE = re.compile(r"[A-Za-z0-9][A-Za-z0-9_+/.@-]{4,}[A-Za-z0-9]")
_HEX = re.compile(r"(?=.*[a-f])(?=(?:.*[0-9]){4})[0-9a-f]{16,}\Z")
_KEY = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_-")
_WHITE = frozenset(" \t\n\x0b\x0c\r")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping spans of each base kind; matches that fail a test are dropped.

    Linear in the text: an email is found from its @ sign, whose local part is the whole run of
    allowed characters before it, and the number patterns never give back what they took.
    """
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out["email"].append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in m.groups())]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out["card"].append(m.span())
        if "+" in text:
            out["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return out


def known(value: str) -> str:
    """What stands for a word in the graph: its text, or a 128-bit digest of a long one's."""
    value = value.lower()
    if len(value) <= LONG:
        return value
    return f"\\{hashlib.blake2b(value.encode('utf-8', 'surrogatepass'), digest_size=16).hexdigest()}"


def pattern(text: str, start: int) -> str:
    """The left context of a position: a key with its sign, or else the word before, both whole.

    Between key, sign, an opening quote and the position there may be any number of blanks. Only
    the context itself is looked at, so all contexts of a text together are about as long as it.
    """
    at = start - (start > 0 and text[start - 1] in "\"'")
    while at and text[at - 1] == " ":
        at -= 1
    if at and text[at - 1] in "=:":
        sign = text[at - 1]
        at -= 1
        while at and text[at - 1] == " ":
            at -= 1
        end = at
        while at and text[at - 1] in _KEY:
            at -= 1
        key = text[at:end].lstrip("-")
        if len(key) > 1:
            return f"{known(key)}{sign}"
    at = start
    while at and text[at - 1] in _WHITE:
        at -= 1
    end = at
    while at and text[at - 1] not in _WHITE:
        at -= 1
    return f"~{known(text[at:end])}" if end < start else "~"


def occurrences(text: str, base: dict[str, list[tuple[int, int]]]) -> list[dict]:
    """Base spans and identifier-like tokens outside them, with pattern, value and kind."""
    found = [{"pattern": pattern(text, a), "instance": known(text[a:b]), "kind": k, "start": a, "stop": b} for k in KINDS for a, b in base[k]]
    if not _DIGIT.search(text):
        return found
    taken = sorted((a, b) for k in KINDS for a, b in base[k])
    i = 0
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if i < len(taken) and taken[i][0] < b or not _DIGIT.search(m.group()):
            continue
        value = m.group()
        found.append({"pattern": pattern(text, a), "instance": known(value), "kind": "secret" if _HEX.match(value) else None, "start": a, "stop": b})
    return found


_OCCURRENCE = pa.list_(pa.struct([("pattern", pa.string()), ("instance", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def scan(docs: DataFrame, *keep: str, text_column: str = "text") -> DataFrame:
    """One row per document in a written table: row_key, the kept columns, counts, spans, found.

    row_key numbers the rows; doc_id may repeat or be null. Null text counts as empty.
    """
    small_batches(docs.sparkSession)
    n = len(keep)

    def run(batches):
        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [t or "" for t in batch.column(n).to_pylist()]
            base = [base_spans(t) for t in texts]
            joined = [",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in x[k]) for x in base]
            found = [occurrences(t, x) for t, x in zip(texts, base, strict=True)]
            keys = pa.array(range(part << 36 | count, (part << 36 | count) + len(texts)), pa.int64())
            count += len(texts)
            yield pa.RecordBatch.from_arrays(
                [keys, *batch.columns[:n], *(pa.array([len(x[k]) for x in base], pa.int64()) for k in KINDS), pa.array(joined, pa.string()), pa.array(found, _OCCURRENCE)],
                names=["row_key", *(f"k{i}" for i in range(n)), *(f"n_{k}" for k in KINDS), "base_spans", "found"],
            )

    types = "".join(f"k{i} {docs.schema[k].dataType.simpleString()}, " for i, k in enumerate(keep))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    found = "found array<struct<pattern:string,instance:string,kind:string,start:bigint,stop:bigint>>"
    return materialise(docs.select(*keep, F.col(text_column).alias(free_name(docs, "_text"))).mapInArrow(run, f"row_key long, {types}{counts}, base_spans string, {found}"))


def confident_patterns(scanned: DataFrame, *, rounds: int = ROUNDS, confident: float = CONFIDENT, least_seeds: int = LEAST_SEEDS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(pattern, kind, score) of the patterns that are trusted to find new instances."""
    each = scanned.select("row_key", F.explode("found").alias("f")).select("row_key", "f.pattern", "f.instance", "f.kind")
    edges = materialise(each.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"), F.count_distinct("row_key").alias("documents")))
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("degree"), F.sum("documents").alias("documents"))
    seeds = edges.where("kind is not null").groupBy("instance", F.col("kind").alias("as_kind")).agg(F.lit(1.0).alias("score"))
    scores, patterns = seeds, None
    for _ in range(rounds):
        gathered = edges.drop("documents").join(scores, "instance").groupBy("pattern", "as_kind").agg(F.sum("score").alias("mass"), F.count_if(F.col("kind") == F.col("as_kind")).alias("seeds"))
        patterns = materialise(gathered.join(sizes, "pattern").select("pattern", "as_kind", "seeds", "documents", (F.col("mass") / (F.col("degree") + SMOOTHING)).alias("score")))
        lent = edges.where("kind is null").select("pattern", "instance").join(patterns.where(F.col("score") >= confident / 2), "pattern").groupBy("instance", "as_kind").agg(F.max("score").alias("score"))
        scores = materialise(seeds.unionByName(lent).groupBy("instance", "as_kind").agg(F.max("score").alias("score")))
    trusted = (F.col("score") >= confident) & (F.col("seeds") >= least_seeds) & (F.col("documents") >= least_documents)
    return patterns.where(trusted).groupBy("pattern").agg(F.max_by("as_kind", F.struct("score", "as_kind")).alias("as_kind"), F.max("score").alias("score"))


def discovered(scanned: DataFrame, patterns: DataFrame) -> DataFrame:
    """(row_key, extra) with the new spans of a document in order of kind and start.

    Hexadecimal seeds are spans themselves; other tokens need a trusted pattern.
    """
    other = scanned.select("row_key", F.explode(F.filter("found", lambda f: f["kind"].isNull() | (f["kind"] == "secret"))).alias("f")).select("row_key", "f.*")
    by_pattern = other.where("kind is null").drop("kind").join(patterns.select("pattern", F.col("as_kind").alias("kind")), "pattern")
    spans = other.where("kind is not null").unionByName(by_pattern)
    return spans.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "stop"))).alias("extra"))


def find(docs: DataFrame, *, id_column: str = "doc_id") -> DataFrame:
    """doc_id, counts of the base kinds, base_spans and all spans (kind:start:end, joined).

    Spans count code points and their end is exclusive. Base kinds come first, in their order; of
    one kind the base spans come before those that patterns found. A span may have several kinds,
    and spans of different kinds may overlap. Null texts count as empty and have no spans. Rows
    that repeat are found each for itself and count as documents of their own for the patterns; a
    null id stays null. A text of any length is looked through as a whole. Where two kinds score
    alike in a pattern, the kind that comes later in the alphabet counts. Other columns are left
    out, and an empty table gives no rows.
    """
    scanned = scan(docs, id_column)
    extra = discovered(scanned, confident_patterns(scanned))
    as_text = F.transform("extra", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))

    def of_kind(spans, kind: str):
        return F.array_join(F.filter(spans, lambda s: s.startswith(f"{kind}:")), ",")

    named = [of_kind(as_text, k) for k in (*KINDS, "secret")]
    of_base = [of_kind(F.split("base_spans", ","), k) for k in KINDS]
    parts = [x for pair in zip([*of_base, F.lit("")], named, strict=True) for x in pair]
    merged = F.array_join(F.filter(F.array(*parts), lambda s: s != ""), ",")
    spans = F.when(F.col("extra").isNull(), F.col("base_spans")).otherwise(merged)
    return scanned.join(extra, "row_key", "left").select(F.col("k0").alias("doc_id"), *(f"n_{k}" for k in KINDS), "base_spans", spans.alias("spans"))


def redact_spans(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Replaces the spans by [KIND]; of overlapping ones the first to start covers the rest."""
    out, at = [], 0
    for a, b, kind in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b) if a < at else b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, *, text_column: str = "text") -> DataFrame:
    """The rows of documents with personal data in the text replaced; other columns as they are.

    A null text stays null, an empty one empty. Rows are never dropped, whatever repeats or is
    null, and columns keep their names, also where helpers have the same.
    Only documents with a token that the base kinds leave open are joined with what the patterns
    found; the rest are rewritten from their own row.
    """
    names, kinds = docs.columns, docs.dtypes
    at = names.index(text_column)
    scanned = scan(docs, *names)
    extra = discovered(scanned, confident_patterns(scanned))
    open_ones = F.exists("found", lambda f: f["kind"].isNull() | (f["kind"] == "secret"))
    columns = [f"k{i}" for i in range(len(names))]
    joined = scanned.where(open_ones).join(extra, "row_key", "left").select(*columns, "base_spans", "extra")
    plain = scanned.where(~open_ones).select(*columns, "base_spans", F.lit(None).cast(joined.schema["extra"].dataType).alias("extra"))

    def run(batches):
        for batch in batches:
            out = []
            for text, base, more in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist(), strict=True):
                spans = [(int(a), int(b), k) for k, a, b in (s.split(":") for s in base.split(",") if s)] + [(m["start"], m["stop"], m["kind"]) for m in more or ()]
                out.append(redact_spans(text, spans) if spans else text)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if i == at else batch.column(i) for i in range(len(names))], names=columns)

    done = plain.unionByName(joined).mapInArrow(run, ", ".join(f"k{i} {t}" for i, (_, t) in enumerate(kinds)))
    return done.toDF(*names)
