"""URL filter: fixed rules first, then a tree of path templates per host. DataFrame code only.

Template tree. A path's segments are generalised by their shape: numbers, hexadecimal ids and other
segments with many digits become wildcards. The tree's nodes are the beginnings of these paths, with
the labels of the pages below. Branches are merged unless labels tell them apart:

1. A node stands out by itself if its labelled rate differs from that of the rest of its parent (a
   likelihood-ratio test, sharpened by the number of siblings that are tried).
2. Siblings that are too small for that are merged with each other: half of the labels picks those
   that look bad, the other half tells what they are like, and the same the other way round. If the
   picked ones then differ from the others, each sibling joins the side that its labels are likelier
   under. Labels never judge a choice that they have made, so noise makes no branch.
3. All other nodes are merged with their parent, and their segments become wildcards.

A page has the counts of the deepest node on its way that stands out, or of its host. It is blocked
when the smoothed purity of these labels, drawn to the host's and the corpus's rate, reaches a limit.

Every step aggregates rows before they are shuffled. Only labelled branches make nodes, and only
paths below rejected branches are looked up for the pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bounded, materialise

#: Pseudo-labels at the host's rate, the rejecting purity, and the test's z value.
PRIOR, REJECT, Z = 10.0, 0.5, 2.0
#: Pages of one path from which on its row is broadcast instead of shuffled to them.
HOT_PATH = 1_000_000
#: Rows with a host and digests that may be broadcast: under 64 MB.
FEW = 250_000
ANY = "*"


def host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null or no ://."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ? or # or the end; empty for null or no ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule (its text, as in "example.net/en/") that fits, else null.

    A rule is host and path prefix; it fits the host and its subdomains. Rules are a bounded
    list and become one CASE expression, longest first.
    """
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{rest}")
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def shape(segment: Column) -> Column:
    """A segment with what varies in it replaced: its static generalisation."""
    bare = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}\z", "")
    return (
        F.when(bare.rlike(r"\A[0-9]+\z"), F.lit("{n}"))
        .when(bare.rlike(r"\A(?=.*[0-9])[0-9a-fA-F-]{8,}\z"), F.lit("{x}"))
        .when(bare.rlike(r"[0-9]{3}|[0-9].*[0-9].*[0-9]") | (F.length(bare) > 40), F.lit(ANY))
        .otherwise(bare)
    )


def shapes(path: Column) -> Column:
    """The shapes of the non-empty segments."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), shape)


def _fit(bad: Column, labelled: Column) -> Column:
    """The log-likelihood of labels at their own rate."""
    def part(k):
        return F.when(k > 0, k * F.log(k / F.nullif(labelled, F.lit(0)))).otherwise(0.0)

    return part(bad) + part(labelled - bad)


def stands_out(bad: Column, labelled: Column, node_bad: Column, node_labelled: Column, tested: Column, z: float = Z) -> Column:
    """Whether a child's labelled rate differs from that of the rest of its node.

    A two-proportion test by likelihood ratio, which holds for few labels too. The level is that
    of z for one child; as the `tested` children of a node are tried, it is sharpened by their
    number, so a single label among many is too few to tell.
    """
    apart = _fit(bad, labelled) + _fit(node_bad - bad, node_labelled - labelled)
    return 2 * (apart - _fit(node_bad, node_labelled)) > z * z + 2 * F.log(F.greatest(tested, F.lit(1)))


def chain(shapes: Column) -> Column:
    """Digests of all beginnings of a path, each made from the one before: memory is linear in the path."""
    first = F.array(F.lit("").cast("string"))
    return F.aggregate(shapes, first, lambda acc, x: F.concat(acc, F.array(F.md5(F.concat(F.element_at(acc, -1), F.lit("/"), x).cast("binary")))))


def path_key(shapes: Column) -> Column:
    """A digest that stands for the shapes of a path."""
    return F.md5(F.array_join(shapes, "/").cast("binary"))


COUNTS = ("labelled", "bad", "labelled0", "bad0")


def paths(pages: DataFrame) -> DataFrame:
    """(host, key, shapes, pages, and COUNTS) from (host, path, bad: 1, 0 or null, half: 0 or 1)."""
    first = F.col("half") == 0
    counts = F.count("bad"), F.coalesce(F.sum("bad"), F.lit(0)), F.count(F.when(first, F.col("bad"))), F.coalesce(F.sum(F.when(first, F.col("bad"))), F.lit(0))
    counted = pages.groupBy("host", shapes(F.col("path")).alias("shapes")).agg(F.count("*").alias("pages"), *(c.alias(n) for c, n in zip(counts, COUNTS, strict=True)))
    return materialise(counted.select("host", path_key(F.col("shapes")).alias("key"), "shapes", "pages", *COUNTS))


def nodes(tree: DataFrame) -> DataFrame:
    """(host, node, parent, depth, and COUNTS) of all beginnings of labelled paths; a root has no parent."""
    ways = tree.where("labelled > 0").select("host", F.col("shapes"), *COUNTS).withColumn("chain", chain(F.col("shapes")))
    steps = ways.select("host", "chain", F.explode(F.sequence(F.lit(0), F.size("chain") - 1)).alias("depth"), *COUNTS)
    parent = F.when(F.col("depth") > 0, F.get("chain", F.col("depth") - 1))
    each = steps.select("host", F.get("chain", "depth").alias("node"), parent.alias("parent"), "depth", *COUNTS)
    return materialise(each.groupBy("host", "node", "parent", "depth").agg(*(F.sum(c).alias(c) for c in COUNTS)))


def alone(found: DataFrame, z: float = Z) -> DataFrame:
    """The children of `nodes` with `apart`: whether each stands out from its parent by itself."""
    child = found.where("parent is not null")
    tested = child.groupBy("host", "parent").agg(F.count("*").alias("tested"))
    above = found.select("host", F.col("node").alias("parent"), F.col("labelled").alias("node_labelled"), F.col("bad").alias("node_bad"))
    told = child.join(bounded(materialise(tested.join(above, ["host", "parent"])), FEW), ["host", "parent"])
    apart = stands_out(F.col("bad"), F.col("labelled"), F.col("node_bad"), F.col("node_labelled"), F.col("tested"), z)
    return materialise(told.select("host", "node", "parent", "depth", *COUNTS, apart.alias("apart")))


def _rate(bad: Column, labelled: Column) -> Column:
    return bad / F.nullif(labelled, F.lit(0))


def sides(children: DataFrame, z: float = Z) -> DataFrame:
    """(host, node, depth, labelled, bad) of siblings that are merged into two sides of their parent.

    From (host, node, parent, depth, COUNTS) of nodes that do not stand out alone. The counts are
    those of the node's side, made of labels that had no part in picking it.
    """
    halves = children.withColumns({"labelled1": F.col("labelled") - F.col("labelled0"), "bad1": F.col("bad") - F.col("bad0")})
    pool = halves.groupBy("host", "parent").agg(*(F.sum(c).alias(f"all_{c}") for c in ("labelled0", "bad0", "labelled1", "bad1")), F.count("*").alias("siblings")).where("siblings > 1")
    told = halves.join(bounded(materialise(pool), FEW), ["host", "parent"])

    def honest(high: bool, what: str) -> Column:
        out = F.lit(0)
        for own, other in ((0, 1), (1, 0)):
            over = _rate(F.col(f"bad{own}"), F.col(f"labelled{own}")) > _rate(F.col(f"all_bad{own}"), F.col(f"all_labelled{own}"))
            out = out + F.coalesce(F.sum(F.when(over if high else ~over, F.col(f"{what}{other}"))), F.lit(0))
        return out

    split = told.groupBy("host", "parent").agg(honest(True, "labelled").alias("high_labelled"), honest(True, "bad").alias("high_bad"), honest(False, "labelled").alias("low_labelled"), honest(False, "bad").alias("low_bad"))
    high, low = ((F.col(f"{k}_bad") + 0.5) / (F.col(f"{k}_labelled") + 1) for k in ("high", "low"))
    both = (F.col("high_bad") + F.col("low_bad"), F.col("high_labelled") + F.col("low_labelled"))
    real = split.where((F.col("high_labelled") > 0) & (F.col("low_labelled") > 0) & (high > low) & stands_out(F.col("high_bad"), F.col("high_labelled"), *both, F.lit(1), z))
    joined = children.join(bounded(materialise(real), FEW), ["host", "parent"])
    likelier = F.col("bad") * F.log(high / low) + (F.col("labelled") - F.col("bad")) * F.log((1 - high) / (1 - low)) > 0
    return joined.select("host", "node", "depth", *(F.when(likelier, F.col(f"high_{c}")).otherwise(F.col(f"low_{c}")).alias(c) for c in ("labelled", "bad")))


def branches(tree: DataFrame, *, prior: float = PRIOR, reject: float = REJECT, z: float = Z) -> DataFrame:
    """(host, node, depth, purity, rejected): the nodes that stand out, and the roots of all hosts with labels."""
    found = nodes(tree)
    tested = alone(found, z)
    own = tested.where("apart").select("host", "node", "depth", "labelled", "bad")
    roots = found.where("parent is null").select("host", "node", "depth", "labelled", "bad")
    marks = own.unionByName(sides(tested.where("not apart").drop("apart"), z)).unionByName(roots)
    whole = roots.agg(F.sum("bad").alias("all_bad"), F.sum("labelled").alias("all_labelled"))
    by_host = roots.select("host", F.col("labelled").alias("host_labelled"), F.col("bad").alias("host_bad"))
    # one row for the corpus: a single aggregate, so its broadcast has a fixed size
    rows = marks.join(bounded(by_host, FEW), "host").join(F.broadcast(whole))
    base = F.coalesce(_rate(F.col("all_bad"), F.col("all_labelled")), F.lit(0.0))
    host_rate = (F.col("host_bad") + prior * base) / (F.col("host_labelled") + prior)
    purity = (F.col("bad") + prior * host_rate) / (F.col("labelled") + prior)
    return materialise(rows.select("host", "node", "depth", purity.alias("purity"), (purity >= reject).alias("rejected")))


def rejected_paths(tree: DataFrame, marks: DataFrame) -> DataFrame:
    """(host, key, pages, template) of the paths whose deepest mark is rejected."""
    hosts = bounded(materialise(marks.where("rejected").select("host").distinct()), FEW)
    ways = tree.join(hosts, "host", "left_semi").select("host", "key", "pages", "shapes", F.posexplode(chain(F.col("shapes"))).alias("depth", "node"))
    on_way = ways.join(bounded(marks.select("host", "node", "rejected"), FEW), ["host", "node"])
    last = on_way.groupBy("host", "key").agg(F.max_by(F.struct("rejected", "pages", "shapes", "depth"), "depth").alias("x")).select("host", "key", "x.*").where("rejected")
    kept, rest = F.slice("shapes", F.lit(1), F.col("depth")), F.size("shapes") - F.col("depth")
    wild = F.transform(F.slice("shapes", F.col("depth") + 1, F.greatest(rest, F.lit(0))), lambda _: F.lit(ANY))
    return materialise(last.select("host", "key", "pages", F.concat(F.lit("/"), F.array_join(F.concat(kept, wild), "/")).alias("template")))


def _looked_up(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with `template` of the paths that `found` has, else null.

    Few paths are broadcast. Of many, those with many pages are, whose number is bounded by the
    pages over HOT_PATH, and the rest are joined by host and key.
    """
    short = found.select("host", "key", "template")
    if found.limit(FEW + 1).count() <= FEW:
        return rows.join(F.broadcast(short), ["host", "key"], "left")
    hot = bounded(found.where(F.col("pages") > HOT_PATH).select("host", "key", "template"), FEW)
    return rows.join(hot, ["host", "key"]).unionByName(rows.join(hot, ["host", "key"], "left_anti").join(short, ["host", "key"], "left"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], labels: DataFrame | None = None, *, key: str = "page_id", url: str = "url", prior: float = PRIOR, reject: float = REJECT) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, template.

    `rules` are (host and path prefix, block or allow). `labels` is (doc_id, bad: 1 or 0) for the
    documents whose number is the last number of a path; without it every page is allowed.
    `template` is that of the rejected branch a page belongs to, else null. A null url has an empty
    host and path and its host's verdict. Keys may repeat or be null, and each row is judged. Paths
    of any length count with all their segments. At a tie of purity and limit a branch is rejected.
    Other columns are ignored, whatever their names. An empty table gives no rows; without labels
    nothing is rejected by the method.
    """
    verdicts = F.lit(None).cast("string")
    for rule, verdict in rules:
        verdicts = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(verdicts)
    base = pages.select(F.col(key).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    base = base.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    rows = base.withColumn("key", path_key(shapes(F.col("path"))))
    if labels is None:
        out = rows.withColumn("template", F.lit(None).cast("string"))
    else:
        number = F.regexp_extract("path", r"([0-9]{1,18})(?:\.[A-Za-z]{1,5})?/*\z", 1)
        known = materialise(labels.select("doc_id", "bad").dropna().where("doc_id >= 0").groupBy("doc_id").agg(F.max("bad").alias("bad")))
        # a cryptographic digest: sums such as CRC-32 put neighbouring numbers in the same half
        half = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % 2
        # paths without a number get keys below zero, so they spread and match nothing
        spread = F.lit(-1) - F.pmod(F.xxhash64("page_id", "path"), F.lit(1 << 40))
        labelled = base.withColumn("doc_id", F.coalesce(number.try_cast("bigint"), spread)).join(bounded(known, FEW), "doc_id", "left").withColumn("half", half)
        tree = paths(labelled.select("host", "path", "bad", "half"))
        out = _looked_up(rows, rejected_paths(tree, branches(tree, prior=prior, reject=reject)))
    method = F.when(F.col("template").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce(verdicts, method).alias("verdict"), "template")
