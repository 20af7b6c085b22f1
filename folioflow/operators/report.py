"""The report as rows: section, order, line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from . import resultlog

# The headings and titles that readers of the report look for; {n} is a number of rows.
TITLE = "# Paper classification report"
REVIEW = "## To review: YES or UNCERTAIN, not in `{library}` ({n})"
MISSING = "## No PDF, not classified ({n})"
FAILED = "## Could not be classified ({n})"
REVIEW_TABLE = ["| Paper | Decision | Evidence |", "|---|---|---|"]
MISSING_TABLE = ["| Paper | Why | Save the PDF as |", "|---|---|---|"]
FAILED_TABLE = ["| Paper | Error |", "|---|---|"]
ACCURACY_TABLE = ["| Include correct | Include incorrect | Failed | Basis exact match |", "|---:|---:|---:|---:|"]
PAPER_TABLE = ["| Paper | Expected | Predicted | Basis | Status |", "|---|---|---|---|---|"]


def _numbered(one: DataFrame, section: int, first: int, items: list[Column]) -> DataFrame:
    """A one-row table's lines in order, from the given position on."""
    rows = F.array(*(F.struct(F.lit(first + k).cast("long").alias("ord"), x.alias("line")) for k, x in enumerate(items)))
    return one.select(F.explode(rows).alias("x")).select(F.lit(section).alias("section"), "x.ord", "x.line")


def _section(section: int, titles: list[str], rows: DataFrame, heading: str | None = None, always: bool = False) -> DataFrame:
    """The rows (ord, line) below a blank line, a heading and a table's titles.

    A section without rows is left out unless it is always told.
    """
    n = rows.agg(F.count("*").alias("n"))  # one row
    top = ["", *([heading, ""] if heading else []), *titles]
    lines = [F.replace(F.lit(x), F.lit("{n}"), F.col("n").cast("string")) for x in top]
    return _numbered(n if always else n.where("n > 0"), section, -len(top), lines).unionByName(rows.select(F.lit(section).alias("section"), "ord", "line"))


def _link() -> Column:
    return F.concat(F.lit("["), F.col("id"), F.lit("]("), U.record_link(F.col("id")), F.lit(")"))


def lines(results: DataFrame, model: str, effort: str, prompt_version: str, prompt_sha256: str, queue: DataFrame | None = None) -> DataFrame:
    """Title, counts and configuration. The counts are one row; papers are never gathered."""
    one = resultlog.summary(results).crossJoin(results.agg(F.count("*").alias("n")))  # one row each
    counts = [("- Results: ", "n", " papers"), ("- Positive: ", "positive", ""), ("- Negative: ", "negative", ""), ("- Uncertain: ", "uncertain", ""), ("- Failed: ", "failed", "")]
    if queue is not None:
        one = one.crossJoin(queue.agg(F.count("*").alias("missing")))
        counts.append(("- No PDF, not classified: ", "missing", ""))
    told = [F.concat(F.lit(a), F.col(c).cast("string"), F.lit(b)) for a, c, b in counts]
    fixed = [f"- Model: `{model}`, reasoning effort `{effort}`", f"- Prompt: `{prompt_version}`, SHA-256 `{prompt_sha256}`"]
    return _numbered(one, 1, 0, [F.lit(TITLE), F.lit(""), *told, *map(F.lit, fixed)])


def review_lines(results: DataFrame, library: DataFrame, name: str) -> DataFrame:
    """Papers to review: YES or UNCERTAIN and not in the library. Needs a column `evidence`."""
    cited = T.table_cell(F.array_join(F.transform("evidence", lambda e: F.concat(F.lit("p"), e["page"].cast("string"), F.lit(": "), e["reason"])), "; "))
    line = F.concat(F.lit("| "), _link(), F.lit(" | "), T.decision(F.col("include"), F.col("basis")), F.lit(" | "), F.coalesce(cited, F.lit("")), F.lit(" |"))
    rows = resultlog.review(results, library).select(F.col("first_seq").alias("ord"), line.alias("line"))
    return _section(2, REVIEW_TABLE, rows, REVIEW.replace("{library}", name), always=True)


def review_links(results: DataFrame, library: DataFrame) -> DataFrame:
    """The same papers as links with their decisions, one a line."""
    line = F.concat(U.record_link(F.col("id")), F.lit("  # "), T.decision(F.col("include"), F.col("basis")))
    return resultlog.review(results, library).select(F.lit(0).alias("section"), F.col("first_seq").alias("ord"), line.alias("line"))


def missing_lines(queue: DataFrame) -> DataFrame:
    """Papers without a file: (id, category, errors, target); repeated errors are told once."""
    why = T.table_cell(F.array_join(F.array_distinct("errors"), "; "))
    line = F.concat(F.lit("| "), _link(), F.lit(" | "), F.col("category"), F.lit(": "), why, F.lit(" | `"), F.col("target"), F.lit("` |"))
    return _section(3, MISSING_TABLE, queue.select(F.lit(0).cast("long").alias("ord"), line.alias("line")), MISSING)


def failure_lines(results: DataFrame) -> DataFrame:
    """Papers that could not be classified, with their last error. Needs a column `errors`."""
    line = F.concat(F.lit("| `"), F.col("id"), F.lit("` | "), T.table_cell(F.element_at("errors", -1)), F.lit(" |"))
    return _section(4, FAILED_TABLE, results.where("not ok").select(F.col("first_seq").alias("ord"), line.alias("line")), FAILED)


def accuracy_lines(results: DataFrame) -> DataFrame:
    """The scores against labels, as one row; nothing where no result has a label."""
    line = F.format_string("| %d | %d | %d | %d of %d |", "correct", "incorrect", "failed", "basis_matches", "classified")
    scored = resultlog.accuracy(results).where("correct + incorrect + failed > 0")
    return _section(5, ACCURACY_TABLE, scored.select(F.lit(0).cast("long").alias("ord"), line.alias("line")))


def paper_lines(results: DataFrame) -> DataFrame:
    """One row a paper: its label if it has one, and what was decided."""
    expected = F.lit("-")
    if "expected_include" in results.columns:
        expected = F.coalesce(T.decision(F.col("expected_include"), F.col("expected_basis")), expected)
    basis = F.when(F.col("ok") & (F.size("basis") > 0), F.array_join("basis", ", ")).otherwise("-")
    cells = [F.concat(F.lit("`"), "id", F.lit("`")), expected, F.when(F.col("ok"), F.col("include")).otherwise("-"), basis, F.when(F.col("ok"), "CLASSIFIED").otherwise("PROCESSING_FAILED")]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    return _section(6, PAPER_TABLE, results.select(F.col("first_seq").alias("ord"), line.alias("line")), always=True)


def full(results: DataFrame, model: str, effort: str, prompt_version: str, prompt_sha256: str, *, library: DataFrame | None = None, library_name: str = "library", queue: DataFrame | None = None) -> DataFrame:
    """All sections in their order; those of a library, a queue or labels only where these are given."""
    parts = [lines(results, model, effort, prompt_version, prompt_sha256, queue)]
    if library is not None:
        parts.append(review_lines(results, library, library_name))
    if queue is not None:
        parts.append(missing_lines(queue))
    parts.append(failure_lines(results))
    if "expected_include" in results.columns:
        parts.append(accuracy_lines(results))
    out = parts[0]
    for part in [*parts[1:], paper_lines(results)]:
        out = out.unionByName(part)
    return out


def write(report: DataFrame, path: str) -> None:
    """The lines as text files that are in order by name; rows of equal order by their text."""
    report.orderBy("section", "ord", "line").select("line").write.mode("overwrite").text(path)
