"""Text functions on columns. They stay in the JVM; patterns use Unix lines and Unicode digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST_LETTERS, LONG_WORD, LEAST_ABSTRACT_WORDS, LEAST_OVERLAP = 100, 5, 20, 0.6

# Headings that start a reference list, headings that end it, and captions.
REFERENCES = (
    r"^[ \t]*(?:\p{Nd}+(?:\.\p{Nd}+)*[.)]?[ \t]+)?(?:REFERENCES|References|BIBLIOGRAPHY|Bibliography|WORKS CITED|Works Cited|"
    r"LITERATURE CITED|Literature Cited|REFERENCE LIST|Reference List)[ \t]*$"
)
RESUME = r"^[ \t]*(?:APPENDIX|Appendix|ACKNOWLEDG|Acknowledg|(?:Online |Materials and )?Methods[ \t]*$|(?:MATERIALS AND )?METHODS[ \t]*$)"
CAPTION = r"^[ \t]*(?:Fig(?:ure|\.)|FIG(?:URE|\.)|Table|TABLE)[ \t]*\p{Nd}"


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def strip_right(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+\z", "")


def normalise_white(text: Column) -> Column:
    """Runs of spaces and tabs to one space, no space at a line's end, at most one empty line."""
    text = F.regexp_replace(text, r"[ \t]+", " ")
    text = F.regexp_replace(text, r"(?md) +$", "")
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]", ""))


def word_set(text: Column) -> Column:
    """Distinct runs of a-z in the lower-cased text; `fold.words` gives those of texts that may hold ligatures."""
    return F.array_distinct(F.array_remove(F.split(F.lower(text), r"[^a-z]+"), ""))


def overlap(abstract: Column, text: Column) -> Column:
    """Share of the abstract's long words that the text has; null with too few to judge."""
    long = F.filter(word_set(abstract), lambda w: F.length(w) >= LONG_WORD)
    return F.when(F.size(long) >= LEAST_ABSTRACT_WORDS, F.size(F.array_intersect(long, word_set(text))) / F.size(long))


def two_decimals(value: Column) -> Column:
    """A share from 0 to 1 with two decimals, rounded as the exact binary value is.

    Only values half-way between two hundredths are doubtful: whether the double that is nearest to
    such a value lies above or below it is looked up among the hundred that there are.
    """
    up = [k for k in range(100) if f"{(2 * k + 1) / 200:.2f}" == f"{(k + 1) / 100:.2f}"]
    low = F.floor(value * 100)
    rest = value * 100 - low
    half = F.abs(rest - 0.5) < 1e-9
    hundredths = F.when(half, low + F.when(low.isin(up), 1).otherwise(0)).otherwise(F.floor(value * 100 + 0.5))
    return F.concat((hundredths / 100).cast("int").cast("string"), F.lit("."), F.lpad((hundredths % 100).cast("string"), 2, "0"))


def first_offset(text: Column, pattern: str) -> Column:
    """Code points before the first match; null without one."""
    return F.when(text.rlike(f"(?md){pattern}"), F.length(F.regexp_extract(text, rf"(?smd)\A(.*?){pattern}", 1)))


def last_offset(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(f"(?md){pattern}"), F.length(F.regexp_extract(text, rf"(?smd)\A(.*){pattern}", 1)))


def table_cell(text: Column) -> Column:
    """One line without the column separator."""
    return F.replace(strip(F.regexp_replace(text, r"(?U)\s+", " ")), F.lit("|"), F.lit("/"))


def decision(include: Column, basis: Column) -> Column:
    return F.when(F.size(basis) > 0, F.concat(include, F.lit(" ("), F.array_join(basis, ", "), F.lit(")"))).otherwise(include)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def evaluation_key(pdf_sha256: Column, model: str, effort: str, pipeline: str, prompt_sha256: str) -> Column:
    """Hash of every input that can change a result: a JSON object with sorted keys."""
    plain = F.concat(
        F.lit(f'{{"model": "{model}", "pdf_sha256": "'), pdf_sha256,
        F.lit(f'", "pipeline_version": "{pipeline}", "prompt_sha256": "{prompt_sha256}", "reasoning_effort": "{effort}"}}'),
    )
    return F.sha2(plain, 256)
