"""Fill-in-middle transformation in Spark's own functions.

A text's units are its lines. Two cuts, drawn from a digest of the row's id, part the units into
prefix, middle and suffix, which are put together in one of two arrangements behind sentinels:

    psm  <P> prefix <S> suffix <M> middle
    spm  <S> suffix <P> prefix <M> middle

A text that holds a sentinel itself, or is empty, stays plain, so that an arrangement can always
be taken apart again: no sentinel can come about where a part meets a sentinel, since `<` begins
every one of them and occurs nowhere else in it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

#: A line with its end, or what follows the last one.
UNIT = r"[^\n]*\n|[^\n]+"


@dataclass(frozen=True)
class Recipe:
    """Seed of the cuts, percentages of arranged texts and of spm among them, sentinels."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def _number(digest: Column, group: int) -> Column:
    """The group of 8 hexadecimal digits as an unsigned integer."""
    return F.conv(F.substring(digest, 1 + 8 * group, 8), 16, 10).cast("long")


def arrange(docs: DataFrame, recipe: Recipe = Recipe(), *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows and columns, with a struct column `fim` (n, form, prefix_chars, middle_chars, output).

    Null and empty texts have no units and a plain, empty output. A null id counts as an empty
    one. Equal rows have equal results, whatever the other columns hold; a column named `fim`
    is replaced. A text of any length is one row and is never cut short. No row, no result.
    """
    text, units, low, high, h = (free_name(docs, n) for n in ("_text", "_units", "_low", "_high", "_h"))
    digest = F.sha2(F.concat(F.lit(f"{recipe.seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary"), 256)
    rows = docs.withColumns({text: F.coalesce(F.col(text_column).cast("string"), F.lit("")), h: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda g: _number(digest, g))})
    rows = rows.withColumn(units, F.regexp_extract_all(F.col(text), F.lit(UNIT), F.lit(0)))
    n = F.size(units)
    first, second = ((F.col(h)[i] % (n + 1)).cast("int") for i in (0, 1))
    rows = rows.withColumns({low: F.least(first, second), high: F.greatest(first, second)})

    def part(start: Column, end: Column) -> Column:
        return F.array_join(F.slice(units, start + 1, end - start), "")

    held = F.lit(False)
    for sentinel in (recipe.prefix, recipe.suffix, recipe.middle):
        held = held | F.contains(F.col(text), F.lit(sentinel))
    plain = (F.col(text) == "") | held | (F.col(h)[2] % 100 >= recipe.rate)
    form = F.when(plain, "plain").when(F.col(h)[3] % 100 < recipe.spm, "spm").otherwise("psm")
    parts = F.struct(part(F.lit(0), F.col(low)).alias("prefix"), part(F.col(low), F.col(high)).alias("middle"), part(F.col(high), n).alias("suffix"))
    made, shape = free_name(rows, "_made"), free_name(rows, "_form")
    rows = rows.withColumn(shape, form).withColumn(made, F.when(F.col(shape) != "plain", parts))
    p, m, s = (F.col(f"{made}.{k}") for k in ("prefix", "middle", "suffix"))
    psm = F.concat(F.lit(recipe.prefix), p, F.lit(recipe.suffix), s, F.lit(recipe.middle), m)
    spm = F.concat(F.lit(recipe.suffix), s, F.lit(recipe.prefix), p, F.lit(recipe.middle), m)
    output = F.when(F.col(shape) == "psm", psm).when(F.col(shape) == "spm", spm).otherwise(F.col(text))
    fim = F.struct(n.cast("long").alias("n"), F.col(shape).alias("form"), F.length(p).cast("long").alias("prefix_chars"), F.length(m).cast("long").alias("middle_chars"), output.alias("output"))
    return rows.select(*(docs[c] for c in docs.columns if c.lower() != "fim"), fim.alias("fim"))


def restore(output: Column, form: Column, recipe: Recipe = Recipe()) -> Column:
    """The text that `arrange` was given, from its output and form alone; a null text is empty."""
    either = "|".join(rf"\Q{s}\E" for s in (recipe.prefix, recipe.suffix, recipe.middle))
    cut = F.split(output, either, -1)
    psm, spm = F.concat(F.get(cut, F.lit(1)), F.get(cut, F.lit(3)), F.get(cut, F.lit(2))), F.concat(F.get(cut, F.lit(2)), F.get(cut, F.lit(3)), F.get(cut, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
