"""Compatibility fold of text for ASCII words, inside the JVM.

`fold` gives a text whose runs of a-z are those of the text's lower-cased NFKC form, which is all
that word sets look at. Its tables come from Python's Unicode data when a plan is made:

1. Characters that stand for one ASCII letter (full-width, mathematical, long s ...) are translated.
2. Those that stand for several (ligatures, unit signs, Roman numbers ...) are replaced, in texts
   that have any.
3. An ASCII letter that composes with a mark behind it is no ASCII letter in NFKC. It composes if,
   of the marks of some combining class that follow it, the first one has a composite with it.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stands in the place of a letter that has become part of a composite.
COMPOSED = "�"
#: A mark, also one that is newer than the JVM's Unicode data.
MARK = r"[\p{M}\p{Cn}]"
#: ASCII characters that are no letters. Nothing on one side of them changes what letters are on the other.
BREAK = r"[\x00-@\[-`{-\x7F]+"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


@cache
def _tables() -> tuple[dict[str, str], dict[str, str]]:
    """(single, several): what characters become that stand for ASCII letters or for other marks."""
    single, several = {}, {}
    for point in range(0x80, 0x110000):
        c = chr(point)
        n = unicodedata.normalize("NFKC", c)
        if n != c and (any(x in LETTERS for x in n) or all(unicodedata.combining(x) for x in n)):
            (single if len(n) == 1 else several)[c] = n
    # apart from its dot it composes with marks below it, and it is the one composite that lower-cases to an ASCII letter
    several["\u0130"] = "I\u0307"
    return single, several


def _class(characters: list[str]) -> str:
    """The characters as a class of a pattern, in ranges."""
    points, out = sorted(map(ord, characters)), []
    for p in points:
        if out and out[-1][1] == p - 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return "[" + "".join(f"\\x{{{a:X}}}" + (f"-\\x{{{b:X}}}" if b > a else "") for a, b in out) + "]"


@cache
def _composing() -> str:
    """A pattern of the ASCII letters that compose with a mark behind them."""
    marks = defaultdict(list)
    for point in range(0x80, 0x110000):
        if kind := unicodedata.combining(chr(point)):
            marks[kind].append(chr(point))
    every = [m for found in marks.values() for m in found]
    direct, behind = [], []
    for kind, found in sorted(marks.items(), key=lambda x: -len(x[1])):  # the commonest marks first
        by_letters = defaultdict(list)
        for m in found:
            # the capital with a dot above is one small letter and that dot again when it is lowered
            letters = "".join(x for x in LETTERS if len(unicodedata.normalize("NFKC", x + m)) == 1 and (x, m) != ("I", "̇"))
            if letters:
                by_letters[letters].append(m)
        others = _class([m for m in every if unicodedata.combining(m) != kind])
        for letters, own in sorted(by_letters.items(), key=lambda x: (-len(x[0]), x[0])):
            direct.append(f"[{letters}](?={_class(own)})")
            behind.append(f"[{letters}](?={others}++{_class(own)})")
    # looks at the next characters first: most letters have no mark behind them, most others have one
    return f"(?=[A-Za-z]{MARK})(?:{'|'.join(direct)}|(?=.{MARK}{{2}})(?:{'|'.join(behind)}))"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value made once however often `then` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def fold(text: Column) -> Column:
    single, several = _tables()
    table = F.create_map(*(F.lit(x) for pair in several.items() for x in pair))

    def spelt(one: Column) -> Column:
        # a look into the table for each different character only
        found = F.array_distinct(F.regexp_extract_all(one, F.lit(r"(?=[^\x00-\x7F])" + _class(list(several))), F.lit(0)))
        return F.aggregate(found, one, lambda so_far, c: F.replace(so_far, c, table[c]))

    def parted(two: Column) -> Column:
        return F.when(two.rlike(f"[A-Za-z]{MARK}"), F.regexp_replace(two, _composing(), COMPOSED)).otherwise(two)

    done = _let(F.translate(text, "".join(single), "".join(single.values())), lambda one: _let(spelt(one), parted))
    # most texts are ASCII or nearly so; only others need any of this
    return F.lower(F.when(text.rlike(r"[^\x00-\x7F]"), done).otherwise(text))


def words(text: Column) -> Column:
    """The words of `text.word_set(fold(text))`. Only pieces with other than ASCII characters are folded, each once."""

    def parts(pieces: Column) -> Column:
        ascii = F.filter(pieces, lambda p: F.octet_length(p) == F.char_length(p))
        others = F.filter(pieces, lambda p: F.octet_length(p) > F.char_length(p))
        folded = F.split(fold(F.array_join(others, " ")), "[^a-z]+")
        return F.array_remove(F.array_union(F.split(F.lower(F.array_join(ascii, " ")), " "), folded), "")

    return _let(F.array_distinct(F.split(text, BREAK)), parts)
