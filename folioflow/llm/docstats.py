"""Statistics of whole texts that the quality operators share."""

from __future__ import annotations

import math

import numpy as np

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Model inputs, all of them ratios or logarithms, so that they mean the same at any length.
FEATURES = ("log_words", "mean_word", "symbol_rate", "dup_line_share", "repeat_share", "upper_share", "distinct_share", "bare_share", "stop_rate", "bang_rate", "digit_share", "words_per_line")
REPEAT_WINDOW = 3


def repeated_words(ids: np.ndarray, size: int = REPEAT_WINDOW) -> int:
    """Words inside a window of `size` words that the text has at least twice."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    key = ids[:n].astype(np.int64)
    for k in range(1, size):
        # ranks stay below the text's length, so the products stay in range at any length
        if k > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * (len(ids) + 1) + ids[k : k + n]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.zeros(len(ids) + 1, dtype=np.int64)
    hit = np.flatnonzero(count[back] > 1)
    np.add.at(starts, hit, 1)
    np.add.at(starts, hit + size, -1)
    return int(np.count_nonzero(np.cumsum(starts[:-1])))


def statistics(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """(the base counts, the features) of a text; null counts as empty, which has all zeros."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    n_white = sum(text.count(c) for c in WHITE)
    chars = len(text) - n_white
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=n)
    repeat = repeated_words(ids)
    base = (n, chars, symbols, dup, repeat)
    if not n:
        return base, (0.0,) * len(FEATURES)
    letters = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    upper = int(np.count_nonzero((letters >= 65) & (letters <= 90)))
    lower = int(np.count_nonzero((letters >= 97) & (letters <= 122)))
    digits = int(np.count_nonzero((letters >= 48) & (letters <= 57)))
    bare = words.count(b"|") + words.count(b"-")
    return base, (
        math.log1p(n), chars / n, symbols / n, dup / lines, repeat / n, upper / max(1, upper + lower), len(index) / n ** 0.9, bare / n,
        (text.count(".") + text.count("?")) / n, text.count("!") / n, digits / chars, math.log1p(n / lines),
    )
