"""Vectorised word hashing for Arrow batches.

Words are the maximal runs of bytes other than U+0020 and U+0009-U+000D. In UTF-8 those six
bytes never occur inside a longer character, so splitting bytes and splitting code points give
the same words. All functions work on a chunk of texts at a time and need memory in proportion
to the chunk, never to the corpus.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that every input bit reaches every output bit."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, at least n of each."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of every text in order, offsets of the texts in it: len(texts)+1)."""
    joined = b" ".join(texts) + b" "
    buf = np.frombuffer(joined, dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    ends_of_texts = np.cumsum(lengths)
    is_word = np.zeros(len(buf) + 2, dtype=np.int8)
    is_word[1:-1] = ~_SPACE[buf]
    edge = np.diff(is_word)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power_tables(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=prefix[1:])
    hashes = mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    offsets[1:] = np.searchsorted(start, ends_of_texts)
    return hashes, offsets


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the concatenation of two sequences that are given by their hashes."""
    return mix(left * _BASE + right + _M1)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` words; entry p is the run that starts at p.

    A run is joined from runs of half its length, as many doublings as the size has bits, so
    equal word sequences get equal hashes wherever they stand. Runs across two texts are
    included; callers mask them out with `valid_starts`.
    """
    power, length, have = words, 1, None
    have_length = 0
    n = size
    while n:
        if n & 1:
            if have is None:
                have, have_length = power, length
            else:
                keep = max(0, len(words) - have_length - length + 1)
                have = join_hashes(have[:keep], power[have_length : have_length + keep])
                have_length += length
        n >>= 1
        if n:
            keep = max(0, len(words) - 2 * length + 1)
            power = join_hashes(power[:keep], power[length : length + keep])
            length *= 2
    return have


def valid_starts(offsets: np.ndarray, size: int, total: int) -> np.ndarray:
    """Positions at which a run of `size` words lies inside one text, as a mask over total-size+1."""
    n = max(0, total - size + 1)
    ok = np.ones(n, dtype=bool)
    for back in range(1, size):
        at = offsets[1:-1] - back
        at = at[(at >= 0) & (at < n)]
        ok[at] = False
    return ok


def chunks(texts: Iterable[bytes], limit: int = 1 << 21) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts) with about `limit` bytes; a longer text stands alone."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        if held and size + len(t) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(t)
        size += len(t) + 1
    if held:
        yield first, held
