"""Encoding with a public tokenizer, piece by piece.

The tokenizer lower-cases a text and cuts it into pieces, runs of letters, single digits and
runs of other signs, and a text's ids are those of its pieces one after the other. Here a batch
is lower-cased and cut as bytes, in its Arrow buffer, and brought to distinct pieces there; only
those become Python strings. Running text repeats most of its pieces, so their ids are kept in a
bounded store and only a new one goes to the tokenizer's model. That holds for ASCII and the
Latin letters up to U+012F. A chunk between white space that holds anything else, an apostrophe
or the start of a special token is one piece, which goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa

#: Pieces kept at once and the longest that is kept, in bytes: under 200 MB in a worker.
KEPT_PIECES, KEPT_BYTES = 500_000, 48

# Kinds of bytes: white space that no piece crosses, letters (with both bytes of the letters from
# U+00C0 to U+012F), digits, other ASCII signs, and all that makes a chunk one whole piece.
_WHITE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, dtype=np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[[0x20, 0x0A]] = _WHITE
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), 0xC3, 0xC4, *range(0x80, 0xC0)]] = _LETTER
_KIND[ord("'")] = _ODD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: A piece that the model takes as it is; one with white space inside or other signs is none.
_PLAIN = re.compile(r"(?:[a-zß-öø-į]+|[0-9]|[!-&(-/:-@\[-`{-~]+)\Z").match


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all spans, one span after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class _Store:
    """Id lists by key, at most `most` of them: a full store keeps those that were met most often."""

    def __init__(self, most: int):
        self.most, self.size = most, 0
        self.place: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.start, self.length, self.uses = (np.zeros(1 << 12, dtype=t) for t in (np.int64, np.int64, np.int32))

    def find(self, keys: list[str]) -> np.ndarray:
        """The place of each key, which must be distinct; -1 where it is not known."""
        at = np.fromiter(map(self.place.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))
        self.uses[at[at >= 0]] += 1
        return at

    def add(self, keys: list[str], flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n, m = len(keys), len(flat)
        while self.size + n > len(self.start):
            self.start, self.length, self.uses = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length, self.uses))
        if self.used + m > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(self.used, m), dtype=np.uint32)])
        at = np.arange(self.size, self.size + n)
        self.flat[self.used : self.used + m] = flat
        self.start[at], self.length[at], self.uses[at] = self.used + np.cumsum(lengths) - lengths, lengths, 0
        self.place.update(zip(keys, at.tolist(), strict=True))
        self.size, self.used = self.size + n, self.used + m
        return at

    def take(self, at: np.ndarray) -> np.ndarray:
        return self.flat[_spans(self.start[at], self.length[at])]

    def trim(self) -> None:
        """Of a full store, keeps at most half: the keys that were met most often since the last time."""
        if self.size <= self.most:
            return
        uses = self.uses[: self.size]
        least = max(1, int(np.partition(uses, -(self.most // 2))[-(self.most // 2)]))
        kept = [(k, i) for k, i in self.place.items() if uses[i] >= least and len(k) <= KEPT_BYTES][: self.most]
        keys, at = [k for k, _ in kept], np.asarray([i for _, i in kept], dtype=np.int64)
        flat, lengths = self.take(at), self.length[at]
        self.__init__(self.most)
        self.add(keys, flat, lengths)


def cut(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes in lower case, where pieces begin and, last, the end) of texts end to end.

    A piece has the white space that follows it. A text's begin is always a piece's.
    """
    n = len(raw)
    kind = _KIND[raw]
    lead, cont = (raw == 0xC3) | (raw == 0xC4), (raw & 0xC0) == 0x80
    after = np.zeros(n, dtype=bool)
    after[1:] = lead[:-1]
    of_c3 = np.zeros(n, dtype=bool)
    of_c3[1:] = raw[:-1] == 0xC3
    # a byte that does not continue one of the letters; the signs U+00D7 and U+00F7; past U+012F
    odd = (cont & ~after) | (of_c3 & ((raw == 0x97) | (raw == 0xB7))) | (after & ~of_c3 & (raw >= 0xB0))
    odd[:-1] |= (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
    kind[odd] = _ODD
    white = kind == _WHITE
    begin = np.zeros(n + 1, dtype=bool)
    begin[1:n] = white[:-1] & ~white[1:]
    begin[edges] = True
    if (kind == _ODD).any():
        chunk = np.flatnonzero(begin[:n])
        whole = np.maximum.reduceat(kind, chunk) == _ODD
        kind[np.repeat(whole, np.diff(chunk, append=n)) & ~white] = _ODD
    begin[1:n] |= ~white[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    low = np.where(kind == _ODD, raw, _LOWER[raw])
    upper = after & (kind == _LETTER)
    low[upper & of_c3 & (raw < 0x9F)] += 0x20
    low[upper & ~of_c3] |= 1
    return low, np.flatnonzero(begin)


class ChunkEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._letters = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x130)}
        self._pieces = _Store(KEPT_PIECES)

    def _places(self, pieces: list[str]) -> np.ndarray:
        """The place in the store of each of the distinct pieces; new ones are encoded."""
        at = self._pieces.find(pieces)
        new = np.flatnonzero(at < 0)
        tokenize, encode, letters = self._tokenizer.model.tokenize, self._tokenizer.encode, self._letters
        fresh, ids = [pieces[i] for i in new], []
        for p in fresh:
            if _PLAIN(p):
                ids.append([t.id for t in tokenize(p if p.isascii() else p.translate(letters))])
            else:
                ids.append(encode(p, add_special_tokens=False).ids)
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        at[new] = self._pieces.add(fresh, np.fromiter((i for x in ids for i in x), dtype=np.uint32, count=int(lengths.sum())), lengths)
        return at

    def ids(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(32-bit ids of all texts, where each text's begin and, last, the end). Null is empty.

        With an end id every text ends with it.
        """
        texts = texts.cast(pa.string())
        texts = texts.fill_null("") if texts.null_count else texts
        _, edges, data = texts.buffers()
        edges = np.frombuffer(edges, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, dtype=np.int64)
        if edges[-1] == edges[0]:
            flat, starts = np.zeros(0, dtype=np.uint32), np.zeros(len(edges), dtype=np.int64)
        else:
            low, cuts = cut(np.frombuffer(data, dtype=np.uint8)[edges[0] : edges[-1]], edges - edges[0])
            pieces = pa.Array.from_buffers(pa.string(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(low)]).dictionary_encode()
            # "a", "a " and "a\n" are one piece
            bare = [p.rstrip(" \n") for p in pieces.dictionary.to_numpy(zero_copy_only=False).tolist()]
            distinct = list(dict.fromkeys(bare))
            place = dict(zip(distinct, self._places(distinct).tolist(), strict=True))
            at = np.fromiter(map(place.__getitem__, bare), dtype=np.int64, count=len(bare))[pieces.indices.to_numpy()]
            flat, ends = self._pieces.take(at), np.concatenate([[0], np.cumsum(self._pieces.length[at])])
            starts = ends[np.searchsorted(cuts, edges - edges[0])]
            self._pieces.trim()
        if end_id is None:
            return flat, starts
        return np.insert(flat, starts[1:], np.uint32(end_id)), starts + np.arange(len(starts))

    def __call__(self, texts: Iterable[str], tail: bytes = b"") -> list[bytes]:
        """Little-endian 32-bit ids of each text, each followed by `tail`."""
        flat, at = self.ids(pa.array(list(texts), pa.string()))
        flat = flat.astype("<u4")
        return [flat[a:b].tobytes() + tail for a, b in zip(at[:-1], at[1:], strict=True)]


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def id_lists(flat: np.ndarray, starts: np.ndarray) -> pa.ListArray:
    """An Arrow list<int32> array of the ids between one start and the next."""
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat.view(np.int32)))


def list_crc32(column: pa.ListArray) -> pa.Array:
    """The CRC-32 of each list's ids as little-endian unsigned 32-bit numbers."""
    values = np.ascontiguousarray(column.values.to_numpy(zero_copy_only=False), dtype="<u4")
    return crc32(values, column.offsets.to_numpy())


def crc32(flat: np.ndarray, starts: np.ndarray) -> pa.Array:
    import zlib

    view, at = memoryview(flat.astype("<u4", copy=False)).cast("B"), (4 * starts).tolist()
    return pa.array([zlib.crc32(view[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64())
