"""Pre-tokenisation of whole texts in NumPy, by the pattern of the public rank files.

The pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
depends on four character classes only, so the token starts of many texts follow
from one class lookup per code point and a few shifted comparisons. Equal
pre-tokens of a batch are found by a 64-bit hash and compared code point by code
point, so that each distinct one is resolved once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import regex

LETTER, NUMBER, OTHER, SPACE = range(4)
#: Code points that one call of :func:`split` looks at; longer texts go in pieces.
PIECE = 1 << 20
_CUT = re.compile(r"(?<=\S)[ \n]")
_M1, _M2, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), 0xD6E8FEB86659FD93


@cache
def class_table() -> np.ndarray:
    """The class of every code point.

    Letters and numbers that Python's own Unicode tables do not know yet are of the
    class OTHER, as in the tokenizer libraries (compared for every code point).
    """
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            table[m.start():m.end()] = kind
    new = [c for c in np.flatnonzero((table == LETTER) | (table == NUMBER)).tolist() if unicodedata.category(chr(c)) == "Cn"]
    table[new] = OTHER
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def pieces(text: str) -> list[str]:
    """``text`` in pieces of about PIECE code points, cut where no token can span:
    before a blank or newline that follows a visible character."""
    out, at = [], 0
    while len(text) - at > PIECE:
        m = _CUT.search(text, at + PIECE)
        if not m:
            break
        out.append(text[at:m.start()])
        at = m.start()
    out.append(text[at:])
    return out


def token_starts(cps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where tokens start in concatenated texts; ``first`` marks the starts of texts."""
    kind = class_table()[cps]
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last white space before a visible character is a token of its own or, if a blank, joins it
    i = np.flatnonzero(start[1:] & (kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1:]) + 1
    start[i - 1] = True
    start[i[cps[i - 1] == 0x20]] = False
    # contractions: an apostrophe that starts a token takes the letters of 's 't 'm 'd 're 've 'll
    q = np.flatnonzero((cps == 0x27) & start)
    if len(q):
        more = np.concatenate([cps, np.zeros(2, np.uint32)])
        same = np.concatenate([~first, [False, False]])  # the next character is in the same text
        a = np.where(same[q + 1], more[q + 1], 0)
        b = np.where(same[q + 1] & same[q + 2], more[q + 2], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        q, size = q[one | two], np.where(one, 1, 2)[one | two]
        start[q + 1] = False
        end = q + 1 + size
        start[end[end < len(cps)]] = True
    return start


_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, PIECE + (PIECE >> 2))
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x)  # wraps modulo 2^64
    return _powers["up"][:n], _powers["down"][:n]


def span_hashes(cps: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's code points, the same wherever it stands."""
    up, down = _power(len(cps) + 1)
    x = (cps.astype(np.uint64) + np.uint64(1)) * _M1
    x ^= x >> np.uint64(31)
    x *= _M2
    x ^= x >> np.uint64(29)
    total = np.zeros(len(cps) + 1, np.uint64)
    np.cumsum(x * up[:len(cps)], out=total[1:])
    h = (total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64) * _M1
    h ^= h >> np.uint64(32)
    return h * _M2


def batches(rows: Iterator[tuple], size: int = PIECE) -> Iterator[list[tuple]]:
    """Rows ``(..., text)`` in lists of about ``size`` code points."""
    held, n = [], 0
    for row in rows:
        if held and n + len(row[-1]) > size:
            yield held
            held, n = [], 0
        held.append(row)
        n += len(row[-1])
    if held:
        yield held


def ragged_take(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices ``flat[begin:begin + size]``, one after another."""
    total = int(size.sum())
    shift = begin - (np.cumsum(size) - size)
    return flat[np.repeat(shift, size) + np.arange(total)]


class Collision(Exception):
    """Two different pre-tokens have the same 64-bit hash."""


class Memory:
    """Pre-tokens that a worker has resolved, found by hash and compared by code points.

    A cache only, emptied when it holds ``limit`` entries (about 100 bytes each).
    ``resolve(hashes, tokens)`` gives the ids of pre-tokens that are not in it. New entries
    go to a small sorted table, which joins the large one when it has grown to a quarter of it.
    """

    def __init__(self, resolve: Callable[[np.ndarray, list[str]], list], dtype, limit: int = 500_000):
        self.resolve, self.dtype, self.limit = resolve, dtype, limit
        self._clear()

    def _clear(self) -> None:
        # hashes, and per hash: start and size in cps, start and size in ids
        self.tables = [(np.zeros(0, np.uint64), np.zeros((4, 0), np.int64)) for _ in range(2)]
        self.cps, self.n_cps = np.zeros(1 << 16, np.uint32), 0
        self.ids, self.n_ids = np.zeros(1 << 16, self.dtype), 0

    def __call__(self, hashes: np.ndarray, cps: np.ndarray, begin: np.ndarray, size: np.ndarray, text: str):
        """Flat ids with the start and size of each of the given distinct spans of ``cps`` (sorted by hash)."""
        place, known = self._found(hashes)
        if not (np.array_equal(place[1, known], size[known]) and np.array_equal(
                ragged_take(self.cps, place[0, known], size[known]), ragged_take(cps, begin[known], size[known]))):
            raise Collision
        new = np.flatnonzero(~known)
        if len(new):
            held = sum(len(h) for h, _ in self.tables)
            if held and held + len(new) > self.limit:
                self._clear()
                new = np.arange(len(hashes))
            place[:, new] = self._learned(hashes[new], cps, begin[new], size[new], text)
        return self.ids, place[2], place[3]

    def _found(self, hashes) -> tuple[np.ndarray, np.ndarray]:
        place, known = np.zeros((4, len(hashes)), np.int64), np.zeros(len(hashes), bool)
        for table, places in self.tables:
            if len(table):
                at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
                hit = table[at] == hashes
                place[:, hit] = places[:, at[hit]]
                known |= hit
        return place, known

    @staticmethod
    def _put(buffer: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
        if used + len(more) > len(buffer):
            buffer = np.concatenate([buffer[:used], np.empty(max(used, len(more)) + 1, buffer.dtype)])
        buffer[used:used + len(more)] = more
        return buffer

    def _learned(self, hashes, cps, begin, size, text) -> np.ndarray:
        found = self.resolve(hashes, [text[b:b + n] for b, n in zip(begin.tolist(), size.tolist())])
        n = np.fromiter(map(len, found), np.int64, len(found))
        place = np.stack([np.cumsum(size) - size + self.n_cps, size, np.cumsum(n) - n + self.n_ids, n])
        self.cps = self._put(self.cps, self.n_cps, ragged_take(cps, begin, size))
        self.ids = self._put(self.ids, self.n_ids, np.fromiter(chain.from_iterable(found), self.dtype, int(n.sum())))
        self.n_cps, self.n_ids = self.n_cps + int(size.sum()), self.n_ids + int(n.sum())
        large, small = self.tables[0], self._merged(self.tables[1], hashes, place)
        if len(small[0]) > max(1 << 14, len(large[0]) >> 2):
            large, small = self._merged(large, *small), (hashes[:0], place[:, :0])
        self.tables = [large, small]
        return place

    @staticmethod
    def _merged(table, hashes, place):
        at = np.searchsorted(table[0], hashes)
        return np.insert(table[0], at, hashes), np.insert(table[1], at, place, axis=1)


def _without_memory(memory: Memory, hashes, cps, begin, size, text: str):
    """The slow path of a batch in which hashes collide: its distinct pre-tokens are told apart as strings."""
    spans = [text[b:b + n] for b, n in zip(begin.tolist(), size.tolist())]
    first = {}
    inverse = np.array([first.setdefault(s, len(first)) for s in spans])
    _, at = np.unique(inverse, return_index=True)
    found = memory.resolve(hashes[at], list(first))
    n = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), memory.dtype, int(n.sum())), np.cumsum(n) - n, n, inverse


def encode(texts: list[str], memory: Memory) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after another, and the number of ids of each text.

    Long texts are worked off piece by piece.
    """
    ids, counts = [], np.zeros(len(texts), np.int64)
    parts = ((k, p) for k, t in enumerate(texts) for p in pieces(t) if p)
    for part in batches(parts):
        sizes = np.array([len(p) for _, p in part])
        text = "".join(p for _, p in part)
        cps = code_points(text)
        first = np.zeros(len(cps), bool)
        first[np.cumsum(sizes) - sizes] = True
        begin = np.flatnonzero(token_starts(cps, first))
        end = np.append(begin[1:], len(cps))
        size = end - begin
        hashes = span_hashes(cps, begin, end)
        u, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        try:
            if not (np.array_equal(size[at][inverse], size)
                    and np.array_equal(cps, ragged_take(cps, begin[at][inverse], size))):
                raise Collision
            flat, start, n = memory(u, cps, begin[at], size[at], text)
        except Collision:
            flat, start, n, inverse = _without_memory(memory, hashes, cps, begin, size, text)
        each = n[inverse]
        ids.append(ragged_take(flat, start[inverse], each))
        upto = np.concatenate([[0], np.cumsum(each)])
        cut = np.searchsorted(begin, np.concatenate([[0], np.cumsum(sizes)]))
        np.add.at(counts, [k for k, _ in part], np.diff(upto[cut]))
    return np.concatenate(ids) if ids else np.zeros(0, memory.dtype), counts
