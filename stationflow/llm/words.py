"""Word and word-run hashes of whole Arrow batches, as array arithmetic.

A word is a maximal run of bytes other than the six ASCII white-space bytes (space, tab to carriage return). None of
them occurs inside a multi-byte UTF-8 character, so splitting bytes equals splitting characters. A word's hash is a
polynomial over its bytes modulo 2**64, taken from prefix sums, then mixed; a run of k words is hashed the same way
over the word hashes. Texts are handled in blocks of about ``BLOCK`` bytes, so memory stays bounded by the block, or
by the longest text where that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20

U = np.uint64
_BYTE_BASE = 0x9E3779B97F4A7C15
_RUN_BASE = 0xD1342543DE82EF95
_RUN_BASE_2 = 0xAF251AF3B0F025B5
_MASK = (1 << 64) - 1

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False

_AS_IS = np.arange(1, 257, dtype=U)
_LOWER = _AS_IS.copy()
_LOWER[ord("A"): ord("Z") + 1] = _AS_IS[ord("a"): ord("z") + 1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (xor-shifts and odd multipliers)."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(29))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(32))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; those of a block are kept for later calls, those of a longer text are not."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        full = np.full(max(n, BLOCK + 1), base, U)
        full[0] = 1
        have = np.multiply.accumulate(full)
        if n <= BLOCK + 1:
            _POWERS[base] = have
    return have[:n]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null counts as an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offs - offs[0], raw[offs[0]: offs[-1]]


def pieces(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False,
           base: int = _BYTE_BASE) -> np.ndarray:
    """Hashes of the byte ranges [start, end) of one block."""
    values = (_LOWER if lower else _AS_IS)[raw]
    values *= _powers(base, len(raw))
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum(values, out=sums[1:])
    inverse = _powers(pow(base, -1, 1 << 64), len(raw) + 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U))


def split(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block; no word crosses a text's edge."""
    word = _IS_WORD[raw]
    before = np.empty_like(word)
    before[1:] = word[:-1]
    edges = offs[:-1][offs[:-1] < len(raw)]
    before[:1] = False
    before[edges] = False
    after = np.empty_like(word)
    after[:-1] = word[1:]
    after[-1:] = False
    after[offs[1:][offs[1:] > 0] - 1] = False
    return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1


class Block:
    """Some consecutive texts of a batch: rows first..last-1, their words and the words' places.

    ``ptr[i] : ptr[i + 1]`` are the words of row ``first + i``.
    """

    def __init__(self, first: int, offs: np.ndarray, raw: np.ndarray, lower: bool):
        self.first, self.last = first, first + len(offs) - 1
        self.offs, self.raw = offs, raw
        self.starts, self.ends = split(raw, offs)
        self.words = pieces(raw, self.starts, self.ends, lower)
        self.ptr = np.searchsorted(self.starts, offs)

    def rows(self) -> Iterator[tuple[int, int, int]]:
        """(row, first word, end word) of every text."""
        ptr = self.ptr.tolist()
        for i in range(self.last - self.first):
            yield self.first + i, ptr[i], ptr[i + 1]


def blocks(column: pa.Array, lower: bool = False) -> Iterator[Block]:
    offs, raw = text_buffers(column)
    n, at = len(offs) - 1, 0
    while at < n:
        to = int(np.searchsorted(offs, offs[at] + BLOCK, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield Block(at, offs[at: to + 1] - offs[at], raw[offs[at]: offs[to]], lower)
        at = to


def runs(words: np.ndarray, k: int, second: bool = False) -> np.ndarray:
    """Hash of words[i : i + k] for every i (a run that crosses a text's edge is the caller's to leave out).

    Runs of doubling length are combined: h(a + b) = h(a) * base**len(b) + h(b).
    """
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    base = _RUN_BASE_2 if second else _RUN_BASE
    out, have, part, size = None, 0, words, 1
    while True:
        if k & size:
            if out is None:
                out = part[:n].copy()
            else:
                out = out * U(pow(base, size, 1 << 64)) + part[have: have + n]
            have += size
        if have == k:
            return mix(out + U(k))
        part = part[:-size] * U(pow(base, size, 1 << 64)) + part[size:]
        size *= 2
