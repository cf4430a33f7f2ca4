"""Whole texts as byte arrays: words, lines and their hashes, for many documents at once.

Everything works on UTF-8 bytes. A word is a maximal run of bytes other than the six ASCII white
space bytes (0x20, 0x09-0x0D); no such byte occurs inside a longer UTF-8 sequence, so byte words
and code point words are the same. Hashes depend on the bytes alone, not on the task, the batch or the
run: they are polynomials modulo the prime 2^61 - 1, which no pattern of bytes cancels (modulo a power
of two Thue-Morse words and their complements would be equal), scrambled to 64 bits.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are taken together until they reach this many bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes that start a code point.
LEADS = (np.arange(256) & 0xC0) != 0x80


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, start: int = 0) -> np.ndarray:
    """``n`` scrambled integers, the same in every process."""
    return mix((np.arange(start, start + n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


PRIME = (1 << 61) - 1
_BASE = int(seeds(1, 1 << 30)[0]) % PRIME
_INVERSE = pow(_BASE, -1, PRIME)
_LOW31, _LOW30, _P = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1), np.uint64(PRIME)
# Sums over more bytes than this could pass 64 bits.
_EXACT_BYTES = 1 << 24
_powers: dict[str, tuple[np.ndarray, ...]] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime, for any 64-bit ``x``."""
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, from halves of 31 bits; 2^61 counts as 1."""
    a1, a0, b1, b0 = a >> np.uint64(31), a & _LOW31, b >> np.uint64(31), b & _LOW31
    middle = a1 * b0 + a0 * b1
    low = a0 * b0
    found = np.uint64(2) * a1 * b1 + (middle >> np.uint64(30)) + ((middle & _LOW30) << np.uint64(31))
    return _reduced(found + (low >> np.uint64(61)) + (low & _P))


def _power(base: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1 of a number, each doubling of the table one product."""
    have = np.ones(1, np.uint64)
    while len(have) < n:
        have = np.concatenate([have, _times(have, np.full(len(have), pow(base, len(have), PRIME), np.uint64))])
    return have


def _up(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The lower 31 and the upper bits of the first powers of the base."""
    if "up" not in _powers or len(_powers["up"][0]) < n:
        power = _power(_BASE, n)
        made = (power & _LOW31).astype(np.uint32), (power >> np.uint64(31)).astype(np.uint32)
        if n > 2 * CHUNK_BYTES:
            return made
        _powers["up"] = made
    return _powers["up"]


def _down(n: int) -> np.ndarray:
    """The first powers of the base's inverse."""
    if "down" not in _powers or len(_powers["down"][0]) < n:
        made = (_power(_INVERSE, n),)
        if n > 2 * CHUNK_BYTES:
            return made[0]
        _powers["down"] = made
    return _powers["down"][0]


class Texts:
    """The bytes of some documents, one after the other, and their words."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.bounds = bounds.astype(np.int64)
        self.count = len(bounds) - 1
        self._sums: tuple[np.ndarray, np.ndarray] | None = None
        solid = ~WHITE[data]
        n = len(data)
        starts = solid.copy()
        starts[1:] &= ~solid[:-1]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:]
        inner = self.bounds[(self.bounds > 0) & (self.bounds < n)]
        starts[inner] = solid[inner]
        ends[inner - 1] = solid[inner - 1]
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.word_bounds = np.searchsorted(self.starts, self.bounds)
        self.n_words = np.diff(self.word_bounds)
        self.word_doc = np.repeat(np.arange(self.count), self.n_words)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each run of bytes."""
        n = len(self.data)
        if self._sums is None:
            # the two halves of the polynomial's terms, summed up; differences of the sums are exact
            values = self.data.astype(np.uint16)
            values += np.uint16(1)
            self._sums = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
            for sums, factors in zip(self._sums, _up(n), strict=True):
                np.multiply(factors[:n], values, out=sums[1:], dtype=np.uint64)
                np.cumsum(sums, out=sums)
        low, high = self._sums
        found = self._total(low[ends] - low[starts], high[ends] - high[starts])
        for i in np.flatnonzero(ends - starts > _EXACT_BYTES).tolist():
            cuts = np.array([*range(int(starts[i]), int(ends[i]), _EXACT_BYTES), int(ends[i])])
            parts = self._total(np.diff(low[cuts]), np.diff(high[cuts]))
            found[i] = sum(parts.tolist()) % PRIME
        found = _times(found, _down(n + 1)[starts])
        found += (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(found)

    @staticmethod
    def _total(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        high = _reduced(high)
        return _reduced(_reduced(low) + (high >> np.uint64(30)) + ((high & _LOW30) << np.uint64(31)))

    def ends_of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A row of each run: its first eight bytes, and its last eight scrambled with its size; up to
        sixteen bytes these tell all of it."""
        if len(self.data) < 8:
            data = np.append(self.data, np.zeros(8, np.uint8))
        else:
            data = np.ascontiguousarray(self.data)
        eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        size = ends - starts
        # a window at the very end of the data begins earlier, and is shifted to where the run begins
        at = np.minimum(starts, len(eights) - 1)
        first = eights[at] >> ((starts - at) * 8).astype(np.uint64)
        short = np.minimum(size, 8)
        first = np.where(short < 8, first & ((np.uint64(1) << (short % 8 * 8).astype(np.uint64)) - np.uint64(1)), first)
        last = np.where(size > 8, eights[np.clip(ends - 8, 0, len(eights) - 1)], np.uint64(0))
        return np.stack([first, mix(last + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))], 1)

    def release(self) -> None:
        """Forget the sums behind the hashes."""
        self._sums = None

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)

    def totals(self, per_byte: np.ndarray) -> np.ndarray:
        """Sums of a value of each byte over each document."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(per_byte, out=sums[1:])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` neighbours; the caller leaves out those across documents."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n])
    return out


def within(bounds: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which windows of ``k`` of ``n`` items lie inside one document."""
    m = max(n - k + 1, 0)
    inside = np.ones(m, bool)
    for b in (bounds[1:-1] if k > 1 else bounds[:0]):
        inside[max(b - k + 1, 0) : max(min(b, m), 0)] = False
    return inside


def give_back() -> None:
    """Return freed memory to the system, where the C library can: a Python worker lives through many
    tasks of many steps, and what it keeps for itself adds up on its executor.

    The library is opened anew each time: a handle kept in the module could not be sent to a task.
    """
    try:
        trim = ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return
    trim(0)


def as_binary(column: pa.Array) -> pa.LargeBinaryArray:
    """A text column with nulls as empty texts, as bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    return column.cast(pa.large_binary())


def chunks(column: pa.Array, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first, past the last, texts) for groups of neighbouring rows of a text column."""
    column = as_binary(column)
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, Texts(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], lower)
        first = last
    give_back()
