"""A collection's Burrows-Wheeler transform and common prefixes, built column by column.

Round j inserts the suffix of length j of every string that is at least so long. The symbol before
the suffix inserted last, found in the transform itself, says where the next one belongs: behind
all suffixes that start with smaller symbols and behind those whose rest sorts before it. So each
round is one sequential pass that reads the transform and the prefix lengths of the last round and
writes those of this one; no suffix is ever compared or kept.

The common prefix of a new suffix with its neighbour is one more than the least value between the
places of their rests in the last round. Values are cut off at `limit`.

A symbol may be several bytes (`packed`): a string is then one sequence of symbols for each place
that its first symbol may start at, and a round inserts a symbol of each of these. Rounds, and so
the passes over the transform, become fewer by the width of a symbol, and the suffixes stay the same.
"""

from __future__ import annotations

import numpy as np


class _Least:
    """Least value of ranges of an array, from tables of doubling spans."""

    def __init__(self, values: np.ndarray, widest: int):
        self.n = len(values)
        levels = max(int(widest).bit_length(), 1)
        self.tables = np.empty((levels, self.n), values.dtype)
        self.tables[0] = values
        for k in range(1, levels):
            last, span = self.tables[k - 1], 1 << (k - 1)
            self.tables[k] = last
            np.minimum(last[:-span], last[span:], out=self.tables[k, :-span])
        self.flat = self.tables.ravel()

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least of values[first..last], both included."""
        level = _LEVEL[np.minimum(last - first + 1, len(_LEVEL) - 1)]
        wide = last - first + 1 >= len(_LEVEL)
        if wide.any():
            level[wide] = np.log2(last[wide] - first[wide] + 1).astype(np.int64)
        row = level * self.n
        return np.minimum(self.flat[row + first], self.flat[row + last + 1 - (1 << level)])


_WIDEST = 5  # bytes of a symbol

# The largest power of two not above a number, as its exponent.
_LEVEL = np.array([max(i.bit_length() - 1, 0) for i in range(1 << 12)], np.int64)


class Collection:
    """Strings of symbols, as one array of numbers from 0 on and their bounds; `limit` caps common prefixes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, limit: int):
        self.n = len(bounds) - 1
        self.lengths = np.diff(bounds)
        kind = np.min_scalar_type(int(data.max(initial=0)) + 1)
        symbols = np.append(data.astype(kind) + kind.type(1), kind.type(0))  # 0 ends a string
        ends = bounds[1:]
        longest = int(self.lengths.max(initial=0))
        strings = np.arange(self.n)
        # the empty suffixes, in the order of the strings
        self.transform = np.where(self.lengths > 0, symbols[np.maximum(ends - 1, 0)], 0).astype(kind)
        self.prefix = np.zeros(self.n, np.uint8)
        place = strings.copy()
        for j in range(1, longest + 1):
            active = strings[self.lengths >= j]
            now = place[active]
            order, rank = self._order()
            symbol, at = self.transform[now], rank[now].astype(np.int64)
            new = at + self.n  # empty suffixes come first
            before, after = order[np.maximum(at - 1, 0)], order[np.minimum(at + 1, len(order) - 1)]
            joined = (at > 0) & (self.transform[before] == symbol)
            follows = (at + 1 < len(order)) & (self.transform[after] == symbol)
            low, high = now[joined], now[follows]
            below, above = before[joined], after[follows]
            widest = max((low - below).max(initial=0), (above - high).max(initial=0))
            least = _Least(self.prefix, widest)
            own = np.zeros(len(active), np.uint8)
            own[joined] = np.minimum(least.between(below + 1, low), limit - 1) + 1
            next_ = np.zeros(len(active), np.uint8)
            next_[follows] = np.minimum(least.between(high + 1, above), limit - 1) + 1
            size = len(self.transform) + len(active)
            old = np.ones(size, bool)
            old[new] = False
            transform, prefix = np.empty(size, kind), np.empty(size, np.uint8)
            transform[old], prefix[old] = self.transform, self.prefix
            more = self.lengths[active] > j
            transform[new] = np.where(more, symbols[np.maximum(ends[active] - j - 1, 0)], 0)
            behind = new + 1
            inside = behind < size
            prefix[behind[inside]] = next_[inside]
            prefix[new] = own
            self.transform, self.prefix = transform, prefix
            # earlier places don't matter any more
            place[active] = new

    def _order(self) -> tuple[np.ndarray, np.ndarray]:
        """Places with a symbol in the order of the suffixes they make, and the rank of each."""
        order = np.argsort(self.transform, kind="stable")[len(self.transform) - np.count_nonzero(self.transform) :]
        rank = np.empty(len(self.transform), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        return order, rank

    def suffixes(self, least: int):
        """(length, strings, places) of the suffixes of each length from ``least`` on, read off the
        transform alone by walking each string back from its end."""
        _, rank = self._order()
        strings, place = np.arange(self.n), np.arange(self.n)
        for j in range(1, int(self.lengths.max(initial=0)) + 1):
            keep = self.lengths[strings] >= j
            strings, place = strings[keep], place[keep]
            place = self.n + rank[place]
            if j >= least:
                yield j, strings, place


def packed(data: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, bounds) of `width` times as many sequences: those of a string's symbols of `width`
    bytes from its byte 0, 1, ... on, numbered in the order of their bytes; what is shorter than a
    symbol is left out."""
    sizes = np.maximum(np.diff(bounds)[:, None] - np.arange(width), 0) // width
    whole = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    start = (bounds[:-1, None] + np.arange(width)).ravel()
    at = np.repeat(start - width * whole[:-1], sizes.ravel()) + width * np.arange(whole[-1])
    words = np.zeros(len(at), np.uint64)
    for i in range(width):
        words = (words << np.uint64(8)) | data[at + i]
    _, symbols = np.unique(words, return_inverse=True)
    return symbols, whole


def shared_prefixes(data: np.ndarray, bounds: np.ndarray, length: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(offsets, strings, groups) of all substrings of ``length`` bytes; equal ones share a group."""
    width = max(w for w in range(1, min(_WIDEST, length) + 1) if length % w == 0)
    symbols, whole = packed(data, bounds, width)
    built = Collection(symbols, whole, length // width)
    group = np.cumsum(built.prefix < length // width) - 1
    return [
        (width * (built.lengths[s] - j) + s % width, s // width, group[p])
        for j, s, p in built.suffixes(length // width)
    ]


