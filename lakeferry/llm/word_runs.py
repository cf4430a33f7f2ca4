"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

A run is a stretch of words that repeats with a smallest period ``q`` over at least ``least`` words
and two periods, and that no neighbouring word extends. Its last ``2 d`` words are a square for every
multiple ``d`` of ``q`` that fits twice, and this square is branching: the suffixes at its start and
at its middle agree in exactly ``d`` words. So both lie in one LCP interval of depth ``d``, in
different children of it. For every such interval the suffixes ``i`` of the smaller child look up
``ISA[i + d]`` and ``ISA[i - d]`` in the other child; a hit is a square, which is rotated to the left as
far as it goes. Squares of the same stretch are one run, whose period is the smallest of theirs.

The array is flat: sorted suffixes, their inverse, common prefixes and for each pair of neighbours
the range to its left and right that agrees in more words; there are no tree nodes. It is built by
prefix doubling over word numbers, for many documents at once, with a document's number in front, so
that nothing crosses documents. A run of ``least`` words has a multiple of its period that is at
least `least_depth`, so only suffixes that share so many words with another one are sorted to the end
and searched: in plain prose these are very few.

Scale: one pass over whole texts in the order they come, without a shuffle; a task holds the words of
one chunk (`words.CHUNK_BYTES`, or one longer text) and four bytes for every word and every doubling
round, of which there are as many as the longest repeat has binary digits. Words are told apart by
their bytes, not by hashes.

Defined results: a null or empty text, or one without words, has no runs and collapses to the empty
text; rows are taken one by one, so repeated rows and null ids give a row each; extra columns are left
out, whatever they are called; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.words import WHITE, Texts, chunks

LEAST_WORDS = 12
# Suffixes that are looked up at once.
LOOKUPS = 1 << 20


def least_depth(least: int) -> int:
    """Every run of ``least`` words has a square whose period is at least this and a multiple of its own."""
    return min(least // 2 // q * q for q in range(1, max(least // 2, 1) + 1))


def word_numbers(texts: Texts) -> tuple[np.ndarray, pa.Array]:
    """(the number of every word, the different words), equal exactly where the bytes are."""
    offsets = np.zeros(len(texts.starts) + 1, np.int64)
    np.cumsum(texts.ends - texts.starts, out=offsets[1:])
    solid = texts.data[~WHITE[texts.data]]
    words = pa.Array.from_buffers(pa.large_binary(), len(texts.starts), [None, pa.py_buffer(offsets), pa.py_buffer(solid)])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


class Suffixes:
    """The suffixes of sequences that share ``depth`` symbols with another one of the same sequence.

    ``order`` lists where they start, sorted; ``place`` is its inverse, -1 elsewhere; ``common[i]`` is
    in how many symbols ``order[i - 1]`` and ``order[i]`` agree.
    """

    def __init__(self, symbols: np.ndarray, sequence: np.ndarray, depth: int):
        n = len(symbols)
        self.n = n
        ends = np.searchsorted(sequence, sequence, "right")
        first = sequence * (int(symbols.max(initial=0)) + 1) + symbols
        rank, active = self._ranked(first, np.arange(n), np.zeros(n + 1, np.int64))
        rank[n] = -1
        self.ranks = [rank.astype(np.int32 if n < 2**31 else np.int64)]
        shared = active if depth < 2 else None
        step = 1
        while len(active):
            after = active + step
            key = rank[active] * (n + 1) + np.where(after < ends[active], rank[np.minimum(after, n)] + 1, 0)
            rank, active = self._ranked(key, active, rank)
            step *= 2
            if len(active):
                self.ranks.append(rank.astype(self.ranks[0].dtype))
            if shared is None and 2 * step > depth:
                shared = active
        shared = active if shared is None else shared
        self.order = shared[np.argsort(rank[shared])]
        self.place = np.full(n + 1, -1, np.int64)
        self.place[self.order] = np.arange(len(self.order))
        self.common = np.zeros(len(self.order), np.int64)
        self.common[1:] = self.ahead(self.order[:-1], self.order[1:])

    @staticmethod
    def _ranked(key: np.ndarray, active: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks refined by a key among the active positions, and those still sharing one.

        A rank is the place of the first of its equals, so that it stays right for the others.
        """
        by_key = np.argsort(key, kind="stable")
        sorted_key, at = key[by_key], active[by_key]
        fresh = np.ones(len(at), bool)
        fresh[1:] = sorted_key[1:] != sorted_key[:-1]
        old = rank[at]
        opens = np.ones(len(at), bool)
        opens[1:] = old[1:] != old[:-1]
        places = np.arange(len(at))
        base = np.maximum.accumulate(np.where(opens, places, 0))
        group = np.maximum.accumulate(np.where(fresh, places, 0))
        rank = rank.copy()
        rank[at] = old + group - base
        alone = fresh.copy()
        alone[:-1] &= fresh[1:]
        return rank, np.sort(at[~alone])

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many symbols the suffixes at different places agree."""
        a, b = a.copy(), b.copy()
        begin = a.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            same = self.ranks[k][a] == self.ranks[k][b]
            a[same] += 1 << k
            b[same] += 1 << k
        return a - begin

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many symbols the text before one place agrees with that before a later one."""
        a, b = a.copy(), b.copy()
        begin = a.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            size = 1 << k
            same = a >= size
            same[same] = self.ranks[k][a[same] - size] == self.ranks[k][b[same] - size]
            a[same] -= size
            b[same] -= size
        return begin - a


def halves(common: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, left, right): the suffixes left ... i-1 and i ... right-1 agree in common[i] symbols, those
    across it in no more; for every i that agrees with its neighbour in ``depth`` symbols."""
    values = common.tolist()
    left, right = [0] * len(values), [len(values)] * len(values)
    stack: list[int] = []
    for i, value in enumerate(values):
        while stack and values[stack[-1]] >= value:
            right[stack.pop()] = i
        left[i] = stack[-1] if stack else 0
        stack.append(i)
    at = np.flatnonzero(common >= depth)
    return at, np.array(left, np.int64)[at], np.array(right, np.int64)[at]


def branching_squares(found: Suffixes, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares of at least ``depth`` that end where their period does."""
    at, left, right = halves(found.common, depth)
    small_left = at - left <= right - at
    begin, size = np.where(small_left, left, at), np.where(small_left, at - left, right - at)
    low, high = np.where(small_left, at, left), np.where(small_left, right, at)
    period = found.common[at]
    sums = np.concatenate([[0], np.cumsum(size)])
    starts, periods = [], []
    first = 0
    while first < len(at):
        last = max(int(np.searchsorted(sums, sums[first] + LOOKUPS, "right")) - 1, first + 1)
        for lowest in range(0, int(size[first]) if last == first + 1 else 1, LOOKUPS):
            counts = size[first:last] if last > first + 1 else np.array([min(LOOKUPS, int(size[first]) - lowest)])
            of = np.repeat(np.arange(first, last), counts)
            nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + lowest
            suffix, d = found.order[begin[of] + nth], period[of]
            for other, start in ((suffix + d, suffix), (suffix - d, suffix - d)):
                place = np.where((other >= 0) & (other < found.n), found.place[np.clip(other, 0, found.n)], -1)
                hit = (place >= low[of]) & (place < high[of])
                starts.append(start[hit])
                periods.append(d[hit])
        first = last
    none = [np.zeros(0, np.int64)]
    return np.concatenate(starts or none), np.concatenate(periods or none)


def runs(symbols: np.ndarray, sequence: np.ndarray, least: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of sequences laid end to end, by start, then period."""
    depth = least_depth(least)
    found = Suffixes(symbols, sequence, depth)
    start, period = branching_squares(found, depth)
    end = start + 2 * period
    start = start - found.behind(start, start + period)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    # a period below `depth` was found by its first multiple that isn't
    for q in range(1, depth):
        for d in range(depth, depth + q):
            some = np.flatnonzero(period == d) if d % q == 0 else []
            if len(some):
                whole = np.ones(len(some), bool)
                for t in range(d - q):
                    whole &= symbols[start[some] + t] == symbols[start[some] + t + q]
                period[some[whole]] = q
    long = end - start >= least
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _collapsed(texts: Texts, least: int) -> tuple[pa.Array, pa.Array]:
    """(runs, the words outside repeats joined by a space) of each document."""
    numbers, words = word_numbers(texts)
    start, end, period = runs(numbers, texts.word_doc, least)
    doc = texts.word_doc[start]
    found = pa.StructArray.from_arrays(
        [pa.array(start - texts.word_bounds[doc]), pa.array(end - start), pa.array(period)], fields=list(_RUN)
    )
    bounds = np.searchsorted(doc, np.arange(texts.count + 1))
    listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found)
    repeats = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(repeats, start + period, 1)
    np.add.at(repeats, end, -1)
    kept = np.cumsum(repeats[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[texts.word_bounds]
    parts = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), words.take(pa.array(numbers[kept])))
    return listed, pc.binary_join(parts, pa.scalar(b" ", pa.large_binary())).cast(pa.string())


def word_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """(id, runs, collapsed) for every row.

    ``runs`` is an array of (start, length, period) in words, by start, then period; ``collapsed`` is
    the text's words joined by single spaces, without those that any run holds after its first period.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in chunks(batch.column(1)):
                listed, collapsed = _collapsed(texts, least)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), listed, collapsed], names=[id_col, "runs", "collapsed"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(found, f"`{id_col}` {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
