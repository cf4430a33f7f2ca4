"""Removal of long substrings that an earlier document also holds, by a collection's transform.

Every byte that lies in a `LENGTH`-byte string which also starts in a document of smaller id is
removed. Equal strings are found by the Burrows-Wheeler transform and common prefixes of a
collection of strings, built one column of all strings per round (`bwt`), a column being five bytes
wide.

Distribution. Every `LENGTH`-byte string has an anchor, the least hash of the `ANCHOR`-byte strings
inside it; equal strings have equal anchors, and neighbours mostly share theirs. So a text falls
into segments of neighbouring strings with one anchor, and a collection need only hold segments of
the same anchors.

1. Texts are written once, as blocks of `BLOCK_BYTES`; only block tables move from here on.
2. Each block sends its distinct anchors, with the number of its documents that hold each, to the
   parts they hash to; a part returns those that two documents or more hold.
3. Each block sends its distinct segments of such anchors, with the smallest and largest id that
   hold each, to collections; a collection builds its transform and returns, for each segment, the
   smallest id of every string in it.
4. Each block marks what its documents share with smaller ids, and removes it.

A block is one sender however often it holds a string, so a passage in a third of all documents is
one entry per block and collection; a block's entries travel by groups of `GROUP` collections,
compressed, so that its rows are few. Anchors that more than `HOT` documents hold, whose segments may
differ at their ends without bound, are split further: their strings are sent one by one, to the
collection that the whole string hashes to. The number of parts and collections grows with the
input, so each stays of one size.

Collections are built in the memory of a task, in arrays that each round reads and writes once
from front to back; files of a machine's own would be lost with an executor.

Defined results: ids are whole numbers; a null text is empty; rows with a null id neither lose nor cause anything to be
lost; rows of the same id don't affect each other; texts shorter than `LENGTH` stay whole; an empty
table gives an empty one. Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.bwt import shared_prefixes
from lakeferry.llm.scratch import Scratch
from lakeferry.llm.words import as_binary, mix, seeds
from lakeferry.plans.workspace import session_settings

LENGTH = 50
ANCHOR = 20
ANCHOR_BITS = 48  # of an anchor's hash; equal hashes of others only mean more work
LONGEST_RUN = LENGTH - ANCHOR + 1  # strings in a segment; more only share an anchor by repeating it
BLOCK_BYTES = 4 << 20
PART_BYTES = 16 << 20  # of text whose anchors make one part
COLLECTION_SEGMENTS = 3000
GROUP = 32  # collections that one task builds one after the other
HOT = 1000
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.iinfo(np.int64).max
_FACTORS = seeds(LENGTH // 8 + 1, 1 << 44) | np.uint64(1)
_MASKS = [np.uint64((1 << 8 * n) - 1) for n in range(8)]
_TILE = 1 << 15
# a segment on its way to its collection, and what comes back
ENTRY = np.dtype([("least", "<i8"), ("most", "<i8"), ("name", "<u4"), ("length", "u1"), ("collection", "u1")])
VERDICT = np.dtype([("name", "<u4"), ("begin", "u1"), ("end", "u1"), ("id", "<i8")])


class Block:
    """Some documents' bytes, one after the other."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, sizes: np.ndarray, data: np.ndarray):
        self.count = len(ids)
        self.data = data
        self.bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ids, self.null = ids, null

        padded = np.zeros(len(data) + 8, np.uint8)
        padded[: len(data)] = data
        # the eight bytes from every place on, as a number
        self.words = np.ndarray((len(data),), "<u8", padded.data, 0, (1,))

    def _hash(self, places, count: int, length: int) -> np.ndarray:
        """A hash of the ``length`` bytes at ``count`` places, a slice's start or an array. It is a
        sum of words, which others may share that differ in a few bytes: it only serves anchors."""
        out = np.zeros(count, np.uint64)
        for i, at in enumerate(range(0, length, 8)):
            part = self.words[places + at : places + at + count] if isinstance(places, int) else self.words[places + at]
            part = part & _MASKS[min(length - at, 8)] if length - at < 8 else part
            out += part * _FACTORS[i]
        out ^= out >> np.uint64(32)
        out *= _GOLD
        return out

    def _chained(self, places: np.ndarray, length: int) -> np.ndarray:
        """A hash of the ``length`` bytes at the places, scrambled after every word."""
        out = np.zeros(len(places), np.uint64)
        for at in range(0, length, 8):
            part = self.words[places + at]
            out = mix(out * _GOLD + (part & _MASKS[length - at] if length - at < 8 else part))
        return out

    def _same(self, places: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Are the long strings at these places equal, byte for byte?"""
        same = np.ones(len(places), bool)
        for at in (*range(0, LENGTH - 7, 8), LENGTH - 8):
            same &= self.words[places + at] == self.words[others + at]
        return same

    def _anchors(self, n: int) -> np.ndarray:
        """The least hash of the anchors' strings inside each of the ``n`` long strings, tile by
        tile, so that a tile's numbers stay in the processor's cache."""
        spans = LENGTH - ANCHOR + 1
        found = np.empty(n, np.uint64)
        for at in range(0, n, _TILE):
            size = min(_TILE, n - at)
            least, span = self._hash(at, size + spans - 1, ANCHOR), 1
            while span * 2 <= spans:
                least = np.minimum(least[:-span], least[span:])
                span *= 2
            np.minimum(least[:size], least[spans - span : spans - span + size], out=found[at : at + size])
        return found

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, strings, anchor, document) of each segment; documents without an id have none."""
        empty = np.zeros(0, np.int64)
        n = len(self.data) - LENGTH + 1
        if n <= 0:
            return empty, empty, empty.astype(np.uint64), empty
        anchors = self._anchors(n)
        lengths = np.maximum(np.diff(self.bounds) - LENGTH + 1, 0)
        lengths[self.null] = 0
        doc = np.repeat(np.arange(self.count), lengths)
        places = np.repeat(self.bounds[:-1] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
        if not len(places):
            return empty, empty, empty.astype(np.uint64), empty
        anchors = anchors[places]
        edge = np.ones(len(places), bool)
        edge[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(edge)
        run = np.diff(np.append(first, len(places)))
        edge |= (np.arange(len(places)) - np.repeat(first, run)) % LONGEST_RUN == 0
        first = np.flatnonzero(edge)
        runs = np.diff(np.append(first, len(places)))
        return places[first], runs, mix(anchors[first]) >> np.uint64(64 - ANCHOR_BITS), doc[first]

    def wanted(self, flagged: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, strings, route, document) of the segments whose anchor is flagged; those with
        hot anchors string by string."""
        start, run, anchor, doc = self.segments()
        keep = _member(anchor, flagged)
        start, run, anchor, doc = start[keep], run[keep], anchor[keep], doc[keep]
        burning = _member(anchor, hot)
        if not burning.any():
            return start, run, anchor, doc
        many = run[burning]
        each = np.repeat(start[burning] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        whole = self._chained(each, LENGTH)
        cold = ~burning
        return (
            np.concatenate([start[cold], each]),
            np.concatenate([run[cold], np.ones(len(each), np.int64)]),
            np.concatenate([anchor[cold], whole]),
            np.concatenate([doc[cold], np.repeat(doc[burning], many)]),
        )

    def distinct(self, start: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first, number of each) of distinct segments. The bytes decide: a hash only
        brings candidates together. The same segments always get the same numbers."""
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # first and last string together are the whole segment: it is shorter than two of them
        end = start + run - 1
        name = mix(mix(self._chained(start, LENGTH) + run.astype(np.uint64)) * _GOLD + self._chained(end, LENGTH))
        _, first, code = np.unique(name, return_index=True, return_inverse=True)
        like = first[code]
        same = (run == run[like]) & self._same(start, start[like]) & self._same(end, end[like])
        more: dict[bytes, tuple[int, int]] = {}
        for i in np.flatnonzero(~same):
            held = self.data[start[i] : end[i] + LENGTH].tobytes()
            code[i], _ = more.setdefault(held, (len(first) + len(more), i))
        return np.concatenate([first, np.array([i for _, i in more.values()], np.int64)]), code


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _short(anchors: np.ndarray) -> bytes:
    """Anchors without the bytes that they leave empty."""
    return np.ascontiguousarray(anchors.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : ANCHOR_BITS // 8].tobytes()


def _long(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) * 8 // ANCHOR_BITS, 8), np.uint8)
    out[:, : ANCHOR_BITS // 8] = np.frombuffer(raw, np.uint8).reshape(len(out), -1) if raw else 0
    return out.view("<u8").ravel()


def _slices(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, places) of equal keys."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    for a, b in zip(first, [*first[1:], len(keys)], strict=True):
        yield int(ordered[a]), order[a:b]


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _blocks(docs: DataFrame) -> DataFrame:
    """(block, ids, nulls, sizes, data): the rows (id, text), some per block, numbered by task;
    the texts are compressed, since blocks are moved twice."""
    names = ["block", "ids", "nulls", "sizes", "data"]
    kinds = [pa.int64(), *[pa.binary()] * 4]

    def packed(number: int, ids: list[int | None], texts: list[bytes]) -> pa.RecordBatch:
        own = np.array([_NONE if i is None else i for i in ids], np.int64).tobytes()
        nulls = np.array([i is None for i in ids], bool).tobytes()
        sizes = np.array([len(t) for t in texts], np.int64).tobytes()
        return _batch([(number, own, nulls, sizes, pa.compress(b"".join(texts), "zstd", asbytes=True))], names, kinds)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        ids: list[int | None] = []
        texts: list[bytes] = []
        size = 0
        for batch in batches:
            for i, value in zip(batch.column(0).to_pylist(), as_binary(batch.column(1)), strict=True):
                text = value.as_py()
                if ids and size + len(text) > BLOCK_BYTES:
                    yield packed(number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(i)
                texts.append(text)
                size += len(text)
        if ids:
            yield packed(number, ids, texts)

    return docs.mapInArrow(made, "block long, ids binary, nulls binary, sizes binary, data binary")


def _read(batch: pa.RecordBatch, i: int) -> Block:
    sizes = _array(batch, "sizes", i, np.int64)
    total = int(sizes.sum())
    data = pa.decompress(batch.column("data")[i].as_py(), total, "zstd", asbytes=True) if total else b""
    return Block(_array(batch, "ids", i, np.int64), _array(batch, "nulls", i, bool), sizes, np.frombuffer(data, np.uint8))


def _array(batch: pa.RecordBatch, name: str, i: int, kind) -> np.ndarray:
    value = batch.column(name)[i].as_py()
    return np.frombuffer(value, kind) if value else np.zeros(0, kind)


def _anchors(blocks: DataFrame, parts: int) -> DataFrame:
    """(part, block, anchors, docs): the distinct anchors of each block and how many of its
    documents hold each."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, _, anchor, doc = _read(batch, i).segments()
                order = np.lexsort((doc, anchor))
                anchor, doc = anchor[order], doc[order]
                fresh = np.ones(len(anchor), bool)
                fresh[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                distinct, counts = np.unique(anchor[fresh], return_counts=True)
                counts = np.minimum(counts, 255).astype(np.uint8)
                rows = [
                    (part, batch.column("block")[i].as_py(), _short(distinct[at]), counts[at].tobytes())
                    for part, at in _slices((distinct % np.uint64(parts)).astype(np.int64))
                ]
                yield _batch(rows, ["part", "block", "anchors", "docs"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()])

    return blocks.mapInArrow(made, "part int, block long, anchors binary, docs binary")


def _repeated(anchors: DataFrame, most: int) -> DataFrame:
    """(block, anchors, hot, n): the anchors of each block that two documents hold, by part."""

    def found(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        held = [_long(batch.column("anchors")[i].as_py()) for i in range(batch.num_rows)]
        docs = np.concatenate([_array(batch, "docs", i, np.uint8) for i in range(batch.num_rows)]).astype(np.int64)
        values = np.concatenate(held)
        sender = np.repeat(np.arange(len(held)), [len(h) for h in held])
        order = np.argsort(values, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], values[order][1:] != values[order][:-1]]))
        total = np.repeat(np.add.reduceat(docs[order], first), np.diff(np.append(first, len(values))))
        many = np.empty(len(values), np.int64)
        many[order] = total
        rows = []
        for i in range(len(held)):
            own = many[np.searchsorted(sender, i) : np.searchsorted(sender, i, "right")]
            again = own > 1
            if again.any():
                rows.append((batch.column("block")[i].as_py(), _short(held[i][again]), _short(held[i][own > most]), int(again.sum())))
        return pa.Table.from_batches([_batch(rows, ["block", "anchors", "hot", "n"], [pa.int64(), pa.binary(), pa.binary(), pa.int64()])])

    return anchors.groupBy("part").applyInArrow(found, "block long, anchors binary, hot binary, n long")


def _flags(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """The flagged and the hot anchors of a block, in order."""

    def merged(name: str) -> np.ndarray:
        parts = batch.column(name)[i].as_py() or []
        return np.sort(_long(b"".join(parts)))

    return merged("flagged"), merged("hot")


def _zipped(*arrays: np.ndarray | bytes) -> bytes:
    raw = b"".join(x if isinstance(x, bytes) else x.tobytes() for x in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unzipped(held: bytes) -> bytes:
    return pa.decompress(held[8:], int.from_bytes(held[:8], "little"), "zstd", asbytes=True)


def _segments(blocks: DataFrame, groups: int) -> DataFrame:
    """(group, block, held): the distinct flagged segments of each block by groups of collections,
    as `ENTRY` records and then their bytes; named by their numbers in the block."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _read(batch, i)
                start, run, route, doc = block.wanted(*_flags(batch, i))
                first, code = block.distinct(start, run)
                entries = np.zeros(len(first), ENTRY)
                entries["least"], entries["most"] = _NONE, np.iinfo(np.int64).min
                np.minimum.at(entries["least"], code, block.ids[doc])
                np.maximum.at(entries["most"], code, block.ids[doc])
                start, spot = start[first], mix(route[first])
                entries["name"], entries["length"] = np.arange(len(first)), run[first] + LENGTH - 1
                entries["collection"] = (spot >> np.uint64(32)) % np.uint64(GROUP)
                rows = []
                for group, at in _slices((spot % np.uint64(groups)).astype(np.int64)):
                    spans = zip(start[at].tolist(), entries["length"][at].tolist(), strict=True)
                    data = b"".join([block.data[s : s + n].tobytes() for s, n in spans])
                    rows.append((group, batch.column("block")[i].as_py(), _zipped(len(at).to_bytes(8, "little"), entries[at], data)))
                yield _batch(rows, ["group", "block", "held"], [pa.int32(), pa.int64(), pa.binary()])

    return blocks.mapInArrow(made, "group int, block long, held binary")


def _holders(texts: list[bytes], least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(entry, begin, end, id): for entries of a collection, each with the smallest and the largest
    id that hold it, the runs of strings that a smaller id than their largest holds, and which."""
    seen: dict[bytes, int] = {}
    code = np.array([seen.setdefault(t, len(seen)) for t in texts], np.int64)
    own = np.full(len(seen), _NONE)
    np.minimum.at(own, code, least)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in seen])]).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(np.diff(bounds) - LENGTH + 1)])
    holder = np.full(int(base[-1]), _NONE)
    parts = shared_prefixes(np.frombuffer(b"".join(seen), np.uint8), bounds, LENGTH)
    offset, string, group = (np.concatenate(x) for x in zip(*parts, strict=True))
    smallest = np.full(int(group.max(initial=0)) + 1, _NONE)
    np.minimum.at(smallest, group, own[string])
    holder[base[string] + offset] = smallest[group]
    # runs of one holder inside each segment
    edge = np.ones(len(holder), bool)
    edge[1:] = holder[1:] != holder[:-1]
    edge[base[:-1]] = True
    first = np.flatnonzero(edge)
    of = np.searchsorted(base, first, "right") - 1
    begin, end = first - base[of], np.append(first[1:], len(holder)) - base[of]
    head = np.searchsorted(of, np.arange(len(seen) + 1))
    many = np.diff(head)[code]
    entry = np.repeat(np.arange(len(code)), many)
    run = np.repeat(head[code] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    useful = holder[first[run]] < most[entry]
    entry, run = entry[useful], run[useful]
    return entry, begin[run], end[run], holder[first[run]]


def _verdicts(segments: DataFrame) -> DataFrame:
    """(block, verdicts): for segments of each block, runs of strings and the smallest id that
    holds each, where a larger id of the block holds them too."""

    def found(table: pa.Table) -> pa.Table:
        entries, texts = [], []
        for held in table.column("held").to_pylist():
            raw = _unzipped(held)
            size = int.from_bytes(raw[:8], "little") * ENTRY.itemsize
            own, data = np.frombuffer(raw[8 : 8 + size], ENTRY), raw[8 + size :]
            ends = np.cumsum(own["length"], dtype=np.int64)
            texts += [data[e - n : e] for e, n in zip(ends.tolist(), own["length"].tolist(), strict=True)]
            entries.append(own)
        sender = np.repeat(np.arange(len(entries)), [len(e) for e in entries])
        every = np.concatenate(entries)
        senders, decided = [], []
        for _, at in _slices(every["collection"]):
            entry, begin, end, holder = _holders([texts[k] for k in at], every["least"][at], every["most"][at])
            out = np.zeros(len(entry), VERDICT)
            out["name"], out["begin"], out["end"], out["id"] = every["name"][at][entry], begin, end, holder
            senders.append(sender[at][entry])
            decided.append(out)
        verdicts, blocks = np.concatenate(decided), table.column("block").to_pylist()
        rows = [(blocks[i], _zipped(verdicts[at])) for i, at in _slices(np.concatenate(senders))]
        return pa.Table.from_batches([_batch(rows, ["block", "verdicts"], [pa.int64(), pa.binary()])])

    return segments.groupBy("group").applyInArrow(found, "block long, verdicts binary")


def _marks(block: Block, flagged: np.ndarray, hot: np.ndarray, verdicts: np.ndarray) -> np.ndarray:
    """Which bytes of a block are removed."""
    cover = np.zeros(len(block.data) + 1, np.int32)
    if len(verdicts):
        start, run, _, doc = block.wanted(flagged, hot)
        _, name = block.distinct(start, run)
        verdicts = verdicts[np.argsort(verdicts["name"], kind="stable")]
        low = np.searchsorted(verdicts["name"], name, "left")
        many = np.searchsorted(verdicts["name"], name, "right") - low
        entry = np.repeat(np.arange(len(name)), many)
        found = verdicts[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
        earlier = found["id"] < block.ids[doc[entry]]
        entry, found = entry[earlier], found[earlier]
        np.add.at(cover, start[entry] + found["begin"], 1)
        np.add.at(cover, start[entry] + found["end"].astype(np.int64) - 1 + LENGTH, -1)
    return np.cumsum(cover[:-1]) > 0


def _cleaned(blocks: DataFrame, id_name: str, with_text: bool) -> DataFrame:
    names = [id_name, "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * with_text

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _read(batch, i)
                verdicts = np.frombuffer(b"".join(map(_unzipped, batch.column("verdicts")[i].as_py() or [])), VERDICT)
                marked = _marks(block, *_flags(batch, i), verdicts)
                rows = []
                for d in range(block.count):
                    at = slice(block.bounds[d], block.bounds[d + 1])
                    gone = marked[at]
                    kept = block.data[at][~gone].tobytes()
                    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    name = None if block.null[d] else int(block.ids[d])
                    row = (name, len(gone), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
                    rows.append(row + ((kept,) if with_text else ()))
                yield _batch(rows, names, kinds)

    schema = f"`{id_name}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return blocks.mapInArrow(made, schema + (", kept_text binary" if with_text else ""))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
                   hot: int = HOT) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) for every row and, if asked for, ``kept_text``,
    the bytes that stay; cutting between the bytes of a code point may leave no valid text."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # a row of these tables is a block, so few of them make a batch
    with session_settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": 512}):
        scratch.put(_blocks(own), "blocks", compression="none")
    with session_settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": 8}):
        blocks = scratch.get("blocks")
        total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        flags = scratch.put(_repeated(_anchors(blocks, 1 + total // PART_BYTES), hot), "flags")
        scratch.release()
        many = flags.agg(F.sum("n")).first()[0] or 0
        by_block = flags.groupBy("block").agg(F.collect_list("anchors").alias("flagged"), F.collect_list("hot").alias("hot"))
        # written once: the shuffle that joins the blocks to their anchors is then over
        flagged = scratch.put(blocks.join(by_block, "block", "left"), "flagged", compression="none")
        scratch.drop("blocks", "flags")
        scratch.release()
        found = _segments(flagged, 1 + many // (COLLECTION_SEGMENTS * GROUP))
        verdicts = scratch.put(_verdicts(found), "verdicts")
        scratch.release()
        decided = verdicts.groupBy("block").agg(F.collect_list("verdicts").alias("verdicts"))
        whole = flagged.join(decided, "block", "left")
        result = scratch.put(_cleaned(whole, id_col, with_text), "result")
    scratch.drop("flagged", "verdicts")
    scratch.release()
    return result
