"""Packing documents into fixed windows by sum of squares.

A document is its token ids in a public vocabulary and an end id. Full windows are cut off it; what
is left, shorter than a window, is placed online: of all fill levels among the open windows (and an
empty one) it goes to the one that minimises the sum of the squared counts of open windows per
level. Counts live in a level array, so a choice costs one pass over as many numbers as a window
has tokens. Levels that are common become likely to be completed, and few windows stay open.

What is still open at the end of a task, or beyond `open_windows`, is joined and cut into full
windows; the rest of that, less than one window, is cut into powers of two, which need no padding.

Each task packs its own input split and holds the level array and the open windows, so nothing is
shuffled and a lost task is repeated with the same result.

Defined results: a null or empty text is the end id alone; every row is a document of its own,
whatever its id, null and repeated ids included; an empty table gives an empty one. Only the id and
the text column are read.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.llm.words import CHUNK_BYTES, Texts, chunks

VOCABULARY = "word_bpe_49k.json"
WINDOW = 2048
END = 1
OPEN_WINDOWS = 4096
# Parts that a task remembers the ids of; then it starts anew.
REMEMBERED = 900_000

# Kinds of bytes: letters (or of longer code points), points, and digits and apostrophes, whose
# words are encoded whole.
_LETTER, _POINT, _OTHER = 1, 2, 3
_KIND = np.full(256, _POINT, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[[*range(48, 58), ord("'")]] = _OTHER
_EMPTY, _WHOLE = np.uint64(0), np.uint64(0x5851F42D4C957F2D)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Ids:
    """Token ids of whole texts, word by word.

    The vocabulary drops white space and never joins across it, so the ids of a text are those of
    its words; a word of letters followed by punctuation is two parts that never join either. The
    ids of a part are remembered by the hash of its bytes, so each is encoded once; its size and its
    first and last eight bytes are compared as well, and a text with a part that has only the hash of
    another one is encoded whole. Parts of
    letters are encoded together, one token of each ending a part; if the number of ends is not
    that of parts, and for all other words, each is encoded alone.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        """Remember only the empty part, in slot 0."""
        self.keys, self.slots = np.array([_EMPTY], np.uint64), np.zeros(1, np.int32)
        self.offset, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.bytes = np.zeros((1 << 16, 2), np.uint64)
        self.flat, self.used, self.count = np.zeros(1 << 20, np.uint32), 0, 1

    def alone(self, part: bytes) -> np.ndarray:
        return np.array(self.model.encode(part.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)

    def together(self, parts: list[bytes]) -> list[np.ndarray]:
        ids = np.array(self.model.encode(b" ".join(parts).decode(), add_special_tokens=False).ids, np.uint32)
        cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(cuts) != len(parts):
            return [self.alone(p) for p in parts]
        return [ids[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    @staticmethod
    def plain(part: bytes) -> bool:
        """Letters that stay letters, one to one, in lower case and composed."""
        if part.isascii():
            return True
        try:
            text = part.decode()
        except UnicodeDecodeError:
            return False
        return text.isalpha() and text.lower().isalpha() and unicodedata.is_normalized("NFC", text)

    def remember(self, keys: np.ndarray, known: np.ndarray, ids: list[np.ndarray | None]) -> None:
        """Add parts, in slots that stay theirs; None is a part of letters that does not stand for itself."""
        length = np.array([-1 if x is None else len(x) for x in ids], np.int64)
        sizes = np.maximum(length, 0)
        added = np.concatenate([np.zeros(0, np.uint32), *[x for x in ids if x is not None]])
        while self.used + len(added) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        while self.count + len(keys) > len(self.length):
            self.offset, self.length, self.bytes = (np.append(x, np.zeros_like(x), axis=0) for x in (self.offset, self.length, self.bytes))
        self.flat[self.used : self.used + len(added)] = added
        new = slice(self.count, self.count + len(keys))
        self.offset[new], self.length[new], self.bytes[new] = self.used + np.cumsum(sizes) - sizes, length, known
        at = np.searchsorted(self.keys, keys)  # in order, being distinct
        self.keys = np.insert(self.keys, at, keys)
        self.slots = np.insert(self.slots, at, np.arange(new.start, new.stop, dtype=np.int32))
        self.used += len(added)
        self.count = new.stop

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slots, which are known)."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.slots[at], self.keys[at] == keys

    def learn(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, letters: bool) -> np.ndarray:
        """The slots of the parts, new ones included."""
        distinct, first, code = np.unique(keys, return_index=True, return_inverse=True)
        slots, known = self.find(distinct)
        new = np.flatnonzero(~known)
        if len(new):
            parts = [texts.data[a:b].tobytes() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            if letters:
                plain = [i for i, p in enumerate(parts) if self.plain(p)]
                ids: list[np.ndarray | None] = [None] * len(parts)
                for at in range(0, len(plain), 2000):
                    some = plain[at : at + 2000]
                    for i, x in zip(some, self.together([parts[i] for i in some]), strict=True):
                        ids[i] = x
            else:
                ids = [self.alone(p) for p in parts]
            slots[new] = self.count + np.arange(len(new))
            self.remember(distinct[new], texts.ends_of(starts[first[new]], ends[first[new]]), ids)
        return slots[code]

    def encode(self, texts: Texts) -> list[np.ndarray]:
        """The ids of each text, of bytes in lower case, the end id last."""
        if self.count > REMEMBERED:
            self.forget()
        starts, ends = texts.starts, texts.ends
        kind = _KIND[texts.data]
        turns = np.zeros(len(kind) + 1, np.int32)
        np.cumsum(kind[1:] != kind[:-1], out=turns[1:-1]) if len(kind) else None
        turned = turns[ends - 1] - turns[starts] if len(starts) else starts
        letters = np.zeros(len(kind) + 1, np.int32)
        np.cumsum(kind == _LETTER, out=letters[1:])
        middle = starts + letters[ends] - letters[starts]
        regular = (turned == 0) & (middle == ends)
        if len(starts):
            regular |= (turned == 1) & (kind[starts] == _LETTER) & (kind[ends - 1] == _POINT)
        # letters, then points; a word of other bytes is one part
        at = np.flatnonzero(regular)
        place = self.learn(texts, starts[at], middle[at], texts.hashes(starts[at], middle[at]), True)
        wrong = [texts.word_doc[at[self.differ(place, texts, starts[at], middle[at])]]]
        whole = self.length[place] >= 0
        regular[at[~whole]] = False
        slots = np.zeros((len(starts), 2), np.int64)
        slots[at[whole], 0] = place[whole]
        middle = np.where(regular, middle, starts)
        at = np.flatnonzero(middle < ends)
        place = self.learn(texts, middle[at], ends[at], texts.hashes(middle[at], ends[at]) ^ _WHOLE, False)
        wrong.append(texts.word_doc[at[self.differ(place, texts, middle[at], ends[at])]])
        slots[at, 1] = place
        place = slots.ravel()
        texts.release()
        lengths, offset = self.length[place].astype(np.int64), self.offset[place]
        # the end id of a document comes behind its last part
        doc = np.repeat(texts.word_doc, 2)
        first = np.cumsum(lengths) - lengths
        inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        out = np.full(int(lengths.sum()) + texts.count, END, np.uint32)
        out[np.repeat(first + doc, lengths) + inside] = self.flat[np.repeat(offset, lengths) + inside]
        size = np.bincount(doc, lengths, texts.count).astype(np.int64) + 1
        cuts = np.cumsum(size)
        found = [out[a:b] for a, b in zip((cuts - size).tolist(), cuts.tolist(), strict=True)]
        for i in np.unique(np.concatenate(wrong)).tolist():
            found[i] = np.append(self.alone(texts.data[texts.bounds[i] : texts.bounds[i + 1]].tobytes()), np.uint32(END))
        return found

    def differ(self, place: np.ndarray, texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which parts are not the remembered ones at these places, by their size and ends."""
        return (self.bytes[place] != texts.ends_of(starts, ends)).any(1)


class Piece:
    __slots__ = ("doc", "start", "ids", "tokens")

    def __init__(self, doc, start: int, ids: np.ndarray, tokens: int):
        self.doc, self.start, self.ids, self.tokens = doc, start, ids, tokens

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.start, self.ids[:n], self.tokens),
            Piece(self.doc, self.start + n, self.ids[n:], self.tokens),
        )


class Packer:
    """The open windows of one task by fill level."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS):
        self.window, self.most = window, open_windows
        self.counts = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = {}
        self.held = 0

    def level_for(self, size: int) -> int:
        """The fill level whose window takes a piece at the least sum of squares; 0 is a new one."""
        if not self.held:
            return 0
        counts = self.counts
        now = counts[1 : self.window - size + 1]
        then = counts[1 + size : self.window + 1]  # full windows count as none
        change = 2 * (then - now) + 2
        if len(change):
            change[-1] -= 1
            change[now == 0] = np.iinfo(np.int64).max
            best = len(change) - int(np.argmin(change[::-1]))  # the fullest of equals
            if change[best - 1] <= 2 * counts[size] + 1:
                return best
        return 0

    def place(self, piece: Piece) -> list[list[Piece]]:
        """Windows that this piece completes."""
        size = len(piece.ids)
        level = self.level_for(size)
        if level:
            held = self.open[level].pop()
            self.counts[level] -= 1
            self.held -= 1
        else:
            held = []
        held.append(piece)
        level += size
        if level == self.window:
            return [held]
        self.open.setdefault(level, []).append(held)
        self.counts[level] += 1
        self.held += 1
        return self.close(all_of_it=False) if self.held > self.most else []

    def add(self, doc, ids: np.ndarray) -> list[list[Piece]]:
        done, at = [], 0
        while len(ids) - at >= self.window:
            done.append([Piece(doc, at, ids[at : at + self.window], len(ids))])
            at += self.window
        if at < len(ids):
            done += self.place(Piece(doc, at, ids[at:], len(ids)))
        return done

    def close(self, all_of_it: bool = True) -> list[list[Piece]]:
        """Join the open windows, fullest first, and cut full ones; at the end the rest as well."""
        pieces = [p for level in sorted(self.open, reverse=True) for held in self.open[level] for p in held]
        self.counts[:] = 0
        self.open, self.held = {}, 0
        rest = sum(len(p.ids) for p in pieces)  # from the window being filled on
        done: list[list[Piece]] = []
        held: list[Piece] = []
        filled = 0
        for piece in pieces:
            while piece is not None:
                short = all_of_it and rest < self.window
                goal = 1 << (rest.bit_length() - 1) if short else self.window
                part, piece = piece.cut(goal - filled) if len(piece.ids) > goal - filled else (piece, None)
                held.append(part)
                filled += len(part.ids)
                if filled == goal:
                    done.append(held)
                    rest -= goal
                    held, filled = [], 0
        if held:
            self.open[filled] = [held]
            self.counts[filled], self.held = 1, 1
        return done


_ids: dict[str, Ids] = {}


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and,
    if asked for, ``ids``. A sequence's pieces follow each other without gaps."""
    path = path or vocabulary_path()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("packed text"))
    fields = [T.StructField(id_col, rows.schema[0].dataType, True)] + [
        T.StructField(name, T.LongType(), False)
        for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False), False))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _ids.setdefault(path, None) or Ids(path)
        _ids[path] = ids
        packer = Packer(window)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 40
        kind = None

        def table(done: list[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            docs_, columns, real = [], [[] for _ in range(6)], []
            for held in done:
                offset = 0
                for p in held:
                    docs_.append(p.doc)
                    raw = p.ids.astype("<u4").tobytes()
                    for column, value in zip(
                        columns, (p.start, len(p.ids), zlib.crc32(raw), p.tokens, number, offset), strict=True
                    ):
                        column.append(value)
                    if with_ids:
                        real.append(p.ids.astype(np.int32))
                    offset += len(p.ids)
                number += 1
            if docs_:
                arrays = [pa.array(docs_, kind)] + [pa.array(c, pa.int64()) for c in columns]
                names = [f.name for f in fields]
                if with_ids:
                    bounds = np.cumsum([0] + [len(r) for r in real])
                    arrays.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(real))))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            kind = batch.column(0).type
            names = batch.column(0).to_pylist()
            for first, last, texts in chunks(batch.column(1), lower=True, limit=2 * CHUNK_BYTES):
                done = []
                for name, own in zip(names[first:last], ids.encode(texts), strict=True):
                    done += packer.add(name, own)
                yield from table(done)
        if kind is not None:
            yield from table(packer.close())

    return rows.mapInArrow(packed, T.StructType(fields))
