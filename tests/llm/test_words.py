from __future__ import annotations

import numpy as np
import pyarrow as pa
from cases import WORD
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from lakeferry.llm import words
from lakeferry.llm.words import Texts, chunks, windows, within

TEXT = st.text(alphabet=st.sampled_from("ab \t\n\r\x0b\x0cAé日  "), max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 40))
def test_words_and_hashes(texts, limit):
    found, hashes = [], {}
    for first, last, part in chunks(pa.array(texts, pa.string()), limit=limit):
        assert last - first == part.count
        words = [part.word(i).decode() for i in range(len(part.starts))]
        for i in range(part.count):
            found.append(words[part.word_bounds[i] : part.word_bounds[i + 1]])
        for word, value in zip(words, part.word_hashes(), strict=True):
            assert hashes.setdefault(word, value) == value
    assert found == [WORD.findall(t or "") for t in texts]
    assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=30), st.integers(1, 6))
def test_windows(values, k):
    found = windows(np.array(values, np.uint64), k)
    plain = [tuple(values[i : i + k]) for i in range(len(values) - k + 1)]
    assert len(found) == len(plain)
    assert len(set(zip(plain, found.tolist(), strict=True))) == len(set(plain)) == len(set(found.tolist()))


def test_windows_stay_in_documents():
    bounds = np.array([0, 3, 3, 4, 9])
    inside = within(bounds, 3, 9)
    assert [i for i in range(7) if inside[i]] == [0, 4, 5, 6]


def thue_morse(n: int) -> tuple[str, str]:
    """A word and its complement, which have equal sums under every polynomial modulo 2^64."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_no_pattern_of_bytes_cancels():
    for n in (256, 1024, 4096, 1 << 16):
        part = next(x for *_, x in chunks(pa.array([" ".join(thue_morse(n))])))
        assert len(set(part.word_hashes().tolist())) == 2


def test_hashes_are_the_polynomial():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    texts = Texts(data, np.array([0, 5000]))
    starts = rng.integers(0, 4000, 200)
    ends = starts + rng.integers(0, 1000, 200)
    found = texts.hashes(starts, ends)
    for s, e, h in zip(starts.tolist(), ends.tolist(), found.tolist(), strict=True):
        plain = sum((int(v) + 1) * pow(words._BASE, j, words.PRIME) for j, v in enumerate(data[s:e])) % words.PRIME
        with np.errstate(over="ignore"):
            expected = words.mix(np.array([plain], np.uint64) + np.array([e - s], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        assert int(expected[0]) == h


def test_runs_longer_than_the_exact_sums(monkeypatch):
    data = np.random.default_rng(2).integers(0, 256, 3000).astype(np.uint8)
    starts, ends = np.array([0, 7, 100]), np.array([3000, 2500, 130])
    whole = Texts(data, np.array([0, 3000])).hashes(starts, ends)
    monkeypatch.setattr(words, "_EXACT_BYTES", 64)
    assert (Texts(data, np.array([0, 3000])).hashes(starts, ends) == whole).all()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.data())
def test_ends_of_runs(raw, draw):
    data = np.frombuffer(raw, np.uint8)
    start = draw.draw(st.integers(0, len(raw)))
    end = draw.draw(st.integers(start, len(raw)))
    first, last = Texts(data, np.array([0, len(raw)])).ends_of(np.array([start]), np.array([end]))[0].tolist()
    run = raw[start:end]
    tail = int.from_bytes(run[-8:], "little") if len(run) > 8 else 0
    with np.errstate(over="ignore"):
        scrambled = words.mix(np.array([tail], np.uint64) + np.array([len(run)], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    assert first == int.from_bytes(run[:8], "little") and last == int(scrambled[0])


def test_functions_can_be_sent_to_tasks_after_they_ran_here():
    assert list(chunks(pa.array(["a b"]), limit=9))
    assert cloudpickle.loads(cloudpickle.dumps(chunks)) is not None
