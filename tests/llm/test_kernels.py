"""The numpy kernels against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerflow.llm import kernels as K

TEXTS = ["", None, " ", "a", "A a\tB", "one two  three\nfour five", "x\x0by\x0cz", "Été  nbsp", "!!! ??? a-b", "w " * 50]


def _words(text):
    return (text or "").encode().lower().split()


def test_words_are_the_white_space_separated_ones_in_any_slicing(monkeypatch):
    data, offs = K.text_buffers(pa.array(TEXTS))
    for limit in (1, 7, 10_000):
        seen = {}
        for lo, hi in K.slices(offs, limit):
            words, bounds = K.word_hashes(data, offs[lo : hi + 1])
            for i in range(lo, hi):
                got = words[bounds[i - lo] : bounds[i - lo + 1]].tolist()
                want = _words(TEXTS[i])
                assert len(got) == len(want)
                for h, w in zip(got, want, strict=True):
                    assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_a_text_longer_than_a_slice_gives_the_same_words(monkeypatch):
    rnd = random.Random(1)
    text = " ".join("".join(rnd.choices("abc", k=rnd.randint(1, 9))) for _ in range(4000))
    data, offs = K.text_buffers(pa.array([text]))
    whole, _ = K.word_hashes(data, offs)
    monkeypatch.setattr(K, "SLICE_BYTES", 512)
    parts, bounds = K.word_hashes(data, offs)
    assert bounds.tolist() == [0, len(whole)] and (parts == whole).all()
    counts = K.gram_counts(data, (1, 3), 10)
    monkeypatch.setattr(K, "SLICE_BYTES", 1 << 20)
    assert all((a == b).all() for a, b in zip(counts, K.gram_counts(data, (1, 3), 10), strict=True))


def test_shingle_sets_and_signatures():
    texts = ["a b c d", "A  B\nc d", "d c b a", "a b", "a b ", "b a", "", None, "a b c a b c a b c"]
    data, offs = K.text_buffers(pa.array(texts))
    sets, bounds = K.shingle_sets(data, offs, 3)
    sizes = np.diff(bounds).tolist()
    assert sizes == [2, 2, 2, 1, 1, 1, 0, 0, 3]
    sig = K.signatures(sets, bounds).tolist()
    assert sig[0] == sig[1] != sig[2] and sig[3] == sig[4] != sig[5] and sig[6] == sig[7] == 0


def test_punctuation_can_separate_words():
    data, offs = K.text_buffers(pa.array(["It's, (really) a-b!", "it s really a b"]))
    words, bounds = K.word_hashes(data, offs, alnum=True)
    assert bounds.tolist() == [0, 5, 10] and (words[:5] == words[5:]).all()


@pytest.mark.parametrize("texts", [[], [None, None], [""]])
def test_empty_columns(texts):
    data, offs = K.text_buffers(pa.array(texts, pa.string()))
    assert len(offs) == len(texts) + 1
    assert list(K.slices(offs)) == ([(0, len(texts))] if texts else [])
    if texts:
        assert len(K.word_hashes(data, offs)[0]) == 0
