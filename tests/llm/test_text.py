"""Words, hashes and runs of words against plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from leaseflow.llm import text as X

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")


def sliced(texts, limit=X.SLICE_BYTES):
    batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
    return list(X.slices(batch, "text", limit))


def test_words_and_hashes_in_any_slicing():
    rng = random.Random(2)
    letters = [*"ab \t\n", "é", "\x0b", "\x1c", " "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(300)] + [None, "", "z"]
    seen: dict[bytes, int] = {}
    for limit in (1, 40, 10_000):
        got = []
        for rows, data, offsets in sliced(texts, limit):
            starts, ends, first = X.words(data, offsets)
            hashes = X.word_hashes(data, starts, ends)
            words = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
            for w, h in zip(words, hashes.tolist(), strict=True):
                assert seen.setdefault(w, h) == h
            got += [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
            assert len(first) == rows.num_rows + 1
        assert got == [SPACE.findall((t or "").encode()) for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_hashes_of_long_texts_do_not_depend_on_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000))
    (_, data, offsets), = sliced([text])
    starts, ends, _ = X.words(data, offsets)
    whole = X.word_hashes(data, starts, ends)
    monkeypatch.setattr(X, "SLICE_BYTES", 50)
    assert (X.word_hashes(data, starts, ends) == whole).all()
    assert (X.word_hashes(data, starts, ends, fold=True) == whole).all()


def test_runs_of_words():
    texts = ["a b c d e f", "", "a b", "b c d e f g", "a b c d e"]
    (_, data, offsets), = sliced(texts)
    starts, ends, first = X.words(data, offsets)
    runs, where = X.shingles(X.word_hashes(data, starts, ends), first, 5)
    assert np.diff(where).tolist() == [2, 0, 1, 2, 1]
    assert runs[0] == runs[5] and runs[1] == runs[3] and len(set(runs.tolist())) == 4


def test_sequence_keys_tell_order_and_length_apart():
    texts = ["a b", "b a", "a b b", "a", "", "a  b"]
    (_, data, offsets), = sliced(texts)
    starts, ends, first = X.words(data, offsets)
    keys = [tuple(k) for k in X.sequence_keys(X.word_hashes(data, starts, ends), first).tolist()]
    assert keys[0] == keys[5] and len(set(keys)) == 5
