"""Packing: every id in one piece, sequences without gaps, little padding, ids as the library's."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from leaseflow.llm import packing as P
from leaseflow.llm import queries as Q
from tests.conftest import SMALL
from tests.llm.data import SCHEMA, documents, edge_rows

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, pieces, window=P.WINDOW):
    """``rows`` have different ids."""
    texts, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        texts[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(texts) == {r[0] for r in rows}
    for doc_id, text, *_ in rows:
        want, at = ids(text), 0
        for p in sorted(texts[doc_id], key=lambda p: p.start):
            part = want[p.start:p.start + p.length]
            assert p.start == at and p.doc_tokens == len(want)
            assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            if "ids" in p.__fields__:
                assert np.frombuffer(p.ids, "<u4").tolist() == part
            at += p.length
        assert at == len(want)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    return sum(p.length for p in pieces) / window / len(sequences)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert check(rows, Q.QUERIES["op6_packing"](spark, SMALL).collect()) > 0.95


def test_edge_cases_and_small_windows(spark):
    rows = [r for r in {r[0]: r for r in edge_rows() if r[0] is not None}.values()]
    pieces = P.pack(documents(spark, rows), PATH, window=64, most_open=3, with_ids=True).collect()
    assert check(rows, pieces, 64) > 0.95


def test_rows_without_or_with_repeated_id(spark):
    rows = [(None, "a"), (None, "b"), (1, "c"), (1, "c"), (1, None)]
    pieces = P.pack(documents(spark, rows), PATH).collect()
    assert sorted(str(p.doc_id) for p in pieces) == ["1", "1", "1", "None", "None"]
    assert sum(p.length for p in pieces) == sum(len(ids(t)) for _, t in rows)


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_ids_of_runs_are_those_of_whole_texts(monkeypatch):
    """Random texts of awkward characters, small caches included."""
    import pyarrow as pa

    from leaseflow.llm import text as X
    monkeypatch.setattr(P, "CACHED_RUNS", 300)
    rng = random.Random(5)
    letters = [*"abZÀß'.,;:!? \t\n\x0b\x1c\x85 éÉİΣσςЖ１2٣中—-_<|>", "'s", "'re", "don't", "I'LL",
               "<|endoftext|>", "<|ENDOFTEXT|>", "é", "Å", ".̇", "ΟΔΟΣ"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(1500)]
    batch = pa.record_batch([pa.array(texts)], ["text"])
    for rows, data, offsets in X.slices(batch, "text", 300):
        got, bounds = P.encode(PATH, data, offsets)
        for text, a, b in zip(rows.column("text").to_pylist(), bounds[:-1], bounds[1:], strict=True):
            assert got[a:b].tolist() == ids(text)[:-1], text


def test_best_fit_keeps_few_windows_open():
    rng = random.Random(6)
    fit, fill, gone = P.BestFit(100, 4), defaultdict(int), set()
    for _ in range(2000):
        n = rng.randrange(1, 101)
        number, offset, emitted = fit.place(n)
        assert offset == fill[number] and number not in gone
        fill[number] += n
        assert fill[number] <= 100 and len(fit.open) <= 4
        if emitted is not None:
            gone.add(emitted)
