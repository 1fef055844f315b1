"""Token counts against the tokenizer library."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import regex
from tokenizers import Regex, Tokenizer, normalizers

from leaseflow.llm import queries as Q
from leaseflow.llm import token_counts as T
from tests.conftest import SMALL
from tests.llm.data import SCHEMA, documents, edge_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def tokens(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return T.Counter(PATH)


def test_random_texts(counter, monkeypatch):
    monkeypatch.setattr(T, "CACHED", 50)
    rng = random.Random(3)
    parts = [*"ab'sret  \n\t\x1c\x85   éß12٣中文😀-_.", "<|endoftext|>", "<|endof", "don't", "hello",
             " world", "ऀ", "\u088f", "\u0558", "\U00011de0"]
    for _ in range(2500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        assert counter.count(text) == tokens(text), repr(text)


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 10_000, " " * 5000, "\n" * 999, "é" * 5000, "😀" * 300])
def test_long_pieces(counter, text):
    assert counter.count(text) == tokens(text)


def test_long_texts_are_cut_lazily(counter, monkeypatch):
    text = "some words, again. " * 300
    monkeypatch.setattr(T, "LONG_TEXT", 100)
    assert counter.count(text) == tokens(text)


@pytest.mark.parametrize("kind", [r"\p{L}", r"\p{N}", r"\s"])
def test_both_libraries_class_early_characters_alike(kind):
    early = "".join(chr(c) for c in range(0x558))
    theirs = set(early) - set(normalizers.Replace(Regex(kind), "").normalize_str(early))
    assert set(regex.findall(kind, early)) == theirs


def test_edge_cases(spark):
    rows = edge_rows()
    got = T.count_tokens(documents(spark, rows), PATH).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got), key=str) == sorted(
        ((r[0], len((r[1] or "").encode()), tokens(r[1]), tokens(r[1]) > 1024) for r in rows), key=str)
    assert T.count_tokens(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = Q.QUERIES["op4_token_counts"](spark, SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: tokens(t) for i, t in texts.items()}
