"""Lexical search against scores computed document by document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from leaseflow.llm import lexical_search as S
from leaseflow.llm import queries as Q
from tests.conftest import SMALL
from tests.llm.data import CLASHING, SCHEMA, documents, edge_rows, sentence
from pyspark.sql import functions as F

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, items, top=10):
    """docs: (doc_id, text), items: (item_id, text) -> rows (item_id, rank, doc_id, score)."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, words = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for d, c, n in counts:
            m = 100 - 90 + (90 * n * n_docs) // words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored, key=lambda r: r[:3])[:top], 1)]
    return sorted(out, key=str)


def result(frame):
    assert frame.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in frame.collect()), key=str)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").withColumns(
        {c: F.lit("x") for c in CLASHING})


def collection(seed, n=300, words=400):
    rng = random.Random(seed)
    rows = [(i, sentence(rng, int(rng.expovariate(1 / 60)), words)) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(40)]  # ties
    rows += [(n + 40 + i, rows[3][1] + " W1 w1, W1;w1 " + "w2 " * i) for i in range(40)]
    items = [(i, sentence(rng, 12, words)) for i in range(15)]
    items += [(100 + i, " ".join(rows[i][1].split()[:25])) for i in range(15)]
    return rows, items


@pytest.mark.parametrize("top,seeds,block", [(10, 50, 20_000), (3, 3, 30)])
def test_equals_plain_scores(spark, top, seeds, block):
    rows, items = collection(top)
    got = S.search(documents(spark, rows), items_of(spark, items), top=top, seeds=seeds, block_terms=block)
    assert result(got) == plain(rows, items, top)


def test_bounds_are_never_below_scores_and_exclude_documents(spark):
    rows, items = collection(9, 600, 3000)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.col("doc_id"))
    index = S.build_index(docs)
    block = S.weigh(docs, next(S.item_blocks(items_of(spark, items))))
    hashes = S.X.string_hashes(S.pa.array(block.vocabulary, S.pa.large_string()))
    bound = {}
    for row in index.collect():
        for keys, values in S._bounds(row.asDict(), block, hashes):
            for k, key in enumerate(keys.tolist()):
                for q, item in enumerate(block.ids):
                    bound[item, key] = values[q, k]
    exact = {(i, d): s for i, _, d, s in plain(rows, items, 10**9)}
    assert all(bound[pair] >= score for pair, score in exact.items())
    least = S.reach(docs, index, block, 10, 50)
    tenth = {(i, r): s for i, r, _, s in plain(rows, items)}
    assert all(low <= tenth.get((item, 10), 1) for item, low in zip(block.ids, least, strict=True))
    kept = {r["key"] for r in S.candidates(index, block, least).collect()}
    assert {d for _, _, d, _ in plain(rows, items)} <= kept
    assert len(kept) < 0.7 * len(rows)  # the signatures do exclude


def test_a_wrong_signature_changes_the_answer(spark, monkeypatch):
    """The answer depends on the bitmaps: with emptied ones nothing is found."""
    rows, items = collection(4, 80)
    monkeypatch.setattr(S, "_bounds", lambda row, block, hashes: [
        (np.asarray(row["keys"]), np.zeros((len(block.ids), len(row["keys"]))))])
    assert S.search(documents(spark, rows), items_of(spark, items)).isEmpty()


def test_edge_rows(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    items = [(1, "one two"), (1, "one two"), (2, None), (3, " ,. "), (4, "É" * 30 + " w1 w2 w3"), (None, "w5 w6"),
             (5, rows[3][1]), (6, "unseen"), (7, "ONE")]
    got = S.search(documents(spark, edge_rows()), items_of(spark, items))
    assert result(got) == plain(rows, items)
    assert S.search(documents(spark, []), items_of(spark, items)).isEmpty()
    assert S.search(documents(spark, edge_rows()), items_of(spark, [])).isEmpty()


def test_many_equal_documents(spark):
    rows = [(i, "alpha beta gamma") for i in range(500)] + [(500 + i, f"alpha x{i}") for i in range(50)]
    got = S.search(documents(spark, list(reversed(rows))), items_of(spark, [(1, "alpha gamma")]))
    assert result(got) == plain(rows, [(1, "alpha gamma")])


def test_lengths_beyond_64_bits():
    m = S.relative_lengths(np.array([10**12, 5]), 10**13, 10**16)
    assert m.tolist() == [10 + 90 * 10**12 * 10**13 // 10**16, 10]


def test_query_on_the_given_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert result(Q.QUERIES["op11_lexical_search"](spark, SMALL)) == plain(docs, items)
