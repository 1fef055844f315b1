"""The similarity join against all pairs of full sets."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from leaseflow.llm import ngram_join as N
from leaseflow.llm import queries as Q
from tests.conftest import SMALL
from tests.llm.data import SCHEMA, documents, edge_rows, sentence

WORD = re.compile(rb"[^ \t\n\v\f\r!-/:-@\[-`{-~]+")


def runs(text):
    words = [w.lower() for w in WORD.findall((text or "").encode())]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """{row index: (class, links, kept)} for rows with ids."""
    sets = [runs(r[1]) for r in rows]
    links, root = defaultdict(int), {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                if rows[i][0] is not None and rows[j][0] is not None:
                    a, b = find(rows[i][0]), find(rows[j][0])
                    root[max(a, b)] = min(a, b)
    return sorted((r[0], find(r[0]), links[i], find(r[0]) == r[0])
                  for i, r in enumerate(rows) if r[0] is not None)


def result(frame):
    return sorted(tuple(r) for r in frame.drop("row_key").filter("doc_id IS NOT NULL").collect())


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [(N.BLOCK_TEXTS, N.BLOCK_RUNS), (4, 2000)])
def test_families_in_any_blocks(spark, block):
    rng = random.Random(8)
    rows = []
    for family in range(6):
        base = sentence(rng, 200)
        rows += [(100 * family + i, edited(rng, base, rng.randrange(0, 9))) for i in range(12)]
    rows += [(1000 + i, rows[i][1].upper() + "!") for i in range(10)]
    rng.shuffle(rows)
    got, want = result(N.near_duplicates(documents(spark, rows), block=block)), brute(rows)
    missing = sum(w[2] for w in want) - sum(g[2] for g in got)
    assert 0 <= missing <= 0.01 * sum(w[2] for w in want)
    if not missing:
        assert got == want


def test_edge_cases(spark):
    rows = edge_rows()
    out = N.near_duplicates(documents(spark, rows))
    assert result(out) == brute(rows)
    without = sorted((r.class_id, r.kept) for r in out.filter("doc_id IS NULL").collect() if r.class_id)
    assert without == [(4, None)] or without == [(4, False)]
    left = N.keep_one(documents(spark, rows))
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == sorted(
        r[0] for r in brute(rows) if r[3])
    assert left.columns == documents(spark, rows).columns


@pytest.mark.parametrize("block", [(N.BLOCK_TEXTS, N.BLOCK_RUNS), (2, 400)])
def test_texts_that_share_an_id_keep_the_links_of_each(spark, block):
    rng = random.Random(12)
    a, b, c, d, e = (sentence(rng, 200) for _ in range(5))
    rows = [(5, a), (5, b), (9, edited(rng, a, 1)), (10, edited(rng, b, 1)), (5, a),
            # A copy under a smaller id brings the other text of its id along.
            (20, c), (21, c), (21, d), (22, edited(rng, d, 1)),
            # Similar texts of one id alone, and an id with only one of its texts linked.
            (30, e), (30, edited(rng, e, 2)), (31, sentence(rng, 50)), (31, edited(rng, d, 2))]
    want = brute(rows)
    assert [w[0] for w in want if not w[3]] == [9, 10, 21, 21, 22, 31, 31]
    assert result(N.near_duplicates(documents(spark, rows), block=block)) == want


def test_empty_table(spark):
    assert N.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = N.choose_bands(threshold, 0.99, 256)
        assert 1 - (1 - threshold ** rows) ** bands >= 0.99 and bands * rows <= 256
    assert N.choose_bands(1.0) == (1, N.MOST_HASHES)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert result(Q.QUERIES["op10_ngram_jaccard_join"](spark, SMALL)) == brute(rows)
