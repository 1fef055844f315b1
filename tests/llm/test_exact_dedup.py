"""Exact dedup against grouping by normalised text."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np

from leaseflow.llm import exact_dedup as E
from tests.llm.data import SCHEMA, documents, edge_rows, sentence


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    out = []
    for body, ids in groups.items():
        some = [i for i in ids if i is not None]
        keep = min(some) if some else None
        for i in ids:
            out.append((i, keep, len(ids), i is not None and i == keep,
                        hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


def result(frame):
    return sorted((tuple(r) for r in frame.drop("row_key").collect()), key=str)


def test_edge_cases(spark):
    rows = edge_rows()
    assert result(E.exact_duplicates(documents(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert E.exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert E.drop_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_colliding_fingerprints_are_noticed(spark):
    """One-byte fingerprints collide; the result is right all the same."""
    rng = random.Random(3)
    rows = [(i, sentence(rng, 300)) for i in range(400)] + [(500 + i, None) for i in range(3)]
    rows += [(1000 + i, rows[i][1].replace(" ", "  ")) for i in range(50)]
    assert result(E.exact_duplicates(documents(spark, rows), width=1)) == brute(rows)


def test_one_row_of_a_group_stays(spark):
    rows = edge_rows()
    docs = documents(spark, rows)
    left = E.drop_copies(docs)
    assert left.columns == docs.columns
    # One row a text; a text without any id keeps a row too.
    bodies = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in left.collect()]
    assert len(bodies) == len(set(bodies)) == len({b[4] for b in brute(rows)})
    assert {r.doc_id for r in left.collect()} == {r[0] for r in brute(rows) if r[3]}


def test_chunks_cover_texts_and_move_with_content():
    rng = np.random.default_rng(5)
    text = rng.integers(97, 123, 60_000, dtype=np.uint8)
    shifted = np.concatenate([rng.integers(97, 123, 777, dtype=np.uint8), text])

    def chunks(data):
        ends, = E.cuts(data, np.array([0, len(data)]))
        assert ends[-1] == len(data) and max(np.diff([0, *ends])) <= E.MAX_CHUNK
        return {data[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)}

    one, two = chunks(text), chunks(shifted)
    assert len(one & two) > 0.9 * len(one)
