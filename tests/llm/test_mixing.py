"""Mixing against a plain computation of targets and of weighted sampling's rules."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from leaseflow.llm import mixing as M
from leaseflow.llm import queries as Q
from tests.conftest import SMALL
from tests.llm.data import SCHEMA, documents, edge_rows, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes: dict, weights=M.WEIGHTS, share=M.SHARE, most=M.MOST_EPOCHS):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        rest, all_ = total - sum(out.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / all_ > most * sizes[s]]
        if not over:
            out |= {s: rest * weight[s] / all_ for s in open_}
            break
        out |= {s: most * sizes[s] for s in over}
        open_ -= set(over)
    return out


def check(rows, got, whole=False):
    want = defaultdict(int)
    for r in rows:
        want[r[2]] += len(WORD.findall(r[1] or ""))
    goal, taken = targets(want), defaultdict(int)
    for r in got:
        assert r.source_size == want[r.source]
        assert r.target == pytest.approx(goal[r.source], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    largest = defaultdict(int)
    for r in got:
        largest[r.source] = max(largest[r.source], r.size)
    for s in goal:
        assert abs(taken[s] - goal[s]) <= (largest[s] / 2 + 1 if whole else 1)
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted(
        (str(r[0]), len(WORD.findall(r[1] or ""))) for r in rows)


def test_edge_cases(spark):
    rows = edge_rows()
    check(rows, M.mix(documents(spark, rows)).collect())


def test_hot_source_quality_and_reruns(spark):
    rng = random.Random(9)
    rows = [(i, sentence(rng, rng.randrange(1, 80)), f"s{rng.randrange(7) * (i % 3)}") for i in range(3000)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(3000)] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id bigint, quality int, toxic int")
    docs, weights = documents(spark, rows), M.quality_weights(labels)
    got = M.mix(docs, weights).collect()
    check(rows, got)
    again = M.mix(docs.repartition(5), weights).collect()
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in again}
    # Within the fractional part, good documents are taken more often.
    part = [r for r in got if 0 < r.target % r.source_size and r.size]
    more = {q: sum(r.taken > r.target // r.source_size * r.size for r in part if r.doc_id % 2 == q)
            for q in (0, 1)}
    assert more[1] > 1.3 * more[0]


def test_whole_documents(spark):
    rng = random.Random(10)
    rows = [(i, sentence(rng, rng.randrange(1, 80)), f"s{i % 5}") for i in range(600)]
    docs = documents(spark, rows)
    got = M.mix(docs, whole=True).collect()
    check(rows, got, whole=True)
    assert all(r.taken % r.size == 0 for r in got)
    times = defaultdict(int)
    for r in M.take_mix(docs).collect():
        times[r.doc_id] += 1
    assert {r.doc_id: r.taken // r.size for r in got if r.taken} == times
    assert M.take_mix(docs).columns == docs.columns


def test_equal_rows_share_all_that_is_taken(spark):
    rng = random.Random(11)
    base = sentence(rng, 10)
    rows = [(1, base, "a")] * 101 + [(1, base, "b")] * 7 + [(None, base, "c")] * 3
    rows += [(10 + i // 2, sentence(random.Random(i // 2), 10), "c") for i in range(40)]
    docs = documents(spark, rows).repartition(3)
    want, got = defaultdict(int), defaultdict(int)
    for r in M.mix(docs, whole=True).collect():
        want[r.source, r.doc_id] += r.copies
    for r in M.take_mix(docs).collect():
        got[r.source, r.doc_id] += 1
    assert got == {k: n for k, n in want.items() if n}
    assert want["a", 1] % 101 and want["a", 1] > 101


def test_empty_table(spark):
    assert M.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert M.take_mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sources_of_many_partitions_rank_by_code_point(spark):
    names = ["a", "B", "é", "", "z", "aa", None, "\U0001f600", "￮"]
    rows = spark.createDataFrame([(n is None, n or "", 10) for n in names],
                                 "no_source boolean, source string, size bigint")
    got = {(None if r.no_source else r.source): r.target for r in M.source_targets(rows).collect()}
    want = targets({n: 10 for n in names})
    assert got == pytest.approx(want)


def test_query(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    check(rows, Q.QUERIES["op8_mixing"](spark, SMALL).collect())
