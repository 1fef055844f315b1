"""Vector neighbours against all pairs, recall at the threshold included."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from leaseflow.llm import queries as Q
from leaseflow.llm import vector_neighbours as V
from tests.conftest import MEDIUM

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, cosine=V.THRESHOLD):
    """Links per row and component per id, for rows with ids."""
    units = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        u = np.array(v, np.float32).astype(float) if ok else None
        units.append(u / np.linalg.norm(u) if ok else None)
    links, root = [0] * len(rows), {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = 0
    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= cosine:
                links[i], links[j], pairs = links[i] + 1, links[j] + 1, pairs + 1
                if None not in (rows[i][0], rows[j][0]):
                    p, q = find(rows[i][0]), find(rows[j][0])
                    root[max(p, q)] = min(p, q)
    return links, {k: find(k) for k in root if k is not None}, pairs


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumns(
        {"v": F.lit(1), "rep": F.lit("x"), "valid": F.lit(None).cast("boolean")})


def at_cosine(rng, v, cosine):
    """A unit vector at an exact cosine to v."""
    other = rng.standard_normal(len(v))
    other -= other @ v * v
    return cosine * v + np.sqrt(1 - cosine ** 2) * other / np.linalg.norm(other)


def test_recall_at_the_threshold(spark):
    """Pairs hardly above and below it, among many others."""
    rng = np.random.default_rng(2)
    rows = []
    for k in range(1200):
        v = rng.standard_normal(64)
        v /= np.linalg.norm(v)
        rows += [(2 * k, v), (2 * k + 1, at_cosine(rng, v, 0.9001 if k % 2 else 0.8999))]
    rows = [(i, (3 * v).astype(np.float32).tolist()) for i, v in rows]
    got = {r.vec_id: r for r in V.near_vectors(frame(spark, rows)).collect()}
    links, parts, pairs = brute(rows)
    for (i, _), n in zip(rows, links, strict=True):
        assert got[i].n_links <= n
    assert sum(r.n_links for r in got.values()) >= 0.93 * 2 * pairs


@pytest.mark.parametrize("block", [V.BLOCK, 8])
def test_hot_cluster_in_any_blocks(spark, block):
    """A third of the rows lie close together; copies among them."""
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(32)
    rows = [(i, (centre + 0.03 * rng.standard_normal(32)).tolist()) for i in range(100)]
    rows += [(100 + i, rng.standard_normal(32).tolist()) for i in range(200)]
    rows += [(400 + i, rows[i][1]) for i in range(40)]
    rng.shuffle(rows)
    got = {r.vec_id: r for r in V.near_vectors(frame(spark, rows), block=block).collect()}
    links, parts, _ = brute(rows)
    assert {i: r.n_links for i, r in got.items()} == {r[0]: n for r, n in zip(rows, links, strict=True)}
    assert {i: r.component_id for i, r in got.items()} == parts
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_edge_cases(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, one), (8, [2.0, 4.0, 6.0]), (8, [2.0, 4.0, 6.0]), (9, one),
            (None, one), (None, None), (10, [-1.0, -2.0, -3.0]), (11, [1.0, 2.0]),
            (12, [1e-30, 2e-30, 3e-30]), (13, [1e30, 2e30, 3e30])]
    got = V.near_vectors(frame(spark, rows)).collect()
    links, parts, _ = brute(rows)
    assert sorted((str(r.vec_id), r.n_links) for r in got) == sorted(
        (str(r[0]), n) for r, n in zip(rows, links, strict=True))
    assert {r.vec_id: r.component_id for r in got if r.vec_id is not None} == parts
    assert sorted(str(r.component_id) for r in got if r.vec_id is None) == ["7", "None"]
    assert V.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_grows_slowly():
    small, large = V.plan(10**4), V.plan(10**8)
    assert large.cuts > small.cuts and large.tables < 100 * small.tables
    assert V.least_collisions(0.9, 0.99) <= V.VIEWS * V.collision_chance(0.9)


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    got = {r.vec_id: r for r in Q.QUERIES["op5_vector_neighbours"](spark, MEDIUM).collect()}
    links, parts, _ = brute(rows)
    want = defaultdict(int, {r[0]: n for r, n in zip(rows, links, strict=True)})
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(links)
    assert all(r.n_links <= want[i] for i, r in got.items())
