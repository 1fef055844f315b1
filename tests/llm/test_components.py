from __future__ import annotations

import random

from leaseflow.llm.components import components


def test_components_of_chains_stars_and_nothing(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    edges += [(7, 7), (None, 3), (300, None)] + edges[:5]
    root = {v: v for e in edges for v in e if v is not None and None not in e and e[0] != e[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {v: find(v) for v in root}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
