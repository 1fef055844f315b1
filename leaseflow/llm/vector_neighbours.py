"""Near-duplicate vectors by collision counting on one-dimensional projections.

Two vectors collide on a random projection if one lies in a window centred at the other. With
unit vectors, a pair at the threshold collides on a projection with a known probability, so
the number of projections (``VIEWS``) on which a pair must collide to be worth verifying
follows from a target recall (:func:`least_collisions`).

Comparing every pair's counts would be quadratic, so projections also deal the vectors out:
a table takes some projections, cuts each at 0, and brings together the vectors that fall on
the same sides; within a part vectors are sorted by a projection, each looks at its window,
counts its collisions over all views and verifies the pairs that reach the count. The number
of tables follows from the same recall, the cuts of a table from the number of vectors, so
that parts stay small at every size (:func:`plan`).

Equal vectors are one class before anything else. A part larger than a block is cut by hash
into blocks, and each pair of blocks is a unit of work; a pair of vectors counts in the first
table whose part and window bring it together and leaves counts and tree edges, never a pair.

Rules: null vectors, zero vectors and vectors with null or non-finite components link with
nothing, not even with equal ones; vectors of different lengths never link; rows that repeat
id and vector link with each other; different vectors that share an id are one vertex; a null
id counts as a copy and takes the component of its class; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leaseflow.llm.components import components
from leaseflow.sources.scratch import materialize

THRESHOLD, RECALL = 0.9, 0.97
#: Views of a pair and half the width of a window, in standard deviations of a projection.
VIEWS, HALF_WINDOW = 24, 0.75
#: Vectors of a part that a table aims at, and of a block.
PART, BLOCK = 64, 1024
SEED = 31


def collision_chance(cosine: float, half: float = HALF_WINDOW) -> float:
    """Chance that unit vectors of this cosine collide on a Gaussian projection."""
    apart = math.sqrt(2 - 2 * cosine)
    return 1.0 if apart == 0 else math.erf(half / apart / math.sqrt(2))


def least_collisions(cosine: float, recall: float, views: int = VIEWS) -> int:
    """Largest count that a pair at the threshold reaches with the given chance."""
    p, chance = collision_chance(cosine), 0.0
    for count in range(views, 0, -1):
        chance += math.comb(views, count) * p ** count * (1 - p) ** (views - count)
        if chance >= recall:
            return count
    return 1


@dataclass(frozen=True)
class Plan:
    cuts: int
    tables: int
    count: int


def plan(vectors: int, cosine: float = THRESHOLD, recall: float = RECALL) -> Plan:
    """Cuts and tables for so many vectors; half of the allowed loss goes to the counts."""
    cuts = max(1, round(math.log2(max(2, vectors / PART))))
    both = (1 + recall) / 2
    side = 1 - math.acos(cosine) / math.pi
    together = side ** cuts * collision_chance(cosine)
    tables = max(1, math.ceil(math.log(1 - both) / math.log1p(-min(together, 1 - 1e-9))))
    return Plan(cuts, tables, least_collisions(cosine, both))


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaling first keeps squares of very large and very small components finite.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _gaussian(seed: int, dim: int, n: int) -> np.ndarray:
    return np.random.default_rng([SEED, seed, dim]).standard_normal((dim, n))


def part_codes(unit: np.ndarray, how: Plan) -> np.ndarray:
    """(vectors, tables) codes of the parts."""
    sides = unit @ _gaussian(0, unit.shape[1], how.cuts * how.tables) > 0
    codes = np.zeros((len(unit), how.tables), np.int64)
    for k in range(how.cuts):
        codes = codes * 2 + sides[:, k * how.tables:(k + 1) * how.tables]
    return codes


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as doubles."""
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _codes(how: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("dim").to_numpy()
            for dim in np.unique(lengths):
                rows = batch.filter(pa.array(lengths == dim))
                codes = part_codes(_unit(_matrix(rows.column("v"))), how)
                flat = pa.array(codes.reshape(-1))
                ends = pa.array(np.arange(0, len(flat) + 1, how.tables, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c) for c in ("rep", "copies", "dim", "v")]
                    + [pa.ListArray.from_arrays(ends, flat)], ["rep", "copies", "dim", "v", "codes"])
    return run


def _links(rows: pa.Table, how: Plan, cosine: float) -> pa.RecordBatch:
    """Links of one unit whose first common table this is: (rep, root, links)."""
    ids, copies, block = (rows[c].to_numpy() for c in ("rep", "copies", "block"))
    table = rows["table"][0].as_py()
    cross = rows["i"][0].as_py() != rows["j"][0].as_py()
    unit = _unit(_matrix(rows["v"].combine_chunks()))
    codes = part_codes(unit, how)[:, :table]
    views = unit @ _gaussian(1, unit.shape[1], VIEWS)
    # Each table sorts by a view of its own, so a pair that misses one window has others.
    sort = views[:, table % VIEWS]
    order = np.argsort(sort, kind="stable")
    sort = sort[order]
    ids, copies, block, unit, codes, views = (a[order] for a in (ids, copies, block, unit, codes, views))
    views32 = views.astype(np.float32)
    counts, root = np.zeros(len(ids), np.int64), np.arange(len(ids))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    window = np.searchsorted(sort, sort + HALF_WINDOW, "right")
    before = np.arange(table) % VIEWS
    for low in range(0, len(ids), 256):
        high = min(low + 256, len(ids))
        far = int(window[high - 1])
        hits = np.zeros((high - low, far - low), np.uint8)
        for k in range(VIEWS):
            hits += np.abs(views32[low:high, k, None] - views32[None, low:far, k]) <= HALF_WINDOW
        a, b = np.nonzero(hits >= how.count)
        a, b = a + low, b + low
        fit = (b > a) & (b < window[a])
        if cross:
            fit &= block[a] != block[b]
        a, b = a[fit], b[fit]
        if table:
            one, two = views[a][:, before], views[b][:, before]
            met = np.maximum(one, two) <= np.minimum(one, two) + HALF_WINDOW
            new = ~((codes[a] == codes[b]) & met).any(axis=1)
            a, b = a[new], b[new]
        near = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
        a, b = a[near], b[near]
        np.add.at(counts, a, copies[b])
        np.add.at(counts, b, copies[a])
        for p, q in zip(a.tolist(), b.tolist(), strict=True):
            p, q = find(p), find(q)
            if p != q:
                small, large = (p, q) if ids[p] < ids[q] else (q, p)
                root[large] = small
    some = np.flatnonzero(counts)
    top = np.array([find(i) for i in some.tolist()], np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[top]), pa.array(counts[some])],
                                      ["rep", "root", "links"])


def _units(how: Plan, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = [batch.column(c).to_numpy() for c in ("table", "dim", "part", "i", "j")]
            change = np.flatnonzero(np.any([u[1:] != u[:-1] for u in unit], axis=0)) + 1
            bounds = [0, *change.tolist(), batch.num_rows]
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                key = tuple(int(u[low]) for u in unit)
                if key != last and held:
                    yield _links(pa.Table.from_batches(held), how, cosine)
                    held = []
                held.append(batch.slice(low, high - low))
                last = key
        if held:
            yield _links(pa.Table.from_batches(held), how, cosine)
    return run


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                 cosine: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id
    reachable by links.
    """
    v = F.col(embedding)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("v"),
                          F.coalesce(valid, F.lit(False)).alias("valid"))
    classes = materialize(rows.filter("valid").groupBy("v").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies")).withColumn("dim", F.size("v")),
        "vectors")
    distinct = classes.filter("rep IS NOT NULL")
    how = plan(distinct.count(), cosine, recall)
    kind = classes.schema["v"].dataType.simpleString()
    coded = distinct.select("rep", "copies", "dim", "v").mapInArrow(
        _codes(how), f"rep bigint, copies bigint, dim int, v {kind}, codes array<bigint>")
    dealt = coded.select("rep", "copies", "dim", "v", F.posexplode("codes").alias("table", "part"))
    # A vector alone in its part has nothing to compare with.
    sizes = coded.select("dim", F.posexplode("codes").alias("table", "part")).groupBy(
        "table", "dim", "part").agg(F.count("*").alias("n")).filter("n > 1").withColumn(
        "blocks", F.ceil(F.col("n") / block).cast("int"))
    placed = dealt.join(sizes, ["table", "dim", "part"]).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    units = placed.select(
        "table", "dim", "part", "rep", "copies", "v", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "table", "dim", "part", F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"), "rep", "copies", "v", "block")
    keys = ["table", "dim", "part", "i", "j"]
    found = materialize(units.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _units(how, cosine), "rep bigint, root bigint, links bigint"), "links")
    counted = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found, "rep", "root").withColumnsRenamed({"id": "rep", "root": "component"})
    linked = classes.join(counted, "rep", "left").join(roots, "rep", "left").select(
        F.col("v").alias("class_v"), F.coalesce("component", "rep").alias("component"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    out = rows.join(linked, F.col("valid") & (F.col("v") == F.col("class_v")), "left")
    own = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
                      own.alias("component_id"),
                      F.coalesce(F.col("vec_id") == own, own.isNull()).alias("kept"))
