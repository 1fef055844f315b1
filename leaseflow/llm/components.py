"""Connected components of an edge table, by alternating star contractions.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): the large-star step
links every larger neighbour to the smallest one, the small-star step every smaller one. Each
step is one aggregation and one join; nothing but the end test reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leaseflow.sources.scratch import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a > b)."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("at"), F.least("a", "low").alias("low"))
    linked = both.join(least, F.col("a") == F.col("at"))
    if large:
        out = linked.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = linked.select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*")
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(id, root) for every vertex of the edges; root is the smallest id reachable.

    Edges with a null end and loops are ignored; no edges give an empty table.
    """
    state = edges.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
    state = state.filter(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("a") > F.col("b")))
    state, seen = materialize(state.distinct(), "edges"), None
    while True:
        mark = state.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                                                  F.lit(0).cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        state = materialize(_star(_star(state, True), False), "edges")
    roots = state.select(F.col("b").alias("id")).distinct()
    return state.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        roots.select("id", F.col("id").alias("root")))
