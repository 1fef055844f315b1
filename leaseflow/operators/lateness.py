"""Exact lateness: each row against the watermark of the rows that arrived before it.

A stream moves its watermark between micro-batches; the rule being reproduced moves it with
every row: a row is late if its window's end is at or before the latest event time that arrived
earlier, less the tolerated disorder. In arrival order that is a running maximum. It is computed
in parts: rows are dealt into ranges of arrival order, each range has its own running maximum,
and the maximum of all ranges before it (one value a range) is carried in. No task sees more
than its range, and the carry has a row for each range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from leaseflow import schemas as S
from leaseflow.operators import windows as W
from leaseflow.sources.scratch import materialize

SEEN = "seen"


def with_prefix_max(rows: DataFrame, value: str, order: list[str], ranges: int | None = None) -> DataFrame:
    """Adds ``seen``: the largest value of all earlier rows, null for the first.

    ``order`` must tell rows apart; null values are passed over. Ranges come from Spark's
    sampling of the order columns, so the dealt rows are stored: a second reading has to find
    the same ranges.
    """
    by = [F.col(c) for c in order]
    dealt = rows.repartitionByRange(ranges, *by) if ranges else rows.repartitionByRange(*by)
    dealt = materialize(dealt.withColumn("_part", F.spark_partition_id()), "arrivals")
    highest = dealt.groupBy("_part").agg(F.max(value).alias("_high"))
    carry = highest.select("_part", F.max("_high").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    inner = Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_own", F.max(value).over(inner)).join(carry, "_part")
    return placed.withColumn(SEEN, F.greatest("_own", "_carry")).drop("_part", "_own", "_carry")


def judged(facts: DataFrame, spec: W.WindowSpec, order: list[str], ranges: int | None = None) -> DataFrame:
    """Facts with an event time, with ``stt``, ``edt``, ``seen`` and ``late``.

    Rows that form no group (no auditor) move the watermark only if they reach the window
    operator, and they don't: they are left out before, as in the window tables.
    """
    time = S.FACT_TIME[spec.fact]
    rows = facts.filter(F.col(time).isNotNull())
    for key in spec.required:
        rows = rows.filter(F.col(key).isNotNull())
    rows = with_prefix_max(rows, time, order, ranges)
    rows = rows.withColumn("_w", F.window(time, W.WINDOW)).withColumn("stt", F.col("_w.start")).withColumn(
        "edt", F.col("_w.end")).drop("_w")
    late = F.col("edt") <= F.col(SEEN) - F.expr(f"INTERVAL {W.DISORDER}")
    return rows.withColumn("late", F.coalesce(late, F.lit(False)))


def late_rows(facts: DataFrame, spec: W.WindowSpec, order: list[str]) -> DataFrame:
    """What the rule drops: the facts' rows with their window and the time seen before."""
    return judged(facts, spec, order).filter("late").drop("late")


def window_table(name: str, facts: DataFrame, dims, order: list[str], ranges: int | None = None) -> DataFrame:
    """A window table of the rows that were not late."""
    kept = judged(facts, W.SPECS[name], order, ranges).filter("NOT late").select(*facts.columns)
    return W.window_table(name, kept, dims)
