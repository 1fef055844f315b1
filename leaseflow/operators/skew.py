"""Keyed work that stays even when one key holds a large share of all rows.

A key is *hot* when it has more than ``limit`` rows. There are at most
``rows / limit`` hot keys, which is what bounds everything broadcast here.
Results are exact whatever the limit is; ``limit=None`` switches the handling off.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from leaseflow.sources.scratch import materialize

HOT_ROWS = 5_000_000

SEGMENT = "_segment"

# Rows of a task that scans a log: what it sorts then fits into memory, however large the log is.
TASK_ROWS = 500_000
# Groups of keys that are counted first.
KEY_GROUPS = 4_096


def hot_keys(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows (counted with map-side combine)."""
    return (rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > limit).select(key))


def join_many_to_one(many: DataFrame, one: DataFrame, key: str,
                     limit: int | None = HOT_ROWS) -> DataFrame:
    """Inner join where ``one`` has one row per key and ``many`` may be skewed.

    Ordinary keys take the normal shuffle join. Rows of hot keys stay where they
    are and meet the few matching rows of ``one`` by broadcast.
    """
    if limit is None:
        return many.join(one, key)
    hot = F.broadcast(hot_keys(many, key, limit))
    ordinary = many.join(hot, key, "left_anti").join(one, key)
    hot_one = F.broadcast(one.join(hot, key, "left_semi"))
    skewed = many.join(hot, key, "left_semi").join(hot_one, key)
    return ordinary.unionByName(skewed)


class Last(NamedTuple):
    """Value of the latest row that has one, up to this row or before it."""

    value: Column
    before: bool = False


# Adds the latest values per row to a keyed, ordered log.
Scan = Callable[[DataFrame, Mapping[str, Last]], DataFrame]


def _running(log: DataFrame, keys: list[str], order: str, values: Mapping[str, Last]) -> DataFrame:
    frame = Window.partitionBy(*keys).orderBy(order)
    upto = frame.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = frame.rowsBetween(Window.unboundedPreceding, -1)
    return log.withColumns({
        name: F.last(v.value, ignorenulls=True).over(earlier if v.before else upto)
        for name, v in values.items()
    })


def plain_scan(key: str, order: str) -> Scan:
    """Window over the whole log of a key: one exchange, shared by all scans on it."""
    return lambda log, values: _running(log, [key], order, values)


def segmented_scan(key: str, order: str) -> Scan:
    """The same values when a key's log is cut into segments that run in parallel.

    Each segment runs its own window; then it receives what the segments before it
    ended with (one row per key and segment). The log is stored before every scan:
    that fixes the segments, and a scan that builds on another does not repeat it.
    """
    def scan(log: DataFrame, values: Mapping[str, Last]) -> DataFrame:
        log = materialize(log, "segments")
        carry = {name: f"_c_{name}" for name in values}
        local = _running(log, [key, SEGMENT], order, values)
        ends = log.groupBy(key, SEGMENT).agg(*[
            F.max_by(v.value, F.when(v.value.isNotNull(), F.col(order))).alias(carry[name])
            for name, v in values.items()])
        preceding = (Window.partitionBy(key).orderBy(SEGMENT)
                     .rowsBetween(Window.unboundedPreceding, -1))
        carried = ends.select(key, SEGMENT, *[
            F.last(c, ignorenulls=True).over(preceding).alias(c) for c in carry.values()])
        return (local.join(carried, [key, SEGMENT], "left")
                .withColumns({n: F.coalesce(F.col(n), F.col(c)) for n, c in carry.items()})
                .drop(*carry.values()))
    return scan


class Hot(NamedTuple):
    """Hot keys (a stored table) and how many segments their rows need."""

    keys: DataFrame
    segments: int


def count_keys(rows: DataFrame, key: str, limit: int) -> tuple[int, Hot | None]:
    """Number of rows with a key, and the hot keys, None if there are none.

    Decides which plan is built, so it runs at once, over one narrow column. Keys are counted
    in groups by hash first, which shuffles a number a group and task. Only keys of groups
    above the limit are counted one by one, and only if one is hot the hot keys are stored
    (at most ``rows / limit`` of them).
    """
    rows = rows.filter(F.col(key).isNotNull())
    group = F.pmod(F.hash(key), F.lit(KEY_GROUPS))
    found = (rows.groupBy(group.alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
             .agg(F.sum("_n").alias("n"),
                  F.collect_list(F.when(F.col("_n") > limit, F.col("_g"))).alias("full")).first())
    total = found.n or 0
    if not found.full:
        return total, None
    counted = rows.filter(group.isin(found.full)).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    keys = materialize(counted.filter(F.col("_n") > limit), "hot")
    segments = keys.agg(F.sum(F.ceil(F.col("_n") / limit)).alias("n")).first().n
    return total, Hot(keys.select(key), int(segments)) if segments else None


def find_hot(rows: DataFrame, key: str, limit: int) -> Hot | None:
    """The hot keys of some rows, None if there are none."""
    return count_keys(rows, key, limit)[1]


def dealt(log: DataFrame, key: str, rows: int, multiple: int | None = None) -> DataFrame:
    """A log dealt to tasks by key, with about ``TASK_ROWS`` rows each.

    Left to the session's settings where these already make enough tasks. With ``multiple``
    it is always dealt, to a multiple of so many: rows whose key hash has equal remainders by that
    number then lie in the same tasks.
    """
    parts = -(-rows // TASK_ROWS)
    if multiple:
        return log.repartition(max(1, -(-parts // multiple)) * multiple, key)
    if parts > int(log.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return log.repartition(parts, key)
    return log


def cut_segments(log: DataFrame, hot: Hot, key: str, order: str) -> DataFrame:
    """Rows of hot keys in even, contiguous segments of (key, order).

    Range partitioning samples the rows, so segments are even however the arrivals
    are spread; order values are unique per key, so no segment boundary is ambiguous.
    """
    return (log.join(F.broadcast(hot.keys), key)
            .repartitionByRange(hot.segments, key, order)
            .withColumn(SEGMENT, F.spark_partition_id()))


def scan_by_key(log: DataFrame, key: str, order: str,
                step: Callable[[DataFrame, Scan], DataFrame],
                limit: int | None = HOT_ROWS, census: DataFrame | None = None,
                multiple: int | None = None) -> DataFrame:
    """Apply a step that scans a keyed log; hot keys take the segmented way.

    ``census`` may name other rows to count keys in, when they bound the log's rows
    per key and cost less to read than the log itself. ``multiple``: see :func:`dealt`.
    """
    total, hot = 0, None
    if limit is not None:
        total, hot = count_keys((log if census is None else census).select(key), key, limit)
    if hot is None:
        return step(dealt(log, key, total, multiple), plain_scan(key, order))
    ordinary = log.join(F.broadcast(hot.keys), key, "left_anti")
    return step(dealt(ordinary, key, total, multiple), plain_scan(key, order)).unionByName(
        step(cut_segments(log, hot, key, order), segmented_scan(key, order)))
