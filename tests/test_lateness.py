"""The running maximum in parts, and rows that miss their window, against a plain loop."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from leaseflow import schemas as S
from leaseflow.operators import lateness as LT
from leaseflow.operators import windows as W

BASE = dt.datetime(2024, 5, 1)


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_prefix_maximum(spark, ranges):
    rng = random.Random(ranges)
    rows = [(i, None if rng.random() < 0.2 else rng.randrange(10**6)) for i in range(500)]
    expected, high = [], None
    for order, value in rows:
        expected.append((order, value, high))
        if value is not None:
            high = value if high is None else max(high, value)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    frame = spark.createDataFrame(shuffled, "o bigint, v bigint")
    got = LT.with_prefix_max(frame, "v", ["o"], ranges).select("o", "v", "seen")
    assert sorted(map(tuple, got.collect())) == expected


def test_a_maximum_of_nothing(spark):
    assert LT.with_prefix_max(spark.createDataFrame([], "o bigint, v bigint"), "v", ["o"], 4).isEmpty()


def plain_late(rows):
    high, late = None, []
    for n, seconds in rows:
        if seconds is None:
            continue
        end = seconds // 10 * 10 + 10
        if high is not None and end <= high - 5:
            late.append(n)
        high = seconds if high is None else max(high, seconds)
    return late


def facts(spark, rows):
    fact = "dwd_credit_add"
    columns = {"id": F.col("n"), S.FACT_TIME[fact]: F.timestamp_add("SECOND", F.col("s"), F.lit(BASE).cast("timestamp_ntz"))}
    frame = spark.createDataFrame(rows, "n bigint, s int")
    return frame.select(F.col("n").alias("arrival"), *[columns.get(f.name, F.lit(1)).cast(f.dataType).alias(f.name)
                                                       for f in S.FACTS[fact].fields])


def test_late_rows(spark):
    rng = random.Random(3)
    rows = [(n, None if rng.random() < 0.05 else n // 2 + rng.randrange(-25, 25)) for n in range(400)]
    rows = [(n, s if s is None else max(s, 0)) for n, s in rows]
    expected = plain_late(rows)
    assert 20 < len(expected) < 300
    spec = W.SPECS["dws_credit_credit_add_win"]
    got = LT.judged(facts(spark, rows), spec, ["arrival"], 9)
    assert sorted(r["id"] for r in got.filter("late").collect()) == expected
    assert got.count() == sum(s is not None for _, s in rows)
    table = LT.window_table("dws_credit_credit_add_win", facts(spark, rows), {}, ["arrival"], 9)
    kept = sum(s is not None for _, s in rows) - len(expected)
    assert table.agg(F.sum("apply_count")).first()[0] == kept


def test_bounds_of_lateness(spark):
    """A window [0, 10) is closed by an event at 15 and not by one at 14."""
    for seconds, late in ((14, []), (15, [1])):
        got = LT.late_rows(facts(spark, [(0, seconds), (1, 9)]), W.SPECS["dws_credit_credit_add_win"], ["arrival"])
        assert [r["id"] for r in got.collect()] == late


def test_no_task_sees_all_rows(spark):
    plan = LT.with_prefix_max(spark.range(1000).selectExpr("id AS o", "id AS v"), "v", ["o"], 8
                              )._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line or "Window (" in line]
    assert any("_part" in w for w in windows)
    assert all("_part" in w or "_high" in w for w in windows)
