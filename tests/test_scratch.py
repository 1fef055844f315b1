"""Intermediate tables: stored once, shuffle files freed, deleted only where they belong."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from leaseflow.sources import scratch


def test_store_and_discard(spark):
    rows, path = scratch.store(spark.range(100).repartition(3, "id"), "numbers")
    other, kept = scratch.store(spark.range(5), "others")
    assert rows.agg(F.sum("id")).first()[0] == 4950
    assert spark.conf.get(scratch.FREE_SHUFFLES) == "false"
    assert scratch.discard(spark, path)
    assert not os.path.exists(path) and os.path.exists(kept) and other.count() == 5


def test_discard_refuses_other_folders(spark, tmp_path):
    (tmp_path / "data").mkdir()
    for path in (str(tmp_path / "data"), scratch.scratch_root(spark), scratch.scratch_root(spark) + "x"):
        with pytest.raises(ValueError):
            scratch.discard(spark, path)
    assert (tmp_path / "data").exists()


def test_a_failed_write_restores_the_setting(spark):
    bad = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        scratch.store(bad, "bad")
    assert spark.conf.get(scratch.FREE_SHUFFLES) == "false"
