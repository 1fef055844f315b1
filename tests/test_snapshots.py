"""Tables with a manifest: whole versions, retries, conflicts, crashes, expiry."""

from __future__ import annotations

import datetime as dt

import pytest

from leaseflow.sources.snapshots import SnapshotTable
from leaseflow.sources.tables import Batch

SCHEMA = "id bigint, v string, seq bigint"


def rows(spark, *items):
    return spark.createDataFrame([(*i, n) for n, i in enumerate(items)], SCHEMA)


def seen(table, version=None):
    schema = table.spark.createDataFrame([], SCHEMA).schema
    return sorted((r["id"], r["v"]) for r in table.latest(schema, ["id"], ["seq"], version).collect())


def fold(table):
    return table.fold(table.spark.createDataFrame([], SCHEMA).schema, ["id"], ["seq"])


@pytest.fixture()
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "t"))


def test_versions_are_whole_and_stay(spark, table):
    assert seen(table) == []
    table.write(rows(spark, (1, "a"), (2, "a"), (1, "b")), Batch("w", 0))
    table.write(rows(spark, (2, "c")), Batch("w", 1))
    assert seen(table) == [(1, "b"), (2, "c")]
    assert seen(table, 1) == [(1, "b"), (2, "a")]
    assert table.versions() == [1, 2]


def test_a_batch_sent_again_replaces_itself(spark, table):
    table.write(rows(spark, (1, "a"), (9, "wrong")), Batch("w", 0))
    table.write(rows(spark, (1, "x")), Batch("v", 0))
    table.write(rows(spark, (1, "a")), Batch("w", 0))
    assert seen(table) == [(1, "a")]  # of equal batch numbers the later writer's name counts
    assert len(table.manifest().entries) == 2


def test_fold_keeps_order_among_writers_and_settles_batches(spark, table):
    table.write(rows(spark, (1, "w0"), (2, "w0")), Batch("w", 0))
    table.write(rows(spark, (1, "w3")), Batch("w", 3))
    before = table.latest(rows(spark).schema, ["id"], ["seq"])
    fold(table)
    assert len(table.manifest().entries) == 1
    # A batch of another writer, numbered below the folded one, doesn't win over it.
    table.write(rows(spark, (1, "u2"), (2, "u2"), (3, "u2")), Batch("u", 2))
    table.write(rows(spark, (1, "late copy")), Batch("w", 3))  # settled
    table.write(rows(spark, (1, "w2 never sent before the fold")), Batch("w", 2))
    assert seen(table) == [(1, "w3"), (2, "u2"), (3, "u2")]
    table.write(rows(spark, (1, "w4")), Batch("w", 4))
    assert seen(table) == [(1, "w4"), (2, "u2"), (3, "u2")]
    assert sorted((r["id"], r["v"]) for r in before.collect()) == [(1, "w3"), (2, "w0")]
    fold(table)
    assert seen(table) == [(1, "w4"), (2, "u2"), (3, "u2")]


def test_two_changes_at_once_lose_nothing(spark, table, monkeypatch):
    """Another writer commits between reading the version and taking its number."""
    other = SnapshotTable(spark, table.path)
    publish, once = SnapshotTable._publish, []

    def beaten(self, manifest):
        if self is table and not once:
            once.append(other.write(rows(spark, (7, "other")), Batch("other", 0)))
        return publish(self, manifest)

    monkeypatch.setattr(SnapshotTable, "_publish", beaten)
    table.write(rows(spark, (1, "mine")), Batch("w", 0))
    assert once == [1] and table.versions() == [1, 2]
    assert seen(table) == [(1, "mine"), (7, "other")]


def test_a_fold_overtaken_by_a_retry_begins_anew(spark, table, monkeypatch):
    table.write(rows(spark, (1, "a")), Batch("w", 0))
    table.write(rows(spark, (1, "b")), Batch("w", 1))
    write, once = SnapshotTable._write, []

    def overtaken(self, data):
        folder = write(self, data)
        if not once:
            once.append(1)
            table.write(rows(spark, (1, "b again")), Batch("w", 1))
        return folder

    monkeypatch.setattr(SnapshotTable, "_write", overtaken)
    fold(table)
    assert seen(table) == [(1, "b again")] and len(table.manifest().entries) == 1


def test_a_crash_before_the_pointer_moves_changes_nothing(spark, table, monkeypatch):
    table.write(rows(spark, (1, "a")), Batch("w", 0))
    monkeypatch.setattr(SnapshotTable, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.write(rows(spark, (1, "b")), Batch("w", 1))
    with pytest.raises(RuntimeError):
        table.replace_all(rows(spark, (5, "c")))
    monkeypatch.undo()
    assert seen(table) == [(1, "a")]
    table.write(rows(spark, (1, "b")), Batch("w", 1))
    assert seen(table) == [(1, "b")]
    assert len(table.vacuum(1)) == 2  # what the crashes left
    assert seen(table) == [(1, "b")]


def test_replace_all_is_one_step(spark, table):
    table.replace_all(rows(spark, (1, "a")))
    opened = table.spark.read.parquet(f"{table.path}/data/{table.manifest().entries[0].folder}")
    table.replace_all(rows(spark, (2, "b")))
    assert seen(table) == [(2, "b")] and [r["v"] for r in opened.collect()] == ["a"]


def test_days(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "d"), "day")
    schema = "id bigint, day date"
    days = [dt.date(2024, 1, 1), dt.date(2024, 3, 1), dt.date(2024, 3, 31), dt.date(2024, 4, 3), None]
    table.write(spark.createDataFrame(list(enumerate(days)), schema), Batch("w", 0))
    kind = spark.createDataFrame([], schema).schema
    assert table.rows(kind).count() == 5
    table.retain(dt.date(2024, 3, 31), (30, 3))
    assert sorted(r["id"] for r in table.rows(kind).collect()) == [1, 2, 3, 4]
    plan = table.rows(kind)._jdf.queryExecution().executedPlan().toString()
    assert "2024-03-01" in plan.split("PartitionFilters: [")[1].split("]")[0]
    table.retain(dt.date(2024, 3, 31), (30, 3), keep_undated=False)
    assert sorted(r["id"] for r in table.rows(kind).collect()) == [1, 2, 3]
    gone = table.vacuum(1)
    assert sorted(g.split("day=")[1] for g in gone) == ["2024-01-01", "__HIVE_DEFAULT_PARTITION__"]
    assert sorted(r["id"] for r in table.rows(kind).collect()) == [1, 2, 3]
