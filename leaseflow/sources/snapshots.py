"""Stored tables with a manifest and one atomic pointer.

A table is a folder with ``data/data_set=<name>/`` folders, which are written once and never changed,
and ``manifests/<version>.json``, each of which names the data folders that make up the table.
The highest version is the table. A change writes its data first, then a manifest under the
next number; giving it that name is one rename that fails if the name is taken, and then the
change is applied to the newer version and tried again. So a reader sees a version whole, a
crash in the middle leaves the old one, and two writers never lose each other's change.

Nothing is deleted by a change: a query that opened an old version goes on reading its files.
:meth:`SnapshotTable.vacuum` removes what the last few versions don't name.

Rows carry ``writer`` and ``batch_id``. Writing a batch again replaces it. A fold keeps each
key's visible row with its own writer and batch, and records per writer the batches it covers:
these are settled, so sending one again changes nothing. Batches of a writer are numbered
upwards.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from leaseflow.operators.dimensions import upsert_latest
from leaseflow.sources.tables import BATCH, WRITER, Batch

FOLDED, SET = "", "data_set"


@dataclass(frozen=True)
class Entry:
    """One data folder: a batch, or a fold (no writer)."""

    folder: str
    writer: str = FOLDED
    batch: int = -1


@dataclass(frozen=True)
class Manifest:
    """One version of a table."""

    version: int = 0
    entries: tuple[Entry, ...] = ()
    #: Highest batch of each writer that a fold has taken in.
    covered: dict[str, int] = field(default_factory=dict)
    #: First and last day that readers see, and whether rows without a day are seen.
    days: tuple[str, str, bool] | None = None

    def covers(self, batch: Batch) -> bool:
        return batch.number <= self.covered.get(batch.writer, -1)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        read = json.loads(text)
        return cls(read["version"], tuple(Entry(**e) for e in read["entries"]), read["covered"],
                   tuple(read["days"]) if read["days"] else None)


class SnapshotTable:
    """A stored table; ``day`` names the column it is partitioned by."""

    def __init__(self, spark: SparkSession, path: str, day: str | None = None):
        self.spark, self.path, self.day = spark, path, day

    # --- files -------------------------------------------------------------------

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _store(self):
        return self._at("manifests").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str, suffix: str = "") -> list[str]:
        store, at = self._store(), self._at(folder)
        if not store.exists(at):
            return []
        names = [s.getPath().getName() for s in store.listStatus(at)]
        return sorted(n for n in names if n.endswith(suffix) and not n.startswith("."))

    def versions(self) -> list[int]:
        return [int(n.split(".")[0]) for n in self._names("manifests", ".json")]

    def manifest(self, version: int | None = None) -> Manifest:
        """A version, the current one by default; version 0 is the empty table."""
        number = max(self.versions(), default=0) if version is None else version
        if number == 0:
            return Manifest()
        stream = self._store().open(self._at(f"manifests/{number:012d}.json"))
        try:
            return Manifest.from_json(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, manifest: Manifest) -> bool:
        """Give a manifest its number; false if another change has taken it."""
        jvm, store = self.spark._jvm, self._store()
        draft = store.makeQualified(self._at(f"manifests/.{uuid.uuid4().hex}"))
        out = store.create(draft, True)
        out.write(bytearray(manifest.to_json().encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            draft.toUri(), self.spark._jsc.hadoopConfiguration())
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        final = store.makeQualified(self._at(f"manifests/{manifest.version:012d}.json"))
        try:
            files.rename(draft, final, options)
        except Exception:
            store.delete(draft, False)
            if store.exists(final):
                return False
            raise
        return True

    def _commit(self, change: Callable[[Manifest], Manifest | None]) -> int:
        """Apply a change to the current version until it gets the next number."""
        while True:
            now = self.manifest()
            changed = change(now)
            if changed is None:
                return now.version
            if self._publish(replace(changed, version=now.version + 1)):
                return now.version + 1

    def _by_day(self, rows: DataFrame) -> DataFrame:
        return rows.hint("rebalance", self.day) if self.day else rows

    def _write(self, rows: DataFrame) -> str:
        folder = f"{SET}={uuid.uuid4().hex}"
        out = rows.write.mode("errorifexists").option("compression", "zstd")
        (out.partitionBy(self.day) if self.day else out).parquet(f"{self.path}/data/{folder}")
        return folder

    # --- changes -----------------------------------------------------------------

    def write(self, rows: DataFrame, batch: Batch, dealt: bool = False) -> int:
        """Add or replace one batch; the version that has it. Settled batches stay as they are.

        ``dealt`` rows already lie in tasks that have few partitions each: they are written where
        they are.
        """
        if self.manifest().covers(batch):
            return self.manifest().version
        rows = rows.withColumns({WRITER: F.lit(batch.writer), BATCH: F.lit(batch.number).cast("bigint")})
        folder = self._write(rows if dealt else self._by_day(rows))

        def change(now: Manifest) -> Manifest | None:
            if now.covers(batch):
                return None
            others = tuple(e for e in now.entries if (e.writer, e.batch) != tuple(batch))
            return replace(now, entries=(*others, Entry(folder, *batch)))
        return self._commit(change)

    def replace_all(self, rows: DataFrame) -> int:
        """The rows become the whole table, as one version."""
        folder = self._write(self._by_day(rows))
        return self._commit(lambda now: replace(now, entries=(Entry(folder),)))

    def fold(self, schema: T.StructType, keys: list[str], order: list[str] | None = None) -> int:
        """Fold the batches of the current version into one folder of visible rows.

        Batches that arrive meanwhile stay beside it; if one of the folded batches was
        replaced meanwhile, the fold is begun anew.
        """
        while True:
            base = self.manifest()
            if len(base.entries) < 2:
                return base.version
            visible = upsert_latest(self.rows(schema, base.version), keys, [BATCH, WRITER, *(order or [])],
                                    keep_order=True)
            folder, folded = self._write(self._by_day(visible)), set(base.entries)
            covered = dict(base.covered)
            for e in base.entries:
                if e.writer != FOLDED:
                    covered[e.writer] = max(e.batch, covered.get(e.writer, -1))
            stale = []

            def change(now: Manifest) -> Manifest | None:
                stale[:] = folded - set(now.entries)
                if stale:
                    return None
                later = tuple(e for e in now.entries if e not in folded)
                return replace(now, entries=(Entry(folder), *later), covered=covered)
            version = self._commit(change)
            if not stale:
                return version

    def retain(self, as_of: dt.date, days: tuple[int, int], keep_undated: bool = True) -> int:
        """Show only days within the range from now on; a change of the manifest alone."""
        first, last = as_of - dt.timedelta(days[0]), as_of + dt.timedelta(days[1])
        return self._commit(lambda now: replace(
            now, days=(first.isoformat(), last.isoformat(), keep_undated)))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete data that the last ``keep`` versions don't name, and older manifests.

        Run it when no query reads older versions and no change is under way. Day folders
        outside the range of every kept version go too.
        """
        versions = self.versions()
        kept, store, gone = versions[-keep:], self._store(), []
        manifests = [self.manifest(v) for v in kept]
        named = {e.folder for m in manifests for e in m.entries}
        for folder in self._names("data"):
            if folder not in named:
                store.delete(self._at(f"data/{folder}"), True)
                gone.append(folder)
                continue
            for name in self._names(f"data/{folder}") if self.day else []:
                text = name.split("=", 1)[-1]
                if name.startswith(f"{self.day}=") and not any(_shown(text, m.days) for m in manifests):
                    store.delete(self._at(f"data/{folder}/{name}"), True)
                    gone.append(f"{folder}/{name}")
        for version in versions[:-keep]:
            store.delete(self._at(f"manifests/{version:012d}.json"), False)
        return gone

    # --- reading -----------------------------------------------------------------

    def rows(self, schema: T.StructType, version: int | None = None) -> DataFrame:
        """All rows of a version with ``writer`` and ``batch_id``; days are pruned."""
        now = self.manifest(version)
        full = T.StructType([*schema.fields, T.StructField(WRITER, T.StringType()),
                             T.StructField(BATCH, T.LongType())])
        if not now.entries:
            return self.spark.createDataFrame([], full)
        base = f"{self.path}/data"
        rows = self.spark.read.schema(full.add(SET, T.StringType())).option("basePath", base).parquet(
            *[f"{base}/{e.folder}" for e in now.entries]).drop(SET)
        if now.days:
            first, last, undated = now.days
            inside = F.col(self.day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
            rows = rows.filter(inside | F.col(self.day).isNull() if undated else inside)
        return rows

    def whole(self) -> DataFrame:
        """The current version of a table that is replaced as a whole."""
        return self.spark.read.parquet(*[f"{self.path}/data/{e.folder}" for e in self.manifest().entries])

    def latest(self, schema: T.StructType, keys: list[str], order: list[str] | None = None,
               version: int | None = None) -> DataFrame:
        """The visible row of each key."""
        return upsert_latest(self.rows(schema, version), keys, [BATCH, WRITER, *(order or [])])


def _shown(day: str, days: tuple[str, str, bool] | None) -> bool:
    if days is None:
        return True
    try:
        return days[0] <= dt.date.fromisoformat(day).isoformat() <= days[1]
    except ValueError:  # the folder of rows without a day
        return days[2]
