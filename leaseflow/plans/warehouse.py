"""The whole warehouse as batch runs: logs in, stored layers out.

Layers live under one root: ``chg/`` (decoded lifecycle changes), ``state/`` (what each facility
and credit had shown by the end of a batch), ``dim/``, ``dwd/`` (facts), ``dws/`` (windows),
``ads/`` (views), ``rejects/`` (counts of rows without a key), and with
:meth:`Warehouse.load_touched_windows` ``sums/`` and ``touched/`` beside ``dws/``. Every step
reads what the step before it stored, so a run that stops can be repeated with the same batch
number.

Batches come in arrival order, numbered upwards by one writer. A batch decodes its changes once
and stores them; its facts come from these and from the stored state of the facilities and
credits it touches, see :mod:`leaseflow.operators.resume`. So a fact may complete in a later
batch than it began, older changes and facts are not read, and a batch loaded again leaves the
same facts. After a correction of an older batch, the batches after it are loaded again.

State rows lie in folders by key hash, of which a batch opens those it touches. State is folded to one
row a key every few batches (``fold_after``); batches before a fold are settled: sent again, they
change nothing. Where state is behind the stored changes (an older warehouse, a batch that
stopped and was not repeated), the changes in between are read once more to catch up.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leaseflow import schemas as S
from leaseflow.operators import checks as K
from leaseflow.operators import dimensions as DIM
from leaseflow.operators import replay as R
from leaseflow.operators import resume as RS
from leaseflow.operators import summaries as M
from leaseflow.operators import windows as W
from leaseflow.operators.skew import HOT_ROWS
from leaseflow.sources import changes as C
from leaseflow.sources import tables as ST
from leaseflow.sources.snapshots import FOLDED, SnapshotTable
from leaseflow.sources.scratch import materialize

# Marks the rows of the batch that is being loaded.
MINE = "_mine"

# Folders that state rows are dealt to by key; fixed for stored tables.
BUCKET, BUCKETS = "bucket", 64
# Rows of a batch up to which its keys are broadcast and its states dealt anew.
FEW_ROWS = 200_000


def _bucket(key: str) -> Column:
    return F.pmod(F.hash(key), F.lit(BUCKETS)).alias(BUCKET)


class Warehouse:
    """Stored layers under a root folder; ``writer`` names who numbers the batches.

    ``fold_after`` is the number of batches whose states lie side by side before they are folded.
    """

    def __init__(self, spark: SparkSession, root: str, writer: str,
                 limit: int | None = HOT_ROWS, fold_after: int = 8):
        self.spark, self.root, self.writer, self.limit = spark, root, writer, limit
        self.fold_after = fold_after

    # --- loading ---------------------------------------------------------------

    def _batch(self, batch_id: int) -> ST.Batch:
        return ST.Batch(self.writer, batch_id)

    def load_dimensions(self, logs: Mapping[str, DataFrame], batch_id: int) -> None:
        """Upsert the dimensions from their change logs."""
        for table in S.DIMENSIONS:
            rows = DIM.upsert_latest(DIM.dimension_changes(logs[table], table), ["id"],
                                     ["arrival"], keep_order=True)
            ST.upsert_dimension(rows, f"{self.root}/dim/{table}", self._batch(batch_id))

    def load_changes(self, logs: Mapping[str, DataFrame], batch_id: int) -> None:
        """Decode the lifecycle logs of a batch and store them; count rows without a key."""
        changes = {t: C.ordered_changes(logs[t], t) for t in C.TABLE_NUMBER}
        for table, rows in changes.items():
            ST.write_batch(rows, f"{self.root}/chg/{table}", self._batch(batch_id))
        stored = {t: self._changes(t, batch_id, batch_id - 1) for t in changes}
        ST.write_batch(R.keyless_rows(stored), f"{self.root}/rejects", self._batch(batch_id))

    def _since(self, path: str, schema: S.T.StructType, batch_id: int, since: int | None) -> DataFrame:
        """Rows of the batches after ``since`` up to this one, those of this one marked."""
        if since == batch_id - 1:
            own = ST.read_batch(self.spark, path, schema, self._batch(batch_id))
            return own.withColumn(MINE, F.lit(True))
        rows = ST.read_batches(self.spark, path, schema).filter(F.col(ST.BATCH) <= batch_id)
        if since is not None:
            rows = rows.filter(F.col(ST.BATCH) > since)
        return self._marked(rows, batch_id)

    def _changes(self, table: str, batch_id: int, since: int | None) -> DataFrame:
        schema = S.T.StructType([*S.raw_schema(table).fields,
                                 S.T.StructField("op", S.T.StringType()),
                                 S.T.StructField(R.ORDER, S.T.LongType())])
        return self._since(f"{self.root}/chg/{table}", schema, batch_id, since)

    def _marked(self, rows: DataFrame, batch_id: int) -> DataFrame:
        mine = (F.col(ST.WRITER) == self.writer) & (F.col(ST.BATCH) == batch_id)
        return rows.withColumn(MINE, mine).drop(ST.WRITER, ST.BATCH)

    def load_facts(self, logs: Mapping[str, DataFrame], batch_id: int,
                   strict_parity: bool = False) -> None:
        """The facts that a batch of logs emits, given all batches before it.

        One pass over the facility changes makes six facts, one over the contract changes and
        the produced-contract facts, with their order, the sign and start facts.
        """
        if self.settled(batch_id):
            return
        self.load_changes(logs, batch_id)
        self.load_facility_facts(batch_id)
        self.load_lease_facts(batch_id, strict_parity)

    def load_facility_facts(self, batch_id: int) -> None:
        """The six stage-one facts, from the stored changes of a batch."""
        since = self._state_before("facility", batch_id)
        facility = {t: self._changes(t, batch_id, since) for t in S.FACILITY_TABLES}
        self._emit(R.facility_log(facility, keep=(MINE,)), RS.facility_stage(), "facility",
                   R.STAGE_ONE_FACTS, batch_id, since)

    def load_lease_facts(self, batch_id: int, strict_parity: bool = False) -> None:
        """Sign and start facts, from the stored contract changes and produced contracts."""
        since = self._state_before("credit", batch_id)
        produce = "dwd_lease_contract_produce"
        made = self._since(f"{self.root}/dwd/{produce}", self._fact_schema(produce), batch_id, since)
        log = R.credit_log(made, self._changes("contract", batch_id, since), keep=(MINE,))
        self._emit(log, RS.credit_stage(strict_parity), "credit", R.STAGE_TWO_FACTS, batch_id, since)

    def _emit(self, log: DataFrame, stage: RS.Stage, name: str, facts: list[str], batch_id: int,
              since: int | None) -> None:
        """Store what a stage's log emits in this batch, then the states it leaves."""
        table, schema = self.state_table(name), self._state_schema(log, stage)
        entries = table.manifest().entries
        if len(entries) >= self.fold_after and all(e.batch < batch_id for e in entries):
            table.fold(schema, [stage.key])
        counts = {r[BUCKET]: r.n for r in log.groupBy(_bucket(stage.key)).agg(
            F.count(F.lit(1)).alias("n")).collect()}
        many = sum(counts.values()) > FEW_ROWS
        states = None if since is None else self._states_of(log, table, schema, stage, batch_id,
                                                            list(counts), many)
        # Many rows are dealt by key to a multiple of the buckets: a task's states are of few of them.
        rows = materialize(RS.go_on(log, stage, states, (MINE,), self.limit,
                                    BUCKETS if many else None), "going-on",
                           compression="zstd")
        for fact in facts:
            made = RS.fact_of(rows.filter(MINE), fact)
            if fact in R.STAGE_TWO_FACTS:
                made = made.withColumn(R.ORDER, F.lit(None).cast("bigint"))
            self._append(fact, made, batch_id)
        table.write(RS.new_states(rows, stage).withColumn(BUCKET, _bucket(stage.key)),
                    self._batch(batch_id), dealt=many)

    def _states_of(self, log: DataFrame, table: SnapshotTable, schema: S.T.StructType,
                   stage: RS.Stage, batch_id: int, buckets: list[int], many: bool) -> DataFrame:
        """States before this batch of the keys that the log has, from the folders they lie in.

        Few keys are picked out by broadcast. For many, all states of these folders go into the
        scan, which leaves keys without a change as they are: that shuffles states once.
        """
        entries = [e for e in table.manifest().entries if e.batch < batch_id]
        before = table.rows(schema).filter(F.col(BUCKET).isin(buckets) & (F.col(ST.BATCH) < batch_id))
        if not many:
            touched = log.select(stage.key).distinct()
            before = before.join(F.broadcast(touched), stage.key, "left_semi")
        if len(entries) > 1:  # one entry has one row a key
            before = ST.latest_by_key(before, [stage.key])
        return before.select(stage.key, RS.STATE)

    def state_table(self, name: str) -> SnapshotTable:
        """States by key, of one of the two stages: ``facility`` or ``credit``."""
        return SnapshotTable(self.spark, f"{self.root}/state/{name}", BUCKET)

    @staticmethod
    def _state_schema(log: DataFrame, stage: RS.Stage) -> S.T.StructType:
        return S.T.StructType([S.T.StructField(stage.key, S.T.LongType()),
                               S.T.StructField(RS.STATE, RS.state_type(log, stage)),
                               S.T.StructField(BUCKET, S.T.IntegerType())])

    def settled(self, batch_id: int) -> bool:
        """Whether a later batch has folded this one's states: it can't be loaded again."""
        return any(self.state_table(n).manifest().covers(self._batch(batch_id))
                   for n in ("facility", "credit"))

    def _state_before(self, name: str, batch_id: int) -> int | None:
        """The last batch before this one whose states are stored."""
        now = self.state_table(name).manifest()
        others = {e.writer for e in now.entries} | set(now.covered)
        if others - {self.writer, FOLDED}:
            raise ValueError(f"the facts under {self.root} are loaded by another writer: {sorted(others)}")
        stored = [e.batch for e in now.entries if e.writer == self.writer and e.batch < batch_id]
        if self.writer in now.covered:
            stored.append(now.covered[self.writer])
        return max(stored, default=None)

    def _append(self, fact: str, rows: DataFrame, batch_id: int) -> None:
        ST.append_fact_by_day(rows, f"{self.root}/dwd/{fact}", S.FACT_TIME[fact],
                              self._batch(batch_id))

    def load_windows(self, batch_id: int) -> None:
        """All window tables from the stored facts."""
        dims = self.dimensions()
        for name, spec in W.SPECS.items():
            rows = W.window_table(name, self.fact(spec.fact), dims)
            ST.replace_aggregate(rows, f"{self.root}/dws/{name}", self._batch(batch_id))

    def load_touched_windows(self, batch_id: int, names: Iterable[str] = W.SPECS,
                             dims: Mapping[str, DataFrame] | None = None) -> None:
        """The windows that a batch's facts touch, instead of all.

        What the batch adds to each window is stored as partial sums, in place of what an
        earlier attempt stored: that takes its sums back. The groups that either attempt
        touched are summed over the partial sums of all batches and written with names as
        they are known now. Facts of older batches are not read again. These tables have a
        manifest (``sums/``, ``touched/``), apart from those of :meth:`load_windows`.
        """
        dims = self.dimensions() if dims is None else dims
        for name in names:
            spec = W.SPECS[name]
            own = self._marked(self._stored_facts(spec.fact), batch_id).filter(MINE)
            added = W.partial_windows(own, spec)
            sums, group = SnapshotTable(self.spark, f"{self.root}/sums/{name}"), [*W.BOUNDS, *spec.keys]
            before = self._marked(sums.rows(added.schema), batch_id).filter(MINE).select(*group)
            sums.write(added, self._batch(batch_id))
            stored = sums.rows(added.schema)
            touched = self._marked(stored, batch_id).filter(MINE).select(*group).unionByName(before).distinct()
            rows = W.enrich(W.summed_windows(stored, touched, spec), spec, dims)
            self.touched_table(name).write(rows, self._batch(batch_id))

    def refresh_views(self) -> None:
        """Recompute all summary views from the stored facts and dimensions."""
        facts, dims = {f: self.fact(f) for f in S.FACTS}, self.dimensions()
        for name, view in M.VIEWS.items():
            ST.refresh_view(lambda view=view: view(facts, dims), f"{self.root}/ads/{name}")

    def run(self, logs: Mapping[str, DataFrame], batch_id: int) -> None:
        self.load_dimensions(logs, batch_id)
        self.load_facts(logs, batch_id)
        self.load_windows(batch_id)
        self.refresh_views()

    # --- reading -----------------------------------------------------------------

    def dimension(self, table: str) -> DataFrame:
        return ST.read_dimension(self.spark, f"{self.root}/dim/{table}", S.raw_schema(table))

    def dimensions(self) -> dict[str, DataFrame]:
        return {t: self.dimension(t) for t in S.DIMENSIONS}

    @staticmethod
    def _fact_schema(fact: str) -> S.T.StructType:
        return S.T.StructType([*S.FACTS[fact].fields, S.T.StructField(R.ORDER, S.T.LongType()),
                               S.T.StructField(ST.DAY, S.T.DateType())])

    def _stored_facts(self, fact: str) -> DataFrame:
        """Facts with their order and batch."""
        return ST.read_batches(self.spark, f"{self.root}/dwd/{fact}", self._fact_schema(fact))

    def fact(self, fact: str) -> DataFrame:
        return self._stored_facts(fact).select(*S.FACTS[fact].names)

    def rejects(self) -> DataFrame:
        """Rows without a key, per table and batch."""
        schema = S.T.StructType([S.T.StructField("table_name", S.T.StringType()),
                                 S.T.StructField("row_count", S.T.LongType())])
        return ST.read_batches(self.spark, f"{self.root}/rejects", schema)

    # --- upkeep ------------------------------------------------------------------

    def fold(self) -> None:
        """Fold the batches of dimensions and window tables, so reads don't grow for ever."""
        for table in S.DIMENSIONS:
            schema = S.T.StructType([*S.raw_schema(table).fields,
                                     S.T.StructField("arrival", S.T.LongType())])
            ST.fold(self.spark, f"{self.root}/dim/{table}", schema, ["id"], ["arrival"])
        for name, spec in W.SPECS.items():
            path = f"{self.root}/dws/{name}"
            schema = self.spark.read.parquet(path).drop(ST.WRITER, ST.BATCH).schema
            ST.fold(self.spark, path, schema, spec.table_key, day="cur_date")

    def drop_expired(self, as_of: dt.date, keep_undated: bool = True) -> None:
        """Remove days outside the ranges of facts and windows."""
        for fact in S.FACTS:
            ST.drop_expired_folders(self.spark, f"{self.root}/dwd/{fact}", as_of, ST.FACT_DAYS,
                                    keep_undated=keep_undated)
        for name in W.SPECS:
            ST.drop_expired_folders(self.spark, f"{self.root}/dws/{name}", as_of, ST.WINDOW_DAYS,
                                    "cur_date", keep_undated)

    def window(self, name: str) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.root}/dws/{name}")
        return ST.latest_by_key(stored, W.SPECS[name].table_key).select(*W.SPECS[name].columns)

    def touched_table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/touched/{name}", "cur_date")

    def window_schema(self, name: str) -> S.T.StructType:
        empty = {t: self.spark.createDataFrame([], S.raw_schema(t)) for t in S.DIMENSIONS}
        facts = self.spark.createDataFrame([], S.FACTS[W.SPECS[name].fact])
        return W.window_table(name, facts, empty).schema

    def touched_window(self, name: str) -> DataFrame:
        """A window table as :meth:`load_touched_windows` keeps it."""
        return self.touched_table(name).latest(self.window_schema(name), W.SPECS[name].table_key).select(
            *W.SPECS[name].columns)

    def view(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/ads/{name}")

    # --- checking ------------------------------------------------------------------

    def check_funnel(self) -> DataFrame:
        return K.funnel_monotone(self.view("mv_ads_credit_transform"))

    def check_totals(self) -> DataFrame:
        return K.summaries_match_facts({f: self.fact(f) for f in M.OUTCOMES.values()},
                                       self.dimensions())
