"""Registered queries that run stored and live forms: batch loads and file streams.

The runs behind the queries of one session and folder are made once and shared.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from leaseflow import schemas as S
from leaseflow.functions import fields as X
from leaseflow.operators import lifecycle as L
from leaseflow.operators import windows as W
from leaseflow.operators.skew import TASK_ROWS
from leaseflow.plans.warehouse import Warehouse
from leaseflow.session import STREAM_CONF, side_by_side
from leaseflow.sources import changes as C
from leaseflow.sources import derived as T
from leaseflow.sources import tables as ST
from leaseflow.sources.scratch import scratch_path
from leaseflow.streaming import facts as SF
from leaseflow.streaming import ingest as SI
from leaseflow.streaming import windows as SW

ONCE = {"availableNow": True}
# Middle of the arrival numbers of the derived logs: the second batch begins here.
CUT = 5_000_015
# Bytes of packed log files that a task reads: those of ``TASK_ROWS`` to twice as many rows.
PACKED_TASK = 16 << 20

_runs: dict[tuple[str, str, str], str] = {}


def _shared(spark: SparkSession, sf_dir: str, name: str, make) -> str:
    """Folder of a run, made on first use."""
    key = spark.sparkContext.applicationId, sf_dir, name
    if key not in _runs:
        root = scratch_path(spark, name)
        make(spark, sf_dir, root)
        _runs[key] = root
    return _runs[key]


def _log(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return _as_log(T.replay_changes(spark, sf_dir, table), table)


def _as_log(rows: DataFrame, table: str) -> DataFrame:
    return rows.select(F.col("seq").alias("arrival"), C.to_envelope(rows, table).alias("value"))


# --- batch loads ----------------------------------------------------------------------------

def _load_two(spark: SparkSession, sf_dir: str, root: str) -> None:
    house = Warehouse(spark, root, "two")
    logs = {t: _log(spark, sf_dir, t) for t in C.TABLE_NUMBER}
    first = {t: log.filter(F.col("arrival") < CUT) for t, log in logs.items()}
    second = {t: log.filter(F.col("arrival") >= CUT) for t, log in logs.items()}
    for batch_id, part in ((0, first), (1, second), (1, second)):
        house.load_facts(part, batch_id)


def two_batches(spark: SparkSession, sf_dir: str, fact: str) -> DataFrame:
    """A log in two batches, the second loaded twice: facts that begin in one batch and end
    in the other are found once."""
    return Warehouse(spark, _shared(spark, sf_dir, "two-batches", _load_two), "two").fact(fact)


# --- streams ----------------------------------------------------------------------------------

def _finish(query) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()


def _files(spark: SparkSession) -> int:
    """State parts of a small stream: work for all cores."""
    return max(4, min(spark.sparkContext.defaultParallelism, C.FILES_PER_BATCH))


@contextmanager
def _state_tasks(spark: SparkSession, rows: int) -> Iterator[int]:
    """Streams begun inside keep their state in as many parts as so many rows need, and read packed
    files in tasks of about as many rows.

    State parts are fixed when a stream begins and adaptive execution does not join them, so
    each costs a state store and files however few rows it has: the session's number is for shuffles.
    """
    parts = max(_files(spark), -(-rows // TASK_ROWS))
    settings = {"spark.sql.shuffle.partitions": parts, "spark.sql.files.maxPartitionBytes": PACKED_TASK}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield parts
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _write_logs(spark: SparkSession, sf_dir: str, path: str) -> dict[str, int]:
    """Change-log files of all tables, ``<path>/<table>``, of at most ``TASK_ROWS`` rows each;
    returns the number of rows per table."""
    seen = {table: Observation() for table in C.TABLE_NUMBER}
    # The source tables are opened once for all logs.
    changes = dict(T.replay_tables(spark, sf_dir))

    def write(table: str) -> None:
        log = _as_log(changes[table], table).coalesce(C.FILES_PER_BATCH)
        (log.observe(seen[table], F.count(F.lit(1)).alias("rows")).write
         .options(maxRecordsPerFile=TASK_ROWS, **ST.PACKED).json(f"{path}/{table}"))

    side_by_side(spark, [partial(write, table) for table in seen])
    return {table: count.get["rows"] for table, count in seen.items()}


def _stream_facts(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Both stages over change-log files; the second reads the first one's topic."""
    for name, value in STREAM_CONF.items():
        spark.conf.set(name, value)
    rows = _write_logs(spark, sf_dir, f"{root}/in")
    # All files of a table in one micro-batch: a writing task has one that is not full.
    logs = {t: C.stream_log(spark, f"{root}/in/{t}", C.FILES_PER_BATCH + rows[t] // TASK_ROWS)
            for t in C.TABLE_NUMBER}
    send = ST.file_topics(f"{root}/topics")
    with _state_tasks(spark, sum(rows[t] for t in S.FACILITY_TABLES)):
        _finish(SF.start(SF.stage_one(SF.facility_rows(logs), ttl_ms=None), SF.STAGE_ONE,
                         f"{root}/dwd", send, f"{root}/check1", ONCE))
        made = SI.topic_log(spark, f"{root}/topics", "dwd_lease_contract_produce", 10_000)
        _finish(SF.start(SF.stage_two(SF.credit_rows(made, logs["contract"])), SF.STAGE_TWO,
                         f"{root}/dwd", send, f"{root}/check2", ONCE))


def stream_fact(spark: SparkSession, sf_dir: str, fact: str) -> DataFrame:
    """A fact as the live form stores it; one micro-batch, so arrival order decides."""
    root = _shared(spark, sf_dir, "stream-facts", _stream_facts)
    return ST.read_facts(spark, f"{root}/dwd/{fact}", S.FACTS[fact]).select(*S.FACTS[fact].names)


LIVE_WINDOW = "dws_credit_credit_add_win"


def _stream_window(spark: SparkSession, sf_dir: str, root: str) -> None:
    """All facts, then a row far in the future, twice (rows are late by the watermark of the
    micro-batch before), then every second fact again, too late."""
    for name, value in STREAM_CONF.items():
        spark.conf.set(name, value)
    fact = W.SPECS[LIVE_WINDOW].fact
    facts = L.fact(T.raw_tables(spark, sf_dir), fact)
    time = S.FACT_TIME[fact]
    future = facts.limit(1).withColumn(time, F.lit("2100-01-01 00:00:00").cast("timestamp_ntz"))
    for n, rows in enumerate((facts, future, future, facts.filter(F.col("id") % 4 < 2))):
        rows.select(F.lit(0).alias("arrival"), X.fact_json(fact).alias("value")).write.json(
            f"{root}/topics/topic={fact}/{n}")
        topic = SI.topic_log(spark, f"{root}/topics", fact, 10_000)
        _finish(SW.start(topic, LIVE_WINDOW, dict, f"{root}/dws", f"{root}/check", ONCE))


def stream_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A live window table: closed by the watermark, rows that come later are dropped."""
    root = _shared(spark, sf_dir, "stream-window", _stream_window)
    spec = W.SPECS[LIVE_WINDOW]
    kinds = {"stt": S.WALL, "edt": S.WALL, "cur_date": S.T.DateType(), "apply_count": S.T.LongType()}
    schema = S.T.StructType([S.T.StructField(c, kinds.get(c, S.MONEY)) for c in spec.columns])
    return ST.read_windows(spark, f"{root}/dws", schema, spec.table_key).select(*spec.columns)


QUERIES = {f"warehouse_two_batches_{f}": partial(two_batches, fact=f) for f in S.FACTS}
QUERIES |= {f"stream_{f}": partial(stream_fact, fact=f) for f in S.FACTS}
QUERIES["stream_dws_credit_credit_add_win"] = stream_window

SQL = {f"{kind}_{f}": f"SELECT * FROM replay_{f}" for f in S.FACTS
       for kind in ("warehouse_two_batches", "stream")}
SQL["stream_dws_credit_credit_add_win"] = f"SELECT * FROM {LIVE_WINDOW}"
