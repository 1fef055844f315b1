"""Stored tables as Parquet folders.

A table is a folder of batches, ``<path>/writer=W/batch_id=N/<day>=.../``. The writer names
the run or stream that numbers its batches; two of them never touch each other's folders.
Writing batch N replaces that batch of its writer and nothing else, so a retried batch (lost
executor, restarted query) leaves the same content. What a reader sees depends on the table kind:

* facts keep every row, duplicates included;
* keyed tables (dimensions, windows) show the row of the highest batch number per key; among
  writers with the same number, of the later name.

No stored row is ever rewritten by a load; :func:`compact` folds old batches.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from leaseflow.operators.dimensions import upsert_latest

WRITER, BATCH = "writer", "batch_id"
DAY = "dt"

# Days kept before and after the current day.
FACT_DAYS = (30, 3)
WINDOW_DAYS = (100, 3)
# Rows of a day from which a micro-batch writes it in several files.
FILE_ROWS = 500_000


def stream_writer(checkpoint: str) -> str:
    """Writer name of a stream: one for each checkpoint, which is what numbers its batches."""
    return "stream-" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


class Batch(NamedTuple):
    """Who writes, and which of its batches."""

    writer: str
    number: int


# --- loading -------------------------------------------------------------------

def write_batch(rows: DataFrame, path: str, batch: Batch, day: str | None = None,
                dealt: bool = False) -> None:
    """Write or replace one batch, partitioned by day where the table has one.

    Rows are rebalanced by day first: every task would otherwise write a small file
    per day. Rebalancing splits large days and joins small ones to even file sizes. It needs
    adaptive execution, which stateful streams go without: these give rows that they have
    dealt themselves (``dealt``), see :func:`dealt_by_day`.
    """
    if day and not dealt:
        rows = rows.hint("rebalance", day)
    writer = rows.write.mode("overwrite").options(partitionOverwriteMode="static", compression="zstd")
    if day:
        writer = writer.partitionBy(day)
    writer.parquet(f"{path}/{WRITER}={batch.writer}/{BATCH}={batch.number}")


def dealt_by_day(rows: DataFrame, kind: str, day: str,
                 counts: Mapping[tuple[str, dt.date | None], int]) -> DataFrame:
    """Rows of several kinds dealt to tasks by kind and day, a day of over ``FILE_ROWS`` rows to
    several, and within a task in order of days, which is what a write by day sorts by.

    ``counts`` has the number of rows per kind and day; it only decides how they are dealt.
    """
    files = {key: -(-n // FILE_ROWS) for key, n in counts.items()}
    tasks = max(1, min(sum(files.values()), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    most: dict[str, int] = {}
    for (name, _), n in files.items():
        most[name] = max(n, most.get(name, 1))
    keys = [F.col(kind), F.col(day)]
    if max(most.values(), default=1) > 1:
        parts = F.coalesce(*[F.when(F.col(kind) == name, n) for name, n in most.items()], F.lit(1))
        keys.append(F.pmod(F.xxhash64(*[c for c in rows.columns if c not in (kind, day)]), parts))
    return rows.repartition(tasks, *keys).sortWithinPartitions(day, kind)


def append_fact_by_day(facts: DataFrame, path: str, time: str, batch: Batch,
                       dealt: bool = False) -> None:
    """Duplicate-keeping fact load, partitioned by event day; dealt rows come with their day."""
    write_batch(facts if dealt else facts.withColumn(DAY, F.to_date(time)), path, batch, DAY, dealt)


def replace_aggregate(windows: DataFrame, path: str, batch: Batch) -> None:
    """Window rows of one batch; a row re-sent by a later batch replaces this one."""
    write_batch(windows, path, batch, "cur_date")


def upsert_dimension(rows: DataFrame, path: str, batch: Batch) -> None:
    """Changed dimension rows of one batch (with ``arrival``)."""
    write_batch(rows, path, batch)


# --- reading -------------------------------------------------------------------

def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches of a table with ``writer`` and ``batch_id``; empty if there are none yet."""
    full = T.StructType([*schema.fields, T.StructField(WRITER, T.StringType()),
                         T.StructField(BATCH, T.LongType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def read_batch(spark: SparkSession, path: str, schema: T.StructType, batch: Batch) -> DataFrame:
    """One batch of a table, empty if it isn't there; other folders aren't even listed."""
    try:
        return spark.read.schema(schema).parquet(
            f"{path}/{WRITER}={batch.writer}/{BATCH}={batch.number}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_facts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stored facts with their day column, duplicates kept."""
    with_day = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    return read_batches(spark, path, with_day).drop(WRITER, BATCH)


def latest_by_key(rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Row of the latest batch (then the given order) per key."""
    batch = [c for c in (BATCH, WRITER) if c in rows.columns]
    return upsert_latest(rows, keys, [*batch, *(order or [])])


def read_windows(spark: SparkSession, path: str, schema: T.StructType,
                 keys: list[str]) -> DataFrame:
    return latest_by_key(read_batches(spark, path, schema), keys)


def read_dimension(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    with_order = T.StructType([*schema.fields, T.StructField("arrival", T.LongType())])
    return latest_by_key(read_batches(spark, path, with_order), ["id"], ["arrival"])


def compact(rows: DataFrame, target: str, batch: Batch, day: str | None = None) -> None:
    """Write the visible rows of a table as the first batch of a new folder.

    The caller points readers to the new folder and continues with later batches.
    """
    write_batch(rows, target, batch, day)


def fold(spark: SparkSession, path: str, schema: T.StructType, keys: list[str],
         order: list[str] | None = None, day: str | None = None) -> None:
    """Fold all batches of a keyed table into one, so that readers need not go through its
    whole history; ``schema`` has the order columns.

    The folded batch is written under the highest number before the old folders go, so what
    readers see is the same throughout; a query that has listed the old files has to be
    started again. Run it between loads.
    """
    stored = read_batches(spark, path, schema)
    top = stored.agg(F.max(BATCH)).first()[0]
    if top is None:
        return
    rows = upsert_latest(stored, keys, [BATCH, WRITER, *(order or [])], keep_order=True)
    folded = Batch(f"fold-{uuid.uuid4().hex[:16]}", top)
    write_batch(rows.select(*schema.names), path, folded, day)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/{WRITER}=*/{BATCH}=*")
    store = pattern.getFileSystem(conf)
    for status in store.globStatus(pattern) or []:
        writer = status.getPath().getParent().getName().split("=", 1)[1]
        number = int(status.getPath().getName().split("=", 1)[1])
        if writer != folded.writer and number <= top:
            store.delete(status.getPath(), True)


# --- retention -------------------------------------------------------------------

def retain_days(rows: DataFrame, as_of: dt.date | Column, days: tuple[int, int],
                day: str = DAY, keep_undated: bool = True) -> DataFrame:
    """Rows within the rolling day range; on a stored table this prunes partitions.

    Rows without a day have no age: they stay unless ``keep_undated`` is off.
    """
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    inside = F.col(day).between(F.date_add(now, -days[0]), F.date_add(now, days[1]))
    return rows.filter(inside | F.col(day).isNull() if keep_undated else inside)


def _expired(text: str, as_of: dt.date, days: tuple[int, int], keep_undated: bool) -> bool:
    try:
        value = dt.date.fromisoformat(text)
    except ValueError:  # the partition of rows without a day
        return not keep_undated
    return not -days[0] <= (value - as_of).days <= days[1]


def drop_expired_days(spark: SparkSession, table: str, as_of: dt.date, days: tuple[int, int],
                      day: str = DAY, keep_undated: bool = True) -> list[str]:
    """Drop day partitions outside the range from a catalog table, one statement a day.

    Works on partition names only; no data passes the driver.
    """
    names = {dict(part.split("=", 1) for part in row[0].split("/"))[day]
             for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator()}
    dropped = sorted(n for n in names if _expired(n, as_of, days, keep_undated))
    for name in dropped:
        value = "NULL" if name.startswith("__") else f"'{name}'"
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({day}={value})")
    return dropped


def drop_expired_folders(spark: SparkSession, path: str, as_of: dt.date, days: tuple[int, int],
                         day: str = DAY, keep_undated: bool = True) -> list[str]:
    """The same for a table kept as folders: removes its expired day folders."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/{WRITER}=*/{BATCH}=*/{day}=*")
    store, dropped = pattern.getFileSystem(conf), []
    for status in store.globStatus(pattern) or []:
        name = status.getPath().getName().split("=", 1)[1]
        if _expired(name, as_of, days, keep_undated):
            store.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(set(dropped))


# --- refreshed views -------------------------------------------------------------

def refresh_view(view: Callable[[], DataFrame], path: str) -> None:
    """Full recompute of a view into its folder."""
    view().write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


# --- topics ------------------------------------------------------------------------

# How JSON lines are written: envelopes and messages repeat their field names, so even the fastest
# level leaves about a tenth. Readers know it by the files' names; a file is read by one task.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

# Sends the rows (topic, key, arrival, value) of one batch.
Send = Callable[[DataFrame, int], None]


def file_topics(path: str) -> Send:
    """File twin of a topic sink: JSON lines under ``topic=<name>``; a retried batch
    replaces its files."""
    def send(rows: DataFrame, batch_id: int) -> None:
        (rows.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").options(**PACKED)
         .option("partitionOverwriteMode", "dynamic").partitionBy("topic", BATCH).json(path))
    return send


def kafka_topics(brokers: str) -> Send:
    """Kafka topic sink, at-least-once; needs the connector jar.

    Messages are keyed, so those of one key keep their order in a topic of many partitions.
    """
    def send(rows: DataFrame, batch_id: int) -> None:
        (rows.select("topic", F.col("key").cast("string").alias("key"), "value").write.format("kafka")
         .option("kafka.bootstrap.servers", brokers).save())
    return send
