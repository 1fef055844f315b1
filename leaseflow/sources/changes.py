"""Change-record log: reading, routing and decoding.

A log is a DataFrame with a ``value`` column (one JSON envelope per row) and, where
order matters, an ``arrival`` column (bigint; a topic offset or a file position).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leaseflow import schemas as S
from leaseflow.functions import fields as X

LOG_SCHEMA = "arrival bigint, value string"
TOPIC_PREFIX = "ods_"
# The tables of the lifecycle, numbered to break ties between topics.
TABLE_NUMBER = {"credit_facility": 0, "credit_facility_status": 1, "reply": 2,
                "credit": 3, "contract": 4}
UNKNOWN_TABLE = "unknown_table"
# Bounds of one micro-batch, which also bound a task's rows of one key.
FILES_PER_BATCH, ROWS_PER_TRIGGER = 100, 1_000_000


# --- readers ---------------------------------------------------------------

def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Captured log files (JSON lines of arrival and value) as a batch."""
    return spark.read.schema(LOG_SCHEMA).json(path)


def stream_log(spark: SparkSession, path: str,
               files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """The same files as a stream, from the first file on."""
    return (spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
            .json(path))


def stream_text(spark: SparkSession, path: str) -> DataFrame:
    """Plain text files, one envelope per line, no arrival number."""
    return spark.readStream.text(path)


def stream_topic(spark: SparkSession, brokers: str, topic: str,
                 per_trigger: int = ROWS_PER_TRIGGER) -> DataFrame:
    """A message topic from its earliest offset; needs the Kafka connector jar.

    ``per_trigger`` bounds what a task holds of one key.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_trigger)
    )
    return topic_rows(reader.load())


def topic_rows(messages: DataFrame) -> DataFrame:
    """Topic messages (value, timestamp, offset) -> (arrival, value).

    Offsets of different topics or partitions say nothing about each other, so the order
    is the message's time in milliseconds, then its offset: the first 45 bits and the
    last 18 of ``arrival`` (of messages with equal time, 262,144 of a partition in a row
    are told apart).
    """
    arrival = (F.unix_millis("timestamp") * (1 << 18)) + F.pmod(F.col("offset"), F.lit(1 << 18))
    return messages.select(arrival.alias("arrival"), F.col("value").cast("string").alias("value"))


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Snapshot images first, then the change log, as one ordered batch log.

    The order is carried by ``phase``: rows of the snapshot sort before rows of
    the log whatever their arrival numbers are.
    """
    return snapshot.withColumn("phase", F.lit(0)).unionByName(
        changes.withColumn("phase", F.lit(1)))


def of_tables(log: DataFrame, pattern: str) -> DataFrame:
    """Rows whose ``source.db``.``source.table`` matches a regular expression."""
    name = F.concat_ws(".", F.get_json_object("value", "$.source.db"),
                       F.get_json_object("value", "$.source.table"))
    return log.filter(name.rlike(f"^(?:{pattern})$"))


# --- routing ----------------------------------------------------------------

def topic_of(value: Column | str = "value") -> Column:
    """Target topic of an envelope; unreadable or nameless rows have their own."""
    table = F.get_json_object(value, "$.source.table")
    return F.concat(F.lit(TOPIC_PREFIX), F.coalesce(table, F.lit(UNKNOWN_TABLE)))


def message_key(value: Column | str = "value") -> Column:
    """Key of an envelope's message: the facility, for contracts the credit, else the id."""
    field = {"credit_facility": "id", "contract": "credit_id"}
    table, key = F.get_json_object(value, "$.source.table"), F.get_json_object(value, "$.after.id")
    for name in TABLE_NUMBER:
        path = f"$.after.{field.get(name, 'credit_facility_id')}"
        key = F.when(table == name, F.get_json_object(value, path)).otherwise(key)
    return key


def route_by_table(log: DataFrame) -> DataFrame:
    return log.withColumn("topic", topic_of())


# --- envelopes --------------------------------------------------------------

def op_code(value: Column | str = "value") -> Column:
    """Operation letter, NULL when absent or unreadable."""
    return F.get_json_object(value, "$.op")


def parse_envelope(log: DataFrame, table: str) -> DataFrame:
    """Envelopes of one table as (table_name, op, after); failures are dropped."""
    return parse_images(log, table).filter(
        F.col("table_name").isNotNull() & F.col("op").isNotNull())


def parse_images(log: DataFrame, table: str) -> DataFrame:
    """Envelopes of one table as (table_name, op, after), whatever fields they lack."""
    kept = [c for c in log.columns if c != "value"]
    return (
        log.select(*kept, X.parse_once("value", S.envelope_schema(table)).alias("_e"))
        .select(*kept, F.col("_e.source.table").alias("table_name"),
                F.col("_e.op").alias("op"), F.col("_e.after").alias("after"))
    )


def after_image(value: Column | str, table: str) -> Column:
    """The ``after`` struct of an envelope, NULL for deletes and bad JSON."""
    return F.from_json(value, S.envelope_schema(table))["after"]


def drop_deletes(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("after").isNotNull())


def live_dim_rows(rows: DataFrame) -> DataFrame:
    """Dimension changes that carry an image: no deletes, ``after`` and id present."""
    return rows.filter((F.coalesce("op", F.lit("r")) != "d") & F.col("after").isNotNull()
                       & F.col("after.id").isNotNull())


def decode_after(rows: DataFrame, table: str, keep: tuple[str, ...] = ("op",)) -> DataFrame:
    """``after`` struct -> typed columns of the raw table, plus the kept ones."""
    return rows.select(
        *keep,
        *[X.decoded_field(F.col("after")[c], kind).alias(c) for c, kind in S.RAW[table]],
    )


def decode_table(log: DataFrame, table: str, keep: tuple[str, ...] = ("op",)) -> DataFrame:
    """Log -> typed rows of one raw table (deletes dropped)."""
    rows = parse_envelope(log, table).filter(F.col("table_name") == table)
    return decode_after(drop_deletes(rows), table, keep)


def arrival_order(table: str, arrival: Column | str = "arrival") -> Column:
    """Order number of a row among all lifecycle topics: by arrival, then by table."""
    arrival = F.col(arrival) if isinstance(arrival, str) else arrival
    return arrival * 8 + TABLE_NUMBER[table]


def ordered_changes(log: DataFrame, table: str) -> DataFrame:
    """Log of a lifecycle table -> typed rows with ``op`` and order number ``seq``.

    A log of :func:`snapshot_then_changes` has its snapshot first: those numbers are negative.
    """
    phase = ("phase",) if "phase" in log.columns else ()
    rows = decode_table(log, table, keep=("op", "arrival", *phase))
    order = arrival_order(table)
    if phase:
        order = F.when(F.col("phase") == 0, order - F.lit(1 << 62)).otherwise(order)
    return rows.withColumn("seq", order).drop("arrival", *phase)


def to_envelope(rows: DataFrame, table: str, op: Column | str = "op", db: str = "lease") -> Column:
    """Typed raw rows -> envelope JSON text (used for fixtures and re-publishing)."""
    op = F.col(op) if isinstance(op, str) else op
    image = F.struct(*[X.encoded_field(F.col(c), kind).alias(c) for c, kind in S.RAW[table]])
    return F.to_json(F.struct(
        F.struct(F.lit(db).alias("db"), F.lit(table).alias("table")).alias("source"),
        op.alias("op"),
        F.when(op != "d", image).alias("after"),
    ))


# --- splitting and uniting ----------------------------------------------------

def split_by_table(rows: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows of ``table``, all other rows)."""
    return (rows.filter(F.col("table_name") == table),
            rows.filter(F.col("table_name") != table))
