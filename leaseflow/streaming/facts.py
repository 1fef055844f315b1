"""Live lifecycle facts: keyed state per facility and per credit.

A micro-batch's rows of one key are sorted by arrival before the rules see them, so
the number of rows taken per trigger (``files_per_batch``, ``per_trigger`` of the
sources) is what bounds the memory of a task. State per key is a handful of images; the
states of a block of consecutive ids are one value.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from functools import partial, reduce
from itertools import batched
from operator import itemgetter
from typing import TYPE_CHECKING, Any

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from leaseflow import schemas as S
from leaseflow.functions import fields as X
from leaseflow.operators import lifecycle as L
from leaseflow.operators import replay as R
from leaseflow.session import side_by_side
from leaseflow.sources import changes as C
from leaseflow.sources import tables as ST
from leaseflow.sources.shipping import ship
from leaseflow.streaming import rules

if TYPE_CHECKING:
    import pandas as pd

HOUR_MS = 3_600_000

STAGE_ONE, STAGE_TWO = R.STAGE_ONE_FACTS, R.STAGE_TWO_FACTS

# Types that JSON would not carry exactly.
_TEXT = (S.WALL, S.MONEY)

# Keys whose ids differ in the last bits alone share a state value, about 40 KB of text when no id
# is missing: at most 128 facilities or, as these keep less, 256 credits.
FACILITY_BITS, CREDIT_BITS = 7, 8
# A row's own key, beside the block that it is grouped by.
KEY = "_key"
# Rows of a block that are decoded at a time.
DECODED_ROWS = 1000


def output_schema(facts: list[str]) -> T.StructType:
    """One row type for all facts of a stage: ``fact_type``, ``seq`` and every column."""
    columns = {f.name: f.dataType for name in facts for f in S.FACTS[name]}
    return T.StructType([T.StructField("fact_type", T.StringType()),
                         T.StructField("seq", T.LongType()),
                         *[T.StructField(n, t) for n, t in columns.items()]])


def as_text(columns: T.StructType) -> Column:
    """The columns that are not null as JSON; times and amounts as their text, which is exact."""
    return F.to_json(F.struct(*[
        (F.col(c.name).cast("string") if c.dataType in _TEXT else F.col(c.name)).alias(c.name)
        for c in columns]))


def from_text(rows: DataFrame, text: str, columns: T.StructType, keep: tuple[str, ...]) -> DataFrame:
    """Inverse of :func:`as_text`: the kept columns, then the typed ones."""
    schema = T.StructType([T.StructField(c.name, T.StringType() if c.dataType in _TEXT else c.dataType)
                           for c in columns])
    return rows.select(*keep, X.parse_once(text, schema).alias("_f")).select(
        *keep, *[F.col(f"_f.{c.name}").cast(c.dataType).alias(c.name) for c in columns])


class KeyedRules(StatefulProcessor):
    """Keeps the rule state of a block of keys and emits the facts its rows produce.

    Rows, facts and state go between Python and the JVM as JSON text (``row``, ``fact``), since each
    column and each state call costs more than a rule: the images of a block's keys are one value,
    read once and written once a micro-batch. A row names its key (``_key``), without one it is
    of the group's. A slot expires ``ttl_ms`` after its own last write, the value after its latest.
    """

    def __init__(self, apply: Callable, columns: list[str], key_column: dict[str, str],
                 ttl_ms: int | None):
        self.apply, self.key_column, self.ttl_ms = apply, key_column, ttl_ms
        self.absent = dict.fromkeys(columns)

    def init(self, handle: Any) -> None:
        ttl = {"ttlDurationMs": self.ttl_ms} if self.ttl_ms else {}
        self.state = handle.getValueState("block", "images string, written string", **ttl)

    def _read(self, now: int) -> tuple[dict[str, dict], dict[str, dict[str, int]]]:
        """By key: the images that have not expired, and (where they expire) when each was written."""
        # Reading where nothing is would write a line to the log.
        if not self.state.exists():
            return {}, {}
        block, written = (json.loads(text) for text in self.state.get())
        if self.ttl_ms:
            block = {k: {n: image for n, image in known.items() if now - written[k][n] < self.ttl_ms}
                     for k, known in block.items()}
        return block, written

    def facts(self, key: Any, rows: Iterable[tuple[int, str]], now: int) -> Iterator[tuple[str, int, str]]:
        """(fact type, order number, JSON) of what the (order number, JSON) rows of a block produce."""
        block, written = self._read(now)
        before = {k: dict(known) for k, known in block.items()}
        for seq, row in _decoded(sorted(rows, key=_order)):
            given = {**self.absent, **row}
            own = given.pop(KEY, key[0])
            for fact, values in self.apply(block.setdefault(str(own), {}), given):
                yield fact, seq, _encode({self.key_column[fact]: own, **values})
        block = {k: known for k, known in block.items() if known}
        if not block:
            if any(before.values()):
                self.state.clear()
        elif any(_changed(block.get(k, {}), before.get(k, {})) for k in {*block, *before}):
            times = {k: {n: written[k][n] if image is before.get(k, {}).get(n) else now
                         for n, image in known.items()} for k, known in block.items()} if self.ttl_ms else {}
            self.state.update((_encode(block), _encode(times)))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        given = ((row["seq"], row["row"]) for row in rows)
        for fact, seq, text in self.facts(key, given, timerValues.getCurrentProcessingTimeInMs()):
            yield Row(fact_type=fact, seq=seq, fact=text)

    def close(self) -> None:
        pass


class FrameRules(KeyedRules):
    """The same over data frames: a row costs a quarter of a ``Row`` to pass, a block several times as
    much, so this is for blocks that get many rows at a time. Order numbers come as text: a null
    would make floating-point numbers of a frame's others."""

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # Not above: the process that plans a stream would wait for it.
        import pandas as pd

        given = ((int(seq) if isinstance(seq, str) else None, text)
                 for part in rows for seq, text in zip(part["seq"].tolist(), part["row"].tolist()))
        made = list(self.facts(key, given, timerValues.getCurrentProcessingTimeInMs()))
        if made:
            yield pd.DataFrame(made, columns=["fact_type", "seq", "fact"], dtype=object)


_decode, _encode = json.JSONDecoder().raw_decode, json.JSONEncoder().encode
_order = itemgetter(0)


def _decoded(rows: list[tuple[int, str]]) -> Iterator[tuple[int, dict]]:
    """Rows with their JSON decoded, many at a time: a call costs as much as a small row."""
    for part in batched(rows, DECODED_ROWS):
        yield from zip([seq for seq, _ in part], _decode(f"[{','.join([text for _, text in part])}]")[0])


def _changed(known: dict[str, dict], before: dict[str, dict]) -> bool:
    return len(known) != len(before) or any(known[n] is not before.get(n) for n in known)


# --- inputs --------------------------------------------------------------------

def facility_rows(logs: dict[str, DataFrame]) -> DataFrame:
    """Envelope logs of the four facility tables -> one stream of typed rows, each with the columns
    that the rules read of its kind: the others would only make its message longer."""
    kinds = {"credit_facility": ("facility", "id"), "reply": ("reply", "credit_facility_id"),
             "credit_facility_status": ("status", "credit_facility_id"),
             "credit": ("credit", "credit_facility_id")}
    parts = []
    for table, (kind, key) in kinds.items():
        rows = C.ordered_changes(logs[table], table)
        parts.append(rows.select(F.col(key).alias("credit_facility_id"), "seq", F.lit(kind).alias("kind"),
                                 *rules.READ[kind]))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return united.filter(F.col("credit_facility_id").isNotNull())


def credit_rows(produce_topic: DataFrame, contract_log: DataFrame) -> DataFrame:
    """Produced-contract topic and contract log -> one stream keyed by credit.

    Produced contracts are ordered by the ``seq`` their messages carry.
    """
    fact = "dwd_lease_contract_produce"
    order = F.get_json_object("value", "$.seq").cast("bigint")
    made = X.read_fact_json(produce_topic.withColumn("seq", order), fact, keep=("seq",)).select(
        "seq", "credit_id", *L.PRODUCE_CARRIED,
        F.lit("produce").alias("kind"))
    rows = C.ordered_changes(contract_log, "contract").drop("op").withColumn(
        "kind", F.lit("contract"))
    united = made.unionByName(rows, allowMissingColumns=True)
    return united.filter(F.col("credit_id").isNotNull())


# --- stateful operators ------------------------------------------------------------

def _keyed(rows: DataFrame, key: str, bits: int, apply: Callable, key_column: dict[str, str],
           ttl_ms: int | None, frames: bool = False) -> DataFrame:
    # The stateful function takes along the sources known when it is built, so they come first.
    ship(rows.sparkSession)
    columns = T.StructType([c for c in rows.schema if c.name not in (key, "seq")])
    facts = output_schema(list(key_column))
    text = as_text(T.StructType([*columns, T.StructField(KEY, T.LongType())]))
    order = F.col("seq").cast("string").alias("seq") if frames else F.col("seq")
    blocks = rows.withColumn(KEY, F.col(key)).select(
        F.shiftright(key, bits).alias("block"), order, text.alias("row")).groupBy("block")
    run, kind = ((blocks.transformWithStateInPandas, FrameRules) if frames
                 else (blocks.transformWithState, KeyedRules))
    made = run(
        statefulProcessor=kind(apply, columns.names, key_column, ttl_ms),
        outputStructType="fact_type string, seq bigint, fact string",
        outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")
    return from_text(made, "fact", T.StructType(facts.fields[2:]), ("fact_type", "seq"))


def stage_one(rows: DataFrame, ttl_ms: int | None = HOUR_MS) -> DataFrame:
    """Facility rows -> tagged facts. Every slot expires ``ttl_ms`` after its last write."""
    key_column = {f: "id" for f in L.OUTCOME_STATUS} | {
        f: "credit_facility_id" for f in L.CREDIT_MILESTONE}
    return _keyed(rows, "credit_facility_id", FACILITY_BITS, rules.facility_row, key_column, ttl_ms,
                  frames=True)


def stage_two(rows: DataFrame, strict_parity: bool = False) -> DataFrame:
    """Credit rows -> tagged sign and start facts; this state never expires."""
    apply = partial(rules.credit_row, strict_parity=strict_parity)
    return _keyed(rows, "credit_id", CREDIT_BITS, apply, {f: "credit_id" for f in STAGE_TWO}, None)


def of_type(tagged: DataFrame, fact: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of one fact with that fact's columns."""
    return tagged.filter(F.col("fact_type") == fact).select(*keep, *S.FACTS[fact].names)


# --- sinks -----------------------------------------------------------------------------

def topic_key(fact: str) -> str:
    """Column that keys a fact's messages: what the next stage groups by."""
    names = S.FACTS[fact].names
    return next(c for c in ("credit_id", "credit_facility_id", "id") if c in names)


def dual_write(facts: list[str], table_root: str, send: ST.Send, writer: str) -> Callable:
    """foreachBatch function: every fact goes to its day-partitioned table and its topic.

    Messages carry ``seq``: the next stage orders by it, whatever the topic's own numbers
    are. The batch is stored while it is written out, so the state is read once, and stored
    again as it is dealt: one shuffle and one sort for all tables, which with the topics are
    written at the same time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn(ST.DAY, F.coalesce(*[
            F.when(F.col("fact_type") == f, F.to_date(S.FACT_TIME[f])) for f in facts]))
        batch.persist()
        dealt = ST.dealt_by_day(batch, "fact_type", ST.DAY, _rows_by_day(batch)).persist()
        try:
            # Made before all write, or tasks of several writes would make the same part.
            dealt.count()
            # What is dealt holds all of it: two copies of a large batch would lie on disk.
            batch.unpersist()
            side_by_side(batch.sparkSession, [
                partial(send, _messages(dealt, facts), batch_id),
                *[partial(ST.append_fact_by_day, of_type(dealt, fact, (ST.DAY,)), f"{table_root}/{fact}",
                          S.FACT_TIME[fact], ST.Batch(writer, batch_id), True) for fact in facts]])
        finally:
            dealt.unpersist()
            batch.unpersist()
    return write


def _rows_by_day(batch: DataFrame) -> dict[tuple[str, Any], int]:
    """Number of rows per fact and event day of a batch."""
    counted = batch.groupBy("fact_type", ST.DAY).count().collect()
    return {(row["fact_type"], row[ST.DAY]): row["count"] for row in counted}


def _messages(batch: DataFrame, facts: list[str]) -> DataFrame:
    """The topic rows of a batch in one pass: ``arrival``, ``value``, ``key``, ``topic``."""
    def by_fact(column: Callable[[str], Column]) -> Column:
        return F.coalesce(*[F.when(F.col("fact_type") == f, column(f)) for f in facts])

    # Facts share columns: each is made text once, not once for every fact.
    rows = batch.filter(F.col("fact_type").isin(facts)).select(
        *[X.fact_text(c.name, c.dataType) for c in output_schema(facts)])
    return rows.select(
        F.col("seq").alias("arrival"), by_fact(lambda f: X.to_json_row([*S.FACTS[f].names, "seq"])).alias("value"),
        by_fact(lambda f: F.col(topic_key(f)).cast("string")).alias("key"),
        F.col("fact_type").alias("topic"))


def start(tagged: DataFrame, facts: list[str], table_root: str, send: ST.Send,
          checkpoint: str, trigger: dict[str, Any] | None = None):
    """Run a fact stream; the default trigger is the usual ten-second micro-batch.

    Its checkpoint names the writer: a new checkpoint numbers its batches afresh, in
    folders of its own.
    """
    write = dual_write(facts, table_root, send, ST.stream_writer(checkpoint))
    return (tagged.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())
