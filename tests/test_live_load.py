"""What the live facts cost: state calls of a block of keys, files of a micro-batch, tasks of a run."""

from __future__ import annotations

import json
import random
import threading

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import TimerValues

from leaseflow import schemas as S
from leaseflow.functions import fields as X
from leaseflow.plans import stored as SD
from leaseflow.session import side_by_side
from leaseflow.sources import changes as C
from leaseflow.sources import derived as D
from leaseflow.sources import tables as ST
from leaseflow.streaming import facts as SF
from leaseflow.streaming import rules
from tests import traces as TR
from tests.test_lifecycle import random_trace
from tests.test_live_state import (
    APPROVED, ASSIGNED, COLUMNS, FACILITY, KEYS, REPLY, Store, approve_code, handle, processor)
from tests.test_streaming import ONCE, read_all, wait


def test_a_block_of_keys_costs_the_calls_of_one():
    store = Store()
    code, assigned = approve_code()
    keys = [7 + n for n in range(50)]
    given = [{**row, SF.KEY: key} for row in (FACILITY, REPLY, {**ASSIGNED, "status": assigned}) for key in keys]
    assert not handle(processor(store), -1, *given)
    assert store.calls <= 3
    found = handle(processor(store), -1, *[{**APPROVED, "status": code, SF.KEY: key} for key in keys[10:]])
    assert [(f, values["id"]) for f, values in found] == [("dwd_audit_approve", key) for key in keys[10:]]
    assert store.calls <= 6
    assert not handle(processor(store), -1, {**APPROVED, "status": code, SF.KEY: 3})


def test_keys_of_a_block_expire_on_their_own():
    """Key 8 keeps the block alive; what key 7 had shown before is gone."""
    store, cancel = Store(), {**APPROVED, "status": rules.OUTCOME_STATUS["dwd_audit_cancel"]}
    handle(processor(store, 100), 0, {**FACILITY, SF.KEY: 7})
    handle(processor(store, 100), 50, {**FACILITY, SF.KEY: 8})
    found = handle(processor(store, 100), 120, {**cancel, SF.KEY: 7}, {**cancel, SF.KEY: 8})
    assert [values["id"] for _, values in found] == [8]


def test_a_micro_batch_writes_a_file_a_day(spark, tmp_path, monkeypatch):
    """Negative, distant and neighbouring ids; one file a day and fact while a day is small."""
    rng = random.Random(5)
    rows = TR.parse({key: random_trace(rng) for key in [*range(-5, 40), 2 ** 40, 2 ** 52]})
    for table, df in TR.frames(spark, rows).items():
        df.select(F.col("seq").alias("arrival"), C.to_envelope(df, table).alias("value")).write.json(
            str(tmp_path / "in" / table))
    expected = TR.run_rules(rows)
    for limit in (500_000, 1):
        monkeypatch.setattr(ST, "FILE_ROWS", limit)
        logs = {t: C.stream_log(spark, str(tmp_path / "in" / t)) for t in S.FACILITY_TABLES}
        wait(SF.start(SF.stage_one(SF.facility_rows(logs), ttl_ms=None), SF.STAGE_ONE, str(tmp_path / f"dwd{limit}"),
                      ST.file_topics(str(tmp_path / f"topics{limit}")), str(tmp_path / f"check{limit}"), ONCE))
        several = 0
        for fact in SF.STAGE_ONE:
            assert TR.canonical(read_all(spark, tmp_path / f"dwd{limit}", fact).collect()) == TR.canonical(expected[fact])
            files = [len(list(day.glob("part-*"))) for day in (tmp_path / f"dwd{limit}" / fact).glob("*/*/dt=*")]
            several += sum(n > 1 for n in files)
        assert (several == 0) == (limit > 1)


def test_state_parts_follow_the_rows(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with SD._state_tasks(spark, 10) as parts:
        assert parts == SD._files(spark)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(parts)
    with SD._state_tasks(spark, 1_000_000_001) as parts:
        assert parts == 2001
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_frames_give_what_rows_give():
    """Also for order numbers above 2 ** 53, a missing one and rows out of order."""
    code, assigned = approve_code()
    late, rows = {**APPROVED, "status": code}, []
    for key in (128, 200):
        rows += [(2 ** 60 + 3, {**late, SF.KEY: key}), (2 ** 60 + 1, {**FACILITY, SF.KEY: key}),
                 (2 ** 60 + 2, {**REPLY, SF.KEY: key}), (2 ** 60, {**ASSIGNED, "status": assigned, SF.KEY: key})]
    for given in (rows, [(None, {**FACILITY, SF.KEY: 128})]):
        stores = Store(), Store()
        made = SF.FrameRules(rules.facility_row, COLUMNS, KEYS, None)
        made.init(stores[0])
        frames = [pd.DataFrame({"seq": [None if seq is None else str(seq) for seq, _ in part],
                                "row": [json.dumps(row) for _, row in part]}) for part in (given[:3], given[3:])]
        found = [tuple(row) for frame in made.handleInputRows((1,), iter(frames), TimerValues(-1, -1))
                 for row in frame.itertuples(index=False)]
        texts = [(seq, json.dumps(row)) for seq, row in given]
        assert found == list(processor(stores[1]).facts((1,), texts, -1))
        assert [seq for _, seq, _ in found] == ([2 ** 60 + 3] * 2 if given is rows else [])
        assert stores[0].values == stores[1].values


def test_times_of_writing_are_kept_where_state_expires_only():
    for ttl_ms, kept in ((None, {}), (100, {"7": {"facility": 5}})):
        store = Store()
        handle(processor(store, ttl_ms), 5, FACILITY)
        assert json.loads(store.values["block"][1]) == kept


def test_side_by_side(spark):
    """Two actions that wait for each other end; a failure is raised after all have ended."""
    meet, ended = threading.Barrier(2, timeout=20), []

    def fails():
        meet.wait()
        raise ValueError("of one")

    def works():
        meet.wait()
        ended.append(1)

    with pytest.raises(ValueError, match="of one"):
        side_by_side(spark, [fails, works])
    assert ended == [1]
    side_by_side(spark, [])


def test_facts_of_a_micro_batch_are_written_side_by_side(spark, tmp_path, monkeypatch):
    meet, sent = threading.Barrier(len(SF.STAGE_ONE), timeout=20), []
    monkeypatch.setattr(ST, "append_fact_by_day", lambda *_: meet.wait())
    batch = spark.createDataFrame([], SF.output_schema(SF.STAGE_ONE))
    SF.dual_write(SF.STAGE_ONE, str(tmp_path), lambda rows, number: sent.append(number), "w")(batch, 4)
    assert sent == [4]


def test_logs_are_written_whole_in_few_files(spark, tmp_path, monkeypatch):
    """Without a shuffle; the files of a table fit one micro-batch however many parts its source has."""
    orders = spark.range(700).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"),
        F.element_at(F.array(*map(F.lit, "FOP")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"),
        (F.col("id") * 1.25).alias("o_totalprice"), F.expr("timestamp_ntz'1995-03-04 00:00:00'").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"))
    orders.repartition(5).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(C, "FILES_PER_BATCH", 3)
    rows = SD._write_logs(spark, str(tmp_path), str(tmp_path / "in"))
    for table in C.TABLE_NUMBER:
        assert 1 <= len(list((tmp_path / "in" / table).glob("part-*"))) <= 3
        written, whole = C.read_log(spark, str(tmp_path / "in" / table)), SD._log(spark, str(tmp_path), table)
        assert rows[table] == whole.count() == D.replay_changes(spark, str(tmp_path), table).count()
        assert written.exceptAll(whole).count() == 0 and whole.exceptAll(written).count() == 0


def test_topics_of_a_micro_batch_are_written_beside_its_facts(spark, tmp_path, monkeypatch):
    meet, sent = threading.Barrier(len(SF.STAGE_ONE) + 1, timeout=20), []

    def send(rows, number):
        meet.wait()
        sent.append(number)

    monkeypatch.setattr(ST, "append_fact_by_day", lambda *_: meet.wait())
    batch = spark.createDataFrame([], SF.output_schema(SF.STAGE_ONE))
    SF.dual_write(SF.STAGE_ONE, str(tmp_path), send, "w")(batch, 5)
    assert sent == [5]


def test_facts_of_a_micro_batch_are_dealt_and_sorted_once(spark, tmp_path, monkeypatch):
    """What a fact's write is given needs no shuffle and no sort of its own."""
    given = {}
    monkeypatch.setattr(ST, "append_fact_by_day", lambda rows, path, *_: given.update(
        {path.rsplit("/", 1)[1]: rows._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")}))
    batch = spark.createDataFrame([], SF.output_schema(SF.STAGE_ONE))
    SF.dual_write(SF.STAGE_ONE, str(tmp_path), lambda *_: None, "w")(batch, 0)
    assert sorted(given) == sorted(SF.STAGE_ONE)
    for own, stored, *_ in given.values():
        assert "Exchange" not in own and "Sort" not in own
        assert "Exchange" in stored and "Sort" in stored


def test_large_days_of_one_kind_are_dealt_to_several_tasks(spark, monkeypatch):
    rows = spark.range(600).select(
        "id", F.when(F.col("id") < 500, "big").when(F.col("id") < 590, "small").alias("kind"),
        F.expr("if(id % 7 = 0, null, date'2020-01-01' + cast(id % 2 as int))").alias("day"))
    counts = {(r["kind"], r["day"]): r["count"] for r in rows.groupBy("kind", "day").count().collect()}
    monkeypatch.setattr(ST, "FILE_ROWS", 100)
    dealt = ST.dealt_by_day(rows, "kind", "day", counts)
    assert dealt.exceptAll(rows).count() == 0 and rows.exceptAll(dealt).count() == 0
    placed = dealt.withColumn("task", F.spark_partition_id()).groupBy("kind", "day").agg(
        F.countDistinct("task").alias("tasks"))
    tasks = {(r["kind"], r["day"]): r["tasks"] for r in placed.collect()}
    assert all(n == 1 for (kind, _), n in tasks.items() if kind != "big")
    assert max(n for (kind, _), n in tasks.items() if kind == "big") > 1


def test_messages_carry_what_the_json_of_their_fact_has(spark):
    for facts in (SF.STAGE_ONE, SF.STAGE_TWO):
        schema = SF.output_schema(facts)
        values = {"long": "id * 7", "string": "concat('a\"', id)", "int": "3", "decimal(19,2)": "cast(id as decimal(19,2)) / 4",
                  "timestamp_ntz": "timestamp_ntz'2020-01-01 00:00:00.5' + make_dt_interval(id)"}
        given = {c.name: F.expr(f"if(id % 3 = 0, null, {values.get(c.dataType.simpleString(), 'id')})").cast(c.dataType)
                 for c in schema if c.name not in ("fact_type", "seq")}
        rows = spark.range(40).select(
            F.element_at(F.array(*map(F.lit, facts)), (F.col("id") % len(facts) + 1).cast("int")).alias("fact_type"),
            F.col("id").alias("seq"), *[v.alias(n) for n, v in given.items()])
        made = {(r["topic"], r["arrival"]): (r["value"], r["key"]) for r in SF._messages(rows, facts).collect()}
        assert len(made) == 40
        for fact in facts:
            for r in SF.of_type(rows, fact, ("seq",)).select("seq", X.fact_json(fact, ("seq",)).alias("value"),
                                                             F.col(SF.topic_key(fact)).cast("string").alias("key")).collect():
                assert made[fact, r["seq"]] == (r["value"], r["key"])


def test_rows_of_a_block_are_decoded_many_at_a_time(monkeypatch):
    calls, decode = [], SF._decode
    monkeypatch.setattr(SF, "DECODED_ROWS", 20)
    monkeypatch.setattr(SF, "_decode", lambda text: calls.append(1) or decode(text))
    texts = [(n, json.dumps({"n": n})) for n in range(50)]
    assert list(SF._decoded(texts)) == [(n, {"n": n}) for n in range(50)]
    assert len(calls) == 3 and not list(SF._decoded([]))
