"""Streams over captured files, end to end, against their batch forms."""

from __future__ import annotations

import itertools
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from leaseflow import schemas as S
from leaseflow.functions.fields import fact_json, read_fact_json
from leaseflow.operators import lifecycle as L
from leaseflow.operators import windows as W
from leaseflow.operators.dimensions import dimension_table
from leaseflow.sources import changes as C
from leaseflow.sources import derived as T
from leaseflow.sources import tables as ST
from leaseflow.streaming import facts as SF
from leaseflow.streaming import ingest as SI
from leaseflow.streaming import windows as SW
from tests import traces as TR
from tests.conftest import SMALL
from tests.test_lifecycle import random_trace

ONCE = {"availableNow": True}


def wait(query, seconds: int = 240):
    try:
        assert query.awaitTermination(seconds), "stream did not end"
    finally:
        query.stop()
    return query


_clock = itertools.count(1_700_000_000)


def write_lines(folder, name, records):
    """JSON lines; every file is a second younger than the last (streams read by age)."""
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))
    now = next(_clock)
    os.utime(folder / name, (now, now))


@pytest.fixture(scope="module")
def changes():
    rng = random.Random(23)
    return TR.parse({key: random_trace(rng) for key in range(1, 40)})


@pytest.fixture(scope="module")
def raw_topics(spark, changes, tmp_path_factory):
    """Envelope files per table, in arrival order, cut into three files each."""
    root = tmp_path_factory.mktemp("topics")
    for table, df in TR.frames(spark, changes).items():
        rows = df.select(F.col("seq").alias("arrival"), C.to_envelope(df, table).alias("value"))
        lines = sorted((r.arrival, r.value) for r in rows.collect())
        for part in range(3):
            cut = lines[len(lines) * part // 3: len(lines) * (part + 1) // 3]
            write_lines(root / table, f"{part}.json",
                        [{"arrival": a, "value": v} for a, v in cut])
    return root


def read_all(spark, root, fact):
    return ST.read_facts(spark, f"{root}/{fact}", S.FACTS[fact]).select(*S.FACTS[fact].names)


def test_facts_stream_equals_rules(spark, changes, raw_topics, tmp_path):
    """Both stages in one micro-batch: the arrival order decides, as in the rules."""
    logs = {t: C.stream_log(spark, str(raw_topics / t)) for t in S.FACILITY_TABLES}
    tables, topics = str(tmp_path / "dwd"), str(tmp_path / "topics")
    tagged = SF.stage_one(SF.facility_rows(logs), ttl_ms=None)
    send = ST.file_topics(topics)
    wait(SF.start(tagged, SF.STAGE_ONE, tables, send, str(tmp_path / "c1"), ONCE))

    expected = TR.run_rules(changes)
    for fact in SF.STAGE_ONE:
        assert TR.canonical(read_all(spark, tables, fact).collect()) == \
            TR.canonical(expected[fact]), fact

    rows = SF.credit_rows(SI.topic_log(spark, topics, "dwd_lease_contract_produce"),
                          C.stream_log(spark, str(raw_topics / "contract")))
    wait(SF.start(SF.stage_two(rows), SF.STAGE_TWO, tables, send, str(tmp_path / "c2"), ONCE))
    for fact in SF.STAGE_TWO:
        assert TR.canonical(read_all(spark, tables, fact).collect()) == \
            TR.canonical(expected[fact]), fact

    # The topics carry the same facts as the tables, NULL fields written out.
    text = spark.read.schema(C.LOG_SCHEMA).json(f"{topics}/topic=dwd_audit_reject")
    back = read_fact_json(text, "dwd_audit_reject").collect()
    assert TR.canonical(back) == TR.canonical(expected["dwd_audit_reject"])
    assert all("audit_man_id" in json.loads(r.value) for r in text.collect())


def test_state_carries_over_micro_batches_with_ttl(spark, tmp_path):
    """Rows of one facility in three batches; the hour-long expiry does not interfere."""
    rows = TR.parse({1: "S16 R A7 F", 2: "C1ou F R C1ou"})
    for table in S.FACILITY_TABLES:
        df = TR.frames(spark, rows)[table]
        lines = df.select(F.col("seq").alias("arrival"),
                          C.to_envelope(df, table).alias("value")).collect()
        for n in range(1, 5):
            write_lines(tmp_path / "in" / table, f"{n}.json",
                        [{"arrival": r.arrival, "value": r.value} for r in lines
                         if r.arrival == n] or [{"arrival": 0, "value": "{}"}])
    logs = {t: C.stream_log(spark, str(tmp_path / "in" / t), files_per_batch=1)
            for t in S.FACILITY_TABLES}
    tagged = SF.stage_one(SF.facility_rows(logs))
    query = wait(SF.start(tagged, SF.STAGE_ONE, str(tmp_path / "dwd"), ST.file_topics(str(tmp_path / "t")),
                          str(tmp_path / "c"), ONCE))
    assert len([p for p in query.recentProgress if p.numInputRows]) >= 2
    expected = TR.run_rules(rows)
    for fact in SF.STAGE_ONE:
        assert TR.canonical(read_all(spark, tmp_path / "dwd", fact).collect()) == \
            TR.canonical(expected[fact]), fact


def test_expired_state_emits_nothing(spark, tmp_path):
    """A facility whose context is older than the expiry never makes its fact."""
    rows = TR.parse({1: "F A7 R S16"})
    for table in S.FACILITY_TABLES:
        df = TR.frames(spark, rows)[table]
        lines = df.select(F.col("seq").alias("arrival"),
                          C.to_envelope(df, table).alias("value")).collect()
        early = [r for r in lines if r.arrival <= 3]
        late = [r for r in lines if r.arrival == 4]
        for n, part in enumerate((early, late)):
            write_lines(tmp_path / f"in{n}" / table, "f.json",
                        [{"arrival": r.arrival, "value": r.value} for r in part]
                        or [{"arrival": 0, "value": "{}"}])
        write_lines(tmp_path / "in" / table, "0.json",
                    [json.loads(x) for x in (tmp_path / "in0" / table / "f.json")
                     .read_text().splitlines()])
    def run(ttl_ms):
        logs = {t: C.stream_log(spark, str(tmp_path / "in" / t)) for t in S.FACILITY_TABLES}
        name = f"ttl-{ttl_ms}"
        wait(SF.start(SF.stage_one(SF.facility_rows(logs), ttl_ms=ttl_ms), SF.STAGE_ONE,
                      str(tmp_path / name), ST.file_topics(str(tmp_path / f"{name}-t")),
                      str(tmp_path / f"{name}-c"), ONCE))

    for ttl_ms in (1000, None):
        run(ttl_ms)
    time.sleep(2)
    for table in S.FACILITY_TABLES:
        (tmp_path / "in" / table / "1.json").write_text(
            (tmp_path / "in1" / table / "f.json").read_text())
    # The same two steps without expiry do make the fact.
    for ttl_ms, made in ((1000, 0), (None, 1)):
        run(ttl_ms)
        assert read_all(spark, tmp_path / f"ttl-{ttl_ms}", "dwd_audit_approve").count() == made


def test_produced_contracts_are_ordered_by_their_messages(spark, tmp_path):
    """Two contract changes, then the produced contract: one sign. The topic's own numbers
    would put the produced contract first, which makes two."""
    fact = "dwd_lease_contract_produce"
    made = {"id": 1, "produced_time": f"{TR.at(9):%Y-%m-%d %H:%M:%S}.000000", "credit_id": 1,
            "credit_facility_id": 1, "apply_amount": "1.00", "reply_amount": "1.00",
            "credit_amount": "1.00", "seq": 999}
    write_lines(tmp_path / "topics" / f"topic={fact}", "0.json",
                [{"key": "1", "value": json.dumps(made), "arrival": 0}])
    contract = [{"source": {"db": "lease", "table": "contract"}, "op": "u",
                 "after": {"id": 1, "credit_id": 1, "signed_time": 1_700_000_000_000_000 + n}}
                for n in range(2)]
    write_lines(tmp_path / "in", "0.json",
                [{"arrival": 10 + n, "value": json.dumps(c)} for n, c in enumerate(contract)])
    rows = SF.credit_rows(SI.topic_log(spark, str(tmp_path / "topics"), fact),
                          C.stream_log(spark, str(tmp_path / "in")))
    wait(SF.start(SF.stage_two(rows), SF.STAGE_TWO, str(tmp_path / "dwd"),
                  ST.file_topics(str(tmp_path / "out")), str(tmp_path / "c"), ONCE))
    assert read_all(spark, tmp_path / "dwd", "dwd_lease_sign").count() == 1


def test_dimension_stream_equals_batch(spark, tmp_path):
    """Three batches of changes; the table shows the last image per id."""
    log = T.dimension_log(spark, SMALL, "department")
    for n in range(3):
        lines = [r.asDict() for r in log.filter(F.col("arrival") == n).collect()]
        write_lines(tmp_path / "in", f"{n}.json", lines)
    wait(SI.start_dimension(C.stream_log(spark, str(tmp_path / "in"), 1), "department",
                            str(tmp_path / "dim"), str(tmp_path / "c"), ONCE))
    stored = ST.read_dimension(spark, str(tmp_path / "dim"), S.raw_schema("department"))
    assert TR.canonical(stored.collect()) == TR.canonical(
        dimension_table(log, "department").collect())


def test_routing_stream(spark, tmp_path):
    lines = ['{"source":{"table":"credit"},"op":"c","after":{}}', "not json",
             '{"source":{"table":null},"op":"c"}', '{"op":"c"}']
    write_lines(tmp_path / "in", "0.json",
                [{"arrival": n, "value": v} for n, v in enumerate(lines)])
    wait(SI.start_routing(C.stream_log(spark, str(tmp_path / "in")),
                          ST.file_topics(str(tmp_path / "out")), str(tmp_path / "c"), ONCE))
    got = spark.read.json(str(tmp_path / "out")).groupBy("topic").count().collect()
    assert {r["topic"]: r["count"] for r in got} == {"ods_credit": 1, "ods_unknown_table": 3}


def fact_topic(spark, folder, fact, batches):
    """Topic files, one per batch of (seconds, amount) pairs."""
    for n, batch in enumerate(batches):
        write_lines(folder, f"{n}.json", [
            {"arrival": i, "value": json.dumps({
                "id": i, S.FACT_TIME[fact]: f"{TR.at(s):%Y-%m-%d %H:%M:%S}.000000",
                "credit_facility_id": 1, "apply_amount": f"{a}.00", "reply_amount": "1.00",
                "credit_amount": "2.00"})} for i, (s, a) in enumerate(batch)])


def test_live_window_late_rows(spark, tmp_path):
    """A row of a fired window is dropped; one just inside the disorder bound is kept.

    The watermark moves between micro-batches, so windows fire one batch later.
    """
    fact, name = "dwd_credit_add", "dws_credit_credit_add_win"
    fact_topic(spark, tmp_path / "in", fact, [
        [(1, 10), (3, 10), (14, 5)],       # watermark 9: window 0-10 still open
        [(4, 10), (16, 5), (26, 1)],       # 4 is kept; then watermark 21: 0-10, 10-20 fire
        [(22, 1)],                         # they are written out with this batch
        [(5, 100), (19, 100)],             # late by now
        [(60, 1)], [(61, 1)],
    ])
    topic = C.stream_log(spark, str(tmp_path / "in"), files_per_batch=1)
    query = wait(SW.start(topic, name, lambda: {}, str(tmp_path / "dws"), str(tmp_path / "c"),
                          ONCE))
    schema = S.T.StructType([
        S.T.StructField("stt", S.WALL), S.T.StructField("edt", S.WALL),
        S.T.StructField("apply_count", S.T.LongType()), S.T.StructField("apply_amount", S.MONEY),
        S.T.StructField("reply_amount", S.MONEY), S.T.StructField("credit_amount", S.MONEY),
        S.T.StructField("cur_date", S.T.DateType())])
    rows = ST.read_windows(spark, str(tmp_path / "dws"), schema, W.SPECS[name].table_key).collect()
    got = {int((r.stt - TR.T0).total_seconds()): (r.apply_count, int(r.apply_amount)) for r in rows}
    assert got == {0: (3, 30), 10: (2, 10), 20: (2, 2)}
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress
                  for op in p.stateOperators)
    assert dropped >= 1


def test_live_windows_equal_batch_windows(spark, tmp_path):
    """Closed live windows of an enriched table equal the batch rows of those windows."""
    raw, name = T.raw_tables(spark, SMALL), \
        "dws_audit_industry_lease_organization_salesman_reject_win"
    fact = W.SPECS[name].fact
    facts = L.fact(raw, fact)
    lines = [r.asDict() for r in facts.orderBy("reject_time").select(
        F.lit(0).alias("arrival"), fact_json(fact).alias("value")).collect()]
    for n in range(3):
        write_lines(tmp_path / "in", f"{n}.json",
                    lines[len(lines) * n // 3: len(lines) * (n + 1) // 3])
    write_lines(tmp_path / "in", "9.json", [{"arrival": 0, "value": "{}"}])
    topic = C.stream_log(spark, str(tmp_path / "in"), files_per_batch=1)
    wait(SW.start(topic, name, lambda: raw, str(tmp_path / "dws"), str(tmp_path / "c"), ONCE))
    batch = W.window_table(name, facts, raw)
    live = ST.read_windows(spark, str(tmp_path / "dws"), batch.schema, W.SPECS[name].table_key)
    live_rows = set(TR.canonical(live.select(*batch.columns).collect()))
    batch_rows = TR.canonical(batch.collect())
    assert live_rows <= set(batch_rows)
    last = max(r[0] for r in live_rows)
    assert live_rows == {r for r in batch_rows if r[0] <= last}
    assert len(live_rows) > 300
