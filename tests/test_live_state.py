"""State of the live facts: calls a key costs, expiry by slot, exact texts."""

from __future__ import annotations

import json

from pyspark.sql import Row, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import TimerValues

from leaseflow import schemas as S
from leaseflow.streaming import facts as SF
from leaseflow.streaming import rules


class Store:
    """State of one key, and how often it was asked."""

    def __init__(self):
        self.values, self.calls = {}, 0

    def getValueState(self, name, schema, **ttl):
        return Slot(self, name)


class Slot:
    def __init__(self, store, name):
        self.store, self.name = store, name

    def exists(self):
        self.store.calls += 1
        return self.name in self.store.values

    def get(self):
        self.store.calls += 1
        return self.store.values.get(self.name)

    def update(self, value):
        self.store.calls += 1
        self.store.values[self.name] = value

    def clear(self):
        self.store.calls += 1
        self.store.values.pop(self.name, None)


COLUMNS = ["kind", "op", "id", *rules.FACILITY_FIELDS, "status", "employee_id", "create_time", "irr", "period",
           "contract_id", "credit_occupy_time", "contract_produce_time"]
KEYS = {f: "id" for f in SF.STAGE_ONE[:3]} | {f: "credit_facility_id" for f in SF.STAGE_ONE[3:]}


def processor(store, ttl_ms=None):
    made = SF.KeyedRules(rules.facility_row, COLUMNS, KEYS, ttl_ms)
    made.init(store)
    return made


def handle(made, now, *rows):
    given = [Row(seq=n, row=json.dumps(r)) for n, r in enumerate(rows)]
    return [(r.fact_type, json.loads(r.fact)) for r in made.handleInputRows((7,), iter(given), TimerValues(now, -1))]


FACILITY = {"kind": "facility", "op": "r", "id": 7, "credit_amount": "5.00"}
ASSIGNED = {"kind": "status", "op": "r", "status": 5, "employee_id": 3, "create_time": "t0"}
APPROVED = {"kind": "status", "op": "r", "status": 16, "create_time": "t1"}
REPLY = {"kind": "reply", "op": "r", "id": 1, "credit_amount": "4.00"}


def approve_code():
    from leaseflow.operators.lifecycle import AUDITOR_STATUSES, OUTCOME_STATUS
    return OUTCOME_STATUS["dwd_audit_approve"], next(iter(AUDITOR_STATUSES))


def test_a_key_costs_few_state_calls():
    """Every call is a round trip to the JVM; their number must not grow with the slots."""
    store = Store()
    code, assigned = approve_code()
    assert not handle(processor(store), -1, FACILITY, REPLY, {**ASSIGNED, "status": assigned})
    assert store.calls <= 3
    found = handle(processor(store), -1, {**APPROVED, "status": code})
    assert [f for f, _ in found] == ["dwd_audit_approve"]
    assert found[0][1]["approve_time"] == "t1" and found[0][1]["audit_man_id"] == 3
    assert store.calls <= 6


def test_slots_expire_by_their_own_last_write():
    """A facility written again at 50 lives until 150, the reply of 0 is gone at 100."""
    code, assigned = approve_code()
    for at, made in ((99, 1), (100, 0)):
        store = Store()
        handle(processor(store, 100), 0, REPLY)
        handle(processor(store, 100), 50, FACILITY, {**ASSIGNED, "status": assigned})
        assert len(handle(processor(store, 100), at, {**APPROVED, "status": code})) == made
        cancel = {**APPROVED, "status": rules.OUTCOME_STATUS["dwd_audit_cancel"]}
        assert [f for f, _ in handle(processor(store, 100), 149, cancel)] == ["dwd_audit_cancel"]
        assert not handle(processor(store, 100), 260, cancel)


def test_texts_are_exact(spark):
    schema = T.StructType([T.StructField("a", S.MONEY), T.StructField("b", S.WALL), T.StructField("c", T.LongType()),
                           T.StructField("d", T.StringType())])
    rows = spark.range(5).select("id", F.lit("99999999999999999.99").cast(S.MONEY).alias("a"), F.expr(
        "element_at(array(null, timestamp_ntz'1900-01-01 00:00:00', timestamp_ntz'2020-02-29 23:59:59.000001',"
        " timestamp_ntz'+12345-01-01 00:00:00.1', timestamp_ntz'0001-01-01 00:00:00'), int(id + 1))").alias("b"),
        F.lit(-2 ** 63).alias("c"), F.expr("if(id = 1, null, concat(char(9), '\"\\\\é', id))").alias("d"))
    text = rows.select("id", SF.as_text(schema).alias("t"))
    back = SF.from_text(text, "t", schema, ("id",))
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0
