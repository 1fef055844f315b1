"""Replay that forgets: against the row-by-row rules whose state expires."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from leaseflow import schemas as S
from leaseflow.operators import expiry as EX
from leaseflow.operators import replay as R
from tests import traces as TR
from tests.test_lifecycle import random_trace

# Trace, time to live, and the facts with the position of their status or credit row.
HAND = [
    ("F A7 R S16", 4, [("dwd_audit_approve", 4)]),
    ("F A7 R S16", 3, []),                                    # the facility is forgotten
    ("F A7 R S16 F", 3, []),                                  # then the auditor
    ("F A7 R S16 F A8", 4, [("dwd_audit_approve", 4)]),
    ("S20 A7 F", 3, [("dwd_audit_reject", 1)]),
    ("S20 A7 F", 2, []),                                      # the waiting outcome is forgotten
    ("F S21 A7 F F", 9, [("dwd_audit_cancel", 2)]),           # once, though complete again
    ("F S21 A7 A7 S21 F", 3, [("dwd_audit_cancel", 2), ("dwd_audit_cancel", 5)]),
    ("C1or F R", 3, [("dwd_credit_add", 1), ("dwd_credit_occupy", 1)]),
    ("C1or F R", 2, []),
    ("F R C1ou A7 C1ou F R", 3, [("dwd_credit_occupy", 3), ("dwd_credit_occupy", 5)]),
    ("F R A7 C1ou F R", 2, []),
    ("F R C1pu A7 A7 A7 K1s", 3, [("dwd_lease_contract_produce", 3), ("dwd_lease_sign", 7)]),
]


def replay(spark, changes, ttl, limit=None):
    return {f: [tuple(r) for r in EX.fact(changes, f, R.ORDER, ttl, limit).collect()] for f in S.FACTS}


@pytest.mark.parametrize("ttl", sorted({t for _, t, _ in HAND}))
def test_hand_traces(spark, ttl):
    cases = {key: (trace, want) for key, (trace, t, want) in enumerate(HAND, start=1) if t == ttl}
    rows = TR.parse({key: trace for key, (trace, _) in cases.items()})
    expected = sorted((f, key, at) for key, (_, want) in cases.items() for f, at in want)
    for facts in (replay(spark, TR.frames(spark, rows), ttl), TR.run_rules(rows, ttl=ttl)):
        found = []
        for fact, made in facts.items():
            for row in made:
                values = dict(zip(S.FACTS[fact].names, row, strict=True))
                key = values.get("credit_facility_id", values["id"])
                found.append((fact, key, int((values[S.FACT_TIME[fact]] - TR.T0).total_seconds())))
        assert sorted(found) == expected


@pytest.mark.parametrize("ttl,limit", [(3, None), (6, 10), (10_000, 10)])
def test_equals_row_by_row(spark, ttl, limit):
    rng = random.Random(23)
    log = {key: random_trace(rng) for key in range(1, 150)}
    log[500] = " ".join(random_trace(rng) for _ in range(30))  # a hot key, in segments
    rows = TR.parse(log)
    mine, theirs = replay(spark, TR.frames(spark, rows), ttl, limit), TR.run_rules(rows, ttl=ttl)
    for fact in S.FACTS:
        assert TR.canonical(mine[fact]) == TR.canonical(theirs[fact]), fact
    # Expiry matters, and a long one changes nothing.
    assert (theirs == TR.run_rules(rows)) == (ttl == 10_000)


def test_clock_of_its_own(spark):
    """Arrival times apart from the order: nothing is known to a row without one."""
    rows = TR.parse({1: "F S21 S20", 2: "F S21 S20"})
    changes = {}
    for table, frame in TR.frames(spark, rows).items():
        late = frame.columns[1 if table == "credit_facility_status" else 0]
        clock = F.when((F.col(late) == 1) | (F.col("seq") < 3), F.col("seq") * 10)
        changes[table] = frame.withColumn("arrived", clock.cast("bigint"))
    for fact, ids in (("dwd_audit_cancel", [1, 2]), ("dwd_audit_reject", [1])):
        made = EX.fact(changes, fact, "arrived", ttl=25)
        assert made.columns == S.FACTS[fact].names
        assert sorted(r.id for r in made.collect()) == ids


def test_empty(spark):
    changes = TR.frames(spark, TR.parse({}))
    for fact in S.FACTS:
        assert EX.fact(changes, fact, R.ORDER, limit=5).count() == 0
