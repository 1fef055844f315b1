"""Pending, overwrite, re-emission and emission-time rules on hand-written and random
traces; the batch replay (plain and segmented) against the row-by-row rules."""

from __future__ import annotations

import random

import pytest

from leaseflow import schemas as S
from leaseflow.operators import lifecycle as L
from leaseflow.operators import replay as R
from tests import traces as TR

# trace -> expected (fact without prefix, position of its time, {column: expected})
HAND = {
    "F A7 R S16": [("audit_approve", 4, {"audit_man_id": 7, "salesman_id": 1})],
    "S16 R A7 F": [("audit_approve", 1, {"industry_id": 4, "reply_id": 2})],
    "S16 S16 F A7 R": [("audit_approve", 2, {})],
    "F A7 R S16 S16": [("audit_approve", 4, {}), ("audit_approve", 5, {})],
    "F S16 A1 R A2": [("audit_approve", 2, {"audit_man_id": 1})],
    "F A A7 S16 R F": [("audit_approve", 4, {"audit_man_id": 7, "salesman_id": 1})],
    "F S20 A7": [("audit_reject", 2, {"audit_man_id": None})],
    "S20 A7 F": [("audit_reject", 1, {"audit_man_id": 7})],
    "F A7 S21": [("audit_cancel", 3, {"audit_man_id": 7})],
    "F S9 A": [],
    "C1ou C2ou F R": [("credit_occupy", 2, {})],
    "F R C1oc C1ou": [("credit_add", 3, {}), ("credit_occupy", 3, {}), ("credit_occupy", 4, {})],
    "F0 C1ou R": [("credit_occupy", 2, {"apply_amount": None})],
    "F0 R C1ou": [],
    "F0 R C1ou F": [("credit_occupy", 3, {})],
    "F R0 C1ou R": [("credit_occupy", 3, {})],
    "F R C1pu K1s": [("lease_contract_produce", 3, {}), ("lease_sign", 4, {})],
    "K1s F R C1pu": [("lease_contract_produce", 4, {}), ("lease_sign", 1, {})],
    "F R C1pu K1s K1se": [("lease_contract_produce", 3, {}), ("lease_sign", 4, {}),
                          ("lease_sign", 5, {}), ("lease_execution", 5, {})],
    "K1s K1s F R C1pu": [("lease_contract_produce", 5, {}), ("lease_sign", 2, {})],
}
KEYS = {key: trace for key, trace in enumerate(HAND, start=1)}


def facts_of(changes, limit, strict=False, facts=tuple(S.FACTS)):
    return {f: [tuple(r) for r in R.fact(changes, f, limit, strict).collect()] for f in facts}


def expected_by_hand():
    out = []
    for key, trace in KEYS.items():
        for fact, position, values in HAND[trace]:
            out.append((f"dwd_{fact}", key, position, values))
    return out


def check_hand(facts):
    found = []
    for fact, rows in facts.items():
        names = S.FACTS[fact].names
        for row in rows:
            values = dict(zip(names, row))
            key = values["id"] if "credit_facility_id" not in values else values["credit_facility_id"]
            position = int((values[S.FACT_TIME[fact]] - TR.T0).total_seconds())
            found.append((fact, key, position, values))
    shape = lambda items: sorted(i[:3] for i in items)
    assert shape(found) == shape(expected_by_hand())
    for fact, key, position, values in expected_by_hand():
        row = next(f[3] for f in found if f[:3] == (fact, key, position))
        assert {c: row[c] for c in values} == values, KEYS[key]


def test_hand_traces_rules():
    check_hand(TR.run_rules(TR.parse(KEYS)))


def test_hand_traces_batch(spark):
    check_hand(facts_of(TR.frames(spark, TR.parse(KEYS)), None))


def random_trace(rng: random.Random) -> str:
    tokens = []
    for token, most in (("F", 2), ("F0", 1), ("A7", 1), ("A8", 1), ("A", 1), ("R", 2), ("R0", 1),
                        ("S16", 2), ("S20", 1), ("S21", 1)):
        tokens += [token] * rng.randint(0, most)
    for _ in range(rng.randint(0, 4)):
        tokens.append(f"C{rng.randint(1, 2)}{rng.choice(['', 'o', 'op', 'p'])}{rng.choice('rcu')}")
    for _ in range(rng.randint(0, 3)):
        tokens.append(f"K{rng.randint(1, 2)}{rng.choice(['', 's', 'se'])}")
    rng.shuffle(tokens)
    return " ".join(tokens)


@pytest.fixture(scope="module")
def random_changes():
    rng = random.Random(11)
    traces = {key: random_trace(rng) for key in range(1, 400)}
    # One facility with far more rows than all others: a hot key.
    traces[500] = " ".join(random_trace(rng) for _ in range(60))
    return TR.parse(traces)


@pytest.mark.parametrize("limit,strict", [(None, False), (None, True), (10, False), (10, True)])
def test_batch_equals_row_by_row(spark, random_changes, limit, strict):
    changes = TR.frames(spark, random_changes)
    theirs = TR.run_rules(random_changes, strict)
    assert all(theirs.values())
    # The strict rule concerns the second stage only.
    facts = R.STAGE_TWO_FACTS if strict else list(S.FACTS)
    mine = facts_of(changes, limit, strict, facts)
    for fact in facts:
        assert TR.canonical(mine[fact]) == TR.canonical(theirs[fact]), fact


@pytest.mark.parametrize("limit", [None, 10])
def test_tagged_pass_equals_single_facts(spark, random_changes, limit):
    changes = TR.frames(spark, random_changes)
    tagged = R.tagged_facts(changes, limit).cache()
    for fact in R.STAGE_ONE_FACTS:
        one = R.stage_one_fact(changes, fact, None).collect()
        assert TR.canonical(R.of_type(tagged, fact).collect()) == TR.canonical(one), fact


def test_strict_parity_forgets_a_produced_contract():
    rows = TR.parse({1: "K1s K1e F R C1pu K1s C1pu"})
    kept, strict = TR.run_rules(rows), TR.run_rules(rows, strict_parity=True)
    assert len(kept["dwd_lease_sign"]) == len(strict["dwd_lease_sign"]) == 2
    amounts = lambda facts: [r[-1] for r in facts["dwd_lease_sign"]]
    assert amounts(kept) == [5, 5] and amounts(strict) == [5, 7]


def test_order_does_not_matter_for_single_triggers(spark):
    """One row per slot: every arrival order gives the facts of the set form."""
    rng, base = random.Random(5), "F A7 R S16 C1opr K1se".split()
    traces = {key: " ".join(rng.sample(base, len(base))) for key in range(1, 60)}
    changes = TR.frames(spark, TR.parse(traces))
    for fact in S.FACTS:
        ids = lambda df: sorted(r[0] for r in df.select("id").collect())
        assert ids(R.fact(changes, fact, None)) == ids(L.fact(changes, fact, None)), fact


@pytest.mark.parametrize("limit", [None, 3])
def test_set_form_with_hot_facility(spark, limit):
    """Many status rows, credits and contracts of one facility: each makes its fact."""
    hot = "F A7 R " + " ".join(["S16", "S20", "S21", "C1opr", "C2opr"] * 8)
    changes = TR.frames(spark, TR.parse({1: hot, 2: "F A7 R S16 C1opr K1se", 3: "S16 F"}))
    contracts = TR.frames(spark, TR.parse({1: "K1se " * 9, 2: "K1se"}))["contract"]
    facts = {f: L.fact({**changes, "contract": contracts}, f, limit).collect() for f in S.FACTS}
    assert {f: len(r) for f, r in facts.items()} == {
        "dwd_audit_approve": 9, "dwd_audit_cancel": 8, "dwd_audit_reject": 8,
        "dwd_credit_add": 17, "dwd_credit_occupy": 17, "dwd_lease_contract_produce": 17,
        "dwd_lease_sign": 10, "dwd_lease_execution": 10}


def test_latest_context_wins_in_set_form(spark):
    changes = TR.frames(spark, TR.parse({1: "F A1 A2 A R R S16"}))
    row = L.fact(changes, "dwd_audit_approve").first()
    assert (row.audit_man_id, row.reply_id) == (2, 6)


def test_first_only(spark):
    changes = TR.frames(spark, TR.parse({1: "F R C1ou C1ou C2ou"}))
    facts = R.fact(changes, "dwd_credit_occupy", None)
    first = L.first_only(facts, "dwd_credit_occupy").collect()
    assert sorted((r.id, r.occupy_time) for r in first) == [(101, TR.at(3)), (102, TR.at(5))]
