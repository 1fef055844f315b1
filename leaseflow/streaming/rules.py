"""Lifecycle rules for one key, row by row: the small helper behind the stateful jobs.

``known`` holds what a key has seen (facility, reply, auditor, ...) and, under a fact's
name, what still waits for the rest. Functions change ``known`` and yield facts as
(fact name, values) pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from leaseflow import schemas as S
from leaseflow.operators.lifecycle import (
    AUDITOR_STATUSES, CONTRACT_MILESTONE, CREDIT_MILESTONE, FACILITY_COLUMNS, INSERT_OPS,
    OUTCOME_STATUS, PRODUCE_CARRIED)

Known = dict[str, dict[str, Any]]
Emitted = Iterator[tuple[str, dict[str, Any]]]

FACILITY_FIELDS = [*FACILITY_COLUMNS, "credit_amount"]
REPLY_FIELDS = ["id", "credit_amount", "irr", "period", "create_time"]
CREDIT_FIELDS = ["id", "contract_id", "credit_amount", "create_time", "credit_occupy_time",
                 "contract_produce_time"]
# Columns of a facility row that the rules read, by its kind.
READ = {"facility": FACILITY_FIELDS, "status": ["status", "employee_id", "create_time"],
        "reply": REPLY_FIELDS, "credit": ["op", *CREDIT_FIELDS]}
_FACT_OF_STATUS = {code: fact for fact, code in OUTCOME_STATUS.items()}


def _pick(row: Any, fields: list[str]) -> dict[str, Any]:
    return {f: row[f] for f in fields}


def _credit_events(row: Any) -> list[str]:
    """Facts a credit row is an event of."""
    return [fact for fact, (milestone, _) in CREDIT_MILESTONE.items()
            if (row["op"] in INSERT_OPS if fact == "dwd_credit_add" else row[milestone] is not None)]


def _credit_values(known: Known, fact: str, credit: dict[str, Any]) -> dict[str, Any]:
    milestone, ids = CREDIT_MILESTONE[fact]
    return {
        **{new: credit[old] or 0 for new, old in ids.items()},
        S.FACT_TIME[fact]: credit[milestone], "credit_amount": credit["credit_amount"],
        "apply_amount": known["facility"]["credit_amount"],
        "reply_amount": known["reply"]["credit_amount"],
    }


def _outcomes(known: Known) -> Emitted:
    """Waiting outcomes whose context is complete."""
    if "facility" not in known:
        return
    for fact in OUTCOME_STATUS:
        if fact not in known:
            continue
        approve = fact == "dwd_audit_approve"
        if approve and not ("auditor" in known and "reply" in known):
            continue
        facility = known["facility"]
        values = {
            S.FACT_TIME[fact]: known.pop(fact)["create_time"],
            "apply_amount": facility["credit_amount"],
            "audit_man_id": known.get("auditor", {}).get("employee_id"),
            **_pick(facility, FACILITY_COLUMNS),
        }
        if approve:
            reply = known["reply"]
            values |= {"reply_id": reply["id"], "reply_amount": reply["credit_amount"],
                       "reply_time": reply["create_time"], **_pick(reply, ["irr", "period"])}
        yield fact, values


def _waiting_credits(known: Known) -> Emitted:
    """Waiting credit events, once a facility and a reply amount are known."""
    if "facility" in known and known.get("reply", {}).get("credit_amount") is not None:
        for fact in CREDIT_MILESTONE:
            if fact in known:
                yield fact, _credit_values(known, fact, known.pop(fact))


def facility_row(known: Known, row: Any) -> Emitted:
    """Apply one row of the facility log."""
    kind = row["kind"]
    if kind == "credit":
        amounts = (known.get("facility", {}).get("credit_amount"),
                   known.get("reply", {}).get("credit_amount"))
        for fact in _credit_events(row):
            credit = _pick(row, CREDIT_FIELDS)
            if None in amounts:
                known[fact] = credit
            else:
                yield fact, _credit_values(known, fact, credit)
        return
    if kind == "status":
        status = row["status"]
        if status in AUDITOR_STATUSES:
            if row["employee_id"] is not None:
                known["auditor"] = _pick(row, ["employee_id"])
        elif status in _FACT_OF_STATUS:
            known[_FACT_OF_STATUS[status]] = _pick(row, ["create_time"])
        yield from _outcomes(known)
        return
    known[kind] = _pick(row, FACILITY_FIELDS if kind == "facility" else REPLY_FIELDS)
    yield from _outcomes(known)
    yield from _waiting_credits(known)


def credit_row(known: Known, row: Any, strict_parity: bool = False) -> Emitted:
    """Apply one row of the credit log (produced contracts and contract changes)."""
    if row["kind"] == "produce":
        produce = _pick(row, PRODUCE_CARRIED)
        waiting = [fact for fact in CONTRACT_MILESTONE if fact in known]
        if not (strict_parity and len(waiting) == len(CONTRACT_MILESTONE)):
            known["produce"] = produce
        for fact in waiting:
            yield fact, {**known.pop(fact), **produce}
        return
    for fact, milestone in CONTRACT_MILESTONE.items():
        if row[milestone] is None:
            continue
        contract = {"id": row["id"], S.FACT_TIME[fact]: row[milestone]}
        if "produce" in known:
            yield fact, {**contract, **known["produce"]}
        else:
            known[fact] = contract
