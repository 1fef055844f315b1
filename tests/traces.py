"""Small ordered change logs in a short notation, one facility (or credit) per trace.

Tokens: ``F``/``F0`` facility with/without amount, ``A7`` status 5 by employee 7, ``A``
status 5 without employee, ``R``/``R0`` reply with/without amount, ``S16a`` outcome row
(letter = its time), ``C12+op`` credit 12 with the milestones of ``+`` (o occupy,
p produce) and operation ``r``/``c``/``u``, ``K12se`` contract of credit 12 with sign
and/or start time, ``P12`` a produced contract (stage two only).
"""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

from leaseflow import schemas as S
from leaseflow.sources.changes import TABLE_NUMBER

T0 = dt.datetime(2024, 1, 1)


def at(n: int) -> dt.datetime:
    return T0 + dt.timedelta(seconds=n)


def _row(table: str, **values):
    return {c: values.get(c, 0 if k.endswith("0") else None) for c, k in S.RAW[table]} | {
        "op": values.get("op", "r"), "seq": values["seq"]}


def parse(traces: dict[int, str]) -> dict[str, list[dict]]:
    """Traces by facility key -> change rows per table. ``seq`` is the position."""
    out: dict[str, list[dict]] = {t: [] for t in TABLE_NUMBER}
    for key, text in traces.items():
        for seq, token in enumerate(text.split(), start=1):
            kind, rest = token[0], token[1:]
            amount = None if rest == "0" else Decimal(1000 * key + seq).scaleb(-2)
            if kind == "F":
                out["credit_facility"].append(_row(
                    "credit_facility", id=key, lease_organization=f"org{seq}",
                    business_partner_id=seq, industry_id=seq, salesman_id=seq,
                    credit_amount=amount, seq=seq))
            elif kind == "A":
                out["credit_facility_status"].append(_row(
                    "credit_facility_status", id=seq, credit_facility_id=key, status=5,
                    employee_id=int(rest) if rest else None, create_time=at(seq), seq=seq))
            elif kind == "S":
                out["credit_facility_status"].append(_row(
                    "credit_facility_status", id=seq, credit_facility_id=key,
                    status=int(rest), create_time=at(seq), seq=seq))
            elif kind == "R":
                out["reply"].append(_row(
                    "reply", id=seq, credit_facility_id=key, credit_amount=amount,
                    irr=Decimal("1.25"), period=seq, create_time=at(seq), seq=seq))
            elif kind == "C":
                ident, marks, op = re.fullmatch(r"(\d+)([op]*)([rcu])", rest).groups()
                out["credit"].append(_row(
                    "credit", id=key * 100 + int(ident), credit_facility_id=key,
                    contract_id=key * 1000 + int(ident), credit_amount=Decimal(seq).quantize(Decimal("0.01")),
                    create_time=at(seq), credit_occupy_time=at(seq) if "o" in marks else None,
                    contract_produce_time=at(seq) if "p" in marks else None, op=op, seq=seq))
            elif kind == "K":
                ident, marks = re.fullmatch(r"(\d+)([se]*)", rest).groups()
                out["contract"].append(_row(
                    "contract", id=key * 1000 + int(ident), credit_id=key * 100 + int(ident),
                    signed_time=at(seq) if "s" in marks else None,
                    execution_time=at(seq) if "e" in marks else None, seq=seq))
            else:
                raise ValueError(token)
    return out


def frames(spark, rows: dict[str, list[dict]]):
    """Change rows -> DataFrames shaped like ``derived.replay_tables``."""
    result = {}
    for table, records in rows.items():
        schema = S.T.StructType([*S.raw_schema(table).fields,
                                 S.T.StructField("op", S.T.StringType()),
                                 S.T.StructField("seq", S.T.LongType())])
        result[table] = spark.createDataFrame(
            [tuple(r[f] for f in schema.names) for r in records], schema)
    return result


class Forgetful(dict):
    """What a key has seen, each entry with the moment it was written."""

    def __init__(self):
        super().__init__()
        self.now, self.written = 0, {}

    def __setitem__(self, name, value):
        super().__setitem__(name, value)
        self.written[name] = self.now

    def advance(self, now: int, ttl: int | None) -> None:
        self.now = now
        for name in [n for n in self if ttl is not None and now >= self.written[n] + ttl]:
            del self[name]


def run_rules(rows: dict[str, list[dict]], strict_parity: bool = False,
              ttl: int | None = None) -> dict[str, list[tuple]]:
    """The row-by-row rules over the same changes, both stages; ``ttl`` in units of ``seq``."""
    from leaseflow.streaming import rules

    kinds = {"credit_facility": ("facility", "id"), "credit_facility_status":
             ("status", "credit_facility_id"), "reply": ("reply", "credit_facility_id"),
             "credit": ("credit", "credit_facility_id")}
    logs: dict[int, list[dict]] = {}
    for table, (kind, key) in kinds.items():
        for r in rows[table]:
            logs.setdefault(r[key], []).append({**r, "kind": kind})
    facts: dict[str, list[tuple]] = {f: [] for f in S.FACTS}
    second: dict[int, list[dict]] = {}

    def keep(fact: str, values: dict) -> None:
        facts[fact].append(tuple(values[c] for c in S.FACTS[fact].names))

    for key, log in logs.items():
        known = Forgetful()
        for row in sorted(log, key=lambda r: r["seq"]):
            known.advance(row["seq"], ttl)
            for fact, values in rules.facility_row(known, row):
                name = "id" if fact.startswith("dwd_audit") else "credit_facility_id"
                values = {name: key, **values}
                keep(fact, values)
                if fact == "dwd_lease_contract_produce":
                    second.setdefault(values["credit_id"], []).append(
                        {**values, "kind": "produce", "seq": row["seq"]})
    for r in rows["contract"]:
        second.setdefault(r["credit_id"], []).append({**r, "kind": "contract"})
    for credit, log in second.items():
        known = {}
        for row in sorted(log, key=lambda r: r["seq"]):
            for fact, values in rules.credit_row(known, row, strict_parity):
                keep(fact, {"credit_id": credit, **values})
    return facts


def canonical(rows) -> list[tuple]:
    return sorted(tuple(str(v) for v in r) for r in rows)
