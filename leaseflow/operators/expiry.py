"""Lifecycle facts in arrival order when what a facility has shown is forgotten after a while.

The live form drops every stage-one value (facility, reply, auditor, waiting outcome, waiting
credit) an hour after it was last written, by arrival time. Replay does the same with a
last-value scan whose values carry the time they were written: a value counts only on rows that
arrive less than ``ttl`` later. The carried times are part of the value, so they pass from one
segment of a hot key to the next like any other.

Without expiry a complete context stays complete, so "emit when complete" can look at the row
before. With it, a context may become complete several times; a waiting outcome is released by
the first complete row after it, once. Stage two never expires.

The clock is a number column of every input that never falls along ``seq`` within a key, in the
unit of ``ttl``; rows without it count as never seen and see nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from leaseflow import schemas as S
from leaseflow.operators import lifecycle as L
from leaseflow.operators import replay as R
from leaseflow.operators.skew import HOT_ROWS, Last, Scan, scan_by_key

# Fixed value: how long state is kept, in milliseconds.
HOUR_MS = 3_600_000


def expiring(scan: Scan, clock: str, ttl: int) -> Scan:
    """The same scan, whose values are forgotten ``ttl`` after they were written."""
    def run(log: DataFrame, values: Mapping[str, Last]) -> DataFrame:
        now = F.col(clock)
        timed = {name: Last(F.when(v.value.isNotNull() & now.isNotNull(),
                                   F.struct(now.alias("at"), v.value.alias("value"))), v.before)
                 for name, v in values.items()}
        return scan(log, timed).withColumns({
            name: F.when(now < F.col(f"{name}.at") + ttl, F.col(f"{name}.value")) for name in values})
    return run


def outcome_state(log: DataFrame, fact: str, scan: Scan, clock: str, ttl: int) -> DataFrame:
    """Context still known, the waiting outcome, and the last row before that was complete."""
    auditor = F.when(R._status_is(*L.AUDITOR_STATUSES), F.col("status.employee_id"))
    trigger = F.when(R._status_is(L.OUTCOME_STATUS[fact]), F.struct(R.ORDER, "status.create_time"))
    known = expiring(scan, clock, ttl)(log, {
        "fi": Last(F.col(R.FACILITY)), "rp": Last(F.col(R.REPLY)), "au": Last(auditor),
        f"at_{fact}": Last(trigger)})
    return scan(known.withColumn("ready", _complete(fact)), {
        "released": Last(F.when(F.col("ready"), F.col(R.ORDER)), before=True)})


def _complete(fact: str) -> Column:
    needs = ("fi", "rp", "au") if fact == "dwd_audit_approve" else ("fi",)
    ready = F.lit(True)
    for name in needs:
        ready = ready & F.col(name).isNotNull()
    return ready


def _emits(fact: str) -> Column:
    """Whether a row with expiring state emits this fact."""
    if fact not in R.AUDIT_FACTS:
        return R.emits(fact)
    waiting = F.col(f"at_{fact}.{R.ORDER}")
    return F.col("ready") & waiting.isNotNull() & (
        F.col("released").isNull() | (F.col("released") < waiting))


def stage_one_fact(changes: R.Changes, fact: str, clock: str, ttl: int = HOUR_MS,
                   limit: int | None = HOT_ROWS, keep_order: bool = False) -> DataFrame:
    """One of the six stage-one facts, reading only the tables it depends on."""
    kinds = {"dwd_audit_approve": (R.FACILITY, R.STATUS, R.REPLY)}.get(
        fact, (R.FACILITY, R.STATUS) if fact in R.AUDIT_FACTS else (R.FACILITY, R.REPLY, R.CREDIT))
    log = R.facility_log(changes, kinds, keep=() if clock == R.ORDER else (clock,))
    if R.REPLY not in kinds:
        log = log.withColumn(R.REPLY, F.lit(None).cast("struct<id:bigint>"))
    order = [R.ORDER] if keep_order else []

    def step(part: DataFrame, scan: Scan) -> DataFrame:
        if fact in R.AUDIT_FACTS:
            state = outcome_state(part, fact, scan, clock, ttl)
        else:
            # An expired release is older than any wait still known, so it may be forgotten too.
            state = R.credit_state(part, expiring(scan, clock, ttl))
        return state.filter(_emits(fact)).select(*R.emitted(fact), *order)

    return scan_by_key(log, R.KEY, R.ORDER, step, limit)


def fact(changes: R.Changes, name: str, clock: str, ttl: int = HOUR_MS,
         limit: int | None = HOT_ROWS, strict_parity: bool = False) -> DataFrame:
    """Any of the eight facts; the two of stage two from produced contracts that were in time."""
    if name in R.STAGE_ONE_FACTS:
        return stage_one_fact(changes, name, clock, ttl, limit)
    produce = stage_one_fact(changes, "dwd_lease_contract_produce", clock, ttl, limit, keep_order=True)
    return R.stage_two_fact(produce, changes["contract"], name, strict_parity, limit,
                            R.produce_bound(changes)).select(*S.FACTS[name].names)
