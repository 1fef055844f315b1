"""Lifecycle facts in arrival order: what a live run emits, from a stored log.

Stage one reads the log of one facility, stage two that of one credit. Both are
running "latest value" columns over (key, order), one exchange each, and every
fact is a row-local condition on them:

* an outcome fact comes at its status row if the context is complete by then,
  otherwise at the row that completes it, from the latest waiting status row;
* a credit fact comes at its credit row if both amounts are known, otherwise it
  waits (the latest waiting one per fact wins) for the next facility or reply row
  that finds a facility and a reply amount;
* a sign or start fact comes at its contract row once a produced contract is
  known, otherwise at the first produced contract.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leaseflow import schemas as S
from leaseflow.operators import lifecycle as L
from leaseflow.operators.skew import HOT_ROWS, Last, Scan, scan_by_key

FACILITY, STATUS, REPLY, CREDIT = "facility", "status", "reply", "credit"
KEY, ORDER = "credit_facility_id", "seq"

# Table name -> change rows with ``op`` and ``seq``.
Changes = Mapping[str, DataFrame]

AUDIT_FACTS = list(L.OUTCOME_STATUS)
CREDIT_FACTS = list(L.CREDIT_MILESTONE)
STAGE_ONE_FACTS = AUDIT_FACTS + CREDIT_FACTS
STAGE_TWO_FACTS = list(L.CONTRACT_MILESTONE)


# --- stage one: facility log ---------------------------------------------------

def _image(table: str, *leave_out: str) -> Column:
    return F.struct(*[F.col(c) for c, _ in S.RAW[table] if c not in leave_out])


def facility_log(changes: Changes, kinds: tuple[str, ...] = (
        FACILITY, STATUS, REPLY, CREDIT), keep: tuple[str, ...] = ()) -> DataFrame:
    """Change rows of the four facility tables as one keyed, ordered log.

    Every input has ``op`` and ``seq`` next to its table's columns, and what ``keep``
    names. Rows without a key are left out rather than merged under a shared one;
    :func:`keyless_rows` counts them.
    """
    parts = {
        FACILITY: ("credit_facility", F.col("id")),
        STATUS: ("credit_facility_status", F.col(KEY)),
        REPLY: ("reply", F.col(KEY)),
        CREDIT: ("credit", F.col(KEY)),
    }
    logs = []
    for kind in kinds:
        table, key = parts[kind]
        leave_out = ("id",) if kind == FACILITY else (KEY,)
        if kind == STATUS:
            leave_out += ("id",)
        logs.append(changes[table].select(
            key.alias(KEY), ORDER, *keep, F.lit(kind).alias("kind"), "op",
            _image(table, *leave_out).alias(kind)))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)
    return united.filter(F.col(KEY).isNotNull())


# Key column of each lifecycle table's log.
LOG_KEY = {"credit_facility": "id", "credit_facility_status": KEY, "reply": KEY, "credit": KEY,
           "contract": "credit_id"}


def keyless_rows(changes: Changes) -> DataFrame:
    """(table_name, row_count) of the rows that no log can take because they lack its key."""
    parts = [rows.filter(F.col(LOG_KEY[table]).isNull()).agg(F.count("*").alias("row_count"))
             .select(F.lit(table).alias("table_name"), "row_count")
             for table, rows in changes.items()]
    return reduce(DataFrame.unionByName, parts)


def _status_is(*codes: int) -> Column:
    return F.col("status.status").isin(*codes)


def _seen(value: Column) -> Column:
    """TRUE on rows that have the value, NULL on the others."""
    return F.when(value.isNotNull(), F.lit(True))


def _present(kind: str, column: str) -> Column:
    """A column of rows of one kind, wrapped so that a NULL value still counts as a row."""
    return F.when(F.col(kind).isNotNull(), F.struct(f"{kind}.{column}"))


def audit_state(log: DataFrame, scan: Scan) -> DataFrame:
    """Running context and waiting outcome per facility."""
    auditor = F.when(_status_is(*L.AUDITOR_STATUSES), F.col("status.employee_id"))
    values = {
        "fi": Last(F.col(FACILITY)), "rp": Last(F.col(REPLY)), "au": Last(auditor),
        "had_fi": Last(_seen(F.col(FACILITY)), before=True),
        "had_rp": Last(_seen(F.col(REPLY)), before=True),
        "had_au": Last(_seen(auditor), before=True),
    }
    for fact, code in L.OUTCOME_STATUS.items():
        values[f"at_{fact}"] = Last(F.when(_status_is(code), F.struct("status.create_time")))
    return scan(log, values)


def credit_state(log: DataFrame, scan: Scan) -> DataFrame:
    """Running amounts, then the waiting credit event per fact and facility."""
    known = scan(log, {
        "cfi": Last(_present(FACILITY, "credit_amount")),
        "crp": Last(_present(REPLY, "credit_amount")),
    })
    reply_amount, apply_amount = F.col("crp.credit_amount"), F.col("cfi.credit_amount")
    both = apply_amount.isNotNull() & reply_amount.isNotNull()
    flush = (F.col("kind").isin(FACILITY, REPLY)
             & F.col("cfi").isNotNull() & reply_amount.isNotNull())
    known = known.withColumn("at_once", both).withColumn("flush", flush)
    values = {"flushed": Last(F.when(F.col("flush"), F.col(ORDER)), before=True)}
    for fact in CREDIT_FACTS:
        waits = _is_event(fact) & ~F.col("at_once")
        values[f"wait_{fact}"] = Last(
            F.when(waits, F.struct(ORDER, CREDIT)), before=True)
    return scan(known, values)


def _is_event(fact: str) -> Column:
    """Credit row that is an event of this fact."""
    if fact == "dwd_credit_add":
        return (F.col("kind") == CREDIT) & F.col("op").isin(*L.INSERT_OPS)
    return (F.col("kind") == CREDIT) & F.col(f"{CREDIT}.{L.CREDIT_MILESTONE[fact][0]}").isNotNull()


def emits(fact: str) -> Column:
    """Whether a row with running state emits this fact."""
    if fact in AUDIT_FACTS:
        pending = F.col(f"at_{fact}").isNotNull()
        trigger = F.coalesce(_status_is(L.OUTCOME_STATUS[fact]), F.lit(False))
        ready, was_ready = F.col("fi").isNotNull(), F.col("had_fi").isNotNull()
        if fact == "dwd_audit_approve":
            ready = ready & F.col("rp").isNotNull() & F.col("au").isNotNull()
            was_ready = was_ready & F.col("had_rp").isNotNull() & F.col("had_au").isNotNull()
        return ready & pending & (trigger | ~was_ready)
    waiting = F.col(f"wait_{fact}.{ORDER}")
    late = F.col("flush") & waiting.isNotNull() & (
        F.col("flushed").isNull() | (waiting > F.col("flushed")))
    return (_is_event(fact) & F.col("at_once")) | late


def emitted(fact: str) -> list[Column]:
    """The fact's columns on a row that emits it."""
    if fact in AUDIT_FACTS:
        named = {
            "id": F.col(KEY), S.FACT_TIME[fact]: F.col(f"at_{fact}.create_time"),
            "audit_man_id": F.col("au"), "apply_amount": F.col("fi.credit_amount"),
            **{c: F.col(f"fi.{c}") for c in L.FACILITY_COLUMNS},
        }
        if fact == "dwd_audit_approve":
            named |= {
                "reply_id": F.col("rp.id"), "reply_amount": F.col("rp.credit_amount"),
                "reply_time": F.col("rp.create_time"), "irr": F.col("rp.irr"),
                "period": F.col("rp.period"),
            }
    else:
        own = F.col("kind") == CREDIT
        image = lambda c: F.when(own, F.col(f"{CREDIT}.{c}")).otherwise(
            F.col(f"wait_{fact}.{CREDIT}.{c}"))
        milestone, ids = L.CREDIT_MILESTONE[fact]
        named = {
            **{new: F.coalesce(image(old), F.lit(0).cast("bigint")) for new, old in ids.items()},
            S.FACT_TIME[fact]: image(milestone), "credit_amount": image("credit_amount"),
            "credit_facility_id": F.col(KEY),
            "apply_amount": F.col("cfi.credit_amount"),
            "reply_amount": F.col("crp.credit_amount"),
        }
    return [named[c].cast(S.FACTS[fact][c].dataType).alias(c) for c in S.FACTS[fact].names]


def stage_one_fact(changes: Changes, fact: str, limit: int | None = HOT_ROWS,
                   keep_order: bool = False) -> DataFrame:
    """One fact, reading only the tables it depends on.

    ``keep_order`` adds ``seq`` of the row that emitted it (stage two needs it).
    """
    audit = fact in AUDIT_FACTS
    kinds = (FACILITY, STATUS, REPLY) if audit else (FACILITY, REPLY, CREDIT)
    if audit and fact != "dwd_audit_approve":
        kinds = (FACILITY, STATUS)
    log = facility_log(changes, kinds)
    if REPLY not in kinds:
        log = log.withColumn(REPLY, F.lit(None).cast("struct<id:bigint>"))
    state = audit_state if audit else credit_state
    order = [F.col(ORDER)] if keep_order else []

    def step(part: DataFrame, scan: Scan) -> DataFrame:
        return state(part, scan).filter(emits(fact)).select(*emitted(fact), *order)

    return scan_by_key(log, KEY, ORDER, step, limit)


def tagged(rows: DataFrame, facts: list[str], condition: Callable[[str], Column],
           columns: Callable[[str], list[Column]], keep: tuple[str, ...]) -> DataFrame:
    """What rows emit: kept columns, ``fact_type`` and one struct a fact."""
    each = F.array(*[
        F.when(condition(fact), F.struct(
            F.lit(fact).alias("fact_type"),
            *[(F.struct(*columns(other)) if other == fact
               else F.lit(None).cast(S.FACTS[other])).alias(other)
              for other in facts]))
        for fact in facts
    ])
    # Nulls go after the explode: a filter of the array is not compiled, nor is what it filters.
    return rows.select(*keep, F.explode(each).alias("_r")).filter(F.col("_r").isNotNull()).select(
        *keep, "_r.*")


def tagged_facts(changes: Changes, limit: int | None = HOT_ROWS,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """All six stage-one facts in one pass: ``fact_type``, ``seq`` and one struct per fact.

    ``keep`` names columns of the inputs to take along from the row that emits.
    """
    def step(part: DataFrame, scan: Scan) -> DataFrame:
        state = credit_state(audit_state(part, scan), scan)
        return tagged(state, STAGE_ONE_FACTS, emits, emitted, (ORDER, *keep))

    return scan_by_key(facility_log(changes, keep=keep), KEY, ORDER, step, limit)


def of_type(tagged: DataFrame, fact: str, keep_order: bool = False) -> DataFrame:
    """One fact out of the tagged output."""
    order = [ORDER] if keep_order else []
    return tagged.filter(F.col("fact_type") == fact).select(f"{fact}.*", *order)


# --- stage two: credit log -------------------------------------------------------

PRODUCE, CONTRACT = "produce", "contract"


def credit_log(produce: DataFrame, contract: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Produced-contract facts (with ``seq``) and contract changes, keyed by credit."""
    carried = F.struct(*L.PRODUCE_CARRIED)
    made = produce.select("credit_id", ORDER, *keep, carried.alias(PRODUCE))
    rows = contract.select("credit_id", ORDER, *keep,
                           F.struct("id", *L.CONTRACT_MILESTONE.values()).alias(CONTRACT))
    united = made.unionByName(rows, allowMissingColumns=True)
    return united.filter(F.col("credit_id").isNotNull())


def contract_state(log: DataFrame, scan: Scan, strict_parity: bool = False) -> DataFrame:
    """Running produced contract and waiting contract rows per credit.

    ``strict_parity`` keeps an odd rule of the original behaviour: a produced
    contract that releases a waiting sign *and* a waiting start is itself not
    remembered, so later contract rows wait for the next one.
    """
    is_produce = F.col(PRODUCE).isNotNull()
    waits = {
        fact: F.when(F.col(f"{CONTRACT}.{milestone}").isNotNull(),
                     F.struct(ORDER, CONTRACT))
        for fact, milestone in L.CONTRACT_MILESTONE.items()
    }
    state = scan(log, {
        "made": Last(F.col(PRODUCE), before=True),
        "made_at": Last(F.when(is_produce, F.col(ORDER)), before=True),
        **{f"wait_{fact}": Last(value, before=True) for fact, value in waits.items()},
    })
    fresh = {
        fact: F.col(f"wait_{fact}").isNotNull() & (
            F.col("made_at").isNull() | (F.col(f"wait_{fact}.{ORDER}") > F.col("made_at")))
        for fact in waits
    }
    stores = is_produce
    if strict_parity:
        stores = is_produce & ~reduce(lambda a, b: a & b, fresh.values())
    state = scan(state, {"stored": Last(F.when(stores, F.lit(True)), before=True)})
    stored = F.coalesce(F.col("stored"), F.lit(False))
    for fact, milestone in L.CONTRACT_MILESTONE.items():
        at_once = F.col(f"{CONTRACT}.{milestone}").isNotNull() & stored
        late = is_produce & ~stored & fresh[fact]
        state = state.withColumn(f"emits_{fact}", F.coalesce(at_once | late, F.lit(False)))
    return state


def contract_emitted(fact: str) -> list[Column]:
    """The columns of a signed or started lease on a row that emits it."""
    own = F.col(CONTRACT).isNotNull()
    image = lambda c: F.when(own, F.col(f"{CONTRACT}.{c}")).otherwise(
        F.col(f"wait_{fact}.{CONTRACT}.{c}"))
    carried = lambda c: F.when(own, F.col(f"made.{c}")).otherwise(F.col(f"{PRODUCE}.{c}"))
    named = {"id": image("id"), S.FACT_TIME[fact]: image(L.CONTRACT_MILESTONE[fact]),
             "credit_id": F.col("credit_id"), **{c: carried(c) for c in L.PRODUCE_CARRIED}}
    return [named[c].cast(S.FACTS[fact][c].dataType).alias(c) for c in S.FACTS[fact].names]


def emits_lease(fact: str) -> Column:
    """Whether a row with the running state of a credit emits this fact."""
    return F.col(f"emits_{fact}")


def stage_two_fact(produce: DataFrame, contract: DataFrame, fact: str,
                   strict_parity: bool = False, limit: int | None = HOT_ROWS,
                   census: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Signed or started lease facts in arrival order."""
    def step(part: DataFrame, scan: Scan) -> DataFrame:
        state = contract_state(part, scan, strict_parity).filter(emits_lease(fact))
        return state.select(*contract_emitted(fact), *keep)

    return scan_by_key(credit_log(produce, contract, keep), "credit_id", ORDER, step, limit, census)


def produce_bound(changes: Changes) -> DataFrame:
    """Rows that bound the stage-two log per credit: a change of a credit makes at most
    one produced-contract fact, and counting changes is cheaper than making the facts."""
    made = changes["credit"].filter(F.col("contract_produce_time").isNotNull())
    return made.select(F.col("id").alias("credit_id")).unionByName(
        changes["contract"].select("credit_id"))


def fact(changes: Changes, name: str, limit: int | None = HOT_ROWS,
         strict_parity: bool = False) -> DataFrame:
    """Any of the eight facts in arrival order."""
    if name in STAGE_ONE_FACTS:
        return stage_one_fact(changes, name, limit)
    produce = stage_one_fact(changes, "dwd_lease_contract_produce", limit, keep_order=True)
    return stage_two_fact(produce, changes["contract"], name, strict_parity, limit,
                          produce_bound(changes))
