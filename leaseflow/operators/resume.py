"""Replay that goes on from stored running state, instead of from the whole history of a key.

All that replay knows of a key is the last value of a few columns. At the end of a batch these
are one row a key, and they are all the next batch needs: the state comes in as a row before the
key's first, from which the same last-value scans start. So a batch reads its own changes and the
state of the keys it touches; how long their history is does not matter.

A state row is ordinary input of the scan. A hot key is cut into segments as ever, its state row
is the first row of its first segment, and what its last segment ended with is its new state.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from leaseflow import schemas as S
from leaseflow.operators import replay as R
from leaseflow.operators.skew import HOT_ROWS, SEGMENT, Last, Scan, plain_scan, scan_by_key
from leaseflow.sources.scratch import materialize

STATE = "state"
SEED, KIND_OF_SEED = "_seed", "state"
# Order of a state row: before every change.
FIRST = -(2 ** 63)


class Stage(NamedTuple):
    """One of the two stages: its key, its running columns, its facts, whether a row that has the
    running columns emits a fact and that fact's columns, and which running columns a state row
    need not carry, since others tell them."""

    key: str
    running: Callable[[DataFrame, Scan], DataFrame]
    facts: list[str]
    emits: Callable[[str], Column]
    emitted: Callable[[str], list[Column]]
    told: Mapping[str, Column] = {}


def _seeded(column: str, value: Column) -> Column:
    return F.when(F.col(f"{SEED}.{column}").isNotNull(), value)


def facility_stage() -> Stage:
    told = {
        **{f"had_{c}": _seeded(c, F.lit(True)) for c in ("fi", "rp", "au")},
        **{f"c{c}": _seeded(c, F.struct(f"{SEED}.{c}.credit_amount")) for c in ("fi", "rp")},
    }
    return Stage(R.KEY, lambda log, scan: R.credit_state(R.audit_state(log, scan), scan),
                 R.STAGE_ONE_FACTS, R.emits, R.emitted, told)


def credit_stage(strict_parity: bool = False) -> Stage:
    return Stage("credit_id", partial(R.contract_state, strict_parity=strict_parity),
                 R.STAGE_TWO_FACTS, R.emits_lease, R.contract_emitted)


def _resuming(scan: Scan, seeded: bool, ends: dict[str, str], told: Mapping[str, Column]) -> Scan:
    """The scan, begun from state rows; notes in ``ends`` which columns hold the values that a
    key has after its row."""
    def run(log: DataFrame, values: Mapping[str, Last]) -> DataFrame:
        if seeded:
            values = {n: Last(F.coalesce(told.get(n, F.col(f"{SEED}.{n}")), v.value), v.before)
                      for n, v in values.items()}
        after = {n: f"_after_{n}" for n, v in values.items() if v.before and n not in told}
        ends.update({n: after.get(n, n) for n in values if n not in told})
        return scan(log, {**values, **{column: Last(values[n].value) for n, column in after.items()}})
    return run


def _ended(ends: Mapping[str, str]) -> Column:
    """What a row leaves to its key's next."""
    return F.struct(*[F.col(column).alias(name) for name, column in ends.items()]).alias(STATE)


def _step(part: DataFrame, scan: Scan, stage: Stage, keep: tuple[str, ...], seeded: bool) -> DataFrame:
    ends: dict[str, str] = {}
    rows = stage.running(part, _resuming(scan, seeded, ends, stage.told))
    group = [stage.key, SEGMENT] if SEGMENT in part.columns else [stage.key]
    is_last = F.lead(R.ORDER).over(Window.partitionBy(*group).orderBy(R.ORDER)).isNull()
    # Conditions come first: the many rows that emit and leave nothing make no facts. A column a fact
    # is compiled and read alone, a filter of an array of facts is neither.
    emits = [F.coalesce(stage.emits(f), F.lit(False)) for f in stage.facts]
    rows = rows.withColumn("_last", is_last).filter(reduce(lambda x, y: x | y, emits, F.col("_last")))
    if seeded:
        # A state row emits nothing, and a key that has no other row keeps the state it has.
        rows = rows.filter(F.col(R.ORDER) != FIRST)
    rows = rows.select(
        stage.key, R.ORDER, *keep,
        *[F.when(stage.emits(f), F.struct(*stage.emitted(f))).alias(f) for f in stage.facts],
        F.when(F.col("_last"), _ended(ends)).alias(STATE))
    return rows if len(group) == 1 else _of_last_segment(rows, stage.key)


def _of_last_segment(rows: DataFrame, key: str) -> DataFrame:
    """Only the last of a hot key's segments leaves a state."""
    rows = materialize(rows, "segments")
    last = rows.filter(F.col(STATE).isNotNull()).groupBy(key).agg(F.max(R.ORDER).alias("_end"))
    ended = F.when(F.col(R.ORDER) == F.col("_end"), F.col(STATE)).alias(STATE)
    return rows.join(F.broadcast(last), key, "left").select(
        *[ended if c == STATE else c for c in rows.columns])


def state_type(log: DataFrame, stage: Stage) -> T.DataType:
    """Type of a key's state; nothing runs."""
    ends: dict[str, str] = {}
    rows = stage.running(log, _resuming(plain_scan(stage.key, R.ORDER), False, ends, stage.told))
    return rows.select(_ended(ends)).schema[STATE].dataType


def go_on(log: DataFrame, stage: Stage, states: DataFrame | None = None, keep: tuple[str, ...] = (),
          limit: int | None = HOT_ROWS, multiple: int | None = None) -> DataFrame:
    """Rows (key, ``seq``, kept columns, a struct a fact, ``state``) of a keyed, ordered log.

    ``states`` has one row (key, ``state``) for each key seen before; changes of the log come after
    those that made the state. A fact's struct is null on rows that do not emit it. ``state`` is set
    on the last row of a key, see :func:`new_states`; a key with a state and no change has none. Kept
    columns are null on state rows. ``multiple``: how rows are dealt, see :func:`skew.dealt`.
    """
    if states is not None:
        seeds = states.select(stage.key, F.lit(FIRST).cast("bigint").alias(R.ORDER),
                              F.col(STATE).alias(SEED))
        if "kind" in log.columns:
            seeds = seeds.withColumn("kind", F.lit(KIND_OF_SEED))
        log = log.unionByName(seeds, allowMissingColumns=True)
    return scan_by_key(log, stage.key, R.ORDER,
                       partial(_step, stage=stage, keep=keep, seeded=states is not None), limit,
                       multiple=multiple)


def new_states(rows: DataFrame, stage: Stage) -> DataFrame:
    """State of each key after its log: (key, ``state``)."""
    return rows.filter(F.col(STATE).isNotNull()).select(stage.key, STATE)


def fact_of(rows: DataFrame, fact: str) -> DataFrame:
    """One emitted fact with ``seq``; of stored rows, its columns alone are read."""
    return rows.filter(F.col(fact).isNotNull()).select(f"{fact}.*", R.ORDER)


def facts_of(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The emitted facts, tagged: ``seq``, kept columns, ``fact_type`` and one struct a fact."""
    facts = [f for f in S.FACTS if f in rows.columns]
    return R.tagged(rows, facts, lambda f: F.col(f).isNotNull(),
                    lambda f: [F.col(f"{f}.{c}") for c in S.FACTS[f].names], (R.ORDER, *keep))
