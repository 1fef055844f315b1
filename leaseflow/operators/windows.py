"""Ten-second event-time window tables: one recipe, eleven specifications."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from leaseflow import schemas as S
from leaseflow.functions.fields import row_count
from leaseflow.operators import enrich as E

# Window length and tolerated disorder.
WINDOW = "10 seconds"
DISORDER = "5 seconds"
# Where rows without a readable time go if they are kept at all: epoch zero.
EPOCH_ZERO = "timestamp_ntz'1970-01-01 08:00:00'"

BOUNDS = ["stt", "edt", "cur_date"]


@dataclass(frozen=True)
class WindowSpec:
    """What distinguishes one window table from the others."""

    fact: str
    amounts: list[str]
    keys: list[str] = field(default_factory=list)
    enrichment: str | None = None  # None, "path" or "auditor"

    @property
    def required(self) -> list[str]:
        """Keys that must be present: an unnamed auditor forms no group."""
        return ["audit_man_id"] if self.enrichment == "auditor" else []

    @property
    def fact_columns(self) -> list[str]:
        """Columns of the fact that are read."""
        return [S.FACT_TIME[self.fact], *self.keys, *self.amounts]

    @property
    def columns(self) -> list[str]:
        return BOUNDS + _DIMENSION_COLUMNS[self.enrichment] + ["apply_count"] + self.amounts

    @property
    def table_key(self) -> list[str]:
        """Columns under which a re-sent row replaces the stored one."""
        return BOUNDS + _DIMENSION_COLUMNS[self.enrichment]


_DIMENSION_COLUMNS = {
    None: [],
    "auditor": ["audit_man_id", "audit_man_name"],
    "path": [
        "industry1_id", "industry1_name", "industry2_id", "industry2_name",
        "industry3_id", "industry3_name", "lease_organization",
        "salesman_id", "salesman_name",
        "department1_id", "department1_name", "department2_id", "department2_name",
        "department3_id", "department3_name",
    ],
}

_PATH_KEYS = ["lease_organization", "industry_id", "salesman_id"]
_APPLY = ["apply_amount"]
_REPLY = ["apply_amount", "reply_amount"]
_CREDIT = ["apply_amount", "reply_amount", "credit_amount"]

SPECS: dict[str, WindowSpec] = {
    "dws_audit_industry_lease_organization_salesman_approval_win":
        WindowSpec("dwd_audit_approve", _REPLY, _PATH_KEYS, "path"),
    "dws_audit_industry_lease_organization_salesman_cancel_win":
        WindowSpec("dwd_audit_cancel", _APPLY, _PATH_KEYS, "path"),
    "dws_audit_industry_lease_organization_salesman_reject_win":
        WindowSpec("dwd_audit_reject", _APPLY, _PATH_KEYS, "path"),
    "dws_audit_audit_man_approval_win":
        WindowSpec("dwd_audit_approve", _REPLY, ["audit_man_id"], "auditor"),
    "dws_audit_audit_man_cancel_win":
        WindowSpec("dwd_audit_cancel", _APPLY, ["audit_man_id"], "auditor"),
    "dws_audit_audit_man_reject_win":
        WindowSpec("dwd_audit_reject", _APPLY, ["audit_man_id"], "auditor"),
    "dws_credit_credit_add_win": WindowSpec("dwd_credit_add", _CREDIT),
    "dws_credit_credit_occupy_win": WindowSpec("dwd_credit_occupy", _CREDIT),
    "dws_lease_contract_produce_win": WindowSpec("dwd_lease_contract_produce", _CREDIT),
    "dws_lease_sign_win": WindowSpec("dwd_lease_sign", _CREDIT),
    "dws_lease_execution_win": WindowSpec("dwd_lease_execution", _CREDIT),
}


def measured_rows(facts: DataFrame, spec: WindowSpec, epoch0: bool = False) -> DataFrame:
    """Facts cut down to event time (``ts``), group keys and amounts.

    Rows without event time are dropped, or put into the window of epoch zero.
    """
    time = F.col(S.FACT_TIME[spec.fact])
    rows = facts.select(time.alias("ts"), *spec.keys, *spec.amounts)
    rows = (rows.withColumn("ts", F.coalesce("ts", F.expr(EPOCH_ZERO))) if epoch0
            else rows.filter(F.col("ts").isNotNull()))
    for key in spec.required:
        rows = rows.filter(F.col(key).isNotNull())
    return rows


def missing_time_count(facts: DataFrame, spec: WindowSpec) -> DataFrame:
    """How many facts have no event time (those the default drops)."""
    return facts.filter(F.col(S.FACT_TIME[spec.fact]).isNull()).agg(
        row_count().alias("missing_time"))


def aggregate(rows: DataFrame, spec: WindowSpec) -> DataFrame:
    """Tumbling-window count and sums; keyed or global alike combine map-side."""
    return rows.groupBy(F.window("ts", WINDOW).alias("_w"), *spec.keys).agg(
        row_count().alias("apply_count"),
        *[F.sum(a).cast(S.MONEY).alias(a) for a in spec.amounts])


def with_bounds(grouped: DataFrame) -> DataFrame:
    """Window start, end and day."""
    return (grouped.withColumn("stt", F.col("_w.start")).withColumn("edt", F.col("_w.end"))
            .withColumn("cur_date", F.to_date(F.col("_w.start"))).drop("_w"))


def enrich(grouped: DataFrame, spec: WindowSpec, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Dimension columns, looked up after aggregation (groups, not facts)."""
    if spec.enrichment == "path":
        grouped = E.with_industry(grouped, dims["industry"], "pointer")
        grouped = E.with_salesman(grouped, dims["employee"], dims["department"], "pointer")
    elif spec.enrichment == "auditor":
        grouped = E.with_employee_name(grouped, dims["employee"], "audit_man_id",
                                       "audit_man_name")
    return grouped.select(*spec.columns)


def partial_windows(facts: DataFrame, spec: WindowSpec, epoch0: bool = False) -> DataFrame:
    """What some facts add to their windows: bounds, group keys, count and sums."""
    return with_bounds(aggregate(measured_rows(facts, spec, epoch0), spec))


def summed_windows(partials: DataFrame, touched: DataFrame, spec: WindowSpec) -> DataFrame:
    """Windows of the touched groups (bounds and keys, each once) from all partial sums."""
    group = [*BOUNDS, *spec.keys]
    names = {c: f"_{c}" for c in group}
    same = [F.col(c) == F.col(names[c]) if c in BOUNDS else F.col(c).eqNullSafe(F.col(names[c]))
            for c in group]
    met = partials.join(touched.select(group).withColumnsRenamed(names), same, "left_semi")
    return met.groupBy(*group).agg(F.sum("apply_count").alias("apply_count"),
                                   *[F.sum(a).cast(S.MONEY).alias(a) for a in spec.amounts])


def window_table(name: str, facts: DataFrame, dims: Mapping[str, DataFrame],
                 epoch0: bool = False) -> DataFrame:
    """One window table from its stored facts (batch: every window is complete)."""
    spec = SPECS[name]
    grouped = with_bounds(aggregate(measured_rows(facts, spec, epoch0), spec))
    return enrich(grouped, spec, dims)
