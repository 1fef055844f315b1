"""Summary views over all facts: outcomes at six grains and the credit funnel."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leaseflow.functions.fields import row_count, typed_null
from leaseflow.operators import enrich as E
from leaseflow.operators import lifecycle as L

# Labels of the views, in the order they are listed.
OUTCOMES = {"approve": "dwd_audit_approve", "cancel": "dwd_audit_cancel",
            "reject": "dwd_audit_reject"}
FUNNEL = {"credit_add": "dwd_credit_add", "credit_occupy": "dwd_credit_occupy",
          "contract_produce": "dwd_lease_contract_produce", "lease_sign": "dwd_lease_sign",
          "lease_execution": "dwd_lease_execution"}
SUMS = "decimal(29,2)"

Facts = Mapping[str, DataFrame]


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Rows of all outcomes in one table, and of the funnel in two (see Lifecycle).
ALL_OUTCOMES, CREDITS, CONTRACTS = "outcomes", "credits", "contracts"


def view_inputs(life: L.Lifecycle, view: str) -> dict[str, DataFrame]:
    """What a view reads, each source table passed over once."""
    if view == "mv_ads_credit_transform":
        return {CREDITS: life.credits, CONTRACTS: life.contracts}
    return {ALL_OUTCOMES: life.outcomes(columns_read(view, OUTCOMES["approve"]))}


def outcome_rows(facts: Facts, keys: list[str]) -> DataFrame:
    """``audit_result``, keys and amounts of every outcome, from one table or from three."""
    if ALL_OUTCOMES in facts:
        label = F.lit(None).cast("string")
        for outcome, fact in OUTCOMES.items():
            label = F.when(F.col("status") == L.OUTCOME_STATUS[fact], outcome).otherwise(label)
        return facts[ALL_OUTCOMES].select(label.alias("audit_result"), *keys, "apply_amount",
                                          "reply_amount")
    return union_all([
        facts[fact].select(
            F.lit(outcome).alias("audit_result"), *keys, "apply_amount",
            F.col("reply_amount") if outcome == "approve"
            else typed_null("decimal(19,2)").alias("reply_amount"))
        for outcome, fact in OUTCOMES.items()])


def _by_outcome(facts: Facts, keys: list[str]) -> DataFrame:
    """Counts and sums per outcome and key; without keys each outcome is one row, also
    where it has no facts."""
    rows = outcome_rows(facts, keys)
    if keys:
        return rows.groupBy(*keys, "audit_result").agg(
            row_count().alias("project_count"), F.sum("apply_amount").alias("apply_amount"),
            F.sum("reply_amount").cast(SUMS).alias("reply_amount"))
    return _listed(rows, "audit_result", {o: F.col("audit_result") == o for o in OUTCOMES},
                   ["apply_amount", "reply_amount"])


def _listed(rows: DataFrame, name: str, parts: Mapping[str, Column], amounts: list[str]
            ) -> DataFrame:
    """One row per named part with its count and sums, all from one aggregate row."""
    measures = [F.struct(
        F.lit(part).alias(name), F.count(F.when(inside, 1)).alias("project_count"),
        *[F.sum(F.when(inside, F.col(a))).alias(a) for a in amounts])
        for part, inside in parts.items()]
    return rows.agg(F.array(*measures).alias("_a")).select(F.explode("_a").alias("_r")).select("_r.*")


def _regroup(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Sum finer groups into coarser ones. NULL sums stay NULL."""
    return groups.groupBy(*keys, "audit_result").agg(
        F.sum("project_count").alias("project_count"),
        F.sum("apply_amount").cast(SUMS).alias("apply_amount"),
        F.sum("reply_amount").cast(SUMS).alias("reply_amount"))


def audit_result_summary(facts: Facts, dims: Facts | None = None) -> DataFrame:
    return _by_outcome(facts, [])


def audit_result_org(facts: Facts, dims: Facts | None = None) -> DataFrame:
    return _by_outcome(facts, ["lease_organization"])


def audit_result_dept(facts: Facts, dims: Facts) -> DataFrame:
    """Per department path of the salesman: reduce to salesmen, look up, reduce again."""
    keys = [f"department{n}_{c}" for n in (3, 2, 1) for c in ("id", "name")]
    groups = _by_outcome(facts, ["salesman_id"])
    return _regroup(E.with_salesman(groups, dims["employee"], dims["department"], "joined"), keys)


def audit_result_salesman(facts: Facts, dims: Facts) -> DataFrame:
    groups = _by_outcome(facts, ["salesman_id"])
    return E.with_employee_name(groups, dims["employee"], "salesman_id", "salesman_name").select(
        "salesman_id", "salesman_name", "audit_result", "project_count",
        "apply_amount", "reply_amount")


def audit_result_audit_man(facts: Facts, dims: Facts) -> DataFrame:
    """Per auditor; facts without an auditor form the NULL group."""
    groups = _by_outcome(facts, ["audit_man_id"])
    return E.with_employee_name(groups, dims["employee"], "audit_man_id", "audit_man_name").select(
        "audit_man_id", "audit_man_name", "audit_result", "project_count",
        "apply_amount", "reply_amount")


def audit_result_industry(facts: Facts, dims: Facts) -> DataFrame:
    keys = [f"industry{n}_{c}" for n in (3, 2, 1) for c in ("id", "name")]
    groups = _by_outcome(facts, ["industry_id"])
    return _regroup(E.with_industry(groups, dims["industry"], "joined"), keys)


def credit_transform(facts: Facts, dims: Facts | None = None) -> DataFrame:
    """The funnel: one row per step, also where a step has no facts."""
    amounts = ["apply_amount", "reply_amount", "credit_amount"]
    if CREDITS in facts:
        tables = [(facts[CREDITS], L.CREDIT_MILESTONE), (facts[CONTRACTS], L.CONTRACT_MILESTONE)]
        return union_all([
            _listed(rows, "transform_step",
                    {s: F.col(f) for s, f in FUNNEL.items() if f in made}, amounts)
            for rows, made in tables])
    parts = []
    for step, fact in FUNNEL.items():
        row = facts[fact].agg(
            row_count().alias("project_count"),
            *[F.sum(a).alias(a) for a in amounts])
        parts.append(row.select(F.lit(step).alias("transform_step"), "*"))
    return union_all(parts)


VIEWS = {
    "mv_ads_audit_result_summary": audit_result_summary,
    "mv_ads_audit_result_org": audit_result_org,
    "mv_ads_audit_result_dept": audit_result_dept,
    "mv_ads_audit_result_salesman": audit_result_salesman,
    "mv_ads_audit_result_audit_man": audit_result_audit_man,
    "mv_ads_audit_result_industry": audit_result_industry,
    "mv_ads_credit_transform": credit_transform,
}
# The fact column each outcome view groups by.
VIEW_KEY = {
    "mv_ads_audit_result_org": ["lease_organization"],
    "mv_ads_audit_result_dept": ["salesman_id"],
    "mv_ads_audit_result_salesman": ["salesman_id"],
    "mv_ads_audit_result_audit_man": ["audit_man_id"],
    "mv_ads_audit_result_industry": ["industry_id"],
}


def columns_read(view: str, fact: str) -> list[str]:
    """Columns of a fact that a view reads."""
    amounts = ["apply_amount"]
    if fact not in ("dwd_audit_cancel", "dwd_audit_reject"):
        amounts.append("reply_amount")
    if view == "mv_ads_credit_transform":
        amounts.append("credit_amount")
    return VIEW_KEY.get(view, []) + amounts


def reviewed_projects(facts: Facts) -> DataFrame:
    """Applications reviewed: approved, rejected or cancelled."""
    return audit_result_summary(facts).agg(F.sum("project_count").alias("reviewed_projects"))


def conversion_rates(funnel: DataFrame) -> DataFrame:
    """Each funnel step's count relative to the step before and to the first step.

    The funnel is five rows in one, so the steps are compared as columns of a
    single pivoted row: no window over the whole table.
    """
    steps = list(FUNNEL)
    counts = funnel.agg(*[
        F.max(F.when(F.col("transform_step") == s, F.col("project_count"))).alias(s)
        for s in steps])

    def rate(part, whole):
        return F.round(F.when(whole != 0, part / whole), 6)

    rows = F.array(*[
        F.struct(
            F.lit(n + 1).alias("step_no"), F.lit(s).alias("transform_step"),
            F.col(s).alias("project_count"),
            (rate(F.col(s), F.col(steps[n - 1])) if n else typed_null("double"))
            .alias("rate_of_previous"),
            rate(F.col(s), F.col(steps[0])).alias("rate_of_first"))
        for n, s in enumerate(steps)
    ])
    return counts.select(F.explode(rows).alias("_s")).select("_s.*")
