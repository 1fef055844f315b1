"""Lifecycle facts from the current images of the raw tables (set form).

Here arrival order plays no part: each trigger row meets the latest context of
its facility. :mod:`leaseflow.operators.replay` is the order-exact form.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from leaseflow import schemas as S
from leaseflow.operators.skew import HOT_ROWS, join_many_to_one

# Status codes of the status log and operation letters of an insert.
APPROVED, REJECTED, CANCELLED = 16, 20, 21
AUDITOR_STATUSES = (4, 5, 6)
INSERT_OPS = ("r", "c")

OUTCOME_STATUS = {"dwd_audit_approve": APPROVED, "dwd_audit_reject": REJECTED,
                  "dwd_audit_cancel": CANCELLED}
FACILITY_COLUMNS = ["lease_organization", "business_partner_id", "industry_id", "salesman_id"]

Raw = Mapping[str, DataFrame]


def auditor_of_facility(status: DataFrame) -> DataFrame:
    """Latest named auditor per facility."""
    named = status.filter(F.col("status").isin(*AUDITOR_STATUSES)
                          & F.col("employee_id").isNotNull())
    return named.groupBy("credit_facility_id").agg(
        F.max_by("employee_id", F.struct("create_time", "id")).alias("audit_man_id"))


def facility_context(facility: DataFrame) -> DataFrame:
    """Facility image under the names facts use."""
    return facility.select(
        F.col("id").alias("credit_facility_id"), *FACILITY_COLUMNS,
        F.col("credit_amount").alias("apply_amount"))


def reply_context(reply: DataFrame) -> DataFrame:
    """Latest reply per facility under the names facts use."""
    image = F.struct(F.col("id").alias("reply_id"), F.col("credit_amount").alias("reply_amount"),
                     F.col("create_time").alias("reply_time"), "irr", "period")
    latest = reply.groupBy("credit_facility_id").agg(
        F.max_by(image, F.struct("create_time", "id")).alias("_r"))
    return latest.select("credit_facility_id", "_r.*")


# Fact -> (milestone column of the credit row, id columns of the fact)
CREDIT_MILESTONE: dict[str, tuple[str, dict[str, str]]] = {
    "dwd_credit_add": ("create_time", {"id": "id"}),
    "dwd_credit_occupy": ("credit_occupy_time", {"id": "id"}),
    "dwd_lease_contract_produce": ("contract_produce_time",
                                   {"id": "contract_id", "credit_id": "id"}),
}


def credit_projection(fact: str, path: str = "") -> list[Column]:
    """Columns a credit row contributes to one of its facts."""
    milestone, ids = CREDIT_MILESTONE[fact]
    source = lambda c: F.col(f"{path}.{c}" if path else c)
    renamed = [F.coalesce(source(old), F.lit(0).cast("bigint")).alias(new)
               for new, old in ids.items()]
    return [*renamed, source(milestone).alias(S.FACT_TIME[fact]),
            source("credit_amount").alias("credit_amount")]


CONTRACT_MILESTONE = {"dwd_lease_sign": "signed_time", "dwd_lease_execution": "execution_time"}
PRODUCE_CARRIED = ["credit_facility_id", "apply_amount", "reply_amount", "credit_amount"]


class Lifecycle:
    """The eight facts of one set of raw tables.

    Contexts and the produced-contract fact are defined once and shared, so facts
    read together repeat neither their definition nor (by exchange reuse) their work.
    ``limit`` is the number of rows from which a key counts as hot; None switches the
    handling of hot keys off.
    """

    def __init__(self, raw: Raw, limit: int | None = HOT_ROWS):
        self.raw, self.limit = raw, limit

    @cached_property
    def _facility(self) -> DataFrame:
        return facility_context(self.raw["credit_facility"])

    @cached_property
    def _auditor(self) -> DataFrame:
        return auditor_of_facility(self.raw["credit_facility_status"])

    @cached_property
    def _reply(self) -> DataFrame:
        return reply_context(self.raw["reply"])

    @cached_property
    def _amounts(self) -> DataFrame:
        """Facilities whose apply and reply amounts are both known."""
        return (
            self._facility.select("credit_facility_id", "apply_amount")
            .join(self._reply.select("credit_facility_id", "reply_amount"), "credit_facility_id")
            .filter(F.col("apply_amount").isNotNull() & F.col("reply_amount").isNotNull())
        )

    @cached_property
    def _produce(self) -> DataFrame:
        return self._credit_fact("dwd_lease_contract_produce")

    @cached_property
    def _latest_produce(self) -> DataFrame:
        """Amounts of the latest produced-contract fact per credit."""
        return self._produce.groupBy("credit_id").agg(
            F.max_by(F.struct(*PRODUCE_CARRIED), F.struct("produced_time", "id")).alias("_p"))

    def _audit_fact(self, fact: str, columns: list[str]) -> DataFrame:
        """One fact per status row with that outcome. Approvals need an auditor and a
        reply; the optional auditor of the others is looked up only if it is read."""
        status = self.raw["credit_facility_status"]
        triggers = status.filter(F.col("status") == OUTCOME_STATUS[fact]).select(
            "credit_facility_id", F.col("create_time").alias(S.FACT_TIME[fact]))
        context = self._facility
        if fact == "dwd_audit_approve":
            context = (context.join(self._auditor, "credit_facility_id")
                       .join(self._reply, "credit_facility_id"))
        elif "audit_man_id" in columns:
            context = context.join(self._auditor, "credit_facility_id", "left")
        rows = join_many_to_one(triggers, context, "credit_facility_id", self.limit)
        return rows.withColumnRenamed("credit_facility_id", "id")

    def _credit_fact(self, fact: str) -> DataFrame:
        """One fact per credit row of a facility with both amounts known.

        A batch table holds each credit once, so the insert-only rule of the new-credit
        fact is met by construction; where ``op`` is present it is applied.
        """
        credit = self.raw["credit"]
        if fact != "dwd_credit_add":
            credit = credit.filter(F.col(CREDIT_MILESTONE[fact][0]).isNotNull())
        elif "op" in credit.columns:
            credit = credit.filter(F.col("op").isin(*INSERT_OPS))
        triggers = credit.select("credit_facility_id", *credit_projection(fact))
        return join_many_to_one(triggers, self._amounts, "credit_facility_id", self.limit)

    def _contract_fact(self, fact: str) -> DataFrame:
        """One fact per contract row with that time set and a produced contract."""
        milestone = CONTRACT_MILESTONE[fact]
        triggers = self.raw["contract"].filter(F.col(milestone).isNotNull()).select(
            "id", "credit_id", F.col(milestone).alias(S.FACT_TIME[fact]))
        joined = join_many_to_one(triggers, self._latest_produce, "credit_id", self.limit)
        return joined.select("id", S.FACT_TIME[fact], "credit_id", "_p.*")

    def outcomes(self, columns: list[str]) -> DataFrame:
        """All three outcome facts in one pass over the status log: ``status`` and the
        given columns. Reply columns are NULL unless approved."""
        status = self.raw["credit_facility_status"]
        triggers = status.filter(F.col("status").isin(*OUTCOME_STATUS.values())).select(
            "credit_facility_id", "status")
        reply = self._reply.select("credit_facility_id", "reply_amount",
                                   F.lit(True).alias("_replied"))
        context = (self._facility.join(self._auditor, "credit_facility_id", "left")
                   .join(reply, "credit_facility_id", "left"))
        rows = join_many_to_one(triggers, context, "credit_facility_id", self.limit)
        approved = F.col("status") == APPROVED
        complete = F.col("audit_man_id").isNotNull() & F.col("_replied").isNotNull()
        return rows.filter(~approved | complete).withColumn(
            "reply_amount", F.when(approved, F.col("reply_amount"))).select("status", *columns)

    @cached_property
    def credits(self) -> DataFrame:
        """Credit rows of facilities with both amounts known, in one pass: the amounts and,
        per credit fact, whether the row makes it."""
        credit = self.raw["credit"]
        inserted = F.col("op").isin(*INSERT_OPS) if "op" in credit.columns else F.lit(True)
        made = {f: inserted if f == "dwd_credit_add" else F.col(milestone).isNotNull()
                for f, (milestone, _) in CREDIT_MILESTONE.items()}
        rows = credit.select("id", "credit_facility_id", "credit_amount", "contract_id",
                             "contract_produce_time", *[m.alias(f) for f, m in made.items()])
        return join_many_to_one(rows, self._amounts, "credit_facility_id", self.limit)

    @cached_property
    def contracts(self) -> DataFrame:
        """Contract rows with a produced contract, in one pass: its amounts and, per contract
        fact, whether the row makes it."""
        produced = self.credits.filter("dwd_lease_contract_produce").groupBy(
            F.col("id").alias("credit_id")).agg(F.max_by(
                F.struct(*PRODUCE_CARRIED),
                F.struct("contract_produce_time", F.coalesce("contract_id", F.lit(0)))).alias("_p"))
        rows = self.raw["contract"].select("credit_id", *[
            F.col(milestone).isNotNull().alias(f) for f, milestone in CONTRACT_MILESTONE.items()])
        return join_many_to_one(rows, produced, "credit_id", self.limit).select(
            *CONTRACT_MILESTONE, "_p.*")

    def fact(self, name: str, columns: list[str] | None = None) -> DataFrame:
        """One fact; ``columns`` restricts it to what the caller reads."""
        columns = columns or S.FACTS[name].names
        if name in OUTCOME_STATUS:
            rows = self._audit_fact(name, columns)
        elif name == "dwd_lease_contract_produce":
            rows = self._produce
        elif name in CREDIT_MILESTONE:
            rows = self._credit_fact(name)
        else:
            rows = self._contract_fact(name)
        return rows.select(*columns)


def fact(raw: Raw, name: str, limit: int | None = HOT_ROWS,
         columns: list[str] | None = None) -> DataFrame:
    """A single fact from its raw tables."""
    return Lifecycle(raw, limit).fact(name, columns)


def first_only(facts: DataFrame, name: str) -> DataFrame:
    """First fact per id, for users who do not want re-emitted facts counted."""
    others = [c for c in S.FACTS[name].names if c != "id"]
    kept = facts.groupBy("id").agg(F.min(F.struct(*others)).alias("_f"))
    return kept.select("id", "_f.*").select(*S.FACTS[name].names)
