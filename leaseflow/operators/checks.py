"""Reconciliation checks over the stored layers. Each returns all compared rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from leaseflow.functions.fields import row_count, typed_null
from leaseflow.operators import enrich as E
from leaseflow.operators import summaries as M

Facts = Mapping[str, DataFrame]


def funnel_monotone(funnel: DataFrame) -> DataFrame:
    """Each step must not have more projects than the step before it."""
    steps = list(M.FUNNEL)
    counts = funnel.agg(*[
        F.max(F.when(F.col("transform_step") == s, F.col("project_count"))).alias(s)
        for s in steps])
    rows = F.array(*[
        F.struct(F.lit(s).alias("transform_step"), F.col(s).alias("project_count"),
                 (F.col(steps[n - 1]) if n else typed_null("bigint")).alias("previous_count"),
                 (F.col(s) <= F.col(steps[n - 1]) if n else F.lit(True)).alias("holds"))
        for n, s in enumerate(steps)
    ])
    return counts.select(F.explode(rows).alias("_s")).select("_s.*")


def _totals(rows: DataFrame, prefix: str) -> DataFrame:
    return rows.groupBy("audit_result").agg(
        F.sum("project_count").alias(f"{prefix}_count"),
        F.sum("apply_amount").cast("decimal(29,2)").alias(f"{prefix}_apply"),
        F.sum("reply_amount").cast("decimal(29,2)").alias(f"{prefix}_reply"))


def summaries_match_facts(facts: Facts, dims: Facts) -> DataFrame:
    """Totals of all six outcome views against the totals of the facts."""
    counted = M.union_all([
        facts[fact].agg(
            row_count().alias("fact_count"), F.sum("apply_amount").alias("fact_apply"),
            (F.sum("reply_amount") if outcome == "approve" else typed_null(M.SUMS))
            .cast(M.SUMS).alias("fact_reply")).withColumn("audit_result", F.lit(outcome))
        for outcome, fact in M.OUTCOMES.items()])
    viewed = M.union_all([
        _totals(view(facts, dims), "view").withColumn("view_name", F.lit(name))
        for name, view in M.VIEWS.items() if name != "mv_ads_credit_transform"])
    same = (F.col("view_count").eqNullSafe(F.col("fact_count"))
            & F.col("view_apply").eqNullSafe(F.col("fact_apply"))
            & F.col("view_reply").eqNullSafe(F.col("fact_reply")))
    return viewed.join(counted, "audit_result").select(
        "view_name", "audit_result", "view_count", "fact_count", "view_apply", "fact_apply",
        "view_reply", "fact_reply", same.alias("holds"))


def names_match_dimension(tables: Facts, dim: DataFrame, key: str, name: str,
                          dim_name: str = "name") -> DataFrame:
    """Per stored table: rows whose name differs from the dimension's."""
    parts = []
    for table, rows in tables.items():
        looked_up = E.with_employee_name(
            rows.select(F.col(key).alias("_k"), F.col(name).alias("_stored")),
            dim.select("id", F.col(dim_name).alias("name")), "_k", "_current")
        parts.append(looked_up.agg(
            row_count().alias("row_count"),
            F.count(F.when(~F.col("_stored").eqNullSafe(F.col("_current")), 1))
            .alias("mismatches"),
        ).select(F.lit(table).alias("table_name"), F.lit(name).alias("name_column"),
                 "row_count", "mismatches"))
    return M.union_all(parts)
