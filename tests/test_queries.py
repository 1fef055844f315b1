"""Registered queries against their SQL in DuckDB, and the plans they compile to."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from leaseflow import schemas as S
from leaseflow.operators import lifecycle as L
from leaseflow.operators import replay as R
from leaseflow.operators import skew as SK
from leaseflow.operators import summaries as M
from leaseflow.operators import windows as W
from leaseflow.plans.catalog import ORACLE, QUERIES
from leaseflow.plans.warehouse import Warehouse
from leaseflow.sources import derived as T
from leaseflow.sources.scratch import materialize
from tests import traces as TR
from tests.conftest import SMALL
from tests.oracle_compare import compare, connect

# Rows of the facts in the generated tables (one trigger per facility, set form).
EXPECTED_ROWS = {
    "dwd_audit_approve": 410, "dwd_audit_reject": 514, "dwd_audit_cancel": 493,
    "dwd_credit_add": 316, "dwd_credit_occupy": 242, "dwd_lease_contract_produce": 187,
    "dwd_lease_sign": 155, "dwd_lease_execution": 137,
}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    """Same rows; built-in operators only, no cross joins."""
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan, word
    rows, _, problem = compare(df, duck, ORACLE[name])
    assert not problem
    assert rows == EXPECTED_ROWS.get(name, rows)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_replay_needs_one_exchange(spark):
    plan = plan_of(QUERIES["replay_dwd_audit_approve"](spark, SMALL))
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.fixture
def shuffle_joins(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("view,most", [
    ("mv_ads_audit_result_dept", {"credit_facility_status": 2, "credit_facility": 1, "reply": 1}),
    ("mv_ads_credit_transform", {"credit": 2, "contract": 1, "credit_facility": 2, "reply": 2})])
def test_views_pass_over_their_tables_once(spark, shuffle_joins, view, most):
    """Scans per stored table, shuffle joins only; reused exchanges don't scan again."""
    raw = {t: materialize(T.raw_table(spark, SMALL, t), f"raw_{t}") for t in S.RAW}
    plan = plan_of(M.VIEWS[view](M.view_inputs(L.Lifecycle(raw, limit=None), view), raw))
    for table, times in most.items():
        assert plan.count(f"/raw_{table}-") <= times, table


def test_large_dimensions_are_not_broadcast(spark):
    """Above the size threshold the look-ups turn into shuffle joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["enrich_hierarchy_joined"](spark, SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(QUERIES["mv_ads_audit_result_org"](spark, SMALL))
    assert "ReadSchema" in plan and "o_custkey" not in plan


def test_windows_combine_before_the_shuffle(spark):
    plan = plan_of(QUERIES["dws_credit_credit_add_win"](spark, SMALL))
    assert "partial_sum" in plan and "partial_count" in plan


def test_hot_key_is_cut_into_even_contiguous_segments(spark):
    rows = [(7, n * n) for n in range(1000)] + [(k, 1) for k in range(100, 200)]
    log = spark.createDataFrame(rows, "k bigint, seq bigint")
    hot = SK.find_hot(log, "k", 100)
    assert [r.k for r in hot.keys.collect()] == [7] and hot.segments == 10
    cut = SK.cut_segments(log, hot, "k", "seq")
    parts = cut.groupBy(SK.SEGMENT).agg(F.count("*").alias("n"), F.min("seq").alias("lo"),
                                        F.max("seq").alias("hi")).orderBy(SK.SEGMENT).collect()
    assert sum(p.n for p in parts) == 1000 and len(parts) > 5
    assert max(p.n for p in parts) <= 200
    assert all(a.hi < b.lo for a, b in zip(parts, parts[1:]))
    assert SK.find_hot(log, "k", 1000) is None


def test_warehouse_run(spark, tmp_path):
    """Logs -> stored layers; the stored views equal the registered queries, a repeated
    run changes nothing."""
    logs = {t: (T.dimension_log(spark, SMALL, t) if t in S.DIMENSIONS
                else T.change_log(spark, SMALL, t)) for t in S.RAW}
    logs = {t: materialize(log, f"log-{t}") for t, log in logs.items()}
    house = Warehouse(spark, str(tmp_path / "w"), "test")
    house.run(logs, 0)
    for fact in S.FACTS:
        assert TR.canonical(house.fact(fact).collect()) == TR.canonical(
            QUERIES[fact](spark, SMALL).collect()), fact
    for view in ("mv_ads_credit_transform", "mv_ads_audit_result_org"):
        assert TR.canonical(house.view(view).collect()) == TR.canonical(
            QUERIES[view](spark, SMALL).collect())
    name = "dws_credit_credit_add_win"
    assert TR.canonical(house.window(name).collect()) == TR.canonical(
        QUERIES[name](spark, SMALL).collect())
    assert all(r.holds for r in house.check_funnel().collect())
    assert all(r.holds for r in house.check_totals().collect())
    before = TR.canonical(house.window(name).collect())
    assert house.rejects().agg(F.sum("row_count")).first()[0] == 0
    house.load_windows(0)
    assert TR.canonical(house.window(name).collect()) == before


def test_every_table_has_a_builder():
    assert set(M.VIEWS) | set(W.SPECS) | set(S.FACTS) <= set(QUERIES)
    assert {f"replay_{f}" for f in R.STAGE_ONE_FACTS + R.STAGE_TWO_FACTS} <= set(QUERIES)
