"""Registered queries: name -> callable (spark, table folder) and, where a second
engine can express it, the same query as SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leaseflow import schemas as S
from leaseflow.functions import decode as D
from leaseflow.functions import fields as X
from leaseflow.operators import checks as K
from leaseflow.operators import dimensions as DIM
from leaseflow.operators import enrich as E
from leaseflow.operators import expiry as EX
from leaseflow.operators import lateness as LT
from leaseflow.operators import lifecycle as L
from leaseflow.operators import replay as R
from leaseflow.operators import summaries as M
from leaseflow.operators import windows as W
from leaseflow.plans import oracle as O
from leaseflow.plans import stored as SD
from leaseflow.plans.warehouse import Warehouse
from leaseflow.sources import changes as C
from leaseflow.sources import derived as T
from leaseflow.sources import snapshots as SN
from leaseflow.sources import tables as ST
from leaseflow.sources.scratch import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query and, if given, its SQL twin."""
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = O.with_ctes(sql)
        return query
    return add


# --- E: lifecycle facts, set form and replay form ---------------------------------------

def set_fact(spark: SparkSession, sf_dir: str, fact: str) -> DataFrame:
    return L.fact(T.raw_tables(spark, sf_dir), fact)


def replay_fact(spark: SparkSession, sf_dir: str, fact: str) -> DataFrame:
    return R.fact(T.replay_tables(spark, sf_dir), fact)


def replay_ttl_fact(spark: SparkSession, sf_dir: str, fact: str) -> DataFrame:
    """State is forgotten after an hour; arrival numbers count as milliseconds."""
    return EX.fact(T.replay_tables(spark, sf_dir), fact, clock=R.ORDER)


for _fact in S.FACTS:
    register(_fact, f"SELECT * FROM {_fact}")(partial(set_fact, fact=_fact))
    register(f"replay_{_fact}", f"SELECT * FROM replay_{_fact}")(partial(replay_fact, fact=_fact))
    register(f"replay_ttl_{_fact}", f"SELECT * FROM replay_ttl_{_fact}")(
        partial(replay_ttl_fact, fact=_fact))


# --- E: contexts, one-pass output, first facts -----------------------------------------

@register("auditor_of_facility", "SELECT credit_facility_id, audit_man_id FROM auditor")
def auditor_of_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.auditor_of_facility(T.raw_table(spark, sf_dir, "credit_facility_status"))


@register("facility_context", """
SELECT id AS credit_facility_id, lease_organization, business_partner_id, industry_id,
       salesman_id, credit_amount AS apply_amount FROM credit_facility""")
def facility_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.facility_context(T.raw_table(spark, sf_dir, "credit_facility"))


@register("reply_context", """
SELECT credit_facility_id, id AS reply_id, credit_amount AS reply_amount,
       create_time AS reply_time, irr, period FROM reply""")
def reply_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.reply_context(T.raw_table(spark, sf_dir, "reply"))


# Columns of the stage-one facts, each once, with their types.
_SIDE = {f.name: f.dataType for fact in R.STAGE_ONE_FACTS for f in S.FACTS[fact].fields}


def _side_sql(fact: str) -> str:
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
             "decimal(19,2)": "DECIMAL(19,2)"}
    columns = [c if c in S.FACTS[fact].names else f"NULL::{kinds[t.simpleString()]} AS {c}"
               for c, t in _SIDE.items()]
    return f"SELECT '{fact}' AS fact_type, {', '.join(columns)} FROM replay_{fact}"


@register("side_outputs", " UNION ALL ".join(_side_sql(f) for f in R.STAGE_ONE_FACTS))
def side_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six facts of one pass over the facility log, whole; columns a fact lacks are null."""
    def value(column: str) -> Column:
        return F.coalesce(*[F.col(f"{f}.{column}") for f in R.STAGE_ONE_FACTS
                            if column in S.FACTS[f].names]).alias(column)

    return R.tagged_facts(T.replay_tables(spark, sf_dir)).select("fact_type", *map(value, _SIDE))


@register("first_occupy_facts", """
SELECT id, occupy_time, credit_facility_id, apply_amount, reply_amount, credit_amount FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY occupy_time, credit_facility_id,
    apply_amount NULLS FIRST, reply_amount, credit_amount) AS rn
  FROM replay_dwd_credit_occupy) WHERE rn = 1""")
def first_occupy_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.first_only(replay_fact(spark, sf_dir, "dwd_credit_occupy"), "dwd_credit_occupy")


# --- G: window tables -------------------------------------------------------------------

def window_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    raw = T.raw_tables(spark, sf_dir)
    spec = W.SPECS[name]
    return W.window_table(name, L.fact(raw, spec.fact, columns=spec.fact_columns), raw)


for _name in W.SPECS:
    register(_name, f"SELECT * FROM {_name}")(partial(window_table, name=_name))



# --- G16, G17: windows of a batch -----------------------------------------------------------

def incremental_windows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A window table loaded in two batches. The second is first sent with all facts, by
    mistake, and then as it should be, which takes the wrong sums back."""
    fact = W.SPECS[name].fact
    facts, raw = materialize(set_fact(spark, sf_dir, fact), fact), T.raw_tables(spark, sf_dir)
    house = Warehouse(spark, scratch_path(spark, "deltas"), "delta")
    second = F.col("id") % 3 == 2
    for number, rows in ((0, facts.filter(~second)), (1, facts), (1, facts.filter(second))):
        stored = rows.withColumn(R.ORDER, F.lit(None).cast("bigint"))
        ST.append_fact_by_day(stored, f"{house.root}/dwd/{fact}", S.FACT_TIME[fact], ST.Batch("delta", number))
        house.load_touched_windows(number, [name], raw)
    return house.touched_window(name)


# One table only: each load writes a folder a day, and the given tables have thousands of days
# with a row or two, so a load is slow here whatever it computes.
register("incremental_dws_lease_sign_win", "SELECT * FROM dws_lease_sign_win")(
    partial(incremental_windows, name="dws_lease_sign_win"))


# --- G12, G18: what the watermark drops -----------------------------------------------------

# Facts arrive in the order of their own time, up to a minute late.
JITTER = 61


def arriving_facts(spark: SparkSession, sf_dir: str, fact: str) -> DataFrame:
    time = S.FACT_TIME[fact]
    seconds = F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {time})")
    return set_fact(spark, sf_dir, fact).withColumn("arrival", seconds + F.col("id") * 7919 % JITTER)


def late_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spec = W.SPECS[name]
    return LT.late_rows(arriving_facts(spark, sf_dir, spec.fact), spec, ["arrival", "id"])


def _judged_sql(spec: W.WindowSpec) -> str:
    time = S.FACT_TIME[spec.fact]
    there = " AND ".join(f"{c} IS NOT NULL" for c in [time, *spec.required])
    return f"""(SELECT *, stt + INTERVAL 10 SECOND AS edt FROM (
  SELECT *, time_bucket(INTERVAL '10 seconds', {time}) AS stt,
         max({time}) OVER (ORDER BY arrival, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM (SELECT *, epoch({time})::BIGINT + id * 7919 % {JITTER} AS arrival
        FROM {spec.fact} WHERE {there})))"""


for _name, _spec in W.SPECS.items():
    register(f"late_rows_{_name}", f"""
SELECT * FROM {_judged_sql(_spec)} WHERE edt <= seen - INTERVAL 5 SECOND""")(partial(late_rows, name=_name))


@register("on_time_dws_lease_sign_win", f"""
SELECT stt, edt, stt::DATE AS cur_date, count(*) AS apply_count,
       sum(apply_amount)::DECIMAL(19,2) AS apply_amount, sum(reply_amount)::DECIMAL(19,2) AS reply_amount,
       sum(credit_amount)::DECIMAL(19,2) AS credit_amount
FROM {_judged_sql(W.SPECS["dws_lease_sign_win"])}
WHERE seen IS NULL OR edt > seen - INTERVAL 5 SECOND GROUP BY stt, edt""")
def on_time_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window table without what arrived too late for its window."""
    name = "dws_lease_sign_win"
    return LT.window_table(name, arriving_facts(spark, sf_dir, W.SPECS[name].fact), {}, ["arrival", "id"])


@register("missing_event_time", """
SELECT time_bucket(INTERVAL '10 seconds', ts) AS stt,
       time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' AS edt,
       time_bucket(INTERVAL '10 seconds', ts)::DATE AS cur_date, count(*) AS apply_count,
       sum(apply_amount)::DECIMAL(19,2) AS apply_amount,
       sum(reply_amount)::DECIMAL(19,2) AS reply_amount,
       sum(credit_amount)::DECIMAL(19,2) AS credit_amount
FROM (SELECT coalesce(k.signed_time, TIMESTAMP '1970-01-01 08:00:00') AS ts, p.apply_amount,
             p.reply_amount, p.credit_amount
      FROM dwd_lease_contract_produce p JOIN contract k ON k.credit_id = p.credit_id)
GROUP BY ALL""")
def missing_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts signed or not: rows without a time go to the window of epoch zero."""
    raw = T.raw_tables(spark, sf_dir)
    contracts = raw["contract"].select("credit_id", "signed_time")
    rows = L.fact(raw, "dwd_lease_contract_produce").join(contracts, "credit_id")
    return W.window_table("dws_lease_sign_win", rows, raw, epoch0=True)


# --- H: summary views -------------------------------------------------------------------

def summary(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    raw = T.raw_tables(spark, sf_dir)
    return M.VIEWS[name](M.view_inputs(L.Lifecycle(raw), name), raw)


for _name in M.VIEWS:
    register(_name, f"SELECT * FROM {_name}")(partial(summary, name=_name))


@register("reviewed_projects", """
SELECT sum(project_count)::BIGINT AS reviewed_projects FROM mv_ads_audit_result_summary""")
def reviewed_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = T.raw_tables(spark, sf_dir)
    return M.reviewed_projects(M.view_inputs(L.Lifecycle(raw), "mv_ads_audit_result_summary"))


_STEPS = "VALUES " + ", ".join(f"({n + 1}, '{s}')" for n, s in enumerate(M.FUNNEL))


@register("conversion_rates", f"""
SELECT s.step_no::INTEGER AS step_no, s.transform_step, v.project_count,
       round(v.project_count / lag(v.project_count) OVER (ORDER BY s.step_no), 6) AS rate_of_previous,
       round(v.project_count / first_value(v.project_count) OVER (ORDER BY s.step_no), 6) AS rate_of_first
FROM ({_STEPS}) s(step_no, transform_step)
JOIN mv_ads_credit_transform v ON v.transform_step = s.transform_step""")
def conversion_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.conversion_rates(summary(spark, sf_dir, "mv_ads_credit_transform"))


# --- I: checks ----------------------------------------------------------------------------

@register("check_funnel_monotone", f"""
SELECT s.transform_step, v.project_count,
       lag(v.project_count) OVER (ORDER BY s.step_no) AS previous_count,
       coalesce(v.project_count <= lag(v.project_count) OVER (ORDER BY s.step_no), true) AS holds
FROM ({_STEPS}) s(step_no, transform_step)
JOIN mv_ads_credit_transform v ON v.transform_step = s.transform_step""")
def check_funnel_monotone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.funnel_monotone(summary(spark, sf_dir, "mv_ads_credit_transform"))


def stored_outcomes(raw: L.Raw) -> dict[str, DataFrame]:
    """The three outcome facts written once, for plans that read them many times."""
    life = L.Lifecycle(raw)
    return {f: materialize(life.fact(f), f) for f in M.OUTCOMES.values()}


_FACT_TOTALS = " UNION ALL ".join(
    f"""SELECT '{o}' AS audit_result, count(*) AS fact_count,
        sum(apply_amount)::DECIMAL(29,2) AS fact_apply,
        {"sum(reply_amount)" if o == "approve" else "NULL"}::DECIMAL(29,2) AS fact_reply FROM {f}"""
    for o, f in M.OUTCOMES.items())
_VIEW_TOTALS = " UNION ALL ".join(
    f"""SELECT '{v}' AS view_name, audit_result, sum(project_count)::BIGINT AS view_count,
        sum(apply_amount)::DECIMAL(29,2) AS view_apply,
        sum(reply_amount)::DECIMAL(29,2) AS view_reply FROM {v} GROUP BY audit_result"""
    for v in M.VIEWS if v != "mv_ads_credit_transform")


@register("check_ads_vs_dwd", f"""
SELECT v.*, f.fact_count, f.fact_apply, f.fact_reply,
       v.view_count IS NOT DISTINCT FROM f.fact_count
       AND v.view_apply IS NOT DISTINCT FROM f.fact_apply
       AND v.view_reply IS NOT DISTINCT FROM f.fact_reply AS holds
FROM ({_VIEW_TOTALS}) v JOIN ({_FACT_TOTALS}) f ON f.audit_result = v.audit_result""")
def check_ads_vs_dwd(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = T.raw_tables(spark, sf_dir)
    return K.summaries_match_facts(stored_outcomes(raw), raw)


_AUDITOR_TABLES = [n for n, s in W.SPECS.items() if s.enrichment == "auditor"]
_PATH_TABLES = [n for n, s in W.SPECS.items() if s.enrichment == "path"]
# (tables, id column, name column, dimension, its name column)
_NAME_CHECKS = [
    (_AUDITOR_TABLES + ["mv_ads_audit_result_audit_man"], "audit_man_id", "audit_man_name",
     "employee", "name"),
    (_PATH_TABLES + ["mv_ads_audit_result_salesman"], "salesman_id", "salesman_name",
     "employee", "name"),
    (_PATH_TABLES + ["mv_ads_audit_result_dept"], "department3_id", "department3_name",
     "department", "department_name"),
    (_PATH_TABLES + ["mv_ads_audit_result_industry"], "industry3_id", "industry3_name",
     "industry", "industry_name"),
]


@register("check_dim_names", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{name}' AS name_column, count(*) AS row_count,
        count(*) FILTER (WHERE t.{name} IS DISTINCT FROM x.{dim_name}) AS mismatches
        FROM {t} t LEFT JOIN {dim} x ON x.id = t.{key}"""
    for tables, key, name, dim, dim_name in _NAME_CHECKS for t in tables))
def check_dim_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = T.raw_tables(spark, sf_dir)
    facts = stored_outcomes(raw)
    tables = {n: W.window_table(n, facts[W.SPECS[n].fact], raw)
              for n in _AUDITOR_TABLES + _PATH_TABLES}
    tables |= {n: M.VIEWS[n](facts, raw) for n in M.VIEWS if n != "mv_ads_credit_transform"}
    stored = {n: materialize(t, n) for n, t in tables.items()
              if n not in ("mv_ads_audit_result_summary", "mv_ads_audit_result_org")}
    return M.union_all([
        K.names_match_dimension({n: stored[n] for n in names}, raw[dim], key, name, dim_name)
        for names, key, name, dim, dim_name in _NAME_CHECKS])


# --- I, A: dimensions from their change logs, keyed storage rules ---------------------------

def _history_sql(table: str) -> str:
    """Changes of one dimension that carry an image: snapshot and renamed rows."""
    columns = [c for c, _ in S.RAW[table]]
    name = {"department": "department_name", "industry": "industry_name"}.get(table, "name")
    renamed = {name: f"{name} || ' v2'", "update_time": "update_time + to_seconds(86400)"}
    later = ", ".join(f"{renamed.get(c, c)} AS {c}" for c in columns)
    return (f"SELECT {', '.join(columns)}, 0 AS seq FROM {table} UNION ALL "
            f"SELECT {later}, 1 FROM {table} WHERE id % 10 = 0")


def dimension_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return DIM.dimension_table(T.dimension_log(spark, sf_dir, table), table)


for _table in S.DIMENSIONS:
    register(f"dim_{_table}", f"""
SELECT {', '.join(c for c, _ in S.RAW[_table])} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn
  FROM ({_history_sql(_table)})) WHERE rn = 1""")(partial(dimension_table, table=_table))


@register("upsert_latest", f"""
SELECT {', '.join(c for c, _ in S.RAW["credit_facility"])}, op FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn
  FROM facility_changes) WHERE rn = 1""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest change of each facility, whole."""
    return DIM.upsert_latest(T.replay_changes(spark, sf_dir, "credit_facility"), ["id"], ["seq"])


_AUDITOR_WINDOW = "dws_audit_audit_man_reject_win"


@register("replace_aggregate", f"""
SELECT stt, edt, cur_date, audit_man_id, audit_man_name, apply_count, apply_amount FROM (
  SELECT *, row_number() OVER (PARTITION BY stt, edt, cur_date, audit_man_id, audit_man_name
                               ORDER BY batch_id DESC) AS rn
  FROM (
    SELECT *, 0 AS batch_id FROM {_AUDITOR_WINDOW}
    UNION ALL
    SELECT stt, edt, cur_date, audit_man_id,
           CASE WHEN audit_man_id % 7 = 3 THEN audit_man_name || ' v2' ELSE audit_man_name END,
           apply_count + 1, (apply_amount * 2)::DECIMAL(19,2), 1
    FROM {_AUDITOR_WINDOW} WHERE audit_man_id % 2 = 1))
WHERE rn = 1""")
def replace_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch re-sends the windows of odd auditors; some came with a new name,
    which makes a second row instead of replacing the first."""
    first = window_table(spark, sf_dir, _AUDITOR_WINDOW)
    again = first.filter(F.col("audit_man_id") % 2 == 1).withColumns({
        "audit_man_name": F.when(F.col("audit_man_id") % 7 == 3,
                                 F.concat("audit_man_name", F.lit(" v2")))
                           .otherwise(F.col("audit_man_name")),
        "apply_count": F.col("apply_count") + 1,
        "apply_amount": (F.col("apply_amount") * 2).cast(S.MONEY)})
    sent = first.withColumn(ST.BATCH, F.lit(0)).unionByName(again.withColumn(ST.BATCH, F.lit(1)))
    return ST.latest_by_key(sent, W.SPECS[_AUDITOR_WINDOW].table_key)


AS_OF = dt.date(1998, 6, 15)


@register("retain_days", f"""
SELECT * FROM (SELECT *, add_time::DATE AS dt FROM dwd_credit_add)
WHERE dt BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}' + 3""")
def retain_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = set_fact(spark, sf_dir, "dwd_credit_add").withColumn(ST.DAY, F.to_date("add_time"))
    return ST.retain_days(facts, AS_OF, ST.FACT_DAYS)


@register("retain_days_windows", f"""
SELECT * REPLACE (apply_count + (extract(day FROM cur_date) % 2)::BIGINT AS apply_count)
FROM dws_credit_credit_add_win
WHERE cur_date BETWEEN DATE '{AS_OF}' - 100 AND DATE '{AS_OF}' + 3""")
def retain_days_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored windows, those of odd days sent again with a count more, then expired by day:
    only the manifest changes, and readers open the day folders inside the range."""
    name = "dws_credit_credit_add_win"
    first = materialize(window_table(spark, sf_dir, name), name)
    stored = SN.SnapshotTable(spark, scratch_path(spark, "windows"), "cur_date")
    stored.write(first, ST.Batch("daily", 0))
    again = first.filter(F.dayofmonth("cur_date") % 2 == 1)
    stored.write(again.withColumn("apply_count", F.col("apply_count") + 1), ST.Batch("daily", 1))
    stored.retain(AS_OF, ST.WINDOW_DAYS)
    return stored.latest(first.schema, W.SPECS[name].table_key).select(*first.columns)


_UPSERTS = 5
_UPSERT_SPAN = 2_000_007  # a fifth of the arrival numbers
_FACILITY = ", ".join(c for c, _ in S.RAW["credit_facility"])


def _latest_sql(where: str, reader: str) -> str:
    return f"""
SELECT {_FACILITY}, op, '{reader}' AS reader FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn
  FROM facility_changes WHERE {where}) WHERE rn = 1"""


@register("compact_then_upsert", _latest_sql("TRUE", "now") + " UNION ALL" + _latest_sql(
    f"seq < {3 * _UPSERT_SPAN}", "before_fold"))
def compact_then_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A changed table in five batches, folded after the third; the last batch is sent twice
    and a folded one again. A reader that opened the table before the fold sees it as it was."""
    rows = T.replay_changes(spark, sf_dir, "credit_facility")
    stored = SN.SnapshotTable(spark, scratch_path(spark, "upserts"))
    schema = S.T.StructType([f for f in rows.schema.fields])

    def send(number: int) -> None:
        part = rows.filter(F.floor(F.col("seq") / _UPSERT_SPAN) == number)
        stored.write(part, ST.Batch("daily", number))

    def visible(reader: str) -> DataFrame:
        return stored.latest(schema, ["id"], ["seq"]).select(
            *[c for c, _ in S.RAW["credit_facility"]], "op", F.lit(reader).alias("reader"))

    for number in range(3):
        send(number)
    before = visible("before_fold")
    stored.fold(schema, ["id"], ["seq"])
    for number in (3, 4, 4, 1):
        send(number)
    return visible("now").unionByName(before)


@register("append_fact_by_day", """
SELECT f.*, f.reject_time::DATE AS dt FROM dwd_audit_reject f, (VALUES (0), (1)) b(batch_id)""")
def append_fact_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same facts loaded as two batches, the second one twice: duplicates of
    different batches stay, a retried batch does not add rows."""
    fact = "dwd_audit_reject"
    rows = materialize(set_fact(spark, sf_dir, fact), fact)
    path = scratch_path(spark, "append")
    for batch_id in (0, 1, 1):
        ST.append_fact_by_day(rows, path, S.FACT_TIME[fact], ST.Batch("load", batch_id))
    return ST.read_facts(spark, path, S.FACTS[fact])


@register("refresh_view", "SELECT * FROM mv_ads_audit_result_org")
def refresh_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary view stored, recomputed over itself and read back."""
    path = scratch_path(spark, "view")
    for _ in range(2):
        ST.refresh_view(lambda: summary(spark, sf_dir, "mv_ads_audit_result_org"), path)
    return spark.read.parquet(path)


@register("snapshot_then_changes", f"""
SELECT {', '.join(c for c, _ in S.RAW['business_partner'])} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn
  FROM ({_history_sql('business_partner')})) WHERE rn = 1""")
def snapshot_then_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot images and later changes, each numbered from zero, as one log."""
    log = T.dimension_log(spark, sf_dir, "business_partner")
    snapshot = log.filter(F.col("arrival") == 0)
    later = log.filter(F.col("arrival") > 0).withColumn("arrival", F.col("arrival") - 1)
    both = C.of_tables(C.snapshot_then_changes(snapshot, later), r"lease\..*")
    rows = DIM.dimension_changes(both, "business_partner", keep=("phase", "arrival"))
    return DIM.upsert_latest(rows, ["id"], ["phase", "arrival"])


@register("union_ods", """
SELECT 'facility' AS kind, op, count(*) AS row_count FROM facility_changes GROUP BY op
UNION ALL SELECT 'status', op, count(*) FROM status_changes GROUP BY op
UNION ALL SELECT 'reply', op, count(*) FROM reply_changes GROUP BY op
UNION ALL SELECT 'credit', op, count(*) FROM credit_changes GROUP BY op""")
def union_ods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four facility tables as one keyed log, counted per table and operation."""
    log = R.facility_log(T.replay_tables(spark, sf_dir))
    return log.groupBy("kind", "op").agg(X.row_count().alias("row_count"))


# --- F: enrichment alone ---------------------------------------------------------------------

def _facility(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    raw = T.raw_tables(spark, sf_dir)
    return raw["credit_facility"].select("id", "industry_id", "salesman_id"), raw


def enrich_hierarchy(spark: SparkSession, sf_dir: str, rule: E.Rule) -> DataFrame:
    rows, raw = _facility(spark, sf_dir)
    rows = E.with_industry(rows, raw["industry"], rule)
    return E.with_salesman(rows, raw["employee"], raw["department"], rule)


def _hierarchy_sql(rule: E.Rule) -> str:
    pointer = rule == "pointer"
    i3, i2, i1 = (("f.industry_id", "i3.superior_industry_id", "i2.superior_industry_id")
                  if pointer else ("i3.id", "i2.id", "i1.id"))
    d3, d2, d1 = (("e.department_id", "d3.superior_department_id", "d2.superior_department_id")
                  if pointer else ("d3.id", "d2.id", "d1.id"))
    return f"""
SELECT f.id, f.industry_id, f.salesman_id, e.name AS salesman_name,
       {i3} AS industry3_id, i3.industry_name AS industry3_name, {i2} AS industry2_id,
       i2.industry_name AS industry2_name, {i1} AS industry1_id, i1.industry_name AS industry1_name,
       {d3} AS department3_id, d3.department_name AS department3_name, {d2} AS department2_id,
       d2.department_name AS department2_name, {d1} AS department1_id,
       d1.department_name AS department1_name
FROM credit_facility f
LEFT JOIN industry i3 ON i3.id = f.industry_id
LEFT JOIN industry i2 ON i2.id = i3.superior_industry_id
LEFT JOIN industry i1 ON i1.id = i2.superior_industry_id
LEFT JOIN employee e ON e.id = f.salesman_id
LEFT JOIN department d3 ON d3.id = e.department_id
LEFT JOIN department d2 ON d2.id = d3.superior_department_id
LEFT JOIN department d1 ON d1.id = d2.superior_department_id"""


for _rule in ("pointer", "joined"):
    register(f"enrich_hierarchy_{_rule}", _hierarchy_sql(_rule))(
        partial(enrich_hierarchy, rule=_rule))


@register("enrich_employee_name", """
SELECT f.id, f.salesman_id, e.name AS salesman_name
FROM credit_facility f LEFT JOIN employee e ON e.id = f.salesman_id""")
def enrich_employee_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, raw = _facility(spark, sf_dir)
    return E.with_employee_name(rows.select("id", "salesman_id"), raw["employee"],
                                "salesman_id", "salesman_name")


# --- A, B: change log and scalar functions ------------------------------------------------------

def _damaged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of all nine tables, some of them damaged by position: broken text, no
    source, NULL table, deletion."""
    logs = []
    for number, table in enumerate(S.RAW):
        rows = T.raw_table(spark, sf_dir, table)
        op = F.when(F.col("id") % 13 == 4, "d").when(F.col("id") % 13 == 5, "u").otherwise("r")
        logs.append(rows.withColumn("op", op).select(
            (F.col("id") * len(S.RAW) + number).alias("arrival"),
            C.to_envelope(rows.withColumn("op", op), table).alias("value")))
    log = M.union_all(logs)
    place = F.col("arrival") % 41
    value = (F.when(place == 7, F.concat(F.lit("{"), F.col("arrival").cast("string")))
             .when(place == 8, F.regexp_replace("value", '"source":[{][^}]*[}],', ""))
             .when(place == 9, F.regexp_replace("value", '"table":"[a-z_]*"', '"table":null'))
             .otherwise(F.col("value")))
    return log.withColumn("value", value)


_ALL_IDS = " UNION ALL ".join(
    f"SELECT id, {n} AS n, '{t}' AS tab FROM {t}" for n, t in enumerate(S.RAW))
_DAMAGED = f"""
  SELECT id, id * {len(S.RAW)} + n AS arrival, tab,
         CASE WHEN id % 13 = 4 THEN 'd' WHEN id % 13 = 5 THEN 'u' ELSE 'r' END AS op,
         (id * {len(S.RAW)} + n) % 41 AS place
  FROM ({_ALL_IDS})"""


@register("route_by_table", f"""
SELECT arrival, CASE WHEN place IN (7, 8, 9) THEN 'ods_unknown_table' ELSE 'ods_' || tab END AS topic
FROM ({_DAMAGED})""")
def route_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.route_by_table(_damaged_log(spark, sf_dir)).select("arrival", "topic")


@register("op_code", f"""
SELECT arrival, CASE WHEN place <> 7 THEN op END AS op FROM ({_DAMAGED})""")
def op_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _damaged_log(spark, sf_dir).select("arrival", C.op_code().alias("op"))


@register("parse_envelope", f"""
SELECT d.arrival, d.tab AS table_name, d.op, CASE WHEN d.op <> 'd' THEN d.id END AS image_id,
       CASE WHEN d.op <> 'd' THEN k.credit_id END AS credit_id
FROM ({_DAMAGED}) d LEFT JOIN contract k ON d.tab = 'contract' AND k.id = d.id
WHERE d.place NOT IN (7, 8, 9)""")
def parse_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = C.parse_envelope(_damaged_log(spark, sf_dir), "contract")
    return parsed.select("arrival", "table_name", "op",
                         F.col("after.id").alias("image_id"), F.col("after.credit_id").alias("credit_id"))


@register("after_image", f"""
SELECT d.arrival, CASE WHEN d.op <> 'd' AND d.place <> 7 THEN d.id END AS image_id,
       CASE WHEN d.op <> 'd' AND d.place <> 7 THEN f.industry_id END AS industry_id
FROM ({_DAMAGED}) d LEFT JOIN credit_facility f ON d.tab = 'credit_facility' AND f.id = d.id""")
def after_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _damaged_log(spark, sf_dir)
    image = log.select("arrival", C.after_image("value", "credit_facility").alias("a"))
    return image.select("arrival", F.col("a.id").alias("image_id"),
                        F.col("a.industry_id").alias("industry_id"))


def decoded_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Raw table -> envelopes -> typed rows: the whole decoding chain."""
    rows = T.raw_table(spark, sf_dir, table).withColumn("op", F.lit("r"))
    return C.decode_table(rows.select(C.to_envelope(rows, table).alias("value")), table)


for _table in ("credit_facility", "credit_facility_status", "reply", "credit", "contract"):
    _shown = ", ".join(f"coalesce({c}, 0) AS {c}" if k.endswith("0") else c
                       for c, k in S.RAW[_table])
    register(f"decode_{_table}", f"SELECT {_shown}, 'r' AS op FROM {_table}")(
        partial(decoded_table, table=_table))


@register("decode_decimal", """
SELECT o_orderkey AS id, o_totalprice::DECIMAL(19,2) AS amount,
       (-(o_totalprice::DECIMAL(19,2)))::DECIMAL(19,2) AS negative,
       (o_totalprice::DECIMAL(19,2) * 1000000000)::DECIMAL(19,2) AS large,
       (-(o_totalprice::DECIMAL(19,2)))::DECIMAL(19,2) AS padded
FROM orders""")
def decode_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("o_totalprice").cast("decimal(19,2)")
    parts = {"amount": amount, "negative": (-amount).cast("decimal(19,2)"),
             "large": (amount * F.lit(10**9)).cast("decimal(19,2)")}
    encoded = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("id"),
        *[D.encode_decimal(v).alias(n) for n, v in parts.items()])
    # Twenty more sign bytes change nothing.
    encoded = encoded.withColumn("padded", F.base64(F.unhex(F.concat(
        F.repeat(F.lit("FF"), 20), F.hex(F.unbase64("negative"))))))
    return encoded.select("id", *[D.decode_decimal(n).alias(n) for n in [*parts, "padded"]])


_EVENT_TEXT = "strftime(ts + INTERVAL '8 hours', '%Y-%m-%d %H:%M:%S.%f')"


@register("micros_to_wall", f"""
SELECT event_id, ts + INTERVAL '8 hours' AS wall, {_EVENT_TEXT} AS wall_text FROM events""")
def micros_to_wall(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", D.naive_micros("ts").alias("micros"))
    wall = D.micros_to_wall("micros")
    return micros.select("event_id", wall.alias("wall"), D.wall_text(wall).alias("wall_text"))


@register("wall_to_millis", f"""
SELECT event_id, CASE WHEN event_id % 9 <> 2 THEN epoch_us(ts) // 1000 END AS millis FROM events""")
def wall_to_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall text back to epoch milliseconds; text without a fraction is unreadable."""
    walls = micros_to_wall(spark, sf_dir)
    text = F.when(F.col("event_id") % 9 != 2, F.col("wall_text")).otherwise(
        F.substring("wall_text", 1, 19))
    return walls.select("event_id", D.wall_to_millis(text).alias("millis"))


@register("window_text", """
SELECT event_id, strftime(ts + INTERVAL '8 hours', '%Y-%m-%d %H:%M:%S') AS stt,
       (ts + INTERVAL '8 hours')::DATE AS cur_date FROM events""")
def window_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.floor(D.naive_micros("ts") / 1000).cast("bigint").alias("ms"))
    return millis.select("event_id", D.window_time("ms").alias("stt"),
                         D.window_date("ms").alias("cur_date"))


@register("to_json_row", """
SELECT '{"id":' || id || ',"add_time":"' || strftime(add_time, '%Y-%m-%d %H:%M:%S.%f')
       || '","credit_facility_id":' || credit_facility_id || ',"apply_amount":"' || apply_amount
       || '","reply_amount":"' || reply_amount || '","credit_amount":"' || credit_amount || '"}' AS value
FROM dwd_credit_add""")
def to_json_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_fact(spark, sf_dir, "dwd_credit_add").select(
        X.fact_json("dwd_credit_add").alias("value"))


@register("read_fact_json", "SELECT * FROM dwd_audit_reject")
def read_fact_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts written as JSON text and read back, NULL auditor included."""
    text = set_fact(spark, sf_dir, "dwd_audit_reject").select(
        X.fact_json("dwd_audit_reject").alias("value"))
    return X.read_fact_json(text, "dwd_audit_reject")


# --- A, E, G: stored batches and live forms -------------------------------------------------------

for _name, _query in SD.QUERIES.items():
    register(_name, SD.SQL[_name])(_query)
