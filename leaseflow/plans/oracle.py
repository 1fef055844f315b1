"""The registered queries as SQL for a second engine (DuckDB).

Written from the rules, not from the Spark code: where the Spark operators use
running values, carried segments or staged aggregation, the text here uses plain
joins, next-row look-ups and one-step GROUP BY.
"""

from __future__ import annotations

import re

# --- raw tables --------------------------------------------------------------------

_MONTH = "date_trunc('month', o_orderdate)::TIMESTAMP"


def _after_month(seconds: str) -> str:
    return f"({_MONTH} + to_seconds({seconds}))"


def _hierarchy(prefix: str, absent: int) -> str:
    return f"""
  SELECT id, TIMESTAMP '2020-01-01 00:00:00' + to_seconds(id) AS create_time,
         TIMESTAMP '2020-01-01 00:00:00' + to_seconds(id) AS update_time,
         lvl::INTEGER AS {prefix}_level, nm AS {prefix}_name, parent::BIGINT AS superior_{prefix}_id
  FROM (
    SELECT 1 + r_regionkey::BIGINT AS id, 1 AS lvl, r_name AS nm, NULL::BIGINT AS parent FROM region
    UNION ALL
    SELECT 100 + n_nationkey::BIGINT, 2, n_name, 1 + n_regionkey FROM nation WHERE n_nationkey <> {absent}
    UNION ALL
    SELECT 1000 + n_nationkey::BIGINT * 5 + r_regionkey, 3, n_name || '/' || r_name, 100 + n_nationkey
    FROM nation, region
  )"""


_REPLY_AMOUNT = ("(o_totalprice::DECIMAL(19,2) - (o_orderkey % 1000)::DECIMAL(19,2))"
                 "::DECIMAL(19,2)")
_PRODUCED = "(o_orderkey % 4 <> 3 AND o_orderkey % 5 <> 4)"
_CREDIT_WHERE = "o_orderstatus = 'F' AND o_orderkey % 3 <> 2"

CTES: dict[str, str] = {
    "business_partner": """
  SELECT c_custkey AS id, TIMESTAMP '2020-01-01 00:00:00' + to_seconds(c_custkey) AS create_time,
         TIMESTAMP '2020-01-01 00:00:00' + to_seconds(c_custkey) AS update_time, c_name AS name
  FROM customer""",
    "department": _hierarchy("department", 7),
    "industry": _hierarchy("industry", 9),
    "employee": """
  SELECT s_suppkey AS id, TIMESTAMP '2020-01-01 00:00:00' + to_seconds(s_suppkey) AS create_time,
         TIMESTAMP '2020-01-01 00:00:00' + to_seconds(s_suppkey) AS update_time,
         s_name AS name, s_suppkey % 4 AS type,
         CASE WHEN s_suppkey % 17 <> 5 THEN 1000 + s_nationkey * 5 + s_suppkey % 6 END AS department_id
  FROM supplier""",
    "credit_facility": """
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderpriority END AS lease_organization,
         o_custkey AS business_partner_id, 1000 + (o_custkey % 27) * 5 + o_orderkey % 5 AS industry_id,
         o_orderkey % 110 AS salesman_id, o_totalprice::DECIMAL(19,2) AS credit_amount
  FROM orders""",
    "credit_facility_status": f"""
  SELECT o_orderkey * 10 + 4 AS id, o_orderkey AS credit_facility_id, 5 AS status,
         CASE WHEN o_orderkey % 23 <> 0 THEN o_orderkey % 90 END AS employee_id,
         {_after_month("o_orderkey % 600")} AS create_time
  FROM orders WHERE o_orderkey % 11 <> 0
  UNION ALL
  SELECT o_orderkey * 10 + 5, o_orderkey,
         CASE o_orderstatus WHEN 'F' THEN 16 WHEN 'O' THEN 20 WHEN 'P' THEN 21 END, NULL,
         {_after_month("3600 + o_orderkey % 600")}
  FROM orders""",
    "reply": f"""
  SELECT o_orderkey * 10 + 1 AS id, o_orderkey AS credit_facility_id, {_REPLY_AMOUNT} AS credit_amount,
         (o_orderkey % 20)::DECIMAL(19,2) AS irr, (12 + o_orderkey % 48)::INTEGER AS period,
         {_after_month("3000")} AS create_time
  FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 13 <> 0""",
    "credit": f"""
  SELECT o_orderkey * 10 + 2 AS id, o_orderkey AS credit_facility_id,
         CASE WHEN {_PRODUCED} THEN o_orderkey * 10 + 3 END AS contract_id,
         {_REPLY_AMOUNT} AS credit_amount, {_after_month("7200 + o_orderkey % 600")} AS create_time,
         CASE WHEN o_orderkey % 4 <> 3 THEN {_after_month("10800 + o_orderkey % 600")} END AS credit_occupy_time,
         CASE WHEN {_PRODUCED} THEN {_after_month("14400 + o_orderkey % 600")} END AS contract_produce_time
  FROM orders WHERE {_CREDIT_WHERE}""",
    "contract": f"""
  SELECT o_orderkey * 10 + 3 AS id, o_orderkey * 10 + 2 AS credit_id,
         CASE WHEN o_orderkey % 8 <> 6 THEN {_after_month("18000 + o_orderkey % 600")} END AS signed_time,
         CASE WHEN o_orderkey % 8 <> 6 AND o_orderkey % 7 <> 6
              THEN {_after_month("21600 + o_orderkey % 600")} END AS execution_time
  FROM orders WHERE {_CREDIT_WHERE} AND {_PRODUCED}""",
}

# --- facts, set form ------------------------------------------------------------------

CTES["auditor"] = """
  SELECT credit_facility_id, arg_max(employee_id, (create_time, id)) AS audit_man_id
  FROM credit_facility_status WHERE status IN (4, 5, 6) AND employee_id IS NOT NULL
  GROUP BY credit_facility_id"""

CTES["dwd_audit_approve"] = """
  SELECT s.credit_facility_id AS id, s.create_time AS approve_time, f.lease_organization,
         f.business_partner_id, f.industry_id, r.id AS reply_id, f.salesman_id, a.audit_man_id,
         f.credit_amount AS apply_amount, r.credit_amount AS reply_amount,
         r.create_time AS reply_time, r.irr, r.period
  FROM credit_facility_status s
  JOIN credit_facility f ON f.id = s.credit_facility_id
  JOIN auditor a ON a.credit_facility_id = s.credit_facility_id
  JOIN reply r ON r.credit_facility_id = s.credit_facility_id
  WHERE s.status = 16"""

for _fact, _time, _code in (("dwd_audit_cancel", "cancel_time", 21),
                            ("dwd_audit_reject", "reject_time", 20)):
    CTES[_fact] = f"""
  SELECT s.credit_facility_id AS id, s.create_time AS {_time}, f.lease_organization,
         f.business_partner_id, f.industry_id, f.salesman_id, a.audit_man_id,
         f.credit_amount AS apply_amount
  FROM credit_facility_status s
  JOIN credit_facility f ON f.id = s.credit_facility_id
  LEFT JOIN auditor a ON a.credit_facility_id = s.credit_facility_id
  WHERE s.status = {_code}"""

_CREDIT_FROM = """FROM credit c
  JOIN credit_facility f ON f.id = c.credit_facility_id
  JOIN reply r ON r.credit_facility_id = c.credit_facility_id
  WHERE f.credit_amount IS NOT NULL AND r.credit_amount IS NOT NULL"""
_CREDIT_AMOUNTS = ("c.credit_facility_id, f.credit_amount AS apply_amount,"
                   " r.credit_amount AS reply_amount, c.credit_amount")

CTES["dwd_credit_add"] = f"""
  SELECT c.id, c.create_time AS add_time, {_CREDIT_AMOUNTS} {_CREDIT_FROM}"""
CTES["dwd_credit_occupy"] = f"""
  SELECT c.id, c.credit_occupy_time AS occupy_time, {_CREDIT_AMOUNTS} {_CREDIT_FROM}
    AND c.credit_occupy_time IS NOT NULL"""
CTES["dwd_lease_contract_produce"] = f"""
  SELECT coalesce(c.contract_id, 0) AS id, c.contract_produce_time AS produced_time,
         c.id AS credit_id, {_CREDIT_AMOUNTS} {_CREDIT_FROM}
    AND c.contract_produce_time IS NOT NULL"""
for _fact, _time in (("dwd_lease_sign", "signed_time"), ("dwd_lease_execution", "execution_time")):
    CTES[_fact] = f"""
  SELECT k.id, k.{_time}, k.credit_id, p.credit_facility_id, p.apply_amount, p.reply_amount,
         p.credit_amount
  FROM contract k JOIN dwd_lease_contract_produce p ON p.credit_id = k.credit_id
  WHERE k.{_time} IS NOT NULL"""

FACTS = ["dwd_audit_approve", "dwd_audit_cancel", "dwd_audit_reject", "dwd_credit_add",
         "dwd_credit_occupy", "dwd_lease_contract_produce", "dwd_lease_sign",
         "dwd_lease_execution"]

# --- facts, replay form ------------------------------------------------------------------


def _replay(table: str, number: int, columns: list[str], changed: dict[str, str],
            nulled: str | None = None) -> str:
    """Versioned changes of one table with their arrival order."""
    later = ", ".join(changed.get(c, c) + f" AS {c}" for c in columns)
    amount = {"credit_amount": f"CASE WHEN {nulled} THEN credit_amount END"} if nulled else {}
    shown = ", ".join(amount.get(c, c) + f" AS {c}" for c in columns)
    return f"""
  SELECT {shown}, op,
         (((id * 7919 + {number} * 104729 + version * 50021) % 1000003) * 5 + {number}) * 2 + version AS seq
  FROM (SELECT {', '.join(columns)}, 'r' AS op, 0 AS version FROM {table}
        UNION ALL
        SELECT {later}, 'u', 1 FROM {table} WHERE id % 7 IN (1, 3, 5))"""


_PLUS_ONE = {"credit_amount": "(credit_amount + 1)::DECIMAL(19,2)"}
CTES["facility_changes"] = _replay(
    "credit_facility", 0, ["id", "lease_organization", "business_partner_id", "industry_id",
                           "salesman_id", "credit_amount"], _PLUS_ONE, "(id + version) % 17 <> 3")
CTES["status_changes"] = _replay(
    "credit_facility_status", 1, ["id", "credit_facility_id", "status", "employee_id", "create_time"],
    {"create_time": "create_time + to_seconds(60)"})
CTES["reply_changes"] = _replay(
    "reply", 2, ["id", "credit_facility_id", "credit_amount", "irr", "period", "create_time"],
    _PLUS_ONE, "(id + version) % 19 <> 4")
CTES["credit_changes"] = _replay(
    "credit", 3, ["id", "credit_facility_id", "contract_id", "credit_amount", "create_time",
                  "credit_occupy_time", "contract_produce_time"], _PLUS_ONE)
CTES["contract_changes"] = _replay(
    "contract", 4, ["id", "credit_id", "signed_time", "execution_time"], {})

# One row per change with what was known after it.
CTES["facility_history"] = """
  SELECT fk, seq, kind, status, moment,
         last_value(fseq IGNORE NULLS) OVER w AS fseq, last_value(rseq IGNORE NULLS) OVER w AS rseq,
         last_value(man IGNORE NULLS) OVER w AS man,
         last_value(CASE WHEN man IS NOT NULL THEN seq END IGNORE NULLS) OVER w AS mseq
  FROM (
    SELECT id AS fk, seq, 'f' AS kind, NULL::INTEGER AS status, NULL::TIMESTAMP AS moment, seq AS fseq,
           NULL::BIGINT AS rseq, NULL::BIGINT AS man FROM facility_changes
    UNION ALL
    SELECT credit_facility_id, seq, 's', status, create_time, NULL, NULL,
           CASE WHEN status IN (4, 5, 6) THEN employee_id END FROM status_changes
    UNION ALL
    SELECT credit_facility_id, seq, 'r', NULL, NULL, NULL, seq, NULL FROM reply_changes
  )
  WINDOW w AS (PARTITION BY fk ORDER BY seq ROWS UNBOUNDED PRECEDING)"""


# What an hour after its arrival (``seq`` in milliseconds) is still known.
HOUR = 3_600_000


def _still(seq: str, value: str) -> str:
    return f"CASE WHEN seq < {seq} + {HOUR} THEN {value} END"


CTES["facility_history_ttl"] = f"""
  SELECT fk, seq, kind, status, moment, {_still('fseq', 'fseq')} AS fseq, {_still('rseq', 'rseq')} AS rseq,
         {_still('mseq', 'man')} AS man
  FROM facility_history"""


def _replay_audit(code: int, ttl: bool = False) -> str:
    """A status row emits at the first complete row before the next such status row."""
    complete = "fseq IS NOT NULL"
    if code == 16:
        complete += " AND rseq IS NOT NULL AND man IS NOT NULL"
    time = {16: "approve_time", 20: "reject_time", 21: "cancel_time"}[code]
    reply_columns = (", r.id AS reply_id, r.credit_amount AS reply_amount,"
                     " r.create_time AS reply_time, r.irr, r.period" if code == 16 else "")
    reply_join = ("JOIN reply_changes r ON r.credit_facility_id = e.fk AND r.seq = e.at.rseq"
                  if code == 16 else "")
    return f"""
  SELECT e.fk AS id, e.moment AS {time}, f.lease_organization, f.business_partner_id, f.industry_id,
         f.salesman_id, e.at.man AS audit_man_id, f.credit_amount AS apply_amount{reply_columns}
  FROM (
    SELECT fk, seq, moment, status,
           first_value(CASE WHEN {complete}
             THEN {{'seq': seq, 'fseq': fseq, 'rseq': rseq, 'man': man}} END IGNORE NULLS)
             OVER (PARTITION BY fk ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at,
           first_value(CASE WHEN status = {code} THEN seq END IGNORE NULLS)
             OVER (PARTITION BY fk ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_seq
    FROM facility_history{'_ttl' if ttl else ''}
  ) e
  JOIN facility_changes f ON f.id = e.fk AND f.seq = e.at.fseq
  {reply_join}
  WHERE e.status = {code} AND (e.next_seq IS NULL OR e.at.seq < e.next_seq)
    {f'AND e.at.seq < e.seq + {HOUR}' if ttl else ''}"""


for _fact, _code in (("dwd_audit_approve", 16), ("dwd_audit_reject", 20), ("dwd_audit_cancel", 21)):
    CTES[f"replay_{_fact}"] = _replay_audit(_code)
    CTES[f"replay_ttl_{_fact}"] = _replay_audit(_code, ttl=True)

CTES["amount_history"] = """
  SELECT fk, seq, kind, last_value(fseq IGNORE NULLS) OVER w AS fseq,
         last_value(rseq IGNORE NULLS) OVER w AS rseq
  FROM (
    SELECT id AS fk, seq, 'f' AS kind, seq AS fseq, NULL::BIGINT AS rseq FROM facility_changes
    UNION ALL SELECT credit_facility_id, seq, 'r', NULL, seq FROM reply_changes
    UNION ALL SELECT credit_facility_id, seq, 'c', NULL, NULL FROM credit_changes
  )
  WINDOW w AS (PARTITION BY fk ORDER BY seq ROWS UNBOUNDED PRECEDING)"""
CTES["amount_history_ttl"] = f"""
  SELECT fk, seq, kind, {_still('fseq', 'fseq')} AS fseq, {_still('rseq', 'rseq')} AS rseq
  FROM amount_history"""
for _end in ("", "_ttl"):
    CTES[f"amounts_known{_end}"] = f"""
  SELECT h.fk, h.seq, h.kind, h.fseq, f.credit_amount AS apply_amount,
         r.credit_amount AS reply_amount
  FROM amount_history{_end} h
  LEFT JOIN facility_changes f ON f.id = h.fk AND f.seq = h.fseq
  LEFT JOIN reply_changes r ON r.credit_facility_id = h.fk AND r.seq = h.rseq"""


def _replay_credit(event: str, columns: str, ttl: bool = False) -> str:
    """Known amounts: at its own row. Otherwise at the next facility or reply row that
    has a facility and a reply amount, unless another waiting credit comes first."""
    known, in_time = ("amounts_known_ttl", f"AND g.seq < t.seq + {HOUR}") if ttl else ("amounts_known", "")
    return f"""
  SELECT {columns}, c.credit_facility_id, e.apply_amount, e.reply_amount, c.credit_amount
  FROM (
    SELECT k.fk, k.seq AS cseq, k.apply_amount, k.reply_amount
    FROM {known} k JOIN credit_changes c ON c.credit_facility_id = k.fk AND c.seq = k.seq
    WHERE k.kind = 'c' AND {event} AND k.apply_amount IS NOT NULL AND k.reply_amount IS NOT NULL
    UNION ALL
    SELECT w.fk, w.seq, g.apply_amount, g.reply_amount
    FROM (
      SELECT t.fk, t.seq, min(g.seq) AS emit_seq
      FROM (SELECT k.fk, k.seq, lead(k.seq) OVER (PARTITION BY k.fk ORDER BY k.seq) AS next_seq
            FROM {known} k JOIN credit_changes c ON c.credit_facility_id = k.fk AND c.seq = k.seq
            WHERE k.kind = 'c' AND {event} AND (k.apply_amount IS NULL OR k.reply_amount IS NULL)) t
      JOIN {known} g ON g.fk = t.fk AND g.seq > t.seq AND (t.next_seq IS NULL OR g.seq < t.next_seq)
       AND g.kind IN ('f', 'r') AND g.fseq IS NOT NULL AND g.reply_amount IS NOT NULL {in_time}
      GROUP BY t.fk, t.seq
    ) w JOIN {known} g ON g.fk = w.fk AND g.seq = w.emit_seq
  ) e JOIN credit_changes c ON c.credit_facility_id = e.fk AND c.seq = e.cseq"""


_CREDIT_EVENTS = {
    "dwd_credit_add": ("c.op IN ('r', 'c')", "c.id, c.create_time AS add_time"),
    "dwd_credit_occupy": ("c.credit_occupy_time IS NOT NULL", "c.id, c.credit_occupy_time AS occupy_time"),
    "dwd_lease_contract_produce": (
        "c.contract_produce_time IS NOT NULL",
        "coalesce(c.contract_id, 0) AS id, c.contract_produce_time AS produced_time, c.id AS credit_id"),
}
for _fact, (_event, _columns) in _CREDIT_EVENTS.items():
    CTES[f"replay_{_fact}"] = _replay_credit(_event, _columns)
    CTES[f"replay_ttl_{_fact}"] = _replay_credit(_event, _columns, ttl=True)
for _kind, _end in (("replay", ""), ("replay_ttl", "_ttl")):
    CTES[f"produce_in_order{_end}"] = CTES[f"{_kind}_dwd_lease_contract_produce"].replace(
        "SELECT coalesce", "SELECT e.emit_seq AS seq, coalesce", 1).replace(
        "SELECT k.fk, k.seq AS cseq,", "SELECT k.fk, k.seq AS cseq, k.seq AS emit_seq,").replace(
        "SELECT w.fk, w.seq,", "SELECT w.fk, w.seq, w.emit_seq,")

for _fact, _time in (("dwd_lease_sign", "signed_time"), ("dwd_lease_execution", "execution_time")):
    CTES[f"replay_{_fact}"] = f"""
  SELECT k.id, k.{_time}, k.credit_id, p.credit_facility_id, p.apply_amount, p.reply_amount,
         p.credit_amount
  FROM (
    SELECT k.seq, k.credit_id, max(p.seq) AS pseq
    FROM contract_changes k JOIN produce_in_order p ON p.credit_id = k.credit_id AND p.seq < k.seq
    WHERE k.{_time} IS NOT NULL GROUP BY k.seq, k.credit_id
    UNION ALL
    SELECT max(k.seq), k.credit_id, p.first_seq
    FROM contract_changes k
    JOIN (SELECT credit_id, min(seq) AS first_seq FROM produce_in_order GROUP BY credit_id) p
      ON p.credit_id = k.credit_id AND k.seq < p.first_seq
    WHERE k.{_time} IS NOT NULL GROUP BY k.credit_id, p.first_seq
  ) m
  JOIN contract_changes k ON k.credit_id = m.credit_id AND k.seq = m.seq
  JOIN produce_in_order p ON p.credit_id = m.credit_id AND p.seq = m.pseq"""
    CTES[f"replay_ttl_{_fact}"] = CTES[f"replay_{_fact}"].replace("produce_in_order", "produce_in_order_ttl")

# --- windows ------------------------------------------------------------------------------

_BUCKET = "time_bucket(INTERVAL '10 seconds', {t})"


def _bounds(t: str) -> str:
    b = _BUCKET.format(t=t)
    return f"{b} AS stt, {b} + INTERVAL '10 seconds' AS edt, {b}::DATE AS cur_date"


def _sums(columns: list[str]) -> str:
    return "count(*) AS apply_count, " + ", ".join(
        f"sum({c})::DECIMAL(19,2) AS {c}" for c in columns)


def _window_path(fact: str, time: str, amounts: list[str]) -> str:
    return f"""
  SELECT g.stt, g.edt, g.cur_date,
         i2.superior_industry_id AS industry1_id, i1.industry_name AS industry1_name,
         i3.superior_industry_id AS industry2_id, i2.industry_name AS industry2_name,
         g.industry_id AS industry3_id, i3.industry_name AS industry3_name,
         g.lease_organization, g.salesman_id, e.name AS salesman_name,
         d2.superior_department_id AS department1_id, d1.department_name AS department1_name,
         d3.superior_department_id AS department2_id, d2.department_name AS department2_name,
         e.department_id AS department3_id, d3.department_name AS department3_name,
         g.apply_count, {', '.join('g.' + a for a in amounts)}
  FROM (SELECT {_bounds(time)}, lease_organization, industry_id, salesman_id, {_sums(amounts)}
        FROM {fact} GROUP BY ALL) g
  LEFT JOIN industry i3 ON i3.id = g.industry_id
  LEFT JOIN industry i2 ON i2.id = i3.superior_industry_id
  LEFT JOIN industry i1 ON i1.id = i2.superior_industry_id
  LEFT JOIN employee e ON e.id = g.salesman_id
  LEFT JOIN department d3 ON d3.id = e.department_id
  LEFT JOIN department d2 ON d2.id = d3.superior_department_id
  LEFT JOIN department d1 ON d1.id = d2.superior_department_id"""


def _window_auditor(fact: str, time: str, amounts: list[str]) -> str:
    return f"""
  SELECT g.stt, g.edt, g.cur_date, g.audit_man_id, e.name AS audit_man_name, g.apply_count,
         {', '.join('g.' + a for a in amounts)}
  FROM (SELECT {_bounds(time)}, audit_man_id, {_sums(amounts)}
        FROM {fact} WHERE audit_man_id IS NOT NULL GROUP BY ALL) g
  LEFT JOIN employee e ON e.id = g.audit_man_id"""


_APPLY, _REPLY = ["apply_amount"], ["apply_amount", "reply_amount"]
_CREDIT = ["apply_amount", "reply_amount", "credit_amount"]
WINDOWS: dict[str, str] = {}
for _fact, _time, _suffix, _amounts in (
        ("dwd_audit_approve", "approve_time", "approval", _REPLY),
        ("dwd_audit_cancel", "cancel_time", "cancel", _APPLY),
        ("dwd_audit_reject", "reject_time", "reject", _APPLY)):
    WINDOWS[f"dws_audit_industry_lease_organization_salesman_{_suffix}_win"] = _window_path(
        _fact, _time, _amounts)
    WINDOWS[f"dws_audit_audit_man_{_suffix}_win"] = _window_auditor(_fact, _time, _amounts)
for _name, _fact, _time in (
        ("dws_credit_credit_add_win", "dwd_credit_add", "add_time"),
        ("dws_credit_credit_occupy_win", "dwd_credit_occupy", "occupy_time"),
        ("dws_lease_contract_produce_win", "dwd_lease_contract_produce", "produced_time"),
        ("dws_lease_sign_win", "dwd_lease_sign", "signed_time"),
        ("dws_lease_execution_win", "dwd_lease_execution", "execution_time")):
    WINDOWS[_name] = f"\n  SELECT {_bounds(_time)}, {_sums(_CREDIT)} FROM {_fact} GROUP BY ALL"
CTES.update(WINDOWS)

# --- summaries ------------------------------------------------------------------------------

_OUTCOMES = {"approve": "dwd_audit_approve", "cancel": "dwd_audit_cancel",
             "reject": "dwd_audit_reject"}
_FUNNEL = {"credit_add": "dwd_credit_add", "credit_occupy": "dwd_credit_occupy",
           "contract_produce": "dwd_lease_contract_produce", "lease_sign": "dwd_lease_sign",
           "lease_execution": "dwd_lease_execution"}


def _view(keys: dict[str, str], joins: str = "") -> str:
    parts = []
    selected = "".join(f"{expr} AS {name}, " for name, expr in keys.items())
    grouped = f"GROUP BY {', '.join(keys.values())}" if keys else ""
    for outcome, fact in _OUTCOMES.items():
        reply = ("sum(a.reply_amount)::DECIMAL(29,2)" if outcome == "approve"
                 else "CAST(NULL AS DECIMAL(29,2))")
        parts.append(f"""
  SELECT {selected}'{outcome}' AS audit_result, count(*) AS project_count,
         sum(a.apply_amount)::DECIMAL(29,2) AS apply_amount, {reply} AS reply_amount
  FROM {fact} a {joins} {grouped}""")
    return "\n  UNION ALL".join(parts)


def _path_keys(prefix: str, alias: str) -> dict[str, str]:
    return {f"{prefix}{n}_{c}": f"{alias}{n}.{'id' if c == 'id' else prefix + '_name'}"
            for n in (3, 2, 1) for c in ("id", "name")}


_DEPT_JOIN = """LEFT JOIN employee e ON e.id = a.salesman_id
  LEFT JOIN department d3 ON d3.id = e.department_id
  LEFT JOIN department d2 ON d2.id = d3.superior_department_id
  LEFT JOIN department d1 ON d1.id = d2.superior_department_id"""
_IND_JOIN = """LEFT JOIN industry i3 ON i3.id = a.industry_id
  LEFT JOIN industry i2 ON i2.id = i3.superior_industry_id
  LEFT JOIN industry i1 ON i1.id = i2.superior_industry_id"""

SUMMARIES = {
    "mv_ads_audit_result_summary": _view({}),
    "mv_ads_audit_result_org": _view({"lease_organization": "a.lease_organization"}),
    "mv_ads_audit_result_dept": _view(_path_keys("department", "d"), _DEPT_JOIN),
    "mv_ads_audit_result_salesman": _view(
        {"salesman_id": "a.salesman_id", "salesman_name": "e.name"},
        "LEFT JOIN employee e ON e.id = a.salesman_id"),
    "mv_ads_audit_result_audit_man": _view(
        {"audit_man_id": "a.audit_man_id", "audit_man_name": "e.name"},
        "LEFT JOIN employee e ON e.id = a.audit_man_id"),
    "mv_ads_audit_result_industry": _view(_path_keys("industry", "i"), _IND_JOIN),
    "mv_ads_credit_transform": "\n  UNION ALL".join(f"""
  SELECT '{step}' AS transform_step, count(*) AS project_count,
         sum(apply_amount)::DECIMAL(29,2) AS apply_amount,
         sum(reply_amount)::DECIMAL(29,2) AS reply_amount,
         sum(credit_amount)::DECIMAL(29,2) AS credit_amount
  FROM {fact}""" for step, fact in _FUNNEL.items()),
}
CTES.update(SUMMARIES)


def with_ctes(body: str) -> str:
    """Prefix a query with the CTEs it (transitively) mentions, in definition order."""
    needed: set[str] = set()
    queue = [body]
    while queue:
        text = queue.pop()
        for word in set(re.findall(r"[a-z_0-9]+", text)):
            if word in CTES and word not in needed:
                needed.add(word)
                queue.append(CTES[word])
    if not needed:
        return body
    clauses = ",\n".join(f"{name} AS ({CTES[name]}\n)" for name in CTES if name in needed)
    return f"WITH {clauses}\n{body}"
