"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default the sf0.1 tables) and ``BENCH_CPUS`` (default 8) select data
and cores; names on the command line select queries.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

from leaseflow.plans.catalog import QUERIES
from leaseflow.session import local_session

HEADLINE = [
    "dwd_audit_approve", "dwd_audit_reject", "dwd_credit_add", "dwd_lease_contract_produce",
    "dwd_lease_sign", "dwd_lease_execution",
    "replay_dwd_audit_approve", "replay_dwd_credit_occupy", "replay_dwd_lease_execution",
    "dws_audit_industry_lease_organization_salesman_approval_win",
    "dws_audit_audit_man_reject_win", "dws_credit_credit_add_win", "dws_lease_execution_win",
    "mv_ads_audit_result_summary", "mv_ads_audit_result_org", "mv_ads_audit_result_dept",
    "mv_ads_audit_result_salesman", "mv_ads_audit_result_audit_man",
    "mv_ads_audit_result_industry", "mv_ads_credit_transform", "conversion_rates",
    "dim_business_partner", "dim_employee", "decode_credit_facility", "enrich_hierarchy_pointer",
]


def measure(spark, sf_dir: str, name: str) -> float:
    """Seconds from building the query to its last row, all columns computed."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def stored_load(spark, sf_dir: str) -> float:
    """Seconds of a log loaded in two batches, the second one twice."""
    from leaseflow.plans import stored
    start = time.perf_counter()
    stored.two_batches(spark, sf_dir, "dwd_audit_approve").count()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    with contextlib.redirect_stdout(sys.stderr):
        spark = local_session(cpus, "leaseflow-bench", **{"spark.sql.shuffle.partitions": cpus})
        for warm in ("mv_ads_audit_result_dept", "replay_dwd_audit_cancel"):
            measure(spark, sf_dir, warm)
        times = {name: round(measure(spark, sf_dir, name), 3) for name in names}
        load = None if sys.argv[1:] else round(stored_load(spark, sf_dir), 3)
        spark.stop()
    print(json.dumps({
        "metric": "leaseflow headline queries, total wall time",
        "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "stored_load_sec": load, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
