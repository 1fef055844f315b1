"""Windows of a batch: only touched groups are written, retries take their sums back."""

from __future__ import annotations

from pyspark.sql import functions as F

from leaseflow import schemas as S
from leaseflow.operators import replay as R
from leaseflow.operators import windows as W
from leaseflow.plans.warehouse import Warehouse
from leaseflow.sources import tables as ST
from tests import traces as TR

FACT, NAME = "dwd_credit_add", "dws_credit_credit_add_win"


def send(house, number, ids, seconds=lambda i: i):
    rows = house.spark.createDataFrame([(i, seconds(i)) for i in ids], "n bigint, s int")
    made = {"id": F.col("n"), S.FACT_TIME[FACT]: F.expr("timestampadd(SECOND, s, timestamp_ntz'2024-05-01 00:00:00')")}
    facts = rows.select(*[made.get(f.name, F.lit(1)).cast(f.dataType).alias(f.name) for f in S.FACTS[FACT].fields],
                        F.lit(None).cast("bigint").alias(R.ORDER))
    ST.append_fact_by_day(facts, f"{house.root}/dwd/{FACT}", S.FACT_TIME[FACT], ST.Batch("w", number))
    house.load_touched_windows(number, [NAME], {})


def counts(house):
    return {r["stt"].minute * 60 + r["stt"].second: r["apply_count"] for r in house.touched_window(NAME).collect()}


def written(house, number):
    """Rows of one batch in the window table."""
    table = house.touched_table(NAME)
    return table.rows(house.window_schema(NAME)).filter(F.col(ST.BATCH) == number).count()


def test_only_touched_windows_are_written(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"), "w")
    send(house, 0, range(100))
    assert counts(house) == {10 * k: 10 for k in range(10)}
    send(house, 1, [200], lambda _: 35)
    assert counts(house) == {10 * k: 10 + (k == 3) for k in range(10)}
    assert written(house, 1) == 1


def test_a_retry_takes_its_sums_back(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"), "w")
    send(house, 0, range(20))
    send(house, 1, [100, 101, 102], lambda i: i - 90)
    send(house, 1, [100], lambda _: 500)  # a corrected second attempt
    assert counts(house) == {0: 10, 10: 10, 500: 1}
    send(house, 1, [])
    assert counts(house) == {0: 10, 10: 10}


def test_batches_equal_one_computation(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"), "w")
    for number in range(4):
        send(house, number, range(number, 300, 4), lambda i: i * 7 % 100)
    stored = house.touched_window(NAME)
    whole = W.window_table(NAME, house.fact(FACT), {})
    assert TR.canonical(stored.collect()) == TR.canonical(whole.select(*stored.columns).collect())
    house.touched_table(NAME).fold(house.window_schema(NAME), W.SPECS[NAME].table_key)
    assert TR.canonical(house.touched_window(NAME).collect()) == TR.canonical(whole.select(*stored.columns).collect())


def test_facts_of_older_batches_are_not_read(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"), "w")
    send(house, 0, range(50))
    own = house._marked(house._stored_facts(FACT), 1).filter("_mine")
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "batch_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
