"""Change-log parsing rules and the stored tables: idempotent batches, latest per key,
retention, refresh."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from leaseflow import schemas as S
from leaseflow.functions import fields as X
from leaseflow.operators import dimensions as DIM
from leaseflow.operators import windows as W
from leaseflow.sources import changes as C
from leaseflow.sources import tables as ST
from tests import traces as TR

FACILITY = ('{"source":{"db":"lease","table":"credit_facility"},"op":"c",'
            '"after":{"id":12,"credit_amount":"Ew==","extra":[1]}}')


def log(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), C.LOG_SCHEMA)


def test_topics(spark):
    values = [FACILITY, "junk", "{}", '{"source":{}}', '{"source":{"table":null}}', None]
    got = [r.topic for r in C.route_by_table(log(spark, *values)).orderBy("arrival").collect()]
    assert got == ["ods_credit_facility"] + ["ods_unknown_table"] * 5


def test_envelopes_that_fail_are_dropped(spark):
    values = [FACILITY, "junk", '{"op":"c","after":{"id":1}}', '{"source":{"table":"x"},"after":{}}',
              '{"source":{"table":"credit_facility"},"op":"d","after":null}']
    rows = C.parse_envelope(log(spark, *values), "credit_facility")
    assert sorted(r.arrival for r in rows.collect()) == [0, 4]
    assert [r.arrival for r in C.drop_deletes(rows).collect()] == [0]


def test_decoding_defaults(spark):
    row = C.decode_table(log(spark, FACILITY), "credit_facility").first()
    assert row.credit_amount == Decimal("0.19")
    assert (row.industry_id, row.salesman_id, row.business_partner_id) == (0, 0, 0)
    assert row.lease_organization is None and row.op == "c"


def test_op_code(spark):
    got = [r[0] for r in log(spark, FACILITY, "junk", "{}").select(C.op_code()).collect()]
    assert got == ["c", None, None]


def test_dimension_rows_need_image_and_id(spark):
    head = '{"source":{"table":"employee"},'
    values = [head + '"op":"c","after":{"id":1,"name":"a"}}', head + '"op":"d","after":{"id":1}}',
              head + '"op":"u","after":null}', head + '"op":"u","after":{"name":"b"}}']
    got = DIM.dimension_changes(log(spark, *values), "employee").collect()
    assert [(r.id, r.name) for r in got] == [(1, "a")]


def test_dimension_rows_may_lack_operation_and_source(spark):
    values = ['{"source":{"table":"employee"},"after":{"id":1,"name":"a"}}',
              '{"op":"c","after":{"id":2,"name":"b"}}',
              '{"op":"c","source":{"table":"industry"},"after":{"id":3,"name":"c"}}']
    got = DIM.dimension_changes(log(spark, *values), "employee").collect()
    assert sorted((r.id, r.name) for r in got) == [(1, "a"), (2, "b")]


def test_message_keys(spark):
    head = '{"source":{"table":"%s"},"after":{"id":1,"credit_facility_id":2,"credit_id":3}}'
    tables = ["credit_facility", "reply", "contract", "employee"]
    rows = log(spark, *[head % t for t in tables], "junk").orderBy("arrival")
    assert [r[0] for r in rows.select(C.message_key()).collect()] == ["1", "2", "3", "1", None]


def test_topic_order_is_time_then_offset(spark):
    """Only what a topic gives: key, value, offset, timestamp. Offsets of two topics differ
    in scale; the order of the messages does not follow them."""
    rows = spark.createDataFrame(
        [("late", 1, dt.datetime(2024, 1, 1, 0, 0, 2)), ("early", 900, dt.datetime(2024, 1, 1)),
         ("next", 901, dt.datetime(2024, 1, 1))], "value string, offset bigint, timestamp timestamp")
    got = C.topic_rows(rows).orderBy(C.arrival_order("contract")).collect()
    assert [r.value for r in got] == ["early", "next", "late"]


def test_tables_by_pattern(spark):
    values = [FACILITY, FACILITY.replace('"lease"', '"other"')]
    assert C.of_tables(log(spark, *values), r"lease\..*").count() == 1


def test_snapshot_before_changes(spark):
    both = C.snapshot_then_changes(log(spark, "a", "b"), log(spark, "c"))
    order = [r.value for r in both.orderBy("phase", "arrival").collect()]
    assert order == ["a", "b", "c"]


def test_snapshot_comes_first_in_lifecycle_order(spark):
    """Snapshot rows and changes are numbered from zero each; the snapshot is replayed first."""
    from leaseflow.operators import replay as R
    rows = TR.frames(spark, TR.parse({1: "S16 F A7 R"}))
    logs = {t: df.select(F.col("seq").alias("arrival"), C.to_envelope(df, t).alias("value"))
            for t, df in rows.items()}
    changed = {"credit_facility_status"}

    def seen(log, table, changes):
        nothing = log.limit(0)
        return C.ordered_changes(C.snapshot_then_changes(nothing if changes else log,
                                                         log if changes else nothing), table)

    changes = {t: seen(log, t, t in changed) for t, log in logs.items()}
    assert changes["reply"].agg(F.max("seq")).first()[0] < 0
    fact = R.stage_one_fact(changes, "dwd_audit_approve", None, keep_order=True).collect()
    # By plain arrival the reply would come last and emit; now the auditor's row does.
    last = changes["credit_facility_status"].agg(F.max("seq")).first()[0]
    assert [r.seq for r in fact] == [last]


def test_split_by_table(spark):
    rows = spark.createDataFrame([("contract",), ("credit",), ("reply",)], "table_name string")
    contract, others = C.split_by_table(rows, "contract")
    assert (contract.count(), others.count()) == (1, 2)


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, Decimal("2.50"))], "id bigint, n string, a decimal(19,2)")
    assert df.select(X.to_json_row(["id", "n", "a"], text=("a",))).first()[0] == \
        '{"id":1,"n":null,"a":"2.50"}'


def test_fact_json_ignores_unknown_fields(spark):
    text = ('{"id":3,"add_time":"2024-01-01 00:00:01.500000","apply_amount":"1.25","what":{},'
            '"reply_amount":null}')
    row = X.read_fact_json(log(spark, text), "dwd_credit_add").first()
    assert row.add_time == dt.datetime(2024, 1, 1, 0, 0, 1, 500000)
    assert (row.apply_amount, row.reply_amount) == (Decimal("1.25"), None)


# --- stored tables ---------------------------------------------------------------

def facts(spark, *rows):
    schema = S.FACTS["dwd_credit_add"]
    full = [(i, TR.at(s), 1, Decimal(a), None, None) for i, s, a in rows]
    return spark.createDataFrame(full, schema)


def test_fact_load_keeps_duplicates_and_is_idempotent(spark, tmp_path):
    path, schema = str(tmp_path / "t"), S.FACTS["dwd_credit_add"]
    assert ST.read_facts(spark, path, schema).count() == 0
    ST.append_fact_by_day(facts(spark, (1, 0, 5), (1, 0, 5)), path, "add_time", ST.Batch("t", 0))
    ST.append_fact_by_day(facts(spark, (1, 0, 5), (2, 86400, 6)), path, "add_time", ST.Batch("t", 1))
    ST.append_fact_by_day(facts(spark, (1, 0, 5), (2, 86400, 6)), path, "add_time", ST.Batch("t", 1))  # retried
    stored = ST.read_facts(spark, path, schema)
    assert stored.count() == 4
    day = stored.filter(F.col("dt") == dt.date(2024, 1, 2))
    assert [r.id for r in day.collect()] == [2]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "dt" in plan.split("PartitionFilters", 1)[1][:80]


def test_writers_do_not_overwrite_each_other(spark, tmp_path):
    path, schema = str(tmp_path / "t"), S.FACTS["dwd_credit_add"]
    ST.append_fact_by_day(facts(spark, (1, 0, 5)), path, "add_time", ST.Batch("a", 0))
    ST.append_fact_by_day(facts(spark, (2, 0, 5)), path, "add_time", ST.Batch("b", 0))
    assert sorted(r.id for r in ST.read_facts(spark, path, schema).collect()) == [1, 2]
    assert ST.stream_writer("/one") != ST.stream_writer("/two")


def test_undated_rows_stay_unless_asked(spark, tmp_path):
    path, schema = str(tmp_path / "t"), S.FACTS["dwd_credit_add"]
    rows = facts(spark, (1, 0, 5), (2, 40 * 86400, 5)).unionByName(
        facts(spark, (3, 0, 6)).withColumn("add_time", F.lit(None).cast("timestamp_ntz")))
    ST.append_fact_by_day(rows, path, "add_time", ST.Batch("a", 0))
    as_of = TR.T0.date()
    stored = ST.read_facts(spark, path, schema)
    assert sorted(r.id for r in ST.retain_days(stored, as_of, ST.FACT_DAYS).collect()) == [1, 3]
    assert [r.id for r in ST.retain_days(stored, as_of, ST.FACT_DAYS, keep_undated=False).collect()] == [1]
    assert len(ST.drop_expired_folders(spark, path, as_of, ST.FACT_DAYS)) == 1
    assert sorted(r.id for r in ST.read_facts(spark, path, schema).collect()) == [1, 3]
    ST.drop_expired_folders(spark, path, as_of, ST.FACT_DAYS, keep_undated=False)
    assert [r.id for r in ST.read_facts(spark, path, schema).collect()] == [1]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from leaseflow import session
    other = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                            sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(other)
    other.sparkContext.master = "local[2]"
    assert session.checkpoint_root(other)


def test_rows_without_a_key_are_counted(spark):
    from leaseflow.operators import replay as R
    rows = TR.frames(spark, TR.parse({1: "F A7 R S16"}))
    rows["reply"] = rows["reply"].unionByName(
        rows["reply"].withColumn("credit_facility_id", F.lit(None).cast("bigint")))
    got = {r.table_name: r.row_count for r in R.keyless_rows(rows).collect()}
    assert got["reply"] == 1 and sum(got.values()) == 1


def test_window_rows_are_replaced_not_summed(spark, tmp_path):
    name, path = "dws_audit_audit_man_reject_win", str(tmp_path / "w")
    spec = W.SPECS[name]
    schema = ("stt timestamp_ntz, edt timestamp_ntz, cur_date date, audit_man_id bigint, "
              "audit_man_name string, apply_count bigint, apply_amount decimal(19,2)")

    def rows(*items):
        return spark.createDataFrame(
            [(TR.at(0), TR.at(10), TR.T0.date(), m, n, c, Decimal(c)) for m, n, c in items], schema)

    ST.replace_aggregate(rows((1, "a", 2), (2, None, 3)), path, ST.Batch("t", 0))
    ST.replace_aggregate(rows((1, "a", 7), (2, "b", 3)), path, ST.Batch("t", 1))
    ST.replace_aggregate(rows((1, "a", 7), (2, "b", 3)), path, ST.Batch("t", 1))
    got = ST.read_windows(spark, path, rows().schema, spec.table_key).collect()
    # The same key is replaced; a name that arrived late makes a second row.
    assert sorted((r.audit_man_id, str(r.audit_man_name), r.apply_count) for r in got) == [
        (1, "a", 7), (2, "None", 3), (2, "b", 3)]


def test_upsert_by_batch_then_arrival(spark, tmp_path):
    path, schema = str(tmp_path / "d"), S.raw_schema("business_partner")

    def rows(*items):
        return spark.createDataFrame([(i, TR.at(0), TR.at(0), n, a) for i, n, a in items],
                                     "id bigint, create_time timestamp_ntz, "
                                     "update_time timestamp_ntz, name string, arrival bigint")

    ST.upsert_dimension(rows((1, "a", 5), (1, "b", 9), (2, "x", 1)), path, ST.Batch("t", 0))
    ST.upsert_dimension(rows((1, "c", 2)), path, ST.Batch("t", 1))
    got = {r.id: r.name for r in ST.read_dimension(spark, path, schema).collect()}
    assert got == {1: "c", 2: "x"}
    with_order = S.T.StructType([*schema.fields, S.T.StructField("arrival", S.T.LongType())])
    ST.fold(spark, path, with_order, ["id"], ["arrival"])
    assert {r.id: r.name for r in ST.read_dimension(spark, path, schema).collect()} == got
    assert ST.read_batches(spark, path, with_order).count() == 2
    ST.upsert_dimension(rows((2, "y", 0)), path, ST.Batch("t", 2))
    got[2] = "y"
    assert {r.id: r.name for r in ST.read_dimension(spark, path, schema).collect()} == got
    ST.compact(ST.read_dimension(spark, path, schema).withColumn("arrival", F.lit(0).cast("bigint")),
               str(tmp_path / "d2"), ST.Batch("t", 1))
    again = ST.read_dimension(spark, str(tmp_path / "d2"), schema)
    assert {r.id: r.name for r in again.collect()} == got


def test_upsert_keeps_null_keys_apart_from_nothing(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, 1, "c")],
                               "k bigint, seq bigint, v string")
    got = DIM.upsert_latest(df, ["k"], ["seq"]).collect()
    assert sorted((str(r.k), r.v) for r in got) == [("1", "c"), ("None", "b")]


def test_retention(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-03-31')) AS dt")
    kept = ST.retain_days(days, dt.date(2024, 2, 15), ST.FACT_DAYS)
    row = kept.agg(F.min("dt"), F.max("dt"), F.count("*")).first()
    assert tuple(row) == (dt.date(2024, 1, 16), dt.date(2024, 2, 18), 34)


def test_drop_expired_partitions(spark):
    spark.sql("DROP TABLE IF EXISTS facts_by_day")
    days = spark.sql("SELECT id, date_add(date'2024-02-15', cast(id - 60 AS int)) AS dt "
                     "FROM range(0, 70)")
    days.write.partitionBy("dt").saveAsTable("facts_by_day")
    dropped = ST.drop_expired_days(spark, "facts_by_day", dt.date(2024, 2, 15), ST.FACT_DAYS)
    left = spark.table("facts_by_day").agg(F.min("dt"), F.max("dt"), F.count("*")).first()
    assert tuple(left) == (dt.date(2024, 1, 16), dt.date(2024, 2, 18), 34)
    assert len(dropped) == 36
    spark.sql("DROP TABLE facts_by_day")


def test_refresh_overwrites(spark, tmp_path):
    path = str(tmp_path / "v")
    ST.refresh_view(lambda: spark.range(5), path)
    ST.refresh_view(lambda: spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


# --- windows and summaries on edge rows ------------------------------------------------

def test_missing_event_time(spark):
    spec = W.SPECS["dws_credit_credit_add_win"]
    df = facts(spark, (1, 0, 5)).unionByName(
        facts(spark, (2, 0, 6)).withColumn("add_time", F.lit(None).cast("timestamp_ntz")))
    name = "dws_credit_credit_add_win"
    assert [r.apply_count for r in W.window_table(name, df, {}).collect()] == [1]
    both = {str(r.cur_date): r.apply_amount for r in W.window_table(name, df, {}, epoch0=True).collect()}
    assert both == {"2024-01-01": Decimal(5), "1970-01-01": Decimal(6)}
    assert W.missing_time_count(df, spec).first().missing_time == 1


def test_null_amounts_are_skipped_in_sums(spark):
    row = W.window_table("dws_credit_credit_add_win", facts(spark, (1, 0, 5), (2, 1, 6)), {}).first()
    assert (row.apply_count, row.apply_amount, row.reply_amount) == (2, Decimal(11), None)


def test_summaries_of_nothing(spark):
    from leaseflow.operators import summaries as M
    empty = {f: spark.createDataFrame([], s) for f, s in S.FACTS.items()}
    rows = M.audit_result_summary(empty).collect()
    assert sorted((r.audit_result, r.project_count, r.apply_amount) for r in rows) == [
        ("approve", 0, None), ("cancel", 0, None), ("reject", 0, None)]
    assert [r.project_count for r in M.credit_transform(empty).collect()] == [0] * 5
    assert [r.rate_of_first for r in M.conversion_rates(M.credit_transform(empty)).collect()] == \
        [None] * 5


@pytest.mark.parametrize("rule,second,first", [("pointer", 20, None), ("joined", None, None)])
def test_missing_parent(spark, rule, second, first):
    from leaseflow.operators import enrich as E
    dim = spark.createDataFrame([(30, "leaf", 20), (10, "top", None)],
                                "id bigint, industry_name string, superior_industry_id bigint")
    facts_ = spark.createDataFrame([(30,), (99,)], "industry_id bigint")
    got = {r.industry_id: r for r in E.with_industry(facts_, dim, rule).collect()}
    assert (got[30].industry3_id, got[30].industry3_name) == (30, "leaf")
    assert (got[30].industry2_id, got[30].industry1_id) == (second, first)
    assert got[99].industry3_id == (99 if rule == "pointer" else None)
