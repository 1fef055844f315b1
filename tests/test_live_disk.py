"""What the live facts leave on disk: packed logs, topics and states, short rows, a batch stored once."""

from __future__ import annotations

import gzip
import random
import zipfile

from pyspark.sql import functions as F

from leaseflow import schemas as S
from leaseflow.plans import stored as SD
from leaseflow.sources import changes as C
from leaseflow.sources import tables as ST
from leaseflow.streaming import facts as SF
from leaseflow.streaming import rules
from tests import traces as TR
from tests.test_lifecycle import random_trace
from tests.test_streaming import ONCE, read_all, wait


def plain(files):
    """Bytes on disk, and the lines of each file."""
    return sum(f.stat().st_size for f in files), [gzip.open(f).read().splitlines() for f in files]


def traces(seed, keys):
    rng = random.Random(seed)
    return TR.parse({key: random_trace(rng) for key in keys})


def logs(spark, rows):
    return {table: df.select(F.col("seq").alias("arrival"), C.to_envelope(df, table).alias("value"))
            for table, df in TR.frames(spark, rows).items()}


def test_logs_are_packed_in_files_that_a_task_can_read(spark, tmp_path, monkeypatch):
    spark.range(4000).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"),
        F.element_at(F.array(*map(F.lit, "FOP")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"),
        (F.col("id") * 1.25).alias("o_totalprice"), F.expr("timestamp_ntz'1995-03-04 00:00:00'").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority")).repartition(2).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(SD, "TASK_ROWS", 600)
    monkeypatch.setattr(C, "FILES_PER_BATCH", 3)
    rows = SD._write_logs(spark, str(tmp_path), str(tmp_path / "in"))
    for table, n in rows.items():
        files = list((tmp_path / "in" / table).glob("part-*"))
        stored, lines = plain(files)
        assert stored * 4 < sum(len(line) + 1 for part in lines for line in part)
        assert max(map(len, lines)) <= 600 and sum(map(len, lines)) == n
        # What one micro-batch is given.
        assert len(files) <= C.FILES_PER_BATCH + n // SD.TASK_ROWS
        written, whole = C.read_log(spark, str(tmp_path / "in" / table)), SD._log(spark, str(tmp_path), table)
        assert written.exceptAll(whole).count() == 0 and whole.exceptAll(written).count() == 0


def test_topics_are_packed(spark, tmp_path):
    rows = spark.range(2000).select(
        F.col("id").alias("arrival"), F.format_string('{"id":%d,"name":null}', "id").alias("value"),
        F.col("id").cast("string").alias("key"), F.lit("t").alias("topic"))
    ST.file_topics(str(tmp_path))(rows, 0)
    stored, lines = plain(list((tmp_path / "topic=t").glob("*/part-*")))
    assert stored * 4 < sum(len(line) + 1 for part in lines for line in part)
    back = spark.read.schema("arrival bigint, value string, key string").json(
        str(tmp_path / "topic=t"), recursiveFileLookup=True)
    assert sorted(back.collect()) == sorted(rows.drop("topic").collect())


def test_tasks_read_packed_files_of_few_rows(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    with SD._state_tasks(spark, 10):
        assert spark.conf.get(name) == str(SD.PACKED_TASK)
    assert spark.conf.get(name) == before


def test_a_micro_batch_lies_once_while_it_is_written(spark, tmp_path, monkeypatch):
    """And what it is made from runs once, though the batch is let go before."""
    kept, made = [], spark.sparkContext.accumulator(0)
    persisted = spark.sparkContext._jsc.getPersistentRDDs

    def counted(rows):
        for row in rows:
            made.add(1)
            yield row

    monkeypatch.setattr(ST, "append_fact_by_day", lambda rows, *_: kept.append((rows.count(), persisted().size())))
    rows = [{"fact_type": f, "seq": n, "id": n} for n, f in enumerate(SF.STAGE_ONE * 5)]
    schema = SF.output_schema(SF.STAGE_ONE)
    batch = spark.createDataFrame(spark.sparkContext.parallelize(
        [tuple(row.get(c) for c in schema.names) for row in rows], 3).mapPartitions(counted), schema)
    before = persisted().size()
    SF.dual_write(SF.STAGE_ONE, str(tmp_path), lambda sent, _: kept.append((sent.count(), persisted().size())),
                  "w")(batch, 0)
    assert sorted(kept) == [(5, before + 1)] * len(SF.STAGE_ONE) + [(len(rows), before + 1)]
    assert made.value == len(rows) and persisted().size() == before


def test_rows_carry_what_the_rules_read(spark):
    class Seen(dict):
        def __getitem__(self, name):
            read.add(name)
            return super().__getitem__(name)

    rows = traces(11, range(60))
    sent = SF.facility_rows(logs(spark, rows)).collect()
    for kind, columns in rules.READ.items():
        of_kind = [row.asDict() for row in sent if row["kind"] == kind]
        assert of_kind and not any(row[c] is not None for row in of_kind for c in row
                                   if c not in (*columns, "credit_facility_id", "seq", "kind"))
        read: set[str] = set()
        for row in of_kind:
            known = {"facility": dict.fromkeys(rules.FACILITY_FIELDS, 1), "auditor": {"employee_id": 1},
                     "reply": dict.fromkeys(rules.REPLY_FIELDS, 1)}
            for waiting in ({}, known):
                list(rules.facility_row(waiting, Seen(row)))
        assert read - {"kind"} == set(columns)


def test_packed_states_give_the_same_facts(spark, tmp_path):
    rows = traces(12, [*range(-3, 30), 2 ** 45])
    for table, log in logs(spark, rows).items():
        log.write.options(**ST.PACKED).json(str(tmp_path / "in" / table))
    given = {t: C.stream_log(spark, str(tmp_path / "in" / t)) for t in S.FACILITY_TABLES}
    wait(SF.start(SF.stage_one(SF.facility_rows(given), ttl_ms=None), SF.STAGE_ONE, str(tmp_path / "dwd"),
                  ST.file_topics(str(tmp_path / "topics")), str(tmp_path / "check"), ONCE))
    expected = TR.run_rules(rows)
    for fact in SF.STAGE_ONE:
        assert TR.canonical(read_all(spark, tmp_path / "dwd", fact).collect()) == TR.canonical(expected[fact])
    options = [archive.read(name).decode() for path in (tmp_path / "check" / "state").rglob("*.zip")
               for archive in [zipfile.ZipFile(path)] for name in archive.namelist() if "OPTIONS" in name]
    assert options and all("compression=kZSTD" in text for text in options)
