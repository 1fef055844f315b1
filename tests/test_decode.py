"""Scalar decoding against values worked out by hand or with Python integers."""

from __future__ import annotations

import base64
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from leaseflow.functions import decode as D


def b64(n: int, size: int | None = None) -> str:
    size = size or (~n if n < 0 else n).bit_length() // 8 + 1
    return base64.b64encode(n.to_bytes(size, "big", signed=True)).decode()


CASES = [0, 19, -1, 127, 128, -128, -129, 255, 256, 65535, 10**15, -(10**15), 2**63 - 1, -(2**63),
         9999999999999999999, -9999999999999999999]


def test_decimal_golden(spark):
    rows = [(b64(n), Decimal(n)) for n in CASES]
    rows += [(b64(19, 9), Decimal(19)), (b64(-5, 12), Decimal(-5)), (b64(7, 16), Decimal(7)),
             (b64(19, 17), Decimal(19)), (b64(-19, 24), Decimal(-19)), (b64(0, 40), Decimal(0))]
    df = spark.createDataFrame(rows, "b string, n decimal(38,0)")
    for r in df.select("n", D.decode_decimal("b").alias("v")).collect():
        assert r.v == Decimal(int(r.n)).scaleb(-2)
    assert b64(19) == "Ew=="


@pytest.mark.parametrize("text", ["***", "", None, b64(10**30), b64(10**37), b64(2**127 - 1),
                                  b64(10**40, 17)])
def test_decimal_unreadable_is_null(spark, text):
    df = spark.createDataFrame([(text,)], "b string")
    assert df.select(D.decode_decimal("b").alias("v")).first().v is None


def test_encoding_round_trip(spark):
    """Shortest form of every value the column type holds, above 8 bytes too."""
    df = spark.createDataFrame([(Decimal(n).scaleb(-2),) for n in CASES], "v decimal(19,2)")
    for r in df.select("v", D.encode_decimal("v").alias("b"),
                       D.decode_decimal(D.encode_decimal("v")).alias("again")).collect():
        assert r.again == r.v
        assert r.b == b64(int(r.v.scaleb(2)))


@pytest.mark.parametrize("scale", [0, 1, 4])
def test_decimal_scale(spark, scale):
    df = spark.createDataFrame([(b64(-12345),)], "b string")
    got = df.select(D.decode_decimal("b", scale).alias("v")).first().v
    assert got == Decimal(-12345).scaleb(-scale)


def test_encode_is_shortest_and_inverse(spark):
    values = [Decimal(n).scaleb(-2) for n in (0, 19, -1, 127, 128, -128, -129, 10**17, -(10**17))]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(19,2)")
    for r in df.select("v", D.encode_decimal("v").alias("b")).collect():
        assert r.b == b64(int(r.v.scaleb(2)))


def test_wall_times(spark):
    df = spark.createDataFrame([(1700000000123456,), (None,), (-1,)], "us bigint")
    got = [tuple(r) for r in df.select(
        D.micros_to_wall("us"), D.wall_text(D.micros_to_wall("us")),
        D.wall_to_micros(D.micros_to_wall("us"))).collect()]
    assert got[0] == (dt.datetime(2023, 11, 15, 6, 13, 20, 123456), "2023-11-15 06:13:20.123456",
                      1700000000123456)
    assert got[1] == (None, None, None)
    assert got[2][0] == dt.datetime(1970, 1, 1, 7, 59, 59, 999999)


def test_wall_to_millis(spark):
    texts = ["2023-11-15 06:13:20.123999", "2023-11-15 06:13:20", "2023-13-45 06:13:20.000000",
             "junk", None, "1970-01-01 07:59:59.999999"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(D.wall_to_millis("s")).collect()]
    assert got == [1700000000123, None, None, None, None, -1]


def test_window_text(spark):
    row = spark.range(1).select(D.window_time(F.lit(1700000000123)).alias("t"),
                                D.window_date(F.lit(1700000000123)).alias("d"),
                                D.window_time(F.lit(None).cast("bigint")).alias("n")).first()
    assert tuple(row) == ("2023-11-15 06:13:20", dt.date(2023, 11, 15), None)


def test_summer_time_years_differ_by_parser(spark):
    """Formatting follows the region, parsing the fixed offset: 1988 shows the hour."""
    row = spark.createDataFrame([(583_977_600_000_000,)], "us bigint").select(
        D.wall_to_millis(D.wall_text(D.micros_to_wall("us"))).alias("ms")).first()
    assert row.ms - 583_977_600_000 == 3_600_000


@pytest.mark.parametrize("wall", [dt.datetime(2024, 3, 10, 2, 30, 0, 5),
                                  dt.datetime(1995, 5, 1, 2, 0, 34), dt.datetime(1969, 5, 1)])
def test_no_function_depends_on_the_session_zone(spark, wall):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(wall,)], "w timestamp_ntz")
        back = df.select(
            D.instant_as_wall(D.wall_as_instant("w")).alias("w"), D.naive_micros("w").alias("us"),
            D.micros_to_wall(D.wall_to_micros("w")).alias("decoded"),
            D.parse_wall(D.wall_text("w")).alias("parsed"), D.wall_text("w").alias("text"),
            F.unix_micros(D.wall_as_instant("w")).alias("instant")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert back.w == back.decoded == back.parsed == wall
    assert back.text == f"{wall:%Y-%m-%d %H:%M:%S.%f}"
    micros = (wall - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    assert back.us == back.instant == micros


def test_zone_is_resolved_once_not_by_name_for_every_row(spark):
    """Zone rules are those of convert_timezone, whose look-ups cost more than the conversion:
    before standard time, at both ends of summer time, far years."""
    micros = [None, 0, -1, 253402300799999999, -62135596800000000, *(
        at + step for at in (-2177481943_000000, 515520000_000000, 527007600_000000, 684867600_000000)
        for step in (-3600_000000, -1, 0, 1, 1800_000000, 3600_000000, 8 * 3600_000000))]
    rows = spark.createDataFrame([(m,) for m in micros], "m bigint").withColumn(
        "utc", F.timestamp_add("MICROSECOND", F.col("m"), F.expr("timestamp_ntz'1970-01-01 00:00:00'")))
    zone, utc = F.lit(D.WALL_ZONE), F.lit("UTC")
    wall = rows.select("m", D.micros_to_wall("m").alias("found"), F.convert_timezone(utc, zone, "utc").alias("expected"))
    back = rows.select("m", D.wall_to_micros("utc").alias("found"),
                       D.naive_micros(F.convert_timezone(zone, utc, "utc")).alias("expected"))
    for compared in (wall, back):
        assert compared.filter(~F.col("found").eqNullSafe(F.col("expected"))).collect() == []
        assert compared.count() == len(micros)
        assert "convert_timezone" not in compared.select("found")._jdf.queryExecution().optimizedPlan().toString()
