from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from sparkseries.functions.timefns import (
    compare_time,
    epoch_ns,
    from_precision,
    ns_to_ntz,
    ns_to_timestamp,
    parse_instant,
    time_bucket,
    to_precision,
)
from sparkseries.model import SeriesError, check_declared, duration_ns, format_duration, interval_text, with_roles

UNITS = {"ns": 1, "u": 10**3, "ms": 10**6, "s": 10**9, "m": 60 * 10**9, "h": 3600 * 10**9}


def test_precisions_floor_exactly(spark):
    values = [0, 1, -1, 1704067199999999999, 1704067200000000000, -1704067199999999999, 1701433938132363612]
    df = spark.createDataFrame([(v,) for v in values], "t bigint")
    for row in df.select("t", *(to_precision(F.col("t"), u).alias(u) for u in UNITS)).collect():
        assert [row[u] for u in UNITS] == [row["t"] // size for size in UNITS.values()]
    digits = df.where("t = 1701433938132363612").select(*(to_precision(F.col("t"), u) for u in UNITS)).first()
    assert [len(str(v)) for v in digits] == [19, 16, 13, 10, 8, 6]
    texts = [r[0] for r in df.select(to_precision(F.col("t"), "rfc3339")).collect()]
    assert texts[0] == "1970-01-01T00:00:00Z"
    assert texts[2] == "1969-12-31T23:59:59.999999999Z"
    assert texts[6] == "2023-12-01T12:32:18.132363612Z"
    with pytest.raises(SeriesError):
        to_precision(F.col("t"), "days")


def test_input_precisions(spark):
    df = spark.createDataFrame([(5, "ns"), (5, "u"), (5, "ms"), (5, "s"), (5, "m"), (5, "h"), (5, "what"), (5, None)], "t bigint, p string")
    found = [r[0] for r in df.select(from_precision(F.col("t"), F.col("p"))).collect()]
    assert found == [5 * UNITS.get(p, 1) for p in ("ns", "u", "ms", "s", "m", "h", "what", None)]
    assert df.select(from_precision(F.col("t"), "ms")).first()[0] == 5_000_000


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on this day.
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.123456' n, TIMESTAMP'2024-03-10 02:30:00.123456Z' z")
        expected = 1710037800123456000
        for name in "nz":
            ns = epoch_ns(df, name)
            row = df.select(ns.alias("ns"), ns_to_ntz(ns).alias("ntz"), F.unix_micros(ns_to_timestamp(ns)).alias("us")).first()
            assert (row["ns"], row["us"]) == (expected, expected // 1000)
            assert row["ntz"] == dt.datetime(2024, 3, 10, 2, 30, 0, 123456)
            for bound, n in (("2024-03-10T02:30:00Z", 1), ("2024-03-10T02:30:01Z", 0)):
                assert df.where(compare_time(df, name, ">=", bound)).count() == n
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize(("duration", "hours"), [("1d", 24), ("6h", 6), ("2h", 2)])
def test_zone_buckets_over_clock_changes(spark, kind, duration, hours):
    zone, utc = ZoneInfo("America/Chicago"), dt.timezone.utc
    starts = [dt.datetime(2024, 3, 9, 12), dt.datetime(2024, 11, 2, 12)]
    instants = [s + dt.timedelta(minutes=37 * i) for s in starts for i in range(60)]
    df = spark.createDataFrame([(i.isoformat(sep=" ") + ("Z" if kind == "timestamp" else ""),) for i in instants], "x string")
    df = df.select(F.col("x").cast(kind).alias("t"))
    bucket = time_bucket(df, "t", duration, "America/Chicago")
    rows = df.select(F.col("t").cast("string").alias("t"), bucket.cast("string").alias("b")).collect()
    for t, b in rows:
        instant = dt.datetime.fromisoformat(t).replace(tzinfo=utc)
        local = instant.astimezone(zone)
        if hours == 24:
            expected = local.replace(hour=0, minute=0, second=0, microsecond=0).astimezone(utc)
        else:
            expected = instant - dt.timedelta(hours=local.hour % hours, minutes=local.minute, seconds=local.second)
        assert dt.datetime.fromisoformat(b).replace(tzinfo=utc) == expected


def test_buckets_of_nanoseconds(spark):
    df = spark.createDataFrame([(-1,), (0,), (720 * 10**9 + 5,)], "t bigint")
    found = [r[0] for r in df.select(time_bucket(df, "t", "12m")).collect()]
    assert found == [-720 * 10**9, 0, 720 * 10**9]


def test_durations():
    assert duration_ns("12m") == 12 * 60 * 10**9
    assert duration_ns("7200h0m0s") == duration_ns("300d")
    assert format_duration(duration_ns("300d")) == "7200h0m0s"
    assert format_duration(duration_ns("2h")) == "2h0m0s"
    assert interval_text("12m") == "720000000 microseconds"
    for wrong in ("0", "1", "", "0s", "12x", "m", "-3d", None):
        with pytest.raises(SeriesError):
            duration_ns(wrong)
    with pytest.raises(SeriesError):
        interval_text("5ns")


def test_instants():
    assert parse_instant("2015-08-18T00:00:00Z") == 1439856000 * 10**9
    assert parse_instant("2015-08-18T00:00:00.000000001Z") == 1439856000 * 10**9 + 1
    assert parse_instant("2015-08-18") == parse_instant("2015-08-18 00:00") == parse_instant("2015-08-17T19:00:00-05:00")
    assert parse_instant(dt.datetime(2015, 8, 18)) == 1439856000 * 10**9
    for wrong in ("now", "2015-13-01", True):
        with pytest.raises(ValueError):
            parse_instant(wrong)


def test_roles_and_declared_schemas(spark):
    df = spark.range(1).selectExpr("id AS time", "1 AS t", "1.5D AS f", "'x' AS s")
    with pytest.raises(SeriesError, match="no column"):
        with_roles(df, time="time", tags=["nope"])
    with pytest.raises(SeriesError, match="unsupported"):
        with_roles(df.withColumn("a", F.array(F.lit(1))), time="time", fields=["a"])
    wide = with_roles(df, time="time", tags=["t"], fields=["f", "s"])
    check_declared(wide.schema, ["t"], {"f": "FLOAT64", "s": "STRING"})
    with pytest.raises(SeriesError, match="empty tag or field"):
        check_declared(wide.schema, [], {})
    for fields in ({"f": "INT64"}, {"g": "INT64"}, {"f": "DECIMAL"}):
        with pytest.raises(SeriesError):
            check_declared(wide.schema, ["t"], fields)
