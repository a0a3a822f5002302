"""The query builder on a small table with known answers, and paging against brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from helpers import plan_text
from pyspark.sql import functions as F

from sparkseries import (
    Query,
    SeriesError,
    all_of,
    any_of,
    arithmetic,
    bound_where,
    call,
    compare,
    const,
    count,
    field_of,
    in_scope,
    last,
    max_,
    mean,
    min_,
    sum_,
    time,
    time_range,
    top,
    with_roles,
)
from sparkseries.plans import paging
from sparkseries.plans.paging import RANK, equi_depth_bucket, page, page_distinct, with_rank

LEVELS = [
    ("coyote_creek", 0, 8.12),
    ("santa_monica", 0, 2.064),
    ("coyote_creek", 6, 8.005),
    ("santa_monica", 6, 2.116),
    ("coyote_creek", 12, 9.96),
    ("santa_monica", 12, None),
    ("coyote_creek", 18, 7.762),
    ("santa_monica", 18, 2.126),
    ("coyote_creek", 24, -0.6),
    ("santa_monica", 24, 2.041),
]


@pytest.fixture(scope="module")
def water(spark):
    start = dt.datetime(2015, 8, 18)
    rows = [(where, start + dt.timedelta(minutes=m), level) for where, m, level in LEVELS]
    df = spark.createDataFrame(rows, "location string, time timestamp_ntz, water_level double")
    return with_roles(df, time="time", tags=["location"], fields=["water_level"])


def at(minute):
    return dt.datetime(2015, 8, 18) + dt.timedelta(minutes=minute)


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_select_all_and_expressions(water):
    assert Query().build(water).count() == 10
    scaled = Query().select(arithmetic("+", arithmetic("*", "water_level", 4), 2).alias("x")).limit(10).build(water)
    assert sorted(r["x"] for r in scaled.collect() if r["x"] is not None)[-1] == pytest.approx(9.96 * 4 + 2)
    assert Query().select(field_of("water_level").alias("WL"), const(3).alias("three")).build(water).columns == ["WL", "three"]
    zero = Query().select(arithmetic("/", "water_level", 0).alias("x")).build(water)
    assert {r["x"] for r in zero.collect()} == {None}


def test_selectors(water):
    assert tuples(Query().select(last("water_level"), "location").build(water)) == [(at(24), -0.6, "coyote_creek")] or tuples(
        Query().select(last("water_level"), "location").tie_break("location").build(water)
    ) == [(at(24), 2.041, "santa_monica")]
    five = tuples(Query().select(top("water_level", 5)).build(water))
    assert [r[1] for r in five] == [9.96, 8.12, 8.005, 7.762, 2.126]
    by_tag = Query().select(top("water_level", 1)).group_by("location").build(water)
    assert sorted(tuples(by_tag)) == [("coyote_creek", at(12), 9.96), ("santa_monica", at(18), 2.126)]
    latest = Query().select(last("water_level")).group_by("location").where(time_range(end=at(18).isoformat() + "Z")).build(water)
    assert sorted(tuples(latest)) == [("coyote_creek", at(12), 9.96), ("santa_monica", at(6), 2.116)]
    per_bucket = Query().select(last("water_level")).group_by("location", time("12m")).build(water)
    assert ("santa_monica", at(12), 2.126) in tuples(per_bucket)
    assert tuples(Query().select(last("water_level")).where(compare("water_level", ">", 99)).build(water)) == []


def test_last_stays_in_a_hash_aggregate(water):
    query = Query().select(last("water_level")).group_by("location")
    assert "SortAggregate" not in plan_text(query.build(water))
    assert sorted(tuples(query.build(water))) == sorted(tuples(query.tie_break("water_level").build(water)))


def test_large_top_cuts_in_slices_first(spark, water):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")
    try:
        rows = Query().select(top("water_level", 3)).group_by("location").build(water)
        assert sorted(r["top"] for r in rows.collect()) == [2.064, 2.116, 2.126, 8.005, 8.12, 9.96]
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_conditions(water):
    def n(condition):
        return Query().where(condition).build(water).count()

    assert n(compare("water_level", ">", 8)) == 3
    nested = all_of(compare("location", "<>", "santa_monica"), any_of(compare("water_level", "<", -0.57), compare("water_level", ">", 9.95)))
    assert n(nested) == 2
    assert n(compare("location", "=~", "/^coy/")) == 5 and n(compare("location", "!~", "/^coy/")) == 5
    assert n(compare("water_level", "!~", "/8/")) == 7, "null matches neither way"
    assert n(compare("time", "=", "2015-08-18T00:06:00Z")) == 2
    assert n(compare("time", "<>", "2015-08-18T00:06:00Z")) == 8
    assert n(time_range("2015-08-18T00:06:00Z", "2015-08-18T00:18:00Z")) == 4
    assert n(time_range("2015-08-18T00:06:00Z", "2015-08-18T00:18:00Z", closed=True)) == 6
    assert n(compare("time", "<", "2015-08-18T00:06:00.000000001Z")) == 4
    assert n(compare("time", ">=", "2015-08-18T00:06:00.000000001Z")) == 6
    assert n(compare("time", ">", "2015-08-17T19:06:00-05:00")) == 6
    assert n(F.col("water_level") > 8) == 3
    with pytest.raises(SeriesError):
        compare("water_level", "LIKE", "x")
    with pytest.raises(SeriesError):
        Query().where(compare("nothing", "=", 1)).build(water)


def test_aggregates(water):
    q = Query().select(mean("water_level").alias("m"), count("water_level").alias("n"), sum_("water_level").alias("s")).group_by("location")
    rows = {r["location"]: r for r in q.build(water).collect()}
    assert rows["santa_monica"]["n"] == 4 and rows["santa_monica"]["m"] == pytest.approx(rows["santa_monica"]["s"] / 4)
    ranged = Query().select(arithmetic("-", max_("water_level"), min_("water_level")).alias("r")).build(water)
    assert ranged.first()["r"] == pytest.approx(9.96 + 0.6)
    assert Query().select(count("water_level").alias("n")).where(compare("location", "=", "nowhere")).build(water).first()["n"] == 0
    assert Query().select(call("median", "water_level").alias("x")).build(water).first()["x"] is not None
    upper = Query().select(call("upper", "location", aggregate=False).alias("x")).build(water)
    assert upper.count() == 10
    buckets = Query().select(count("water_level").alias("n")).group_by(time("12m")).order_by("DESC").build(water)
    assert tuples(buckets) == [(at(24), 2), (at(12), 3), (at(0), 4)]
    paged = Query().select(count("water_level").alias("n")).group_by(time("12m")).order_by("ASC").limit(1).offset(1).build(water)
    assert tuples(paged) == [(at(12), 3)]
    series = Query().select(count("water_level").alias("n")).group_by("location", time("12m")).order_by("DESC").limit(1).build(water)
    assert sorted(tuples(series)) == [("coyote_creek", at(24), 1), ("santa_monica", at(24), 1)]
    over_all = Query().select(count("water_level").alias("n")).group_by("location", time("12m")).limit(1, scope="global").build(water)
    assert over_all.count() == 1


@pytest.mark.parametrize(
    "query",
    [
        lambda: Query().select("location", mean("water_level")),
        lambda: Query().select(top("water_level", 1), last("water_level")),
        lambda: Query().group_by(time("12m")),
    ],
)
def test_wrong_queries(water, query):
    with pytest.raises(SeriesError):
        query().build(water)


def test_wrong_clauses(spark):
    for wrong in (
        lambda: Query().order_by("UP"),
        lambda: Query().limit(1, scope="table"),
        lambda: Query().group_by(time("1m"), time("2m")),
        lambda: top("x", 0),
        lambda: arithmetic("%", "a", "b"),
        lambda: arithmetic("+", "a"),
    ):
        with pytest.raises(SeriesError):
            wrong()


def test_time_zone(water):
    rows = Query().select(count("water_level").alias("n")).group_by(time("1d")).timezone("America/Chicago", label="local").build(water)
    assert tuples(rows) == [(dt.datetime(2015, 8, 17, 5), 9, dt.datetime(2015, 8, 17))]


def test_several_measurements(water):
    tables = {"a": water, "b": water.withColumn("extra", F.lit(1))}
    union = Query().from_("a", "b").build(tables)
    assert union.groupBy("measurement").count().orderBy("measurement").collect()[1]["count"] == 10
    assert "extra" in union.columns
    counts = Query().select(count("water_level").alias("n")).from_("a", "b").build(tables)
    assert sorted(tuples(counts)) == [(9, "a"), (9, "b")]
    for wrong in (Query(), Query().from_("c")):
        with pytest.raises(SeriesError):
            wrong.build(tables)


def test_scope_and_parameters(spark):
    rows = [(1, "string 1", 3.1415926, True), (2, "string 2", 2.0, False), (3, "string 3", 3.0, True)]
    df = spark.createDataFrame(rows, "v1 bigint, v2 string, v3 double, v4 boolean")
    assert tuples(bound_where(df, "v1 = :v1 AND v2 = :v2", v1=2, v2="string 2")) == [rows[1]]
    assert bound_where(df, "v2 = :v", v="x' OR '1'='1").count() == 0
    scoped = df.withColumn("db", F.lit("d")).withColumn("rp", F.when(df.v1 == 1, "autogen").otherwise("week"))
    assert in_scope(scoped, "d").count() == 1 and in_scope(scoped, "d", "week").count() == 2
    assert in_scope(scoped, "other").count() == 0
    with pytest.raises(SeriesError, match="database"):
        in_scope(scoped, "")


# --------------------------------------------------------------------------
# paging


@pytest.fixture(scope="module")
def skewed(spark):
    """Most rows in one series, several rows at one time, a series with one row, times before 1970."""
    rng = random.Random(11)
    rows = [("hot", rng.randrange(-50, 400) * 97, n) for n in range(600)]
    rows += [(rng.choice(["a", "b"]), rng.randrange(0, 30) * 1800, 1000 + n) for n in range(60)]
    rows += [("one", 5, 5000), (None, 7, 6000), (None, 9, 6001)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "tag string, s bigint, id int").repartition(5)
    return df.withColumn("t", F.timestamp_seconds("s").cast("timestamp_ntz")).cache(), rows


def expected_page(rows, limit, offset, descending, series):
    groups = {}
    for tag, s, number in rows:
        groups.setdefault(tag if series else 0, []).append((-s if descending else s, number))
    kept = []
    for members in groups.values():
        members.sort()
        kept += [n for _, n in members[max(offset, 0) : (max(offset, 0) + limit) if limit > 0 else None]]
    return sorted(kept)


@pytest.mark.parametrize("direct", [True, False])
@pytest.mark.parametrize("series", [["tag"], []])
@pytest.mark.parametrize(("limit", "offset", "descending"), [(7, 0, False), (20, 33, True), (0, 40, False), (0, 250, True), (450, 100, False), (-1, 0, False)])
def test_page(spark, skewed, monkeypatch, direct, series, limit, offset, descending):
    df, rows = skewed
    if not direct:
        monkeypatch.setattr(paging, "GLOBAL_DIRECT_ROWS", 0)
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "0")
    try:
        paged = page(df, time="t", ties=["id"], limit=limit, offset=offset, series=series, descending=descending, buckets=16)
        found = sorted(r["id"] for r in paged.select("id").collect())
        assert paged.columns == df.columns
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert found == expected_page(rows, limit, offset, descending, series)


def test_rank(skewed):
    df, rows = skewed
    ranked = with_rank(df, time="t", ties=["id"], series=["tag"], buckets=64)
    for tag in {r[0] for r in rows}:
        ids = [n for _, n in sorted((s, n) for t, s, n in rows if t == tag)]
        found = ranked.where(F.col("tag").eqNullSafe(F.lit(tag))).orderBy(RANK).collect()
        assert [(r[RANK], r["id"]) for r in found] == list(enumerate(ids, 1))


def test_rows_without_time_come_last(spark, skewed, monkeypatch):
    monkeypatch.setattr(paging, "GLOBAL_DIRECT_ROWS", 0)
    df = skewed[0].select("tag", "t", "id").unionByName(spark.createDataFrame([("hot", None, 7000), ("hot", None, 7001)], "tag string, t timestamp_ntz, id int"))
    paged = page(df, time="t", ties=["id"], offset=664)
    assert [r["id"] for r in paged.collect()] == [7001]
    assert with_rank(df, time="t", ties=["id"], series=["tag"]).where("id >= 7000").agg(F.min(RANK)).first()[0] == 601


def test_page_of_distinct_keys(spark):
    df = spark.range(100).selectExpr("CAST(id AS string) AS k")
    ordered = sorted(str(i) for i in range(100))
    assert [r["k"] for r in page_distinct(df, ["k"], limit=3, offset=2).collect()] == ordered[2:5]
    assert sorted(r["k"] for r in page_distinct(df, ["k"], offset=90).collect()) == ordered[90:]
    assert sorted(r["k"] for r in page_distinct(df, ["k"], offset=90, descending=True).collect()) == ordered[:10]
    assert page_distinct(df, ["k"], offset=500).count() == 0


def test_large_page_has_no_single_partition(spark, skewed):
    plan = plan_text(page(skewed[0], time="t", ties=["id"], offset=5, series=["tag"]))
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("descending", [False, True])
def test_late_pages_of_distinct_keys(spark, monkeypatch, descending):
    monkeypatch.setattr(paging, "GLOBAL_DIRECT_ROWS", 50)
    rows = [(f"k{i % 400}" if i % 97 else None, i // 400) for i in range(1_200)]
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or "", r[1]), reverse=descending)
    df = spark.createDataFrame(rows, "k string, n int").repartition(4)
    for limit, offset in ((30, 100), (1, 1_100), (5_000, 3), (0, 1_000), (0, 9_999), (60, 0)):
        got = page_distinct(df, ["k", "n"], limit=limit, offset=offset, descending=descending, buckets=32)
        want = rows[offset : offset + limit if limit else None]
        found = [tuple(r) for r in got.collect()]
        assert found == want if limit else sorted(map(str, found)) == sorted(map(str, want))
    assert "SinglePartition" not in plan_text(page_distinct(df, ["k", "n"], limit=500, offset=100, buckets=32))


@pytest.mark.parametrize("shared", ["hour", "time"])
def test_a_hot_hour_is_many_buckets(spark, shared):
    df = spark.range(20_000).selectExpr("'hot' AS tag", f"id % {3_600_000 if shared == 'hour' else 1} * 1000000 AS t", "uuid() AS name", "id % 7 AS x", "id").cache()
    keyed = df.withColumn("b", equi_depth_bucket(df, time="t", ties=["x", "id"], series=["tag"], buckets=64))
    sizes = [r["count"] for r in keyed.groupBy("b").count().collect()]
    assert len(sizes) > 50 and max(sizes) < 1_000
    ranked = with_rank(df, time="t", ties=["x", "id"], series=["tag"]).select(RANK, "id").collect()
    want = sorted(range(20_000), key=lambda i: (0 if shared == "time" else i, i % 7, i))
    assert [r["id"] for r in sorted(ranked)] == want
    paged = page(df, time="t", ties=["x", "id"], series=["tag"], offset=2_000, limit=15_000)
    assert sorted(r["id"] for r in paged.collect()) == sorted(want[2_000:17_000])


def test_a_page_reads_twice_and_shuffles_only_cut_rows(spark, skewed, tmp_path):
    skewed[0].write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    plan = plan_text(page(df, time="t", ties=["id"], offset=5, series=["tag"]))
    assert plan.count("rows]") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert "from_json" not in plan
    plan = plan_text(page(df, time="t", ties=["id"], offset=5))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_ties_of_any_type_order_pages(spark):
    rows = [(i % 3, [i], i % 5 / 4, b"x", f"n{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "t bigint, list array<int>, d double, b binary, s string").withColumn("d", F.when(F.col("d") > 0.9, None).otherwise(F.col("d")))
    want = sorted(rows, key=lambda r: (r[0], r[2] > 0.9, r[2] if r[2] <= 0.9 else 0, r[3], r[4]))
    got = page(df, time="t", ties=["d", "b", "s"], offset=40, buckets=32)
    assert [r["s"] for r in got.collect()] == [r[4] for r in want[40:]]
    by_list = page(df, time="t", ties=["s"], series=["list"], offset=1)
    assert by_list.count() == 0


# --------------------------------------------------------------------------
# pages and order of every query shape


def test_pages_of_grouped_results(water):
    tags = Query().select(mean("water_level").alias("m")).group_by("location")
    assert [r[0] for r in tags.limit(1, "global").build(water).collect()] == ["coyote_creek"]
    assert [r[0] for r in tags.limit(1, "global").offset(1, "global").build(water).collect()] == ["santa_monica"]
    assert tags.limit(1).build(water).count() == 2 and tags.offset(1).build(water).count() == 0
    assert Query().select(mean("water_level")).offset(1).build(water).count() == 0
    highest = Query().select(top("water_level", 5)).limit(2)
    assert [r[0] for r in highest.build(water).collect()] == [at(0), at(6)]
    assert Query().select(top("water_level", 3)).group_by("location").limit(1).build(water).count() == 2


def test_order_without_a_bucket_and_behind_an_alias(water):
    query = Query().select(mean("water_level").alias("m")).group_by("location").order_by("DESC")
    assert [r[0] for r in query.build(water).collect()] == ["coyote_creek", "santa_monica"]
    hidden = Query().select(field_of("water_level").alias("time")).order_by("DESC").tie_break("location").build(water)
    assert hidden.columns == ["time"] and hidden.first()["time"] in (-0.6, 2.041)


def test_global_page_over_several_measurements(water):
    tables = {"b": water, "a": water}
    query = Query().select("water_level").from_("b", "a").tie_break("location")
    rows = query.limit(3, "global").build(tables).collect()
    assert [(r["measurement"], r["water_level"]) for r in rows] == [("a", 8.12), ("a", 2.064), ("b", 8.12)]
    assert query.limit(3).build(tables).count() == 6
