from __future__ import annotations

import random

import pytest
from helpers import point
from pyspark.sql import functions as F

from sparkseries.model import FIELD, TAG, SeriesError, columns_with_role, with_roles
from sparkseries.operators.points import points_to_wide, wide_to_points
from sparkseries.operators.quality import (
    block_stats,
    check_record,
    merge_duplicates,
    merge_points,
    reject_reasons,
    require_record,
    split_rejects,
    type_conflicts,
)


def test_merge_fixture(spark):
    df = spark.createDataFrame(
        [(200, 1, 1, None), (100, 2, 2, "x"), (200, 3, None, "y"), (100, 4, None, None)], "time bigint, seq int, a int, b string"
    )
    merged = merge_duplicates(df, ["time"], "seq").orderBy("time").collect()
    assert [tuple(r) for r in merged] == [(100, 2, "x"), (200, 1, "y")]


def test_merge_against_brute_force(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice("ab"), rng.randrange(20), n, rng.choice([None, n]), rng.choice([None, f"s{n}"])) for n in range(400)
    ]
    rng.shuffle(rows)
    expected = {}
    for tag, time, _, a, b in sorted(rows, key=lambda r: r[2]):
        old = expected.get((tag, time), (None, None))
        expected[tag, time] = (a if a is not None else old[0], b if b is not None else old[1])
    df = spark.createDataFrame(rows, "tag string, time int, seq int, a int, b string").repartition(7)
    merged = {(r["tag"], r["time"]): (r["a"], r["b"]) for r in merge_duplicates(df, ["tag", "time"], "seq").collect()}
    assert merged == expected


def test_merging_points(spark, lines):
    texts = ["m,t=a x=1,y=1 5", "m,t=a x=2 5", "m,t=b x=3 5", "m,t=a z=\"q\" 5", "m x=4 5", "m,t=a x=9 6"]
    points = None
    for n, text in enumerate(texts):
        part = lines(text).withColumn("seq", F.lit(n))
        points = part if points is None else points.unionByName(part)
    merged = {(r["measurement"], r["tags"].get("t"), r["time_ns"]): point(r)[2] for r in merge_points(points, "seq").collect()}
    assert merged == {
        ("m", "a", 5): {"x": ("f", 2.0), "y": ("f", 1.0), "z": ("s", "q")},
        ("m", "b", 5): {"x": ("f", 3.0)},
        ("m", None, 5): {"x": ("f", 4.0)},
        ("m", "a", 6): {"x": ("f", 9.0)},
    }


def test_line_breaks_are_refused_for_text(lines):
    good = lines("m,t=a f=\"x\" 1")
    broken = good.withColumn("tags", F.create_map(F.lit("t"), F.lit("a\nb")))
    assert [reject_reasons(p, for_text=True).first()["reasons"] for p in (good, broken)] == [[], ["line break in a name or value"]]
    assert reject_reasons(broken).first()["reasons"] == []


def test_record_checks(spark):
    good = spark.createDataFrame([(1, 2, 3)], "a int, b int, time int")
    assert check_record(good).where("violations > 0").count() == 0
    unsorted = good.select("time", "b", "a")
    assert require_record(unsorted).columns == ["a", "b", "time"]
    broken = {
        "time_missing": good.drop("time"),
        "no_other_column": good.select("time"),
        "time_null": good.withColumn("time", F.lit(None).cast("int")),
        "repeated_name": good.select("a", F.col("b").alias("a"), "time"),
    }
    for check, df in broken.items():
        with pytest.raises(SeriesError, match=check):
            require_record(df)


def test_rejects(spark, lines):
    points = lines("m,t=a f=1 1", "m,time=a f=1 2", "m time=1 3")
    odd = points.limit(1).withColumn("fields", F.map_filter("fields", lambda k, v: F.lit(False)))
    null_slot = points.where("time_ns = 1").withColumn("fields", F.transform_values("fields", lambda k, v: F.lit(None).cast("struct<i:bigint,u:decimal(20,0),f:double,s:string,b:boolean>")))
    reasons = {r["time_ns"]: r["reasons"] for r in reject_reasons(points).collect()}
    assert reasons == {1: [], 2: ["tag name time is reserved"], 3: ["field name time is reserved"]}
    assert reject_reasons(odd).first()["reasons"] == ["no field"]
    assert reject_reasons(null_slot).first()["reasons"] == ["unsupported field type"]
    assert "empty measurement" in reject_reasons(points.withColumn("measurement", F.lit(None).cast("string"))).first()["reasons"]
    good, bad = split_rejects(points)
    assert (good.count(), bad.count()) == (1, 2)


def test_union_of_shapes(lines):
    line = 'i=100i,b=true,f=3.14,s1="pi1"'
    points = lines(f"m,t1=a,t2=b {line} 1000", f"m,a1=a,a2=b {line} 2000", f"m,b1=a,b2=b {line} 3000", "n f=1")
    wide = points_to_wide(points, "m")
    assert wide.columns == ["a1", "a2", "b", "b1", "b2", "f", "i", "s1", "t1", "t2", "time"]
    assert columns_with_role(wide, TAG) == ["a1", "a2", "b1", "b2", "t1", "t2"]
    assert columns_with_role(wide, FIELD) == ["b", "f", "i", "s1"]
    rows = wide.orderBy("time").collect()
    assert [(r["t1"], r["a2"], r["i"], r["b"]) for r in rows] == [("a", None, 100, True), (None, "b", 100, True), (None, None, 100, True)]
    given = points_to_wide(points, "m", tags=["t1"], fields={"i": "integer"})
    assert given.columns == ["i", "t1", "time"] and given.count() == 3


def test_wide_needs_one_type_per_name(lines):
    mixed = lines("m f=1i 1", "m f=1.5 2", "m g=1 3")
    with pytest.raises(SeriesError, match="several types"):
        points_to_wide(mixed, "m")
    assert [(r["key"], r["types"]) for r in type_conflicts(mixed).collect()] == [("f", ["float", "integer"])]
    with pytest.raises(SeriesError, match="both as tag and as field"):
        points_to_wide(lines("m,x=a x=1 1"), "m")
    with pytest.raises(SeriesError, match="more than 2 columns"):
        points_to_wide(lines("m a=1,b=1,c=1 1"), "m", max_columns=2)


def test_points_of_a_table(spark):
    df = spark.createDataFrame(
        [("Test1", "test1", 897870, 834.5433, True, 10), ("x", None, None, None, None, 20), ("Test3", "test3", None, None, False, 0)],
        "Tag string, stringField string, intField bigint, doubleField double, boolField boolean, time bigint",
    )
    fields = ["stringField", "intField", "doubleField", "boolField"]
    points = wide_to_points(with_roles(df, time="time", tags=["Tag"], fields=fields), "m", now=F.lit(99).cast("bigint"))
    good, bad = split_rejects(points)
    assert bad.count() == 1
    assert sorted(((point(r), r["time_ns"]) for r in good.collect()), key=repr) == [
        (("m", {"Tag": "Test1"}, {"stringField": ("s", "test1"), "intField": ("i", 897870), "doubleField": ("f", 834.5433), "boolField": ("b", True)}), 10),
        (("m", {"Tag": "Test3"}, {"stringField": ("s", "test3"), "boolField": ("b", False)}), 99),
    ]


def test_block_stats(lines):
    rows = block_stats(lines("a f=1 7", "a f=1 3", "b f=1 5")).orderBy("measurement").collect()
    assert [tuple(r) for r in rows] == [("a", 2, 3, 7), ("b", 1, 5, 5)]
