from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkseries.model import SeriesError, with_roles
from sparkseries.operators.points import tag_sets, wide_to_points
from sparkseries.operators.explore import (
    field_types,
    series_cardinality,
    show_field_keys,
    show_measurements,
    show_series,
    show_tag_keys,
    show_tag_values,
    table_field_keys,
)


def column(df, name):
    return [r[name] for r in df.collect()]


@pytest.fixture
def weather(lines):
    return lines(
        'w,location=c1,country=cn weather="sun",temperature=25.0 1',
        'w,location=c2,country=cn weather="sun",temperature=26.0 2',
        'w,location=u1,country=us weather="sun",temperature=35.0 3',
        'w,location=u2,country=us weather="sun",temperature=36.0 4',
        "other,place=x f=1i 5",
    )


def test_tag_values(weather):
    assert column(show_tag_values(weather, "location", "w", order="ASC", limit=9), "value") == ["c1", "c2", "u1", "u2"]
    assert column(show_tag_values(weather, "location", "w", order="DESC", limit=9), "value") == ["u2", "u1", "c2", "c1"]
    assert column(show_tag_values(weather, "location", "w", order="ASC", limit=2, offset=2), "value") == ["u1", "u2"]
    assert sorted(column(show_tag_values(weather, "location", "w", order="ASC", offset=1), "value")) == ["c2", "u1", "u2"]
    assert sorted(column(show_tag_values(weather, "location", "w", order="DESC", offset=3), "value")) == ["c1"]
    where = ("country", "=", "cn")
    assert column(show_tag_values(weather, "location", "w", where=where, order="ASC", limit=2, offset=2), "value") == []
    assert sorted(column(show_tag_values(weather, "/loc.*/"), "value")) == ["c1", "c2", "u1", "u2"]
    assert show_tag_values(weather, ["location", "country"]).count() == 6
    assert column(show_tag_values(weather, "/loc.*/", where=("country", "=~", "/^u/"), order="ASC", limit=1), "value") == ["u1"]


@pytest.mark.parametrize("keys", [[], "", ["a", ""]])
def test_tag_values_need_a_key(weather, keys):
    with pytest.raises(SeriesError, match="empty tag key"):
        show_tag_values(weather, keys)


def test_series(lines):
    points = lines("m,vector1=v1,horizon=h1 f=1 1", "m,vector2=c2,country=cn vector3=1 2", "m,vector3=u1,country=us f=1 3", "m,vector4=u2,country=us f=1 4", "m,vector4=u2,country=us f=2 5")
    assert sorted(column(show_series(points, "m"), "key")) == [
        "m,country=cn,vector2=c2",
        "m,country=us,vector3=u1",
        "m,country=us,vector4=u2",
        "m,horizon=h1,vector1=v1",
    ]
    assert show_series(points, limit=2).count() == 2
    assert column(show_series(points, limit=2, offset=2), "key") == ["m,country=us,vector4=u2", "m,horizon=h1,vector1=v1"]
    assert show_series(points, where=("country", "=", "cn")).count() == 1
    assert show_series(points, where=("country", "!~", "/cn/")).count() == 2
    assert series_cardinality(points).collect()[0].asDict() == {"measurement": "m", "n": 4}
    assert series_cardinality(points, approximate=True).collect()[0]["n"] == 4


def test_keys_and_measurements(spark, weather, lines):
    points = lines('a,tag1=1,tag2=2,tag3=3 field1=1i,field2=T,field3="x",field4=1.5,field5=3u', "b f=1")
    assert column(show_tag_keys(points, "a", limit=3).orderBy("key"), "key") == ["tag1", "tag2", "tag3"]
    assert column(show_tag_keys(points, "a", offset=1).orderBy("key"), "key") == ["tag2", "tag3"]
    assert column(show_tag_keys(points, "a", limit=1, offset=1), "key") == ["tag2"]
    types = {"field1": "integer", "field2": "boolean", "field3": "string", "field4": "float", "field5": "unsigned"}
    assert {r["key"]: r["type"] for r in show_field_keys(points, "a").collect()} == types
    assert sorted(column(show_measurements(weather), "measurement")) == ["other", "w"]
    assert column(show_measurements(weather, "=~", "/^o/"), "measurement") == ["other"]
    assert column(show_measurements(weather, "!~", "/^o/"), "measurement") == ["w"]
    assert column(show_measurements(weather, "<>", "w"), "measurement") == ["other"]
    wide = with_roles(spark.range(1).selectExpr("id AS time", "'x' AS t", "1L AS a", "1.5D AS b", "true AS c", "'s' AS d"), time="time", tags=["t"], fields=["a", "b", "c", "d"])
    empty = wide.withColumn("a", F.lit(None).cast("bigint").alias("a", metadata={"role": "field"}))
    assert sorted(column(table_field_keys(wide, "w"), "key")) == ["a", "b", "c", "d"]
    assert sorted(column(table_field_keys(empty, "w"), "key")) == ["b", "c", "d"]
    assert field_types(wide) == {"a": "integer", "b": "float", "c": "boolean", "d": "string"}


def test_tag_sets_answer_like_points(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", None, 3)], "t string, u string, time bigint")
    df = with_roles(df.withColumn("f", F.lit(1.5)), time="time", tags=["t", "u"], fields=["f"])
    sets, points = tag_sets(df, "m"), wide_to_points(df, "m")
    assert {tuple(r.tags.items()): r.row_count for r in sets.collect()} == {(("t", "a"), ("u", "x")): 2, (("t", "b"),): 1}
    for show in (show_series, show_tag_keys, lambda p: show_tag_values(p, ["t", "u"])):
        assert sorted(show(sets).collect()) == sorted(show(points).collect())


def test_series_of_escaped_texts_stay_apart(lines):
    from sparkseries.operators.explore import series_cardinality, show_series

    points = lines(r"m,a=1\,b\=2 v=1 1", "m,a=1,b=2 v=1 2")
    assert [tuple(r) for r in series_cardinality(points).collect()] == [("m", 2)]
    assert sorted(r[0] for r in show_series(points).collect()) == [r"m,a=1,b=2", r"m,a=1\,b\=2"]
