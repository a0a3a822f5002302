from __future__ import annotations

from decimal import Decimal

import pytest
from helpers import plan_text, point

from sparkseries.model import SeriesError
from sparkseries.operators import templates as template_module
from sparkseries.operators.templates import (
    bind_points,
    bind_statement,
    bind_templates,
    bound_points,
    parameters,
    unresolved_points,
)
from pyspark.sql import functions as F

T25 = {"temperature": ("f", 25.5)}
# (template line, parameters, expected point or None when a parameter is missing)
CASES = [
    ("weather,location=$loc temperature=25.5", {"loc": "beijing"}, ("weather", {"location": "beijing"}, T25)),
    ("weather,location=beijing temperature=$temp", {"temp": 25.5}, ("weather", {"location": "beijing"}, T25)),
    ("weather,location=beijing humidity=$hum", {"hum": 60}, ("weather", {"location": "beijing"}, {"humidity": ("i", 60)})),
    ("weather active=$status", {"status": False}, ("weather", {}, {"active": ("b", False)})),
    ("weather count=$n", {"n": Decimal(7)}, ("weather", {}, {"count": ("u", Decimal(7))})),
    ("$meas,location=beijing temperature=25.5", {"meas": "weather"}, ("weather", {"location": "beijing"}, T25)),
    ("weather,location=beijing temperature=25.5", {"other": "x"}, ("weather", {"location": "beijing"}, T25)),
    ("weather,location=$loc temperature=25.5", {"other": "value"}, None),
    ("weather,location=beijing temperature=$missing", {"other": "value"}, None),
    (
        "weather,location=$loc temperature=$temp,temperature2=$temperature",
        {"loc": "beijing", "temp": 25.5, "temperature": 30.0},
        ("weather", {"location": "beijing"}, {"temperature": ("f", 25.5), "temperature2": ("f", 30.0)}),
    ),
    ("weather,location=$loc temperature=25.5", {"loc": ""}, ("weather", {"location": ""}, T25)),
    ("weather,location=city_$name_station temperature=25.5", {"name": "beijing"}, ("weather", {"location": "city_beijing_station"}, T25)),
    (
        "weather,location=$city-$country temperature=25.5",
        {"city": "beijing", "country": "china"},
        ("weather", {"location": "beijing-china"}, T25),
    ),
    ("weather temperature=$temp", {"temp": 0}, ("weather", {}, {"temperature": ("i", 0)})),
    ("weather temperature=$temp", {"temp": -10.5}, ("weather", {}, {"temperature": ("f", -10.5)})),
    ("weather,location=[$loc] temperature=25.5", {"loc": "beijing"}, ("weather", {"location": "[beijing]"}, T25)),
    ("weather,location=price:$100 temperature=25.5", {"loc": "x"}, None),
    ("weather,$tagkey=value temperature=25.5", {"tagkey": "location"}, ("weather", {"location": "value"}, T25)),
    ("weather,id=$n temperature=25.5", {"n": 12345}, ("weather", {"id": "12345"}, T25)),
    ("weather,id=$n temperature=25.5", {"n": 28.0}, ("weather", {"id": "28"}, T25)),
    ("weather,id=$n temperature=25.5", {"n": True}, ("weather", {"id": "true"}, T25)),
    ("weather,id=$n temperature=25.5", {"n": "北京"}, ("weather", {"id": "北京"}, T25)),
    ('weather note="at $loc now"', {"loc": 'a,b=c "d"\ne'}, ("weather", {}, {"note": ("s", 'at a,b=c "d"\ne now')})),
    ("weather,location=$loc temperature=25.5", {"loc": "x,evil=1 y=2"}, ("weather", {"location": "x,evil=1 y=2"}, T25)),
    ("weather,location=$temp/$temperature temperature=25.5", {"temp": 1, "temperature": 2}, ("weather", {"location": "1/2"}, T25)),
    ("weather,$a=1,$b=2 f=1i", {"a": "k", "b": "k"}, ("weather", {"k": "2"}, {"f": ("i", 1)})),
    ("weather $f=$v", {"f": "speed", "v": 3}, ("weather", {}, {"speed": ("i", 3)})),
    ("weather,cost=5$ f=1i", {"a": "k"}, ("weather", {"cost": "5$"}, {"f": ("i", 1)})),
]


def params_frame(spark, given):
    kinds = {str: "string", float: "double", int: "bigint", bool: "boolean", Decimal: "decimal(20,0)"}
    return spark.createDataFrame([tuple(given.values())], ", ".join(f"`{k}` {kinds[type(v)]}" for k, v in given.items()))


@pytest.mark.parametrize("part", range(4))
def test_cases_as_points(spark, lines, part):
    """All cases through the general path, where templates and parameters are rows."""
    frames = []
    for number, (line, given, _) in list(enumerate(CASES))[part::4]:
        row = params_frame(spark, given)
        row = row.select(F.lit(number).alias("template_id"), parameters(row, {k: k for k in given}).alias("params"))
        frames.append(row.join(lines(line).withColumn("template_id", F.lit(number)), "template_id"))
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    for row in bind_points(union).collect():
        expected = CASES[row["template_id"]][2]
        if expected is None:
            assert len(row["unresolved"]) == 1, row
        else:
            assert row["unresolved"] == [] and point(row) == expected


@pytest.mark.parametrize("case", CASES, ids=[f"{i}" for i in range(len(CASES))])
def test_cases_as_statement(spark, case):
    line, given, expected = case
    df, names = params_frame(spark, given), {k: k for k in given}
    if expected is None:
        with pytest.raises(SeriesError, match="unresolved|not found"):
            bind_statement(df, "INSERT " + line, names)
    else:
        (row,) = bind_statement(df, "INSERT " + line, names).collect()
        assert row["unresolved"] == [] and point(row) == expected


def test_without_parameters_points_stay(spark, lines):
    df = lines("weather,location=$loc f=$x").withColumn("params", parameters(lines("m f=1"), {}))
    (row,) = bind_points(df).collect()
    assert point(row) == ("weather", {"location": "$loc"}, {"f": ("s", "$x")}) and row["unresolved"] == []


def test_templates_join_parameter_rows(spark, lines):
    templates = lines("a,t=$x f=$y 5", "b,t=$x f=1i").withColumn("template_id", F.when(F.col("measurement") == "a", 1).otherwise(2))
    rows = spark.createDataFrame([(1, "p", 1), (1, "q", None), (2, "r", 3), (3, "s", 4)], "template_id int, x string, y bigint")
    params = rows.select("template_id", parameters(rows, {"x": "x", "y": "y"}).alias("params"))
    bound = bind_templates(templates, params)
    assert sorted((r["measurement"], r["tags"]["t"]) for r in bound_points(bound).collect()) == [("a", "p"), ("b", "r")]
    (bad,) = unresolved_points(bound).collect()
    assert bad["tags"]["t"] == "q" and bad["unresolved"] == ["$y"]


def test_statement_with_several_lines_and_null_parameter(spark):
    df = spark.createDataFrame([(1, "p", 1.5), (2, None, 2.5)], "id int, x string, y double")
    bound = bind_statement(df, "insert a,t=$x f=$y 5\n\nb f=$y", {"x": "x", "y": "y"}, keep=["id"])
    assert bound.count() == 4
    assert sorted((r["id"], r["measurement"], r["time_ns"]) for r in bound_points(bound).collect()) == [
        (1, "a", 5),
        (1, "b", None),
        (2, "b", None),
    ]
    assert [r["unresolved"] for r in unresolved_points(bound).collect()] == [["$x"]]


@pytest.mark.parametrize("most", [64, 0])
def test_cases_as_templates(spark, lines, monkeypatch, most):
    """All cases in one call, compiled and joined."""
    monkeypatch.setattr(template_module, "COMPILED_TEMPLATES", most)
    templates = params = None
    for number, (line, given, _) in enumerate(CASES):
        row = params_frame(spark, given)
        row = row.select(F.lit(number).alias("template_id"), parameters(row, {k: k for k in given}).alias("params"))
        one = lines(line).withColumn("template_id", F.lit(number))
        templates, params = (one, row) if templates is None else (templates.unionByName(one), params.unionByName(row))
    bound = bind_templates(templates, params)
    assert ("Join" in plan_text(bound)) == (most == 0) and "Exchange" not in plan_text(bound) or most == 0
    rows = bound.collect()
    assert sorted(r["template_id"] for r in rows) == list(range(len(CASES)))
    for row in rows:
        expected = CASES[row["template_id"]][2]
        if expected is None:
            assert len(row["unresolved"]) == 1, row
        else:
            assert row["unresolved"] == [] and point(row) == expected


@pytest.mark.parametrize("most", [64, 0])
def test_templates_of_several_points_and_odd_rows(spark, lines, monkeypatch, most):
    monkeypatch.setattr(template_module, "COMPILED_TEMPLATES", most)
    templates = lines("a,t=$x f=$y 5", 'b,t=$x$ f="$y/$y"', "c,$x=$y,k=1 f=1i").withColumn("k", F.when(F.col("measurement") == "c", "two").otherwise("one"))
    templates = templates.unionByName(templates.limit(1).withColumn("k", F.lit(None).cast("string")))
    data = [("one", "p", 1), ("one", None, 2), ("two", "k", 3), ("nope", "q", 4), (None, "r", 5), ("one", None, None)]
    rows = spark.createDataFrame(data, "k string, x string, y bigint")
    params = rows.select("k", F.lit(7).alias("fields_seen"), parameters(rows, {"x": "x", "y": "y"}).alias("params"))
    bound = bind_templates(templates, params, on="k")
    assert sorted(bound.columns) == sorted(["k", "fields_seen", "time_ns", "measurement", "tags", "fields", "unresolved"])
    got = sorted((r["measurement"], r["time_ns"] or 0, sorted(r["tags"].items()), tuple(r["unresolved"])) for r in bound.collect())
    assert got == sorted([
        ("a", 5, [("t", "p")], ()),
        ("b", 0, [("t", "p$")], ()),
        ("a", 5, [("t", "$x")], ("$x",)),
        ("b", 0, [("t", "$x$")], ("$x",)),
        ("c", 0, [("k", "1")], ()),
        ("a", 5, [("t", "$x")], ()),
        ("b", 0, [("t", "$x$")], ()),
    ])


def test_no_template_binds_nothing(spark, lines):
    templates = lines("a,t=$x f=1").withColumn("template_id", F.lit(1)).where("false")
    rows = spark.createDataFrame([(1, "p")], "template_id int, x string")
    bound = bind_templates(templates, rows.select("template_id", parameters(rows, {"x": "x"}).alias("params")))
    assert bound.count() == 0 and {"measurement", "tags", "fields", "unresolved"} <= set(bound.columns)
