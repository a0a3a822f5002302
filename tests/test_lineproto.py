from __future__ import annotations

from decimal import Decimal

import pytest
from helpers import plain, point
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkseries.functions.values import general_double, infer_value, plain_double
from sparkseries.model import FIELDS_TYPE, TAGS_TYPE, SeriesError, with_roles
from sparkseries.operators.points import wide_to_points
from sparkseries.sources.lineproto import (
    encode_points,
    encode_table,
    good_points,
    insert_lines,
    parse_lines,
    read_lines,
    rejected_lines,
    require_clean,
    write_lines,
)

GOOD = {
    "weather temperature=25.5": ("weather", {}, {"temperature": ("f", 25.5)}, None),
    "weather,location=beijing,sensor=001 temperature=25.5,humidity=60i": (
        "weather",
        {"location": "beijing", "sensor": "001"},
        {"temperature": ("f", 25.5), "humidity": ("i", 60)},
        None,
    ),
    "weather,location=$loc temperature=$temp": ("weather", {"location": "$loc"}, {"temperature": ("s", "$temp")}, None),
    "weather,location=shanghai temperature=30.0 1609459200000000000": (
        "weather",
        {"location": "shanghai"},
        {"temperature": ("f", 30.0)},
        1609459200000000000,
    ),
    'weather,location=beijing status="sunny",temperature=25.5': (
        "weather",
        {"location": "beijing"},
        {"status": ("s", "sunny"), "temperature": ("f", 25.5)},
        None,
    ),
    "weather,location=beijing active=true,offline=false": (
        "weather",
        {"location": "beijing"},
        {"active": ("b", True), "offline": ("b", False)},
        None,
    ),
    "weather,location=beijing count=100u,temperature=25.5": (
        "weather",
        {"location": "beijing"},
        {"count": ("u", Decimal(100)), "temperature": ("f", 25.5)},
        None,
    ),
    "weather temperature=9223372036854775807i": ("weather", {}, {"temperature": ("i", 9223372036854775807)}, None),
    "weather temperature=-9223372036854775808i": ("weather", {}, {"temperature": ("i", -9223372036854775808)}, None),
    "weather temperature=1.23e10": ("weather", {}, {"temperature": ("f", 1.23e10)}, None),
    'weather description="",temperature=25.5': ("weather", {}, {"description": ("s", ""), "temperature": ("f", 25.5)}, None),
    r'we\,a\ t,lo\=c=be\,i\ j f\ 1="a,b \"q\" = c\\",g=2 5': (
        "we,a t",
        {"lo=c": "be,i j"},
        {"f 1": ("s", 'a,b "q" = c\\'), "g": ("f", 2.0)},
        5,
    ),
    "m a=1,a=2i": ("m", {}, {"a": ("i", 2)}, None),
    'm,a=b,a=c f="12i"': ("m", {"a": "c"}, {"f": ("s", "12i")}, None),
    "m,a=b=c f=1": ("m", {"a": "b=c"}, {"f": ("f", 1.0)}, None),
    "m a=,b=1": ("m", {}, {"a": ("s", ""), "b": ("f", 1.0)}, None),
    "  m a=1 7\r": ("m", {}, {"a": ("f", 1.0)}, 7),
    'm "a=b c"=1': ("m", {}, {"a=b c": ("f", 1.0)}, None),
}
BAD = [
    "weather,location=beijing",
    ",location=beijing temperature=25.5",
    "weather temperature=25.5 invalid_timestamp",
    "m a=1 -5",
    "m a=1 99999999999999999999",
    'm a="x',
    "m,=v f=1",
    "m a=1,=2",
    "m",
]


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_lines_give_points(spark):
    for row in parse_lines(frame(spark, GOOD)).collect():
        assert row["reason"] is None, row
        measurement, tags, fields, time_ns = GOOD[row["value"]]
        assert point(row) == (measurement, tags, fields)
        assert row["time_ns"] == time_ns


def test_bad_lines_are_rejected_and_blank_lines_skipped(spark):
    parsed = parse_lines(frame(spark, [*BAD, "", "   ", "m a=1"]))
    assert sorted(r["value"] for r in rejected_lines(parsed).collect()) == sorted(BAD)
    assert good_points(parsed).count() == 1
    with pytest.raises(SeriesError):
        require_clean(parsed)


def test_long_values_and_many_fields(spark):
    texts = [
        'm a="' + "x" * 20_000 + '"',
        'm a="' + r"\"" * 9_000 + '"',
        "m " + ",".join(f"f{i}={i}i" for i in range(2_000)),
        "m,t=" + "y" * 20_000 + " a=1",
    ]
    rows = {r["value"]: r for r in parse_lines(frame(spark, texts)).collect()}
    assert plain(rows[texts[0]]["fields"]["a"]) == ("s", "x" * 20_000)
    assert plain(rows[texts[1]]["fields"]["a"]) == ("s", '"' * 9_000)
    assert len(rows[texts[2]]["fields"]) == 2_000
    assert rows[texts[3]]["tags"]["t"] == "y" * 20_000


INFERRED = {
    "42i": ("i", 42),
    "123I": ("i", 123),
    "-42i": ("i", -42),
    "42u": ("u", Decimal(42)),
    "123U": ("u", Decimal(123)),
    "18446744073709551615u": ("u", Decimal(18446744073709551615)),
    "18446744073709551616u": ("s", "18446744073709551616u"),
    "9223372036854775808i": ("s", "9223372036854775808i"),
    '"hello world"': ("s", "hello world"),
    '""': ("s", ""),
    **{w: ("b", True) for w in ("true", "TRUE", "t", "T")},
    **{w: ("b", False) for w in ("false", "FALSE", "f", "F")},
    "3.14": ("f", 3.14),
    "-2.5": ("f", -2.5),
    "42": ("f", 42.0),
    "1.23e-4": ("f", 1.23e-4),
    "$temp": ("s", "$temp"),
    "unquoted": ("s", "unquoted"),
    "True": ("s", "True"),
    " 5i ": ("i", 5),
    "1d": ("s", "1d"),
    "5f": ("s", "5f"),
    "1e400": ("s", "1e400"),
    "inf": ("f", float("inf")),
    "-Infinity": ("f", float("-inf")),
    "": ("s", ""),
    "i": ("s", "i"),
}


def test_inference(spark):
    rows = frame(spark, INFERRED).select("value", infer_value(F.col("value")).alias("v")).collect()
    assert {r["value"]: plain(r["v"]) for r in rows} == INFERRED
    assert frame(spark, [None]).select(infer_value(F.col("value")).alias("v")).first()["v"] is None


def test_double_texts(spark):
    cases = {
        5.0: ("5", "5"),
        25.5: ("25.5", "25.5"),
        -0.001: ("-0.001", "-0.001"),
        1e21: ("1" + "0" * 21, "1e+21"),
        1.5e10: ("15000000000", "15000000000"),
        -1.234567e8: ("-123456700", "-123456700"),
        123456789.125: ("123456789.125", "123456789.125"),
        1.5e-7: ("0.00000015", "1.5e-07"),
        1e-4: ("0.0001", "0.0001"),
        float("inf"): ("+Inf", "+Inf"),
    }
    df = spark.createDataFrame([(v,) for v in cases], "v double")
    for v, a, b in df.select("v", plain_double(F.col("v")), general_double(F.col("v"))).collect():
        assert (a, b) == cases[v]


def points_frame(spark, rows):
    slots = ("i", "u", "f", "s", "b")
    data = [
        (m, tags, {k: tuple(v if s == kind else None for s in slots) for k, (kind, v) in fields.items()}, t)
        for m, tags, fields, t in rows
    ]
    schema = f"measurement string, tags {TAGS_TYPE.simpleString()}, fields {FIELDS_TYPE.simpleString()}, time_ns bigint"
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize(
    ("row", "text"),
    [
        (("test", {"T0": "0"}, {"a": ("i", 1)}, 0), "test,T0=0 a=1i"),
        (("test,", {"T0": "0"}, {"a": ("i", 1)}, 0), r"test\,,T0=0 a=1i"),
        (("test ", {"T0": "0"}, {"a": ("i", 1)}, 0), r"test\ ,T0=0 a=1i"),
        (("test", {"T0,": "0"}, {"a": ("i", 1)}, 0), r"test,T0\,=0 a=1i"),
        (("test", {"T0=": "0"}, {"a": ("i", 1)}, 0), r"test,T0\==0 a=1i"),
        (("test", {"T0 ": "0"}, {"a": ("i", 1)}, 0), r"test,T0\ =0 a=1i"),
        (("test", {"T0": "0,"}, {"a": ("i", 1)}, 0), r"test,T0=0\, a=1i"),
        (("test", {"T0": "0="}, {"a": ("i", 1)}, 0), r"test,T0=0\= a=1i"),
        (("test", {"T0": "0 "}, {"a": ("i", 1)}, 0), r"test,T0=0\  a=1i"),
        (("test", {"T0": "0"}, {"a,": ("i", 1)}, 0), r"test,T0=0 a\,=1i"),
        (("test", {"T0": "0"}, {"a=": ("i", 1)}, 0), r"test,T0=0 a\==1i"),
        (("test", {"T0": "0"}, {"a ": ("i", 1)}, 0), r"test,T0=0 a\ =1i"),
        (("test", {"T0": "0"}, {"a": ("s", '1"')}, 0), r'test,T0=0 a="1\""'),
        (("test", {"T0": "0"}, {"a": ("s", "1\\")}, 0), r'test,T0=0 a="1\\"'),
        (("test", {}, {"a": ("b", True), "b": ("b", False), "c": ("u", Decimal(7))}, 3), "test a=T,b=F,c=7u 3"),
        (
            ("measurement", {"tag": "tag1"}, {"filed1": ("s", "string field")}, 1701433938132363612),
            'measurement,tag=tag1 filed1="string field" 1701433938132363612',
        ),
    ],
)
def test_encoder(spark, row, text):
    assert [r["value"] for r in encode_points(points_frame(spark, [row])).collect()] == [text]


def test_points_without_measurement_or_fields_give_no_line(spark):
    rows = [("", {}, {"a": ("i", 1)}, 1), ("m", {"t": "x"}, {}, 1), ("m", {"t": "x"}, {"a": ("i", 1)}, 1)]
    assert encode_points(points_frame(spark, rows)).count() == 1


def test_table_encoding_is_the_same_as_point_encoding(spark):
    df = spark.createDataFrame(
        [
            (1, "a b", None, 1.5, "x\"y\\", True, 5),
            (0, "c,=\\", "z", None, None, False, None),
            (3, None, None, 1e22, "", None, 2**40),
            (4, "q", "r", None, None, None, None),
        ],
        "time bigint, `tag b` string, `a=` string, f double, `s x` string, ok boolean, n bigint",
    )
    df = with_roles(df, time="time", tags=["tag b", "a="], fields=["f", "s x", "ok", "n"])
    now = F.lit(0).cast("bigint")
    expected = encode_points(wide_to_points(df, "m, x", now=now)).collect()
    assert sorted(encode_table(df, "m, x").collect()) == sorted(expected)
    assert len(expected) == 3


text = st.text(st.characters(blacklist_categories=("Cs", "Cc", "Zl", "Zp")), max_size=8)
name = text.filter(lambda s: s and s == s.strip())
value = st.one_of(
    st.tuples(st.just("i"), st.integers(-(2**63), 2**63 - 1)),
    st.tuples(st.just("f"), st.floats(allow_nan=False, allow_infinity=False)),
    st.tuples(st.just("s"), text),
    st.tuples(st.just("b"), st.booleans()),
    st.tuples(st.just("u"), st.integers(0, 2**64 - 1).map(Decimal)),
)
a_point = st.tuples(
    name, st.dictionaries(name, name, max_size=3), st.dictionaries(name, value, min_size=1, max_size=4), st.integers(1, 2**62)
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(a_point, min_size=1, max_size=40))
def test_round_trip(spark, rows):
    lines = encode_points(points_frame(spark, rows))
    back = require_clean(parse_lines(lines)).collect()

    def key(p):
        return repr((p[0], sorted(p[1].items()), sorted(p[2].items()), p[3]))

    assert sorted(key((*point(r), r["time_ns"])) for r in back) == sorted(key(r) for r in rows)


def test_insert_statements(spark):
    df = spark.createDataFrame(
        [
            (1, "INSERT weather,location=beijing temperature=25.5\n\n\nweather,location=shanghai temperature=28.0\n\n"),
            (2, "InSeRt weather,location=beijing temperature=25.5\r\nweather,location=shanghai temperature=28.0"),
            (3, "select 1"),
            (4, "INSERT    \n\n   "),
        ],
        "id int, command string",
    )
    points = require_clean(parse_lines(insert_lines(df)))
    assert sorted((r["id"], r["line_no"]) for r in points.collect()) == [(1, 1), (1, 4), (2, 1), (2, 2)]


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_files(spark, tmp_path, lines, compression):
    points = lines('m,a=b f=1,g="x y" 5', "m f=2i 6")
    path = str(tmp_path / "lp")
    write_lines(points, path, compression=compression)
    back = require_clean(parse_lines(read_lines(spark, path)))
    assert sorted(repr(point(r)) for r in back.collect()) == sorted(repr(point(r)) for r in points.collect())
    assert back.select("seq").distinct().count() == 2


def test_line_break_cannot_be_written(spark, tmp_path):
    points = points_frame(spark, [("m", {}, {"a": ("s", "x\ny")}, 1)])
    with pytest.raises(Exception, match="line break"):
        write_lines(points, str(tmp_path / "bad"))


def test_timestamps_that_do_not_fit_are_rejects(spark):
    from sparkseries.sources.lineproto import BAD_TIME, parse_lines

    df = spark.createDataFrame([("m f=1 99999999999999",), ("m f=1 5",)], "value string")
    assert sorted((r["reason"] or "", r["time_ns"] or 0) for r in parse_lines(df, precision="s").collect()) == [
        ("", 5 * 10**9),
        (BAD_TIME, 0),
    ]
