from __future__ import annotations

import numpy as np
import pytest
from helpers import plan_text
from pyspark.sql import functions as F

from sparkseries.model import SeriesError
from sparkseries.operators import opslog
from sparkseries.operators.opslog import classify_statements, clean_statement, metric_rollup, quantile_name, statement_counts

CLASSES = {
    **{f"{w} x": "Query" for w in ("SELECT", "show", "Explain", "DESCRIBE", "desc", "WITH")},
    **{f"{w} x": "Command" for w in ("CREATE", "drop", "Alter", "UPDATE", "delete")},
    "INSERT m f=1": "Insert",
    "insert m f=1\n\n m f=2 ": "Insert",
    "": "Unknown",
    "   ": "Unknown",
    "SELECTED x": "Unknown",
    "-- SELECT\nSELECT": "Unknown",
    "SELECT 1 -- tail": "Query",
    "/* a */ SELECT 1": "Query",
    "/* a */SELECT/* b */* FROM m": "Query",
    "/*/SELECT 1": "Query",
    "/* open SELECT 1": "Unknown",
    "/* a\nb */\n\tSHOW DATABASES": "Query",
    "DROP/* x */MEASUREMENT m": "Command",
    "\n\n  select\n*": "Query",
}


def test_statement_classes(spark):
    df = spark.createDataFrame([(t,) for t in CLASSES], "command string")
    rows = {r["command"]: r for r in classify_statements(df).collect()}
    assert {t: r["class"] for t, r in rows.items()} == CLASSES
    assert rows["insert m f=1\n\n m f=2 "]["affected_rows"] == 2
    assert rows["drop x"]["affected_rows"] == 1 and rows["show x"]["affected_rows"] == 0
    assert rows[""]["affected_rows"] is None
    counts = {r["class"]: (r["n"], r["affected_rows"]) for r in statement_counts(df).collect()}
    assert counts["Insert"] == (2, 3) and counts["Command"] == (6, 6) and counts["Unknown"][1] == 0
    cleaned = spark.createDataFrame([("a /* x */ b -- c",)], "t string").select(clean_statement(F.col("t"))).first()[0]
    assert cleaned.split() == ["a", "b"]


def check(spark, rows, quantiles=(0.5, 0.9, 0.99)):
    df = spark.createDataFrame(rows, "kind string, database string, latency double").repartition(6)
    found = {(r["kind"], r["is_total"], r["database"]): r for r in metric_rollup(df, quantiles=quantiles).collect()}
    groups = {}
    for kind, database, latency in rows:
        groups.setdefault((kind, True, None), []).append(latency)
        groups.setdefault((kind, False, database), []).append(latency)
    assert set(found) == set(groups)
    for key, values in groups.items():
        row, known = found[key], [v for v in values if v is not None]
        assert row["requests"] == len(values)
        for q in quantiles:
            expected = float(np.quantile(known, q)) if known else None
            assert row[quantile_name(q)] == (pytest.approx(expected) if known else None)


def test_exact_quantiles(spark):
    rng = np.random.default_rng(3)
    rows = [("query", f"d{n % 3}", float(v)) for n, v in enumerate(rng.gamma(2, 9, 500))]
    rows += [("write", None, 1.0), ("write", "d0", None), ("idle", "d0", None), ("write", "d1", 5.0)]
    check(spark, rows, (0.0, 0.5, 0.9, 0.99, 1.0))


@pytest.mark.parametrize("hot_value", [False, True])
def test_exact_quantiles_in_brackets(spark, monkeypatch, hot_value):
    """Groups above the small size, one with a third of its rows at one value."""
    monkeypatch.setattr(opslog, "_SMALL_GROUP", 100)
    monkeypatch.setattr(opslog, "_ACCURACY", 200)
    rng = np.random.default_rng(4)
    values = rng.gamma(2, 9, 4_000)
    if hot_value:
        values[: len(values) // 3] = 7.25
    check(spark, [("query", f"d{n % 2}", float(v)) for n, v in enumerate(values)])


def test_approximate_quantiles_keep_their_rank_error(spark):
    rng = np.random.default_rng(5)
    values = rng.permutation(5_000).astype(float)
    df = spark.createDataFrame([("query", "d", float(v)) for v in values], "kind string, database string, latency double")
    for row in metric_rollup(df, approximate=True).collect():
        assert row["requests"] == 5_000 and row["latency_sum"] == values.sum()
        for q, error in opslog.QUANTILE_ERRORS.items():
            assert abs(row[quantile_name(q)] / 5_000 - q) <= error


def test_wrong_quantiles(spark):
    for wrong in ([], [1.5]):
        with pytest.raises(SeriesError):
            metric_rollup(spark.range(1).selectExpr("'a' AS kind", "'b' AS database", "1D AS latency"), quantiles=wrong)


@pytest.mark.parametrize("shape", ["spread", "hot low", "hot high", "two values", "hot amid", "nulls"])
def test_brackets_are_narrowed_until_they_are_small(spark, monkeypatch, shape):
    monkeypatch.setattr(opslog, "_SMALL_GROUP", 12)
    monkeypatch.setattr(opslog, "_ACCURACY", 400)
    rng = np.random.default_rng(5)
    values = [float(v) for v in rng.gamma(2, 9, 4_000)]
    hot = {"hot low": 0.0, "hot high": 1e6, "hot amid": 15.0}
    if shape in hot:
        values = [hot[shape] if i % 20 else v for i, v in enumerate(values)]
    if shape == "two values":
        values = [float(i % 2) for i in range(4_000)]
    if shape == "nulls":
        values = [None if i % 3 else v for i, v in enumerate(values)]
    rows = [("query", f"d{i % 2}" if i % 50 else None, v) for i, v in enumerate(values)]
    check(spark, rows, (0.0, 0.03, 0.5, 0.96, 0.99, 1.0))


def test_a_hot_group_needs_no_window(spark):
    df = spark.range(60_000).selectExpr("'query' AS kind", "'hot' AS database", "CAST(id % 40000 AS double) AS latency")
    rolled = metric_rollup(df)
    plan = plan_text(rolled)
    assert "Window" not in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert rolled.where("is_total").first()["p50"] == float(np.quantile(np.arange(60_000) % 40_000, 0.5))
