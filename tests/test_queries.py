"""Every registered query against DuckDB, on whole tables."""

from __future__ import annotations

import re

import __spark_entry__ as registry
import oracle
import pytest
from helpers import plan_text

FOLDER = "/root/testdata/sf0.001"
#: the training-data queries have tests of their own
OWN = sorted(n for n in registry.queries() if not re.match(r"op\d+_|pipeline$", n))


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", OWN)
def test_agrees_with_sql(spark, con, name):
    df = registry.queries()[name](spark, FOLDER)
    assert oracle.differences(df, con, registry.oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(OWN) <= set(registry.oracle_sql()) <= set(registry.queries())


def test_entry_is_stable(spark):
    df = registry.entry(spark)
    assert df.columns == ["event_type", "time", "c"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["count_by_time", "lp_roundtrip_events", "bind_templates", "merge_last_nonnull", "metric_rollup"])
def test_plans_have_no_python_and_no_cross_join(spark, name):
    plan = plan_text(registry.queries()[name](spark, FOLDER))
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_time_range_reaches_the_scan(spark):
    plan = plan_text(registry.queries()["count_by_time_range"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts,2024-01-02" in plan and "LessThan(ts,2024-01-05" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_top_cuts_before_the_shuffle(spark):
    assert plan_text(registry.queries()["top_by_tag"](spark, FOLDER)).count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan_text(registry.queries()["top_global"](spark, FOLDER))
