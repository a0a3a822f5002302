"""

Every query reads whole tables.  ``oracle_sql`` gives for each query the SQL
that DuckDB runs on the same files; column names agree on both sides.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkseries import (
    Query,
    all_of,
    any_of,
    arithmetic,
    bound_where,
    call,
    compare,
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
from sparkseries.functions.timefns import epoch_ns, from_precision, ns_to_ntz, to_precision
from sparkseries.functions.values import infer_value, slot_value, value_type
from sparkseries.operators.explore import (
    series_cardinality,
    show_field_keys,
    show_measurements,
    show_series,
    show_tag_keys,
    show_tag_values,
    table_field_keys,
)
from sparkseries.operators.opslog import metric_rollup, statement_counts
from sparkseries.operators.points import points_to_wide, tag_sets, wide_to_points
from sparkseries.operators.postings import index_version, is_current, lookup_postings, merge_postings, read_postings
from sparkseries.operators.quality import (
    REASONS,
    block_stats,
    check_record,
    merge_duplicates,
    merge_points,
    reject_reasons,
    type_conflicts,
)
from sparkseries.operators.retention import keep_retained, policies, policy_report, resolve_policy, shard_group
from sparkseries.operators.templates import bind_statement, bind_templates, bound_points, parameters
from sparkseries.operators.textindex import read_text_index, search, search_texts, text_index, write_text_index
from sparkseries.plans.paging import page
from sparkseries.session import scratch_folder
from sparkseries.sources.documents import document_rows, result_documents, series_documents
from sparkseries.sources.layout import (
    SHARD,
    STORED_POINTS,
    drop_expired,
    drop_measurement,
    expired_groups,
    read_measurement,
    read_points,
    without_measurement,
    write_measurement,
    write_points,
)
from sparkseries.sources.lineproto import encode_line, encode_points, encode_table, good_points, parse_lines
from sparkseries.streaming.ingest import BATCH, PART, ingested_points, line_stream, outcomes, routed_stream, start_ingest, write_batch

SMALL = "/root/testdata/sf0.001"

# --------------------------------------------------------------------------
# the supplied tables as measurements


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_roles(
        _table(spark, sf_dir, "events"),
        time="ts",
        tags=["event_type", "user_id"],
        fields=["event_id", "value", "props"],
    )


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_roles(
        _table(spark, sf_dir, "lineitem"),
        time="l_shipdate",
        tags=["l_returnflag", "l_linestatus"],
        fields=[
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
        ],
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_roles(
        _table(spark, sf_dir, "orders"),
        time="o_orderdate",
        tags=["o_orderstatus", "o_orderpriority"],
        fields=["o_orderkey", "o_custkey", "o_totalprice"],
    )


def _event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_to_points(_events(spark, sf_dir), "events")


def _all_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        wide_to_points(_events(spark, sf_dir), "events"),
        wide_to_points(_lineitem(spark, sf_dir), "lineitem"),
        wide_to_points(_orders(spark, sf_dir), "orders"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


LINE_TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]

Query_ = Callable[[SparkSession, str], DataFrame]
Queries = dict[str, Query_]
_QUERIES: Queries = {}
_SQL: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def keep(function):
        _QUERIES[name] = function
        if sql:
            _SQL[name] = sql
        return function

    return keep


# --------------------------------------------------------------------------
# projection


@_register("select_all", "SELECT o_orderstatus, o_orderpriority, o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def _(spark, d):
    return Query().build(_orders(spark, d))


@_register("select_fields", "SELECT o_orderpriority, o_totalprice FROM orders")
def _(spark, d):
    return Query().select("o_orderpriority", "o_totalprice").build(_orders(spark, d))


@_register("select_alias", "SELECT o_totalprice AS price, o_orderkey AS id FROM orders")
def _(spark, d):
    return Query().select(field_of("o_totalprice").alias("price"), field_of("o_orderkey").alias("id")).build(_orders(spark, d))


@_register(
    "arith_nested",
    "SELECT l_orderkey, l_linenumber, (l_quantity * 4) + 2 AS a, l_tax / nullif(l_discount, 0) AS d FROM lineitem",
)
def _(spark, d):
    a = arithmetic("+", arithmetic("*", "l_quantity", 4), 2).alias("a")
    ratio = arithmetic("/", "l_tax", "l_discount").alias("d")
    return Query().select("l_orderkey", "l_linenumber", a, ratio).build(_lineitem(spark, d))


# --------------------------------------------------------------------------
# conditions

for _name, _op, _sql_op in [
    ("where_gt", ">", ">"),
    ("where_lt", "<", "<"),
    ("where_ge", ">=", ">="),
    ("where_le", "<=", "<="),
]:

    def _where(spark, d, op=_op):
        return Query().select("event_id", "value").where(compare("value", op, 25.5)).build(_events(spark, d))

    _register(_name, f"SELECT event_id, value FROM events WHERE value {_sql_op} 25.5")(_where)


@_register("where_eq", "SELECT event_id, event_type FROM events WHERE event_type = 'click'")
def _(spark, d):
    return Query().select("event_id", "event_type").where(compare("event_type", "=", "click")).build(_events(spark, d))


@_register("where_ne", "SELECT event_id, event_type FROM events WHERE event_type <> 'click'")
def _(spark, d):
    return Query().select("event_id", "event_type").where(compare("event_type", "<>", "click")).build(_events(spark, d))


@_register("where_match", "SELECT event_id, event_type FROM events WHERE regexp_matches(event_type, '^(cl|vi).*')")
def _(spark, d):
    return Query().select("event_id", "event_type").where(compare("event_type", "=~", "/^(cl|vi).*/")).build(_events(spark, d))


@_register("where_notmatch", "SELECT event_id, event_type FROM events WHERE NOT regexp_matches(event_type, 'c[lh]')")
def _(spark, d):
    return Query().select("event_id", "event_type").where(compare("event_type", "!~", "/c[lh]/")).build(_events(spark, d))


@_register(
    "where_nested",
    "SELECT event_id, value FROM events WHERE event_type <> 'view' AND (value < 5 OR value > 90.5)",
)
def _(spark, d):
    condition = all_of(compare("event_type", "<>", "view"), any_of(compare("value", "<", 5), compare("value", ">", 90.5)))
    return Query().select("event_id", "value").where(condition).build(_events(spark, d))


@_register(
    "where_time_range",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts <= TIMESTAMP '2024-01-20 18:30:00'",
)
def _(spark, d):
    span = time_range("2024-01-10T06:00:00Z", "2024-01-20T18:30:00Z", closed=True)
    return Query().select("event_id", "ts").where(span).build(_events(spark, d))


@_register("bound_params", "SELECT event_id, event_type, value FROM events WHERE event_type = 'purchase' AND value > 20.5")
def _(spark, d):
    rows = bound_where(_events(spark, d), "event_type = :kind AND value > :low", kind="purchase", low=20.5)
    return rows.select("event_id", "event_type", "value")


@_register(
    "from_many",
    "SELECT 'events' AS measurement, ts AS time, value AS v FROM events "
    "UNION ALL SELECT 'orders', o_orderdate, o_totalprice FROM orders",
)
def _(spark, d):
    tables = {
        "events": _events(spark, d).select(F.col("ts").alias("time"), F.col("value").alias("v")),
        "orders": _orders(spark, d).select(F.col("o_orderdate").alias("time"), F.col("o_totalprice").alias("v")),
    }
    return Query().select("time", "v").from_("events", "orders").build(tables)


@_register(
    "from_many_limit",
    "SELECT measurement, time, v FROM (SELECT 'events' AS measurement, ts AS time, value AS v, event_id AS id FROM events "
    "UNION ALL SELECT 'orders', o_orderdate, o_totalprice, o_orderkey FROM orders) ORDER BY time, measurement, id LIMIT 40",
)
def _(spark, d):
    tables = {
        "events": _events(spark, d).select(F.col("ts").alias("time"), F.col("value").alias("v"), F.col("event_id").alias("id")),
        "orders": _orders(spark, d).select(
            F.col("o_orderdate").alias("time"), F.col("o_totalprice").alias("v"), F.col("o_orderkey").alias("id")
        ),
    }
    query = Query().select("time", "v").from_("events", "orders").tie_break("id").limit(40, "global")
    return query.build(tables)


@_register(
    "top_limit",
    "SELECT l_returnflag, time, top FROM (SELECT l_returnflag, l_shipdate AS time, l_extendedprice AS top, row_number() OVER "
    "(PARTITION BY l_returnflag ORDER BY l_shipdate, l_extendedprice) p FROM (SELECT *, row_number() OVER "
    "(PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) r "
    "FROM lineitem) WHERE r <= 5) WHERE p <= 2",
)
def _(spark, d):
    query = Query().select(top("l_extendedprice", 5)).group_by("l_returnflag").tie_break(*LINE_TIES).limit(2)
    return query.build(_lineitem(spark, d))


@_register(
    "mean_limit_global",
    "SELECT l_returnflag, avg(l_quantity) AS m FROM lineitem GROUP BY 1 ORDER BY 1 LIMIT 1 OFFSET 1",
)
def _(spark, d):
    query = Query().select(mean("l_quantity").alias("m")).group_by("l_returnflag").limit(1, "global").offset(1, "global")
    return query.build(_lineitem(spark, d))


@_register("mean_order", "SELECT l_returnflag, avg(l_quantity) AS m FROM lineitem GROUP BY 1 ORDER BY 1")
def _(spark, d):
    query = Query().select(mean("l_quantity").alias("m")).group_by("l_returnflag").order_by("ASC")
    return query.build(_lineitem(spark, d))


@_register("scope_rp", "SELECT event_id, value FROM events WHERE event_type = 'click'")
def _(spark, d):
    scoped = _events(spark, d).withColumn("db", F.lit("metrics")).withColumn("rp", F.col("event_type"))
    return in_scope(scoped, "metrics", "click").select("event_id", "value")


# --------------------------------------------------------------------------
# aggregates and selectors


@_register("call_function_stddev", "SELECT event_type, round(stddev_samp(value), 4) AS sd FROM events GROUP BY 1")
def _(spark, d):
    sd = call("stddev_samp", "value").alias("sd")
    return Query().select(sd).group_by("event_type").build(_events(spark, d)).withColumn("sd", F.round("sd", 4))


@_register("mean_by_tag", "SELECT l_returnflag, avg(l_quantity) AS m FROM lineitem GROUP BY 1")
def _(spark, d):
    return Query().select(mean("l_quantity").alias("m")).group_by("l_returnflag").build(_lineitem(spark, d))


@_register("sum_by_tag", "SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS s FROM lineitem GROUP BY 1, 2")
def _(spark, d):
    rows = Query().select(sum_("l_extendedprice").alias("s")).group_by("l_returnflag", "l_linestatus").build(_lineitem(spark, d))
    return rows.withColumn("s", F.round("s", 2))


@_register("min_by_tag", "SELECT event_type, min(value) AS lo, min(event_id) AS first_id FROM events GROUP BY 1")
def _(spark, d):
    return Query().select(min_("value").alias("lo"), min_("event_id").alias("first_id")).group_by("event_type").build(_events(spark, d))


@_register("max_by_tag", "SELECT event_type, max(value) AS hi, max(props) AS last_props FROM events GROUP BY 1")
def _(spark, d):
    return Query().select(max_("value").alias("hi"), max_("props").alias("last_props")).group_by("event_type").build(_events(spark, d))


@_register(
    "count_by_time",
    "SELECT event_type, time_bucket(INTERVAL '12 minutes', ts, TIMESTAMP '1970-01-01') AS time, count(value) AS c "
    "FROM events GROUP BY 1, 2",
)
def _count_by_time(spark, d):
    query = Query().select(count("value").alias("c")).group_by("event_type", time("12m")).order_by("DESC")
    return query.build(_events(spark, d))


@_register(
    "count_by_time_range",
    "SELECT event_type, time_bucket(INTERVAL '12 minutes', ts, TIMESTAMP '1970-01-01') AS time, count(value) AS c "
    "FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-05' GROUP BY 1, 2",
)
def _(spark, d):
    query = (
        Query()
        .select(count("value").alias("c"))
        .where(time_range("2024-01-02T00:00:00Z", "2024-01-05T00:00:00Z"))
        .group_by("event_type", time("12m"))
        .order_by("DESC")
    )
    return query.build(_events(spark, d))


@_register(
    "mean_by_tag_time",
    "SELECT l_returnflag, time_bucket(INTERVAL '7 days', l_shipdate, TIMESTAMP '1970-01-01') AS time, "
    "avg(l_quantity) AS m, count(l_quantity) AS n FROM lineitem GROUP BY 1, 2",
)
def _(spark, d):
    query = Query().select(mean("l_quantity").alias("m"), count("l_quantity").alias("n")).group_by("l_returnflag", time("7d"))
    return query.build(_lineitem(spark, d))


@_register("count_global", "SELECT count(value) AS n, max(value) AS hi FROM events WHERE event_type <> 'view'")
def _(spark, d):
    query = Query().select(count("value").alias("n"), max_("value").alias("hi")).where(compare("event_type", "<>", "view"))
    return query.build(_events(spark, d))


@_register("range_by_tag", "SELECT l_returnflag, max(l_quantity) - min(l_quantity) AS q_range FROM lineitem GROUP BY 1")
def _(spark, d):
    spread = arithmetic("-", max_("l_quantity"), min_("l_quantity")).alias("q_range")
    return Query().select(spread).group_by("l_returnflag").build(_lineitem(spark, d))


@_register(
    "last_global",
    "SELECT ts AS time, value AS last, CAST(user_id AS VARCHAR) AS user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1",
)
def _(spark, d):
    return Query().select(last("value"), "user_id").tie_break("event_id").build(_events(spark, d))


@_register(
    "last_by_tag",
    "SELECT event_type, ts AS time, value AS last, CAST(user_id AS VARCHAR) AS user_id FROM "
    "(SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) r FROM events) WHERE r = 1",
)
def _(spark, d):
    return Query().select(last("value"), "user_id").group_by("event_type").tie_break("event_id").build(_events(spark, d))


@_register(
    "top_global",
    "SELECT l_shipdate AS time, l_extendedprice AS top, l_orderkey FROM lineitem "
    "ORDER BY l_extendedprice DESC, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10",
)
def _(spark, d):
    return Query().select(top("l_extendedprice", 10), "l_orderkey").tie_break(*LINE_TIES).build(_lineitem(spark, d))


@_register(
    "top_by_tag",
    "SELECT l_returnflag, l_shipdate AS time, l_extendedprice AS top FROM (SELECT *, row_number() OVER "
    "(PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) r "
    "FROM lineitem) WHERE r <= 5",
)
def _(spark, d):
    query = Query().select(top("l_extendedprice", 5)).group_by("l_returnflag").tie_break(*LINE_TIES)
    return query.build(_lineitem(spark, d))


# --------------------------------------------------------------------------
# order, limit, offset


@_register("order_desc", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id")
def _(spark, d):
    return Query().select("event_id", "ts").order_by("DESC").tie_break("event_id").build(_events(spark, d))


@_register("limit_offset", "SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 30 OFFSET 3")
def _(spark, d):
    return Query().select("event_id", "ts").order_by("ASC").tie_break("event_id").limit(30).offset(3).build(_events(spark, d))


@_register("offset_only", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id OFFSET 1234")
def _(spark, d):
    rows = page(_events(spark, d), time="ts", ties=["event_id"], offset=1234, descending=True)
    return rows.select("event_id", "ts")


@_register(
    "limit_per_series",
    "SELECT o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) r FROM orders) WHERE r BETWEEN 3 AND 5",
)
def _(spark, d):
    query = Query().select("o_orderkey").group_by("o_orderstatus").tie_break("o_orderkey").limit(3).offset(2)
    return query.build(_orders(spark, d))


@_register(
    "offset_per_series",
    "SELECT o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) r FROM orders) WHERE r > 100",
)
def _(spark, d):
    query = Query().select("o_orderkey").group_by("o_orderstatus").tie_break("o_orderkey").offset(100)
    return query.build(_orders(spark, d))


# --------------------------------------------------------------------------
# time


@_register(
    "tz_day_buckets",
    "SELECT timezone('UTC', timezone('America/Chicago', date_trunc('day', "
    "timezone('America/Chicago', timezone('UTC', ts))))) AS time, count(value) AS c FROM events GROUP BY 1",
)
def _(spark, d):
    return Query().select(count("value").alias("c")).group_by(time("1d")).timezone("America/Chicago").build(_events(spark, d))


@_register(
    "epoch_precisions",
    "SELECT event_id, epoch_ns(ts) AS ns, epoch_us(ts) AS u, epoch_us(ts) // 1000 AS ms, epoch_us(ts) // 1000000 AS s, "
    "epoch_us(ts) // 60000000 AS m, epoch_us(ts) // 3600000000 AS h FROM events",
)
def _(spark, d):
    df = _events(spark, d)
    ns = epoch_ns(df, "ts")
    return df.select("event_id", *(to_precision(ns, p).alias(p) for p in ("ns", "u", "ms", "s", "m", "h")))


@_register(
    "epoch_normalise",
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_ns(ts) WHEN 1 THEN epoch_us(ts) * 1000 "
    "WHEN 2 THEN epoch_us(ts) // 1000 * 1000000 ELSE epoch_us(ts) // 1000000 * 1000000000 END AS time_ns FROM events",
)
def _(spark, d):
    df = _events(spark, d)
    ns, kind = epoch_ns(df, "ts"), F.col("event_id") % 4
    named = F.when(kind == 0, "ns").when(kind == 1, "u").when(kind == 2, "ms").otherwise("s")
    given = F.when(kind == 0, ns)
    for number, name in ((1, "u"), (2, "ms"), (3, "s")):
        given = given.when(kind == number, to_precision(ns, name))
    source = df.select("event_id", named.alias("precision"), given.alias("t"))
    return source.select("event_id", from_precision(F.col("t"), F.col("precision")).alias("time_ns"))


# --------------------------------------------------------------------------
# schema exploration


@_register("show_measurements", "SELECT 'events' AS measurement FROM events UNION SELECT 'orders' FROM orders")
def _(spark, d):
    return show_measurements(_all_points(spark, d), "=~", "/^(ev|or)/")


@_register(
    "show_tag_keys",
    "SELECT 'events' AS measurement, 'user_id' AS key FROM events WHERE user_id IS NOT NULL "
    "UNION SELECT 'lineitem', 'l_returnflag' FROM lineitem WHERE l_returnflag IS NOT NULL "
    "UNION SELECT 'orders', 'o_orderstatus' FROM orders WHERE o_orderstatus IS NOT NULL",
)
def _(spark, d):
    return show_tag_keys(_all_points(spark, d), limit=1, offset=1)


@_register(
    "show_tag_values",
    "SELECT DISTINCT 'orders' AS measurement, 'o_orderpriority' AS key, o_orderpriority AS value FROM orders WHERE o_orderstatus = 'F'",
)
def _(spark, d):
    return show_tag_values(_all_points(spark, d), "o_orderpriority", "orders", where=("o_orderstatus", "=", "F"), order="ASC")


@_register(
    "show_tag_values_in",
    "SELECT DISTINCT 'events' AS measurement, 'event_type' AS key, event_type AS value FROM events "
    "UNION SELECT DISTINCT 'events', 'user_id', CAST(user_id AS VARCHAR) FROM events",
)
def _(spark, d):
    return show_tag_values(_event_points(spark, d), ["event_type", "user_id"])


@_register(
    "show_tag_values_regex",
    "SELECT DISTINCT CAST(user_id AS VARCHAR) AS value FROM events WHERE event_type = 'click' ORDER BY 1 LIMIT 5 OFFSET 10",
)
def _(spark, d):
    values = show_tag_values(
        _event_points(spark, d), "/user.*/", where=("event_type", "=", "click"), order="ASC", limit=5, offset=10
    )
    return values.select("value")


@_register(
    "show_field_keys",
    "SELECT * FROM (VALUES ('events', 'event_id', 'integer'), ('events', 'value', 'float'), ('events', 'props', 'string'), "
    "('lineitem', 'l_orderkey', 'integer'), ('lineitem', 'l_partkey', 'integer'), ('lineitem', 'l_suppkey', 'integer'), "
    "('lineitem', 'l_linenumber', 'integer'), ('lineitem', 'l_quantity', 'float'), ('lineitem', 'l_extendedprice', 'float'), "
    "('lineitem', 'l_discount', 'float'), ('lineitem', 'l_tax', 'float'), ('orders', 'o_orderkey', 'integer'), "
    "('orders', 'o_custkey', 'integer'), ('orders', 'o_totalprice', 'float')) t(measurement, key, type)",
)
def _(spark, d):
    return show_field_keys(_all_points(spark, d))


@_register(
    "show_field_keys_table",
    "SELECT * FROM (VALUES ('lineitem', 'l_orderkey', 'integer'), ('lineitem', 'l_partkey', 'integer'), "
    "('lineitem', 'l_suppkey', 'integer'), ('lineitem', 'l_linenumber', 'integer'), ('lineitem', 'l_quantity', 'float'), "
    "('lineitem', 'l_extendedprice', 'float'), ('lineitem', 'l_discount', 'float'), ('lineitem', 'l_tax', 'float')) "
    "t(measurement, key, type)",
)
def _(spark, d):
    return table_field_keys(_lineitem(spark, d), "lineitem")


@_register(
    "show_series",
    "SELECT DISTINCT 'lineitem,l_linestatus=' || l_linestatus || ',l_returnflag=' || l_returnflag AS key FROM lineitem",
)
def _(spark, d):
    return show_series(tag_sets(_lineitem(spark, d), "lineitem"))


@_register(
    "show_series_where",
    "SELECT DISTINCT 'events,event_type=' || event_type || ',user_id=' || user_id AS key FROM events "
    "WHERE event_type = 'click' ORDER BY key LIMIT 20 OFFSET 5",
)
def _(spark, d):
    return show_series(_event_points(spark, d), where=("event_type", "=", "click"), limit=20, offset=5)


@_register(
    "series_cardinality",
    "SELECT 'events' AS measurement, count(DISTINCT (event_type, user_id)) AS n FROM events "
    "UNION ALL SELECT 'lineitem', count(DISTINCT (l_returnflag, l_linestatus)) FROM lineitem "
    "UNION ALL SELECT 'orders', count(DISTINCT (o_orderstatus, o_orderpriority)) FROM orders",
)
def _(spark, d):
    return series_cardinality(_all_points(spark, d))


_POLICY_ROWS = [
    {"db": "tpch", "name": "F", "duration": "365d", "shard_group_duration": "7d", "is_default": True},
    {"db": "tpch", "name": "O", "duration": "17520h0m0s", "shard_group_duration": "1d"},
    {"db": "tpch", "name": "P", "duration": "100000d"},
]


def _order_points(spark: SparkSession, d: str) -> DataFrame:
    scoped = _orders(spark, d).withColumn("db", F.lit("tpch")).withColumn("rp", F.col("o_orderstatus"))
    return wide_to_points(
        scoped, "orders", tags=["o_orderpriority"], fields=["o_orderkey", "o_totalprice"], time="o_orderdate", keep=["db", "rp"]
    )


@_register(
    "policy_report",
    "SELECT p.name, p.duration, p.is_default, count(o_orderkey) AS row_count, min(epoch_ns(o_orderdate)) AS min_time, "
    "max(epoch_ns(o_orderdate)) AS max_time FROM (VALUES ('F', '8760h0m0s', true), ('O', '17520h0m0s', false), "
    "('P', '2400000h0m0s', false)) p(name, duration, is_default) LEFT JOIN orders ON o_orderstatus = p.name GROUP BY 1, 2, 3",
)
def _(spark, d):
    report = policy_report(_order_points(spark, d), policies(spark, _POLICY_ROWS))
    return report.select("name", "duration", "is_default", "row_count", "min_time", "max_time")


@_register(
    "drop_measurement",
    "SELECT event_type AS measurement, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY 1",
)
def _(spark, d):
    points = _event_points(spark, d).withColumn("db", F.lit("metrics")).withColumn("rp", F.lit("autogen"))
    points = points.withColumn("measurement", F.col("tags")["event_type"])
    return without_measurement(points, "metrics", "", "click").groupBy("measurement").agg(F.count(F.lit(1)).alias("n"))


@_register(
    "show_tag_values_page",
    "SELECT 'orders' AS measurement, 'order' AS key, CAST(o_orderkey AS VARCHAR) AS value FROM orders "
    "ORDER BY value DESC LIMIT 12000 OFFSET 1500",
)
def _(spark, d):
    orders = _orders(spark, d).withColumn("order", F.col("o_orderkey").cast("string"))
    points = wide_to_points(orders, "orders", tags=["order"], fields=["o_totalprice"], time="o_orderdate")
    return show_tag_values(points, keys=["order"], order="DESC", limit=12_000, offset=1_500)


# --------------------------------------------------------------------------
# quality


@_register(
    "merge_last_nonnull",
    "WITH x AS (SELECT *, CASE WHEN l_quantity > 25 THEN l_quantity END q FROM lineitem) "
    "SELECT l_returnflag, l_linestatus, l_shipdate, "
    "(list(q ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) "
    "FILTER (q IS NOT NULL))[1] AS q, "
    "(list(l_tax ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC))[1] AS tax "
    "FROM x GROUP BY 1, 2, 3",
)
def _(spark, d):
    df = _lineitem(spark, d).select(
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
        *LINE_TIES,
        F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("q"),
        F.col("l_tax").alias("tax"),
    )
    return merge_duplicates(df, ["l_returnflag", "l_linestatus", "l_shipdate"], LINE_TIES, ["q", "tax"])


@_register(
    "merge_points",
    "WITH x AS (SELECT *, CASE WHEN l_quantity > 25 THEN l_quantity END q FROM lineitem) "
    "SELECT l_returnflag, l_linestatus, epoch_ns(l_shipdate) AS time_ns, "
    "(list(q ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) "
    "FILTER (q IS NOT NULL))[1] AS q, "
    "(list(l_tax ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC))[1] AS tax "
    "FROM x GROUP BY l_returnflag, l_linestatus, l_shipdate",
)
def _(spark, d):
    df = _lineitem(spark, d)
    df = df.withColumn("q", F.when(F.col("l_quantity") > 25, F.col("l_quantity"))).withColumn("tax", F.col("l_tax"))
    points = wide_to_points(
        df, "lineitem", time="l_shipdate", tags=["l_returnflag", "l_linestatus"], fields=["q", "tax"], keep=LINE_TIES
    )
    return merge_points(points, LINE_TIES).select(
        F.col("tags")["l_returnflag"].alias("l_returnflag"),
        F.col("tags")["l_linestatus"].alias("l_linestatus"),
        "time_ns",
        F.col("fields")["q"]["f"].alias("q"),
        F.col("fields")["tax"]["f"].alias("tax"),
    )


@_register(
    "validate_record",
    "SELECT 'time_null' AS \"check\", count(*) FILTER (event_id % 10 = 0) AS violations FROM events "
    "UNION ALL SELECT * FROM (VALUES ('time_missing', 0), ('time_not_last', 1), ('no_other_column', 0), ('repeated_name', 0), "
    "('names_not_sorted', 0)) t",
)
def _(spark, d):
    df = _table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("time"), "value")
    return check_record(df)


@_register(
    "reject_reasons",
    "SELECT CASE event_id % 6 WHEN 1 THEN 'empty measurement' WHEN 2 THEN 'no field' WHEN 3 THEN 'tag name time is reserved' "
    "WHEN 4 THEN 'empty field name' WHEN 5 THEN 'empty measurement; field name time is reserved' ELSE '' END AS reasons, "
    "count(*) AS n FROM events GROUP BY 1",
)
def _(spark, d):
    kind = F.col("event_id") % 6
    field_name = F.when(kind == 4, "").when(kind == 5, "time").otherwise("value")
    fields = F.create_map(field_name, slot_value("f", F.col("value")))
    points = _events(spark, d).select(
        F.when(~kind.isin(1, 5), "events").otherwise("").alias("measurement"),
        F.create_map(F.when(kind == 3, "time").otherwise("event_type"), F.col("event_type")).alias("tags"),
        F.when(kind == 2, F.map_filter(fields, lambda k, v: F.lit(False))).otherwise(fields).alias("fields"),
    )
    return (
        reject_reasons(points).groupBy(F.concat_ws("; ", REASONS).alias("reasons")).agg(F.count(F.lit(1)).alias("n"))
    )


@_register(
    "infer_field_types",
    "SELECT CASE event_id % 7 WHEN 0 THEN 'integer' WHEN 1 THEN 'unsigned' WHEN 2 THEN 'float' WHEN 3 THEN 'boolean' "
    "WHEN 4 THEN 'boolean' ELSE 'string' END AS type, count(*) AS n FROM events GROUP BY 1",
)
def _(spark, d):
    kind, number = F.col("event_id") % 7, F.col("event_id").cast("string")
    text = (
        F.when(kind == 0, F.concat(number, F.lit("i")))
        .when(kind == 1, F.concat(number, F.lit("u")))
        .when(kind == 2, F.col("value").cast("string"))
        .when(kind == 3, "T")
        .when(kind == 4, "FALSE")
        .when(kind == 5, F.concat(F.lit('"'), F.col("event_type"), F.lit('"')))
        .otherwise(F.concat(number, F.lit("d")))
    )
    typed = _events(spark, d).select(value_type(infer_value(text)).alias("type"))
    return typed.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@_register(
    "type_conflicts",
    "SELECT event_type AS measurement, 'value' AS key, CASE WHEN bool_or(event_id % 3 = 0) AND bool_or(event_id % 3 <> 0) "
    "THEN 'float,string' END AS types FROM events WHERE event_type IN ('click', 'view') GROUP BY 1",
)
def _(spark, d):
    mixed = F.col("event_type").isin("click", "view") & (F.col("event_id") % 3 == 0)
    value = F.when(mixed, slot_value("s", F.col("value").cast("string"))).otherwise(slot_value("f", F.col("value")))
    points = _events(spark, d).select(
        F.col("event_type").alias("measurement"),
        F.create_map(F.lit("user_id"), F.col("user_id")).alias("tags"),
        F.create_map(F.lit("value"), value).alias("fields"),
    )
    return type_conflicts(points).withColumn("types", F.array_join("types", ","))


@_register(
    "block_stats",
    "SELECT 'events' AS measurement, count(*) AS row_count, min(epoch_ns(ts)) AS min_time, max(epoch_ns(ts)) AS max_time FROM events "
    "UNION ALL SELECT 'lineitem', count(*), min(epoch_ns(l_shipdate)), max(epoch_ns(l_shipdate)) FROM lineitem "
    "UNION ALL SELECT 'orders', count(*), min(epoch_ns(o_orderdate)), max(epoch_ns(o_orderdate)) FROM orders",
)
def _(spark, d):
    return block_stats(_all_points(spark, d))


@_register(
    "record_union",
    "SELECT ts AS time, event_type, NULL::VARCHAR AS o_orderstatus, event_id, NULL::BIGINT AS o_orderkey, value, "
    "NULL::DOUBLE AS o_totalprice FROM events UNION ALL "
    "SELECT o_orderdate, NULL, o_orderstatus, NULL, o_orderkey, NULL, o_totalprice FROM orders",
)
def _(spark, d):
    events = wide_to_points(_events(spark, d), "mixed", tags=["event_type"], fields=["event_id", "value"])
    orders = wide_to_points(_orders(spark, d), "mixed", tags=["o_orderstatus"], fields=["o_orderkey", "o_totalprice"])
    wide = points_to_wide(events.unionByName(orders), "mixed")
    return wide.withColumn("time", F.to_utc_timestamp("time", F.current_timezone()).cast("timestamp_ntz"))


# --------------------------------------------------------------------------
# retention


@_register(
    "retention_keep",
    "SELECT o_orderkey FROM orders JOIN (VALUES ('F', 365), ('O', 730), ('P', 100000)) p(st, d) ON o_orderstatus = st "
    "WHERE o_orderdate >= TIMESTAMP '1998-01-01' - to_days(d)",
)
def _(spark, d):
    orders = _orders(spark, d).withColumn("db", F.lit("tpch")).withColumn("rp", F.col("o_orderstatus"))
    kept = keep_retained(orders, policies(spark, _POLICY_ROWS), "1998-01-01T00:00:00Z", time="o_orderdate")
    return kept.select("o_orderkey")


@_register("shard_groups", "SELECT o_orderkey, epoch_us(o_orderdate) // (7 * 86400000000) AS shard_group FROM orders")
def _(spark, d):
    orders = _orders(spark, d)
    return orders.select("o_orderkey", shard_group(epoch_ns(orders, "o_orderdate"), "7d").alias("shard_group"))


@_register(
    "default_rp",
    "SELECT CASE WHEN event_type = 'click' THEN 'one' ELSE event_type END AS rp, count(*) AS n FROM events GROUP BY 1",
)
def _(spark, d):
    policy = policies(spark, [{"db": "metrics", "name": "one", "duration": "3d", "is_default": True}])
    kind = F.when(F.col("event_type") == "click", "").otherwise(F.col("event_type"))
    events = _events(spark, d).select(F.lit("metrics").alias("db"), kind.alias("rp"))
    return resolve_policy(events, policy).groupBy("rp").agg(F.count(F.lit(1)).alias("n"))


# A store of orders by status: F in the store's groups of 30 days, O in groups of its own, P without a duration.
_STORE_POLICIES = [
    {"db": "tpch", "name": "F", "duration": "365d", "shard_group_duration": None, "is_default": True},
    {"db": "tpch", "name": "O", "duration": "730d", "shard_group_duration": "90d"},
    {"db": "tpch", "name": "P"},
]
_AS_OF = "2001-06-01T00:00:00Z"
_STORED_GROUPS = (
    "SELECT o_orderkey, o_orderstatus AS rp, epoch_us(o_orderdate) // (d * 86400000000) AS shard_group, "
    "(epoch_us(o_orderdate) // (d * 86400000000) + 1) * d * 86400000000 "
    "<= epoch_us(TIMESTAMP '2001-06-01') - kept * 86400000000 AS expired "
    "FROM orders JOIN (VALUES ('F', 30, 365), ('O', 90, 730), ('P', 30, 100000)) p(st, d, kept) ON o_orderstatus = st"
)


def _order_store(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    path, rules = scratch_folder(spark, "orders"), policies(spark, _STORE_POLICIES)
    write_points(_order_points(spark, d), path, policies=rules, shard_duration="30d")
    return path, rules


@_register("expired_groups_30d", f"SELECT DISTINCT rp, shard_group FROM ({_STORED_GROUPS}) WHERE expired")
def _(spark, d):
    path, rules = _order_store(spark, d)
    return expired_groups(spark, path, rules, _AS_OF).select("rp", "shard_group")


@_register("retention_store", f"SELECT rp, shard_group, count(*) AS n FROM ({_STORED_GROUPS}) WHERE NOT expired GROUP BY 1, 2")
def _(spark, d):
    path, rules = _order_store(spark, d)
    drop_expired(spark, path, rules, _AS_OF)
    stored = spark.read.schema(STORED_POINTS).parquet(path)
    return stored.groupBy("rp", "shard_group").agg(F.count(F.lit(1)).alias("n"))


@_register(
    "retention_read",
    "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '2001-06-01' - INTERVAL 730 DAY",
)
def _(spark, d):
    path, rules = _order_store(spark, d)
    kept = read_points(spark, path, "tpch", "O", policies=rules, as_of=_AS_OF)
    return kept.select(F.col("fields")["o_orderkey"]["i"].alias("o_orderkey"))


@_register("read_default_rp", "SELECT o_orderstatus AS status, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1")
def _(spark, d):
    path, rules = scratch_folder(spark, "orders"), policies(spark, _STORE_POLICIES)
    points = _order_points(spark, d).withColumn("tags", F.map_concat("tags", F.create_map(F.lit("status"), F.col("rp"))))
    points = points.withColumn("rp", F.when(F.col("rp") == "P", "").otherwise(F.col("rp")))
    write_points(points, path, policies=rules, shard_duration="90d")
    return read_points(spark, path, "tpch").groupBy(F.col("tags")["status"].alias("status")).agg(F.count(F.lit(1)).alias("n"))


@_register(
    "drop_measurement_store",
    "SELECT event_type AS measurement, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY 1",
)
def _(spark, d):
    path = scratch_folder(spark, "measurements")
    points = _event_points(spark, d).withColumn("measurement", F.col("tags")["event_type"])
    write_points(points, path, db="metrics")
    drop_measurement(spark, path, "metrics", "", "click")
    return read_points(spark, path, "metrics").groupBy("measurement").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# text in and out




@_register(
    "bind_templates",
    "SELECT event_id, substr(event_type, 1, 1) || '_' || event_type || '_b-' || user_id AS bound, value, "
    "CAST(event_id AS VARCHAR) AS note FROM events",
)
def _(spark, d):
    events = _events(spark, d).withColumn("id_text", F.col("event_id").cast("string"))
    text = F.concat(F.lit("m,t="), F.substring("event_type", 1, 1), F.lit('_$loc_b-$locx value=$v,note="$id"'))
    texts = events.select("event_type").distinct().select("event_type", text.alias("value"))
    templates = good_points(parse_lines(texts)).drop("value")
    names = {"loc": "event_type", "locx": "user_id", "v": "value", "id": "id_text"}
    rows = events.select("event_id", "event_type", parameters(events, names).alias("params"))
    return _bound_columns(bind_templates(templates, rows, on="event_type"))


def _bound_columns(bound: DataFrame) -> DataFrame:
    return bound_points(bound).select(
        "event_id",
        F.col("tags")["t"].alias("bound"),
        F.col("fields")["value"]["f"].alias("value"),
        F.col("fields")["note"]["s"].alias("note"),
    )


@_register(
    "bind_statement",
    "SELECT event_id, 'a_' || event_type || '_b-' || user_id AS bound, value, CAST(event_id AS VARCHAR) AS note FROM events",
)
def _(spark, d):
    events = _events(spark, d).withColumn("id_text", F.col("event_id").cast("string"))
    names = {"loc": "event_type", "locx": "user_id", "v": "value", "id": "id_text"}
    text = "INSERT m,t=a_$loc_b-$locx value=$v,note=\"$id\""
    return _bound_columns(bind_statement(events, text, names, keep=["event_id"]))


@_register(
    "lp_encode_events",
    "SELECT 'events,event_type=' || event_type || ',user_id=' || user_id || ' event_id=' || event_id || 'i,props=\"' || "
    "replace(props, '\"', '\\\"') || '\",value=' || regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') || ' ' || epoch_ns(ts) "
    "AS line FROM events",
)
def _(spark, d):
    return encode_table(_events(spark, d), "events", name="line")


_SQL["lp_encode_points"] = _SQL["lp_encode_events"]


@_register("lp_encode_points")
def _(spark, d):
    return encode_points(_event_points(spark, d), "line")


@_register(
    "lp_roundtrip_events",
    "SELECT 'ev x' AS m, event_type, CAST(user_id AS VARCHAR) AS user_id, event_id, props, value, epoch_ns(ts) AS time_ns FROM events",
)
def _lp_roundtrip(spark, d):
    lines = encode_table(_events(spark, d), "ev x")
    points = good_points(parse_lines(lines))
    return points.select(
        F.col("measurement").alias("m"),
        F.col("tags")["event_type"].alias("event_type"),
        F.col("tags")["user_id"].alias("user_id"),
        F.col("fields")["event_id"]["i"].alias("event_id"),
        F.col("fields")["props"]["s"].alias("props"),
        F.col("fields")["value"]["f"].alias("value"),
        "time_ns",
    )


@_register(
    "series_docs_events",
    "SELECT event_type, CAST(ts AS VARCHAR) AS time, value FROM events",
)
def _(spark, d):
    documents = series_documents(
        _events(spark, d), "events", time="ts", tags=["event_type"], columns=["value"], ties=["event_id"], chunk_rows=1_000
    )
    rows = document_rows(result_documents(documents).select(F.col("document").alias("value")))
    return rows.select(
        F.col("tags")["event_type"].alias("event_type"),
        F.regexp_replace(F.regexp_replace(F.col("values")["time"], "T", " "), "Z$", "").alias("time"),
        F.col("values")["value"].cast("double").alias("value"),
    )


@_register(
    "text_search_documents",
    r"SELECT doc_id FROM documents WHERE list_contains(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), 'that') "
    r"AND list_contains(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), 'with')",
)
def _(spark, d):
    documents = _table(spark, d, "documents").select("doc_id", "text")
    words = ["that", "with"]
    return search(documents, _stored_index(spark, d, documents, words), "doc_id", words).select("doc_id")


def _stored_index(spark, d, documents, words):
    """The rows of some words in the index of ``documents``, written once per session, folder and state of the texts."""
    version = (spark, d, *index_version(documents, "doc_id", ["text"]))
    if version not in _INDEXES:
        path = scratch_folder(spark, "text-index")
        write_text_index(text_index(documents, "doc_id", ["text"]), path)
        _INDEXES[version] = path
    return read_text_index(spark, _INDEXES[version], words)


_INDEXES: dict = {}


_WORDS = r"unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')))"


@_register("text_index_build", f"SELECT token, count(*) AS n FROM (SELECT {_WORDS} AS token FROM documents) GROUP BY 1")
def _(spark, d):
    path = scratch_folder(spark, "postings")
    merge_postings(_table(spark, d, "documents"), path, "doc_id", ["text"])
    return read_postings(spark, path).groupBy("token").agg(F.sum(F.size("gaps")).alias("n"))


_SQL["text_index_merge"] = _SQL["text_search_documents"]


@_register("text_index_merge")
def _(spark, d):
    path, documents = scratch_folder(spark, "postings"), _table(spark, d, "documents")
    merge_postings(documents.where("lang = 'en'"), path, "doc_id", ["text"])
    merge_postings(documents.where("lang <> 'en' OR lang IS NULL"), path, "doc_id", ["text"])
    if not is_current(documents, path, "doc_id"):
        raise RuntimeError("the index does not hold the documents")
    return lookup_postings(spark, path, ["that", "with"]).withColumnRenamed("row_id", "doc_id")


@_register(
    "text_search_unicode",
    r"SELECT doc_id FROM documents WHERE list_contains(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), 'für')",
)
def _(spark, d):
    documents = _table(spark, d, "documents").select("doc_id", "text")
    return search_texts(documents, ["text"], "für").select("doc_id")


_SQL["text_scan_documents"] = _SQL["text_search_documents"]


@_register("text_scan_documents")
def _(spark, d):
    documents = _table(spark, d, "documents").select("doc_id", "text")
    return search_texts(documents, ["text"], ["that", "with"]).select("doc_id")


# --------------------------------------------------------------------------
# layout and ingest


@_register(
    "read_range_1d",
    "SELECT event_type, count(*) AS n FROM events WHERE ts >= (SELECT min(ts) FROM events) + INTERVAL 2 DAY GROUP BY 1",
)
def _(spark, d):
    points = wide_to_points(_events(spark, d), "events", tags=["event_type"], fields=["value"], time="ts")
    path = scratch_folder(spark, "daily")
    write_points(points, path, db="metrics", rp="raw", shard_duration="1d")
    first = points.agg(F.min("time_ns")).first()[0]
    found = read_points(spark, path, "metrics", "raw", start=first + 2 * 86_400 * 10**9)
    return found.groupBy(F.col("tags")["event_type"].alias("event_type")).agg(F.count("*").alias("n"))


@_register(
    "shard_groups_policy",
    "SELECT event_type AS rp, CASE WHEN event_type = 'click' THEN epoch_us(ts) // 86400000000 "
    "ELSE epoch_us(ts) // (7 * 86400000000) END AS shard_group, count(*) AS n FROM events "
    "WHERE ts >= (SELECT min(ts) FROM events) + INTERVAL 1 DAY AND event_type IN ('click', 'view') GROUP BY 1, 2",
)
def _(spark, d):
    path = scratch_folder(spark, "own-durations")
    events = _events(spark, d).withColumn("rp", F.col("event_type"))
    points = wide_to_points(events, "events", tags=["user_id"], fields=["value"], time="ts", keep=["rp"])
    policy = policies(spark, [{"db": "metrics", "name": "click", "duration": "30d", "shard_group_duration": "1d"}])
    write_points(points, path, db="metrics", policies=policy)
    start = points.agg(F.min("time_ns")).first()[0] + 86_400 * 10**9
    stored = read_points(spark, path, "metrics", "click", start=start).unionByName(
        read_points(spark, path, "metrics", "view", start=start)
    )
    return stored.groupBy("rp", "shard_group").agg(F.count(F.lit(1)).alias("n"))


@_register(
    "layout_counts",
    "SELECT event_type AS rp, epoch_us(ts) // (7 * 86400000000) AS shard_group, count(*) AS n FROM events GROUP BY 1, 2",
)
def _(spark, d):
    path = scratch_folder(spark, "points")
    events = _events(spark, d).withColumn("rp", F.col("event_type"))
    points = wide_to_points(events, "events", tags=["user_id"], fields=["value"], time="ts", keep=["rp"])
    write_points(points, path, db="metrics", shard_duration="7d")
    stored = spark.read.schema(STORED_POINTS).parquet(path).where("db = 'metrics'")
    return stored.groupBy("rp", "shard_group").agg(F.count(F.lit(1)).alias("n"))


@_register(
    "shard_layout",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, 1::BIGINT AS shards FROM lineitem GROUP BY 1, 2",
)
def _(spark, d):
    path = scratch_folder(spark, "lineitem")
    fields = {"l_orderkey": "INT64", "l_quantity": "FLOAT64", "l_extendedprice": "FLOAT64"}
    write_measurement(
        _lineitem(spark, d),
        path,
        tags=["l_returnflag", "l_linestatus"],
        fields=fields,
        time="l_shipdate",
        shard_keys=["l_returnflag", "l_linestatus"],
        shards=8,
        sort_keys=["l_orderkey"],
    )
    stored = spark.read.parquet(path)
    return stored.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.size(F.collect_set(SHARD)).cast("bigint").alias("shards")
    )


@_register(
    "range_layout",
    "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O'",
)
def _(spark, d):
    path = scratch_folder(spark, "ranges")
    fields = {"l_orderkey": "INT64", "l_quantity": "FLOAT64"}
    keys = ["l_returnflag", "l_linestatus"]
    write_measurement(_lineitem(spark, d), path, tags=keys, fields=fields, time="l_shipdate", shard_keys=keys, shard_type="RANGE", shards=12)
    return read_measurement(spark, path, l_returnflag="N", l_linestatus="O").select("l_orderkey", "l_quantity")


@_register(
    "ingest_stream",
    "SELECT 'metrics' AS db, 'autogen' AS rp, event_type, value, ts AS time FROM events",
)
def _(spark, d):
    path = scratch_folder(spark, "ingest")
    points = wide_to_points(_events(spark, d), "events", tags=["event_type"], fields=["value", "event_id"])
    encode_points(points).write.text(f"{path}/lines")
    query = start_ingest(line_stream(spark, f"{path}/lines", db="metrics"), f"{path}/store", f"{path}/state", interval=None)
    query.awaitTermination()
    return ingested_points(spark, f"{path}/store").select(
        "db",
        "rp",
        F.col("tags")["event_type"].alias("event_type"),
        F.col("fields")["value"]["f"].alias("value"),
        ns_to_ntz(F.col("time_ns")).alias("time"),
    )


def _event_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the events, and the type and the number of each."""
    points = wide_to_points(_events(spark, d), "events", tags=["event_type"], fields=["value", "event_id"])
    line = encode_line(F.col("measurement"), F.col("tags"), F.col("fields"), F.col("time_ns"))
    return points.select(line.alias("value"), F.col("tags")["event_type"].alias("event_type"), F.col("fields")["value"]["f"].alias("number"))


@_register(
    "ingest_by_points",
    "SELECT 'metrics' AS db, 'autogen' AS rp, p AS part, least(700, n - 700 * p) AS n "
    "FROM (SELECT n, unnest(range(0, (n + 699) // 700)) AS p FROM (SELECT count(*) AS n FROM events))",
)
def _(spark, d):
    path = scratch_folder(spark, "ingest")
    _event_lines(spark, d).select("value").write.text(f"{path}/lines")
    stream = line_stream(spark, f"{path}/lines", db="metrics")
    start_ingest(stream, f"{path}/store", f"{path}/state", interval=None, batch_points=700).awaitTermination()
    points = ingested_points(spark, f"{path}/store")
    return points.groupBy("db", "rp", BATCH, PART).agg(F.count(F.lit(1)).alias("n")).drop(BATCH)


_ROUTES = {"click": ("web", "raw"), "view": ("web", "week"), "purchase": ("shop", ""), "signup": ("shop", "month"), "error": ("ops", "")}


@_register(
    "ingest_routes",
    "SELECT db, CASE rp WHEN '' THEN 'autogen' ELSE rp END AS rp, event_type, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id "
    "FROM events JOIN (VALUES ('click', 'web', 'raw'), ('view', 'web', 'week'), ('purchase', 'shop', ''), ('signup', 'shop', 'month'), "
    "('error', 'ops', '')) r(kind, db, rp) ON event_type = kind GROUP BY 1, 2, 3",
)
def _(spark, d):
    path = scratch_folder(spark, "routes")
    _event_lines(spark, d).drop("number").write.partitionBy("event_type").text(f"{path}/lines")
    stream = routed_stream(spark, {scope: f"{path}/lines/event_type={kind}" for kind, scope in _ROUTES.items()})
    start_ingest(stream, f"{path}/store", f"{path}/state", interval=None, batch_points=5_000).awaitTermination()
    number = F.col("fields")["event_id"]["i"]
    return (
        ingested_points(spark, f"{path}/store")
        .groupBy("db", "rp", F.col("tags")["event_type"].alias("event_type"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("first_id"), F.max(number).alias("last_id"))
    )


@_register(
    "ingest_outcomes",
    "WITH c AS (SELECT event_type, count(*) AS n, count(*) FILTER (value < 10) AS bad FROM events GROUP BY 1), "
    "g AS (SELECT event_type, n - bad AS good, bad FROM c) "
    "SELECT 'metrics' AS db, event_type AS rp, p AS part, b AS batch, least(900, good - 900 * p) AS rows, "
    "CASE p WHEN 0 THEN bad ELSE 0 END AS rejected, p = 0 AND bad > 0 AS faulty "
    "FROM (SELECT *, 0 AS b, unnest(range(0, greatest(1, (good + 899) // 900))) AS p FROM g WHERE event_type <> 'error') "
    "UNION ALL SELECT 'metrics', 'error', 0, 1, 0, 0, true FROM c WHERE event_type = 'error'",
)
def _(spark, d):
    path = scratch_folder(spark, "outcomes")
    # lines of small numbers lose their fields
    line = F.when(F.col("number") < 10, F.substring_index("value", " ", 1)).otherwise(F.col("value"))
    lines = _event_lines(spark, d).select(line.alias("value"), F.lit("metrics").alias("db"), F.col("event_type").alias("rp"))
    batches = {0: lines.where("rp <> 'error'"), 1: lines.where("rp = 'error'")}
    write_batch(batches[0], 0, path, batch_points=900)
    try:
        write_batch(batches[1], 1, path, compression="nonesuch")
    except Exception:  # the failure is in the outcomes
        pass
    write_batch(batches[0], 0, path, batch_points=900)  # a batch that runs again
    found = outcomes(spark, path)
    return found.select("db", "rp", PART, BATCH, "rows", "rejected", (F.col("error") != "").alias("faulty"))


# --------------------------------------------------------------------------
# logs


def _request_log(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("event_type").isin("view", "click"), "query").otherwise("write")
    return _table(spark, d, "events").select(
        kind.alias("kind"), F.col("event_type").alias("database"), F.col("value").alias("latency")
    )


@_register(
    "metric_rollup",
    "SELECT kind, grouping(event_type) = 1 AS is_total, event_type AS database, count(*) AS requests, "
    "round(sum(value), 2) AS latency_sum, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.9), 4) AS p90, "
    "round(quantile_cont(value, 0.99), 4) AS p99 FROM (SELECT CASE WHEN event_type IN ('view', 'click') THEN 'query' "
    "ELSE 'write' END kind, event_type, value FROM events) GROUP BY GROUPING SETS ((kind), (kind, event_type))",
)
def _(spark, d):
    rolled = metric_rollup(_request_log(spark, d))
    return rolled.withColumns(
        {"latency_sum": F.round("latency_sum", 2), **{q: F.round(q, 4) for q in ("p50", "p90", "p99")}}
    )


@_register(
    "classify_statements",
    "SELECT CASE WHEN event_type IN ('click', 'view') THEN 'Query' WHEN event_type = 'error' THEN 'Command' "
    "WHEN event_type = 'signup' THEN 'Insert' ELSE 'Unknown' END AS class, count(*) AS n, "
    "CAST(sum(CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 ELSE 0 END) AS BIGINT) AS affected_rows FROM events GROUP BY 1",
)
def _(spark, d):
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", "select * from m -- drop")
        .when(kind == "view", "/* c */show series")
        .when(kind == "error", "DROP measurement m")
        .when(kind == "signup", "Insert m,a=b x=1\n\n  m,a=c x=2 ")
        .otherwise("noop")
    )
    log = _events(spark, d).select(F.concat(text, F.lit(" "), F.col("event_id").cast("string")).alias("command"))
    return statement_counts(log)


# --------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Counts per tag and 12-minute bucket, newest first, on the small tables."""
    return _count_by_time(spark, SMALL)


# The training-data operators and their pipeline can be left out as a whole, or
# lack a library that only they need; all other imports stand above.
try:
    import corpus_pipeline
    from sparkseries.llm.queries import QUERIES as _LLM_QUERIES
    from sparkseries.llm.queries import SQL as _LLM_SQL

    def _found_by_workers(query: Query_) -> Query_:
        """``query`` with this folder on the search path of Python workers."""

        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.abspath(__file__)))
            return query(spark, folder)

        return run

    _QUERIES.update({name: _found_by_workers(q) for name, q in {**_LLM_QUERIES, "pipeline": corpus_pipeline.run}.items()})
    _SQL.update(_LLM_SQL)
    if corpus_pipeline.ORACLE_SQL:
        _SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
except ModuleNotFoundError:
    pass


def queries() -> Queries:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """For each query the SQL that DuckDB runs on the same tables."""
    return dict(_SQL)
