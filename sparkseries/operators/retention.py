"""Retention policies as a table: enforcement, shard groups, defaults and the report.

A policy row has ``db, name, duration, shard_group_duration, hot_duration,
warm_duration, index_duration, replica_num, is_default``.  Durations are text
such as ``3d`` or ``7200h0m0s``; a null duration keeps data for ever.

A policy table is reduced to one row per key first and then joined.  Its rows
are counted: up to ``BROADCAST_ROWS`` of them are sent to every executor and
looked up by hash, so the points are not shuffled; beyond that Spark chooses.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.functions.timefns import epoch_ns, floor_div, parse_instant
from sparkseries.model import DEFAULT_POLICY, NS_PER, TIME_NS, col, duration_ns

POLICY_SCHEMA = T.StructType(
    [
        T.StructField("db", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("duration", T.StringType()),
        T.StructField("shard_group_duration", T.StringType()),
        T.StructField("hot_duration", T.StringType()),
        T.StructField("warm_duration", T.StringType()),
        T.StructField("index_duration", T.StringType()),
        T.StructField("replica_num", T.LongType()),
        T.StructField("is_default", T.BooleanType()),
    ]
)
DEFAULT_SHARD_GROUP = "7d"
_DURATION_TEXT = "^(?:[0-9]+(?:ns|us|ms|u|s|m|h|d|w))+$"


def policies(spark: SparkSession, rows: list[Mapping[str, Any]]) -> DataFrame:
    """A policy table from dicts; durations are checked."""
    names = [f.name for f in POLICY_SCHEMA.fields]
    for row in rows:
        for name in names:
            if name.endswith("duration") and row.get(name) is not None:
                duration_ns(row[name])
    defaults = {"replica_num": 1, "is_default": False}
    return spark.createDataFrame([tuple(row.get(n, defaults.get(n)) for n in names) for row in rows], POLICY_SCHEMA)


def duration_column_ns(text: Column) -> Column:
    """Nanoseconds of a duration column; malformed or zero text raises an error, null stays null."""
    parts = F.regexp_extract_all(text, F.lit("([0-9]+)(ns|us|ms|u|s|m|h|d|w)"), F.lit(0))
    units = F.create_map(*(F.lit(x) for unit, size in NS_PER.items() for x in (unit, size)))

    def one(part: Column) -> Column:
        return F.regexp_extract(part, "^[0-9]+", 0).cast("bigint") * units[F.regexp_extract(part, "[a-z]+$", 0)]

    total = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, p: a + one(p))
    bad = F.raise_error(F.concat(F.lit("invalid duration "), text)).cast("bigint")
    return F.when(text.isNull(), F.lit(None).cast("bigint")).when(~text.rlike(_DURATION_TEXT), bad).otherwise(
        F.when(total > 0, total).otherwise(bad)
    )


def duration_column_text(ns: Column) -> Column:
    """Hours, minutes and seconds, such as ``7200h0m0s``."""
    seconds = floor_div(ns, NS_PER["s"])
    return F.concat(
        floor_div(seconds, 3600).cast("string"),
        F.lit("h"),
        floor_div(F.pmod(seconds, F.lit(3600)), 60).cast("string"),
        F.lit("m"),
        F.pmod(seconds, F.lit(60)).cast("string"),
        F.lit("s"),
    )


#: policies that every executor may hold: a key and a value each
BROADCAST_ROWS = 500_000


def _looked_up(df: DataFrame, keys: list[Column], table: DataFrame, name: str) -> DataFrame:
    """``df`` with the value of its key as column ``name``; ``table`` has ``keys`` (an array of texts) and ``value``, once per key."""
    few = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    known = table.select(F.col("keys").alias("__keys"), F.col("value").alias(name))
    wanted = F.array(*(k.cast("string") for k in keys))
    return df.join(F.broadcast(known) if few else known, wanted == F.col("__keys"), "left").drop("__keys")


def keep_retained(
    df: DataFrame,
    policy_table: DataFrame,
    as_of: Any,
    *,
    db: str = "db",
    rp: str = "rp",
    time: str = TIME_NS,
) -> DataFrame:
    """Rows not older than their policy's duration at ``as_of``; rows without a policy or duration are kept.

    Of several rows of one policy the longest duration counts.
    """
    found = _looked_up(df, [col(db), col(rp)], policy_cutoffs(policy_table, as_of), "__oldest")
    young = F.col("__oldest").isNull() | (epoch_ns(found, time) >= F.col("__oldest"))
    return found.where(young).drop("__oldest")


def shard_group(time_ns: Column, duration: str = DEFAULT_SHARD_GROUP) -> Column:
    """Number of the shard group that holds a time; groups are aligned to the epoch."""
    return floor_div(time_ns, duration_ns(duration))


def with_shard_group(points: DataFrame, duration: str = DEFAULT_SHARD_GROUP) -> DataFrame:
    return points.withColumn("shard_group", shard_group(F.col(TIME_NS), duration))


def shard_durations(policy_table: DataFrame | None) -> dict[tuple[str, str], str]:
    """The policies' own shard group durations by (db, policy), of several the shortest: settings, as many as the policies."""
    if policy_table is None:
        return {}
    own = policy_table.where("db IS NOT NULL AND name IS NOT NULL AND shard_group_duration IS NOT NULL")
    shortest = F.min_by("shard_group_duration", F.struct(duration_column_ns(F.col("shard_group_duration")), "shard_group_duration"))
    return {(r["db"], r["name"]): r["own"] for r in own.groupBy("db", "name").agg(shortest.alias("own")).collect()}


def default_policies(policy_table: DataFrame | None) -> dict[str, str]:
    """The default policy of each database that has one, of several the first by name."""
    if policy_table is None:
        return {}
    rows = policy_table.where("is_default AND db IS NOT NULL AND name IS NOT NULL").groupBy("db").agg(F.min("name").alias("name"))
    return {r["db"]: r["name"] for r in rows.collect()}


def _with_shard_size(df: DataFrame, durations: Mapping[tuple[str, str], str], default: str, name: str) -> DataFrame:
    """``df`` with the shard group duration of each row's (db, rp) in nanoseconds."""
    size = F.lit(duration_ns(default)).cast("bigint")
    if not durations:
        return df.withColumn(name, size)
    rows = [([db, rp], duration_ns(d)) for (db, rp), d in durations.items()]
    table = df.sparkSession.createDataFrame(rows, "keys array<string>, value bigint")
    found = _looked_up(df, [F.col("db"), F.col("rp")], table, name)
    return found.withColumn(name, F.coalesce(name, size))


def with_policy_shard_group(points: DataFrame, durations: Mapping[tuple[str, str], str], default: str) -> DataFrame:
    """``shard_group`` by the duration of each row's (db, rp), else by ``default``."""
    if not durations:
        return with_shard_group(points, default)
    time, size = F.col(TIME_NS), F.col("__size")
    # Floor division whose divisor is a column; integer division cuts towards zero.
    group = F.floor((time - F.pmod(time, size)).cast("decimal(20,0)") / size).cast("bigint")
    return _with_shard_size(points, durations, default, "__size").withColumn("shard_group", group).drop("__size")


def policy_cutoffs(policy_table: DataFrame, as_of: Any) -> DataFrame:
    """``(keys, value)``: for each policy with a duration the oldest time that it keeps at ``as_of``; of several the longest counts."""
    oldest = F.lit(parse_instant(as_of)).cast("bigint") - F.max(duration_column_ns(F.col("duration")))
    own = policy_table.where("duration IS NOT NULL AND db IS NOT NULL AND name IS NOT NULL")
    return own.groupBy(F.array("db", "name").alias("keys")).agg(oldest.alias("value"))


def expired_shard_groups(
    groups: DataFrame, policy_table: DataFrame, as_of: Any, *, shard_duration: str, own_durations: Mapping[tuple[str, str], str] | None = None
) -> DataFrame:
    """Rows of ``groups`` (db, rp, shard_group, ..) whose whole group is older than its policy's duration at ``as_of``.

    The durations are those by which the groups were laid out, not those of the
    policy table: ``layout.expired_groups`` takes them from a store's notes.
    """
    sized = _with_shard_size(groups, own_durations or {}, shard_duration, "__size")
    cut = _looked_up(sized, [F.col("db"), F.col("rp")], policy_cutoffs(policy_table, as_of), "__oldest")
    ends = (F.col("shard_group").cast("decimal(20,0)") + 1) * F.col("__size")
    return cut.where(ends <= F.col("__oldest")).drop("__size", "__oldest")


def resolve_policy(df: DataFrame, policy_table: DataFrame | None = None, *, db: str = "db", rp: str = "rp") -> DataFrame:
    """Fill an empty policy with the database's default one, else with ``autogen``."""
    given = F.nullif(col(rp), F.lit(""))
    if policy_table is None:
        return df.withColumn(rp, F.coalesce(given, F.lit(DEFAULT_POLICY)))
    defaults = (
        policy_table.where(F.col("is_default") & F.col("db").isNotNull())
        .groupBy(F.array("db").alias("keys"))
        .agg(F.min("name").alias("value"))
    )
    found = _looked_up(df, [col(db)], defaults, "__default")
    return found.withColumn(rp, F.coalesce(given, F.col("__default"), F.lit(DEFAULT_POLICY))).drop("__default")


def policy_report(points: DataFrame, policy_table: DataFrame, *, db: str = "db", rp: str = "rp", time: str = TIME_NS) -> DataFrame:
    """The eight policy attributes with the rows and the first and last time stored under each."""
    stored = (
        points.groupBy(col(db).alias("__db"), col(rp).alias("__rp"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.min(col(time)).alias("min_time"), F.max(col(time)).alias("max_time"))
    )
    shown = [
        duration_column_text(duration_column_ns(F.col(c))).alias(c)
        for c in ("duration", "shard_group_duration", "hot_duration", "warm_duration", "index_duration")
    ]
    joined = policy_table.join(
        stored, (policy_table["db"] == stored["__db"]) & (policy_table["name"] == stored["__rp"]), "left"
    )
    return joined.select(
        "db",
        "name",
        *shown,
        "replica_num",
        "is_default",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        "min_time",
        "max_time",
    )


def policies_from_results(rows: DataFrame, values: str = "values", db: str = "db") -> DataFrame:
    """Policy rows from result rows of eight texts each; a row with a missing or mistyped value is dropped."""
    texts = [F.get(col(values), F.lit(i)) for i in range(8)]
    replica, flag = texts[6].try_cast("double"), texts[7]
    typed = rows.where(F.size(col(values)) >= 8).select(
        col(db).alias("db"),
        texts[0].alias("name"),
        *(texts[i].alias(n) for i, n in enumerate([f.name for f in POLICY_SCHEMA.fields][2:7], start=1)),
        replica.cast("bigint").alias("replica_num"),
        F.when(flag == "true", True).when(flag == "false", False).alias("is_default"),
    )
    return typed.dropna(subset=[f.name for f in POLICY_SCHEMA.fields])
