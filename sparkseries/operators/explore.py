"""Schema exploration over points: measurements, tag keys and values, field keys, series."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkseries.functions.values import series_key, tag_entries
from sparkseries.model import FIELD, SLOT_TYPE_NAMES, SeriesError, col, columns_with_role, slot_for
from sparkseries.operators.points import field_types_of, tag_keys_of
from sparkseries.plans.conditions import is_regex, match, regex_body
from sparkseries.plans.paging import page_distinct

#: a condition on one tag: (tag key, operator, value)
TagCondition = tuple[str, str, Any]


def _scope(points: DataFrame, measurement: str | None, where: TagCondition | None = None) -> DataFrame:
    if measurement:
        points = points.where(F.col("measurement") == measurement)
    if where is not None:
        key, operator, value = where
        points = points.where(match(F.col("tags")[key], operator, value))
    return points


def show_measurements(points: DataFrame, operator: str | None = None, pattern: str | None = None) -> DataFrame:
    """Measurement names, filtered by ``= <> =~ !~`` when given."""
    if operator is not None:
        points = points.where(match(F.col("measurement"), operator, pattern))
    return points.select("measurement").distinct()


def show_tag_keys(points: DataFrame, measurement: str | None = None, *, limit: int = 0, offset: int = 0) -> DataFrame:
    """(measurement, key) in name order; limit and offset count within a measurement."""
    keys = tag_keys_of(_scope(points, measurement))
    if limit <= 0 and offset <= 0:
        return keys
    # The keys of a measurement are its columns, so this window is small.
    numbered = keys.withColumn("__n", F.row_number().over(Window.partitionBy("measurement").orderBy("key")))
    if offset > 0:
        numbered = numbered.where(F.col("__n") > offset)
    if limit > 0:
        numbered = numbered.where(F.col("__n") <= max(offset, 0) + limit)
    return numbered.drop("__n")


def show_tag_values(
    points: DataFrame,
    keys: str | Sequence[str],
    measurement: str | None = None,
    *,
    where: TagCondition | None = None,
    order: str | None = None,
    limit: int = 0,
    offset: int = 0,
) -> DataFrame:
    """(measurement, key, value) of one key, of keys matching ``/re/``, or of several keys.

    ``order`` sorts by value, ``ASC`` or ``DESC``; without it pages follow
    measurement, key and value.
    """
    wanted = [keys] if isinstance(keys, str) else list(keys)
    if not wanted or not all(wanted):
        raise SeriesError("empty tag key")
    if order not in (None, "ASC", "DESC"):
        raise SeriesError(f"unknown order {order!r}")
    rows = _scope(points, measurement, where)
    if len(wanted) == 1 and not is_regex(wanted[0]):
        value = F.col("tags")[wanted[0]]
        rows = rows.select("measurement", F.lit(wanted[0]).alias("key"), value.alias("value")).where(F.col("value").isNotNull())
    else:
        chosen = F.map_filter("tags", lambda k, v: _key_matches(k, wanted))
        rows = rows.select("measurement", F.explode(chosen).alias("key", "value"))
    values = rows.distinct()
    by = ["value", "key", "measurement"] if order else ["measurement", "key", "value"]
    return page_distinct(values, by, limit=limit, offset=offset, descending=order == "DESC")


def _key_matches(key: Column, wanted: Sequence[str]) -> Column:
    if len(wanted) == 1:
        return key.rlike(regex_body(wanted[0]))
    return key.isin(*wanted)


def show_field_keys(points: DataFrame, measurement: str | None = None) -> DataFrame:
    """(measurement, key, type) with the types integer, unsigned, float, string and boolean."""
    return field_types_of(_scope(points, measurement))


def field_types(df: DataFrame) -> dict[str, str]:
    """Field names and types of a measurement table, read from its schema."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return {name: SLOT_TYPE_NAMES[slot_for(types[name])] for name in columns_with_role(df, FIELD)}


def table_field_keys(df: DataFrame, measurement: str) -> DataFrame:
    """(measurement, key, type) of the fields of a measurement table that hold any value.

    Types come from the schema and presence from one count per column, so no
    value is turned into a row.
    """
    types = field_types(df)
    if not types:
        raise SeriesError("no field")
    counted = df.agg(*(F.count(col(name)).alias(name) for name in types))
    keys = [
        F.when(col(name) > 0, F.struct(F.lit(name).alias("key"), F.lit(kind).alias("type"))) for name, kind in types.items()
    ]
    return counted.select(F.lit(measurement).alias("measurement"), F.inline(F.array_compact(F.array(*keys))))


def show_series(
    points: DataFrame,
    measurement: str | None = None,
    *,
    where: TagCondition | None = None,
    limit: int = 0,
    offset: int = 0,
) -> DataFrame:
    """Distinct series keys ``m,k=v,...``; pages follow the key."""
    rows = _scope(points, measurement, where)
    keys = rows.select(series_key(F.col("measurement"), F.col("tags")).alias("key")).distinct()
    return page_distinct(keys, ["key"], limit=limit, offset=offset)


def series_cardinality(points: DataFrame, *, approximate: bool = False) -> DataFrame:
    """Number of series per measurement, exact or by a sketch."""
    keyed = points.select("measurement", tag_entries(F.col("tags")).alias("key"))
    if approximate:
        return keyed.groupBy("measurement").agg(F.approx_count_distinct("key").alias("n"))
    return keyed.distinct().groupBy("measurement").agg(F.count(F.lit(1)).alias("n"))
