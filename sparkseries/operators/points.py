"""Between measurement tables (wide, typed) and points (schemaless)."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.functions.timefns import epoch_ns, ns_to_timestamp
from sparkseries.functions.values import slot_of_column, value_type
from sparkseries.model import (
    FIELD,
    FIELDS_TYPE,
    ROLE,
    SLOT_TYPE_NAMES,
    TAG,
    TAGS_TYPE,
    TIME,
    TIME_NS,
    SeriesError,
    col,
    columns_with_role,
    require_name,
    time_column,
)

_SLOT_OF_TYPE = {name: slot for slot, name in SLOT_TYPE_NAMES.items()}


def now_ns() -> Column:
    return F.unix_micros(F.current_timestamp()) * 1_000


def wide_to_points(
    df: DataFrame,
    measurement: str,
    *,
    time: str | None = None,
    tags: Iterable[str] | None = None,
    fields: Iterable[str] | None = None,
    keep: Iterable[str] = (),
    now: Column | None = None,
) -> DataFrame:
    """Points of a measurement table; null tags and fields are left out of the maps.

    Columns come from the roles in the schema unless they are named.  A zero or
    missing time becomes ``now``.
    """
    require_name(measurement, "measurement")
    time = time or time_column(df)
    tags = list(tags) if tags is not None else columns_with_role(df, TAG)
    fields = list(fields) if fields is not None else columns_with_role(df, FIELD)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *(col(k) for k in keep),
        F.lit(measurement).alias("measurement"),
        _map_of([(t, col(t).cast("string")) for t in tags], TAGS_TYPE).alias("tags"),
        _map_of([(f, slot_of_column(col(f), types[f])) for f in fields], FIELDS_TYPE).alias("fields"),
        with_default_time(epoch_ns(df, time), now).alias(TIME_NS),
    )


def _map_of(items: list[tuple[str, Column]], data_type) -> Column:
    value_type_name = data_type.valueType.simpleString()
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(f"array<{value_type_name}>"))
    if not items:
        return empty
    full = F.create_map(*(part for k, v in items for part in (F.lit(k), v)))
    complete = reduce(operator.and_, [v.isNotNull() for _, v in items])
    # Most rows have every column; the others join the maps of those present.
    present = [F.when(v.isNotNull(), F.create_map(F.lit(k), v)).otherwise(empty) for k, v in items]
    return F.when(complete, full).otherwise(F.map_concat(*present))


def with_default_time(time_ns: Column, now: Column | None = None) -> Column:
    """Nanoseconds, with ``now`` in place of null and zero."""
    return F.coalesce(F.nullif(time_ns, F.lit(0).cast("bigint")), now_ns() if now is None else now)


def tag_sets(df: DataFrame, measurement: str, tags: Iterable[str] | None = None) -> DataFrame:
    """(measurement, tags, row_count) for each distinct tag set of a measurement table.

    The tag columns are made distinct as columns, before any map is built.
    Series and tag exploration give the same answer on it as on all points.
    """
    require_name(measurement, "measurement")
    tags = list(tags) if tags is not None else columns_with_role(df, TAG)
    if not tags:
        raise SeriesError("empty tag")
    named = df.select(*(col(t).cast("string").alias(t) for t in tags))
    # The count keeps this aggregate apart: a bare distinct would be merged into
    # the caller's distinct, and maps would be built for every row again.
    counted = named.groupBy(*(col(t) for t in tags)).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 0")
    tag_map = _map_of([(t, col(t)) for t in tags], TAGS_TYPE)
    return counted.select(F.lit(measurement).alias("measurement"), tag_map.alias("tags"), "row_count")


def tag_keys_of(points: DataFrame) -> DataFrame:
    """Distinct (measurement, key) of all tags.

    Points of one shape share one key list, so the lists are made distinct
    before they are exploded: the shuffle carries shapes, not points.
    """
    shapes = points.select("measurement", F.map_keys("tags").alias("keys")).distinct()
    return shapes.select("measurement", F.explode("keys").alias("key")).distinct()


def field_types_of(points: DataFrame) -> DataFrame:
    """Distinct (measurement, key, type) of all fields.

    Points of one shape share one list of keys and one of types, so these are
    made distinct before they are exploded.
    """
    types = F.transform(F.map_values("fields"), value_type)
    shapes = points.select("measurement", F.map_keys("fields").alias("key"), types.alias("type")).distinct()
    typed = shapes.select("measurement", F.inline(F.arrays_zip("key", "type")))
    return typed.where(F.col("type").isNotNull()).distinct()


def points_to_wide(
    points: DataFrame,
    measurement: str,
    *,
    tags: Iterable[str] | None = None,
    fields: Mapping[str, str] | None = None,
    max_columns: int | None = None,
    time: str = TIME,
) -> DataFrame:
    """One typed table of a measurement: columns by name, nulls where a point lacks one, time last.

    Give ``tags`` and ``fields`` (name to type name) when the schema is known;
    otherwise one job reads the keys.  A field with several types, or a name used
    both as tag and field, is an error; with ``max_columns`` more keys are too.
    """
    require_name(measurement, "measurement")
    rows = points.where(F.col("measurement") == measurement)
    if tags is None or fields is None:
        tags, fields = _discover(rows, max_columns)
    tags, fields = list(tags), dict(fields)
    if not tags and not fields:
        raise SeriesError("empty tag or field")
    both = sorted(set(tags) & set(fields))
    if both:
        raise SeriesError(f"{both} used both as tag and as field")
    if time in tags or time in fields:
        raise SeriesError(f"key can't be {time}")
    slots = {name: _SLOT_OF_TYPE[type_name] for name, type_name in fields.items()}
    kept = [c for c in points.columns if c in ("db", "rp", "seq")]
    built = {t: F.col("tags")[t].alias(t, metadata={ROLE: TAG}) for t in tags}
    for name, slot in slots.items():
        built[name] = F.col("fields")[name][slot].alias(name, metadata={ROLE: FIELD})
    return rows.select(
        *(col(c) for c in kept),
        *(built[name] for name in sorted(built)),
        ns_to_timestamp(F.col(TIME_NS)).alias(time, metadata={ROLE: TIME}),
    )


def _discover(rows: DataFrame, max_columns: int | None) -> tuple[list[str], dict[str, str]]:
    tagged = tag_keys_of(rows).select(F.lit(TAG).alias("kind"), "key", F.lit("tag").alias("type"))
    typed = field_types_of(rows).select(F.lit(FIELD).alias("kind"), "key", "type")
    found = tagged.unionByName(typed)
    found = (found if max_columns is None else found.limit(max_columns * 2 + 1)).collect()
    tags = sorted({r["key"] for r in found if r["kind"] == TAG})
    fields: dict[str, str] = {}
    clash = set()
    for r in found:
        if r["kind"] == FIELD and fields.setdefault(r["key"], r["type"]) != r["type"]:
            clash.add(r["key"])
    if clash:
        raise SeriesError(f"fields with several types: {sorted(clash)}")
    if max_columns is not None and len(tags) + len(fields) > max_columns:
        raise SeriesError(f"more than {max_columns} columns; name the wanted tags and fields")
    return tags, fields
