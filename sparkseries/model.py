"""Data model: points, typed measurement tables, durations and names.

Two DataFrame shapes carry all data.

*points* is schemaless and long::

    db, rp, measurement   string
    tags                  map<string,string>
    fields                map<string, struct<i,u,f,s,b>>   one slot set per value
    time_ns               bigint      epoch nanoseconds, null when not given
    seq                   bigint      arrival order (optional)

A *measurement table* is wide: one typed column for each tag and field and one
time column.  Which column plays which part is kept in ``StructField.metadata``
under the key ``role``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME = "time"
TIME_NS = "time_ns"
DEFAULT_POLICY = "autogen"

ROLE = "role"
TAG, FIELD = "tag", "field"

#: slot name -> Spark type of a field value
SLOTS: dict[str, T.DataType] = {
    "i": T.LongType(),
    "u": T.DecimalType(20, 0),
    "f": T.DoubleType(),
    "s": T.StringType(),
    "b": T.BooleanType(),
}
#: slot name -> type name shown to users
SLOT_TYPE_NAMES = {"i": "integer", "u": "unsigned", "f": "float", "s": "string", "b": "boolean"}
#: type names of declared schemas -> slot
DECLARED_TYPES = {"INT64": "i", "FLOAT64": "f", "STRING": "s", "BOOL": "b"}

SLOT_STRUCT = T.StructType([T.StructField(n, t) for n, t in SLOTS.items()])
SLOT_DDL = SLOT_STRUCT.simpleString()
TAGS_TYPE = T.MapType(T.StringType(), T.StringType())
FIELDS_TYPE = T.MapType(T.StringType(), SLOT_STRUCT)


class SeriesError(ValueError):
    """Invalid argument or data that the library refuses."""


def require_name(value: str | None, what: str) -> str:
    if not value:
        raise SeriesError(f"empty {what}")
    return value


# --------------------------------------------------------------------------
# durations

NS_PER = {
    "ns": 1,
    "u": 1_000,
    "us": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60 * 1_000_000_000,
    "h": 3_600 * 1_000_000_000,
    "d": 86_400 * 1_000_000_000,
    "w": 7 * 86_400 * 1_000_000_000,
}
_DURATION_PART = re.compile(r"(\d+)(ns|us|ms|u|s|m|h|d|w)")


def duration_ns(text: str) -> int:
    """``12m``, ``3d`` or ``7200h0m0s`` in nanoseconds; a unit is required and zero is refused."""
    parts = _DURATION_PART.findall(text or "")
    if not parts or "".join(n + u for n, u in parts) != text:
        raise SeriesError(f"invalid duration {text!r}: a number with a unit is required")
    total = sum(int(n) * NS_PER[u] for n, u in parts)
    if total <= 0:
        raise SeriesError(f"invalid duration {text!r}: it must be positive")
    return total


def format_duration(ns: int) -> str:
    """Hours, minutes and seconds, such as ``7200h0m0s`` for 300 days."""
    seconds = ns // NS_PER["s"]
    return f"{seconds // 3600}h{seconds % 3600 // 60}m{seconds % 60}s"


def interval_text(text: str) -> str:
    """A duration as the interval text taken by Spark's window functions."""
    ns = duration_ns(text)
    if ns % 1_000:
        raise SeriesError(f"duration {text!r} is finer than one microsecond")
    return f"{ns // 1_000} microseconds"


# --------------------------------------------------------------------------
# roles in the schema of a measurement table


def slot_for(data_type: T.DataType) -> str:
    """Slot that holds a value of a Spark type."""
    if isinstance(data_type, T.BooleanType):
        return "b"
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "i"
    if isinstance(data_type, T.DecimalType) and data_type.scale == 0 and data_type.precision <= 20:
        return "u"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "f"
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return "s"
    raise SeriesError(f"unsupported field value type {data_type.simpleString()}")


def with_roles(
    df: DataFrame,
    *,
    time: str,
    tags: Iterable[str] = (),
    fields: Iterable[str] = (),
) -> DataFrame:
    """Mark columns as time, tags and fields; tags are cast to string."""
    tags, fields = list(tags), list(fields)
    types = {f.name: f.dataType for f in df.schema.fields}
    for name in [time, *tags, *fields]:
        if name not in types:
            raise SeriesError(f"no column {name!r}")
    for name in fields:
        slot_for(types[name])
    columns = [
        *(F.col(_q(t)).cast("string").alias(t, metadata={ROLE: TAG}) for t in tags),
        *(F.col(_q(f)).alias(f, metadata={ROLE: FIELD}) for f in fields),
        F.col(_q(time)).alias(time, metadata={ROLE: TIME}),
    ]
    return df.select(*columns)


def columns_with_role(df: DataFrame, role: str) -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get(ROLE) == role]


def time_column(df: DataFrame) -> str:
    """The marked time column, else a column named ``time``."""
    marked = columns_with_role(df, TIME)
    if marked:
        return marked[0]
    if TIME in df.columns:
        return TIME
    raise SeriesError("no time column")


def check_declared(schema: T.StructType, tags: Iterable[str], fields: Mapping[str, str]) -> None:
    """Check a wide schema against declared tags and ``{field: INT64|FLOAT64|STRING|BOOL}``."""
    tags = list(tags)
    if not tags and not fields:
        raise SeriesError("empty tag or field")
    types = {f.name: f.dataType for f in schema.fields}
    problems = []
    for tag in tags:
        if not isinstance(types.get(tag), T.StringType):
            problems.append(f"tag {tag!r} must be a string column")
    for name, declared in fields.items():
        if declared not in DECLARED_TYPES:
            problems.append(f"field {name!r} has unknown type {declared!r}")
        elif name not in types:
            problems.append(f"field {name!r} is missing")
        elif slot_for(types[name]) != DECLARED_TYPES[declared]:
            problems.append(f"field {name!r} is {types[name].simpleString()}, declared {declared}")
    if problems:
        raise SeriesError("; ".join(problems))


def _q(name: str) -> str:
    """Quote a column name, so that dots and blanks in it are taken as they are."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str):
    return F.col(_q(name))
