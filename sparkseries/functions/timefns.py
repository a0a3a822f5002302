"""Time arithmetic on epoch nanoseconds, timestamps and zone-free timestamps.

All rounding is whole-number floor arithmetic, so results are exact before 1970
and at the last nanosecond of a unit; no value passes through a double.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.model import NS_PER, SeriesError, col, duration_ns, interval_text

#: precision name -> nanoseconds in one unit
PRECISIONS = {name: NS_PER[name] for name in ("ns", "u", "ms", "s", "m", "h")}
RFC3339 = "rfc3339"


def floor_div(value: Column, unit: int) -> Column:
    """Whole-number floor division of a bigint by a positive constant."""
    if unit == 1:
        return value
    unit_lit = F.lit(unit).cast("bigint")
    return F.call_function("div", value - F.pmod(value, unit_lit), unit_lit)


def _micros_of_day(value: Column) -> Column:
    """Microseconds since midnight of a zone-free timestamp, whatever the session zone."""
    second = (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("bigint")
    return (F.hour(value) * 60 + F.minute(value)).cast("bigint") * 60_000_000 + second


def _micros_of_ntz(value: Column, session_zone: str) -> Column:
    if session_zone in ("UTC", "Etc/UTC", "GMT"):
        return F.unix_micros(value.cast("timestamp"))
    day = F.datediff(value.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return day * (NS_PER["d"] // 1_000) + _micros_of_day(value)


def epoch_ns(df: DataFrame, name: str) -> Column:
    """Epoch nanoseconds of a time column: bigint (taken as nanoseconds), timestamp or timestamp_ntz."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.LongType):
        return col(name)
    if isinstance(data_type, T.TimestampNTZType):
        zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
        return _micros_of_ntz(col(name), zone) * 1_000
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(col(name)) * 1_000
    if isinstance(data_type, T.DateType):
        return F.unix_date(col(name)).cast("bigint") * NS_PER["d"]
    raise SeriesError(f"column {name!r} of type {data_type.simpleString()} is not a time")


def time_order(df: DataFrame, name: str) -> Column:
    """A bigint that grows with a time column, in the column's own unit; no time is too large for it."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.LongType):
        return col(name)
    if isinstance(data_type, T.TimestampNTZType):
        return _micros_of_ntz(col(name), df.sparkSession.conf.get("spark.sql.session.timeZone"))
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(col(name))
    if isinstance(data_type, T.DateType):
        return F.unix_date(col(name)).cast("bigint")
    raise SeriesError(f"column {name!r} of type {data_type.simpleString()} is not a time")


def ns_to_timestamp(value: Column) -> Column:
    """Timestamp of epoch nanoseconds, floored to the microsecond."""
    return F.timestamp_micros(floor_div(value, 1_000))


def ns_to_ntz(value: Column) -> Column:
    """Zone-free UTC timestamp of epoch nanoseconds, floored to the microsecond."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", floor_div(value, 1_000), epoch)


def to_precision(ns: Column, precision: str) -> Column:
    """Epoch nanoseconds counted in ``ns``, ``u``, ``ms``, ``s``, ``m`` or ``h``, or as RFC 3339 text.

    The text is UTC with nanoseconds and without trailing zeros.
    """
    if precision == RFC3339:
        second = F.date_format(ns_to_ntz(ns), "yyyy-MM-dd'T'HH:mm:ss")
        rest = F.lpad(F.pmod(ns, F.lit(NS_PER["s"])).cast("string"), 9, "0")
        rest = F.regexp_replace(rest, "0+$", "")
        return F.concat(second, F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), F.lit("Z"))
    if precision not in PRECISIONS:
        raise SeriesError(f"unknown precision {precision!r}")
    return floor_div(ns, PRECISIONS[precision])


def from_precision(value: Column, precision: Column | str) -> Column:
    """Epoch nanoseconds of a count in a precision given as text or as a column; unknown names mean ``ns``.

    Null where the nanoseconds do not fit.
    """
    if isinstance(precision, str):
        return F.try_multiply(value, F.lit(PRECISIONS.get(precision, 1)).cast("bigint"))
    unit = F.lit(1).cast("bigint")
    for name, size in PRECISIONS.items():
        unit = F.when(precision == name, F.lit(size).cast("bigint")).otherwise(unit)
    return F.try_multiply(value, unit)


# --------------------------------------------------------------------------
# buckets


def time_bucket(df: DataFrame, name: str, duration: str, zone: str | None = None) -> Column:
    """Start of the fixed bucket that holds the time; buckets are aligned to the epoch.

    With a zone they are aligned to local midnight of 1970-01-01 there.  Buckets
    of whole days follow the local calendar, so a day has 23 or 25 hours where
    clocks change; shorter buckets use the offset in force at the row's own time.
    """
    data_type = df.schema[name].dataType
    value = col(name)
    ns = duration_ns(duration)
    if isinstance(data_type, T.LongType):
        if zone:
            raise SeriesError("zone buckets need a timestamp column")
        return value - F.pmod(value, F.lit(ns).cast("bigint"))
    if not zone:
        return F.window(value, interval_text(duration))["start"]
    if isinstance(data_type, T.TimestampNTZType):
        local = F.convert_timezone(F.lit("UTC"), F.lit(zone), value)
    elif isinstance(data_type, T.TimestampType):
        local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.to_utc_timestamp(value, F.current_timezone()).cast("timestamp_ntz"))
    else:
        raise SeriesError(f"column {name!r} of type {data_type.simpleString()} has no zone buckets")
    return _zoned_start(value, local, data_type, ns, zone)


def _zoned_start(value: Column, local: Column, data_type: T.DataType, ns: int, zone: str) -> Column:
    ntz = isinstance(data_type, T.TimestampNTZType)
    if ns % NS_PER["d"] == 0:
        days = ns // NS_PER["d"]
        day = F.datediff(local.cast("date"), F.lit("1970-01-01").cast("date"))
        first = F.date_add(F.lit("1970-01-01").cast("date"), day - F.pmod(day, F.lit(days)))
        start = F.convert_timezone(F.lit(zone), F.lit("UTC"), first.cast("timestamp_ntz"))
        if ntz:
            return start
        return F.from_utc_timestamp(start.cast("timestamp"), F.current_timezone())
    if NS_PER["d"] % ns:
        raise SeriesError("zone buckets must divide a day or be whole days")
    # Distance from the local bucket start, taken off the row's own instant.
    back = F.pmod(_micros_of_day(local), F.lit(ns // 1_000).cast("bigint"))
    return F.timestamp_add("MICROSECOND", -back, value)


def in_zone(value: Column, zone: str) -> Column:
    """Zone-free UTC time shown as local time of a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), value)


# --------------------------------------------------------------------------
# literals

_RFC3339 = re.compile(
    r"^(\d{4}-\d\d-\d\d)(?:[T ](\d\d:\d\d(?::\d\d)?)(?:\.(\d{1,9}))?)?(Z|[+-]\d\d:\d\d)?$"
)


def parse_instant(text: str | int | dt.datetime) -> int:
    """Epoch nanoseconds of RFC 3339 text, a date, a datetime or a whole number of nanoseconds."""
    if isinstance(text, bool):
        raise SeriesError(f"not a time: {text!r}")
    if isinstance(text, int):
        return text
    if isinstance(text, dt.datetime):
        aware = text if text.tzinfo else text.replace(tzinfo=dt.timezone.utc)
        return (aware - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1) * 1_000
    match = _RFC3339.match(text)
    if not match:
        raise SeriesError(f"not a time: {text!r}")
    date, clock, fraction, offset = match.groups()
    clock = clock or "00:00:00"
    clock = clock if clock.count(":") == 2 else clock + ":00"
    zone = "+00:00" if offset in (None, "Z") else offset
    base = dt.datetime.fromisoformat(f"{date}T{clock}{zone}")
    return parse_instant(base) + int((fraction or "").ljust(9, "0"))


def instant_literal(ns: int, data_type: T.DataType) -> Column:
    """A constant of the type of a time column, floored to what the type can hold."""
    if isinstance(data_type, T.LongType):
        return F.lit(ns).cast("bigint")
    text = (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=ns // 1_000)).isoformat(sep=" ")
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(data_type, T.TimestampType):
        return F.lit(text + "Z").cast("timestamp")
    if isinstance(data_type, T.DateType):
        return F.lit(text[:10]).cast("date")
    raise SeriesError(f"type {data_type.simpleString()} is not a time")


def compare_time(df: DataFrame, name: str, operator: str, value: str | int | dt.datetime) -> Column:
    """Compare the *raw* time column with a constant, so that the range reaches the scan."""
    data_type = df.schema[name].dataType
    ns = parse_instant(value)
    step = {T.LongType: 1, T.DateType: NS_PER["d"]}.get(type(data_type), 1_000)
    exact = ns % step == 0
    literal = instant_literal(ns, data_type)
    column = col(name)
    # A constant finer than the column: nothing equals it, and "< t" is "<= floor(t)".
    if operator == "=":
        return (column == literal) if exact else (column.isNotNull() & F.lit(False))
    if operator == "<>":
        return (column != literal) if exact else column.isNotNull()
    if operator == ">":
        return column > literal
    if operator == "<=":
        return column <= literal
    if operator == ">=":
        return (column >= literal) if exact else (column > literal)
    if operator == "<":
        return (column < literal) if exact else (column <= literal)
    raise SeriesError(f"operator {operator!r} is not defined for times")
