"""WHERE conditions: comparisons, regular expressions and AND/OR over them.

A condition is resolved against a DataFrame into one Column.  Comparisons with
the time column parse their constant once and keep the raw column on the left,
so that the range is pushed down to the scan.
"""

from __future__ import annotations

import functools
import operator as op
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.functions.timefns import compare_time
from sparkseries.model import TIME, SeriesError, col

_PLAIN: dict[str, Callable[[Column, Column], Column]] = {
    "=": op.eq,
    "<>": op.ne,
    ">": op.gt,
    "<": op.lt,
    ">=": op.ge,
    "<=": op.le,
}
_TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def regex_body(pattern: str) -> str:
    """``/re/`` without its slashes; other text is taken as it is."""
    if len(pattern) >= 2 and pattern.startswith("/") and pattern.endswith("/"):
        return pattern[1:-1]
    return pattern


def is_regex(pattern: str) -> bool:
    return len(pattern) >= 2 and pattern.startswith("/") and pattern.endswith("/")


def match(column: Column, operator: str, value: Any) -> Column:
    """One comparison on a Column.  ``=~`` finds the pattern anywhere; null never matches."""
    if operator in ("=~", "!~"):
        found = column.cast("string").rlike(regex_body(value))
        return found if operator == "=~" else ~found
    if operator not in _PLAIN:
        raise SeriesError(f"unknown operator {operator!r}")
    return _PLAIN[operator](column, F.lit(value))


@dataclass(frozen=True)
class Compare:
    column: str
    operator: str
    value: Any

    def resolve(self, df: DataFrame, time: str) -> Column:
        name = time if self.column == TIME and TIME not in df.columns else self.column
        if name not in df.columns:
            raise SeriesError(f"no column {self.column!r}")
        is_time = name == time or isinstance(df.schema[name].dataType, _TIME_TYPES)
        if is_time and self.operator not in ("=~", "!~"):
            return compare_time(df, name, self.operator, self.value)
        return match(col(name), self.operator, self.value)


@dataclass(frozen=True)
class Composite:
    operator: str
    parts: tuple

    def resolve(self, df: DataFrame, time: str) -> Column:
        if not self.parts:
            raise SeriesError(f"empty {self.operator} condition")
        join = {"AND": op.and_, "OR": op.or_}[self.operator]
        return functools.reduce(join, [resolve(p, df, time) for p in self.parts])


def compare(column: str, operator: str, value: Any) -> Compare:
    """``compare("water_level", ">", 8)``; operators are ``= <> > < >= <= =~ !~``."""
    if operator not in (*_PLAIN, "=~", "!~"):
        raise SeriesError(f"unknown operator {operator!r}")
    return Compare(column, operator, value)


def all_of(*parts) -> Composite:
    return Composite("AND", parts)


def any_of(*parts) -> Composite:
    return Composite("OR", parts)


def time_range(start: Any = None, end: Any = None, *, closed: bool = False) -> Composite:
    """Half-open ``[start, end)``, or ``[start, end]`` when closed."""
    parts = []
    if start is not None:
        parts.append(Compare(TIME, ">=", start))
    if end is not None:
        parts.append(Compare(TIME, "<=" if closed else "<", end))
    return Composite("AND", tuple(parts))


def resolve(condition, df: DataFrame, time: str) -> Column:
    """Column of a condition; a Column is returned unchanged."""
    return condition if isinstance(condition, Column) else condition.resolve(df, time)
