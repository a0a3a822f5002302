"""Aggregates and selectors by name.

``call("MEAN", "f")`` gives the plain aggregates; any other name reaches the
Spark function of that name.  ``last`` and ``top`` are selectors: they bring
other columns of the chosen row along.
"""

from __future__ import annotations

import operator as op
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkseries.model import SeriesError, col

_AGGREGATES = {"MEAN": F.avg, "COUNT": F.count, "SUM": F.sum, "MIN": F.min, "MAX": F.max}
_ARITHMETIC = {"+": op.add, "-": op.sub, "*": op.mul}


@dataclass(frozen=True)
class Term:
    """A select item: its Column, whether it aggregates, and its output name."""

    column: Column
    aggregate: bool = False
    name: str | None = None

    def alias(self, name: str) -> Term:
        return replace(self, name=name)

    def output(self) -> Column:
        return self.column.alias(self.name) if self.name else self.column


@dataclass(frozen=True)
class Selector:
    """LAST or TOP of a field."""

    kind: str
    source: str
    n: int = 1
    name: str | None = None

    def alias(self, name: str) -> Selector:
        return replace(self, name=name)

    @property
    def output_name(self) -> str:
        return self.name or self.kind


@dataclass(frozen=True)
class Bucket:
    """GROUP BY TIME(duration)."""

    duration: str
    name: str = field(default="time")


def field_of(name: str) -> Term:
    """A tag or field by name."""
    return Term(col(name), name=name)


def const(value: Any) -> Term:
    return Term(F.lit(value))


def term(value: Any) -> Term:
    """Anything usable as a select item or operand: a name, a Column, a constant or a Term."""
    if isinstance(value, (Term, Selector)):
        return value
    if isinstance(value, str):
        return field_of(value)
    if isinstance(value, Column):
        return Term(value)
    return const(value)


def call(function: str, *args: Any, aggregate: bool = True) -> Term | Selector:
    """A function by name.  Names outside the built-in set go to Spark's function of that name.

    Say ``aggregate=False`` for a function that works on one row.
    """
    upper = function.upper()
    if upper == "LAST":
        (source,) = args
        return last(source)
    if upper == "TOP":
        source, n = args
        return top(source, n)
    operands = [term(a) for a in args]
    if upper in _AGGREGATES:
        (operand,) = operands
        return Term(_AGGREGATES[upper](operand.column), True, upper.lower())
    column = F.call_function(function, *(o.column for o in operands))
    return Term(column, aggregate or any(o.aggregate for o in operands), function.lower())


def mean(source: Any) -> Term:
    return call("MEAN", source)


def count(source: Any) -> Term:
    return call("COUNT", source)


def sum_(source: Any) -> Term:
    return call("SUM", source)


def min_(source: Any) -> Term:
    return call("MIN", source)


def max_(source: Any) -> Term:
    return call("MAX", source)


def last(source: str) -> Selector:
    """Value at the latest time at which the field is not null."""
    return Selector("last", source)


def top(source: str, n: int) -> Selector:
    """The n largest values with their times; the earliest time wins a tie."""
    if n <= 0:
        raise SeriesError("TOP needs a positive number")
    return Selector("top", source, n)


def time(duration: str) -> Bucket:
    return Bucket(duration)


def arithmetic(operator: str, *operands: Any) -> Term:
    """``+ - * /`` over two or more operands, from the left; division by zero gives null."""
    if len(operands) < 2:
        raise SeriesError("arithmetic needs two or more operands")
    terms = [term(o) for o in operands]
    if operator == "/":
        column = reduce(F.try_divide, [t.column for t in terms])
    elif operator in _ARITHMETIC:
        column = reduce(_ARITHMETIC[operator], [t.column for t in terms])
    else:
        raise SeriesError(f"unknown operator {operator!r}")
    return Term(column, any(t.aggregate for t in terms))
