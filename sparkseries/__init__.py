"""sparkseries: time-series analytics as ordinary Spark plans."""

from sparkseries.functions.aggregates import (
    arithmetic,
    call,
    const,
    count,
    field_of,
    last,
    max_,
    mean,
    min_,
    sum_,
    time,
    top,
)
from sparkseries.model import SeriesError, with_roles
from sparkseries.plans.conditions import all_of, any_of, compare, time_range
from sparkseries.plans.query import Query, bound_where, in_scope

__all__ = [
    "Query",
    "SeriesError",
    "all_of",
    "any_of",
    "arithmetic",
    "bound_where",
    "call",
    "compare",
    "const",
    "count",
    "field_of",
    "in_scope",
    "last",
    "max_",
    "mean",
    "min_",
    "sum_",
    "time",
    "time_range",
    "top",
    "with_roles",
]
