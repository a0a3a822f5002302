"""LIMIT and OFFSET over a total order, within each series or over everything.

Small pages use Spark's own top-n operators, which cut rows before the shuffle.
A large page, or an offset without a limit, would sort a whole series (or the
whole table) in one task.  Those go through *equi-depth buckets* instead: a
sample of (series, time, ties) gives edges, so that a bucket holds about the
same number of rows wherever they lie, also within one hour or one time.  Rows
are counted per bucket exactly, a running total over the few counts gives the
rank at which every bucket starts, and only the buckets that a page boundary
cuts need their rows numbered.  The sample decides how work is spread and never
what the result is.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import takewhile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.functions.timefns import time_order
from sparkseries.functions.values import let
from sparkseries.model import col
from sparkseries.session import scratch_folder

#: up to this many rows a global page is a single top-n
GLOBAL_DIRECT_ROWS = 10_000
#: edges of the buckets, and sampled rows for each; both small enough for the driver
EDGES, SAMPLED = 1_023, 4
RANK = "__rank"
_KEY, _FROM, _SIZE, _BUCKET, _SERIES = "__key", "__from", "__size", "__bucket", "__series"


def _direction(column: Column, descending: bool) -> Column:
    return column.desc_nulls_last() if descending else column.asc_nulls_last()


def order_columns(time: str, ties: Sequence[str], descending: bool) -> list[Column]:
    """Time first in the wanted direction, then the tie-breakers ascending."""
    return [_direction(col(time), descending), *(col(t).asc_nulls_last() for t in ties)]


def _sortable(df: DataFrame, name: str) -> Column | None:
    """A whole number, double or text that never falls as the column grows; None for a type without one."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return col(name).cast("bigint")
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return col(name).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return time_order(df, name)
    if isinstance(kind, T.StringType) and kind == T.StringType():
        return col(name)
    return None


def order_key(df: DataFrame, *, time: str, ties: Sequence[str], series: Sequence[str], descending: bool) -> Column:
    """A struct in the order of series, time and ties, nulls last; it ends before the first column that cannot be one."""
    at = time_order(df, time)
    parts: list[Column | None] = [_sortable(df, s) for s in series]
    parts += [F.bitwise_not(at) if descending else at, *(_sortable(df, t) for t in ties)]
    whole = takewhile(lambda part: part is not None, parts)
    fields = [f for i, part in enumerate(whole) for f in (part.isNull().cast("bigint").alias(f"n{i}"), part.alias(f"v{i}"))]
    return F.struct(*fields) if fields else F.struct(F.lit(0).alias("n0"))


def _edges(df: DataFrame, key: Column, buckets: int) -> Column:
    """A constant array of keys in order that cut the rows into about ``buckets`` parts, from a sample."""
    drawn = df.select(key.alias(_KEY)).orderBy(F.rand(7)).limit(buckets * SAMPLED).orderBy(_KEY)
    rows = [r[0] for r in drawn.select(F.to_json(_KEY)).collect()]
    texts = list(dict.fromkeys(rows[SAMPLED - 1 :: SAMPLED]))[: buckets - 1]
    return F.from_json(F.lit(f"[{','.join(texts)}]"), T.ArrayType(drawn.schema[_KEY].dataType))


def _bucket(edges: Column, key: Column, buckets: int) -> Column:
    """The number of edges up to a key, found by halving."""
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(max(1, buckets - 1).bit_length()))))
    return let(
        key,
        lambda k: F.aggregate(
            steps, F.lit(0), lambda found, step: F.when(F.get(edges, found + step - 1) <= k, found + step).otherwise(found)
        ),
    )


def equi_depth_bucket(
    df: DataFrame, *, time: str, ties: Sequence[str] = (), series: Sequence[str] = (), descending: bool = False, buckets: int = EDGES + 1
) -> Column:
    """The number of sampled edges up to a row; it never falls in the order of the rows of a series."""
    key = order_key(df, time=time, ties=ties, series=series, descending=descending)
    return _bucket(_edges(df, key, buckets), key, buckets)


def _with_buckets(df: DataFrame, bucket: Column, series: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their series and bucket, and per (series, bucket) the number of rows and of rows before it.

    Series are one struct: structs compare null fields as equal.
    """
    fields = [col(s).alias(f"s{i}") for i, s in enumerate(series)] or [F.lit(0).alias("s0")]
    keyed = df.withColumns({_SERIES: F.struct(*fields), _BUCKET: bucket})
    counts = keyed.groupBy(_SERIES, _BUCKET).agg(F.count(F.lit(1)).alias(_SIZE))
    running = Window.partitionBy(_SERIES).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return keyed, counts.withColumn(_FROM, F.coalesce(F.sum(_SIZE).over(running), F.lit(0)))


def with_rank(
    df: DataFrame,
    *,
    time: str,
    ties: Sequence[str] = (),
    series: Sequence[str] = (),
    descending: bool = False,
    buckets: int = EDGES + 1,
) -> DataFrame:
    """Number the rows of every series from 1 in time order, one task per (series, bucket)."""
    bucket = equi_depth_bucket(df, time=time, ties=ties, series=series, descending=descending, buckets=buckets)
    keyed, counts = _with_buckets(df, bucket, series)
    within = Window.partitionBy(_SERIES, _BUCKET).orderBy(*order_columns(time, ties, descending))
    based = keyed.join(counts.drop(_SIZE), [_SERIES, _BUCKET])
    return based.withColumn(RANK, F.col(_FROM) + F.row_number().over(within)).select(*(col(c) for c in df.columns), RANK)


def page(
    df: DataFrame,
    *,
    time: str,
    ties: Sequence[str] = (),
    limit: int = 0,
    offset: int = 0,
    series: Sequence[str] = (),
    descending: bool = False,
    buckets: int = EDGES + 1,
) -> DataFrame:
    """Rows ``offset+1 .. offset+limit`` of the order, per series when ``series`` is given.

    A limit or offset of zero or less is ignored.  A global page of any size
    comes in the order; the row order of a per-series page is not defined.
    """
    limit, offset = max(limit, 0), max(offset, 0)
    if not limit and not offset:
        return df
    order = order_columns(time, ties, descending)
    last = offset + limit if limit else None
    if series:
        cut = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
        if last is not None and last <= cut:
            window = Window.partitionBy(*(col(s) for s in series)).orderBy(*order)
            numbered = df.withColumn(RANK, F.row_number().over(window)).where(F.col(RANK) <= last)
            return (numbered.where(F.col(RANK) > offset) if offset else numbered).drop(RANK)
    elif last is not None and last <= GLOBAL_DIRECT_ROWS:
        ordered = df.orderBy(*order)
        return (ordered.offset(offset) if offset else ordered).limit(limit)

    key = order_key(df, time=time, ties=ties, series=series, descending=descending)
    rows = _between(df, key, order, series, offset, last, buckets)
    return rows if series else rows.orderBy(*order)


def _between(
    df: DataFrame, key: Column, order: Sequence[Column], series: Sequence[str], offset: int, last: int | None, buckets: int
) -> DataFrame:
    """Rows of the ranks ``offset + 1 .. last`` in the order, which ``key`` never goes against."""
    edges = _edges(df, key, buckets)
    keyed, counts = _with_buckets(df, _bucket(edges, key, buckets), series)
    bounded = _bounded(keyed.drop(_BUCKET), _page_bounds(counts, offset, last), bool(series))
    # Rows are compared with the ends of the two cut buckets; only those of the cut buckets are numbered.
    first, end = F.col("__first"), F.col("__last")
    first_from, first_to, end_from, end_to = (F.get(edges, i.cast("int")) for i in (first - 1, first, end - 1, end))
    in_first = (first_from.isNull() | (key >= first_from)) & (first_to.isNull() | (key < first_to))
    in_end = end.isNotNull() & (end_from.isNull() | (key >= end_from)) & (end_to.isNull() | (key < end_to))
    inside = bounded.where((key >= first_to) & (end.isNull() | (key < end_from)))
    numbered = bounded.where(in_first | in_end).withColumn(_BUCKET, F.when(in_first, first).otherwise(end))
    numbered = numbered.withColumn(RANK, F.row_number().over(Window.partitionBy(_SERIES, _BUCKET).orderBy(*order)))
    after = (F.col(_BUCKET) > first) | (F.col(RANK) > F.col("__skip"))
    before = end.isNull() | (F.col(_BUCKET) < end) | (F.col(RANK) <= F.col("__take"))
    columns = [col(c) for c in df.columns]
    return inside.select(*columns).union(numbered.where(after & before).select(*columns))


def _page_bounds(counts: DataFrame, offset: int, last: int | None) -> DataFrame:
    """One row per series: the buckets that hold the first and the last row of the page, and the place of both in them."""

    def holding(rank: int) -> tuple[Column, Column]:
        inside = (F.col(_FROM) < rank) & (F.col(_FROM) + F.col(_SIZE) >= rank)
        return F.max(F.when(inside, F.col(_BUCKET))), F.max(F.when(inside, F.lit(rank) - F.col(_FROM)))

    first, place = holding(offset + 1)
    end, take = holding(last) if last is not None else (F.lit(None).cast("int"), F.lit(None).cast("bigint"))
    found = counts.groupBy(_SERIES).agg(first.alias("__first"), (place - 1).alias("__skip"), end.alias("__last"), take.alias("__take"))
    return found.where(F.col("__first").isNotNull())


def _bounded(keyed: DataFrame, bounds: DataFrame, series: bool) -> DataFrame:
    """Rows of the series that have a page, with its bounds: constants of a global page, else a table whose size Spark knows."""
    if not series:
        row = bounds.drop(_SERIES).first()
        if row is None:
            keyed = keyed.where(F.lit(False))
        values = row.asDict() if row else dict.fromkeys(("__first", "__skip", "__last", "__take"), 0)
        return keyed.withColumns({name: F.lit(value).cast("bigint") for name, value in values.items()})
    path = scratch_folder(keyed.sparkSession, "page-bounds")
    bounds.write.parquet(path)
    return keyed.join(keyed.sparkSession.read.schema(bounds.schema).parquet(path), _SERIES)


def page_distinct(
    df: DataFrame, keys: Sequence[str], *, limit: int = 0, offset: int = 0, descending: bool = False, buckets: int = EDGES + 1
) -> DataFrame:
    """A page of a DataFrame whose ``keys`` are unique, ordered by them.

    A page that ends within ``GLOBAL_DIRECT_ROWS`` is a top-n.  A later one, or
    an offset without a limit, is found by equi-depth buckets, so no task sees
    all rows before it.
    """
    limit, offset = max(limit, 0), max(offset, 0)
    if not limit and not offset:
        return df
    order = [col(k).desc() if descending else col(k).asc() for k in keys]
    last = offset + limit if limit else None
    if last is not None and last <= GLOBAL_DIRECT_ROWS:
        ordered = df.orderBy(*order)
        return (ordered.offset(offset) if offset else ordered).limit(limit)
    rising = [col(k).asc() for k in keys]
    # Structs compare null fields as the least, as rising order does; types without a key end it.
    parts = list(takewhile(lambda part: part is not None, (_sortable(df, k) for k in keys)))
    key = F.struct(*(p.alias(f"v{i}") for i, p in enumerate(parts))) if parts else F.struct(F.lit(0).alias("v0"))
    if not descending:
        rows = _between(df, key, rising, (), offset, last, buckets)
    else:  # ranks from the other end
        total = df.count()
        first, end = max(0, total - last) if last is not None else 0, total - offset
        rows = _between(df, key, rising, (), first, end, buckets) if end > first else df.where(F.lit(False))
    return rows.orderBy(*order) if limit else rows
