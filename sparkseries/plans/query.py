"""Time-series queries as an immutable builder that yields a lazy DataFrame.

::

    (Query()
        .select(mean("value"))
        .from_("events")
        .where(compare("event_type", "<>", "error"))
        .group_by("event_type", time("12m"))
        .order_by("DESC")
        .build({"events": df}))
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.functions.aggregates import Bucket, Selector, Term, term
from sparkseries.functions.timefns import in_zone, time_bucket
from sparkseries.model import DEFAULT_POLICY, TIME, SeriesError, col, require_name, time_column
from sparkseries.plans.conditions import resolve
from sparkseries.plans.paging import order_columns, page, page_distinct

MEASUREMENT = "measurement"
_PLACE, _TIE, _HIDDEN = "__place", "__tie", "__hidden_time"


_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.TimestampType, T.TimestampNTZType, T.DateType)


@dataclass(frozen=True)
class Query:
    columns: tuple = ()
    tables: tuple[str, ...] = ()
    condition: Any = None
    tags: tuple[str, ...] = ()
    bucket: Bucket | None = None
    order: str = ""
    row_limit: int = 0
    row_offset: int = 0
    page_scope: str = "series"
    zone: str | None = None
    ties: tuple[str, ...] = ()
    time: str | None = None
    time_label: str | None = None

    # -- clauses ------------------------------------------------------------

    def select(self, *columns: Any) -> Query:
        """Names, Terms, Selectors or Columns; none means all columns."""
        return replace(self, columns=tuple(term(c) for c in columns))

    def from_(self, *tables: str) -> Query:
        return replace(self, tables=tuple(tables))

    def where(self, condition: Any) -> Query:
        return replace(self, condition=condition)

    def group_by(self, *keys: str | Bucket) -> Query:
        """Tag names and at most one ``time("12m")``."""
        buckets = [k for k in keys if isinstance(k, Bucket)]
        if len(buckets) > 1:
            raise SeriesError("only one time bucket can be grouped by")
        tags = tuple(k for k in keys if not isinstance(k, Bucket))
        return replace(self, tags=tags, bucket=buckets[0] if buckets else None)

    def order_by(self, order: str) -> Query:
        """``ASC`` or ``DESC``; only time can be ordered."""
        if order not in ("ASC", "DESC"):
            raise SeriesError(f"unknown order {order!r}")
        return replace(self, order=order)

    def limit(self, n: int, scope: str | None = None) -> Query:
        return replace(self, row_limit=n, page_scope=self._scope(scope))

    def offset(self, n: int, scope: str | None = None) -> Query:
        return replace(self, row_offset=n, page_scope=self._scope(scope))

    def timezone(self, zone: str, label: str | None = None) -> Query:
        """Buckets follow the zone; ``label`` names an extra column with local times."""
        return replace(self, zone=zone, time_label=label)

    def tie_break(self, *columns: str) -> Query:
        """Columns that make the time order total."""
        return replace(self, ties=tuple(columns))

    def time_is(self, column: str) -> Query:
        """Name the time column when the schema does not mark it."""
        return replace(self, time=column)

    def _scope(self, scope: str | None) -> str:
        if scope not in (None, "series", "global"):
            raise SeriesError(f"unknown scope {scope!r}")
        return scope or self.page_scope

    # -- plan ---------------------------------------------------------------

    def build(self, source: DataFrame | Mapping[str, DataFrame]) -> DataFrame:
        """The lazy result.  Several tables give the union of their results with a measurement column.

        A global page counts over the union, a per-series page within each table.
        """
        if isinstance(source, DataFrame):
            if len(self.tables) > 1:
                raise SeriesError("several measurements need a mapping of DataFrames")
            return self._sorted(self._rows(source))
        if not self.tables:
            raise SeriesError("empty measurement")
        missing = [t for t in self.tables if t not in source]
        if missing:
            raise SeriesError(f"no measurement {missing[0]!r}")
        if len(self.tables) == 1:
            return self._sorted(self._rows(source[self.tables[0]]))
        joint = self.page_scope == "global" and (self.row_limit > 0 or self.row_offset > 0)
        own = replace(self, row_limit=0, row_offset=0) if joint else self
        parts = [own._rows(source[t], placed=joint).withColumn(MEASUREMENT, F.lit(t)) for t in self.tables]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return self._sorted(self._joint_page(rows) if joint else rows)

    def _joint_page(self, rows: DataFrame) -> DataFrame:
        """A page of the union: in time order, then by measurement and the tie-breakers."""
        ties = [MEASUREMENT, *(t for t in self.tags if t in rows.columns), *(c for c in rows.columns if c.startswith(_TIE))]
        time = _PLACE if _PLACE in rows.columns else TIME if TIME in rows.columns else None
        if time:
            cut = page(
                rows, time=time, ties=ties, limit=self.row_limit, offset=self.row_offset, descending=self.order == "DESC"
            )
        else:
            cut = page_distinct(rows, ties, limit=self.row_limit, offset=self.row_offset)
        return cut.drop(_PLACE, *(c for c in rows.columns if c.startswith(_TIE)))

    def _rows(self, df: DataFrame, placed: bool = False) -> DataFrame:
        time = self.time or time_column(df)
        if self.condition is not None:
            df = df.where(resolve(self.condition, df, time))
        selectors = [c for c in self.columns if isinstance(c, Selector)]
        if selectors:
            if len(selectors) > 1:
                raise SeriesError("one selector per query")
            if selectors[0].kind == "top":
                return self._paged(self._top(df, time, selectors[0]), selectors[0].output_name)
            return self._paged(self._last(df, time, selectors[0]))
        if self.bucket or any(c.aggregate for c in self.columns):
            return self._paged(self._aggregate(df, time))
        return self._plain(df, time, placed)

    def _plain(self, df: DataFrame, time: str, placed: bool = False) -> DataFrame:
        if self.row_limit > 0 or self.row_offset > 0:
            df = page(
                df,
                time=time,
                ties=self.ties,
                limit=self.row_limit,
                offset=self.row_offset,
                series=self.tags if self.page_scope == "series" else (),
                descending=self.order == "DESC",
            )
        keys = [t for t in self.tags if t not in self._selected()]
        place = [col(time).alias(_PLACE), *(col(t).alias(f"{_TIE}{i}") for i, t in enumerate(self.ties))] if placed else []
        if self.columns:
            df = df.select(
                *(col(k) for k in keys), *(c.output() for c in self.columns), *self._order_extra(df, time), *place
            )
        elif placed:
            df = df.select("*", *place)
        return self._labelled(df, time)

    def _order_extra(self, df: DataFrame, time: str) -> list[Column]:
        # A projection keeps the time column when the result is to be sorted by it;
        # beside an output of the same name it is kept under another name until then.
        if not self.order:
            return []
        return [col(time).alias(_HIDDEN) if time in self._selected() else col(time)]

    def _selected(self) -> set[str]:
        return {c.name for c in self.columns if isinstance(c, Term) and c.name}

    def _aggregate(self, df: DataFrame, time: str) -> DataFrame:
        if not self.columns:
            raise SeriesError("a time bucket needs an aggregate in the select list")
        plain = [c.name for c in self.columns if not c.aggregate and c.name not in self.tags]
        if plain:
            raise SeriesError(f"{plain} is neither aggregated nor grouped by")
        keys = [col(t) for t in self.tags]
        if self.bucket:
            keys.append(time_bucket(df, time, self.bucket.duration, self.zone).alias(self.bucket.name))
        wanted = [c.output() for c in self.columns if c.aggregate]
        result = df.groupBy(*keys).agg(*wanted) if keys else df.agg(*wanted)
        return self._labelled(result, self.bucket.name) if self.bucket else result

    def _last(self, df: DataFrame, time: str, selector: Selector) -> DataFrame:
        names = [c.name for c in self.columns if isinstance(c, Term) and c.name not in self.tags]
        keys = [col(t) for t in self.tags]
        if self.bucket:
            keys.append(time_bucket(df, time, self.bucket.duration, self.zone).alias("__bucket"))
        present = df.where(col(selector.source).isNotNull())
        wanted = {"__v": selector.source, "__t": time, **{f"__c{i}": n for i, n in enumerate(names)}}
        # Without a tie-break numbers stay in a hash aggregate; texts are sorted anyway, so all of a row decides.
        fixed = all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in wanted.values())
        ties = self.ties or (() if fixed else tuple(dict.fromkeys([selector.source, *names])))
        position = F.struct(col(time), *(col(t) for t in ties)) if ties else col(time)
        if not self.ties and fixed:
            # Fixed-width columns; each picks the same row.
            picks = [F.max_by(col(c), position).alias(k) for k, c in wanted.items()]
        else:
            row = F.struct(*(col(c).alias(k) for k, c in wanted.items()))
            picks = [F.max_by(row, position).alias("__row")]
        rows = present.groupBy(*keys).agg(*picks)
        if not keys:
            rows = rows.where(F.col(rows.columns[0]).isNotNull())
        if "__row" in rows.columns:
            rows = rows.select(*(c for c in rows.columns if c != "__row"), "__row.*")
        when = F.col("__bucket") if self.bucket else F.col("__t")
        return rows.select(
            *(col(t) for t in self.tags),
            when.alias(TIME),
            F.col("__v").alias(selector.output_name),
            *(F.col(f"__c{i}").alias(n) for i, n in enumerate(names)),
        )

    def _top(self, df: DataFrame, time: str, selector: Selector) -> DataFrame:
        names = [c.name for c in self.columns if isinstance(c, Term) and c.name not in self.tags]
        present = df.where(col(selector.source).isNotNull())
        order = [col(selector.source).desc(), *order_columns(time, self.ties, False)]
        if self.bucket:
            present = present.withColumn("__bucket", time_bucket(df, time, self.bucket.duration, self.zone))
        parts = [*(col(t) for t in self.tags), *([F.col("__bucket")] if self.bucket else [])]
        if parts:
            present = _top_per_group(present, parts, order, selector.n)
        else:
            present = present.orderBy(*order).limit(selector.n)
        return present.select(
            *(col(t) for t in self.tags),
            col(time).alias(TIME),
            col(selector.source).alias(selector.output_name),
            *(col(n) for n in names),
        )

    def _paged(self, rows: DataFrame, *ties: str) -> DataFrame:
        """A page of a grouped result: in time order, or in the order of the tags where it has no time."""
        if self.row_limit <= 0 and self.row_offset <= 0:
            return rows
        series = self.tags if self.page_scope == "series" else ()
        if TIME in rows.columns:
            return page(
                rows,
                time=TIME,
                ties=[*self.tags, *ties],
                limit=self.row_limit,
                offset=self.row_offset,
                series=series,
                descending=self.order == "DESC",
            )
        if series or not self.tags:
            # One row each: an offset leaves nothing of it.
            return rows.where(F.lit(self.row_offset <= 0))
        return page_distinct(rows, self.tags, limit=self.row_limit, offset=self.row_offset)

    def _labelled(self, df: DataFrame, time: str) -> DataFrame:
        if not (self.zone and self.time_label) or time not in df.columns:
            return df
        value = col(time)
        if isinstance(df.schema[time].dataType, T.TimestampType):
            value = F.to_utc_timestamp(value, F.current_timezone()).cast("timestamp_ntz")
        return df.withColumn(self.time_label, in_zone(value, self.zone))

    def _sorted(self, df: DataFrame) -> DataFrame:
        if not self.order:
            return df
        ties = [t for t in (*self.tags, *self.ties) if t in df.columns]
        grouped = any(isinstance(c, Selector) or c.aggregate for c in self.columns)
        if grouped and TIME not in df.columns:
            # Without a bucket there is no time; the tags alone order the rows.
            return df.orderBy(*(col(t).asc_nulls_last() for t in ties)) if ties else df
        time = _HIDDEN if _HIDDEN in df.columns else TIME if TIME in df.columns else (self.time or time_column(df))
        return df.orderBy(*order_columns(time, ties, self.order == "DESC")).drop(_HIDDEN)


def _top_per_group(df: DataFrame, keys: Sequence[Column], order: Sequence[Column], n: int) -> DataFrame:
    """Top n per group; every task first keeps its own n rows of a group."""
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > threshold:
        # Beyond Spark's own pre-cut, cut within hash slices of each group first.
        slices = F.pmod(F.xxhash64(*(col(c) for c in df.columns if _hashable(df, c))), F.lit(64))
        sliced = Window.partitionBy(*keys, F.col("__slice")).orderBy(*order)
        df = df.withColumn("__slice", slices).withColumn("__n", F.row_number().over(sliced))
        df = df.where(F.col("__n") <= n).drop("__n", "__slice")
    numbered = df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col("__n") <= n).drop("__n")


def _hashable(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, (T.MapType, T.VariantType))


# --------------------------------------------------------------------------
# scope and parameters


def in_scope(df: DataFrame, db: str, rp: str = "", *, default_rp: str = DEFAULT_POLICY) -> DataFrame:
    """Rows of one database and policy; an empty policy means the default one."""
    require_name(db, "database name")
    return df.where((F.col("db") == db) & (F.col("rp") == (rp or default_rp)))


def bound_where(df: DataFrame, predicate: str, **params: Any) -> DataFrame:
    """Filter by a predicate with ``:name`` parameters; values are bound, never spliced into the text."""
    return df.sparkSession.sql(f"SELECT * FROM {{df}} WHERE {predicate}", args=params, df=df)
