"""Validation, rejects, duplicate merging, type conflicts and block statistics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.functions.values import value_type
from sparkseries.model import TIME, TIME_NS, SeriesError, col
from sparkseries.operators.points import field_types_of

REASONS = "reasons"


def merge_duplicates(
    df: DataFrame,
    keys: Iterable[str],
    seq: str | Iterable[str],
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """One row per key; in every column the last non-null value in ``seq`` order stays.

    The keys are normally the tags and the time.  ``seq`` must order the rows of
    a key without ties.  One shuffle on the keys; each task first merges its own rows.
    """
    keys = list(keys)
    seq = [seq] if isinstance(seq, str) else list(seq)
    if not keys or not seq:
        raise SeriesError("merge needs keys and an arrival order")
    columns = [c for c in df.columns if c not in {*keys, *seq}] if columns is None else list(columns)
    if not columns:
        return df.select(*(col(k) for k in keys)).distinct()
    position = col(seq[0]) if len(seq) == 1 else F.struct(*(col(s) for s in seq))
    metadata = {f.name: f.metadata for f in df.schema.fields}
    # The order is nulled with the value: max_by skips rows without an order.
    chosen = [
        F.max_by(col(c), F.when(col(c).isNotNull(), position)).alias(c, metadata=metadata[c]) for c in columns
    ]
    return df.groupBy(*(col(k) for k in keys)).agg(*chosen)


def merge_points(points: DataFrame, seq: str | Iterable[str], newest: str | None = None) -> DataFrame:
    """Points with one row per series and time; of every field the last value in ``seq`` order stays.

    ``newest`` names a column whose largest value is kept.

    Fields are merged as rows of their own, so even a (series, time) with any
    number of copies combines before the shuffle; only the distinct fields of a
    point meet in one group.
    """
    seq = [seq] if isinstance(seq, str) else list(seq)
    if not seq:
        raise SeriesError("merge needs an arrival order")
    keys = [c for c in ("db", "rp", "measurement", "tags", TIME_NS) if c in points.columns]
    position = col(seq[0]) if len(seq) == 1 else F.struct(*(col(s) for s in seq))
    # A series is grouped by its sorted tag entries; maps do not compare.
    entries = F.array_sort(F.map_entries("tags")).alias("__tags")
    kept = [col(newest).alias("__newest")] if newest else []
    rows = points.select(
        *(entries if k == "tags" else col(k) for k in keys), *kept, position.alias("__seq"), F.explode("fields").alias("__key", "__value")
    ).where(F.col("__value").isNotNull())
    by = ["__tags" if k == "tags" else k for k in keys]
    most = [F.max("__newest").alias("__newest")] if newest else []
    latest = rows.groupBy(*by, "__key").agg(F.max_by("__value", "__seq").alias("__value"), *most)
    merged = latest.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("__key"), F.col("__value")))).alias("fields"), *most
    )
    return merged.select(
        *(F.map_from_entries("__tags").alias("tags") if k == "tags" else col(k) for k in keys),
        "fields",
        *([F.col("__newest").alias(newest)] if newest else []),
    )


def check_record(df: DataFrame, time: str = TIME) -> DataFrame:
    """(check, violations) of a measurement table: one pass, one row per check.

    The checks are a time column that is present, last and free of nulls, at
    least one other column, unique names, and names in order.
    """
    names = df.columns
    others = [n for n in names if n != time]
    schema_checks = {
        "time_missing": time not in names,
        "time_not_last": time in names and names[-1] != time,
        "no_other_column": not others,
        "repeated_name": len(set(names)) != len(names),
        "names_not_sorted": others != sorted(others),
    }
    usable = time in names and names.count(time) == 1
    nulls = F.count_if(col(time).isNull()) if usable else F.lit(0).cast("bigint")
    counted = df.agg(nulls.alias("time_null"), F.count(F.lit(1)).alias("rows"))
    rows = [F.struct(F.lit("time_null").alias("check"), F.col("time_null").alias("violations"))]
    for name, broken in schema_checks.items():
        rows.append(F.struct(F.lit(name).alias("check"), F.lit(int(broken)).cast("bigint").alias("violations")))
    return counted.select(F.inline(F.array(*rows)))


def require_record(df: DataFrame, time: str = TIME) -> DataFrame:
    """The table itself with columns in name order and time last, or an error that names the broken checks."""
    fixable = {"time_not_last", "names_not_sorted"}
    broken = [r["check"] for r in check_record(df, time).where("violations > 0").collect() if r["check"] not in fixable]
    if broken:
        raise SeriesError(f"invalid record: {', '.join(sorted(broken))}")
    return df.select(*(col(n) for n in sorted(c for c in df.columns if c != time)), col(time))


def reject_reasons(points: DataFrame, *, for_text: bool = False) -> DataFrame:
    """Add ``reasons``: everything wrong with a point, an empty array for a good one.

    ``for_text`` also refuses line breaks, which line protocol cannot carry.
    """
    tag_keys, fields = F.coalesce(F.map_keys("tags"), F.array().cast("array<string>")), F.map_entries("fields")
    field_keys = F.coalesce(F.map_keys("fields"), F.array().cast("array<string>"))
    checks: list[tuple[Column, str]] = [
        (F.coalesce(F.length("measurement"), F.lit(0)) == 0, "empty measurement"),
        (F.size(field_keys) == 0, "no field"),
        (F.array_contains(tag_keys, TIME), "tag name time is reserved"),
        (F.array_contains(field_keys, TIME), "field name time is reserved"),
        (F.array_contains(tag_keys, ""), "empty tag name"),
        (F.array_contains(field_keys, ""), "empty field name"),
        (F.exists(fields, lambda e: value_type(e["value"]).isNull()), "unsupported field type"),
    ]
    if for_text:
        texts = F.concat(F.array("measurement"), tag_keys, F.coalesce(F.map_values("tags"), F.array().cast("array<string>")), field_keys)
        values = F.coalesce(F.map_values("fields")["s"], F.array().cast("array<string>"))
        checks.append((F.exists(F.concat(texts, values), lambda t: t.contains("\n")), "line break in a name or value"))
    reasons = F.array_compact(F.array(*(F.when(bad, F.lit(text)) for bad, text in checks)))
    return points.withColumn(REASONS, reasons)


def split_rejects(points: DataFrame, *, for_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good points, and rejected points with their reasons."""
    judged = reject_reasons(points, for_text=for_text)
    return judged.where(F.size(REASONS) == 0).drop(REASONS), judged.where(F.size(REASONS) > 0)


def type_conflicts(points: DataFrame) -> DataFrame:
    """(measurement, key, types) of fields that occur with more than one type."""
    types = field_types_of(points).groupBy("measurement", "key").agg(F.array_sort(F.collect_set("type")).alias("types"))
    return types.where(F.size("types") > 1)


def block_stats(points: DataFrame) -> DataFrame:
    """Rows, first and last time per measurement."""
    return points.groupBy("measurement").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(TIME_NS).alias("min_time"),
        F.max(TIME_NS).alias("max_time"),
    )
