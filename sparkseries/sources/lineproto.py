"""Line protocol text: ``measurement[,tag=value...] field=value[,...] [timestamp]``.

Reading is built from regular expressions and array functions only.  One
substitution cuts a line into its four sections; the sections are then cut
into pairs.  Every loop in the patterns is possessive, so a value of any
length is matched without recursion or backtracking.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkseries.functions.timefns import epoch_ns, from_precision
from sparkseries.functions.values import entries_map, infer_values, plain_double, trimmed
from sparkseries.model import (
    FIELD,
    FIELDS_TYPE,
    TAG,
    TAGS_TYPE,
    TIME_NS,
    SeriesError,
    col,
    columns_with_role,
    require_name,
    slot_for,
    time_column,
)

REASON = "reason"

# Quotes group text only in field keys and values.
_QUOTED = r'"[^\\"]*+(?:\\.[^\\"]*+)*+"'
_MEASUREMENT = r"(?=[^, ])[^\\, ]*+(?:\\.[^\\, ]*+)*+"
_TAG_KEY = r"[^\\=]*+(?:\\.[^\\=]*+)*+"
_TAG_VALUE = r"[^\\, ]*+(?:\\.[^\\, ]*+)*+"
_FIELD_KEY = rf'(?:[^\\"=]++|\\.|{_QUOTED})*+'
_FIELD_VALUE = rf'(?:[^\\", ]++|\\.|{_QUOTED})*+'
_TAG = rf"({_TAG_KEY})=({_TAG_VALUE})(?:,|$)"
_FIELD = rf"({_FIELD_KEY})=({_FIELD_VALUE})(?:,|$)"
LINE = (
    rf"^({_MEASUREMENT})(?:,((?:{_TAG_KEY}={_TAG_VALUE})(?:,{_TAG_KEY}={_TAG_VALUE})*+))?"
    rf" ({_FIELD_KEY}={_FIELD_VALUE}(?:,{_FIELD_KEY}={_FIELD_VALUE})*+)(?: ([0-9]*+))?$"
)

BAD_LINE = "malformed line"
BAD_TIME = "timestamp out of range"
EMPTY_KEY = "empty tag or field name"


def _unescape(text: Column) -> Column:
    return F.when(text.contains("\\"), F.regexp_replace(text, r"\\(.)", "$1")).otherwise(text)


def _unquote(text: Column) -> Column:
    bare = F.regexp_replace(text, r'\\(.)|"', "$1")
    return F.when(text.contains("\\") | text.contains('"'), bare).otherwise(text)


def _field_values(tokens: Column) -> Column:
    def clean(token: Column) -> Column:
        quoted, bare = token.startswith('"'), _unquote(token)
        return F.struct(F.when(quoted, bare).otherwise(trimmed(bare)).alias("t"), quoted.alias("q"))

    return infer_values(F.transform(tokens, clean))


def parse_lines(df: DataFrame, text: str = "value", *, precision: str | Column = "ns") -> DataFrame:
    """Turn a column of lines into points.

    Adds ``measurement``, ``tags``, ``fields``, ``time_ns`` (null when the line
    has no timestamp) and ``reason`` (null for a good line).  Blank lines are
    dropped.  Use :func:`good_points` and :func:`rejected_lines` to split the
    result, or :func:`require_clean` to refuse any bad line.
    """
    line = trimmed(col(text))
    lines = df.withColumn("__line", line).where(F.length("__line") > 0)
    single = F.when(~F.col("__line").contains("\n"), F.col("__line"))
    sections = lines.withColumn(
        "__part", F.split(F.regexp_replace(single, LINE, "$1\n$2\n$3\n$4"), "\n", -1)
    )
    part = F.col("__part")
    ok = F.size(part) == 4
    name, tag_text, field_text, stamp = (F.get(part, F.lit(i)) for i in range(4))

    # Without a backslash every comma separates tags and the first "=" ends a key.
    simple = F.transform(F.split(tag_text, ","), lambda t: F.split(t, "=", 2))
    plain_tags = ~tag_text.contains("\\") & tag_text.rlike("^[^=,]*=[^,]*(?:,[^=,]*=[^,]*)*+$")
    tag_keys = F.when(plain_tags, F.transform(simple, lambda p: F.get(p, F.lit(0)))).otherwise(
        F.transform(F.regexp_extract_all(tag_text, F.lit(_TAG), F.lit(1)), _unescape)
    )
    tag_values = F.when(plain_tags, F.transform(simple, lambda p: F.get(p, F.lit(1)))).otherwise(
        F.transform(F.regexp_extract_all(tag_text, F.lit(_TAG), F.lit(2)), _unescape)
    )
    has_tags = F.length(tag_text) > 0
    field_keys = F.transform(F.regexp_extract_all(field_text, F.lit(_FIELD), F.lit(1)), _unquote)
    field_values = _field_values(F.regexp_extract_all(field_text, F.lit(_FIELD), F.lit(2)))
    stamp_number = F.when(F.length(stamp) > 0, stamp.try_cast("bigint"))

    cut = sections.select(
        *(col(c) for c in df.columns),
        ok.alias("__ok"),
        F.when(ok, _unescape(name)).alias("measurement"),
        F.when(ok & has_tags, tag_keys).alias("__tk"),
        F.when(ok & has_tags, tag_values).alias("__tv"),
        F.when(ok, field_keys).alias("__fk"),
        F.when(ok, field_values).alias("__fv"),
        F.when(ok, stamp_number).alias("__t"),
        F.coalesce(ok & (F.length(stamp) > 0) & stamp_number.isNull(), F.lit(False)).alias("__late"),
    )
    no_tags = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    empty_key = F.coalesce(F.array_contains("__tk", ""), F.lit(False)) | F.coalesce(F.array_contains("__fk", ""), F.lit(False))
    stamped = from_precision(F.col("__t"), precision)
    reason = (
        F.when(~F.coalesce(F.col("__ok"), F.lit(False)), BAD_LINE)
        .when(F.col("__late") | (F.col("__t").isNotNull() & stamped.isNull()), BAD_TIME)
        .when(empty_key, EMPTY_KEY)
    )
    tags = F.when(F.col("__tk").isNull(), no_tags).otherwise(entries_map(F.col("__tk"), F.col("__tv")))
    point = F.struct(
        F.col("measurement"),
        F.when(F.col("__ok"), tags).cast(TAGS_TYPE).alias("tags"),
        F.when(F.col("__ok"), entries_map(F.col("__fk"), F.col("__fv"))).cast(FIELDS_TYPE).alias("fields"),
        stamped.alias(TIME_NS),
        reason.alias(REASON),
    )
    # A generator ends the projection: filters on the points stay above the
    # parsing instead of being rewritten into a second copy of it.
    return cut.select(*(col(c) for c in df.columns), F.inline(F.array(point)))


def good_points(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REASON).isNull()).drop(REASON)


def rejected_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REASON).isNotNull()).drop("measurement", "tags", "fields", TIME_NS)


def require_clean(parsed: DataFrame, text: str = "value") -> DataFrame:
    """The points, or an error that names the first bad line.  Runs one job over the lines."""
    bad = parsed.where(F.col(REASON).isNotNull()).select(text, REASON).limit(1).collect()
    if bad:
        raise SeriesError(f"{bad[0][REASON]}: {bad[0][text]!r}")
    return good_points(parsed)


#: columns of :func:`read_lines` that order its lines
LINE_ORDER = ("file", "block", "seq")


def read_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """Lines of text files (plain or compressed) in ``value``, with their place in :data:`LINE_ORDER`.

    ``file`` and ``block`` (the offset of the split) name a place in the input,
    and ``seq`` grows within it; together they are an arrival order for merging.
    """
    lines = spark.read.options(**options).text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


def insert_lines(df: DataFrame, text: str = "command") -> DataFrame:
    """The lines of ``INSERT`` statements, numbered from 1 in ``line_no``; other statements give no rows."""
    command = trimmed(col(text))
    body = F.regexp_extract(command, r"(?is)^insert(.*+)$", 1)
    lines = F.posexplode(F.split(trimmed(body), "\n"))
    return (
        df.where(command.rlike("(?i)^insert"))
        .select(*(col(c) for c in df.columns), lines.alias("line_no", "value"))
        .withColumn("line_no", F.col("line_no") + 1)
        .where(F.length(trimmed(F.col("value"))) > 0)
    )


# --------------------------------------------------------------------------
# writing


def _escape(text: Column, specials: str) -> Column:
    return F.regexp_replace(text, rf"([\\{specials}])", r"\\$1")


def _value_token(value: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.regexp_replace(value["s"], r'(["\\])', r"\\$1"), F.lit('"'))
    return F.coalesce(
        plain_double(value["f"]),
        F.concat(value["i"].cast("string"), F.lit("i")),
        quoted,
        F.when(value["b"], "T").when(~value["b"], "F"),
        F.concat(value["u"].cast("string"), F.lit("u")),
    )


def encode_line(measurement: Column, tags: Column, fields: Column, time_ns: Column) -> Column:
    """One line per point with keys in order, or null where a point has no measurement or no field.

    A backslash is escaped everywhere, so that reading a line gives the point back.
    """
    tag_parts = F.transform(
        F.array_sort(F.map_entries(F.map_filter(tags, lambda k, v: v.isNotNull()))),
        lambda e: F.concat(_escape(e["key"], ", ="), F.lit("="), _escape(e["value"], ", =")),
    )
    present = F.array_sort(F.filter(F.map_entries(fields), lambda e: e["value"].isNotNull()))
    field_parts = F.transform(present, lambda e: F.concat(_escape_key(e["key"]), F.lit("="), _value_token(e["value"])))
    head = F.concat_ws(",", F.array_insert(F.coalesce(tag_parts, F.array().cast("array<string>")), F.lit(1), _escape(measurement, ", ")))
    stamp = F.when(F.coalesce(time_ns, F.lit(0)) == 0, "").otherwise(F.concat(F.lit(" "), time_ns.cast("string")))
    body = F.concat_ws(",", field_parts)
    return F.when((F.length(measurement) > 0) & (F.length(body) > 0), F.concat(head, F.lit(" "), body, stamp))


def _escape_key(key: Column) -> Column:
    # A quote in a field key would start quoted text when read back.
    return F.regexp_replace(key, r'([\\, ="])', r"\\$1")


def encode_points(points: DataFrame, name: str = "value") -> DataFrame:
    """Column of lines; points without measurement or fields are dropped."""
    line = encode_line(F.col("measurement"), F.col("tags"), F.col("fields"), F.col(TIME_NS))
    return points.select(F.explode(F.array_compact(F.array(line))).alias(name))


def encode_table(
    df: DataFrame,
    measurement: str,
    *,
    time: str | None = None,
    tags: Iterable[str] | None = None,
    fields: Iterable[str] | None = None,
    name: str = "value",
) -> DataFrame:
    """Lines of a measurement table, the same as :func:`encode_points` gives for its points.

    The columns are known, so keys are escaped and ordered once and a row is a
    plain concatenation.
    """
    require_name(measurement, "measurement")
    time = time or time_column(df)
    tags = sorted(tags if tags is not None else columns_with_role(df, TAG))
    fields = sorted(fields if fields is not None else columns_with_role(df, FIELD))
    types = {f.name: f.dataType for f in df.schema.fields}
    if not fields:
        raise SeriesError("no field")

    def key(text: str, specials: str) -> str:
        return "".join("\\" + c if c in specials else c for c in text)

    def token(column: Column, slot: str) -> Column:
        if slot == "s":
            return F.concat(F.lit('"'), _escape_where(column, r'["\\]', r'(["\\])'), F.lit('"'))
        if slot == "f":
            return plain_double(column.cast("double"))
        if slot == "b":
            return F.when(column, "T").when(~column, "F")
        return F.concat(column.cast("string"), F.lit(slot))

    head = F.concat(
        F.lit(key(measurement, "\\, ")),
        *(
            F.coalesce(
                F.concat(F.lit("," + key(t, "\\, =") + "="), _escape_where(col(t).cast("string"), r"[\\, =]", r"([\\, =])")),
                F.lit(""),
            )
            for t in tags
        ),
    )
    parts = [F.concat(F.lit(key(f, '\\, ="') + "="), token(col(f), slot_for(types[f]))) for f in fields]
    stamp = F.concat(F.lit(" "), F.nullif(epoch_ns(df, time), F.lit(0).cast("bigint")).cast("string"))
    line = F.concat(head, F.lit(" "), F.concat_ws(",", *parts), F.coalesce(stamp, F.lit("")))
    some = reduce(operator.or_, [col(f).isNotNull() for f in fields])
    return df.where(some).select(line.alias(name))


def _escape_where(text: Column, found: str, taken: str) -> Column:
    return F.when(text.rlike(found), F.regexp_replace(text, taken, r"\\$1")).otherwise(text)


def write_lines(points: DataFrame, path: str, *, compression: str = "none", mode: str = "errorifexists") -> None:
    """Write points as text; values with a line break cannot be written and raise an error."""
    lines = encode_points(points)
    checked = F.when(
        F.col("value").contains("\n"), F.raise_error(F.lit("a line break cannot be written as line protocol"))
    ).otherwise(F.col("value"))
    lines.select(checked.cast("string").alias("value")).write.mode(mode).option("compression", compression).text(path)
