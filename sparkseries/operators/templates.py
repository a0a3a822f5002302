"""Bind ``$name`` placeholders of template points to rows of parameters.

Values are put in as values: text that comes out of a parameter is never
parsed again, so separators and quotes in it stay part of one value.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.functions.values import (
    entries_map,
    general_double,
    let,
    slot_of_column,
    slot_value,
    string_slot,
    value_text,
)
from sparkseries.model import FIELDS_TYPE, SLOT_DDL, SLOTS, TAGS_TYPE, TIME_NS, SeriesError, col, slot_for
from sparkseries.sources.lineproto import insert_lines, parse_lines, require_clean

UNRESOLVED = "unresolved"
_NAME = "[A-Za-z0-9_]"
_NO_NAMES = "array<string>"


def parameters(df: DataFrame, names: Mapping[str, str]) -> Column:
    """Map of parameter name to typed value, from ``{parameter: column}``; null values count as not given."""
    if not names:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(f"array<{SLOT_DDL}>"))
    types = {f.name: f.dataType for f in df.schema.fields}
    values = [slot_of_column(col(c), types[c]) for c in names.values()]
    built = F.map_from_arrays(F.array(*(F.lit(n) for n in names)), F.array(*values))
    return F.map_filter(built, lambda k, v: v.isNotNull()).cast(FIELDS_TYPE)


def _bind_text(text: Column, params: Column, names: Column, odd: Column) -> Column:
    """``struct<text, missing>`` of a text: each ``$`` takes the longest known name that follows it."""

    def cut(piece: Column) -> Column:
        return F.struct(piece.alias("piece"), F.regexp_extract(piece, f"^{_NAME}+", 0).alias("word"))

    def longest(piece: Column, word: Column) -> Column:
        searched = F.array_max(
            F.transform(
                F.filter(names, lambda n: piece.startswith(n)), lambda n: F.struct(F.length(n).alias("size"), n.alias("name"))
            )
        )["name"]
        # A whole word that is known is the longest name, unless names hold other characters.
        return F.when(~odd & F.array_contains(names, word), word).otherwise(searched)

    def named(part: Column) -> Column:
        piece, word = part["piece"], part["word"]
        return F.struct(piece.alias("piece"), word.alias("word"), longest(piece, word).alias("name"))

    def bound(part: Column) -> Column:
        piece, word, name = part["piece"], part["word"], part["name"]
        rest = F.substring(piece, F.length(name) + 1, F.length(piece))
        return F.struct(
            F.when(name.isNotNull(), F.concat(value_text(params[name]), rest)).otherwise(F.concat(F.lit("$"), piece)).alias("text"),
            F.when(name.isNull() & (F.length(word) > 0), F.concat(F.lit("$"), word)).alias("missing"),
        )

    def joined(pieces: Column) -> Column:
        after = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
        return let(
            F.transform(F.transform(F.transform(after, cut), named), bound),
            lambda parts: F.struct(
                F.concat(F.get(pieces, F.lit(0)), F.array_join(parts["text"], "")).alias("text"),
                F.array_compact(parts["missing"]).alias("missing"),
            ),
        )

    plain = F.struct(text.alias("text"), F.array().cast(_NO_NAMES).alias("missing"))
    return F.when(text.contains("$"), let(F.split(text, r"\$", -1), joined)).otherwise(plain)


def bind_points(df: DataFrame, params: str = "params") -> DataFrame:
    """Bind the points of a DataFrame with the parameter map in each row.

    ``unresolved`` lists the placeholders without a parameter; a row where it is
    not empty is a reject.  Without any parameter a point stays as it is.
    """
    given = F.coalesce(F.size(col(params)), F.lit(0)) > 0
    names = F.filter(F.map_keys(col(params)), lambda n: F.length(n) > 0)
    odd = F.exists(names, lambda n: ~n.rlike(f"^{_NAME}+$"))
    no_texts = F.array().cast(_NO_NAMES)
    texts = F.concat(
        F.array("measurement"),
        F.coalesce(F.map_keys("tags"), no_texts),
        F.coalesce(F.map_values("tags"), no_texts),
        F.coalesce(F.map_keys("fields"), no_texts),
        F.coalesce(F.map_values("fields")["s"], no_texts),
    )
    named = df.select(
        *(col(c) for c in df.columns),
        F.when(given, names).alias("__names"),
        F.when(given, odd).alias("__odd"),
        F.when(given, texts).alias("__texts"),
    )
    # All texts of a point go through one expression.
    all_bound = F.transform("__texts", lambda t: _bind_text(t, col(params), F.col("__names"), F.col("__odd")))
    staged = named.select(*(col(c) for c in df.columns), "__names", all_bound.alias("__bound"))

    tag_count, field_count = (F.greatest(F.size(m), F.lit(0)) for m in ("tags", "fields"))
    tag_keys = F.slice("__bound", F.lit(2), tag_count)
    tag_values = F.slice("__bound", tag_count + 2, tag_count)
    field_keys = F.slice("__bound", tag_count * 2 + 2, field_count)
    field_texts = F.slice("__bound", tag_count * 2 + field_count + 2, field_count)
    field_values = F.zip_with(
        F.map_values("fields"), field_texts, lambda v, b: _field_value(v, b, col(params), F.col("__names"))
    )
    parts = staged.select(
        *(col(c) for c in df.columns),
        F.get("__bound", F.lit(0)).alias("__m"),
        F.concat(tag_keys, tag_values, field_keys)["missing"].alias("__missing"),
        tag_keys["text"].alias("__tk"),
        tag_values["text"].alias("__tv"),
        field_keys["text"].alias("__fk"),
        field_values.alias("__fv"),
    )
    kept = [c for c in df.columns if c not in ("measurement", "tags", "fields", params)]
    missing = F.concat(F.col("__m.missing"), F.flatten("__missing"), F.flatten(F.col("__fv")["missing"]))
    point = F.struct(
        F.coalesce(F.col("__m.text"), F.col("measurement")).alias("measurement"),
        F.when(F.col("__tk").isNotNull(), entries_map(F.col("__tk"), F.col("__tv"))).otherwise(F.col("tags")).cast(TAGS_TYPE).alias("tags"),
        F.when(F.col("__fk").isNotNull(), entries_map(F.col("__fk"), F.col("__fv")["value"]))
        .otherwise(F.col("fields"))
        .cast(FIELDS_TYPE)
        .alias("fields"),
        F.array_distinct(F.coalesce(missing, no_texts)).alias(UNRESOLVED),
    )
    return parts.select(*(col(k) for k in kept), F.inline(F.array(point)))


def _field_value(value: Column, bound: Column, params: Column, names: Column) -> Column:
    """``struct<value, missing>``: text that is one placeholder takes the typed value, other text is bound."""
    text = value["s"]
    name = F.when(text.rlike(rf"^\${_NAME}+$"), F.substring(text, F.lit(2), F.length(text)))
    none = F.array().cast(_NO_NAMES)
    unknown = F.when(F.array_contains(names, name), none).otherwise(F.array(text))
    return F.struct(
        F.when(name.isNotNull(), params[name]).when(text.contains("$"), string_slot(bound["text"])).otherwise(value).alias("value"),
        F.when(name.isNotNull(), unknown).otherwise(F.coalesce(bound["missing"], none)).alias("missing"),
    )


#: templates, and characters after their ``$``, up to which they are compiled into one expression
COMPILED_TEMPLATES, COMPILED_CHARS = 64, 2_000
_POINT = ("measurement", "tags", "fields")


def bind_templates(templates: DataFrame, params: DataFrame, on: str = "template_id") -> DataFrame:
    """Bind every template point to each parameter row of the same template.

    Templates are read once and compiled: each placeholder becomes a look-up of
    the names that it may mean, each template an expression over them, and one
    CASE on the key chooses, so rows are neither joined nor shuffled and no
    text is searched.  More than ``COMPILED_TEMPLATES`` templates, or longer
    ones than ``COMPILED_CHARS``, are joined instead, with the same result.
    Rows without a template are not in the result; ``without_template`` gives
    them.
    """
    if "params" not in params.columns:
        raise SeriesError("parameter rows need a params column")
    few = templates.where(col(on).isNotNull()).limit(COMPILED_TEMPLATES + 1).collect()
    extra = [f for f in templates.schema.fields if f.name not in (on, *_POINT)]
    compiled = _Compiled([tuple(r[c] for c in _POINT) for r in few])
    plain = all(isinstance(f.dataType, (T.AtomicType, T.NullType)) for f in [*extra, templates.schema[on]])
    if len(few) > COMPILED_TEMPLATES or compiled.chars > COMPILED_CHARS or not plain or set(params.columns) & {f.name for f in extra}:
        return bind_points(params.join(templates, on))
    return compiled.bind(params, on, few, templates.schema, extra)


class _Compiled:
    """Expressions of templates over a ``params`` map.

    The text after a ``$`` can only mean one of its own beginnings; the longest
    that the row knows is chosen once for all templates that share the text.
    """

    def __init__(self, points: list[tuple]):
        self.points = points
        self.pieces: dict[str, int] = {}
        for measurement, tags, fields in points:
            texts = [measurement, *tags, *tags.values(), *fields, *(v["s"] or "" for v in fields.values())]
            for text in texts:
                for piece in text.split("$")[1:]:
                    self.pieces.setdefault(piece, len(self.pieces))
        self.chars = sum(map(len, self.pieces))

    def bind(self, params: DataFrame, on: str, rows: list, schema: T.StructType, extra: list[T.StructField]) -> DataFrame:
        known = F.map_keys("params")
        named = params.withColumns({f"__n{i}": self._meant(piece, known) for piece, i in self.pieces.items()})
        shown = named.withColumns({f"__t{i}": value_text(F.col("params")[F.col(f"__n{i}")]) for i in self.pieces.values()})
        given = F.coalesce(F.size("params"), F.lit(0)) > 0
        by_key: dict = {}
        for row, point in zip(rows, self.points):
            by_key.setdefault(row[on], []).append((row, point))
        chosen = None
        for key, own in by_key.items():
            structs = F.array(*(self._struct(row, point, given, extra) for row, point in own))
            is_key = col(on) == F.lit(key).cast(schema[on].dataType)
            chosen = F.when(is_key, structs) if chosen is None else chosen.when(is_key, structs)
        kept = [on, *(c for c in params.columns if c not in (on, "params", *_POINT))]
        if chosen is None:
            names = [f"{c} {d}" for c, d in (("measurement", "string"), ("tags", TAGS_TYPE.simpleString()), ("fields", FIELDS_TYPE.simpleString()))]
            types = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in extra), *names, f"{UNRESOLVED} {_NO_NAMES}"]
            chosen = F.lit(None).cast(f"array<struct<{', '.join(t.replace(' ', ': ', 1) for t in types)}>>")
        return shown.select(*(col(c) for c in kept), F.inline(chosen))

    @staticmethod
    def _meant(piece: str, known: Column) -> Column:
        name = F.lit(None).cast("string")
        for size in range(1, len(piece) + 1):  # the last test made is that of the shortest
            name = F.when(F.array_contains(known, piece[:size]), piece[:size]).otherwise(name)
        return name

    def _text(self, text: str) -> tuple[Column, list[Column]]:
        head, *rest = text.split("$")
        parts, missing = [F.lit(head)], []
        for piece in rest:
            name, value = (F.col(f"__{c}{self.pieces[piece]}") for c in "nt")
            after = F.substring(F.lit(piece), F.length(name) + 1, F.lit(len(piece)))
            parts.append(F.when(name.isNotNull(), F.concat(value, after)).otherwise(F.lit("$" + piece)))
            if word := re.match(f"{_NAME}+", piece):
                missing.append(F.when(name.isNull(), F.lit("$" + word[0])))
        return F.concat(*parts) if rest else parts[0], missing

    def _field(self, slots) -> tuple[Column, list[Column]]:
        text = slots["s"]
        if text is None or "$" not in text:
            return _plain_slot(slots), []
        if whole := re.fullmatch(rf"\$({_NAME}+)", text):
            known = F.array_contains(F.map_keys("params"), whole[1])
            return F.col("params")[whole[1]], [F.when(~known, F.lit(text))]
        bound, missing = self._text(text)
        return string_slot(bound), missing

    def _struct(self, row, point: tuple, given: Column, extra: list[T.StructField]) -> Column:
        measurement, tags, fields = point
        name, missing = self._text(measurement)
        maps, later = [], []
        for items, kind, convert in ((tags, TAGS_TYPE, self._text), (fields, FIELDS_TYPE, self._field)):
            keys = [self._text(k) for k in items]
            values = [convert(v) for v in items.values()]
            maps.append(_built([k for k, _ in keys], [v for v, _ in values], any("$" in k for k in items), kind))
            missing += [m for _, lost in keys for m in lost]
            (missing if convert == self._text else later).extend(m for _, lost in values for m in lost)
        plain = [_built([F.lit(k) for k in tags], [F.lit(v) for v in tags.values()], False, TAGS_TYPE)]
        plain.append(_built([F.lit(k) for k in fields], [_plain_slot(v) for v in fields.values()], False, FIELDS_TYPE))
        none = F.array().cast(_NO_NAMES)
        lost = F.array_distinct(F.array_compact(F.array(*missing, *later).cast(_NO_NAMES)))
        either = [F.when(given, x).otherwise(y) for x, y in zip((name, *maps, lost), (F.lit(measurement), *plain, none))]
        own = [F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in extra]
        return F.struct(*own, *(c.alias(n) for c, n in zip(either, (*_POINT, UNRESOLVED))))


def _plain_slot(slots) -> Column:
    slot = next(s for s in SLOTS if slots[s] is not None)
    return slot_value(slot, F.lit(str(slots[slot])) if slot == "u" else F.lit(slots[slot]))


def _built(keys: list[Column], values: list[Column], may_meet: bool, kind) -> Column:
    """A map of columns; keys with placeholders may meet or be null."""
    if not keys:
        return F.map_from_arrays(F.array().cast(_NO_NAMES), F.array().cast(_NO_NAMES)).cast(kind)
    if may_meet:
        return entries_map(F.array(*keys), F.array(*values)).cast(kind)
    return F.create_map(*(x for pair in zip(keys, values) for x in pair)).cast(kind)


def without_template(templates: DataFrame, params: DataFrame, on: str = "template_id") -> DataFrame:
    """Parameter rows that ``bind_templates`` cannot bind because no template has their key: rejects."""
    return params.join(templates.select(on).distinct(), on, "left_anti")


def bound_points(bound: DataFrame) -> DataFrame:
    return bound.where(F.size(UNRESOLVED) == 0).drop(UNRESOLVED)


def unresolved_points(bound: DataFrame) -> DataFrame:
    return bound.where(F.size(UNRESOLVED) > 0)


# --------------------------------------------------------------------------
# one statement for all rows


def bind_statement(df: DataFrame, statement: str, names: Mapping[str, str], keep: Iterable[str] = ()) -> DataFrame:
    """Points of one statement text bound to every row of ``df``, with ``{parameter: column}``.

    The text is read once, so each placeholder becomes a column reference and a
    row costs no text search.  A placeholder without a parameter is an error; a
    row where a parameter is null names it in ``unresolved``.
    """
    spark = df.sparkSession
    text = spark.createDataFrame([(statement,)], "command string")
    lines = insert_lines(text) if re.match(r"\s*insert\b", statement, re.I) else text.select(
        F.explode(F.split("command", "\n")).alias("value")
    )
    points = require_clean(parse_lines(lines)).select("measurement", "tags", "fields", TIME_NS).collect()
    if not points:
        raise SeriesError("no point in the statement")
    binder = _Binder(df, names)
    bound = [binder.point(p["measurement"], p["tags"], p["fields"], p[TIME_NS]) for p in points]
    return df.select(*(col(k) for k in keep), F.inline(F.array(*bound)))


class _Binder:
    """Columns for the texts of a template, over one DataFrame of parameters."""

    def __init__(self, df: DataFrame, names: Mapping[str, str]):
        types = {f.name: f.dataType for f in df.schema.fields}
        self.slots = {n: slot_of_column(col(c), types[c]) for n, c in names.items() if n}
        self.columns = {n: (col(c), slot_for(types[c])) for n, c in names.items() if n}
        self.used: dict[str, None] = {}

    def text(self, text: str) -> Column:
        parts = [F.lit(piece) if literal else self._spliced(piece) for literal, piece in self._pieces(text)]
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    def _pieces(self, text: str) -> list[tuple[bool, str]]:
        if not self.columns or "$" not in text:
            return [(True, text)]
        head, *rest = text.split("$")
        pieces = [(True, head)] if head else []
        for piece in rest:
            known = max((n for n in self.columns if piece.startswith(n)), key=len, default=None)
            if known is not None:
                self.used[known] = None
                pieces.append((False, known))
                piece = piece[len(known) :]
            else:
                word = re.match(f"{_NAME}*", piece)[0]
                if word:
                    raise SeriesError(f"unresolved parameter ${word}")
                piece = "$" + piece
            if piece:
                pieces.append((True, piece))
        return pieces

    def _spliced(self, name: str) -> Column:
        column, slot = self.columns[name]
        if slot == "f":
            return general_double(column.cast("double"))
        return F.when(column, "true").when(~column, "false") if slot == "b" else column.cast("string")

    def field(self, slots) -> Column:
        text = slots["s"]
        if text is not None and self.columns:
            whole = re.fullmatch(rf"\$({_NAME}+)", text)
            if whole:
                if whole[1] not in self.slots:
                    raise SeriesError(f"parameter ${whole[1]} not found")
                self.used[whole[1]] = None
                return self.slots[whole[1]]
            if "$" in text:
                return string_slot(self.text(text))
        slot = next(s for s in SLOTS if slots[s] is not None)
        return slot_value(slot, F.lit(str(slots[slot])) if slot == "u" else F.lit(slots[slot]))

    def point(self, measurement: str, tags: Mapping[str, str], fields: Mapping, time_ns: int | None) -> Column:
        self.used = {}
        name = self.text(measurement)
        tag_map = self._map([(k, self.text(v)) for k, v in tags.items()], TAGS_TYPE)
        field_map = self._map([(k, self.field(v)) for k, v in fields.items()], FIELDS_TYPE)
        missing = [F.when(self.columns[n][0].isNull(), F.lit("$" + n)) for n in self.used]
        return F.struct(
            name.alias("measurement"),
            tag_map.alias("tags"),
            field_map.alias("fields"),
            F.lit(time_ns).cast("bigint").alias(TIME_NS),
            F.array_compact(F.array(*missing).cast(_NO_NAMES)).alias(UNRESOLVED),
        )

    def _map(self, items: list[tuple[str, Column]], data_type) -> Column:
        if not items:
            return F.map_from_arrays(F.array().cast(_NO_NAMES), F.array().cast(_NO_NAMES)).cast(data_type)
        if any("$" in k for k, _ in items) and self.columns:
            # Bound keys may meet, and may be null where a parameter is.
            keys = F.array(*(F.coalesce(self.text(k), F.lit(k)) for k, _ in items))
            return entries_map(keys, F.array(*(v for _, v in items))).cast(data_type)
        return F.create_map(*(x for k, v in items for x in (F.lit(k), v))).cast(data_type)
