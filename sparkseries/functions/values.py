"""Field values: typed slots, inference from text, text forms and series keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkseries.model import SLOT_TYPE_NAMES, SLOTS, slot_for

# How the text of a field value names its type.
TRUE_WORDS = ("true", "TRUE", "t", "T")
FALSE_WORDS = ("false", "FALSE", "f", "F")
INTEGER_TEXT = r"^[+-]?[0-9]+[iI]$"
UNSIGNED_TEXT = r"^[0-9]+[uU]$"
UNSIGNED_MAX = 18446744073709551615

# White space that is trimmed around lines and values.
SPACES = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

_DIGITS = "[0-9]++(?:_[0-9]++)*+"
_DECIMAL = rf"(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
_HEX_DIGITS = "[0-9a-fA-F]"
_HEX = rf"0[xX](?:{_HEX_DIGITS}++\.?{_HEX_DIGITS}*+|\.{_HEX_DIGITS}++)[pP][+-]?[0-9]++"
FINITE_TEXT = rf"^[+-]?(?:{_DECIMAL}|{_HEX})$"
INFINITE_TEXT = r"^(?i)[+-]?inf(?:inity)?$"
NAN_TEXT = r"^(?i)nan$"
EXPONENT_TEXT = r"^(-?)([0-9])\.([0-9]+)E(-?[0-9]+)$"


def slot_value(slot: str, value: Column) -> Column:
    """Struct with one slot set."""
    parts = [
        (value if name == slot else F.lit(None)).cast(data_type).alias(name)
        for name, data_type in SLOTS.items()
    ]
    return F.struct(*parts)


def slot_of_column(column: Column, data_type: T.DataType) -> Column:
    """Struct of a typed column, null when the value is null."""
    return F.when(column.isNotNull(), slot_value(slot_for(data_type), column))


def string_slot(text: Column) -> Column:
    return slot_value("s", text)


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def infer_values(items: Column) -> Column:
    """Type an array of ``struct<t: text, q: quoted>`` by the text, giving an array of slot structs.

    The order is integer, unsigned, boolean, float, else string.  Quoted text is
    always a string; a number that does not fit its type stays a string.
    """
    return F.transform(F.transform(items, _kind), lambda c: F.when(c["t"].isNotNull(), _slots(c)))


_S, _F, _I, _U, _B, _INF, _NAN = range(7)


def _kind(item: Column) -> Column:
    """The text with a code for what it looks like; the most common forms are tried first."""
    text = item["t"]
    kind = (
        F.when(item["q"], _S)
        .when(text.rlike(FINITE_TEXT), _F)
        .when(text.rlike(INTEGER_TEXT), _I)
        .when(text.isin(*TRUE_WORDS, *FALSE_WORDS), _B)
        .when(text.rlike(UNSIGNED_TEXT), _U)
        .when(text.rlike(INFINITE_TEXT), _INF)
        .when(text.rlike(NAN_TEXT), _NAN)
        .otherwise(_S)
    )
    return F.struct(text.alias("t"), kind.alias("kind"))


def _slots(c: Column) -> Column:
    text, kind = c["t"], c["kind"]
    body = F.substring(text, F.lit(1), F.length(text) - 1)
    finite = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    infinite = F.when(text.startswith("-"), float("-inf")).otherwise(float("inf"))
    largest = F.lit(str(UNSIGNED_MAX)).cast("decimal(20,0)")
    # Digits that do not fit the number type leave the text a string.
    overflow = (
        F.when(kind == _I, (F.length(text) > 18) & body.try_cast("bigint").isNull())
        .when(kind == _U, (F.length(text) > 19) & ~F.coalesce(body.try_cast("decimal(38,0)") <= largest, F.lit(False)))
        .when(kind == _F, F.abs(finite) == float("inf"))
    )
    return F.struct(
        F.when(kind == _I, body.try_cast("bigint")).alias("i"),
        F.when((kind == _U) & ~overflow, body.try_cast("decimal(38,0)")).cast(SLOTS["u"]).alias("u"),
        F.when((kind == _F) & ~overflow, finite).when(kind == _INF, infinite).when(kind == _NAN, float("nan")).alias("f"),
        F.when(F.coalesce(overflow, kind == _S), text).alias("s"),
        F.when(kind == _B, text.isin(*TRUE_WORDS)).alias("b"),
    )


def infer_value(text: Column) -> Column:
    """Type one field value by its text; text in double quotes is a string without its quotes."""

    def split_quotes(value: Column) -> Column:
        quoted = (F.length(value) >= 2) & value.startswith('"') & value.endswith('"')
        inner = F.substring(value, F.lit(2), F.length(value) - 2)
        return F.struct(F.when(quoted, inner).otherwise(value).alias("t"), F.coalesce(quoted, F.lit(False)).alias("q"))

    return F.get(infer_values(F.transform(F.array(trimmed(text)), split_quotes)), F.lit(0))


def value_type(value: Column) -> Column:
    """Type name of a slot struct: integer, unsigned, float, string or boolean."""
    return F.coalesce(
        *(F.when(value[slot].isNotNull(), F.lit(name)) for slot, name in SLOT_TYPE_NAMES.items())
    )


def plain_double(value: Column) -> Column:
    """Shortest decimal text without exponent: 5.0 is ``5``, 1.0E21 has 21 zeros."""

    text = value.cast("string")
    cut = F.split(F.regexp_replace(text, EXPONENT_TEXT, "$1\n$2\n$3\n$4"), "\n")
    return (
        F.when(F.isnan(value), "NaN")
        .when(value == float("inf"), "+Inf")
        .when(value == float("-inf"), "-Inf")
        .when(text.contains("E"), let(cut, _without_exponent))
        .when(text.endswith(".0"), F.substring(text, F.lit(1), F.length(text) - 2))
        .otherwise(text)
    )


def _without_exponent(part: Column) -> Column:
    sign, lead, digits, exponent = (F.get(part, F.lit(i)) for i in range(4))
    exponent = exponent.cast("int")
    fraction = F.regexp_replace(digits, "0+$", "")
    whole = F.concat(lead, F.substring(F.rpad(fraction, exponent, "0"), F.lit(1), exponent))
    rest = F.substring(fraction, exponent + 1, F.length(fraction))
    large = F.when(F.length(fraction) <= exponent, whole).otherwise(F.concat(whole, F.lit("."), rest))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), lead, fraction)
    return F.concat(sign, F.when(exponent < 0, small).otherwise(large))


def value_text(value: Column) -> Column:
    """Text of a slot struct when it is spliced into a name or a longer text."""
    return F.coalesce(
        value["s"],
        value["i"].cast("string"),
        value["u"].cast("string"),
        F.when(value["b"], "true").when(~value["b"], "false"),
        general_double(value["f"]),
    )


def general_double(value: Column) -> Column:
    """Shortest text of a double, with an exponent below 1e-4 and from 1e21 on."""

    def spell(text: Column) -> Column:
        spelled = F.regexp_replace(F.regexp_extract(text, "^(.+)E", 1), r"\.0$", "")
        power = F.regexp_extract(text, "E-?([0-9]+)$", 1)
        sign = F.when(text.contains("E-"), "-").otherwise("+")
        return F.concat(spelled, F.lit("e"), sign, F.when(F.length(power) > 1, power).otherwise(F.lpad(power, 2, "0")))

    size = F.abs(value)
    tiny_or_huge = (size > 0) & (size < 1e-4) | (size >= 1e21) & (size < float("inf"))
    return F.when(tiny_or_huge, let(value.cast("string"), spell)).otherwise(plain_double(value))


# --------------------------------------------------------------------------
# maps


def entries_map(keys: Column, values: Column) -> Column:
    """Map from two arrays; of a repeated key the last value stays."""
    # Only maps with repeated keys pay for the search for the last occurrence.
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    lasting = F.filter(
        pairs,
        lambda pair, i: ~F.array_contains(F.slice(keys, i + 2, F.greatest(F.size(keys) - i - 1, F.lit(0))), pair["k"]),
    )
    deduped = F.map_from_arrays(F.transform(lasting, lambda p: p["k"]), F.transform(lasting, lambda p: p["v"]))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_arrays(keys, values)).otherwise(deduped)


def tag_entries(tags: Column) -> Column:
    """The tags as a sorted array of entries: equal for equal series, whatever their texts hold."""
    return F.array_sort(F.map_entries(tags))


def series_key(measurement: Column, tags: Column) -> Column:
    """``m,k1=v1,k2=v2`` with keys in order; tags that a point lacks are left out.

    Commas, equals signs, spaces and backslashes of names and values are
    escaped by a backslash (of a measurement all but the equals sign), so
    different series have different keys.
    """

    def shown(text: Column) -> Column:
        return F.regexp_replace(text, r"([\\,= ])", r"\\$1")

    pairs = F.transform(tag_entries(tags), lambda e: F.concat(shown(e["key"]), F.lit("="), shown(e["value"])))
    return F.concat_ws(",", F.array_insert(pairs, F.lit(1), F.regexp_replace(measurement, r"([\\, ])", r"\\$1")))
