"""Canonical text of values: the byte contract of state lines and result documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F, types as T

# JSON's short escapes, backslash first so that later ones are not escaped again.
_SHORT_ESCAPES = [
    ("\\", "\\\\"),
    ('"', '\\"'),
    ("\b", "\\b"),
    ("\f", "\\f"),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
]
_SHORT = {raw for raw, _ in _SHORT_ESCAPES}
_CONTROL_ESCAPES = [(chr(i), f"\\u{i:04x}") for i in range(0x20) if chr(i) not in _SHORT]


def json_string(text: Column) -> Column:
    """JSON string literal with non-ASCII text kept as it is."""

    def escaped(pairs: list[tuple[str, str]], col: Column) -> Column:
        return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, col)

    # Nearly all text needs no escaping, and rare control characters need the longer chain.
    body = (
        F.when(~text.rlike(r'[\x00-\x1f"\\]'), text)
        .when(~text.rlike(r"[\x00-\x07\x0b\x0e-\x1f]"), escaped(_SHORT_ESCAPES, text))
        .otherwise(escaped(_SHORT_ESCAPES + _CONTROL_ESCAPES, text))
    )
    return F.concat(F.lit('"'), body, F.lit('"'))


def instant_micros(ts: Column) -> Column:
    """UTC text with six fraction digits, as state lines carry it."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def instant_iso(ts: Column) -> Column:
    """UTC text whose fraction is left out when zero, as result documents carry it."""
    whole = F.date_trunc("second", ts) == ts
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(instant_micros(ts))


def json_value(column: Column, data_type: T.DataType) -> Column:
    """JSON value of one business column; null stays the literal ``null``.

    Decimals keep the digits of their type, floating-point numbers are written as Spark writes them.
    Binary and nested columns, and others without an agreed text, are refused.
    """
    if isinstance(data_type, T.TimestampType):
        value = _quoted(instant_micros(column))
    elif isinstance(data_type, T.TimestampNTZType):
        value = _quoted(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    elif isinstance(data_type, (T.DecimalType, T.DateType)):
        value = _quoted(column.cast("string"))
    elif isinstance(data_type, T.StringType):
        value = json_string(column)
    elif isinstance(data_type, (T.IntegralType, T.BooleanType, T.FractionalType)):
        value = column.cast("string")
    else:
        raise TypeError(f"no canonical text for {data_type.simpleString()}")
    return F.coalesce(value, F.lit("null"))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def json_line(fields: list[T.StructField], values: list[Column] | None = None) -> Column:
    """Compact JSON object of the given columns in the given order, ended by a newline.

    ``values`` are what to write for the fields, where they are not the columns of those names.
    """
    parts: list[Column] = []
    for position, field in enumerate(fields):
        opening = "{" if position == 0 else ","
        value = values[position] if values else F.col(field.name)
        parts += [F.lit(f'{opening}"{field.name}":'), json_value(value, field.dataType)]
    return F.concat(*parts, F.lit("}\n"))
