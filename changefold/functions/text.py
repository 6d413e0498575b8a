"""Text cell → typed value, as column expressions.

A parser works in steps: each step adds helper columns that the next ones refer to by name, so
that no expression is written into the plan twice. Its last columns are the value and the text of
the first broken rule, null when none is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from changefold.spec import MONEY

# The characters that count as white space around a cell.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What a run record says about a broken rule.
BLANK = "{} must not be blank"
NOT_AN_INSTANT = "{} must be a timezone-aware timestamp"
TOO_LATE = "{} exceeds allowed future skew"
NOT_AN_INTEGER = "{} must be an integer"
NEGATIVE = "{} must be non-negative"
NOT_A_DECIMAL = "{} must be a decimal"
UNFIT = "{} must fit decimal(18, 2) and be non-negative"
TOO_FINE = "{} must have at most two decimal places"
NOT_A_FLAG = "{} must be either true or false"

# Fixed value: the largest amount.
LARGEST_AMOUNT = "9999999999999999.99"

# ISO-8601 with a mandatory offset. The first form is what Spark's own cast reads.
_TIMESTAMP_PLAIN = r"^(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
# Separators must be used throughout the date, the time and the offset, or not at all in each.
_TIMESTAMP_SHAPE = (
    r"^(?!0000)(\d{4}-\d{2}-\d{2}|\d{8})[T ](\d{2}|\d{2}:\d{2}|\d{2}:\d{2}:\d{2}(\.\d+)?|\d{4}|\d{6}(\.\d+)?)"
    r"(Z|[+-](\d{2}|\d{4}|\d{2}:\d{2}))$"
)
# What turns the other forms into the first one, in this order.
_TIMESTAMP_REWRITES = [
    (r"^(\d{4})(\d{2})(\d{2})(?=[T ])", "$1-$2-$3"),
    (r"(?<=[T ]\d{2})(?=[Z+-])", ":00:00"),
    (r"(?<=[T ]\d{2}):?(\d{2})(?=[Z+-])", ":$1:00"),
    (r"(?<=[T ]\d{2})(\d{2})(\d{2})", ":$1:$2"),
    (r"([+-]\d{2}):?(\d{2})?$", "$1:$2"),
    (r"(?<=[+-]\d{2}:)$", "00"),
]
_INTEGER = r"^[+-]?\d+(_\d+)*$"
_MONEY_PLAIN = r"^\+?\d{1,16}(\.\d{0,2}0*)?$"
_DECIMAL = r"^[+-]?(?=\.?\d)\d*\.?\d*([eE][+-]?\d+)?$"
_NOT_FINITE = r"^(?i)[+-]?(inf|infinity|s?nan\d*)$"


@dataclass(frozen=True)
class Parse:
    """Steps of helper columns, then the value and the error."""

    steps: tuple[dict[str, Column], ...]
    value: Column
    error: Column


def run_steps(rows: DataFrame, parses: list[Parse]) -> DataFrame:
    """Adds the helper columns of all parses, the same step of each at once."""
    for depth in range(max((len(parse.steps) for parse in parses), default=0)):
        added = {k: v for parse in parses if depth < len(parse.steps) for k, v in parse.steps[depth].items()}
        rows = rows.withColumns(added)
    return rows


def computed_once(value: Column) -> Column:
    """The same value, kept where it is.

    Catalyst copies an expression into every filter above it, unless it depends on the partition
    it runs in.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def strip(cell: Column) -> Column:
    """Trim Unicode white space at both ends.

    Looking for all kinds of it is slow, so it is done only where space alone does not lead to
    printable ASCII at both ends.
    """
    text = F.trim(cell)
    last = F.substring(text, -1, 1)
    done = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(done, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def first_error(*checks: tuple[Column, str]) -> Column:
    """Text of the first check that holds, else null."""
    return F.coalesce(*(F.when(broken, F.lit(text)) for broken, text in checks))


def _helper(name: str) -> Callable[[str], str]:
    return lambda part: f"__{name}_{part}"


def _blank(text: Column, name: str) -> tuple[Column, str]:
    return text.isNull() | (text == ""), BLANK.format(name)


def parse_text(cell: Column, name: str) -> Parse:
    h = _helper(name)
    text = F.col(h("text"))
    return Parse(({h("text"): strip(cell)},), text, first_error(_blank(text, name)))


def parse_timestamp(cell: Column, name: str) -> Parse:
    """Instant of ISO-8601 text that carries an offset. Naive text is an error."""
    h = _helper(name)
    text, plain, value = (F.col(h(part)) for part in ("text", "plain", "value"))

    rewritten = reduce(lambda t, change: F.regexp_replace(t, *change), _TIMESTAMP_REWRITES, text)
    readable = F.when(plain, text).when(text.rlike(_TIMESTAMP_SHAPE), rewritten)
    steps = (
        {h("text"): strip(cell)},
        {h("plain"): text.rlike(_TIMESTAMP_PLAIN)},
        {h("value"): computed_once(readable.try_cast("timestamp"))},
    )
    error = first_error(_blank(text, name), (value.isNull(), NOT_AN_INSTANT.format(name)))
    return Parse(steps, value, error)


def parse_sequence(cell: Column, name: str) -> Parse:
    """Integer of at least 0."""
    h = _helper(name)
    text, value = F.col(h("text")), F.col(h("value"))
    digits = F.replace(text, F.lit("_"), F.lit(""))
    steps = (
        {h("text"): strip(cell)},
        {h("value"): F.when(text.rlike(_INTEGER), digits.try_cast("bigint"))},
    )
    error = first_error(
        _blank(text, name),
        (value.isNull(), NOT_AN_INTEGER.format(name)),
        (value < 0, NEGATIVE.format(name)),
    )
    return Parse(steps, value, error)


def parse_money(cell: Column, name: str) -> Parse:
    """decimal(18, 2) of at least 0 whose text is exact at two decimals.

    Casting rounds, so text that is no plain amount is read with 18 decimals and its digits are
    counted. With up to 17 significant digits nothing can hide behind the 18th decimal of an
    amount that is whole in cents; 18 digits fit only the largest amounts, more fit none.
    """
    h = _helper(name)
    text, plain, wide, digits, value = (F.col(h(part)) for part in ("text", "plain", "wide", "digits", "value"))
    number = F.replace(text, F.lit("_"), F.lit(""))
    significant = F.btrim(F.regexp_replace(text, r"[+._-]|[eE].*$", ""), F.lit("0"))
    whole_cents = (wide == wide.try_cast(MONEY)) & (
        (digits == 0) | ((digits <= 17) & (wide != 0)) | ((digits == 18) & (wide >= 10**15))
    )
    steps = (
        {h("text"): strip(cell)},
        {h("plain"): text.rlike(_MONEY_PLAIN)},
        {
            h("wide"): F.when(~plain & number.rlike(_DECIMAL), number.try_cast("decimal(38,18)")),
            h("digits"): F.when(~plain, F.length(significant)),
        },
        {h("value"): F.when(plain, text.try_cast(MONEY)).when((wide >= 0) & whole_cents, wide.cast(MONEY))},
    )
    # Without a wide value the number is too large, or its exponent too low for any decimal.
    limit = F.lit(LARGEST_AMOUNT).cast("decimal(38,18)")
    too_large = F.coalesce(wide > limit, ~number.rlike(r"[eE]-\d{9,}$"))
    negative = text.startswith("-") & (digits > 0)
    error = F.when(value.isNull(), first_error(
        _blank(text, name),
        (number.rlike(_NOT_FINITE), UNFIT.format(name)),
        (~number.rlike(_DECIMAL), NOT_A_DECIMAL.format(name)),
        (negative | too_large, UNFIT.format(name)),
        (F.lit(True), TOO_FINE.format(name)),
    ))
    return Parse(steps, value, error)


def parse_flag(cell: Column, name: str) -> Parse:
    """``true`` or ``false`` in any case; Spark's own cast would accept more."""
    h = _helper(name)
    text, value = F.col(h("text")), F.col(h("value"))
    steps = (
        {h("text"): F.lower(strip(cell))},
        {h("value"): F.when(text == "true", True).when(text == "false", False)},
    )
    error = first_error(
        (text.isNull(), BLANK.format(name)),
        (value.isNull(), NOT_A_FLAG.format(name)),
    )
    return Parse(steps, value, error)


def parse_column(rows: DataFrame, name: str, parse: Callable[[Column, str], Parse]) -> DataFrame:
    """Rows with column ``name`` parsed, null where it is in error, and an ``error`` column."""
    parsed = parse(F.col(name), name)
    value = F.when(parsed.error.isNull(), parsed.value).alias(name)
    others = [column for column in rows.columns if column != name]
    return run_steps(rows, [parsed]).select(*others, value, parsed.error.alias("error"))
