"""The source contract as one DataFrame job: cells → typed columns plus the first broken rule."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from changefold.errors import MISSING_COLUMNS, NO_HEADER, SourceDataError
from changefold.functions import text
from changefold.operators.window import late_enough_day
from changefold.spec import KIND_TYPES, MONEY, TableSpec

ERROR = "error"

_PARSERS = {
    "text": text.parse_text,
    "timestamp": text.parse_timestamp,
    "sequence": text.parse_sequence,
    "money": text.parse_money,
    "flag": text.parse_flag,
}


def require_columns(spec: TableSpec, names: list[str]) -> None:
    """Header contract: every contract column is there, others may be."""
    if not names:
        raise SourceDataError(NO_HEADER)
    missing = sorted(set(spec.kinds) - set(names))
    if missing:
        raise SourceDataError(MISSING_COLUMNS + ", ".join(missing))


def _rule(name: str, kind: str, data_type: T.DataType) -> text.Parse:
    """How to get one column's value and error; a column that is already typed is not parsed again."""
    cell = F.col(name)
    blank = (cell.isNull(), text.BLANK.format(name))
    if kind == "timestamp" and isinstance(data_type, T.TimestampNTZType):
        raise SourceDataError(text.NOT_AN_INSTANT.format(name))
    if kind == "money" and isinstance(data_type, T.DecimalType):
        value = cell.try_cast(MONEY)
        error = text.first_error(
            blank,
            (value.isNull() | (cell < 0), text.UNFIT.format(name)),
            (value != cell, text.TOO_FINE.format(name)),
        )
        return text.Parse((), value, error)
    if kind == "sequence" and isinstance(data_type, T.IntegralType):
        error = text.first_error(blank, (cell < 0, text.NEGATIVE.format(name)))
        return text.Parse((), cell.cast("bigint"), error)
    if kind in ("timestamp", "flag") and data_type == KIND_TYPES[kind]:
        return text.Parse((), cell, text.first_error(blank))
    return _PARSERS[kind](cell if isinstance(data_type, T.StringType) else cell.cast("string"), name)


def validate(
    rows: DataFrame,
    spec: TableSpec,
    extraction_start: datetime | Column | None = None,
    latest_allowed: datetime | Column | None = None,
) -> DataFrame:
    """Rows in the window, typed, with ``error`` = first broken rule or null.

    The event time is parsed on every row, so a bad one is an error wherever it stands; the
    other columns of a row before the window are never looked at. Extra columns are kept. A history
    that has the spec's ``event_day`` is read from the window's first day on, rows without a day in any case.
    """
    columns = rows.columns
    require_columns(spec, columns)
    types = {field.name: field.dataType for field in rows.schema}
    rules = {name: _rule(name, kind, types[name]) for name, kind in spec.contract}
    time = rules.pop(spec.event_time)

    if extraction_start is not None and spec.event_day in columns:
        rows = rows.filter(late_enough_day(spec.event_day, _instant(extraction_start)))
    rows = text.run_steps(rows, [time])
    if extraction_start is not None:
        late_enough = time.value >= _instant(extraction_start)
        # About a stored event time this reaches a Parquet scan; a parsed one is parsed before.
        rows = rows.filter(time.value.isNull() | late_enough)
    rows = text.run_steps(rows, list(rules.values()))

    errors = [time.error]
    if latest_allowed is not None:
        too_late = (time.value > _instant(latest_allowed), text.TOO_LATE.format(spec.event_time))
        errors.append(text.first_error(too_late))
    errors += [rule.error for rule in rules.values()]

    extra = [F.col(name) for name in columns if name not in spec.kinds]
    typed = [
        rule.value.cast(KIND_TYPES[spec.kinds[name]]).alias(name)
        for name, rule in {spec.event_time: time, **rules}.items()
    ]
    return rows.select(*extra, *typed, text.computed_once(F.coalesce(*errors)).alias(ERROR))


def _instant(value: datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def clean(validated: DataFrame) -> DataFrame:
    """Typed rows that keep the contract."""
    return validated.filter(F.col(ERROR).isNull()).drop(ERROR)


def gate(validated: DataFrame, *identity: str) -> DataFrame:
    """One row: rows seen, rows in error, and the smallest (identity, error) among them."""
    offender = F.struct(*(F.col(name) for name in identity), F.col(ERROR))
    bad = F.col(ERROR).isNotNull()
    return validated.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(bad).alias("rows_in_error"),
        F.min(F.when(bad, offender)).alias("first_offender"),
    ).select("rows_checked", "rows_in_error", "first_offender.*")
