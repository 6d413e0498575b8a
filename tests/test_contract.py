"""Source contract: how cells are read and which rule a row breaks first."""

from datetime import UTC, datetime, timedelta
from decimal import Decimal

import pytest

from changefold import PRODUCTS, SourceDataError, read_csv_history
from changefold.functions.text import parse_column, parse_flag, parse_money, parse_sequence, parse_timestamp, strip
from changefold.operators.contract import clean, gate, require_columns, validate
from tests.products import HEADER, fragment

START = datetime(2026, 1, 1, tzinfo=UTC)
RUN_START = datetime(2026, 1, 2, tzinfo=UTC)
GOOD = ("k-1", "10:00", "1", "Viola", "Strings", "410.75", "true")


def changed(**cells):
    names = [part.split()[0] for part in HEADER.split(", ")]
    return tuple(cells.get(name, value) for name, value in zip(names, GOOD, strict=True))


def errors(spark, *rows, start=START, latest=RUN_START + timedelta(minutes=5)):
    return [r.error for r in validate(fragment(spark, rows), PRODUCTS, start, latest).collect()]


def read_cells(spark, parse, cells):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, x string")
    return [(r.x, r.error) for r in parse_column(rows, "x", parse).orderBy("i").collect()]


TIMESTAMPS = {
    "2026-01-01T10:00:00Z": "2026-01-01T10:00:00+00:00",
    "2026-01-03T15:45:00+05:30": "2026-01-03T10:15:00+00:00",
    " \t2026-01-01 10:00:00-01:30 ": "2026-01-01T11:30:00+00:00",
    "20260101T100000Z": "2026-01-01T10:00:00+00:00",
    "2026-01-01T10Z": "2026-01-01T10:00:00+00:00",
    "2026-01-01T10:05Z": "2026-01-01T10:05:00+00:00",
    "2026-01-01 10:00+02": "2026-01-01T08:00:00+00:00",
    "2026-01-01T100000.25+0200": "2026-01-01T08:00:00.250000+00:00",
    "2026-01-01T10:00:00.1234567Z": "2026-01-01T10:00:00.123456+00:00",
    "2026-01-01T10:00:00.5Z": "2026-01-01T10:00:00.500000+00:00",
}
BAD_TIMESTAMPS = [
    "2026-01-01T10:00:00", "2026-01-01", "now", "not-a-date", "2026-01-01T10:00:00 UTC", "2026-1-1T10:00:00Z",
    "2026-02-30T10:00:00Z", "2026-01-01T25:00:00Z", "2026-0101T10:00:00Z", "0000-01-01T00:00:00Z",
    "2026-01-01T10:00:00+2:00", "1767261600",
]


def test_timestamps(spark):
    found = read_cells(spark, parse_timestamp, TIMESTAMPS)
    assert [v.astimezone(UTC).isoformat() for v, _ in found] == list(TIMESTAMPS.values())
    assert all(error is None for _, error in found)
    rejected = read_cells(spark, parse_timestamp, BAD_TIMESTAMPS)
    assert rejected == [(None, "x must be a timezone-aware timestamp")] * len(BAD_TIMESTAMPS)
    assert read_cells(spark, parse_timestamp, [None, " "]) == [(None, "x must not be blank")] * 2


def test_sequences(spark):
    found = read_cells(spark, parse_sequence, ["0", " +5\t", "1_000", "007", "9223372036854775807"])
    assert found == [(n, None) for n in (0, 5, 1000, 7, 2**63 - 1)]
    rejected = read_cells(spark, parse_sequence, ["1.0", "x", "1__0", "_1", "1e2", "-1", None])
    assert [error for _, error in rejected] == ["x must be an integer"] * 5 + [
        "x must be non-negative",
        "x must not be blank",
    ]


AMOUNTS = {
    "47.5": "47.50", "47.50": "47.50", "0": "0.00", "-0.00": "0.00", "+5": "5.00", ".5": "0.50", "5.": "5.00",
    "1e2": "100.00", "1.5E+1": "15.00", "12345e-2": "123.45", "1_000.25": "1000.25", " 7 ": "7.00",
    "9999999999999999.99": "9999999999999999.99", "99999999999999999900E-4": "9999999999999999.99",
    "1.10000000000000000000000000000000000000": "1.10", "0e-40": "0.00", "000000000000000000012": "12.00",
    "100000000000000000000e-19": "10.00", "1234567890123456.78e0": "1234567890123456.78",
}
UNFIT = "x must fit decimal(18, 2) and be non-negative"
TOO_FINE = "x must have at most two decimal places"
BAD_AMOUNTS = {
    "": "x must not be blank", "-0.01": UNFIT, "-1e-30": UNFIT, "NaN": UNFIT, "-Infinity": UNFIT, "inf": UNFIT,
    "10000000000000000": UNFIT, "1e50": UNFIT, "1e99999999999": UNFIT, "99999999999999999.999": UNFIT,
    "0.001": TOO_FINE, "1e-3": TOO_FINE, "1e-30": TOO_FINE, "1e-99999999999": TOO_FINE,
    "1.0000000000000000000000000000001": TOO_FINE, "1.00000000000000001e-2": TOO_FINE,
    "1.0000000000000000001": TOO_FINE, "abc": "x must be a decimal", "1,5": "x must be a decimal",
    ".": "x must be a decimal", "1e": "x must be a decimal", "0x10": "x must be a decimal",
}


def test_amounts(spark):
    assert read_cells(spark, parse_money, AMOUNTS) == [(Decimal(v), None) for v in AMOUNTS.values()]
    assert read_cells(spark, parse_money, BAD_AMOUNTS) == [(None, v) for v in BAD_AMOUNTS.values()]


def test_flags(spark):
    found = read_cells(spark, parse_flag, ["true", " TRUE ", "False", "yes", "t", "1", "", None])
    assert [value for value, _ in found] == [True, True, False] + [None] * 5
    either = "x must be either true or false"
    assert [error for _, error in found] == [None] * 3 + [either] * 4 + ["x must not be blank"]


def test_strip_takes_all_white_space(spark):
    padded = "".join(c for c in map(chr, range(0x110000)) if c.isspace() and not 0xD800 <= ord(c) < 0xE000)
    row = spark.createDataFrame([(padded + "a b" + padded,)], "x string").select(strip("x")).first()
    assert row[0] == "a b"


def test_first_broken_rule_wins(spark):
    worst = dict(product_id=" ", source_sequence="-1", name="", category="\t", price="x", is_active="yes")
    assert errors(spark, changed(updated_at="2026-01-01T10:00", **worst)) == [
        "updated_at must be a timezone-aware timestamp"
    ]
    assert errors(spark, changed(updated_at="2099-01-01T00:00:00Z", **worst)) == [
        "updated_at exceeds allowed future skew"
    ]
    expected = {
        "product_id": "product_id must not be blank",
        "name": "name must not be blank",
        "category": "category must not be blank",
        "source_sequence": "source_sequence must be non-negative",
        "price": "price must be a decimal",
        "is_active": "is_active must be either true or false",
    }
    for column, error in expected.items():
        assert errors(spark, changed(**worst)) == [error]
        del worst[column]
    assert errors(spark, GOOD) == [None]


def test_window_and_future_bound(spark):
    bound = "2026-01-01T12:00:00Z"
    rows = [
        changed(updated_at="2026-01-01T11:59:59.999999Z", price="junk", product_id=""),
        changed(updated_at=bound),
        changed(updated_at="2026-01-02T00:05:00Z"),
        changed(updated_at="2026-01-02T00:05:00.000001Z"),
        changed(updated_at="junk", price="junk"),
    ]
    found = errors(spark, *rows, start=datetime(2026, 1, 1, 12, tzinfo=UTC))
    assert found == [
        None,
        None,
        "updated_at exceeds allowed future skew",
        "updated_at must be a timezone-aware timestamp",
    ]


def test_clean_rows_are_normalised(spark):
    row = clean(
        validate(
            fragment(spark, [("\tk 2 ", "2024-05-31T23:30:00-03:30", "7 ", "\u3000Bass drum\n", " Perc ussion", "12.5", "fAlSe")]),
            PRODUCTS,
        )
    ).first()
    assert (row.product_id, row.source_sequence, row.name, row.category) == ("k 2", 7, "Bass drum", "Perc ussion")
    assert (row.updated_at.astimezone(UTC), row.price, row.is_active) == (
        datetime(2024, 6, 1, 3, tzinfo=UTC), Decimal("12.50"), False,
    )


def test_gate_counts_and_names_one_offender(spark):
    rows = fragment(spark, [GOOD, changed(product_id="P3", price="x"), changed(product_id="P2", is_active="")])
    row = gate(validate(rows, PRODUCTS), "product_id").first()
    assert row.asDict() == {
        "rows_checked": 3, "rows_in_error": 2, "product_id": "P2", "error": "is_active must be either true or false",
    }


def test_typed_columns_are_checked_too(spark):
    rows = spark.createDataFrame(
        [
            (" A ", datetime(2026, 1, 1, tzinfo=UTC), 1, "n", "c", Decimal("1.230"), True),
            ("B", None, 1, "n", "c", Decimal("1"), True),
            ("C", datetime(2026, 1, 1, tzinfo=UTC), -1, "n", "c", Decimal("1"), True),
            ("D", datetime(2026, 1, 1, tzinfo=UTC), 1, " ", "c", Decimal("1"), True),
            ("E", datetime(2026, 1, 1, tzinfo=UTC), 1, "n", "c", Decimal("1.001"), True),
            ("F", datetime(2026, 1, 1, tzinfo=UTC), 1, "n", "c", Decimal("-1"), True),
            ("G", datetime(2026, 1, 1, tzinfo=UTC), 1, "n", "c", Decimal("1"), None),
            ("H", datetime(2025, 1, 1, tzinfo=UTC), -1, "n", "c", None, None),
        ],
        "product_id string, updated_at timestamp, source_sequence int, name string, category string, "
        "price decimal(20,3), is_active boolean",
    )
    found = {r.product_id: r.error for r in validate(rows, PRODUCTS, START).collect()}
    assert found == {
        "A": None,
        "B": "updated_at must not be blank",
        "C": "source_sequence must be non-negative",
        "D": "name must not be blank",
        "E": "price must have at most two decimal places",
        "F": "price must fit decimal(18, 2) and be non-negative",
        "G": "is_active must not be blank",
    }


def test_bound_of_a_typed_history_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "typed")
    clean(validate(fragment(spark, [GOOD]), PRODUCTS)).write.parquet(path)
    validated = validate(spark.read.parquet(path), PRODUCTS, START)
    plan = validated._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(updated_at),GreaterThanOrEqual(updated_at," in plan


def test_header(spark, tmp_path):
    with pytest.raises(SourceDataError, match="missing required columns: category, price"):
        require_columns(PRODUCTS, ["product_id", "updated_at", "source_sequence", "name", "is_active", "more"])
    with pytest.raises(SourceDataError, match="header row"):
        require_columns(PRODUCTS, [])
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    with pytest.raises(SourceDataError, match="header row"):
        validate(read_csv_history(spark, str(empty)), PRODUCTS)
