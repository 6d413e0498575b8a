"""``python -m checks.compare [sf_dir] [query ...]``: every query against its SQL in DuckDB."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

from changefold.session import build_session
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

DEFAULT_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _row(values) -> tuple:
    return tuple(float(v) if isinstance(v, Decimal) else v for v in values)


def differences(spark, sf_dir: str, name: str, connection: duckdb.DuckDBPyConnection) -> tuple[int, list[str]]:
    """(rows, what differs) for one query; columns are compared by name, rows as a multiset."""
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    rows = Counter(_row(row) for row in found.select(*columns).collect())
    wanted = connection.sql(ORACLE_SQL[name])
    if sorted(wanted.columns) != columns:
        return 0, [f"columns {columns} differ from {sorted(wanted.columns)}"]
    order = [wanted.columns.index(c) for c in columns]
    expected = Counter(_row(row[i] for i in order) for row in wanted.fetchall())
    problems = []
    if rows != expected:
        problems = [
            f"only in Spark: {list((rows - expected).items())[:2]}",
            f"only in SQL: {list((expected - rows).items())[:2]}",
        ]
    return rows.total(), problems


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else DEFAULT_DIR
    spark = build_session(
        "compare", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in argv[1:] or QUERIES:
        started = time.time()
        try:
            n_rows, problems = differences(spark, sf_dir, name, connection)
        except Exception as error:
            n_rows, problems = 0, [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok':5}{name:24}{n_rows:8} rows {time.time() - started:7.2f} s", *problems)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
