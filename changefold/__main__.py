"""``python -m changefold``: run one load of a CSV product history and print its result."""

from __future__ import annotations

import argparse
import re
import sys
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from changefold.plans.load import LoadParams, result_document, run_load
from changefold.plans.store import TargetStore
from changefold.session import build_session
from changefold.sources.history import read_csv_history
from changefold.spec import PRODUCTS


def offset_time(text: str) -> datetime:
    """A time with its offset from UTC."""
    when = datetime.fromisoformat(text)
    if not when.tzinfo:
        raise ValueError(f"{text} has no offset from UTC")
    return when


def duration_in(unit: str) -> Callable[[str], timedelta]:
    """Reader of plain decimal numbers of a unit; no sign, no exponent, nothing infinite."""

    def duration(text: str) -> timedelta:
        if not re.fullmatch(r"\d+(\.\d*)?|\.\d+", text, re.ASCII):
            raise ValueError(f"{text} is no number of {unit}")
        return timedelta(**{unit: float(text)})

    duration.__name__ = f"number of {unit}"
    return duration


@dataclass(frozen=True)
class Option:
    """An option that sets one field of the load's parameters; without a default it must be given."""

    flag: str
    field: str
    reads: Callable
    help: str = ""
    default: str | None = None


# Names and defaults of the options.
OPTIONS = (
    Option("--pipeline-name", "pipeline_name", str, default="products"),
    Option("--initial-start-at", "initial_start_at", offset_time, "first event time to load while there is no mark"),
    Option("--overlap-hours", "overlap", duration_in("hours"), "read again before the mark", "24"),
    Option("--allowed-future-skew-minutes", "allowed_future_skew", duration_in("minutes"), default="5"),
)


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="changefold", description=__doc__)
    options.add_argument("--source", required=True, help="CSV file or folder of CSV files")
    options.add_argument("--store", required=True, help="folder of the target, its state and its runs")
    options.add_argument("--buckets", type=int, help="bucket count of a new store; else its first load decides")
    options.add_argument("--line-rows", action="store_true", help="every line is a row, so that large files are split")
    for o in OPTIONS:
        options.add_argument(o.flag, dest=o.field, type=o.reads, default=o.default, required=o.default is None, help=o.help)
    return options


def main(argv: list[str] | None = None) -> int:
    given = vars(parser().parse_args(argv))
    params = LoadParams(**{o.field: given[o.field] for o in OPTIONS})
    store = TargetStore(build_session(), given["store"], PRODUCTS, given["buckets"])
    try:
        document = load_and_describe(store, given["source"], params, multiline=not given["line_rows"])
    except Exception as problem:
        print(type(problem).__name__, problem, sep=": ", file=sys.stderr)
        return 1
    print(document)
    return 0


def load_and_describe(store: TargetStore, source: str, params: LoadParams, multiline: bool = True) -> str:
    """The result document of one load."""
    result = run_load(lambda: read_csv_history(store.spark, source, multiline), store, params)
    try:
        digest = store.checksum().first()["state_checksum"]
    finally:
        store.forget_tables()
    return result_document(result.as_frame(store.spark), digest, pretty=True).first()[0]


if __name__ == "__main__":
    sys.exit(main())
