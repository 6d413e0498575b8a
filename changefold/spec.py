"""What a versioned table looks like: its key, its version order, its payload and its contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

MONEY = T.DecimalType(18, 2)

#: Stored type of every contract kind.
KIND_TYPES: dict[str, T.DataType] = {
    "text": T.StringType(),
    "timestamp": T.TimestampType(),
    "sequence": T.LongType(),
    "money": MONEY,
    "flag": T.BooleanType(),
}


@dataclass(frozen=True)
class VersionedTable:
    """Column roles. ``version`` is compared left to right; its first column is the event time."""

    key: tuple[str, ...]
    version: tuple[str, ...]
    payload: tuple[str, ...]

    @property
    def event_time(self) -> str:
        return self.version[0]

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.key, *self.version, *self.payload)

    def version_of(self, side: str | None = None) -> Column:
        return _struct(self.version, side)

    def payload_of(self, side: str | None = None) -> Column:
        return _struct(self.payload, side)


def _struct(names: tuple[str, ...], side: str | None) -> Column:
    prefix = f"{side}." if side else ""
    return F.struct(*(F.col(prefix + name).alias(name) for name in names))


@dataclass(frozen=True)
class TableSpec(VersionedTable):
    """A versioned table with a declared source contract.

    ``contract`` lists (column, kind) in the order in which a row's columns are checked;
    the event time is always checked before any of them. ``event_day`` names a column that a history
    may have: the UTC date of the event time, by which its folders are partitioned.
    """

    contract: tuple[tuple[str, str], ...] = ()
    event_day: str = "event_day"

    @property
    def kinds(self) -> dict[str, str]:
        return dict(self.contract)

    @property
    def business_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, KIND_TYPES[self.kinds[c]]) for c in self.columns])

    @property
    def target_schema(self) -> T.StructType:
        return T.StructType([*self.business_schema.fields, *LOAD_STAMP.fields])


#: Operational columns that every written target row carries.
LOAD_STAMP = T.StructType(
    [
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("last_run_id", T.StringType()),
    ]
)

STATE_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("watermark", T.TimestampType()),
        T.StructField("last_successful_run_id", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

COUNTERS = (
    "rows_received",
    "rows_after_deduplication",
    "rows_inserted",
    "rows_updated",
    "rows_ignored",
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("previous_watermark", T.TimestampType()),
        T.StructField("resulting_watermark", T.TimestampType()),
        *(T.StructField(name, T.LongType()) for name in COUNTERS),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

SUCCESS = "SUCCESS"
FAILED = "FAILED"

#: The product table: current product rows keyed by product_id.
PRODUCTS = TableSpec(
    key=("product_id",),
    version=("updated_at", "source_sequence"),
    payload=("name", "category", "price", "is_active"),
    contract=(
        ("updated_at", "timestamp"),
        ("product_id", "text"),
        ("name", "text"),
        ("category", "text"),
        ("source_sequence", "sequence"),
        ("price", "money"),
        ("is_active", "flag"),
    ),
)
