"""Version history → one newest version per key, with a check for contradictory versions.

Shuffle shape: rows are first counted per (key, version, payload), a hash aggregate on both sides of the
exchange, so that nothing is sorted before rows are collapsed, and a version delivered a million times
is one row per map task before it moves. A key that owns a third of the history is spread over its
versions. From there two ways lead to the keys: versions and counts alone, without payloads, tell the
contradictory versions; the newest version is taken per task before the last exchange, which carries
at most one row per key and task. Both read the first exchange's files, which are written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changefold.sources.history import SOURCE_FILE
from changefold.spec import VersionedTable

COPIES = "copies"
ROWS = "rows_seen"
CONFLICT = "conflict"
FIRST_ERROR = "first_error"


def exact_repeats(rows: DataFrame, table: VersionedTable, *more: str) -> DataFrame:
    """Distinct (key, version, payload) with the number of copies each was delivered in."""
    return rows.groupBy(*table.columns, *more).agg(F.count(F.lit(1)).alias(COPIES))


def contradictory(collapsed: DataFrame, table: VersionedTable, error: str | None = None) -> DataFrame:
    """(key, version) pairs that stand with more than one payload among collapsed rows without an error."""
    # Counted, not filtered: a filter would move below the collapse, which then ran once for each use.
    sound = F.col(error).isNull() if error else F.lit(True)
    versions = collapsed.groupBy(*table.key, *table.version).agg(
        F.count_if(sound).alias("payloads"), F.sum(COPIES).alias(COPIES)
    )
    return versions.where("payloads > 1").select(*table.key, *table.version, COPIES)


def source_conflicts(rows: DataFrame, table: VersionedTable) -> DataFrame:
    """(key, version) pairs that carry more than one payload, whether they would win or not."""
    return contradictory(exact_repeats(rows, table), table)


def newest_per_key(rows: DataFrame, table: VersionedTable) -> DataFrame:
    """Newest version of every key; for histories known to be free of conflicts."""
    newest = F.max(F.struct(table.version_of().alias("v"), table.payload_of().alias("p")))
    return _unpack(rows.groupBy(*table.key).agg(newest.alias("newest")), table)


def fold(validated: DataFrame, table: VersionedTable, error: str | None = None) -> DataFrame:
    """Everything a load needs to know about its window, one row per key.

    Columns: key, newest version, its payload, ``rows_seen``, ``conflict`` = smallest
    contradictory version of the key or null. With ``error`` named, rows in error give up their
    key and come out as the one row with null keys, whose ``first_error`` is set.
    """
    extra = [ROWS, CONFLICT]
    offender, known = [], set(validated.columns)
    if error:
        bad = F.col(error).isNotNull()
        identity = [c for c in (SOURCE_FILE, *table.key, *table.version) if c in known]
        named = F.struct(*(F.col(c).cast("string").alias(c) for c in identity), F.col(error).alias("message"))
        validated = validated.select(
            F.when(bad, named).alias(FIRST_ERROR), *(F.when(~bad, F.col(c)).alias(c) for c in table.columns)
        )
        offender = [FIRST_ERROR]
    collapsed = exact_repeats(validated, table, *offender)
    newest = F.struct(table.version_of().alias("v"), table.payload_of().alias("p"))
    version_type = collapsed.select(table.version_of().alias("v")).schema["v"].dataType
    versions = collapsed.select(
        *table.key, newest.alias("newest"), F.col(COPIES).alias(ROWS), F.lit(None).cast(version_type).alias(CONFLICT), *offender
    )
    clashes = contradictory(collapsed, table, FIRST_ERROR if error else None).select(
        *table.key,
        F.lit(None).cast(versions.schema["newest"].dataType).alias("newest"),
        # The copies were counted among the versions.
        (F.col(COPIES) * 0).alias(ROWS),
        table.version_of().alias(CONFLICT),
        *(F.lit(None).cast(versions.schema[name].dataType).alias(name) for name in offender),
    )
    per_key = versions.unionByName(clashes).groupBy(*table.key).agg(
        F.max("newest").alias("newest"),
        F.sum(ROWS).alias(ROWS),
        F.min(CONFLICT).alias(CONFLICT),
        *(F.min(name).alias(name) for name in offender),
    )
    return _unpack(per_key, table, *extra, *offender)


def _unpack(per_key: DataFrame, table: VersionedTable, *extra: str) -> DataFrame:
    return per_key.select(
        *table.key,
        *(F.col(f"newest.v.{c}").alias(c) for c in table.version),
        *(F.col(f"newest.p.{c}").alias(c) for c in table.payload),
        *extra,
    )
