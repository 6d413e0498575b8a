"""Applying classified winners to the target as whole-table expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from changefold.operators.classify import INSERT, OUTCOME, UPDATE, held_name
from changefold.spec import LOAD_STAMP, VersionedTable


def changes(classified: DataFrame, table: VersionedTable, loaded_at: Column, run_id: Column) -> DataFrame:
    """Rows to write: inserts and updates, stamped with the load that writes them."""
    return classified.filter(is_change()).select(
        *table.columns,
        loaded_at.cast("timestamp").alias("loaded_at"),
        run_id.cast("string").alias("last_run_id"),
    )


def is_change() -> Column:
    """Whether a classified row is to be written."""
    return F.coalesce(F.col(OUTCOME).isin(INSERT, UPDATE), F.lit(False))


def written(met: DataFrame, table: VersionedTable, loaded_at: Column, run_id: Column, kept: Column, *more: Column) -> DataFrame:
    """Rows to write, out of winners that met the target: changes, stamped, and the target rows that are to be ``kept``.

    Kept rows come as they were, load stamps included.
    """
    change = is_change()
    stamps = {"loaded_at": loaded_at.cast("timestamp"), "last_run_id": run_id.cast("string")}
    new = {**{name: F.col(name) for name in table.columns}, **stamps}
    chosen = (F.when(change, value).otherwise(F.col(held_name(name))).alias(name) for name, value in new.items())
    there = F.col(held_name(table.key[0])).isNotNull()
    return met.where(change | (kept & there)).select(*chosen, *more)


def untouched(target: DataFrame, changed: DataFrame, table: VersionedTable) -> DataFrame:
    """Target rows no change replaces, with every column as it was."""
    return target.join(changed.select(*table.key), list(table.key), "left_anti")


def apply_changes(
    target: DataFrame,
    changed: DataFrame,
    table: VersionedTable,
    place: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """The target after the load. A changed row is replaced whole, stamps included.

    ``place`` may lay the changed rows out like the target before the two are put together.
    """
    columns = [*table.columns, *LOAD_STAMP.names]
    kept = untouched(target, changed, table)
    return kept.select(*columns).unionByName(place(changed).select(*columns))
