"""Winners against the current target: insert, update, stale, replay or conflict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changefold.spec import VersionedTable

OUTCOME = "outcome"
INSERT, UPDATE, STALE, REPLAY, CONFLICT = "insert", "update", "stale", "replay", "conflict"


def restrict_to_keys(target: DataFrame, winners: DataFrame, table: VersionedTable) -> DataFrame:
    """Target rows whose key is among the winners.

    A semi join, so that a small set of winners (by the size Spark knows of it) is broadcast and
    the target is only streamed past it.
    """
    return target.join(winners.select(*table.key), list(table.key), "left_semi")


def held_name(name: str) -> str:
    """Name of a target column beside the winners' columns."""
    return f"held_{name}"


def met(winners: DataFrame, target: DataFrame, table: VersionedTable, how: str = "left") -> DataFrame:
    """Winners beside the target rows of their keys, whose columns are renamed, and the ``outcome`` of each.

    With ``how`` full_outer target rows without a winner come too; their outcome is null.
    """
    held = target.select(*(F.col(name).alias(held_name(name)) for name in target.columns))
    on_key = [F.col(k) == F.col(held_name(k)) for k in table.key]
    return winners.join(held, on_key, how).withColumn(OUTCOME, _outcome(table))


def classify(winners: DataFrame, target: DataFrame, table: VersionedTable) -> DataFrame:
    """Winners with their ``outcome``. Each key may be in the target at most once."""
    wanted = restrict_to_keys(target.select(*table.columns), winners, table)
    return met(winners, wanted, table).select(*winners.columns, OUTCOME)


def _outcome(table: VersionedTable) -> Column:
    def held(names: tuple[str, ...]) -> Column:
        return F.struct(*(F.col(held_name(name)).alias(name) for name in names))

    version = table.version_of()
    return (
        F.when(F.col(table.key[0]).isNull(), F.lit(None).cast("string"))
        .when(F.col(held_name(table.key[0])).isNull(), INSERT)
        .when(version > held(table.version), UPDATE)
        .when(version < held(table.version), STALE)
        .when(table.payload_of().eqNullSafe(held(table.payload)), REPLAY)
        .otherwise(CONFLICT)
    )


def outcome_counters() -> list[Column]:
    """Load counters as aggregates over classified winners; ignored covers stale and replay."""
    outcome = F.col(OUTCOME)
    return [
        F.count_if(outcome == INSERT).alias("rows_inserted"),
        F.count_if(outcome == UPDATE).alias("rows_updated"),
        F.count_if(outcome.isin(STALE, REPLAY)).alias("rows_ignored"),
    ]
