"""Constraints as audit queries, since Parquet tables have none of their own.

A rule is a SQL condition that holds for a bad row, under the name it is reported by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changefold.spec import COUNTERS, FAILED, SUCCESS

Rules = dict[str, str]


def violations(rows: DataFrame, rules: Rules) -> DataFrame:
    """(rule, violations) for every rule, all counted in one pass."""
    counted = rows.agg(*rule_counts(rules))
    return counted.unpivot([], list(rules), "rule", "violations")


def rule_counts(rules: Rules, among: str = "true") -> list[Column]:
    """Number of rows that break each rule, as aggregates named like the rules; ``among`` restricts the rows."""
    return [F.expr(f"count_if(({among}) AND ({bad}))").alias(name) for name, bad in rules.items()]


def repeated_keys(rows: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, and ``n``, how often. Bucketed rows need no exchange for that."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def duplicate_keys(rows: DataFrame, *key: str) -> DataFrame:
    """One row: number of keys that occur more than once."""
    return repeated_keys(rows, *key).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("key is unique").alias("rule"), "violations"
    )


def not_null_rules(*names: str) -> Rules:
    return {f"{name} is not null": f"`{name}` IS NULL" for name in names}


def non_negative_rules(*names: str) -> Rules:
    return {f"{name} is not negative": f"`{name}` < 0" for name in names}


def run_rules() -> Rules:
    """What every run record must satisfy."""
    required = ("run_id", "pipeline_name", "started_at", "finished_at", "status", *COUNTERS)
    return {
        **not_null_rules(*required),
        **non_negative_rules(*COUNTERS),
        "status is known": f"status NOT IN ('{SUCCESS}', '{FAILED}')",
        "run finishes after it starts": "finished_at < started_at",
        "winners do not exceed rows received": "rows_after_deduplication > rows_received",
        "outcomes add up on success": f"status = '{SUCCESS}' AND "
        "rows_inserted + rows_updated + rows_ignored <> rows_after_deduplication",
        "failed run has no mark": f"status = '{FAILED}' AND resulting_watermark IS NOT NULL",
    }


def broken_rules(rows: DataFrame, rules: Rules) -> DataFrame:
    """Rows that break a rule, each with the names of all rules it breaks."""
    named = ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in rules.items())
    marked = rows.withColumn("broken_rules", F.expr(f"array_join(array({named}), '; ')"))
    return marked.filter("broken_rules <> ''")


def status_counts(runs: DataFrame) -> DataFrame:
    """Number of runs per status."""
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("n_runs"))
