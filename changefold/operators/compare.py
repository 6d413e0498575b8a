"""Equality of two states."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def business_state(target: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The business columns only."""
    return target.select(*columns)


def state_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side holds more often than the other; empty when the states are equal.

    The same as EXCEPT ALL both ways, in one shuffle.
    """
    columns = left.columns
    signed = left.withColumn("sign", F.lit(1)).unionByName(
        right.select(*columns).withColumn("sign", F.lit(-1))
    )
    surplus = signed.groupBy(*columns).agg(F.sum("sign").alias("surplus")).filter("surplus <> 0")
    return surplus.select(
        *columns,
        F.when(F.col("surplus") > 0, "left").otherwise("right").alias("only_in"),
        F.abs("surplus").alias("n_rows"),
    )
