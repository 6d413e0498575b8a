"""High-water mark, extraction start and pipeline state."""

from datetime import UTC, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changefold.operators import window
from changefold.operators.contract import validate
from changefold.session import one_row
from changefold.spec import PRODUCTS, STATE_SCHEMA

T = datetime(2026, 1, 2, 10, tzinfo=UTC)


def state(spark, *rows):
    return spark.createDataFrame([(name, mark, run, mark) for name, mark, run in rows], STATE_SCHEMA)


def test_start_is_mark_minus_overlap_or_initial(spark):
    names = spark.createDataFrame([("known",), ("new",)], "pipeline_name string")
    found = window.lookup_state(state(spark, ("known", T, "r1"), ("other", T, "r2")), names)
    initial = datetime(2026, 1, 1, 12, tzinfo=timezone(timedelta(hours=2)))
    starts = window.extraction_start(found, initial, timedelta(hours=24, microseconds=1)).collect()
    assert {r.pipeline_name: r.extraction_start.astimezone(UTC) for r in starts} == {
        "known": datetime(2026, 1, 1, 9, 59, 59, 999999, tzinfo=UTC),
        "new": datetime(2026, 1, 1, 10, tzinfo=UTC),
    }
    assert {r.pipeline_name: r.last_successful_run_id for r in starts} == {"known": "r1", "new": None}


def test_negative_durations_are_rejected(spark):
    with pytest.raises(ValueError, match="overlap must be non-negative"):
        window.extraction_start(state(spark), T, timedelta(seconds=-1))
    with pytest.raises(ValueError, match="allowed_future_skew must be non-negative"):
        window.beyond_future_bound(state(spark), "updated_at", F.lit(T), timedelta(seconds=-1))


def test_mark_never_decreases_and_ignores_nulls(spark):
    earlier = T - timedelta(days=1)
    pairs = [(T, earlier), (earlier, T), (None, T), (T, None), (None, None)]
    rows = spark.createDataFrame(pairs, "p timestamp, s timestamp")
    found = [r[0] for r in rows.select(window.advance(F.col("p"), F.col("s"))).collect()]
    assert [m and m.astimezone(UTC) for m in found] == [T, T, T, T, None]


def test_bounds_are_inclusive_below_and_exclusive_of_the_skew(spark):
    rows = spark.createDataFrame([(T + timedelta(microseconds=n),) for n in (-1, 0, 1)], "t timestamp")
    assert window.in_window(rows, "t", T).count() == 2
    late = window.beyond_future_bound(rows, "t", F.lit(T - timedelta(minutes=5)), timedelta(minutes=5))
    assert late.count() == 1


def test_days_before_the_window_are_not_read(spark, tmp_path):
    times = [T - timedelta(days=2), T - timedelta(hours=11), T - timedelta(microseconds=1), T, None]
    rows = spark.createDataFrame([(f"k{i}", t, 1, "n", "c", Decimal("1.00"), True) for i, t in enumerate(times)], PRODUCTS.business_schema)
    by_day = str(tmp_path / "by_day")
    rows.withColumn("event_day", F.to_date("updated_at")).write.partitionBy("event_day").parquet(by_day)
    history = spark.read.parquet(by_day)
    checked = validate(history, PRODUCTS, T)
    assert {r.product_id: r.error for r in checked.collect()} == {"k3": None, "k4": "updated_at must not be blank"}
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "event_day" in plan[plan.index("PartitionFilters") :].split("]")[0]
    assert window.in_window(history, "updated_at", T, "event_day").count() == 1


def test_upsert_replaces_by_name(spark):
    held = state(spark, ("a", T, "r1"), ("b", T, "r1"))
    new = one_row(spark, STATE_SCHEMA, dict(zip(STATE_SCHEMA.names, ("b", T, "r2", T), strict=True)))
    found = window.upsert_state(held, new).collect()
    assert {r.pipeline_name: r.last_successful_run_id for r in found} == {"a": "r1", "b": "r2"}
