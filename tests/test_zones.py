"""Which files of an unpartitioned history a window opens."""

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from changefold import PRODUCTS, LoadParams, SourceDataError, TargetStore, ZonedHistory, run_load
from changefold.operators.contract import validate
from tests.products import counters, fragment

START = datetime(2026, 1, 1, tzinfo=UTC)


def day_rows(spark, day, n=5):
    rows = [(f"k{day}-{i}", f"2026-01-{day:02}T0{i}:00:00Z", 1, "n", "c", "1.00", "true") for i in range(n)]
    return validate(fragment(spark, rows), PRODUCTS).drop("error").select(*PRODUCTS.columns)


@pytest.fixture
def history(spark, tmp_path):
    path = str(tmp_path / "a history")
    for day in range(1, 7):
        day_rows(spark, day).coalesce(1).write.mode("append").parquet(path)
    return ZonedHistory(spark, path, str(tmp_path / "zones"), "updated_at")


def test_only_files_of_the_window_are_opened(spark, history):
    opened = history.since(START + timedelta(days=4))
    assert len(opened.inputFiles()) == 2 and opened.count() == 10
    assert history.refresh() == 0  # nothing new
    assert history.known().count() == 6 and history().count() == 30
    assert history.since(START + timedelta(days=60)).isEmpty()
    day_rows(spark, 9).coalesce(1).write.mode("append").parquet(history.path)
    opened = history.since(START + timedelta(days=5))
    assert sorted(r[0] for r in opened.select(F.dayofmonth("updated_at")).distinct().collect()) == [6, 9]
    assert len(opened.inputFiles()) == 2
    # The bound itself is inside.
    assert len(history.since(datetime(2026, 1, 9, 4, tzinfo=UTC)).inputFiles()) == 1


def test_a_load_opens_what_it_needs_and_sees_rows_without_a_time(spark, history, tmp_path):
    store = TargetStore(spark, str(tmp_path / "store"), PRODUCTS, n_buckets=2)
    params = LoadParams("products", START, timedelta(hours=24))
    assert counters(run_load(history, store, params)) == (30, 30, 30, 0, 0)
    day_rows(spark, 7).coalesce(1).write.mode("append").parquet(history.path)
    assert counters(run_load(history, store, params))[2:] == (5, 0, 6)
    timeless = day_rows(spark, 2, 1).withColumn("updated_at", F.lit(None).cast("timestamp"))
    timeless.coalesce(1).write.mode("append").parquet(history.path)
    with pytest.raises(SourceDataError, match="updated_at must not be blank"):
        run_load(history, store, params)
