"""High-water mark: where a load starts to read and how far it got."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from changefold.errors import NEGATIVE_OVERLAP, NEGATIVE_SKEW
from changefold.spec import STATE_SCHEMA


def interval(duration: timedelta) -> Column:
    """Day-time interval literal, exact to the microsecond."""
    seconds = f"{duration.seconds}.{duration.microseconds:06d}BD"
    return F.expr(f"make_dt_interval({duration.days}, 0, 0, {seconds})")


def lookup_state(state: DataFrame, names: DataFrame) -> DataFrame:
    """State row of every asked ``pipeline_name``; null columns where there is none yet."""
    return names.select("pipeline_name").join(state, "pipeline_name", "left").select(*STATE_SCHEMA.names)


def extraction_start(looked_up: DataFrame, initial_start_at: datetime, overlap: timedelta) -> DataFrame:
    """Adds the inclusive lower bound: mark minus overlap, or the initial start without a mark."""
    if overlap < timedelta(0):
        raise ValueError(NEGATIVE_OVERLAP)
    start = F.coalesce(F.col("watermark") - interval(overlap), F.lit(initial_start_at).cast("timestamp"))
    return looked_up.withColumn("extraction_start", start)


def in_window(rows: DataFrame, event_time: str, start: datetime | Column, day: str | None = None) -> DataFrame:
    """Rows at or after the bound; ``day`` names a column with the event time's UTC date."""
    start = start if isinstance(start, Column) else F.lit(start)
    if day:
        rows = rows.filter(late_enough_day(day, start))
    return rows.filter(F.col(event_time) >= start)


def late_enough_day(day: str, start: Column) -> Column:
    """Whether rows of a day may be in the window. On a partition column this prunes folders.

    Rows without a day may be anywhere.
    """
    return F.col(day).isNull() | (F.col(day) >= F.to_date(start))


def future_bound(run_start: datetime | Column, skew: timedelta) -> datetime | Column:
    """Latest event time that is fine, the bound itself included."""
    if skew < timedelta(0):
        raise ValueError(NEGATIVE_SKEW)
    return run_start + (interval(skew) if isinstance(run_start, Column) else skew)


def beyond_future_bound(rows: DataFrame, event_time: str, run_start: datetime | Column, skew: timedelta) -> DataFrame:
    """Rows later than run start plus skew."""
    bound = future_bound(run_start, skew)
    return rows.filter(F.col(event_time) > (bound if isinstance(bound, Column) else F.lit(bound)))


def advance(previous: Column, source: Column) -> Column:
    """Later of the two marks; a null one does not count, so the mark never decreases."""
    return F.greatest(previous, source)


def upsert_state(state: DataFrame, changed: DataFrame) -> DataFrame:
    """State with the changed pipelines' rows put in place of their old ones."""
    kept = state.join(changed.select("pipeline_name"), "pipeline_name", "left_anti")
    return kept.select(*STATE_SCHEMA.names).unionByName(changed.select(*STATE_SCHEMA.names))
