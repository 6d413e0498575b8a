"""One incremental load: window → contract → fold → classify → write → publish."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from changefold.errors import (
    BLANK_PIPELINE_NAME,
    NAIVE_START,
    ConflictingSourceVersionError,
    SourceDataError,
    TargetVersionConflictError,
)
from changefold.functions.canonical import instant_iso
from changefold.operators import audit, checksum, window
from changefold.operators.classify import CONFLICT, OUTCOME, UPDATE, held_name, met, outcome_counters
from changefold.operators.contract import ERROR, clean, validate
from changefold.operators.fold import CONFLICT as CONTRADICTORY, FIRST_ERROR, ROWS, fold
from changefold.operators.merge import is_change, written
from changefold.plans.store import HASHED_BYTES, REPLACED, PipelineState, RunRecord, Snapshot, TargetStore
from changefold.session import configure, one_row
from changefold.sources.zones import ZonedHistory
from changefold.spec import FAILED, STATE_SCHEMA, SUCCESS, TableSpec

#: Points of a load at which ``on_stage`` is called.
AFTER_CLASSIFICATION = "classified"
AFTER_TARGET_WRITES = "target written"
AFTER_STATE_ADVANCEMENT = "mark moved"


@dataclass(frozen=True)
class LoadParams:
    pipeline_name: str
    initial_start_at: datetime
    overlap: timedelta = timedelta(hours=24)
    allowed_future_skew: timedelta = timedelta(minutes=5)
    #: Keep rows that break the contract beside the target and load the others, instead of failing.
    quarantine: bool = False


@dataclass(frozen=True)
class LoadResult:
    run: RunRecord
    extraction_start: datetime

    def as_frame(self, spark: SparkSession) -> DataFrame:
        started = F.col("started_at").alias("run_started_at")
        return self.run.as_frame(spark).select(
            "run_id", "status", started, "previous_watermark",
            F.lit(self.extraction_start).alias("extraction_start"), "resulting_watermark",
            "rows_received", "rows_after_deduplication", "rows_inserted", "rows_updated", "rows_ignored",
        )


def result_document(result: DataFrame, checksum: str, pretty: bool = False) -> DataFrame:
    """One JSON document: the result's fields, instants as UTC text, nulls kept, then the checksum."""
    fields = [
        instant_iso(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in result.schema
    ]
    options = {"ignoreNullFields": "false", "pretty": str(pretty).lower()}
    document = F.struct(*fields, F.lit(checksum).alias("business_state_checksum"))
    return result.select(F.to_json(document, options).alias("document"))


def run_load(
    history: Callable[[], DataFrame] | ZonedHistory | DataFrame,
    store: TargetStore,
    params: LoadParams,
    *,
    run_id: str | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(UTC),
    on_stage: Callable[[str], None] = lambda stage: None,
) -> LoadResult:
    """Load what is new in ``history`` into the store's target.

    Either target rows, progress mark and success record all become visible, or none of them and
    a failed record is kept. A failed or repeated load is simply run again with the same history.
    ``history`` may be a function, so that a source which cannot be opened is recorded as well, or have a
    zone map, so that only files with rows in the window are opened. A
    ``run_id`` can be used once; a blank, unfit or used one is refused and leaves no record.
    """
    if not params.pipeline_name.strip():
        raise ValueError(BLANK_PIPELINE_NAME)
    configure(store.spark)
    store = store.reopened()
    run = RunRecord(str(uuid.uuid4()) if run_id is None else run_id, params.pipeline_name, started_at=_utc(clock()))
    store.claim(run.run_id)
    progress = _Progress(run)
    try:
        return _load(history, store, params, progress, clock, on_stage)
    except Exception as error:
        failed = replace(
            progress.run,
            status=FAILED,
            finished_at=_utc(clock()),
            resulting_watermark=None,
            error_type=type(error).__name__,
            error_message=str(error)[:500],
        )
        try:
            store.record_failure(failed)
        except Exception as unrecorded:
            error.add_note(f"the failed run could not be recorded: {unrecorded}")
        if params.quarantine:
            _quietly(lambda: store.drop_quarantine(run.run_id))
        raise
    finally:
        _quietly(lambda: store.discard_staging(run.run_id))
        _quietly(store.forget_tables)


def load_records(records: DataFrame, store: TargetStore, *, run_id: str, loaded_at: datetime) -> dict[str, int]:
    """Classify typed records, one per key, and write those to insert or update; gives the counters.

    For callers with windows and audits of their own: no mark moves and no run is recorded. All records
    are classified before any shows, and a conflict with the target, an unsound row or two records of one
    key leave the target as it was. The run id is used up in any case.
    """
    configure(store.spark)
    store = store.reopened()
    loaded_at = _utc(loaded_at)
    store.claim(run_id)
    try:
        base = store.snapshot()
        rows, laid_out = records.select(*store.spec.columns), bool(base.n_buckets)
        bucket = store.bucket_of_key(base.n_buckets) if base.n_buckets else F.lit(None)
        winners, seen = store.stage(rows, run_id, "winners", base.n_buckets, [F.collect_set(bucket).alias("buckets")])
        if not base.n_buckets:
            base = replace(base, n_buckets=store.choose_buckets(run_id, "winners"))
        applied = _apply(winners, store, base, run_id, loaded_at, seen.get("buckets") or [], laid_out)
        if applied.buckets:
            store.publish(base, run_id, applied.rewritten, None, None, applied.added, applied.digest, applied.pending)
        return applied.counters
    finally:
        _quietly(lambda: store.discard_staging(run_id))
        _quietly(store.forget_tables)


class _Progress:
    """What the run record would say if the load ended now."""

    def __init__(self, run: RunRecord) -> None:
        self.run = run

    def note(self, **reached: object) -> None:
        self.run = replace(self.run, **reached)


def _load(history, store, params, progress, clock, on_stage) -> LoadResult:
    spark, spec, run = store.spark, store.spec, progress.run
    base = store.snapshot()

    # The bound becomes a literal, so that the scan can be pruned with it.
    asked = one_row(spark, T.StructType([STATE_SCHEMA["pipeline_name"]]), {"pipeline_name": params.pipeline_name})
    known = window.lookup_state(store.state(base), asked)
    bounds = window.extraction_start(known, params.initial_start_at, params.overlap).first()
    previous = _utc_from_row(bounds["watermark"])
    progress.note(previous_watermark=previous)
    if previous is None and params.initial_start_at.utcoffset() is None:
        raise ValueError(NAIVE_START)
    start = _utc_from_row(bounds["extraction_start"])
    latest_allowed = window.future_bound(run.started_at, params.allowed_future_skew)

    if isinstance(history, ZonedHistory):
        rows = history.since(start)
    else:
        rows = history() if callable(history) else history
    if params.quarantine:
        folded = fold(_quarantined(rows, store, run.run_id, start, latest_allowed), spec)
    else:
        folded = fold(validate(rows, spec, start, latest_allowed), spec, ERROR)
    winners, seen = store.stage(folded, run.run_id, "winners", base.n_buckets, _source_metrics(folded, store, base.n_buckets))
    laid_out = bool(base.n_buckets)
    if not laid_out:
        base = replace(base, n_buckets=store.choose_buckets(run.run_id, "winners"))
    newest = _gate_source(seen, spec, progress)

    winners, touched = winners.select(*spec.columns), seen.get("buckets") or []
    applied = _apply(winners, store, base, run.run_id, run.started_at, touched, laid_out, lambda: on_stage(AFTER_CLASSIFICATION))
    progress.note(**applied.counters)
    on_stage(AFTER_TARGET_WRITES)

    finished_at = _utc(clock())
    marks = one_row(spark, T.StructType([T.StructField(n, T.TimestampType()) for n in ("previous", "newest")]), {"previous": previous, "newest": newest})
    mark = _utc_from_row(marks.select(window.advance(F.col("previous"), F.col("newest"))).first()[0])
    progress.note(status=SUCCESS, finished_at=finished_at, resulting_watermark=mark)
    state = None
    if mark is not None:
        reached = PipelineState(params.pipeline_name, mark, run.run_id, finished_at)
        state = store.advanced(base, reached)
    on_stage(AFTER_STATE_ADVANCEMENT)

    record = progress.run.as_frame(spark)
    broken = audit.broken_rules(record, audit.run_rules()).first()
    if broken is not None:
        raise ValueError(f"run record is not sound: {broken['broken_rules']}")
    store.publish(base, run.run_id, applied.rewritten, state, progress.run, applied.added, applied.digest, applied.pending)
    return LoadResult(progress.run, start)


def _quarantined(rows: DataFrame, store: TargetStore, run_id: str, start: datetime, latest_allowed: datetime) -> DataFrame:
    """Rows that keep the contract; the others are kept beside the target, as they stand in the source."""
    record = "record"
    while record in rows.columns:
        record += "_"
    # JSON holds any cell; nulls are kept, so that a cell the row lacks can be told from an empty one.
    shown = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    validated = validate(rows.withColumn(record, shown), store.spec, start, latest_allowed)
    rejected = F.col(ERROR).isNotNull()
    kept = validated.select(*store.spec.columns, F.when(rejected, F.col(record)).alias(record), ERROR)
    # Read once, so that both parts come from the same state of the source.
    staged, seen = store.stage(kept, run_id, "validated", 0, [F.count_if(rejected).alias("rejected")])
    if seen.get("rejected"):
        store.quarantine(staged.where(rejected).select(F.col(record).alias("record"), F.col(ERROR).alias("rule")), run_id)
    return clean(staged).drop(record)


def _source_metrics(folded: DataFrame, store: TargetStore, n_buckets: int) -> list[Column]:
    """What a load has to know about its winners. The newest event time of all rows is that of all
    winners, as it leads the version order; buckets are at most as many as the store has."""
    spec = store.spec
    bucket = store.bucket_of_key(n_buckets) if n_buckets else F.lit(None).cast("int")
    clash = F.struct(*spec.key, CONTRADICTORY)
    offender = [F.min(FIRST_ERROR).alias("offender")] if FIRST_ERROR in folded.columns else []
    return [
        *offender,
        F.min(F.when(F.col(CONTRADICTORY).isNotNull(), clash)).alias("clash"),
        F.sum(ROWS).alias("rows_received"),
        F.count(F.lit(1)).alias("n_winners"),
        F.max(spec.event_time).alias("newest"),
        F.collect_set(bucket).alias("buckets"),
    ]


def _gate_source(seen: dict, spec: TableSpec, progress: _Progress) -> datetime | None:
    """Refuse rows in error and contradictory versions; give the newest event time seen."""
    if seen.get("offender") is not None:
        found = seen["offender"].asDict()
        message = found.pop("message")
        where = ", ".join(f"{name}={value}" for name, value in found.items() if value is not None)
        raise SourceDataError(f"{message} ({where})")
    progress.note(rows_received=seen.get("rows_received") or 0)
    if seen.get("clash") is not None:
        raise ConflictingSourceVersionError(
            "source rows disagree for " + _name_version(spec, seen["clash"], seen["clash"][CONTRADICTORY])
        )
    progress.note(rows_after_deduplication=seen.get("n_winners") or 0)
    return _utc_from_row(seen.get("newest"))


@dataclass(frozen=True)
class _Applied:
    """What winners did to the target; not published yet."""

    counters: dict[str, int]
    rewritten: dict[int, int]
    added: dict[int, int]
    digest: str | None

    @property
    def buckets(self) -> bool:
        return bool(self.rewritten or self.added)

    @property
    def pending(self) -> bool:
        """Whether lines were written that the digest does not have."""
        return self.buckets and not self.digest


def _apply(
    winners: DataFrame,
    store: TargetStore,
    base: Snapshot,
    run_id: str,
    loaded_at: datetime,
    touched: list[int],
    laid_out: bool,
    classified: Callable[[], None] = lambda: None,
) -> _Applied:
    """Classify winners and write the changes, both by one join in one job.

    Buckets that are due are written whole, to the others change files are added. Conflicts and unsound
    rows are found in the same job; what it wrote then is named by no manifest.
    """
    spec, n = store.spec, base.n_buckets
    due = sorted(bucket for bucket in touched if bucket in base.buckets and base.due(bucket))
    # Winners staged when the store had no buckets yet are laid out now.
    winners = winners if laid_out else store.spread(winners, n)
    if store.staged_bytes(run_id, "winners") <= HASHED_BYTES * n:
        winners = winners.hint("shuffle_hash")
    held = store.target(base, touched)
    joined = met(winners, held, spec, "full_outer" if due else "left")
    rules = _row_rules(spec)
    is_winner = f"{OUTCOME} IS NOT NULL"
    bucket = store.bucket_of_key(n, *(F.coalesce(F.col(k), F.col(held_name(k))) for k in spec.key))
    observed = Observation(f"classified-{run_id}")
    metrics = [
        *outcome_counters(),
        F.min(F.when(F.col(OUTCOME) == CONFLICT, F.struct(*spec.key, *spec.version))).alias("clash"),
        F.collect_set(F.when(is_change(), bucket)).alias("changed"),
        *audit.rule_counts(rules, is_winner),
    ]
    held_line = checksum.line_hash(spec, spec.business_schema, held_name(""))
    replaced = F.when(F.col(OUTCOME) == UPDATE, held_line).alias(REPLACED)
    kept = bucket.isin(due) if due else F.lit(False)
    rows = written(joined.observe(observed, *metrics), spec, F.lit(loaded_at), F.lit(run_id), kept, replaced)
    sizes = store.write_buckets(rows, run_id, n)
    seen = observed.get
    if seen.get("clash") is not None:
        raise TargetVersionConflictError("history and target disagree for " + _name_version(spec, seen["clash"], seen["clash"]))
    for name in rules:
        if seen.get(name):
            raise ValueError(f"rows to load break the rule: {name}")
    classified()
    counters = {name: seen.get(name) or 0 for name in ("rows_inserted", "rows_updated", "rows_ignored")}
    changed = seen.get("changed") or []
    whole = {b: sizes[b] for b in changed if b in due or b not in base.buckets}
    added = {b: sizes[b] for b in changed if b not in whole}
    digest = store.carry_digest(base, run_id) if changed else None
    return _Applied(counters, whole, added, digest)


def _row_rules(spec: TableSpec) -> audit.Rules:
    signed = [name for name, kind in spec.contract if kind in ("sequence", "money")]
    return {**audit.not_null_rules(*spec.columns), **audit.non_negative_rules(*signed)}


def _name_version(spec: TableSpec, row, version) -> str:
    parts = [f"{name}={row[name]!r}" for name in spec.key]
    for name in spec.version:
        value = version[name]
        shown = _utc_from_row(value).isoformat() if isinstance(value, datetime) else value
        parts.append(f"{name}={shown}")
    return ", ".join(parts)


def _utc(value: datetime) -> datetime:
    if value.utcoffset() is None:
        raise ValueError("the clock must give timezone-aware times")
    return value.astimezone(UTC)


def _utc_from_row(value: datetime | None) -> datetime | None:
    """A collected timestamp is naive in the Python process's own zone."""
    return None if value is None else value.astimezone(UTC)


def _quietly(cleanup: Callable[[], None]) -> None:
    try:
        cleanup()
    except Exception:
        pass
