"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changefold import (
    PRODUCTS,
    ConflictingSourceVersionError,
    LoadParams,
    LoadResult,
    SourceDataError,
    TargetStore,
    TargetVersionConflictError,
    ZonedHistory,
    append_csv_history,
    configure,
    load_records,
    read_csv_history,
    result_document,
    run_load,
    scratch_dir,
)
from changefold.functions.text import parse_column, parse_flag, parse_money
from changefold.operators import audit, checksum, window
from changefold.operators.classify import CONFLICT, OUTCOME, STALE, classify, outcome_counters, restrict_to_keys
from changefold.operators.compare import business_state, state_diff
from changefold.operators.contract import ERROR, clean, gate, validate
from changefold.operators.fold import CONFLICT as CONTRADICTORY, ROWS, exact_repeats, fold, newest_per_key, source_conflicts
from changefold.operators.merge import changes, untouched
from changefold.plans.load import AFTER_TARGET_WRITES
from changefold.sources.history import SOURCE_FILE, with_fragment
from checks import feeds
from checks.feeds import BEGINNING, EVENTS, LINES, ORDERS, OVERLAP, PARTS, plain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_STARTS = {
    "seed": datetime(2002, 1, 1, tzinfo=UTC),
    "load": datetime(2002, 1, 2, tzinfo=UTC),
    "broken": datetime(2002, 1, 3, tzinfo=UTC),
    "retry": datetime(2002, 1, 4, tzinfo=UTC),
}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(configure(spark), sf_dir))

    QUERIES[build.__name__] = run
    return build


# -- scans, window, state ----------------------------------------------------------------------


@query
def scan_history(spark, sf_dir):
    path = scratch_dir(spark, "history")
    raw = feeds.raw_products(spark, sf_dir).withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    before = F.col("updated_at") < "2000"
    append_csv_history(raw.filter(before), path)
    append_csv_history(raw.filter(~before).select(*reversed(raw.columns)), path)
    return read_csv_history(spark, path).drop(SOURCE_FILE)


@query
def append_history(spark, sf_dir):
    once = feeds.events(spark, sf_dir)
    fragment = once.filter("event_type = 'error'").select(*reversed(once.columns))
    return with_fragment(once, fragment)


@query
def state_lookup(spark, sf_dir):
    return window.lookup_state(feeds.customer_state(spark, sf_dir), feeds.customer_pipelines(spark, sf_dir))


@query
def extraction_start(spark, sf_dir):
    known = window.lookup_state(feeds.customer_state(spark, sf_dir), feeds.customer_pipelines(spark, sf_dir))
    starts = window.extraction_start(known, BEGINNING, OVERLAP)
    return starts.select("pipeline_name", "watermark", "extraction_start")


@query
def state_upsert(spark, sf_dir):
    rows = feeds.orders(spark, sf_dir)
    later = rows.filter(F.col("o_orderdate") >= F.lit(feeds.SEEDED_UNTIL))
    return window.upsert_state(
        feeds.customer_state(spark, sf_dir), feeds.customer_state(spark, sf_dir, later, "load")
    )


def _window_start(spark, sf_dir) -> datetime:
    """Start of the second load, collected as one row so that it prunes the scan."""
    mark = feeds.seeded(feeds.orders(spark, sf_dir)).agg(F.max("o_orderdate").alias("watermark"))
    start = window.extraction_start(mark, BEGINNING, OVERLAP).first()["extraction_start"]
    return start.astimezone(UTC)


def _in_window(spark, sf_dir) -> DataFrame:
    return window.in_window(feeds.orders(spark, sf_dir), "o_orderdate", _window_start(spark, sf_dir))


@query
def window_filter(spark, sf_dir):
    return _in_window(spark, sf_dir)


@query
def window_filter_partitioned(spark, sf_dir):
    """The same window of a history that is partitioned by day."""
    path = scratch_dir(spark, "by-day")
    rows = feeds.orders(spark, sf_dir)
    rows.withColumn("day", F.to_date("o_orderdate")).repartition("day").write.partitionBy("day").parquet(path)
    history = spark.read.parquet(path)
    return window.in_window(history, "o_orderdate", _window_start(spark, sf_dir), "day").select(*rows.columns)


@query
def window_filter_zones(spark, sf_dir):
    """The same window of a history whose files have a zone map."""
    path = scratch_dir(spark, "zoned")
    rows = feeds.orders(spark, sf_dir)
    rows.repartitionByRange(16, "o_orderdate").write.parquet(path)
    start = _window_start(spark, sf_dir)
    history = ZonedHistory(spark, path, scratch_dir(spark, "zones"), "o_orderdate")
    return window.in_window(history.since(start), "o_orderdate", start)


@query
def future_gate(spark, sf_dir):
    run_start = datetime(2024, 1, 25, tzinfo=UTC)
    return window.beyond_future_bound(feeds.events(spark, sf_dir), "ts", run_start, timedelta(minutes=5))


@query
def watermark_advance(spark, sf_dir):
    rows = feeds.orders(spark, sf_dir)
    later = rows.filter(F.col("o_orderdate") >= F.lit(feeds.SEEDED_UNTIL))
    source = feeds.customer_state(spark, sf_dir, later).select(
        "pipeline_name", F.col("watermark").alias("source_watermark")
    )
    known = window.lookup_state(feeds.customer_state(spark, sf_dir), feeds.customer_pipelines(spark, sf_dir))
    return known.join(source, "pipeline_name", "left").select(
        "pipeline_name",
        F.col("watermark").alias("previous_watermark"),
        "source_watermark",
        window.advance(F.col("watermark"), F.col("source_watermark")).alias("resulting_watermark"),
    )


@query
def watermark_empty(spark, sf_dir):
    rows = feeds.orders(spark, sf_dir)
    mark = rows.agg(F.max("o_orderdate").alias("mark")).first()["mark"].astimezone(UTC)
    nothing_newer = rows.filter(F.col("o_orderdate") > F.lit(mark))
    return nothing_newer.agg(
        F.count(F.lit(1)).alias("rows_received"),
        F.max("o_orderdate").alias("source_watermark"),
        window.advance(F.lit(mark), F.max("o_orderdate")).alias("resulting_watermark"),
    )


@query
def late_arrivals(spark, sf_dir):
    """Error events arrive late: after the newest event of the other types was loaded."""
    rows = feeds.events(spark, sf_dir)
    punctual = rows.filter("event_type <> 'error'")
    mark = punctual.agg(F.max("ts").alias("watermark"))
    bounds = window.extraction_start(mark, BEGINNING, timedelta(days=5)).first()
    reread = window.in_window(rows, "ts", bounds["extraction_start"].astimezone(UTC))
    winners = fold(reread, EVENTS).select(*EVENTS.columns)
    outcomes = classify(winners, newest_per_key(punctual, EVENTS), EVENTS)
    late = (F.col("ts") < F.lit(bounds["watermark"].astimezone(UTC))) & F.col(OUTCOME).isin("insert", "update")
    return outcomes.filter(late).select("user_id", "ts", "event_id", OUTCOME)


# -- contract ----------------------------------------------------------------------------------


def _validated(spark, sf_dir) -> DataFrame:
    return validate(feeds.raw_products(spark, sf_dir), PRODUCTS, BEGINNING, RUN_STARTS["seed"])


@query
def contract_errors(spark, sf_dir):
    return _validated(spark, sf_dir).filter("error IS NOT NULL").select("o_orderkey", "error")


@query
def contract_clean(spark, sf_dir):
    return clean(_validated(spark, sf_dir)).drop("o_orderkey")


@query
def contract_gate(spark, sf_dir):
    return gate(_validated(spark, sf_dir), "o_orderkey")


def _by_priority(*choices: Column) -> Column:
    """Picks a spelling by the order's priority, so that all spellings occur."""
    rank = F.left("o_orderpriority", F.lit(1)).cast("int")
    return F.element_at(F.array(*choices), rank)


@query
def price_normalise(spark, sf_dir):
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    cents = (amount * 100).cast("decimal(20,0)").cast("string")
    spelling = _by_priority(
        amount.cast("string"),
        F.concat(F.lit("\t+"), amount.cast("string"), F.lit("000 ")),
        F.concat(cents, F.lit("E-2")),
        F.concat(amount.cast("string"), F.lit("1")),
        F.concat(F.lit("-"), amount.cast("string")),
    )
    spelled = feeds.read(spark, sf_dir, "orders").select("o_orderkey", spelling.alias("price"))
    return parse_column(spelled, "price", parse_money)


@query
def boolean_normalise(spark, sf_dir):
    spelling = _by_priority(F.lit("true"), F.lit(" TRUE\t"), F.lit("False"), F.lit("yes"), F.lit("  "))
    spelled = feeds.read(spark, sf_dir, "orders").select("o_orderkey", spelling.alias("is_active"))
    return parse_column(spelled, "is_active", parse_flag)


# -- versions ----------------------------------------------------------------------------------


@query
def dedup_exact(spark, sf_dir):
    return exact_repeats(feeds.events_with_repeats(spark, sf_dir), EVENTS)


@query
def source_conflicts_(spark, sf_dir):
    lines = feeds.read(spark, sf_dir, "lineitem").select(*LINES.columns)
    return source_conflicts(lines, LINES)


@query
def latest_by_key(spark, sf_dir):
    return fold(feeds.events_with_repeats(spark, sf_dir), EVENTS).select(*EVENTS.columns, ROWS)


@query
def fold_window(spark, sf_dir):
    """All a load needs to know about its window: newest version, rows seen, smallest contradictory version."""
    lines = feeds.read(spark, sf_dir, "lineitem").select(*LINES.columns)
    conflict = F.col(f"{CONTRADICTORY}.l_shipdate").alias("conflict_shipdate")
    return fold(lines, LINES).select(*LINES.columns, ROWS, conflict)


@query
def latest_tiebreak(spark, sf_dir):
    lines = feeds.read(spark, sf_dir, "lineitem").select(*PARTS.columns)
    return newest_per_key(lines, PARTS)


# -- target ------------------------------------------------------------------------------------


def _target_with_stamps(spark, sf_dir) -> DataFrame:
    return feeds.seeded_target(spark, sf_dir).select(
        "*", F.lit(RUN_STARTS["seed"]).alias("loaded_at"), F.lit("seed").alias("last_run_id")
    )


@query
def business_state_(spark, sf_dir):
    return business_state(_target_with_stamps(spark, sf_dir), ORDERS.columns).orderBy(*ORDERS.key)


@query
def target_key_lookup(spark, sf_dir):
    winners = newest_per_key(_in_window(spark, sf_dir), ORDERS)
    return restrict_to_keys(feeds.seeded_target(spark, sf_dir), winners, ORDERS).orderBy(*ORDERS.key)


def _outcomes(spark, sf_dir) -> DataFrame:
    winners = newest_per_key(feeds.orders(spark, sf_dir), ORDERS)
    return classify(winners, feeds.seeded_target(spark, sf_dir), ORDERS)


@query
def classify_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir)


@query
def stale_rows(spark, sf_dir):
    newest = newest_per_key(feeds.orders(spark, sf_dir), ORDERS)
    return classify(feeds.seeded_target(spark, sf_dir), newest, ORDERS).filter(F.col(OUTCOME) == STALE)


@query
def target_conflicts(spark, sf_dir):
    """The target holds another total for its urgent orders."""
    altered = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(
        F.col("o_totalprice")
    )
    target = feeds.seeded_target(spark, sf_dir).withColumn("o_totalprice", altered)
    winners = newest_per_key(feeds.orders(spark, sf_dir), ORDERS)
    return classify(winners, target, ORDERS).filter(F.col(OUTCOME) == CONFLICT)


@query
def untouched_rows(spark, sf_dir):
    target = _target_with_stamps(spark, sf_dir)
    changed = changes(_outcomes(spark, sf_dir), ORDERS, F.lit(RUN_STARTS["load"]), F.lit("load"))
    return untouched(target, changed, ORDERS)


@query
def run_metrics(spark, sf_dir):
    winners = fold(_in_window(spark, sf_dir), ORDERS)
    return classify(winners, feeds.seeded_target(spark, sf_dir), ORDERS).agg(
        F.sum(ROWS).alias("rows_received"),
        F.count(F.lit(1)).alias("rows_after_deduplication"),
        *outcome_counters(),
        F.max("o_orderdate").alias("source_watermark"),
    )


# -- audit and comparison ----------------------------------------------------------------------


@query
def constraint_audit(spark, sf_dir):
    lines = feeds.read(spark, sf_dir, "lineitem")
    rules = {
        **audit.not_null_rules("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey"),
        **audit.non_negative_rules("l_quantity", "l_extendedprice"),
        "ship date is before 2001": "l_shipdate >= TIMESTAMP '2001-01-01 00:00:00 UTC'",
    }
    keys = audit.duplicate_keys(lines, *LINES.key)
    return audit.violations(lines, rules).unionByName(keys)


@query
def run_reconcile(spark, sf_dir):
    broken = audit.broken_rules(feeds.order_runs(spark, sf_dir), audit.run_rules())
    return broken.select("run_id", "broken_rules")


@query
def run_status_counts(spark, sf_dir):
    return audit.status_counts(feeds.order_runs(spark, sf_dir))


@query
def state_diff_(spark, sf_dir):
    newest = newest_per_key(feeds.orders(spark, sf_dir), ORDERS)
    return state_diff(feeds.seeded_target(spark, sf_dir), newest)


@query
def canonical_lines(spark, sf_dir):
    return checksum.canonical_lines(feeds.event_product_state(spark, sf_dir), PRODUCTS)


@query
def bucket_checksum(spark, sf_dir):
    return checksum.bucket_digests(feeds.event_product_state(spark, sf_dir), PRODUCTS)


@query
def state_checksum(spark, sf_dir):
    return checksum.state_digest(feeds.event_product_state(spark, sf_dir), PRODUCTS)


# -- whole loads -------------------------------------------------------------------------------


def fixed_load(store: TargetStore, history: DataFrame, run_id: str, quarantine: bool = False, **more) -> LoadResult:
    """A load whose run id and times are fixed; each look at the clock is a minute later."""
    times = (RUN_STARTS[run_id] + timedelta(minutes=minute) for minute in range(60))
    params = LoadParams("orders", BEGINNING, OVERLAP, quarantine=quarantine)
    return run_load(history, store, params, run_id=run_id, clock=lambda: next(times), **more)


def seeded_store(spark, sf_dir) -> tuple[TargetStore, DataFrame]:
    """A store that holds the orders before the seed's end, and the whole history."""
    history = feeds.order_products(spark, sf_dir)
    store = TargetStore(spark, scratch_dir(spark, "store"), PRODUCTS, n_buckets=8)
    fixed_load(store, feeds.seeded(history, "updated_at"), "seed")
    return store, history


def _must_fail(expected: type[Exception], load: Callable[[], LoadResult]) -> None:
    try:
        load()
    except expected:
        return
    raise AssertionError(f"the load should have ended with {expected.__name__}")


@query
def incremental_load(spark, sf_dir):
    store, history = seeded_store(spark, sf_dir)
    return fixed_load(store, history, "load").as_frame(spark)


@query
def apply_load(spark, sf_dir):
    store, history = seeded_store(spark, sf_dir)
    fixed_load(store, history, "load")
    return store.target()


@query
def replay_noop(spark, sf_dir):
    store, history = seeded_store(spark, sf_dir)
    fixed_load(store, feeds.seeded(history, "updated_at"), "load")
    return store.target()


class _Injected(RuntimeError):
    pass


@query
def retry_equivalence(spark, sf_dir):
    store, history = seeded_store(spark, sf_dir)

    def fail(stage: str) -> None:
        if stage == AFTER_TARGET_WRITES:
            raise _Injected(stage)

    _must_fail(_Injected, lambda: fixed_load(store, history, "broken", on_stage=fail))
    fixed_load(store, history, "retry")
    return store.target()


@query
def run_audit(spark, sf_dir):
    """A seed, a load, and a load that meets two prices for every version."""
    store, history = seeded_store(spark, sf_dir)
    fixed_load(store, history, "load")
    contradictory = history.unionByName(history.withColumn("price", F.col("price") + 1))
    _must_fail(ConflictingSourceVersionError, lambda: fixed_load(store, contradictory, "broken"))
    return store.runs()


@query
def failed_run_audit(spark, sf_dir):
    """The history turns out to disagree with what was loaded from it."""
    store, history = seeded_store(spark, sf_dir)
    altered = feeds.seeded(history, "updated_at").withColumn("is_active", ~F.col("is_active"))
    _must_fail(TargetVersionConflictError, lambda: fixed_load(store, altered, "broken"))
    return store.runs().filter("status = 'FAILED'")


def csv_history(spark, sf_dir, rows: DataFrame) -> DataFrame:
    """Rows of text cells, written as CSV and read again."""
    path = scratch_dir(spark, "history")
    append_csv_history(rows.drop("o_orderkey"), path)
    return read_csv_history(spark, path).drop(SOURCE_FILE)


@query
def csv_load(spark, sf_dir):
    """The text rows that keep the contract, from CSV into a target."""
    raw = feeds.raw_products(spark, sf_dir)
    sound = validate(raw, PRODUCTS).filter(F.col(ERROR).isNull()).select("o_orderkey")
    history = csv_history(spark, sf_dir, raw.join(sound, "o_orderkey", "left_semi"))
    store = TargetStore(spark, scratch_dir(spark, "store"), PRODUCTS, n_buckets=8)
    fixed_load(store, history, "seed")
    return store.target()


@query
def csv_load_failed(spark, sf_dir):
    """All text rows, of which some break the contract."""
    history = csv_history(spark, sf_dir, feeds.raw_products(spark, sf_dir))
    store = TargetStore(spark, scratch_dir(spark, "store"), PRODUCTS, n_buckets=8)
    _must_fail(SourceDataError, lambda: fixed_load(store, history, "seed"))
    return store.runs().select("run_id", "status", "error_type", "rows_received", "rows_after_deduplication", "resulting_watermark")


@query
def compacted_state(spark, sf_dir):
    """The target after a load, its change files merged into the buckets."""
    store, history = seeded_store(spark, sf_dir)
    fixed_load(store, history, "load")
    if store.compact().changes:
        raise AssertionError("no change files should be left")
    return store.target()


@query
def carried_checksum(spark, sf_dir):
    """The state's checksum after a load, out of the lines that the loads replaced and wrote."""
    store, history = seeded_store(spark, sf_dir)
    fixed_load(store, history, "load")
    return store.checksum()


@query
def snapshot_diff(spark, sf_dir):
    """What a load changed: rows of the buckets whose digests differ between the two snapshots."""
    store, history = seeded_store(spark, sf_dir)
    fixed_load(store, history, "load")
    return store.differences(store.snapshot(1), store.snapshot(2))


@query
def loaded_records(spark, sf_dir):
    """The newest order of every customer, handed over without window, state and audit."""
    store, history = seeded_store(spark, sf_dir)
    load_records(newest_per_key(history, PRODUCTS), store, run_id="load", loaded_at=RUN_STARTS["load"])
    return store.target()


def _quarantining_store(spark, sf_dir) -> TargetStore:
    """All text rows, loaded with those that break the contract put aside."""
    store = TargetStore(spark, scratch_dir(spark, "store"), PRODUCTS, n_buckets=8)
    fixed_load(store, feeds.raw_products(spark, sf_dir), "seed", quarantine=True)
    return store


@query
def quarantined_rows(spark, sf_dir):
    key = F.get_json_object("record", "$.o_orderkey").cast("bigint").alias("o_orderkey")
    return _quarantining_store(spark, sf_dir).quarantined().select(key, "rule", "run")


@query
def quarantining_load(spark, sf_dir):
    return _quarantining_store(spark, sf_dir).target()


@query
def rebucket_state(spark, sf_dir):
    """The seeded target after its buckets were split in two."""
    store, _ = seeded_store(spark, sf_dir)
    store.rebucket(16)
    return store.target()


@query
def run_id_reuse(spark, sf_dir):
    """A load under a used run id, with nothing new to write, is refused and leaves no record."""
    store, history = seeded_store(spark, sf_dir)
    _must_fail(ValueError, lambda: fixed_load(store, feeds.seeded(history, "updated_at"), "seed"))
    return store.runs()


@query
def result_document_(spark, sf_dir):
    store, history = seeded_store(spark, sf_dir)
    result = fixed_load(store, history, "load")
    digest = store.checksum().first()["state_checksum"]
    return result_document(result.as_frame(spark), digest)


#: Queries named like the operator they call.
for _name in [name for name in QUERIES if name.endswith("_")]:
    QUERIES[_name[:-1]] = QUERIES.pop(_name)
