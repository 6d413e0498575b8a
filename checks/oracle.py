"""The same queries in plain SQL, written independently of the Spark code."""

from __future__ import annotations

SEEDED = "o_orderdate < TIMESTAMP '2000-01-01'"
ORDER_COLUMNS = "o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority"
NEWEST_ORDER = "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"
NEWEST_PRODUCT = (
    "QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY updated_at DESC, source_sequence DESC) = 1"
)

# Target before the load, newest order per customer overall, and the load's window.
TARGET = f"target AS (SELECT {ORDER_COLUMNS} FROM orders WHERE {SEEDED} {NEWEST_ORDER})"
LATEST = f"latest AS (SELECT {ORDER_COLUMNS} FROM orders {NEWEST_ORDER})"
BOUND = (
    "bound AS (SELECT max(o_orderdate) AS mark, max(o_orderdate) - INTERVAL 30 DAY AS start_at "
    f"FROM orders WHERE {SEEDED})"
)
WINDOW = f"{BOUND}, in_window AS (SELECT {ORDER_COLUMNS} FROM orders, bound WHERE o_orderdate >= start_at)"
WINNERS = f"winners AS (SELECT * FROM in_window {NEWEST_ORDER})"


def outcomes(source: str, target: str) -> str:
    version = "(s.o_orderdate, s.o_orderkey)"
    held = "(t.o_orderdate, t.o_orderkey)"
    same = " AND ".join(
        f"s.{c} IS NOT DISTINCT FROM t.{c}" for c in ("o_orderstatus", "o_totalprice", "o_orderpriority")
    )
    return (
        f"outcomes AS (SELECT s.*, CASE WHEN t.o_custkey IS NULL THEN 'insert' WHEN {version} > {held} THEN 'update' "
        f"WHEN {version} < {held} THEN 'stale' WHEN {same} THEN 'replay' ELSE 'conflict' END AS outcome "
        f"FROM {source} s LEFT JOIN {target} t ON s.o_custkey = t.o_custkey)"
    )


PIPELINES = "pipelines AS (SELECT 'customer-' || c_custkey AS pipeline_name FROM customer)"


def customer_state(name: str, where: str, run: str) -> str:
    return (
        f"{name} AS (SELECT 'customer-' || o_custkey AS pipeline_name, max(o_orderdate) AS watermark, "
        f"'{run}' AS last_successful_run_id, max(o_orderdate) AS updated_at FROM orders WHERE {where} GROUP BY o_custkey)"
    )


SEED_STATE = customer_state("seed_state", SEEDED, "seed")
LATER_STATE = customer_state("later_state", f"NOT ({SEEDED})", "load")

# The text feed: what the cells hold and which rule each row breaks first.
RAW_TIME = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')"
RAW_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
RAW_NAME = "'say \"' || o_orderstatus || '\",' || chr(10) || 'then go'"
RAW_ERROR = """CASE
    WHEN o_orderkey % 103 = 0 THEN 'updated_at must be a timezone-aware timestamp'
    WHEN o_orderkey % 101 = 0 THEN 'product_id must not be blank'
    WHEN o_orderkey % 107 = 0 THEN 'source_sequence must be non-negative'
    WHEN o_orderkey % 109 = 0 THEN 'price must have at most two decimal places'
    WHEN o_orderkey % 113 = 0 THEN 'is_active must be either true or false' END"""

RUNS = """runs AS (SELECT 'run-' || o_orderkey AS run_id,
    o_orderdate AS started_at,
    CASE o_orderpriority WHEN '5-LOW' THEN o_orderdate - INTERVAL 1 SECOND
        ELSE o_orderdate + INTERVAL 1 MINUTE END AS finished_at,
    CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCESS' ELSE 'PENDING' END AS status,
    CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderdate END AS resulting_watermark,
    o_orderpriority = '1-URGENT' AS urgent, CAST(floor(o_totalprice) AS BIGINT) % 7 AS rest FROM orders)"""
RUN_BREACHES = """concat_ws('; ',
    CASE WHEN urgent THEN 'rows_updated is not negative' END,
    CASE WHEN status NOT IN ('SUCCESS', 'FAILED') THEN 'status is known' END,
    CASE WHEN finished_at < started_at THEN 'run finishes after it starts' END,
    CASE WHEN status = 'SUCCESS' AND urgent AND rest <> -1 THEN 'outcomes add up on success' END,
    CASE WHEN status = 'FAILED' AND resulting_watermark IS NOT NULL THEN 'failed run has no mark' END)"""

# Typed product feeds.
ORDER_PRODUCTS = """SELECT CAST(o_custkey AS VARCHAR) AS product_id, o_orderdate AS updated_at,
    o_orderkey AS source_sequence, o_orderstatus AS name, o_orderpriority AS category,
    CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderstatus <> 'F' AS is_active FROM orders"""
EVENT_PRODUCTS = """SELECT CAST(user_id AS VARCHAR) AS product_id, ts AS updated_at,
    event_id AS source_sequence, event_type AS name, props AS category,
    CAST(abs("value") AS DECIMAL(18,2)) AS price, event_type <> 'error' AS is_active FROM events"""


def lines_of(state: str) -> str:
    return f"""lines AS (SELECT product_id, '{{"product_id":"' || product_id || '","updated_at":"'
        || strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%fZ') || '","source_sequence":' || source_sequence
        || ',"name":"' || name || '","category":"' || replace(category, '"', '\\"') || '","price":"' || price
        || '","is_active":' || CASE WHEN is_active THEN 'true' ELSE 'false' END || '}}' || chr(10) AS line
        FROM {state})"""


_LANES = [f"CAST(sum(('0x' || substr(hash, {1 + 8 * i}, 8))::BIGINT) % 4294967296 AS VARCHAR)" for i in range(8)]
DIGESTS = f"""hashed AS (SELECT substr(sha256(product_id), 1, 3) AS bucket, sha256(line) AS hash FROM lines),
    digests AS (SELECT bucket, count(*) AS n_rows,
        sha256(concat_ws(':', bucket, CAST(count(*) AS VARCHAR), {", ".join(_LANES)})) AS digest
        FROM hashed GROUP BY bucket),
    root AS (SELECT CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS n_rows, sha256(coalesce(
        string_agg(bucket || ':' || digest, chr(10) ORDER BY bucket || ':' || digest), '')) AS state_checksum
        FROM digests)"""

# A whole load: the target after it, the counters, the marks.
LOADED = f"""history AS ({ORDER_PRODUCTS}),
    seed AS (SELECT * FROM history WHERE updated_at < TIMESTAMP '2000-01-01' {NEWEST_PRODUCT}),
    marks AS (SELECT max(updated_at) AS mark, max(updated_at) - INTERVAL 30 DAY AS start_at
        FROM history WHERE updated_at < TIMESTAMP '2000-01-01'),
    reread AS (SELECT history.* FROM history, marks WHERE updated_at >= start_at),
    newest AS (SELECT * FROM reread {NEWEST_PRODUCT}),
    joined AS (SELECT n.*, s.product_id IS NULL AS is_insert,
        s.product_id IS NOT NULL AND (n.updated_at, n.source_sequence) > (s.updated_at, s.source_sequence) AS is_update
        FROM newest n LEFT JOIN seed s ON n.product_id = s.product_id),
    counted AS (SELECT (SELECT count(*) FROM reread) AS rows_received, count(*) AS rows_after_deduplication,
        count(*) FILTER (WHERE is_insert) AS rows_inserted, count(*) FILTER (WHERE is_update) AS rows_updated,
        count(*) FILTER (WHERE NOT is_insert AND NOT is_update) AS rows_ignored FROM joined),
    after AS (SELECT (SELECT mark FROM marks) AS mark, (SELECT start_at FROM marks) AS start_at,
        greatest((SELECT mark FROM marks), (SELECT max(updated_at) FROM reread)) AS new_mark)"""
_BUSINESS = "product_id, updated_at, source_sequence, name, category, CAST(price AS VARCHAR) AS price, is_active"


def target_after(run: str, started: str) -> str:
    return f"""merged AS (
        SELECT {_BUSINESS}, TIMESTAMP '2002-01-01' AS loaded_at, 'seed' AS last_run_id FROM seed
        WHERE product_id NOT IN (SELECT product_id FROM joined WHERE is_insert OR is_update)
        UNION ALL SELECT {_BUSINESS}, TIMESTAMP '{started}', '{run}' FROM joined WHERE is_insert OR is_update)"""


def _names_version(product: str, when: str, sequence: str) -> str:
    return (
        f"'product_id=''' || {product} || ''', updated_at=' || strftime({when}, '%Y-%m-%dT%H:%M:%S+00:00') "
        f"|| ', source_sequence=' || {sequence}"
    )


def _run_row(run: str, day: int, status: str, previous: str, resulting: str, counts: str, error: str = "NULL, NULL"):
    return (
        f"SELECT '{run}' AS run_id, 'orders' AS pipeline_name, TIMESTAMP '2002-01-0{day} 00:00:00' AS started_at, "
        f"TIMESTAMP '2002-01-0{day} 00:01:00' AS finished_at, '{status}' AS status, "
        f"CAST({previous} AS TIMESTAMP) AS previous_watermark, CAST({resulting} AS TIMESTAMP) AS resulting_watermark, "
        f"{counts}, {error}"
    )


_COUNTERS = ("rows_received", "rows_after_deduplication", "rows_inserted", "rows_updated", "rows_ignored")


def _counts(*values: str) -> str:
    return ", ".join(f"CAST({v} AS BIGINT) AS {n}" for v, n in zip(values, _COUNTERS, strict=True))


_SEED_ROWS = "(SELECT count(*) FROM history WHERE updated_at < TIMESTAMP '2000-01-01')"
_SEED_RUN = _run_row(
    "seed", 1, "SUCCESS", "NULL", "(SELECT mark FROM marks)",
    _counts(_SEED_ROWS, "(SELECT count(*) FROM seed)", "(SELECT count(*) FROM seed)", "0", "0"),
    "CAST(NULL AS VARCHAR) AS error_type, CAST(NULL AS VARCHAR) AS error_message",
)
_LOAD_RUN = _run_row(
    "load", 2, "SUCCESS", "(SELECT mark FROM marks)", "(SELECT new_mark FROM after)",
    _counts(*(f"(SELECT {n} FROM counted)" for n in _COUNTERS)),
)
# Third load: every version of its window comes with two prices; the smallest one is reported.
_THIRD = """third AS (SELECT history.* FROM history, after WHERE updated_at >= new_mark - INTERVAL 30 DAY),
    third_first AS (SELECT product_id, updated_at, source_sequence FROM third
        ORDER BY product_id, updated_at, source_sequence LIMIT 1)"""
_BROKEN_RUN = _run_row(
    "broken", 3, "FAILED", "(SELECT new_mark FROM after)", "NULL",
    _counts("2 * (SELECT count(*) FROM third)", "0", "0", "0", "0"),
    "'ConflictingSourceVersionError', 'source rows disagree for ' || (SELECT "
    + _names_version("product_id", "updated_at", "source_sequence") + " FROM third_first)",
)
# Second load of altered history: the first customer whose newest version was loaded otherwise.
_ALTERED = f"""altered AS (SELECT history.* FROM history, marks
        WHERE updated_at >= start_at AND updated_at < TIMESTAMP '2000-01-01'),
    altered_newest AS (SELECT * FROM altered {NEWEST_PRODUCT}),
    altered_first AS (SELECT * FROM altered_newest ORDER BY product_id, updated_at, source_sequence LIMIT 1)"""
_ALTERED_RUN = _run_row(
    "broken", 3, "FAILED", "(SELECT mark FROM marks)", "NULL",
    _counts("(SELECT count(*) FROM altered)", "(SELECT count(*) FROM altered_newest)", "0", "0", "0"),
    "'TargetVersionConflictError' AS error_type, 'history and target disagree for ' || (SELECT "
    + _names_version("product_id", "updated_at", "source_sequence") + " FROM altered_first) AS error_message",
)

_ISO = "'%Y-%m-%dT%H:%M:%SZ'"

ORACLE_SQL: dict[str, str] = {
    "scan_history": f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
        CASE WHEN o_orderkey % 101 = 0 THEN ' ' || chr(9) ELSE CAST(o_orderkey AS VARCHAR) END AS product_id,
        CASE WHEN o_orderkey % 103 = 0 THEN {RAW_TIME} ELSE {RAW_TIME} || 'Z' END AS updated_at,
        CASE WHEN o_orderkey % 107 = 0 THEN '-1' ELSE CAST(o_custkey AS VARCHAR) END AS source_sequence,
        {RAW_NAME} AS name, '  ' || o_orderpriority || ' ' AS category,
        CASE WHEN o_orderkey % 109 = 0 THEN '0.001' ELSE {RAW_PRICE} END AS price,
        CASE WHEN o_orderkey % 113 = 0 THEN 'yes' WHEN o_orderstatus = 'F' THEN 'FALSE' ELSE 'true' END AS is_active
        FROM orders""",
    "append_history": """SELECT user_id, ts, event_id, event_type, "value", props FROM events
        UNION ALL SELECT user_id, ts, event_id, event_type, "value", props FROM events WHERE event_type = 'error'""",
    "state_lookup": f"""WITH {SEED_STATE}, {PIPELINES} SELECT p.pipeline_name, watermark, last_successful_run_id,
        updated_at FROM pipelines p LEFT JOIN seed_state s ON p.pipeline_name = s.pipeline_name""",
    "extraction_start": f"""WITH {SEED_STATE}, {PIPELINES} SELECT p.pipeline_name, watermark,
        coalesce(watermark - INTERVAL 30 DAY, TIMESTAMP '1990-01-01') AS extraction_start
        FROM pipelines p LEFT JOIN seed_state s ON p.pipeline_name = s.pipeline_name""",
    "state_upsert": f"""WITH {SEED_STATE}, {LATER_STATE} SELECT * FROM later_state UNION ALL
        SELECT * FROM seed_state WHERE pipeline_name NOT IN (SELECT pipeline_name FROM later_state)""",
    "window_filter": f"WITH {WINDOW} SELECT * FROM in_window",
    "window_filter_zones": f"WITH {WINDOW} SELECT * FROM in_window",
    "window_filter_partitioned": f"WITH {WINDOW} SELECT * FROM in_window",
    "future_gate": """SELECT user_id, ts, event_id, event_type, "value", props FROM events
        WHERE ts > TIMESTAMP '2024-01-25 00:05:00'""",
    "watermark_advance": f"""WITH {SEED_STATE}, {LATER_STATE}, {PIPELINES}
        SELECT p.pipeline_name, s.watermark AS previous_watermark, l.watermark AS source_watermark,
        CASE WHEN s.watermark IS NULL THEN l.watermark WHEN l.watermark IS NULL THEN s.watermark
            WHEN l.watermark > s.watermark THEN l.watermark ELSE s.watermark END AS resulting_watermark
        FROM pipelines p LEFT JOIN seed_state s ON p.pipeline_name = s.pipeline_name
        LEFT JOIN later_state l ON p.pipeline_name = l.pipeline_name""",
    "watermark_empty": """SELECT CAST(0 AS BIGINT) AS rows_received, CAST(NULL AS TIMESTAMP) AS source_watermark,
        max(o_orderdate) AS resulting_watermark FROM orders""",
    "late_arrivals": """WITH punctual AS (SELECT * FROM events WHERE event_type <> 'error'),
        mark AS (SELECT max(ts) AS reached FROM punctual),
        held AS (SELECT * FROM punctual
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
        winners AS (SELECT events.* FROM events, mark WHERE ts >= reached - INTERVAL 5 DAY
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
        SELECT w.user_id, w.ts, w.event_id, CASE WHEN h.user_id IS NULL THEN 'insert' ELSE 'update' END AS outcome
        FROM winners w LEFT JOIN held h ON w.user_id = h.user_id, mark
        WHERE w.ts < reached AND (h.user_id IS NULL OR (w.ts, w.event_id) > (h.ts, h.event_id))""",
    "contract_errors": f"""SELECT o_orderkey, {RAW_ERROR} AS error FROM orders WHERE {RAW_ERROR} IS NOT NULL""",
    "contract_clean": f"""SELECT CAST(o_orderkey AS VARCHAR) AS product_id, o_orderdate AS updated_at,
        o_custkey AS source_sequence, {RAW_NAME} AS name, o_orderpriority AS category,
        {RAW_PRICE} AS price, o_orderstatus <> 'F' AS is_active
        FROM orders WHERE {RAW_ERROR} IS NULL""",
    "contract_gate": f"""SELECT count(*) AS rows_checked, count({RAW_ERROR}) AS rows_in_error,
        min(o_orderkey) FILTER (WHERE {RAW_ERROR} IS NOT NULL) AS o_orderkey,
        arg_min({RAW_ERROR}, o_orderkey) FILTER (WHERE {RAW_ERROR} IS NOT NULL) AS error FROM orders""",
    "price_normalise": f"""SELECT o_orderkey,
        CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2', '3') THEN {RAW_PRICE} END AS price,
        CASE substr(o_orderpriority, 1, 1) WHEN '4' THEN 'price must have at most two decimal places'
            WHEN '5' THEN 'price must fit decimal(18, 2) and be non-negative' END AS error FROM orders""",
    "boolean_normalise": """SELECT o_orderkey,
        CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN true WHEN '2' THEN true WHEN '3' THEN false END AS is_active,
        CASE WHEN substr(o_orderpriority, 1, 1) IN ('4', '5') THEN 'is_active must be either true or false' END AS error
        FROM orders""",
    "dedup_exact": """WITH twice AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'error')
        SELECT user_id, ts, event_id, event_type, "value", props, count(*) AS copies FROM twice GROUP BY ALL""",
    "source_conflicts": """SELECT l_orderkey, l_linenumber, l_shipdate, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber, l_shipdate HAVING count(DISTINCT (l_partkey, l_quantity)) > 1""",
    "latest_by_key": """WITH seen AS (SELECT user_id, CAST(count(*) + count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS rows_seen
            FROM events GROUP BY user_id)
        SELECT e.user_id, ts, event_id, event_type, "value", props, rows_seen
        FROM events e JOIN seen USING (user_id)
        QUALIFY row_number() OVER (PARTITION BY e.user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "latest_tiebreak": """SELECT l_partkey, l_shipdate, l_orderkey, l_quantity, l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC,
            l_quantity DESC, l_extendedprice DESC) = 1""",
    "business_state": f"WITH {TARGET} SELECT * FROM target ORDER BY o_custkey",
    "target_key_lookup": f"""WITH {TARGET}, {WINDOW} SELECT * FROM target
        WHERE EXISTS (SELECT 1 FROM in_window w WHERE w.o_custkey = target.o_custkey) ORDER BY o_custkey""",
    "classify_outcomes": f"WITH {TARGET}, {LATEST}, {outcomes('latest', 'target')} SELECT * FROM outcomes",
    "stale_rows": f"""WITH {TARGET}, {LATEST}, {outcomes('target', 'latest')}
        SELECT * FROM outcomes WHERE outcome = 'stale'""",
    "target_conflicts": f"""WITH {TARGET}, {LATEST}, other AS (SELECT * REPLACE (CASE o_orderpriority
            WHEN '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM target),
        {outcomes('latest', 'other')} SELECT * FROM outcomes WHERE outcome = 'conflict'""",
    "untouched_rows": f"""WITH {TARGET}, {LATEST}
        SELECT target.*, TIMESTAMP '2002-01-01' AS loaded_at, 'seed' AS last_run_id FROM target
        JOIN latest USING (o_custkey) WHERE target.o_orderkey = latest.o_orderkey""",
    "run_metrics": f"""WITH {TARGET}, {WINDOW}, {WINNERS}, {outcomes('winners', 'target')}
        SELECT (SELECT count(*) FROM in_window) AS rows_received, count(*) AS rows_after_deduplication,
        count(*) FILTER (WHERE outcome = 'insert') AS rows_inserted, count(*) FILTER (WHERE outcome = 'update') AS rows_updated,
        count(*) FILTER (WHERE outcome IN ('stale', 'replay')) AS rows_ignored,
        (SELECT max(o_orderdate) FROM in_window) AS source_watermark FROM outcomes""",
    "constraint_audit": """SELECT 'l_orderkey is not null' AS rule, count(*) FILTER (WHERE l_orderkey IS NULL) AS violations FROM lineitem
        UNION ALL SELECT 'l_linenumber is not null', count(*) FILTER (WHERE l_linenumber IS NULL) FROM lineitem
        UNION ALL SELECT 'l_shipdate is not null', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem
        UNION ALL SELECT 'l_partkey is not null', count(*) FILTER (WHERE l_partkey IS NULL) FROM lineitem
        UNION ALL SELECT 'l_quantity is not negative', count(*) FILTER (WHERE l_quantity < 0) FROM lineitem
        UNION ALL SELECT 'l_extendedprice is not negative', count(*) FILTER (WHERE l_extendedprice < 0) FROM lineitem
        UNION ALL SELECT 'ship date is before 2001', count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '2001-01-01') FROM lineitem
        UNION ALL SELECT 'key is unique', count(*) FROM (SELECT 1 FROM lineitem
            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
    "run_reconcile": f"""WITH {RUNS}, judged AS (SELECT run_id, {RUN_BREACHES} AS broken_rules FROM runs)
        SELECT * FROM judged WHERE broken_rules <> ''""",
    "run_status_counts": f"WITH {RUNS} SELECT status, count(*) AS n_runs FROM runs GROUP BY status",
    "state_diff": f"""WITH {TARGET}, {LATEST},
        gone AS (SELECT * FROM target EXCEPT ALL SELECT * FROM latest),
        come AS (SELECT * FROM latest EXCEPT ALL SELECT * FROM target)
        SELECT *, 'left' AS only_in, CAST(1 AS BIGINT) AS n_rows FROM gone
        UNION ALL SELECT *, 'right', CAST(1 AS BIGINT) FROM come""",
    "canonical_lines": f"""WITH state AS ({EVENT_PRODUCTS} {NEWEST_PRODUCT}), {lines_of('state')}
        SELECT product_id, line FROM lines""",
    "bucket_checksum": f"""WITH state AS ({EVENT_PRODUCTS} {NEWEST_PRODUCT}), {lines_of('state')}, {DIGESTS}
        SELECT bucket, n_rows, digest FROM digests""",
    "state_checksum": f"""WITH state AS ({EVENT_PRODUCTS} {NEWEST_PRODUCT}), {lines_of('state')}, {DIGESTS}
        SELECT n_rows, state_checksum FROM root""",
    "incremental_load": f"""WITH {LOADED} SELECT 'load' AS run_id, 'SUCCESS' AS status,
        TIMESTAMP '2002-01-02' AS run_started_at, mark AS previous_watermark, start_at AS extraction_start,
        new_mark AS resulting_watermark, counted.* FROM counted, after""",
    "apply_load": f"WITH {LOADED}, {target_after('load', '2002-01-02')} SELECT * FROM merged",
    "replay_noop": f"""WITH {LOADED} SELECT {_BUSINESS}, TIMESTAMP '2002-01-01' AS loaded_at,
        'seed' AS last_run_id FROM seed""",
    "csv_load": f"""SELECT CAST(o_orderkey AS VARCHAR) AS product_id, o_orderdate AS updated_at,
        o_custkey AS source_sequence, {RAW_NAME} AS name, o_orderpriority AS category, {RAW_PRICE} AS price,
        o_orderstatus <> 'F' AS is_active, TIMESTAMP '2002-01-01' AS loaded_at, 'seed' AS last_run_id
        FROM orders WHERE {RAW_ERROR} IS NULL""",
    "csv_load_failed": """SELECT 'seed' AS run_id, 'FAILED' AS status, 'SourceDataError' AS error_type,
        CAST(0 AS BIGINT) AS rows_received, CAST(0 AS BIGINT) AS rows_after_deduplication,
        CAST(NULL AS TIMESTAMP) AS resulting_watermark""",
    "compacted_state": f"WITH {LOADED}, {target_after('load', '2002-01-02')} SELECT * FROM merged",
    "loaded_records": f"WITH {LOADED}, {target_after('load', '2002-01-02')} SELECT * FROM merged",
    "carried_checksum": f"""WITH {LOADED}, {target_after('load', '2002-01-02')}, {lines_of('merged')}, {DIGESTS}
        SELECT n_rows, state_checksum FROM root""",
    "snapshot_diff": f"""WITH {LOADED}, {target_after('load', '2002-01-02')},
        gone AS (SELECT {_BUSINESS} FROM seed EXCEPT ALL SELECT {_BUSINESS} FROM merged),
        come AS (SELECT {_BUSINESS} FROM merged EXCEPT ALL SELECT {_BUSINESS} FROM seed)
        SELECT *, 'left' AS only_in, CAST(1 AS BIGINT) AS n_rows FROM gone
        UNION ALL SELECT *, 'right', CAST(1 AS BIGINT) FROM come""",
    "quarantined_rows": f"""SELECT o_orderkey, {RAW_ERROR} AS "rule", 'seed' AS run FROM orders WHERE {RAW_ERROR} IS NOT NULL""",
    "quarantining_load": f"""SELECT CAST(o_orderkey AS VARCHAR) AS product_id, o_orderdate AS updated_at,
        o_custkey AS source_sequence, {RAW_NAME} AS name, o_orderpriority AS category, {RAW_PRICE} AS price,
        o_orderstatus <> 'F' AS is_active, TIMESTAMP '2002-01-01' AS loaded_at, 'seed' AS last_run_id
        FROM orders WHERE {RAW_ERROR} IS NULL""",
    "fold_window": """WITH versions AS (SELECT l_orderkey, l_linenumber, l_shipdate, count(DISTINCT (l_partkey, l_quantity)) AS payloads
            FROM lineitem GROUP BY ALL),
        clashes AS (SELECT l_orderkey, l_linenumber, min(l_shipdate) AS conflict_shipdate FROM versions WHERE payloads > 1 GROUP BY ALL),
        seen AS (SELECT l_orderkey, l_linenumber, count(*) AS rows_seen FROM lineitem GROUP BY ALL),
        newest AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_quantity FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC) = 1)
        SELECT newest.*, rows_seen, conflict_shipdate FROM newest JOIN seen USING (l_orderkey, l_linenumber)
        LEFT JOIN clashes USING (l_orderkey, l_linenumber)""",
    "rebucket_state": f"""WITH {LOADED} SELECT {_BUSINESS}, TIMESTAMP '2002-01-01' AS loaded_at,
        'seed' AS last_run_id FROM seed""",
    "run_id_reuse": f"WITH {LOADED} {_SEED_RUN}",
    "retry_equivalence": f"WITH {LOADED}, {target_after('retry', '2002-01-04')} SELECT * FROM merged",
    "run_audit": f"WITH {LOADED}, {_THIRD} {_SEED_RUN} UNION ALL {_LOAD_RUN} UNION ALL {_BROKEN_RUN}",
    "failed_run_audit": f"WITH {LOADED}, {_ALTERED} {_ALTERED_RUN}",
    "result_document": f"""WITH {LOADED}, {target_after('load', '2002-01-02')}, {lines_of('merged')}, {DIGESTS}
        SELECT '{{"run_id":"load","status":"SUCCESS","run_started_at":"2002-01-02T00:00:00Z","previous_watermark":"'
        || strftime(mark, {_ISO}) || '","extraction_start":"' || strftime(start_at, {_ISO})
        || '","resulting_watermark":"' || strftime(new_mark, {_ISO}) || '","rows_received":' || rows_received
        || ',"rows_after_deduplication":' || rows_after_deduplication || ',"rows_inserted":' || rows_inserted
        || ',"rows_updated":' || rows_updated || ',"rows_ignored":' || rows_ignored
        || ',"business_state_checksum":"' || state_checksum || '"}}' AS document FROM counted, after, root""",
}
