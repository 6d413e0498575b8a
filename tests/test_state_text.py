"""Canonical lines, digests, documents, comparison and audit rules."""

import hashlib
import json
from datetime import UTC, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changefold import PRODUCTS
from changefold.functions.canonical import instant_iso, json_line, json_string
from changefold.operators.audit import broken_rules, duplicate_keys, run_rules, violations
from changefold.operators.checksum import bucket_digests, canonical_lines, state_digest
from changefold.operators.compare import state_diff
from changefold.plans.store import RunRecord

ROWS = [
    ("ß/7", datetime(2024, 2, 29, 23, 59, 59, 10, UTC), 40, "tab\there \\ \x01", "«Öl»", Decimal("0.07"), False),
    ("A 'k'", datetime(1999, 12, 31, 6, tzinfo=UTC), 0, 'say "no"', "\r\f", Decimal("1234567.80"), True),
]


def line(row):
    """A row's line as Python's own JSON writer puts it."""
    key, time, sequence, name, category, price, active = row
    stamp = time.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    values = dict(zip(PRODUCTS.columns, (key, stamp, sequence, name, category, f"{price:.2f}", active), strict=True))
    return json.dumps(values, ensure_ascii=False, separators=(",", ":")) + "\n"


@pytest.fixture
def state(spark):
    return spark.createDataFrame(ROWS, PRODUCTS.business_schema)


def test_lines_have_the_agreed_bytes(state):
    lines = canonical_lines(state, PRODUCTS).orderBy("product_id").collect()
    assert [r.line for r in lines] == [line(row) for row in sorted(ROWS)]


def test_json_strings_equal_pythons(spark):
    texts = ["".join(map(chr, range(1, 40))), "\\u001f \\n", 'a"b', "é😀 \x7f", "", "\x1f"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r[0] for r in rows.orderBy("i").select(json_string(F.col("t"))).collect()]
    assert found == [json.dumps(t, ensure_ascii=False) for t in texts]


def test_digest_depends_on_every_business_value_and_on_nothing_else(state):
    def digest(rows):
        return state_digest(rows, PRODUCTS).first()["state_checksum"]

    base = digest(state)
    assert digest(state.orderBy(F.desc("product_id")).repartition(3)) == base
    assert digest(state.withColumn("loaded_at", F.current_timestamp())) == base
    assert digest(state.limit(0)) == hashlib.sha256(b"").hexdigest()
    altered = [
        state.withColumn("price", F.col("price") + 1),
        state.withColumn("is_active", ~F.col("is_active")),
        state.withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 MICROSECOND")),
        state.withColumn("name", F.concat("name", F.lit(" "))),
        state.limit(1),
    ]
    assert len({base, *(digest(rows) for rows in altered)}) == 6


def test_digest_formula_in_python(state):
    line_hash = hashlib.sha256(line(ROWS[1]).encode()).hexdigest()
    bucket = hashlib.sha256(b"A 'k'").hexdigest()[:3]
    lanes = [str(int(line_hash[8 * i : 8 * i + 8], 16)) for i in range(8)]
    wanted = hashlib.sha256(":".join([bucket, "1", *lanes]).encode()).hexdigest()
    found = {r.bucket: (r.n_rows, r.digest) for r in bucket_digests(state, PRODUCTS).collect()}
    assert found[bucket] == (1, wanted)
    root = "\n".join(sorted(f"{b}:{d}" for b, (_, d) in found.items()))
    assert state_digest(state, PRODUCTS).first()["state_checksum"] == hashlib.sha256(root.encode()).hexdigest()


def test_fraction_is_left_out_when_zero(spark):
    times = [datetime(2026, 1, 1, 1, 2, 3, micros, UTC) for micros in (0, 500000, 1)]
    rows = spark.createDataFrame([(t,) for t in times] + [(None,)], "t timestamp")
    found = [r[0] for r in rows.select(instant_iso(F.col("t"))).collect()]
    assert found == ["2026-01-01T01:02:03Z", "2026-01-01T01:02:03.500000Z", "2026-01-01T01:02:03.000001Z", None]


def test_state_diff_counts_copies(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    right = spark.createDataFrame([("a", 1), (None, 2), ("d", 3)], "v string, k int")
    found = sorted(tuple(r) for r in state_diff(left, right).collect())
    assert found == [(1, "a", "left", 1), (3, "c", "left", 1), (3, "d", "right", 1)]
    assert state_diff(left, left.repartition(2)).isEmpty()


def run(**changes):
    base = dict(
        run_id="r", pipeline_name="p", started_at=datetime(2026, 1, 1, tzinfo=UTC),
        finished_at=datetime(2026, 1, 1, 0, 1, tzinfo=UTC), status="SUCCESS",
        resulting_watermark=datetime(2025, 12, 31, tzinfo=UTC), rows_received=12, rows_after_deduplication=10,
        rows_inserted=2, rows_updated=3, rows_ignored=5,
    )
    return RunRecord(**{**base, **changes})


def test_run_rules(spark):
    failed = dict(status="FAILED", resulting_watermark=None, rows_inserted=0, rows_updated=0, rows_ignored=0)
    for record, wanted in [
        (run(), None),
        (run(**failed), None),
        (run(status="FAILED"), "failed run has no mark"),
        (run(status="UNKNOWN", resulting_watermark=None), "status is known"),
        (run(rows_ignored=4), "outcomes add up on success"),
        (run(rows_received=9), "winners do not exceed rows received"),
        (run(rows_received=-1, **failed, rows_after_deduplication=-1), None),
        (run(finished_at=datetime(2025, 1, 1, tzinfo=UTC)), "run finishes after it starts"),
        (run(pipeline_name=None), "pipeline_name is not null"),
    ]:
        found = broken_rules(record.as_frame(spark), run_rules()).first()
        if record.rows_received < 0:
            assert found["broken_rules"] == "rows_received is not negative; rows_after_deduplication is not negative"
        else:
            assert (found and found["broken_rules"]) == wanted


def test_violations_and_duplicate_keys(spark):
    rows = spark.createDataFrame([(1, 5), (1, -1), (2, None), (2, 1), (3, 1)], "k int, n int")
    rules = {"n is not null": "n IS NULL", "n is not negative": "n < 0"}
    found = violations(rows, rules).unionByName(duplicate_keys(rows, "k")).collect()
    assert {r.rule: r.violations for r in found} == {"n is not null": 1, "n is not negative": 1, "key is unique": 2}


def test_values_of_other_types(spark):
    rows = spark.sql("SELECT 1.0010BD AS d, DATE'2020-01-02' AS day, TIMESTAMP_NTZ'2020-01-02 03:04:05.6' AS at, CAST(NULL AS INT) AS n, 2.5D AS f")
    assert rows.select(json_line(rows.schema.fields)).first()[0] == (
        '{"d":"1.0010","day":"2020-01-02","at":"2020-01-02T03:04:05.600000","n":null,"f":2.5}\n'
    )
    with pytest.raises(TypeError, match="array<int>"):
        json_line(spark.sql("SELECT array(1) AS a").schema.fields)
