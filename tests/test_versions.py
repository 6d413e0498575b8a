"""Folding versions and classifying winners."""

from datetime import UTC, datetime, timedelta
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from changefold.operators.classify import OUTCOME, classify, outcome_counters, restrict_to_keys
from changefold.operators.fold import CONFLICT, FIRST_ERROR, ROWS, exact_repeats, fold, newest_per_key, source_conflicts
from changefold.operators.merge import apply_changes, changes, untouched
from changefold.spec import VersionedTable

TABLE = VersionedTable(("k",), ("t", "s"), ("a", "b"))
SCHEMA = "k string, t int, s int, a string, b double"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def values(frame_, *columns):
    return sorted((tuple(r) for r in frame_.select(*columns).collect()), key=str)


HISTORY = [
    ("P1", 10, 1, "x", 1.0),
    ("P1", 10, 2, "y", 2.0),  # same time, higher sequence
    ("P1", 9, 9, "z", 3.0),  # older time, highest sequence
    ("P1", 10, 2, "y", 2.0),  # exact repeat
    ("P2", 1, 1, None, None),
]


def test_newest_version_wins_in_any_order(spark):
    wanted = [("P1", 10, 2, "y", 2.0, 4), ("P2", 1, 1, None, None, 1)]
    for order in list(permutations(HISTORY))[::17]:
        rows = frame(spark, *order).repartition(3, F.rand(7))
        assert values(fold(rows, TABLE), *TABLE.columns, ROWS) == wanted
    assert values(newest_per_key(frame(spark, *HISTORY), TABLE), *TABLE.columns) == [w[:-1] for w in wanted]


def test_exact_repeats_collapse(spark):
    found = exact_repeats(frame(spark, *HISTORY), TABLE)
    assert sorted(r.copies for r in found.collect()) == [1, 1, 1, 2]


def test_conflict_counts_on_losing_versions_too(spark):
    rows = frame(spark, *HISTORY, ("P1", 9, 9, "other", 3.0), ("P1", 10, 1, "x", None), ("P2", 1, 1, None, None))
    assert values(source_conflicts(rows, TABLE), "k", "t", "s", "copies") == [("P1", 10, 1, 2), ("P1", 9, 9, 2)]
    found = {r.k: r[CONFLICT] for r in fold(rows, TABLE).collect()}
    assert (found["P1"].t, found["P1"].s) == (9, 9)
    assert found["P2"] is None


def test_rows_in_error_become_one_row_without_a_key(spark):
    rows = frame(spark, *HISTORY).withColumn("error", F.when(F.col("t") == 9, F.concat(F.lit("bad "), "a")))
    found = {r.k: r for r in fold(rows, TABLE, "error").collect()}
    assert found[None][FIRST_ERROR].asDict() == {"k": "P1", "t": "9", "s": "9", "message": "bad z"}
    assert (found["P1"][ROWS], found["P1"][FIRST_ERROR]) == (3, None)


def test_a_third_of_all_rows_on_one_key(spark):
    """Against brute force: one key, and one version of it, dominate the history."""
    rows = [(f"K{i % 200}", i % 13, i % 7, f"v{i % 13}{i % 7}", float(i % 13)) for i in range(4000)]
    rows += [("HOT", i % 500, i % 3, f"h{i % 500}{i % 3}", 0.0) for i in range(1500)] + [("HOT", 7, 1, "h71", 0.0)] * 1500
    newest = {}
    for row in rows:
        held = newest.get(row[0])
        if held is None or row[1:3] > held[1:3]:
            newest[row[0]] = row
    wanted = sorted((*row, sum(1 for r in rows if r[0] == key)) for key, row in newest.items())
    folded = fold(frame(spark, *rows), TABLE)
    assert sorted(tuple(r) for r in folded.select(*TABLE.columns, ROWS).collect()) == wanted
    assert folded.filter(F.col(CONFLICT).isNotNull()).isEmpty()


TARGET = [("A", 5, 1, "x", 1.0), ("B", 5, 1, "x", 1.0), ("C", 5, 1, "x", None), ("D", 5, 1, "x", 1.0), ("Z", 1, 1, "x", 1.0)]
WINNERS = [
    ("A", 5, 2, "x", 1.0),
    ("B", 4, 9, "other", 1.0),
    ("C", 5, 1, "x", None),
    ("D", 5, 1, "x", None),
    ("E", 1, 1, "x", 1.0),
]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_outcomes(spark, threshold):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        winners, target = frame(spark, *WINNERS), frame(spark, *TARGET)
        outcomes = classify(winners, target, TABLE)
        wanted = {"A": "update", "B": "stale", "C": "replay", "D": "conflict", "E": "insert"}
        assert {r.k: r[OUTCOME] for r in outcomes.collect()} == wanted
        assert tuple(outcomes.agg(*outcome_counters()).first()) == (1, 1, 2)
        assert values(restrict_to_keys(target, winners, TABLE), "k") == [("A",), ("B",), ("C",), ("D",)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_apply_leaves_other_rows_alone(spark):
    stamp = [F.lit(datetime(2026, 1, 1, tzinfo=UTC)).alias("loaded_at"), F.lit("old").alias("last_run_id")]
    target = frame(spark, *TARGET).select("*", *stamp)
    outcomes = classify(frame(spark, *WINNERS), frame(spark, *TARGET), TABLE)
    new = datetime(2026, 1, 1, tzinfo=UTC) + timedelta(days=1)
    changed = changes(outcomes, TABLE, F.lit(new), F.lit("new"))
    assert values(changed, "k", "last_run_id") == [("A", "new"), ("E", "new")]
    kept = [("B", "old"), ("C", "old"), ("D", "old"), ("Z", "old")]
    assert values(untouched(target, changed, TABLE), "k", "last_run_id") == kept
    after = apply_changes(target, changed, TABLE)
    assert values(after, "k", "last_run_id") == sorted([("A", "new"), ("E", "new"), *kept])
    assert values(after.filter("k = 'A'"), "s") == [(2,)]


def test_nothing_is_sorted_before_rows_are_collapsed(spark):
    """Below the first exchange of each branch rows are only hashed, also with errors among them, and both branches read one exchange."""
    rows = frame(spark, *HISTORY).withColumn("error", F.when(F.col("t") == 9, F.lit("bad")))
    folded = fold(rows, TABLE, "error")
    lines = folded._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    below = []
    for i, line in enumerate(lines):
        if " Exchange " in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            if not any(" Exchange " in other for other in lines[i + 1 : end]):
                below += lines[i + 1 : end]
    assert any("HashAggregate" in line for line in below)
    assert not any("Sort" in line for line in below)
    folded.collect()
    assert "ReusedExchange" in folded._jdf.queryExecution().executedPlan().toString()
