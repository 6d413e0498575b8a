"""Searches by inner product: exact numbers, repeated rows, hot cells, odd vectors, and what the trees leave out."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import brute

pytest.importorskip("changefold.llm.queries")
from changefold.llm import hard_negatives, topk, vector_search as vs  # noqa: E402
from changefold.llm.vectors import inner_products  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, label int"


def clusters(rng, centres, each, width, length=8, spread=1.0):
    middle = rng.normal(0, 10, (centres, length))
    return np.concatenate([m + rng.normal(0, width, (each, length)) for m in middle]) * spread


def table_of(spark, vectors, labels=None):
    labels = labels if labels is not None else [i % 4 for i in range(len(vectors))]
    return spark.createDataFrame([(i, [float(x) for x in v], int(k)) for i, (v, k) in enumerate(zip(vectors, labels, strict=True))], SCHEMA)


def mined(rows, **settings):
    prepared = hard_negatives.prepared(rows)
    return sorted(map(tuple, hard_negatives.hard_negatives(prepared, prepared.where("vec_id % 10 = 0"), **settings).collect()))


# -- scores --------------------------------------------------------------------------------


@pytest.mark.parametrize("power", [3, 24, 27, 30, 40, 900])
def test_products_are_exact_at_every_size(power):
    rng = np.random.default_rng(power)
    a, b = (np.floor(rng.uniform(-1, 1, (5, 6)) * 2.0**power) for _ in range(2))
    limits = np.iinfo(np.int64)
    for i, row in enumerate(inner_products(a, b).tolist()):
        for j, score in enumerate(row):
            exact = sum(int(x) * int(y) for x, y in zip(a[i].tolist(), b[j].tolist(), strict=True))
            assert score == min(max(exact, limits.min), limits.max)


def test_top_k_of_large_components(spark):
    """Products beyond 2^53 are exact, and components near the end of the doubles do not break the query."""
    big = float(2**24)
    rows = [(0, [big, 1.0, 1.0]), (1, [big, 3.0, -1.0]), (2, [big, -1.0, 5.0]), (20, [1e300, 1.0, 2.0]), (21, [-1e308, 4.0, 1.0]), (40, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sound = topk.quantised(table)
    found = {(r[0], r[1]): (r[2], r[3]) for r in topk.top_k(sound, sound.where("vec_id % 20 = 0")).collect()}
    own = {i: [math.floor(64 * x) if abs(64 * x) < 2**53 else int(min(max(64 * x, -1.7976931348623157e308), 1.7976931348623157e308)) for x in v] for i, v in rows}
    limits = np.iinfo(np.int64)
    for query in (0, 20, 40):
        scores = {i: min(max(sum(x * y for x, y in zip(own[query], v, strict=True)), limits.min), limits.max) for i, v in own.items() if i != query}
        wanted = sorted(scores.items(), key=lambda one: (-one[1], one[0]))
        assert [found[query, k + 1] for k in range(5)] == wanted


def test_repeated_rows_of_a_query(spark):
    """Equal query rows are answered once; candidates that repeat count one by one."""
    rng = random.Random(7)
    vectors = [[float(rng.randint(-3, 3)) for _ in range(4)] for _ in range(40)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(20, vectors[20])] * 19 + [(7, vectors[7])] * 3 + [(None, vectors[3])]
    sound = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    found = topk.top_k(sound, sound.where("vec_id % 20 = 0"), k=30).collect()
    scaled = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    for query in (0, 20):
        own = scaled[query][1]
        scores = [(sum(x * y for x, y in zip(own, v, strict=True)), i) for i, v in scaled if i != query]
        wanted = sorted(((-s, i is None, i or 0) for s, i in scores))[:30]
        mine = sorted((r for r in found if r["query_id"] == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 31))
        assert [(-r["score"], r["vec_id"] is None, r["vec_id"] or 0) for r in mine] == wanted


def test_hot_vector_is_split_over_shards(spark):
    """A third of all rows are one vector; no shard is much larger than asked for."""
    rng = np.random.default_rng(3)
    vectors = np.concatenate([np.tile(rng.normal(0, 1, 6), (400, 1)), rng.normal(0, 1, (800, 6))])
    sound = topk.quantised(table_of(spark, vectors).repartition(5))
    shards = vs.Shards(sound.withColumn("label", F.lit(0).cast("long")), topk.Top, "test-shards", 100, 300, 16)
    sizes = [r["n"] for r in shards.table.select((F.octet_length("rows") / vs.row_type(6).itemsize).alias("n")).collect()]
    assert sum(sizes) == 1200 and max(sizes) <= 160
    found = topk.top_k(sound, sound.where("vec_id % 100 = 0"), k=5, shard_rows=100, sample_rows=300)
    whole = np.floor(64 * vectors).astype(np.int64)
    for query in range(0, 1200, 100):
        scores = whole @ whole[query]
        wanted = [i for i in np.lexsort((np.arange(1200), -scores)).tolist() if i != query][:5]
        mine = sorted((r["rank"], r["vec_id"]) for r in found.where(f"query_id = {query}").collect())
        assert [i for _, i in mine] == wanted


def test_kd_trees_leave_out_most_leaves_of_clustered_rows():
    rng = np.random.default_rng(4)
    vectors = np.floor(64 * clusters(rng, 16, 256, 0.3))
    rows = np.zeros(len(vectors), vs.row_type(8))
    rows["id"], rows["vector"] = np.arange(len(vectors)), vectors
    queries = np.zeros(8, vs.query_type(8))
    queries["vector"], queries["id"], queries["low"], queries["high"] = vectors[:8], -1, np.iinfo(np.int64).min, np.iinfo(np.int64).max
    tree = topk.Tree(rows, float(np.abs(vectors).max()), 32)
    best = vs.Best(queries, 5, vs.different_id)
    tree.visit(best)
    exact = inner_products(queries["vector"], vectors)
    q, _, scores = best.found()
    for i in range(8):
        assert scores[q == i].tolist() == sorted(exact[i].tolist(), reverse=True)[:5]
    assert tree.leaves <= 0.25 * sum(child < 0 for child in tree.left)


# -- hard negatives ------------------------------------------------------------------------


@pytest.mark.parametrize("settings", [{}, {"shard_rows": 60, "block_queries": 7, "sample_rows": 150}])
def test_hard_negatives_against_all_pairs(spark, monkeypatch, settings):
    monkeypatch.setattr(vs, "LEAF_ROWS", 16)
    rng = np.random.default_rng(5)
    vectors = np.concatenate([clusters(rng, 6, 60, 2.0, 5, 0.05), rng.normal(0, 1, (140, 5))])
    labels = rng.integers(0, 3, 500)
    assert mined(table_of(spark, vectors, labels), **settings) == brute.hard_negatives(vectors, labels, 10)


def test_hard_negatives_of_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.choice([-1, 0, 1, 2])) for _ in range(3)], i % 3) for i in range(60)]
    odd = [(70, None, 1), (80, [1.0, None, 1.0], 1), (90, [math.nan] * 3, 1), (100, [math.inf, 0.0, 0.0], 1), (110, [1.0, 1.0, 1.0], None), (120, [], 1), (121, [], 1), (122, [], 2),
           (130, [2.0, 1.0], 0), (131, [2.0, 2.0], 0), (132, [2.0, 1.5], 1)]
    table = spark.createDataFrame(rows + odd, SCHEMA).withColumns({name: F.lit("clash") for name in ("cell", "block", "query", "rank", "score", "vector")})
    found = mined(table)
    plain = brute.hard_negatives([v for _, v, _ in rows], [k for _, _, k in rows], 10)
    # Vectors without components score 0 with each other, and a positive score of 0 takes negatives of score 0.
    extra = [(120, 121, 1, 122, 0, 0), (130, 131, 1, 132, 393216, 360448)]
    assert found == sorted(plain + extra)
    none = table.limit(0)
    assert mined(none) == []
    assert mined(table.where("vec_id % 10 <> 0")) == []


def test_equal_anchors_are_answered_once(spark):
    rng = np.random.default_rng(9)
    vectors, labels = rng.normal(0, 1, (50, 4)), rng.integers(0, 2, 50)
    table = table_of(spark, vectors, labels)
    once = brute.hard_negatives(vectors, labels, 10)
    doubled = table.unionByName(table.where("vec_id = 10"))
    own = [row for row in mined(doubled) if row[0] == 10]
    assert own == [row for row in once if row[0] == 10]


def test_ranges_rule_out_siblings():
    """On clustered rows most leaves are never scored, and none that holds a hit is left out."""
    rng = np.random.default_rng(6)
    vectors = np.floor(256 * clusters(rng, 32, 128, 0.1, 16))
    rows = np.zeros(len(vectors), vs.row_type(16))
    rows["id"], rows["vector"], rows["label"] = np.arange(len(vectors)), vectors, np.arange(len(vectors)) % 2
    most = float(np.abs(vectors).max())
    sphere = hard_negatives.Sphere(most, float(np.sqrt((vectors**2).sum(axis=1)).max() / most))
    tree = hard_negatives.Tree(rows, sphere, 32)
    queries = np.zeros(4, vs.query_type(16))
    queries["vector"], queries["id"], queries["low"], queries["high"] = vectors[:4], np.arange(4), np.iinfo(np.int64).min, np.iinfo(np.int64).max
    scored = []
    best = vs.Best(queries, 5, hard_negatives._positive)
    take = best.take
    best.take = lambda active, leaf: (scored.append(len(active) * len(leaf)), take(active, leaf))
    tree.visit(best)
    q, ids, _ = best.found()
    exact = inner_products(queries["vector"], vectors)
    for i in range(4):
        fit = [j for j in np.lexsort((np.arange(len(vectors)), -exact[i])).tolist() if j != i and j % 2 == 0][:5]
        assert ids[q == i].tolist() == fit
    assert sum(scored) < 0.4 * 4 * len(vectors)
