"""Exact search for rows of highest inner product, in shards that an index deals out and rules out.

An index is fitted on a bounded sample: it deals rows to cells, and knows for each cell the smallest and
largest of some features of its rows (coordinates, distances to split points), taken over all rows. A
cell is dealt into shards of about ``shard_rows`` by a hash, so that no shard is large, whatever
the rows are; each shard gets a tree of the index's kind. Queries go in blocks of the same cell. A block
is first searched in one shard of its own cell, which gives every query a score that its results
have to reach; then in the shards of all cells that the index cannot rule out by that score.

What the driver holds is bounded by the sample, the number of cells and the number of vector lengths.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from changefold.llm.common import map_arrow, staged
from changefold.llm.vectors import ids_of, inner_products, matrix

SHARD_ROWS = 4096
BLOCK_QUERIES = 256
SAMPLE_ROWS = 4096
MOST_CELLS = 256
LEAF_ROWS = 128
_LOWEST = np.iinfo(np.int64).min
_HIGHEST = np.iinfo(np.int64).max

SHARD = "length int, cell int, sub int, rows binary, least binary, most binary"
BLOCK = "length int, block long, cell int, queries binary"
WORK = ("length", "cell", "sub", "block", "data")
HIT = "length int, block long, query int, query_id long, first long, second long, vec_id long, score long"


def row_type(length: int) -> np.dtype:
    return np.dtype([("id", "<i8"), ("label", "<i8"), ("vector", "<f8", (length,))])


def query_type(length: int) -> np.dtype:
    """``low`` and ``high`` bound the scores wanted; ``first`` and ``second`` are carried along to the hits."""
    fields = [(name, "<i8") for name in ("id", "label", "low", "high", "first", "second")]
    return np.dtype([("query", "<i4"), *fields, ("vector", "<f8", (length,))])


class Best:
    """Hits of some queries in a shard. ``low`` rises to the k-th best score of each query."""

    def __init__(self, queries: np.ndarray, k: int, fits: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> None:
        self.queries, self.k, self.fits = queries, k, fits
        self.low, self.high = queries["low"].copy(), queries["high"]
        self.top = np.full((len(queries), k), _LOWEST, np.int64)
        self.hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def take(self, active: np.ndarray, rows: np.ndarray) -> None:
        """Score the rows of one leaf with the queries named, all by one product."""
        asked = self.queries[active]
        scores = inner_products(asked["vector"], rows["vector"])
        wanted = (scores >= self.low[active, None]) & (scores <= self.high[active, None]) & self.fits(asked, rows)
        q, r = np.nonzero(wanted)
        if not len(q):
            return
        self.hits.append((active[q], rows["id"][r], scores[q, r]))
        some = np.unique(q)
        better = np.concatenate([self.top[active[some]], np.where(wanted[some], scores[some], _LOWEST)], axis=1)
        better = np.partition(better, better.shape[1] - self.k, axis=1)[:, -self.k :]
        self.top[active[some]] = better
        self.low[active[some]] = np.maximum(self.low[active[some]], better.min(axis=1))

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of queries, ids and scores: the k best of each query, the smaller id first among equals."""
        if not self.hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, ids, scores = (np.concatenate(part) for part in zip(*self.hits, strict=True))
        kept = scores >= self.low[q]
        q, ids, scores = q[kept], ids[kept], scores[kept]
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        return tuple(column[rank < self.k] for column in (q, ids, scores))


# -- dealing rows ----------------------------------------------------------------------------


_PLACED = "length int, vec_id long, label long, vector array<double>, cell int, sub int"


def _cells(indexes: dict, subs: dict | None) -> Callable:
    """Adds each row's cell, and its sub by the drawn number once the cells' sizes are known."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(0).to_numpy()
            cell = np.zeros(batch.num_rows, np.int32)
            sub = np.zeros(batch.num_rows, np.int32)
            for length in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == length)
                if length in indexes:
                    cell[own] = indexes[length].assign(matrix(batch.column(3).take(pa.array(own)), length))
                if subs:
                    among = np.array([subs[length, c] for c in cell[own].tolist()])
                    sub[own] = batch.column(4).to_numpy()[own] % among
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(cell), pa.array(sub)], [*batch.schema.names[:4], "cell", "sub"])

    return run


def _dealt(rows: DataFrame, indexes: dict, size: int) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """Rows with cell and sub, about ``size`` to each pair, and the number of subs of every cell."""
    # The draw parts repeats of one row; over a scan it is the same each time a task is run.
    drawn = F.xxhash64("vec_id", (F.rand(17) * (1 << 30)).cast("long")).alias("drawn")
    listed = rows.select(F.size("vector").alias("length"), "vec_id", "label", "vector", drawn)
    counted = map_arrow(listed, _cells(indexes, None), _PLACED).groupBy("length", "cell").count().collect()
    subs = {(row["length"], row["cell"]): -(-row["count"] // size) for row in counted}
    return map_arrow(listed, _cells(indexes, subs), _PLACED), subs


def _shard(indexes: dict) -> Callable:
    def run(part: pa.Table) -> pa.Table:
        length = part.column("length")[0].as_py()
        rows = np.empty(part.num_rows, row_type(length))
        rows["id"], rows["label"] = ids_of(part.column("vec_id")), ids_of(part.column("label"))
        rows["vector"] = matrix(part.column("vector"), length)
        rows = rows[np.argsort(rows["id"], kind="stable")]
        features = indexes[length].features(rows["vector"]) if length in indexes else np.zeros((len(rows), 0))
        ranges = [pa.array([side.astype("<f8").tobytes()], pa.binary()) for side in (features.min(axis=0), features.max(axis=0))]
        names = ["length", "cell", "sub", "rows", "least", "most"]
        return pa.table(dict(zip(names, [*(part.column(n).slice(0, 1) for n in names[:3]), pa.array([rows.tobytes()], pa.binary()), *ranges], strict=True)))

    return run


def _ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for length, cell, least, most in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            low, high = np.frombuffer(least, "<f8"), np.frombuffer(most, "<f8")
            n = len(low)
            columns = [pa.array([length] * n, pa.int32()), pa.array([cell] * n, pa.int32()), pa.array(np.arange(n, dtype=np.int32)), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays(columns, ["length", "cell", "feature", "low", "high"])


class Shards:
    """Rows (vec_id, label, vector of whole numbers) in shards, with the index that dealt them.

    ``fit`` makes an index of a sample (a matrix), the number of cells wanted, the largest component and
    the largest norm of all rows of that length.
    """

    def __init__(self, rows: DataFrame, fit: Callable, purpose: str, shard_rows: int, sample_rows: int, most_cells: int) -> None:
        rows = rows.select("vec_id", "label", "vector")
        most = F.array_max(F.transform("vector", lambda x: F.abs(x)))
        unit = F.aggregate("vector", F.lit(0.0), lambda total, x: total + (x / F.col("most")) * (x / F.col("most")))
        sized = rows.select(F.size("vector").alias("length"), "vector", most.alias("most"))
        sized = sized.select("length", "most", F.when(F.col("most") > 0, F.log("most") + F.log(unit) / 2).alias("norm"))
        seen = sized.groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.max("most").alias("most"), F.max("norm").alias("norm")).collect()
        sample = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(sample_rows).select("vector").collect()
        self.indexes = {}
        for row in seen:
            own = [r["vector"] for r in sample if len(r["vector"]) == row["length"]]
            if own and row["length"] and row["most"]:
                norm = float(np.exp(row["norm"] - np.log(row["most"]))) * (1 + 1e-9)
                self.indexes[row["length"]] = fit(np.array(own), min(most_cells, -(-row["n"] // shard_rows)), row["most"], norm)
        dealt, self.subs = _dealt(rows, self.indexes, shard_rows)
        shards = dealt.groupBy("length", "cell", "sub").applyInArrow(_shard(self.indexes), SHARD)
        self.table = staged(shards, purpose)
        found = map_arrow(self.table.select("length", "cell", "least", "most"), _ranges, "length int, cell int, feature int, low double, high double")
        for row in found.groupBy("length", "cell", "feature").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            self.indexes[row["length"]].know(row["cell"], row["feature"], row["low"], row["high"])


# -- queries ---------------------------------------------------------------------------------


def _block(part: pa.Table) -> pa.Table:
    length, cell, sub = (part.column(name)[0].as_py() for name in ("length", "cell", "sub"))
    queries = np.zeros(part.num_rows, query_type(length))
    queries["id"], queries["label"] = ids_of(part.column("vec_id")), ids_of(part.column("label"))
    queries["vector"] = matrix(part.column("vector"), length)
    queries["low"], queries["high"] = _LOWEST, _HIGHEST
    queries = queries[np.argsort(queries["id"], kind="stable")]
    queries["query"] = np.arange(len(queries))
    columns = [pa.array([length], pa.int32()), pa.array([cell << 32 | sub], pa.int64()), pa.array([cell], pa.int32()), pa.array([queries.tobytes()], pa.binary())]
    return pa.table(dict(zip(("length", "block", "cell", "queries"), columns, strict=True)))


def blocks_of(queries: DataFrame, shards: Shards, purpose: str, block_queries: int) -> DataFrame:
    """Distinct rows as queries without bounds, in blocks of one cell."""
    distinct = staged(queries.select("vec_id", "label", "vector").distinct(), purpose)
    dealt, _ = _dealt(distinct, shards.indexes, block_queries)
    return staged(dealt.groupBy("length", "cell", "sub").applyInArrow(_block, BLOCK), purpose)


def _asked(indexes: dict, subs: dict) -> Callable:
    """Work for shards: every block, cut down to the queries that a cell may answer."""
    of_length: dict[int, list[tuple[int, int]]] = {}
    for (length, cell), n in sorted(subs.items()):
        of_length.setdefault(length, []).append((cell, n))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, block, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                queries = np.frombuffer(data, query_type(length))
                cells = of_length.get(length, [])
                reach = indexes[length].reach(queries) if length in indexes else None
                for cell, n in cells:
                    own = queries if reach is None else queries[reach[:, cell]]
                    if len(own):
                        columns = [pa.array([length] * n, pa.int32()), pa.array([cell] * n, pa.int32()), pa.array(np.arange(n, dtype=np.int32)),
                                   pa.array([block] * n, pa.int64()), pa.array([own.tobytes()] * n, pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, list(WORK))

    return run


def _answers(indexes: dict, plain: Callable, k: int, fits: Callable, raise_only: bool) -> Callable:
    """Rows come by shard: first the shard itself, then the queries it has to answer.

    With ``raise_only`` queries come out again, their lower bounds raised to their k-th score in the shard.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            for i in range(batch.num_rows):
                length, cell, block, data = (batch.column(c)[i].as_py() for c in (0, 1, 3, 4))
                if block is None:
                    rows = np.frombuffer(data, row_type(length))
                    tree = (indexes[length].tree if length in indexes else plain)(rows)
                    continue
                queries = np.frombuffer(data, query_type(length))
                best = Best(queries, k, fits)
                tree.visit(best)
                if raise_only:
                    raised = queries.copy()
                    raised["low"] = best.low
                    columns = [pa.array([length], pa.int32()), pa.array([block], pa.int64()), pa.array([cell], pa.int32()), pa.array([raised.tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["length", "block", "cell", "queries"])
                    continue
                q, ids, scores = best.found()
                if len(q):
                    asked = queries[q]
                    columns = [np.full(len(q), length, np.int32), np.full(len(q), block, np.int64), asked["query"], asked["id"], asked["first"], asked["second"], ids, scores]
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], [name.split()[0] for name in HIT.split(", ")])

    return run


class Whole:
    """A shard that is one leaf."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows

    def visit(self, best: Best) -> None:
        best.take(np.arange(len(best.queries)), self.rows)


def search(blocks: DataFrame, shards: Shards, k: int, fits: Callable, purpose: str) -> DataFrame:
    """The k best rows of each query within its bounds: HIT's columns, and ``rank`` from 1.

    ``fits`` says for some queries and rows which of them may meet. Ties go to the smaller vec_id.
    """
    spark = blocks.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nobody = F.lit(None).cast("long").alias("block")
    held = shards.table.select("length", "cell", "sub", nobody, F.col("rows").alias("data"))

    def met(asked: DataFrame, held: DataFrame, raise_only: bool, schema: str) -> DataFrame:
        work = held.unionByName(asked).repartition(parts, "length", "cell", "sub")
        ordered = work.sortWithinPartitions("length", "cell", "sub", F.col("block").asc_nulls_first())
        return map_arrow(ordered, _answers(shards.indexes, Whole, k, fits, raise_only), schema)

    # A cell of queries may have no rows, and then no shard to start from.
    there = [F.lit(f"{length}:{cell}") for length, cell in shards.subs]
    at_home = F.concat_ws(":", "length", "cell").isin(*there) if there else F.lit(False)
    home = blocks.where(at_home).select("length", "cell", F.lit(0).alias("sub"), "block", F.col("queries").alias("data"))
    raised = met(home, held.where("sub = 0"), True, BLOCK).unionByName(blocks.where(~at_home))
    raised = staged(raised, purpose)
    asked = map_arrow(raised.select("length", "block", "queries"), _asked(shards.indexes, shards.subs), "length int, cell int, sub int, block long, data binary")
    hits = met(asked, held, False, HIT)
    order = W.partitionBy("length", "block", "query").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def different_id(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return queries["id"][:, None] != rows["id"][None, :]
