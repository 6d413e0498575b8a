"""Hard negatives of anchors: rows of other labels that score almost as high as a positive.

Rows of one vector length are points of a sphere: with M the largest norm, x becomes (x, sqrt(M^2 - |x|^2)),
and a query a becomes (a, 0), so that the squared distance |a|^2 + M^2 - 2 a.x falls as the score rises, and a
window of scores is an annulus around the query. The index is a multiway hyperplane tree of the GNAT
kind: every split point takes the rows nearest to it, and keeps for each sibling's rows the smallest
and the largest distance to itself. A sibling whose range does not meet the query's annulus, seen from
any of the split points, holds nothing wanted. The tree's top is fitted on a sample and spread over the
cluster (see ``vector_search``), its ranges being those of all rows; the lower levels are built for each
shard by the task that searches it. Leaves are scored exactly, in whole numbers.

Positives are the best rows of the anchor's label: their annulus is a ball that shrinks as better ones
are found. Each positive's window of scores is then a query for rows of other labels.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part;
vectors of different lengths never meet, and those without components score 0 with each other; rows
that share the anchor's vec_id are neither its positives nor its negatives, other repeated rows count
one by one; equal anchors are answered once; a null vec_id is no anchor and comes last in ties; scores
beyond 64 bits count as the nearest number of 64 bits; without rows or anchors there is no answer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changefold.llm import vector_search as vs
from changefold.llm.common import map_arrow, staged
from changefold.llm.vectors import floored, given_id, sound

SPLIT_POINTS = 8
#: Rows of a node from which its split points are chosen.
_CANDIDATES = 64
#: By how much of the sphere's radius rounding may move a distance.
_SLACK = 1e-6


def prepared(rows: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", scale: int = 256) -> DataFrame:
    """vec_id, label, vector (floor of each component times ``scale``) of the rows that take part."""
    kept = rows.where(sound(vector_column) & F.col(label_column).isNotNull())
    return kept.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("long").alias("label"), floored(vector_column, scale).alias("vector")
    )


def farthest_first(points: np.ndarray, wanted: int) -> np.ndarray:
    """Numbers of points, each as far as can be from those before it; fewer if the points are."""
    chosen = [0]
    nearest = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < wanted:
        one = int(nearest.argmax())
        if nearest[one] <= 1e-12:
            break
        chosen.append(one)
        nearest = np.minimum(nearest, ((points - points[one]) ** 2).sum(axis=1))
    return np.array(chosen)


def _distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(axis=1)[:, None] + (others**2).sum(axis=1)[None, :] - 2 * points @ others.T
    return np.sqrt(np.maximum(squares, 0))


@dataclass
class Sphere:
    """How vectors of one length become points: components over ``most``, radius M = ``norm``."""

    most: float
    norm: float

    def points(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.most
        lift = np.sqrt(np.maximum(self.norm**2 - (scaled**2).sum(axis=1), 0))
        return np.hstack([scaled, lift[:, None]])

    def asked(self, queries: np.ndarray) -> np.ndarray:
        return np.hstack([queries["vector"] / self.most, np.zeros((len(queries), 1))])

    def annulus(self, asked: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances between which rows with a score from ``low`` to ``high`` lie; with no way in, from 0 to less than 0."""
        squares = (asked**2).sum(axis=1) + self.norm**2
        slack = _SLACK * np.sqrt(squares)
        nearest = squares - 2 * (high / self.most) / self.most
        farthest = squares - 2 * (low / self.most) / self.most
        near, far = (np.sqrt(np.maximum(side, 0)) for side in (nearest, farthest))
        return near - slack, np.where(farthest < -(slack**2), -1.0, far + slack)


def meets(distances: np.ndarray, near: np.ndarray, far: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Queries by children: whether a child's ranges meet a query's annulus, seen from every split point.

    ``distances`` are those of the queries to the split points; ``least`` and ``most`` have a row for each
    child and a column for each split point.
    """
    to_points = distances[:, None, :]
    farthest_seen = to_points + most[None, :, :]
    nearest_seen = np.maximum(to_points - most[None, :, :], least[None, :, :] - to_points)
    return ((farthest_seen >= near[:, None, None]) & (nearest_seen <= far[:, None, None])).all(axis=2)


@dataclass
class Node:
    rows: tuple[int, int]
    splits: np.ndarray | None = None
    least: np.ndarray | None = None
    most: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)


class Tree:
    def __init__(self, rows: np.ndarray, sphere: Sphere, leaf_rows: int) -> None:
        self.sphere = sphere
        points = sphere.points(rows["vector"])
        order = np.arange(len(rows))
        self.root = Node((0, len(rows)))
        open_nodes = [self.root]
        while open_nodes:
            node = open_nodes.pop()
            a, b = node.rows
            if b - a <= leaf_rows:
                continue
            own = order[a:b]
            some = points[own[:: max(1, (b - a) // _CANDIDATES)]]
            splits = some[farthest_first(some, SPLIT_POINTS)]
            if len(splits) < 2:
                continue
            distances = _distances(points[own], splits)
            child = distances.argmin(axis=1)
            grouped = np.argsort(child, kind="stable")
            order[a:b] = own[grouped]
            counts = np.bincount(child, minlength=len(splits))
            if counts.max() == b - a:
                continue
            ends = np.cumsum(counts)
            full = np.flatnonzero(counts)
            by_child = [distances[grouped[ends[c] - counts[c] : ends[c]]] for c in full]
            node.splits = splits
            node.least = np.stack([part.min(axis=0) for part in by_child])
            node.most = np.stack([part.max(axis=0) for part in by_child])
            node.children = [Node((a + int(ends[c] - counts[c]), a + int(ends[c]))) for c in full]
            open_nodes += node.children
        self.rows = rows[order]

    def visit(self, best: vs.Best) -> None:
        asked = self.sphere.asked(best.queries)
        waiting = [(self.root, np.arange(len(best.queries)))]
        while waiting:
            node, active = waiting.pop()
            if not node.children:
                best.take(active, self.rows[node.rows[0] : node.rows[1]])
                continue
            distances = _distances(asked[active], node.splits)
            near, far = self.sphere.annulus(asked[active], best.low[active].astype(float), best.high[active].astype(float))
            wanted = meets(distances, near, far, node.least, node.most)
            # The child that is nearest to most of the queries is visited first, and so pushed last.
            closeness = (node.least + node.most)[None, :, :] - 2 * distances[:, None, :]
            for child in np.argsort(-np.abs(closeness).sum(axis=(0, 2))).tolist():
                own = active[wanted[:, child]]
                if len(own):
                    waiting.append((node.children[child], own))


class Top:
    """The top of the tree: split points from a sample, and the ranges of all rows."""

    def __init__(self, sample: np.ndarray, cells: int, most: float, norm: float) -> None:
        self.sphere = Sphere(most, norm)
        points = self.sphere.points(sample)
        self.splits = points[farthest_first(points, cells)]
        n = len(self.splits)
        self.least, self.most = np.full((n, n), np.inf), np.full((n, n), -np.inf)

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        return self.features(vectors).argmin(axis=1).astype(np.int32)

    def features(self, vectors: np.ndarray) -> np.ndarray:
        return _distances(self.sphere.points(vectors), self.splits)

    def know(self, cell: int, feature: int, least: float, most: float) -> None:
        self.least[cell, feature], self.most[cell, feature] = least, most

    def reach(self, queries: np.ndarray) -> np.ndarray:
        asked = self.sphere.asked(queries)
        near, far = self.sphere.annulus(asked, queries["low"].astype(float), queries["high"].astype(float))
        distances = _distances(asked, self.splits)
        # By cell, as the table of all queries, cells and split points would be large.
        by_cell = [meets(distances, near, far, self.least[c : c + 1], self.most[c : c + 1]) for c in range(len(self.splits))]
        return np.hstack(by_cell)

    def tree(self, rows: np.ndarray) -> Tree:
        return Tree(rows, self.sphere, vs.LEAF_ROWS)


def _positive(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return vs.different_id(queries, rows) & (queries["label"][:, None] == rows["label"][None, :])


def _negative(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return vs.different_id(queries, rows) & (queries["label"][:, None] != rows["label"][None, :])


def _windows(percent: int):
    """Blocks of anchors and their positives → blocks of windows, one query for each positive."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, block, cell, data, found in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                anchors = np.frombuffer(data, vs.query_type(length))
                found = sorted((f["query"], f["rank"], f["vec_id"], f["score"]) for f in found)
                windows = anchors[np.searchsorted(anchors["query"], [f[0] for f in found])].copy()
                windows["query"] = np.arange(len(windows))
                windows["first"], windows["second"] = [f[2] for f in found], [f[3] for f in found]
                windows["high"] = windows["second"]
                windows["low"] = [-(-percent * f[3] // 100) for f in found]
                windows = windows[windows["low"] <= windows["high"]]
                columns = [pa.array([length], pa.int32()), pa.array([block], pa.int64()), pa.array([cell], pa.int32()), pa.array([windows.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["length", "block", "cell", "queries"])

    return run


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    *,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    shard_rows: int = vs.SHARD_ROWS,
    block_queries: int = vs.BLOCK_QUERIES,
    sample_rows: int = vs.SAMPLE_ROWS,
    most_cells: int = vs.MOST_CELLS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Both tables have vec_id, label and vector (whole numbers as doubles). For each anchor's best rows of
    its label, the best rows of other labels that score at most as high and at least ``percent`` of it.
    """
    shards = vs.Shards(rows, Top, "negatives-shards", shard_rows, sample_rows, most_cells)
    blocks = vs.blocks_of(anchors.where("vec_id IS NOT NULL"), shards, "negatives-anchors", block_queries)
    found = vs.search(blocks, shards, positives, _positive, "negatives-raised")
    listed = found.groupBy("length", "block").agg(F.collect_list(F.struct("query", "rank", "vec_id", "score")).alias("found"))
    met = blocks.join(listed, ["length", "block"]).select("length", "block", "cell", "queries", "found")
    windows = staged(map_arrow(met, _windows(percent), vs.BLOCK), "negatives-windows")
    mined = vs.search(windows, shards, negatives, _negative, "negatives-raised")
    return mined.select(
        F.col("query_id").alias("anchor_id"), given_id("first").alias("positive_id"), "rank", given_id("vec_id").alias("negative_id"),
        F.col("second").alias("positive_score"), F.col("score").alias("negative_score"),
    )
