"""Packing whole documents into as few fixed-length sequences as can be, by a grouping genetic algorithm.

A document longer than a sequence is cut into full pieces, of which the first may be shorter; nothing
else is cut. Full pieces are sequences of their own. The rest are dealt by a hash into cells of about
``cell_items`` pieces, so that no task ever holds more than one cell at a time, however the documents
are spread. A cell is packed by several islands, each with a population of its own, a chromosome being
the sequence of every piece. Crossover injects whole well-filled sequences of one parent into another,
takes out all sequences of the other that share a piece with them, and places the displaced pieces best
fit, largest first. Mutation dissolves some of the least filled sequences likewise. After each epoch the
best chromosome of an island moves to the next one, where it takes the place of the worst. An island
rests when it has as few sequences as the sizes allow. What stands in sequences filled below
``reopen_below`` is dealt into cells once more, across the first ones, and packed again.

Texts are encoded once, and the pieces written; sizes alone go through the algorithm. Every epoch is a
written table, so that a lost executor repeats a part of one. Chance comes from the numbers of cell,
island and epoch: a repeated task gives the same.

Defined results: a null text has no ids but the end id; rows that share a doc_id, or are equal, are
packed as documents of their own; an empty table gives no pieces; columns beside the two named are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from changefold.llm.byte_tokens import ByteEncoder
from changefold.llm.common import map_arrow, staged

PIECES = "doc_id long, piece int, start long, ids binary, doc_tokens long, part int, number long, size int"
_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("ids", pa.binary()),
     ("doc_tokens", pa.int64()), ("part", pa.int32()), ("number", pa.int64()), ("size", pa.int32())]
)
#: Rows put out at a time.
_OUT_ROWS = 2_000

ISLAND = "cell long, island int, sizes binary, population array<binary>, sequences int, fill double, done boolean"
CELL = "cell long, parts array<int>, numbers array<long>, sizes binary"
PLACES = "part int, number long, size int, sequence_id long, offset long"


# -- pieces ----------------------------------------------------------------------------------


def _pieces(tokenizer: str, end_id: int, capacity: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = ByteEncoder(tokenizer), np.array([end_id], "<u4")
        part, number, out = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id = batch.column(0)[i].as_py()
                ids = np.append(encoder.encode(batch.column(1)[i].as_py() or ""), end).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    out.append((doc_id, piece, a, ids[a:b].tobytes(), len(ids), part, number, b - a))
                    number += 1
                if len(out) >= _OUT_ROWS:
                    yield _batch(out, _PIECES)
                    out = []
        if out:
            yield _batch(out, _PIECES)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


# -- one chromosome --------------------------------------------------------------------------


def fewest(sizes: np.ndarray, capacity: int) -> int:
    """A number of sequences that no packing gets below.

    For any small size, pieces too large to stand with it fill a sequence each, pieces of more than half
    a sequence stand apart from each other, and what is left of the latter must hold the rest.
    """
    counts = np.bincount(sizes, minlength=capacity + 1)
    weights = counts * np.arange(capacity + 1)
    upto, weight_upto = np.cumsum(counts), np.cumsum(weights)
    half = capacity // 2
    small = np.arange(half + 1)
    alone = upto[-1] - upto[capacity - small]
    apart, apart_weight = upto[capacity - small] - upto[half], weight_upto[capacity - small] - weight_upto[half]
    below = np.maximum(small - 1, 0)
    rest = weight_upto[half] - np.where(small > 0, weight_upto[below], 0)
    more = np.maximum(0, -(-(rest - (apart * capacity - apart_weight)) // capacity))
    return int((alone + apart + more).max()) if len(sizes) else 0


class _Space:
    """Free space of sequences, for placing pieces best fit: a bit for every amount that some sequence has."""

    def __init__(self, fills: list[int], capacity: int) -> None:
        self.capacity, self.fills = capacity, fills
        self.having: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0
        for number, fill in enumerate(fills):
            self._offer(number, capacity - fill)

    def _offer(self, number: int, free: int) -> None:
        self.having[free].append(number)
        self.bits |= 1 << free

    def place(self, size: int) -> int:
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            having = self.having[free]
            number = having.pop()
            if not having:
                self.bits &= ~(1 << free)
        else:
            free, number = self.capacity, len(self.fills)
            self.fills.append(0)
        self.fills[number] += size
        self._offer(number, free - size)
        return number


def _completed(bins: np.ndarray, sizes: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    """Renumbered sequences, with the pieces that have none (-1) placed best fit in the given order."""
    placed = bins >= 0
    numbers = np.unique(bins[placed], return_inverse=True)[1]
    full = np.empty(len(bins), np.int32)
    full[placed] = numbers
    fills = np.bincount(numbers, sizes[placed]).astype(np.int64).tolist() if len(numbers) else []
    space = _Space(fills, capacity)
    for item in order.tolist():
        full[item] = space.place(int(sizes[item]))
    return full


def _fitness(bins: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then the mean square of their fill."""
    fills = np.bincount(bins, sizes) / capacity
    return -len(fills), float((fills**2).mean()) if len(fills) else 0.0


def _largest_first(items: np.ndarray, sizes: np.ndarray, chance: np.random.Generator, jitter: float) -> np.ndarray:
    return items[np.argsort(-sizes[items] * (1 + jitter * chance.random(len(items))), kind="stable")]


def crossed(into: np.ndarray, other: np.ndarray, sizes: np.ndarray, capacity: int, chance: np.random.Generator) -> np.ndarray:
    """``into`` with some well-filled sequences of ``other`` in place of all that share a piece with them."""
    fills = np.bincount(other, sizes)
    best = np.argsort(-fills, kind="stable")[: max(1, len(fills) // 2)]
    wanted = chance.integers(1, max(1, len(best) // 4) + 1)
    injected = np.zeros(len(fills), bool)
    injected[chance.choice(best, wanted, replace=False)] = True
    moved = injected[other]
    hit = np.zeros(int(into.max()) + 1, bool)
    hit[into[moved]] = True
    displaced = hit[into] & ~moved
    bins = np.where(moved, other + len(hit), into)
    bins[displaced] = -1
    return _completed(bins, sizes, _largest_first(np.flatnonzero(displaced), sizes, chance, 0.05), capacity)


def mutated(bins: np.ndarray, sizes: np.ndarray, capacity: int, chance: np.random.Generator) -> np.ndarray:
    """Some of the least filled sequences and a few others dissolved, and their pieces placed again."""
    fills = np.bincount(bins, sizes)
    n = len(fills)
    gone = np.zeros(n, bool)
    gone[np.argsort(fills, kind="stable")[: chance.integers(1, 2 + n // 50)]] = True
    gone[chance.integers(0, n, 1 + n // 50)] = True
    displaced = np.flatnonzero(gone[bins])
    bins = np.where(gone[bins], -1, bins)
    return _completed(bins, sizes, _largest_first(displaced, sizes, chance, 0.3), capacity)


# -- islands ---------------------------------------------------------------------------------


def _founded(sizes: np.ndarray, capacity: int, individuals: int, chance: np.random.Generator, first: bool) -> list[np.ndarray]:
    """Best fit in orders from strictly largest first to loosely so; the best first."""
    none, all_of = np.full(len(sizes), -1, np.int32), np.arange(len(sizes))
    found = []
    least = fewest(sizes, capacity)
    for i in range(individuals):
        jitter = 0.0 if first and i == 0 else 0.5 * (i + 1) / individuals
        found.append(_completed(none, sizes, _largest_first(all_of, sizes, chance, jitter), capacity))
        if found[-1].max(initial=-1) + 1 <= least:
            return [found[-1]]
    return found


def evolved(sizes: np.ndarray, population: list[np.ndarray], capacity: int, generations: int, chance: np.random.Generator) -> list[np.ndarray]:
    """The population after some generations, best first. Offspring take the place of the worst."""
    least = fewest(sizes, capacity)
    ranked = sorted(((_fitness(bins, sizes, capacity), i, bins) for i, bins in enumerate(population)), key=lambda one: (-one[0][0], -one[0][1], one[1]))
    scored = [(score, bins) for score, _, bins in ranked]
    for _ in range(generations):
        if -scored[0][0][0] <= least:
            break
        # The better of two drawn is a parent, twice; what the cross gives is mutated every other time.
        a, b = (int(chance.integers(0, len(scored), 2).min()) for _ in range(2))
        child = crossed(scored[a][1], scored[b][1], sizes, capacity, chance) if a != b else scored[a][1]
        if a == b or chance.random() < 0.5:
            child = mutated(child, sizes, capacity, chance)
        score = _fitness(child, sizes, capacity)
        if score > scored[-1][0] and all(score != other for other, _ in scored):
            scored[-1] = (score, child)
            scored.sort(key=lambda one: one[0], reverse=True)
    return [bins for _, bins in scored]


def _chance(level: int, cell: int, island: int, epoch: int) -> np.random.Generator:
    return np.random.default_rng([level, cell, island, epoch])


def _found(capacity: int, individuals: int, level: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, island, listed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                sizes = np.frombuffer(listed, np.int32)
                population = _founded(sizes, capacity, individuals, _chance(level, cell, island, 0), island == 0)
                yield _island(cell, island, sizes, population, capacity)

    return run


def _evolve(capacity: int, generations: int, level: int, epoch: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, island, listed, held, arrived in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                sizes = np.frombuffer(listed, np.int32)
                population = [np.frombuffer(bins, np.int32) for bins in held]
                if arrived is not None:
                    population = [*population[: max(1, len(population) - 1)], np.frombuffer(arrived, np.int32)]
                population = evolved(sizes, population, capacity, generations, _chance(level, cell, island, epoch))
                yield _island(cell, island, sizes, population, capacity)

    return run


def _island(cell: int, island: int, sizes: np.ndarray, population: list[np.ndarray], capacity: int) -> pa.RecordBatch:
    negative, fill = _fitness(population[0], sizes, capacity)
    done = -negative <= fewest(sizes, capacity)
    kept = population[:1] if done else population
    return pa.RecordBatch.from_arrays(
        [pa.array([cell], pa.int64()), pa.array([island], pa.int32()), pa.array([sizes.tobytes()], pa.binary()),
         pa.array([[bins.tobytes() for bins in kept]], pa.list_(pa.binary())), pa.array([-negative], pa.int32()), pa.array([fill]), pa.array([done])],
        ["cell", "island", "sizes", "population", "sequences", "fill", "done"],
    )


def _settle(capacity: int, reopen_below: float, level: int):
    """Places of a cell's pieces; those of sequences to be opened again have none."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, parts, numbers, listed, best in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                sizes, bins = np.frombuffer(listed, np.int32), np.frombuffer(best, np.int32)
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(sizes[order].astype(np.int64))
                before = ends - sizes[order]
                fills = np.bincount(bins, sizes)
                begin = np.zeros(len(fills), np.int64)
                begin[1:] = np.cumsum(fills)[:-1]
                offset = np.empty(len(bins), np.int64)
                offset[order] = before - begin[bins[order]]
                sequence = (cell << 24 | bins.astype(np.int64)) << 2 | level
                reopened = fills[bins] < reopen_below * capacity
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts, pa.int32()), pa.array(numbers, pa.int64()), pa.array(sizes),
                     pa.array(sequence, mask=reopened), pa.array(offset, mask=reopened)],
                    ["part", "number", "size", "sequence_id", "offset"],
                )

    return run


def _packed_cells(
    pieces: DataFrame, level: int, capacity: int, cell_items: int, islands: int, individuals: int, epochs: int, generations: int, reopen_below: float
) -> DataFrame | None:
    """Places of pieces (part, number, size) as far as they have one; nothing without pieces."""
    spark = pieces.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = pieces.count()
    if not count:
        return None
    # A hash deals the pieces evenly, so that a cell's size is known within a few hundredths.
    cell = F.pmod(F.xxhash64("part", "number", F.lit(level)), F.lit(-(-count // cell_items)).cast("long"))
    listed = F.array_sort(F.collect_list(F.struct("part", "number", "size"))).alias("listed")
    dealt = pieces.groupBy(cell.alias("cell")).agg(listed)
    cells = map_arrow(dealt.selectExpr("cell", "listed.part", "listed.number", "listed.size"), _written_sizes, CELL)
    cells = staged(cells, "genetic-cells")
    numbered = F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island")
    spread = cells.select("cell", numbered, "sizes").repartition(parts, "cell", "island")
    state = staged(map_arrow(spread, _found(capacity, individuals, level), ISLAND), "genetic-islands")
    for epoch in range(1, epochs + 1):
        # A cell rests once any of its islands has reached the bound.
        resting = state.where("done").select("cell").distinct()
        awake = state.join(resting, "cell", "left_anti")
        if awake.isEmpty():
            break
        moved = awake.select("cell", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.get("population", F.lit(0)).alias("arrived"))
        met = awake.join(moved, ["cell", "island"], "left").select("cell", "island", "sizes", "population", "arrived")
        after = map_arrow(met.repartition(parts, "cell", "island"), _evolve(capacity, generations, level, epoch), ISLAND)
        state = staged(state.join(resting, "cell", "left_semi").unionByName(after), "genetic-islands")
    quality = F.struct(-F.col("sequences"), "fill", -F.col("island"))
    best = state.groupBy("cell").agg(F.max_by(F.get("population", F.lit(0)), quality).alias("bins"))
    settled = cells.join(best, "cell").select("cell", "parts", "numbers", "sizes", "bins")
    return staged(map_arrow(settled, _settle(capacity, reopen_below, level), PLACES), "genetic-places")


def _written_sizes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [np.array(one, np.int32).tobytes() for one in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes, pa.binary())], ["cell", "parts", "numbers", "sizes"])


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = 1024,
    end_id: int = 2,
    cell_items: int = 4096,
    islands: int = 3,
    individuals: int = 8,
    epochs: int = 3,
    generations: int = 40,
    reopen_below: float = 0.95,
) -> DataFrame:
    """Pieces of documents: doc_id, piece, start, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a byte-level tokenizer file that all executors can open.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    pieces = staged(map_arrow(texts, _pieces(tokenizer, end_id, capacity), PIECES), "genetic-pieces", compression="zstd")
    whole = F.col("size") == capacity
    result = ["doc_id", "piece", "start", "ids", "doc_tokens", "sequence_id", "offset"]
    alone = (F.col("part").cast("long") * F.lit(1 << 30) + F.col("number")) * 4
    placed = pieces.where(whole).select("*", alone.alias("sequence_id"), F.lit(0).cast("long").alias("offset")).select(*result)
    settings = (capacity, cell_items, islands, individuals, epochs, generations)
    first = _packed_cells(pieces.where(~whole).select("part", "number", "size"), 1, *settings, reopen_below)
    if first is None:
        return placed
    places = first.where("sequence_id IS NOT NULL")
    second = _packed_cells(first.where("sequence_id IS NULL").select("part", "number", "size"), 2, *settings, 0.0)
    if second is not None:
        places = places.unionByName(second)
    joined = pieces.where(~whole).join(places.drop("size"), ["part", "number"])
    return placed.unionByName(joined.select(*result))
