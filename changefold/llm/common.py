"""What several operators share: staged tables, and words of a batch of texts as numpy arrays."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from changefold.session import scratch_dir

#: White space of the contracts: space and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one round of array work takes at once. A longer text is a round of its own.
ROUND_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(rows: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write rows to the shared scratch folder and read them back: cuts the lineage, survives lost executors."""
    spark = rows.sparkSession
    path = scratch_dir(spark, purpose)
    rows.write.options(**options).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def map_arrow(rows: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` that sends this subpackage's code along, so that executors need not have it installed."""
    for name, module in list(sys.modules.items()):
        if name.startswith(__package__ + "."):
            cloudpickle.register_pickle_by_value(module)
    return rows.mapInArrow(run, schema)


def fresh(name: str, columns: list[str]) -> str:
    """A column name that no input column has, whatever the session's case rules."""
    taken = {column.lower() for column in columns}
    while name in taken:
        name += "_"
    return name


def words_array(text: str | Column) -> Column:
    """Non-empty words of a text; null has none."""
    return F.filter(F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), SPACES), lambda w: w != "")


#: Values over which a scan builds one list at a time.
STRETCH = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often and how deep ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan(values: Column, begin: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """State after each of the values, from ``begin`` on; ``kind`` is the state's SQL type.

    Lists grow by copying, so that they are built stretch by stretch and joined at the end.
    """
    none = F.array().cast(f"array<{kind}>")

    def within(part: Column, start: Column) -> Column:
        last = lambda done: F.when(F.size(done) == 0, start).otherwise(F.element_at(done, -1))
        return F.aggregate(part, none, lambda done, value: F.concat(done, F.array(step(last(done), value))))

    def stretch(values: Column, done: Column, k: Column) -> Column:
        start = F.when(F.size(done) == 0, begin).otherwise(F.element_at(F.element_at(done, -1), -1))
        return F.concat(done, F.array(within(F.slice(values, k * STRETCH + 1, F.lit(STRETCH)), start)))

    def whole(values: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / STRETCH).cast("int"))
        every = F.aggregate(places, F.array().cast(f"array<array<{kind}>>"), lambda done, k: stretch(values, done, k))
        return F.when(F.size(values) == 0, none).otherwise(F.flatten(every))

    return let(values, whole)


# -- numpy ---------------------------------------------------------------------------------

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
#: Random odd numbers from a fixed seed, one for each byte, and the base of the polynomial.
_BYTE_CODE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_CODE = _BYTE_CODE[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """The first n powers of the base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        wanted = np.full(max(n, 1 << 12), _BASE, np.uint64)
        wanted[0] = 1
        _powers = np.cumprod(wanted, dtype=np.uint64)
    return _powers[:n]


@dataclass
class Words:
    """Words of consecutive texts. ``first`` has one entry more than there are texts."""

    data: np.ndarray  # the texts' bytes
    start: np.ndarray  # of each word, in bytes
    end: np.ndarray
    first: np.ndarray  # number of the first word of each text

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; ``lower`` takes A-Z as a-z."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        begin = int(self.start[0])
        stop = int(self.end[-1])
        own = self.data[begin:stop]
        spans = np.diff(np.append(self.start, stop))
        position = np.arange(len(own)) - np.repeat(self.start - begin, spans)
        longest = int((self.end - self.start).max())
        np.minimum(position, longest - 1, out=position)
        value = (_LOWER_CODE if lower else _BYTE_CODE)[own] * powers(longest)[position]
        value[_IS_SPACE[own]] = 0
        sums = np.add.reduceat(value, self.start - begin)
        return mix(sums + (self.end - self.start).astype(np.uint64))


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts that lie between consecutive offsets."""
    solid = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid
    ends = ends.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    start = np.flatnonzero(starts)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def text_rounds(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Bytes of a column of texts (null: empty), some rows at a time: number of the first, bytes, offsets."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + ROUND_BYTES, "right")) - 1)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


_WORD_ROLE = np.random.default_rng(77).integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(words: Words, size: int, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``size`` words.

    A text with fewer words has its whole sequence as its only one; without words it has none.
    """
    codes = words.hashes(lower)
    rolled = np.zeros(max(0, len(codes) - size + 1), np.uint64)
    for k in range(size):
        rolled += codes[k : k + len(rolled)] * _WORD_ROLE[k]
    rolled = mix(rolled)
    sets = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            found = np.sort(rolled[a : b - size + 1])
            sets.append(found[np.append(True, found[1:] != found[:-1])] if len(found) > 1 else found)
        elif b > a:
            sets.append(mix((codes[a:b] * _WORD_ROLE[: b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            sets.append(codes[a:b])
    return sets
