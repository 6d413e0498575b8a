"""Document fingerprints: the k smallest hashes of a text's word shingles.

A fingerprint is text: the number k's hashes (``HASH_BYTES`` each, ascending) in base 64. Fingerprints
of parts merge into that of their union, and two fingerprints estimate resemblance, containment and,
each by itself, the number of distinct shingles. Sets of at most k shingles are estimated exactly.

Defined results: a null text counts as empty; an empty text, or one of white space, has the empty
fingerprint; two empty fingerprints resemble each other fully, an empty and another not at all; a text
with fewer words than a shingle has its whole sequence as its only shingle.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from changefold.llm.common import find_words, map_arrow, shingle_sets, text_rounds

SHINGLE_WORDS = 5
K = 256
HASH_BYTES = 5


def smallest(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct hashes, cut to HASH_BYTES bytes; ``hashes`` are sorted."""
    cut = hashes[: 2 * k] >> np.uint64(64 - 8 * HASH_BYTES)
    return np.unique(cut)[:k]


def to_text(sketch: np.ndarray) -> str:
    wide = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BYTES :]
    return base64.b64encode(wide.tobytes()).decode()


def from_text(fingerprint: str | None) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint or ""), np.uint8).reshape(-1, HASH_BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 8 - HASH_BYTES :] = raw
    return wide.view(">u8").ravel().astype(np.uint64)


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Fingerprint of the union of two parts."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles among all shingles of both."""
    union = merged(a, b, k)
    if not len(union):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(common, union, assume_unique=True).sum() / len(union))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    if len(a) < k:
        return float(len(a))
    return (k - 1) / (float(a[k - 1]) / 2.0 ** (8 * HASH_BYTES))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first set's shingles that the second set has; 1 for an empty first set."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct(merged(a, b, k), k)
    return min(1.0, both / distinct(a, k))


def _sketches(texts: pa.Array, words: int, k: int) -> list[np.ndarray]:
    found = []
    for _, data, offsets in text_rounds(texts):
        found += [smallest(one, k) for one in shingle_sets(find_words(data, offsets), words)]
    return found


def fingerprints(docs: DataFrame, text_columns: tuple[str, ...] = ("text",), *, words: int = SHINGLE_WORDS, k: int = K) -> DataFrame:
    """``docs`` with each text column replaced by its fingerprint."""
    return _mapped(docs, text_columns, words, k, pairs=())


def compared(docs: DataFrame, text_columns: tuple[str, ...], pairs: tuple[tuple[str, str, str], ...], *, words: int = SHINGLE_WORDS, k: int = K) -> DataFrame:
    """Like ``fingerprints``, plus for each (name, column, column) of ``pairs`` the two's resemblance."""
    return _mapped(docs, text_columns, words, k, pairs)


def _mapped(docs, text_columns, words, k, pairs):
    kept = [c for c in docs.columns if c not in text_columns]
    rows = docs.select(*kept, *(F.col(c).cast("string").alias(c) for c in text_columns))
    schema = rows
    for name, _, _ in pairs:
        schema = schema.withColumn(name, F.lit(0.0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                part = batch.slice(start, 2_000)
                sketches = {c: _sketches(part.column(len(kept) + i), words, k) for i, c in enumerate(text_columns)}
                texts = [pa.array(map(to_text, sketches[c]), pa.string()) for c in text_columns]
                likeness = [
                    pa.array([resemblance(x, y, k) for x, y in zip(sketches[a], sketches[b], strict=True)], pa.float64())
                    for _, a, b in pairs
                ]
                own = [part.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*own, *texts, *likeness], [*kept, *text_columns, *(p[0] for p in pairs)])

    return map_arrow(rows, run, schema.schema)


def with_next_text(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, text and next_text: the text of the row that follows by doc_id (after the last: the first).

    Rows are dealt into ranges of doc_id with about as many rows each. Only the first row of each
    range has to be looked up from the range before it. Nulls come first; rows of one doc_id follow
    each other by text.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = [(i + 1) / ranges for i in range(ranges - 1)] or [1.0]
    bounds = rows.agg(F.percentile_approx("doc_id", marks, 20 * ranges)).first()[0]
    dealt = rows.withColumn("range", _range_of(F.col("doc_id"), sorted(set(bounds or []))))
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "text")
    first = dealt.groupBy("range").agg(F.min(order).alias("first"))  # one row for each range
    onward = W.orderBy("range")
    following = F.coalesce(F.lead("first").over(onward), F.first("first").over(onward.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    ends = first.select("range", following["text"].alias("following"))
    within = W.partitionBy("range").orderBy("doc_id", "text")
    chained = dealt.withColumn("next_text", F.lead("text").over(within))
    return chained.join(ends, "range").select("doc_id", "text", F.coalesce("next_text", "following").alias("next_text"))


def _range_of(value: Column, bounds: list[int]) -> Column:
    """Number of bounds below a value, by halving."""

    def halve(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= bounds[middle], halve(low, middle)).otherwise(halve(middle + 1, high))

    return F.when(value.isNull(), -1).otherwise(halve(0, len(bounds)))


def edited(text: str, following: str) -> Column:
    """A text with its last half replaced by as much of the beginning of another."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(F.col(text), F.lit(1), F.char_length(text) - half), F.substring(F.col(following), F.lit(1), half))
