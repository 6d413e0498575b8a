"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Features of a text are its words, pairs of neighbouring words, and the same of the words' shapes (kind
of first and last character, capitals only, length, same as the word before). Each is hashed to one of
2**BITS weights; its value is its share among the text's features, times SCALE. So a score is a sparse
dot product, and long texts weigh no more than short ones.

The weights are learnt in one task from a bounded sample of labelled rows (``sample``, the rows of
smallest hash of doc_id, all if there are fewer); scoring is spread over all tasks, with the weights,
whose size is fixed, sent to each.

Defined results: null and empty texts are scored by the intercept alone; without any labelled row the
score is 0.5; a doc_id labelled twice counts twice; labels that are null are left out; columns beside
those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from changefold.llm.common import Words, find_words, map_arrow, mix, text_rounds

BITS = 18
SCALE = 64.0
#: Labelled rows to learn from, and passes over them.
SAMPLE = 16_000
PASSES = 3
#: Of the learner: step, smoothing of steps, and the two penalties.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.002, 0.02

_KIND = np.zeros(256, np.uint64)  # of a character's first or last byte
_KIND[48:58] = 1
_KIND[65:91] = 2
_KIND[97:123] = 3
_KIND[128:] = 4
_PUNCTUATION = [c for c in range(33, 127) if not _KIND[c]]
_KIND[_PUNCTUATION] = 5 + np.arange(len(_PUNCTUATION), dtype=np.uint64)


def _shapes(words: Words, codes: np.ndarray) -> np.ndarray:
    length = words.end - words.start
    small = ((words.data >= 97) & (words.data < 123)) | (words.data >= 128)
    seen = np.append(0, np.cumsum(small))
    lower = (seen[words.end] - seen[words.start]) > 0
    same = np.append(False, codes[1:] == codes[:-1])
    shape = _KIND[words.data[words.start]] | _KIND[words.data[words.end - 1]] << np.uint64(8)
    shape |= lower.astype(np.uint64) << np.uint64(16) | same.astype(np.uint64) << np.uint64(17)
    return mix(shape | np.minimum(length, 24).astype(np.uint64) >> np.uint64(1) << np.uint64(18) | np.uint64(1 << 40))


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Weight numbers of all texts' features, four rows for each word, and each text's first word.

    A pair that would reach into the text before is replaced by a mark of the text's begin.
    """
    codes = words.hashes(lower=False)
    shapes = _shapes(words, codes) if len(codes) else codes
    begins = words.first[:-1][np.diff(words.first) > 0]
    rows = []
    for tag, own in ((1, codes), (2, shapes)):
        before = np.roll(own, 1)
        before[begins] = tag
        rows += [own, own * np.uint64(0x9E3779B97F4A7C15) + before * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(tag)]
    hashed = np.stack([mix(row + np.uint64(k)) for k, row in enumerate(rows)]) if len(codes) else np.zeros((4, 0), np.uint64)
    return (hashed >> np.uint64(64 - BITS)).astype(np.int64), words.first


def _learn(passes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (1 << BITS) + 1  # the last is the intercept
        z, n = np.zeros(size), np.zeros(size)
        examples = []
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for row, data, offsets in text_rounds(batch.column(0)):
                numbers, first = features(find_words(data, offsets))
                for k in range(len(offsets) - 1):
                    own = numbers[:, first[k] : first[k + 1]].ravel()
                    at, count = np.unique(own, return_counts=True)
                    value = (SCALE / max(1, len(own))) * count
                    examples.append((np.append(at, size - 1).astype(np.int32), np.append(value, 1.0).astype(np.float32), labels[row + k]))
        for _ in range(passes):
            for at, value, label in examples:
                zs, ns = z[at], n[at]
                w = np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2))
                gradient = (_sigmoid(w @ value) - label) * value
                square = gradient * gradient
                z[at] = zs + gradient - (np.sqrt(ns + square) - np.sqrt(ns)) / ALPHA * w
                n[at] = ns + square
        weights = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype("<f4").tobytes()], pa.binary())], ["weights"])

    return run


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def train(labelled: DataFrame, *, sample: int = SAMPLE, passes: int = PASSES) -> np.ndarray:
    """Weights learnt from rows of doc_id, text, label (0 or 1)."""
    rows = labelled.where("label IS NOT NULL").select("text", F.col("label").cast("int").alias("label"), F.xxhash64("doc_id").alias("place"), "doc_id")
    one = rows.repartition(1).sortWithinPartitions("place", "doc_id", "text").select("text", "label")
    found = map_arrow(one, _learn(passes), "weights binary").first()
    if found is None:  # Spark leaves the task out where it knows that there are no rows
        return np.zeros((1 << BITS) + 1, np.float32)
    return np.frombuffer(found["weights"], "<f4")


def chosen(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of smallest hash of doc_id, at most ``sample``."""
    return labels.where("label IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)


def score(docs: DataFrame, weights: np.ndarray, *, id_columns: tuple[str, ...] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """``id_columns`` and a score between 0 and 1 of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(*id_columns, F.col(text_column).alias("__text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.astype(np.float64)
        for batch in batches:
            scores = []
            for _, data, offsets in text_rounds(batch.column(len(id_columns))):
                numbers, first = features(find_words(data, offsets))
                sums = np.append(0.0, np.cumsum(own[numbers].sum(axis=0)))
                count = np.diff(first)
                scores.append(_sigmoid(own[-1] + SCALE * (sums[first[1:]] - sums[first[:-1]]) / np.maximum(1, 4 * count)))
            kept = [batch.column(i) for i in range(len(id_columns))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(scores) if scores else [], pa.float64())], [*id_columns, "score"])

    schema = rows.drop("__text").withColumn("score", F.lit(0.0)).schema
    return map_arrow(rows, run, schema)


def held_out(doc_id: str = "doc_id", remainder: int = 2, parts: int = 4) -> Column:
    """Whether a row is kept from learning: by a checksum of its doc_id as text (null: never)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == remainder, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> np.ndarray:
    """Weights from the labelled rows of ``docs`` that are not held out; labels as ``quality`` marks them."""
    known = labels.select("doc_id", F.col("quality").alias("label")).where(~held_out())
    few = F.broadcast(chosen(known, sample))  # at most ``sample`` rows of two numbers
    return train(docs.select("doc_id", "text").join(few, "doc_id"), sample=sample)
