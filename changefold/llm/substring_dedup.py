"""Repeated passages: every window of ``window`` words that also starts in an earlier document.

Super-k-mers: neighbouring windows of a text whose smallest hashed run of MINIMISER words (the
minimiser) is the same occurrence travel together, as one string of words, to the bucket that the
minimiser names. Equal windows have equal minimisers, so each bucket can decide on its windows alone.

A task gathers GATHERED bytes of strings, equal ones once with the list of their places, and puts them
out as one compressed block for each part (a number of buckets). The task that has a part sorts its
windows and finds the smallest document of each distinct one, block group by block group, then goes
over the blocks again for the places at which a window is not its first. Beside one group it holds a
part's compressed blocks and its distinct windows; a passage that a third of all documents share is
one string in each block. Windows are sorted and compared by 64-bit hashes, within one part.

Back come only the spans of words to remove, gathered by row: by doc_id and a hash of the text.

Defined results: a null text has no words; a null doc_id counts as larger than any other; rows that
share a doc_id, or have none, are never earlier than each other, and of each only its own repeated
windows go; texts shorter than a window stay whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from changefold.llm.common import Words, find_words, map_arrow, mix, text_rounds

WINDOW = 13
MINIMISER = 3
#: Bytes of strings a task gathers before it puts them out, and of those it compares in one round.
GATHERED = 24 << 20
COMPARED = 16 << 20
#: Bytes that a block should have at least on average; parts are made accordingly, and at most so many
#: for each partition of the shuffle.
BLOCK_BYTES = 16 << 10
FINENESS = 8
#: How hard blocks are compressed.
LEVEL = 5
_LAST = np.iinfo(np.int64).max
_ROLE = np.random.default_rng(1313).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)

BLOCKS = "part int, size long, block binary"
SPANS = "doc_id long, text_hash long, from_word int, to_word int"


def _rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    sums = np.zeros(max(0, len(codes) - size + 1), np.uint64)
    for k in range(size):
        sums += codes[k : k + len(sums)] * _ROLE[k]
    return mix(sums)


def _single_spaced(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words joined by one space, and where each begins and ends."""
    length = words.end - words.start + 1
    end = np.cumsum(length)
    start = end - length
    source = np.repeat(words.start - start, length) + np.arange(end[-1] if len(end) else 0)
    joined = words.data[np.minimum(source, len(words.data) - 1)]
    joined[end - 1] = 32
    return joined.tobytes(), start, end - 1


def super_kmers(words: Words, window: int, minimiser: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first word, last word and bucket of every super-k-mer."""
    codes = words.hashes()
    if len(codes) < window:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    grams = _rolled(codes, minimiser)
    views = np.lib.stride_tricks.sliding_window_view(grams, window - minimiser + 1)
    at = np.empty(len(views), np.int64)
    for low in range(0, len(views), 1 << 16):
        at[low : low + (1 << 16)] = views[low : low + (1 << 16)].argmin(axis=1)
    at += np.arange(len(at))
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    inside = text[: len(at)] == text[window - 1 :]
    begins = inside.copy()
    begins[1:] &= (at[1:] != at[:-1]) | ~inside[:-1] | (text[1 : len(at)] != text[: len(at) - 1])
    ends = inside.copy()
    ends[:-1] &= begins[1:] | ~inside[1:]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    return text[first], first, last + window - 1, mix(grams[at[first]] ^ np.uint64(window)).view(np.int64)


def _block(strings: list[bytes], places: list[tuple[list[int], list[int], list[int]]]) -> bytes:
    """Strings with the documents, their texts' hashes and places of each, compressed."""
    counts = np.array([len(docs) for docs, _, _ in places], "<i4")
    docs = np.array([d for own, _, _ in places for d in own], "<i8")
    texts = np.array([t for _, own, _ in places for t in own], "<i8")
    starts = np.array([s for _, _, own in places for s in own], "<i4")
    head = np.array([len(counts), len(docs)], "<i8")
    whole = b"".join([head.tobytes(), counts.tobytes(), docs.tobytes(), texts.tobytes(), starts.tobytes(), b"\n".join(strings)])
    return np.array([len(whole)], "<i8").tobytes() + pa.Codec("zstd", compression_level=LEVEL).compress(whole, asbytes=True)


def _unblock(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How often each string occurs, where (document, hash of its text, place), and the bytes of all strings, a line each."""
    size = int(np.frombuffer(block, "<i8", 1)[0])
    whole = pa.decompress(block[8:], size, codec="zstd", asbytes=True)
    n, places = np.frombuffer(whole, "<i8", 2).tolist()
    counts = np.frombuffer(whole, "<i4", n, 16)
    docs = np.frombuffer(whole, "<i8", places, 16 + 4 * n)
    texts = np.frombuffer(whole, "<i8", places, 16 + 4 * n + 8 * places)
    starts = np.frombuffer(whole, "<i4", places, 16 + 4 * n + 16 * places)
    return counts, docs, texts, starts, np.frombuffer(whole, np.uint8, offset=16 + 4 * n + 20 * places)


def _emit(window: int, minimiser: int, parts: int):
    def blocks_of(found: dict[bytes, tuple]) -> pa.RecordBatch:
        part = np.fromiter((row[0] for row in found.values()), np.int64, len(found))
        order = np.argsort(part, kind="stable")
        strings, places = list(found), [row[1:] for row in found.values()]
        edges = np.flatnonzero(np.diff(part[order], prepend=-1, append=parts))
        blocks, sizes = [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = order[a:b].tolist()
            blocks.append(_block([strings[i] for i in own], [places[i] for i in own]))
            sizes.append(sum(len(strings[i]) for i in own))
        return pa.RecordBatch.from_arrays(
            [pa.array(part[order][edges[:-1]].astype(np.int32)), pa.array(sizes, pa.int64()), pa.array(blocks, pa.binary())], ["part", "size", "block"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, tuple] = {}
        held = 0
        for batch in batches:
            ids, hashes = batch.column(0).fill_null(_LAST).to_pylist(), batch.column(1).to_pylist()
            for row, data, offsets in text_rounds(batch.column(2)):
                words = find_words(data, offsets)
                text, first, last, bucket = super_kmers(words, window, minimiser)
                joined, begin, end = _single_spaced(words)
                part = (bucket.view(np.uint64) % np.uint64(parts)).tolist() if len(text) else []
                spans = zip(text.tolist(), (first - words.first[text]).tolist(), begin[first].tolist(), end[last].tolist(), part, strict=True)
                for k, start, a, b, name in spans:
                    string = joined[a:b]
                    known = found.get(string)
                    if known is None:
                        found[string] = (name, [ids[row + k]], [hashes[row + k]], [start])
                        held += b - a
                    else:
                        known[1].append(ids[row + k])
                        known[2].append(hashes[row + k])
                        known[3].append(start)
                if held > GATHERED:
                    yield blocks_of(found)
                    found, held = {}, 0
        if found:
            yield blocks_of(found)

    return run


class _Group:
    """Windows of some blocks' strings."""

    def __init__(self, blocks: list[bytes], window: int) -> None:
        opened = [_unblock(block) for block in blocks]
        self.counts, self.docs, self.texts, self.starts = (np.concatenate([one[i] for one in opened]) for i in range(4))
        codes, sizes = [], []
        for *_, data in opened:
            offsets = np.concatenate(([0], np.flatnonzero(data == 10) + 1, [len(data)]))
            words = find_words(data, offsets)
            codes.append(words.hashes())
            sizes.append(np.diff(words.first))
        sizes = np.concatenate(sizes)
        self.windows = sizes - window + 1  # of each string
        self.first = np.cumsum(self.windows) - self.windows
        place = np.repeat(np.cumsum(sizes) - sizes - self.first, self.windows) + np.arange(self.windows.sum())
        self.keys = _rolled(np.concatenate(codes), window)[place]

    def smallest(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct windows, sorted, and the smallest document of each."""
        least = np.minimum.reduceat(self.docs, np.cumsum(self.counts) - self.counts)
        return _least(self.keys, np.repeat(least, self.windows))

    def repeated(self, keys: np.ndarray, least: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents, hashes of their texts, and spans of words in them, of windows that also start in a smaller document."""
        of_window = least[np.searchsorted(keys, self.keys)]
        # Every place of a string has all of its windows.
        string = np.repeat(np.arange(len(self.counts)), self.counts)
        per = self.windows[string]
        total = int(per.sum())
        before = np.cumsum(per) - per
        step = np.arange(total) - np.repeat(before, per)
        again = np.repeat(self.docs, per) > of_window[np.repeat(self.first[string], per) + step]
        inner = np.ones(total + 1, bool)
        inner[before] = False
        opens, closes = again.copy(), again.copy()
        opens[1:] &= ~(again[:-1] & inner[1:total])
        closes[:-1] &= ~(again[1:] & inner[1:total])
        a, b = np.flatnonzero(opens), np.flatnonzero(closes)
        place = np.searchsorted(before, a, "right") - 1
        start = self.starts[place].astype(np.int64)
        return self.docs[place], self.texts[place], start + step[a], start + step[b] + window


def _least(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, docs = keys[order], docs[order]
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[begins], np.minimum.reduceat(docs, begins) if len(keys) else docs


def _part(blocks: list[bytes], sizes: list[int], window: int) -> Iterator[pa.RecordBatch]:
    groups: list[list[bytes]] = [[]]
    held = 0
    for block, size in zip(blocks, sizes, strict=True):
        if groups[-1] and held + size > COMPARED:
            groups.append([])
            held = 0
        groups[-1].append(block)
        held += size
    keys, least, group = np.zeros(0, np.uint64), np.zeros(0, np.int64), None
    for own in groups:
        group = _Group(own, window)
        new = group.smallest()
        keys, least = _least(np.append(keys, new[0]), np.append(least, new[1])) if len(keys) else new
    for own in groups:
        group = group if len(groups) == 1 else _Group(own, window)
        docs, texts, from_word, to_word = group.repeated(keys, least, window)
        if len(docs):
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs), pa.array(texts), pa.array(from_word.astype(np.int32)), pa.array(to_word.astype(np.int32))],
                ["doc_id", "text_hash", "from_word", "to_word"],
            )


def _compare(window: int):
    """Rows come by part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks, sizes = None, [], []
        for batch in batches:
            for number, size, block in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if number != part:
                    if blocks:
                        yield from _part(blocks, sizes, window)
                    part, blocks, sizes = number, [], []
                blocks.append(block)
                sizes.append(size)
        if blocks:
            yield from _part(blocks, sizes, window)

    return run


def repeated_spans(docs: DataFrame, *, window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """doc_id, text_hash, from_word and to_word (exclusive) of words that windows of earlier documents cover."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = partitions * max(1, min(FINENESS, GATHERED // (BLOCK_BYTES * partitions)))
    blocks = map_arrow(rows, _emit(window, minimiser, parts), BLOCKS)
    dealt = blocks.repartition(partitions, "part").sortWithinPartitions("part")
    return map_arrow(dealt, _compare(window), SPANS)


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column(2)
        for row, data, offsets in text_rounds(batch.column(1)):
            words = find_words(data, offsets)
            joined, begin, end = _single_spaced(words)
            own = spans.slice(row, len(offsets) - 1)
            per = pc.list_value_length(own).fill_null(0).to_numpy()
            flat = own.flatten()
            shift, limit = np.repeat(words.first[:-1], per), np.repeat(words.first[1:], per)
            a = np.minimum(flat.field(0).to_numpy() + shift, limit)
            b = np.minimum(flat.field(1).to_numpy() + shift, limit)
            depth = np.zeros(len(begin) + 1, np.int64)
            np.add.at(depth, a, 1)
            np.add.at(depth, b, -1)
            keep = np.cumsum(depth)[:-1] == 0
            n_words, kept = np.diff(words.first), np.append(0, np.cumsum(keep))[words.first]
            texts = []
            for k in range(len(n_words)):
                x, y = int(words.first[k]), int(words.first[k + 1])
                if kept[k + 1] - kept[k] == y - x:
                    texts.append(joined[begin[x] : end[y - 1]] if y > x else b"")
                else:
                    runs = np.flatnonzero(np.diff(np.concatenate(([False], keep[x:y], [False])).astype(np.int8)))
                    texts.append(b" ".join(joined[begin[x + i] : end[x + j - 1]] for i, j in zip(runs[::2].tolist(), runs[1::2].tolist(), strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(n_words)), pa.array(n_words, pa.int64()), pa.array(n_words - np.diff(kept), pa.int64()),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )


def without_repeats(docs: DataFrame, *, window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by one space) of every row."""
    spans = repeated_spans(docs, window=window, minimiser=minimiser)
    # Rows equal in id and text find the same spans, so that one span is kept once however many there are.
    gathered = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("from_word", "to_word")).alias("spans"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    key = (F.coalesce(rows["doc_id"], F.lit(_LAST)) == gathered["doc_id"]) & (F.xxhash64(rows["text"]) == gathered["text_hash"])
    joined = rows.join(gathered, key, "left").select(rows["doc_id"], "text", "spans")
    return map_arrow(joined, _remove, "doc_id long, n_words long, n_removed long, kept_text string")
