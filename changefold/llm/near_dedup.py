"""Near-duplicate documents by MinHash: one-permutation hashing, optimal densification, banded buckets.

A document's set is the set of its word shingles. Documents with equal sets are one class from the
start, so that groups of copies cost one row. Each class has one hash per bin, empty bins borrowing
from a full one that a fixed random sequence finds; ROWS bins together name a bucket.

Candidate pairs are stars: in each bucket every class is paired with a centre, the class that shares
most buckets with others, which in a group of near copies is the text they derive from. Pairs are
confirmed on the full sets. That settles a bucket whose classes are one component afterwards, or whose
others are ruled out: the distance 1 - similarity is a metric, so that a class near a centre (at most
0.2) cannot be linked with one far from it (more than 0.4). Classes of buckets that are not settled,
as short texts around one common line make them, are joined by what they differ in from their centre.
Copies around a centre have most of their shingles in common with each other, but few of their
differences, and linked ones that are not both near the centre must share a good part of these: pairs
are those that share one of the rarest, enough of them to miss no link. So no two classes are paired
because they are around the same centre alone, and nothing is capped.

Two sets of similarity 0.8 share no bucket with a chance of (1 - 0.8 ** ROWS) ** (BINS / ROWS) = 5e-8.
What follows the buckets is exact.

Defined results: null texts and texts without words have the empty set, linked with nothing; a text
with fewer words than a shingle has its whole sequence as its only one; a null doc_id is never the
smallest of a component; rows that share a doc_id are judged each by its own text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from changefold.llm.common import fresh, find_words, map_arrow, mix, shingle_sets, staged, text_rounds
from changefold.llm.components import components

BINS = 128
ROWS = 4

_ROLE = np.random.default_rng(99).integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One hash for each bin of a sorted, not empty set of hashes: the smallest that falls in it.

    An empty bin looks at the bins that a hash of its own number and of 0, 1, 2 and so on names, and
    takes what the first full one of them has.
    """
    edges = np.arange(bins, dtype=np.uint64) * np.uint64(2**64 // bins)
    at = np.searchsorted(hashes, edges)
    full = np.append(at[1:], len(hashes)) > at
    value = hashes[np.minimum(at, len(hashes) - 1)]
    empty = np.flatnonzero(~full)
    if len(empty) >= bins - 1:
        return np.full(bins, value[full][0])
    tried, tries = 0, 8
    while len(empty):
        steps = np.arange(tried, tried + tries, dtype=np.uint64)
        donors = (mix(empty.astype(np.uint64)[:, None] << np.uint64(32) | steps) % np.uint64(bins)).astype(np.int64)
        hit = full[donors]
        found = hit.any(axis=1)
        value[empty[found]] = value[donors[found, hit[found].argmax(axis=1)]]
        empty = empty[~found]
        tried, tries = tried + tries, min(2 * tries, 256)
    return value


def bands(value: np.ndarray, rows: int) -> np.ndarray:
    """Names of the buckets of a signature."""
    names = (value.reshape(-1, rows) * _ROLE[:rows]).sum(axis=1, dtype=np.uint64)
    return mix(names ^ mix(np.arange(1, len(names) + 1, dtype=np.uint64))).view(np.int64)


def _sign(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_rounds(batch.column(2)):
                sets = shingle_sets(find_words(data, offsets), words)
                sizes = np.fromiter(map(len, sets), np.int64, len(sets))
                keys = [mix(s).sum(dtype=np.uint64).tobytes() + mix(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).tobytes() for s in sets]
                names = [bands(signature(s, BINS), ROWS) for s in sets if len(s)]
                per = BINS // ROWS
                ends = np.append(0, np.cumsum((sizes > 0) * per)).astype(np.int32)
                flat = np.concatenate(names) if names else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
                own = [batch.column(i).slice(row, len(sets)) for i in range(2)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(sizes), pa.array(keys, pa.binary()), lists], ["doc_id", "text_hash", "n_shingles", "set_key", "buckets"]
                )

    return run


def _sets(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_rounds(batch.column(1)):
                sets = shingle_sets(find_words(data, offsets), words)
                ends = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sets)), lists], ["node", "hashes"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def signed(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_key and buckets of every row."""
    schema = "doc_id long, text_hash long, n_shingles long, set_key binary, buckets array<long>"
    return map_arrow(_texts(docs), _sign(words), schema)


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_key, component, component_id and kept of every row of ``docs``.

    ``component`` numbers the components, null for rows without words. ``component_id`` is the smallest doc_id that links lead to; ``kept`` marks that document. Sets
    are linked when 100 * common >= percent * all their shingles.
    """
    rows = staged(signed(docs, words), "near-signed")
    one = F.struct("doc_id", "text_hash")
    classes = rows.where("n_shingles > 0").groupBy("set_key").agg(
        F.min(F.when(F.col("doc_id").isNotNull(), one)).alias("known"), F.min(one).alias("any"),
        F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets"),
    )
    of = F.coalesce("known", "any")
    classes = classes.select("set_key", of["doc_id"].alias("doc_id"), of["text_hash"].alias("text_hash"), "n", "buckets")
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    linked = _components(docs, classes, words, percent)
    named = classes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "component").select("set_key", "component", "component_id")
    found = rows.join(named, "set_key", "left")
    alone = F.col("n_shingles") == 0
    smallest = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.col("doc_id").eqNullSafe(smallest).alias("kept")
    return found.select("doc_id", "text_hash", "n_shingles", "set_key", "component", smallest.alias("component_id"), kept)


def _components(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """node and component of every class that is linked with another."""
    spread = classes.select("node", "n", F.explode(F.array_distinct("buckets")).alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = staged(spread.join(shared, "bucket"), "near-members")
    ranks = members.groupBy("node").agg(F.sum("members").alias("rank"))
    members = staged(members.drop("members").join(ranks, "node"), "near-ranked")
    sets = staged(_sets_of(docs, classes.join(ranks.select("node"), "node", "left_semi"), words), "near-sets")

    top = members.groupBy("bucket").agg(F.max(F.struct("rank", (-F.col("node")).alias("minus"), "n")).alias("top"))
    centres = top.select("bucket", (-F.col("top.minus")).alias("a"), F.col("top.n").alias("n_a"))
    stars = centres.join(members.select("bucket", F.col("node").alias("b"), "n"), "bucket").where("a <> b")
    measured = staged(_measured(_pairs(stars), sets), "near-pairs")
    links = staged(_linked(measured, percent), "near-links")
    known = components(links)

    open_ = staged(_unsettled(members, centres, measured, known, percent), "near-unsettled")
    new = staged(_linked(_measured(_pairs(_candidates(open_, sets, percent)), sets), percent), "near-links")
    return known if new.isEmpty() else components(links.unionByName(new))


def _pairs(stars: DataFrame) -> DataFrame:
    """a and b of each pair once."""
    return stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _linked(measured: DataFrame, percent: int) -> DataFrame:
    return measured.where(100 * F.col("common") >= percent * F.col("all")).select("a", "b")


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, and sizes of the intersection and the union of their sets."""
    left = pairs.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hashes_b")), "b")
    both = left.join(sets.select(F.col("node").alias("a"), "hashes"), "a")
    common = F.size(F.array_intersect("hashes", "hashes_b")).cast("long")
    counted = both.select("a", "b", common.alias("common"), (F.size("hashes") + F.size("hashes_b")).alias("sum"))
    return counted.select("a", "b", "common", (F.col("sum") - F.col("common")).cast("long").alias("all"))


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node and sorted shingle hashes of classes, from one row of each."""
    texts, key = _texts(docs), ["doc_id", "text_hash"]
    same = [texts[k].eqNullSafe(wanted[k]) for k in key]
    found = texts.join(wanted.select("node", *key), same[0] & same[1]).select("node", "text")
    # Repeated rows give a class twice.
    return map_arrow(found, _sets(words), "node long, hashes array<long>").groupBy("node").agg(F.first("hashes").alias("hashes"))


def _with_component(rows: DataFrame, known: DataFrame) -> DataFrame:
    return rows.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _unsettled(members: DataFrame, centres: DataFrame, measured: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """centre, node, near and component of classes that may be linked with others around their bucket's centre without having been compared with them."""
    place = centres.join(members.select("bucket", "node"), "bucket").where("a <> node")
    pair = [F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")]
    place = place.select("bucket", "node", *pair).join(measured, ["a", "b"])
    near = 100 * F.col("common") >= percent * F.col("all")
    far = 100 * F.col("common") < (2 * percent - 100) * F.col("all")
    centre = F.when(F.col("a") == F.col("node"), F.col("b")).otherwise(F.col("a")).alias("centre")
    place = _with_component(place.select("bucket", "node", centre, near.alias("near"), (~near & ~far).alias("between")), known)
    part = F.when(~F.col("near"), F.col("component"))
    parts = place.groupBy("bucket").agg(
        F.max("between").alias("mixed"), F.min("component").alias("low"), F.max("component").alias("high"),
        F.min(part).alias("far_low"), F.max(part).alias("far_high"),
    )
    parts = parts.where("CASE WHEN mixed THEN low <> high ELSE far_low <> far_high END").select("bucket", "mixed")
    return place.join(parts, "bucket").where("mixed OR NOT near").select("centre", "node", "near", "component").distinct()


def _candidates(place: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a and b of the classes around one centre that may be linked, of different components and not both near it.

    Sets of n and m shingles are linked when at most r * (n + m) are in one of them only, r being
    (100 - percent) / (100 + percent). What they have apart from each other is what their differences
    from the centre have, so that differences of d and e shingles must share (d + e - r * (n + m)) / 2.
    ``d - r * n`` is at least ``-r * n_centre``, and more than ``r * n_centre`` for a class that is not
    near: that bounds from below what a class must share with any other, which is never nothing. With
    all differences around a centre in one order, rare shingles first, two that share so many meet in
    their beginnings, where enough is left of both behind the first that they share.
    """
    centre = sets.select(F.col("node").alias("centre"), F.col("hashes").alias("hashes_centre"))
    both = place.join(sets, "node").join(centre, "centre")
    apart = F.concat(F.array_except("hashes", "hashes_centre"), F.array_except("hashes_centre", "hashes"))
    sizes = [F.size("hashes").alias("n"), F.size("hashes_centre").alias("n_centre")]
    apart = staged(both.select("centre", "node", "near", "component", *sizes, apart.alias("apart")), "near-apart")

    rows = apart.select("centre", "node", "near", "component", "n", "n_centre", F.size("apart").alias("size"), F.explode("apart").alias("shingle"))
    # Shingles that one component has alone come first in the order. They lead to nothing.
    shared = rows.groupBy("centre", "shingle").agg(
        F.count(F.lit(1)).alias("members"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    rows = rows.join(shared.where("low <> high").drop("low", "high"), ["centre", "shingle"])
    own = W.partitionBy("centre", "node")
    at = F.col("size") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("members", "shingle"))
    excess = (100 + percent) * F.col("size").cast("long") - (100 - percent) * F.col("n").cast("long")
    least = (100 - percent) * F.col("n_centre").cast("long")
    rows = rows.withColumns({"left": F.col("size") - at + 1, "excess": excess, "least": least})
    enough = lambda other: 2 * (100 + percent) * F.col("left") >= F.col("excess") + other
    rows = rows.withColumns({"brief": enough(F.col("least") + 1), "long": ~F.col("near") & enough(-F.col("least"))})
    rows = staged(rows.where("brief OR long").select("centre", "shingle", "node", "near", "component", "n", "left", "excess", "brief"), "near-beginnings")

    x, y = rows.where("brief").alias("x"), rows.where("NOT near").alias("y")
    same = (F.col("x.centre") == F.col("y.centre")) & (F.col("x.shingle") == F.col("y.shingle"))
    once = F.col("x.near") | (F.col("y.brief") & (F.col("x.node") < F.col("y.node")))
    fit = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")  # else sizes alone forbid a link
    behind = 2 * (100 + percent) * F.least("x.left", "y.left") >= F.col("x.excess") + F.col("y.excess")
    found = x.join(y, same & (F.col("x.component") != F.col("y.component")) & once & fit & behind)
    return found.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def one_of_each(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, and all without words, repeated rows once."""
    found = staged(near_duplicates(docs, words=words, percent=percent).where("kept"), "near-kept")
    # Rows of one doc_id, or without one, may belong to several components; those without words to none.
    group = ["doc_id", "component", F.when(F.col("n_shingles") == 0, F.col("text_hash"))]
    doc, text = (fresh(name, docs.columns) for name in ("chosen_doc", "chosen_text"))
    chosen = found.groupBy(*group).agg(F.min("text_hash").alias(text)).select(F.col("doc_id").alias(doc), text)
    chosen = staged(chosen, "near-chosen")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(text))
    kept = docs.join(chosen, same, "left_semi")
    if found.count() > chosen.count():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept
