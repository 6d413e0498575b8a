"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents, shuffled by a hash, make one long stream of words that starts again when it
ends; the stream is cut into blocks of equal size. The points of the golden-ratio sequence, taken
through the cumulative target weights, say which source each slot of the schedule draws from; the
n-th slot of a source takes the source's n-th block. Any stretch of the schedule so has each source
near its weight. A source's last block is cut at its target.

Running sums and ranks are taken in two steps, within hash or slot ranges and then over the ranges,
so that a source which holds most of the data is never one task.

Defined results: a null text has size 0 and is never drawn; null is a source of its own, last in
order; rows that share a doc_id are documents of their own, told apart by ``copy``; an empty table,
or one without words, gives an empty schedule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from changefold.llm.common import NOT_SPACES, SPACES, fresh, staged

#: Words of a block.
BLOCK_WORDS = 256
#: Slots of which ranks are taken together, and cells of the unit interval.
SLOT_RANGE = 8192
CELLS = 1024
GOLDEN = 0.6180339887498949
#: Weight by a source's place in the order of names, repeating.
WEIGHTS = (3, 1, 2)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(NOT_SPACES)), F.lit(0)).cast("long")


def copy_number(source: str = "source", text_hash: str = "text_hash") -> Column:
    """Tells rows of one doc_id apart. Rows equal in source and text are interchangeable."""
    return F.row_number().over(W.partitionBy("doc_id").orderBy(text_hash, source)).cast("int")


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, copy, source, size and a hash to shuffle by, of every row."""
    sized = docs.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("text_hash"))
    shuffled = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return sized.select("doc_id", copy_number().alias("copy"), "source", "size", shuffled.alias("shuffle"))


def targets(sized: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Source sizes and targets; one row per source.

    Targets share ``share`` times all sizes by weight. None is above ``most`` times its source's size:
    in the order of that cap per weight, sources are capped as long as the level which the others
    would reach is not below their cap.
    """
    by_name = W.orderBy(F.col("source").isNull(), "source")
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), "source_no")
    listed = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(by_name).cast("long"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("source_no") - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", most * F.col("source_size"))
    )
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    budget = share * F.sum("source_size").over(everything)
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levelled = listed.withColumn("level", level)
    free = F.when(F.col("level") * F.col("weight") < F.col("cap"), F.struct("level"))
    reached = F.coalesce(F.first(free, ignorenulls=True).over(by_cap.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))["level"], F.lit(float("inf")))
    return levelled.select("source", "source_no", "source_size", F.least("cap", reached * F.col("weight")).alias("target"))


def schedule(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """Slots in order: slot, source_no, block_no (of the source's repeated stream)."""
    spark = sources.sparkSession
    drawn = sources.where("target >= 1").withColumn("blocks", F.ceil(F.floor("target") / F.lit(block)))
    total = F.sum("target").over(W.partitionBy())
    until = F.sum("target").over(W.orderBy("source_no"))
    drawn = drawn.withColumns({"low": (until - F.col("target")) / total, "high": until / total})
    last = (F.col("source_no") == F.max("source_no").over(W.partitionBy())).cast("int")
    drawn = drawn.withColumn("high", F.col("high") + last)
    # The interval of a source is looked up by the cells it overlaps, of which each has few sources.
    cells = drawn.select(
        "source_no", "low", "high", "blocks",
        F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))).alias("cell"),
    )
    n_slots, n_sources = drawn.agg(F.coalesce(F.sum("blocks"), F.lit(0)), F.coalesce(F.max("source_no"), F.lit(0))).first()
    point = (F.col("slot") + 1) * GOLDEN
    slots = spark.range(n_slots).withColumnRenamed("id", "slot").withColumn("point", point - F.floor(point))
    slots = slots.withColumn("cell", F.floor(F.col("point") * CELLS))
    hits = slots.join(cells, "cell").where("point >= low AND point < high").select("slot", "source_no", "blocks")
    hits = hits.withColumn("range", F.floor(F.col("slot") / SLOT_RANGE))
    per_range = hits.groupBy("source_no", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(W.partitionBy("source_no").orderBy("range")) - F.col("n")
    per_range = per_range.withColumn("earlier", earlier)
    ranked = hits.join(per_range.select("source_no", "range", "earlier"), ["source_no", "range"])
    rank = F.row_number().over(W.partitionBy("source_no", "range").orderBy("slot")) - 1 + F.col("earlier")
    regular = ranked.withColumn("block_no", rank).where("block_no < blocks").select("slot", "source_no", "block_no")
    # The few blocks by which a source fell short of its weight come last.
    have = per_range.groupBy("source_no").agg(F.sum("n").alias("have"))
    short = drawn.join(have, "source_no", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < blocks")
    tail = short.select("source_no", F.explode(F.sequence(F.col("have"), F.col("blocks") - 1)).alias("block_no"))
    return regular.unionByName(tail.withColumn("slot", n_slots + F.col("block_no") * n_sources + F.col("source_no")))


def streams(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with words, each with its source's number and where its words begin in the stream."""
    keyed = sized.where("size > 0").join(sources, sized["source"].eqNullSafe(sources["source"])).drop("source")
    keyed = keyed.withColumn("range", F.substring("shuffle", 1, 3))
    sums = keyed.groupBy("source_no", "range").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(W.partitionBy("source_no").orderBy("range")) - F.col("words")
    sums = sums.select("source_no", "range", before.alias("before"))
    own = W.partitionBy("source_no", "range").orderBy("shuffle", "doc_id", "copy")
    begin = F.sum("size").over(own) - F.col("size")
    return keyed.withColumn("begin", begin).join(sums, ["source_no", "range"]).withColumn("begin", F.col("begin") + F.col("before")).drop("before", "range")


def draw(sized: DataFrame, sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """What the mix takes, in pieces: slot, source_no, block_no, doc_id, copy, round, from_word, to_word."""
    rounds = F.explode(F.sequence(F.lit(0), F.floor((F.floor("target") - 1) / F.col("source_size")))).alias("round")
    own = streams(sized, sources).where("target >= 1").select("*", rounds)
    begin = F.col("round") * F.col("source_size") + F.col("begin")
    own = own.withColumn("begin", begin).withColumn("end", F.least(F.col("begin") + F.col("size"), F.floor("target")))
    pieces = own.where("begin < end").select(
        "*", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block))).alias("block_no")
    )
    pieces = pieces.select(
        "source_no", "block_no", "doc_id", "copy", "round",
        (F.greatest("begin", F.col("block_no") * block) - F.col("begin")).alias("from_word"),
        (F.least("end", (F.col("block_no") + 1) * block) - F.col("begin")).alias("to_word"),
    )
    return pieces.join(schedule(sources, block), ["source_no", "block_no"])


def mix(docs: DataFrame, *, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents measured, sources with targets, pieces drawn) of a table with doc_id, source, text."""
    sized = staged(measure(docs), "mixing-sizes")
    sources = staged(targets(sized, share, most, weights), "mixing-sources")
    return sized, sources, draw(sized, sources, block)


def taken(sized: DataFrame, sources: DataFrame, pieces: DataFrame) -> DataFrame:
    """Every row of the input with what the mix takes of it, and the first and last slot that it is drawn for."""
    drawn = pieces.groupBy("doc_id", "copy").agg(
        F.sum(F.col("to_word") - F.col("from_word")).alias("taken"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot")
    )
    known = sized.join(sources.drop("source_no"), sized["source"].eqNullSafe(sources["source"])).drop("source")
    key = known["doc_id"].eqNullSafe(drawn["doc_id"]) & (known["copy"] == drawn["copy"])
    return known.join(drawn, key, "left").select(
        known["doc_id"], known["copy"], "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "first_slot", "last_slot",
    )


def mixed_documents(docs: DataFrame, pieces: DataFrame) -> DataFrame:
    """The drawn words as rows of ``docs``, in order of the schedule: a document drawn whole keeps its text, else its drawn words.

    A document drawn in two rounds gives two rows. Rows stand where their first slot is, ranges of slots
    being partitions, so that whoever reads them in order meets every source near its weight.
    """
    runs = pieces.groupBy("doc_id", "copy", "round").agg(
        F.min("from_word").alias("from_word"), F.max("to_word").alias("to_word"), F.min("slot").alias("slot")
    )
    runs = staged(runs, "mixing-runs").alias("r")
    hashed, copy, slot = (fresh(name, docs.columns) for name in ("text_hash", "copy", "slot"))
    first, last = F.col("r.from_word").cast("int"), F.col("r.to_word").cast("int")
    whole = (first == 0) & (last == word_count("d.text"))
    words = F.filter(F.split("d.text", SPACES), lambda w: w != "")
    text = F.when(whole, F.col("d.text")).otherwise(F.array_join(F.slice(words, first + 1, last - first), " "))
    new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id"))

    def drawn(keyed: DataFrame, by: Column) -> DataFrame:
        return keyed.alias("d").join(runs, by).select(*(new.get(c, F.col(f"d.{c}")).alias(c) for c in docs.columns), F.col("r.slot").alias(slot))

    # Only rows that share a doc_id need numbers, so that the other texts move by doc_id no more than once.
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id")
    shared = staged(shared, "mixing-shared").alias("s")
    if shared.isEmpty():
        rows = drawn(docs, same)
    else:
        given = docs.alias("g")
        is_shared = F.col("g.doc_id").eqNullSafe(F.col("s.doc_id"))
        keyed = given.join(shared, is_shared, "left_semi").withColumn(hashed, F.xxhash64("text"))
        keyed = keyed.withColumn(copy, copy_number(text_hash=hashed))
        rows = drawn(given.join(shared, is_shared, "left_anti"), same).unionByName(drawn(keyed, same & (F.col(f"d.{copy}") == F.col("r.copy"))))
    return rows.repartitionByRange(slot).sortWithinPartitions(slot).drop(slot)
