"""One query for each operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changefold.llm import chat, fingerprints, genetic_packing, hard_negatives, line_dedup, mixing, near_dedup, packing, pii, quality, repetition, substring_dedup, topk
from changefold.llm.common import let, table, words_array
from changefold.llm.oracle import ORACLE_SQL  # noqa: F401

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
ACCEPT = 0.7


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    chained = fingerprints.with_next_text(table(spark, sf_dir, "documents"))
    edit = fingerprints.edited("text", "next_text")
    rows = chained.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "text", "next_text", edit.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    pairs = (("near_edited", "text", "edited"), ("near_next", "text", "next_text"))
    found = fingerprints.compared(rows, ("text", "next_text", "edited"), pairs)
    return found.select(
        "doc_id", "n_chars", "edited_sha256", F.col("text").alias("fingerprint"), F.col("edited").alias("edited_fingerprint"), "near_edited", "near_next"
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, pii.BASE), F.sha2(pii.written(base).cast("binary"), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"), pii.written(F.col("spans"), score=True).alias("scored_spans"),
    )


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized, sources, pieces = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.taken(sized, sources, pieces).drop("copy")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, weights)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(rows, rows.where(F.col("vec_id") % 20 == 0))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    length = (F.octet_length("ids") / 4).cast("long")
    return pieces.select(
        "doc_id", "start", length.alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.prepared(given.withColumn("label", shifted))
    found = hard_negatives.hard_negatives(rows, rows.where(F.col("vec_id") % 100 == 0))
    return found.withColumn("rank", F.col("rank").cast("int"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", looped(F.col("doc_id"), "text").alias("text"))
    found = repetition.collapse_runs(docs)
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    ratio = lambda a, b: a["length"] * b["period"]  # noqa: E731  larger where a repeats more often
    # Runs come by start, then period, and the sort is stable.
    order = lambda a, b: F.when(ratio(a, b) > ratio(b, a), -1).when(ratio(a, b) < ratio(b, a), 1).otherwise(0)
    best = F.get(F.array_sort("runs", order), F.lit(0))
    exponent = F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        exponent.cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def looped(doc_id: Column, text: str) -> Column:
    """The text, with the words from one on repeating in one document of ten, so that there are long runs to find."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        ends = F.struct(a.alias("a"), p.alias("p"))
        place = lambda i, e: F.when(i < e["a"], i).otherwise(e["a"] + F.pmod(i - e["a"], e["p"])).cast("int")
        return let(ends, lambda e: F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i, e))), " "))

    chosen = F.when(F.pmod(h, F.lit(10)) == 0, F.col(text))
    looped = let(words_array(chosen), lambda words: F.when(F.size(words) > 0, repeated(words)))
    return F.coalesce(looped, F.col(text))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = genetic_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER))
    length = (F.octet_length("ids") / 4).cast("long")
    return pieces.select(
        "doc_id", "piece", "start", length.alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_pii": op2_pii,
    "op3_near_dedup": op3_near_dedup,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_line_dedup": op7_line_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_top_k": op9_top_k,
    "op10_packing": op10_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_best_fit_packing": op13_best_fit_packing,
}
